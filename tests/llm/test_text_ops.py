"""Tokens, packing, chat, quality, licences, URLs and toxicity on small inputs."""

import hashlib
import random
import re
import string
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tabloom.llm import chat, license_scan, packing, quality, sentencepiece_codec, toxicity, url_filter

ODD = [" ", "  ", "\n", " \n", "\t", "\0", "a", "Bc", "é", "1", "23", ".", "!?", "'s", "\xa0", "<|endoftext|>", "日本",
       "\x1c", "\x85", "🙂", "▁", "word ", "the ", "ing"]


def odd_texts(seed, n=200):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 30))) for _ in range(n)]


# -- packing ------------------------------------------------------------------

@pytest.fixture(scope="module")
def bpe():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_packed_pieces_hold_the_tokenizer_ids(docs, bpe):
    rng = random.Random(1)
    rows = [(i, t) for i, t in enumerate(odd_texts(2))] + [(300, None), (301, ""), (302, "long text " * 3000)]
    rows += [(303, "a<|endoftext|>b"), (304, "<|endoftext|><|endoftext|> x <|endoftext|>"), (305, "<|endoftext| >")]
    rows += [(400 + i, "word " * rng.randint(1, 900)) for i in range(60)]
    df = docs(*rows).repartition(3)
    pieces = packing.pack(df, length=256, window=5000).collect()
    ids = {i: bpe(t or "") + [1] for i, t in rows}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
        part = np.array(ids[p.doc_id][p.start: p.start + p.length], "<u4").tobytes()
        assert p.length > 0 and zlib.crc32(part) == p.ids_crc32 and p.doc_tokens == len(ids[p.doc_id])
    assert by_doc.keys() == ids.keys()
    for i, found in by_doc.items():
        at = 0
        for p in sorted(found, key=lambda p: p.start):
            assert p.start == at
            at += p.length
        assert at == len(ids[i])
    padded = 0
    for found in by_sequence.values():
        at = 0
        for p in sorted(found, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 256
        padded += 0 if at & (at - 1) == 0 else 256 - at
    assert padded <= 0.02 * sum(map(len, ids.values())) + 3 * 4 * 256


def test_costs_are_balanced():
    rng = random.Random(3)
    sizes = [rng.randint(50, 1500) for _ in range(400)]
    cost, room = defaultdict(float), defaultdict(int)
    for _, _, n, s in packing.assign(sizes, 2048, 1 / 2048):
        cost[s] += n + n * n / 2048
        room[s] += n
    full = [cost[s] for s in cost if room[s] == 2048]
    assert len(full) >= len(cost) - 6 and max(full) < 1.6 * sum(full) / len(full)


def test_packing_nothing(docs):
    assert packing.pack(docs().limit(0)).count() == 0


# -- SentencePiece ------------------------------------------------------------

@pytest.fixture(scope="module")
def codec():
    return sentencepiece_codec.Codec(public_tokenizers.path("piece_bpe_32k.model"))


def best_by_force(codec, pieces, text):
    """Ids of the highest sum, longer last pieces first among ties, by plain dynamic programming."""
    if not text:
        return []
    own_mark = "\U0010ffff"  # no text here holds it
    marked = (" " + text).replace("▁", own_mark).replace(" ", "▁")
    best = [(0.0, 0, [])] + [None] * len(marked)
    for end in range(1, len(marked) + 1):
        found = None
        for begin in range(max(0, end - 50), end):
            p = pieces.get(marked[begin:end])
            if p and (found is None or best[begin][0] + p[1] > found[0]):
                found = (best[begin][0] + p[1], begin, [p[0]])
        char = marked[end - 1]
        spelled = best[end - 1][0] + codec.unknown
        if char not in pieces and (found is None or spelled > found[0]):
            body = ("▁" if char == own_mark else char).encode()
            found = (spelled, end - 1, [int(codec.bytes_at[b]) for b in body])
        best[end] = found
    ids, end = [], len(marked)
    while end:
        ids[:0] = best[end][2]
        end = best[end][1]
    return ids


def test_segmentation_is_the_best_one(codec):
    a = codec.automaton
    names = {}
    stack = {0: b""}
    for state in range(len(a.depth)):  # spell the trie out again
        for byte in np.flatnonzero(a.depth[a.goto[state]] == a.depth[state] + 1):
            stack[int(a.goto[state, byte])] = stack[state] + bytes([byte])
    for state, spelled in stack.items():
        if a.piece[state] >= 0:
            names[spelled.decode()] = (int(a.piece[state]), float(a.score[state]))
    texts = odd_texts(4) + ["a\0▁b ▁\0", "Then the quick brown fox jumped over lazy dogs", "x" * 3000]
    for t, found in zip(texts, codec.encode(texts)):
        assert np.frombuffer(found, "<i4").tolist() == best_by_force(codec, names, t)
        assert codec.decode(found) == t


def test_long_stretches_are_segmented_like_short_ones(codec):
    import time

    rng = random.Random(6)
    marks = [x.replace(" ", "").replace("\n", "") for x in ODD]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(1, 300))).encode() for _ in range(60)] + ["é".encode() * 200, "日本🙂".encode() * 50]
    for t, ids in zip(texts, codec.together(texts)):
        assert codec.alone(t).tolist() == ids.tolist()
    start = time.perf_counter()
    word = "".join(rng.choice("abcdefghijklmnop") for _ in range(300_000))
    (found,) = codec.encode([word])
    assert codec.decode(found) == word and time.perf_counter() - start < 10
    assert all(len(k) <= sentencepiece_codec.CACHED_CHARS for k in codec.known)


def test_encoding_round_trip_on_spark(docs):
    rows = list(enumerate(odd_texts(5, 40))) + [(50, None), (51, "y" * 20_000)]
    out = sentencepiece_codec.encode(docs(*rows))
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in out.collect())
    assert {r.doc_id: r.text for r in sentencepiece_codec.decode(out).collect()} == {i: t or "" for i, t in rows}
    assert sentencepiece_codec.encode(docs().limit(0)).count() == 0


# -- chat ---------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, extra string"


def test_chat_reads_back_what_was_logged(spark):
    rng = random.Random(7)
    control = ["</s>", "[INST]", "[/INST]", "<s>", "\\", "<", "[", "/s>", "a", "\n", "é"]
    rows = [(c, k, "assistant" if k % 2 else "user", "".join(rng.choice(control) for _ in range(rng.randint(0, 12))), "x")
            for c in range(20) for k in range(rng.randint(1, 6))]
    rows += [(50, 0, "user", None, "x"), (50, 1, "assistant", "z" * 5000, "x"), (51, 0, None, "t", "x"), (None, 0, "user", "n", "x")]
    got = {r.conv_id: r for r in chat.read_back(chat.render(chat.event_log(spark.createDataFrame(rows, TURNS)))).collect()}
    by = defaultdict(list)
    for c, k, role, text, _ in rows:
        by[c].append((k, role or "", text or ""))
    assert got.keys() == by.keys()
    for c, turns in by.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_of_nothing_and_of_repeated_rows(spark):
    one = (1, 0, "user", "same", "x")
    assert chat.read_back(chat.render(chat.event_log(spark.createDataFrame([one, one], TURNS)))).head().n_turns == 2
    assert chat.read_back(chat.render(chat.event_log(spark.createDataFrame([], TURNS)))).count() == 0


def test_events_fold_to_the_final_text():
    log = [(1, "start", "user"), (1, "delta", "a"), (1, "regenerate", None), (1, "delta", "b"), (1, "delta", "c"),
           (1, "start", "assistant"), (1, "delta", "x"), (1, "edit", "y"), (2, "start", "user")]
    assert list(chat._messages(iter(log))) == [(1, "user", "bc"), (1, "assistant", "y"), (2, "user", "")]


def folded_by_force(log):
    """conv -> [(role, text)]: messages as dictionaries, events applied one by one in the order of the log."""
    out = {}
    for conv in {e[0] for e in log}:
        order, texts = [], {}
        for _, _, message, kind, payload in sorted((e for e in log if e[0] == conv), key=lambda e: e[1]):
            if kind == "start":
                if message not in texts:
                    order.append(message)
                texts[message] = (payload or "", "")
            elif message in texts and kind == "delta":
                texts[message] = (texts[message][0], texts[message][1] + (payload or ""))
            elif message in texts and kind == "edit":
                texts[message] = (texts[message][0], payload or "")
            elif kind == "regenerate" and message in order:
                texts[message] = (texts[message][0], "")
                order = order[:order.index(message) + 1]
        out[conv] = [texts[m] for m in order]
    return {c: t for c, t in out.items() if t}


@pytest.mark.parametrize("seed", [1, 2])
def test_any_log_folds_as_events_say(spark, seed):
    rng = random.Random(seed)
    log = []
    for conv in [*range(30), None]:
        started, seq = [], 0
        for _ in range(rng.randint(1, 25)):
            seq += rng.randint(1, 3)
            kind = rng.choice(["start", "delta", "delta", "edit", "regenerate", "delete", None])
            fresh = kind == "start" or not started
            message = rng.randint(100, 130) if fresh else rng.choice(started)
            if kind == "start" and message in started:
                continue
            started += [message] * (kind == "start")
            log.append((conv, seq, message, kind, rng.choice([None, "a", "<s>b", "[INST]", "assistant"])))
    df = spark.createDataFrame([(*e, "x") for e in rng.sample(log, len(log))], "conv_id long, seq long, message long, kind string, payload string, turn string")
    pieces = chat.render(df.repartition(5))
    got = defaultdict(list)
    for r in sorted(pieces.collect(), key=lambda r: r.turn_index):
        got[r.conv_id].append(chat.parse(r.piece))
    # a message that was dropped stays dropped; later events of it change nothing
    assert dict(got) == folded_by_force(log)
    faulty = [e for e in log if e[3] not in chat.KINDS or not any(s[0] == e[0] and s[2] == e[2] and s[3] == "start" and s[1] <= e[1] for s in log)]
    assert chat.faulty_events(df).count() == len(faulty)


def test_late_edits_and_stored_pieces(spark, tmp_path):
    log = [(1, 1, 10, "start", "user"), (1, 2, 10, "delta", "first"), (1, 3, 11, "start", "assistant"), (1, 4, 11, "delta", "answer"),
           (1, 5, 10, "edit", "mended"), (1, 6, 11, "delta", "!"), (1, 7, 12, "start", "user"), (1, 8, 11, "regenerate", None), (1, 9, 11, "delta", "anew")]
    pieces = chat.render(spark.createDataFrame(log, "conv_id long, seq long, message long, kind string, payload string"))
    pieces.repartition(4, "piece").write.parquet(str(tmp_path / "pieces"))
    got = chat.read_back(spark.read.parquet(str(tmp_path / "pieces"))).first()
    assert got.n_turns == 2 and got.turns_sha256 == hashlib.sha256(b"user\nmended\nassistant\nanew\n").hexdigest()


# -- quality ------------------------------------------------------------------

def test_quality_measures_and_verdicts(docs):
    rng = random.Random(8)
    plain = [(i, " ".join(rng.choice(["the", "of", "and", "house", "river", "garden", "to", "in"]) for _ in range(80)).capitalize() + ".")
             for i in range(40)]
    again = "one two three four five six seven eight "
    rows = plain + [(100, None), (101, ""), (102, again * 5), (103, "$$$ ### %%% " * 30), (104, "x y\nx y\n\n \nx y z\nx y"),
                    (105, " ".join("WORDS AND LETTERS EVERYWHERE NOW".split() * 1) + " " + " ".join(f"Q{i}ZK" for i in range(80)))]
    df = docs(*rows)
    got = {r.doc_id: r for r in quality.judge(df).collect()}
    assert all(got[i].kept for i, _ in plain)
    assert got[100].n_words == 0 and got[100].base_failed and got[101].base_failed
    assert got[102].n_repeat_words == 40 and got[102].base_failed
    assert got[103].n_symbols == 270 and not got[103].kept
    assert got[104].n_dup_lines == 2 and got[104].word_chars == 9
    assert not got[105].kept and not got[105].base_failed
    kept = quality.keep(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_words_are_judged_by_their_language(spark, docs):
    rng = random.Random(9)
    common = "the of and to in was that with for on as by at from it is".split()

    def prose(n):
        return " ".join(rng.choice(common) if rng.random() < 0.4 else "".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(n))

    def salad(n):
        return " ".join("".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(n))

    rows = [(i, prose(150)) for i in range(80)] + [(200, salad(60)), (201, salad(2000)), (202, prose(60)), (203, salad(30)), (204, prose(40_000))]
    alone = docs((300, salad(120)), lang="zz-q1").unionByName(docs((301, prose(120)), lang="*")).unionByName(docs((302, prose(120)), lang=None))
    got = {r.doc_id: r for r in quality.judge(docs(*rows).unionByName(alone)).collect()}
    assert all(got[i].kept for i in [*range(80), 202, 204, 301, 302])
    # no common word at all: rejected by words alone; a language of one document is no measure of itself
    assert not any(got[i].kept or got[i].base_failed or got[i].char_distance > quality.CHAR_DISTANCE for i in (200, 201, 300))
    assert got[203].kept  # too short to be compared


def test_quality_of_nothing_and_of_null_languages(docs):
    assert quality.judge(docs().limit(0)).count() == 0
    assert quality.judge(docs((1, "a b c"), (1, "a b c"), lang=None)).count() == 2


# -- licences -----------------------------------------------------------------

def test_licences_are_found_and_inherited(spark):
    filler = "some words of a quite ordinary kind stand in this line and go on\n"
    rows = [(1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/c/x", filler * 3), (3, "a/b/y", "Licensed under CC BY-NC 4.0.\n" + filler * 20),
            (4, "q/z", filler), (5, "a/b/LICENSE", "This work is licensed under the GNU General Public License, version 3."),
            (6, None, None), (7, "a/w", "the license of the version is under the house and the general public " * 3)]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert [got[i].license for i in range(1, 8)] == ["MIT", "GPL-3.0", "CC-BY-NC-4.0", None, "GPL-3.0", None, "MIT"]
    assert got[2].license_dir == "a/b" and got[7].license_dir == "a" and got[3].license_dir is None
    assert got[1].is_license_file and not got[3].is_license_file
    empty = spark.createDataFrame([], "doc_id long, path string, text string")
    assert license_scan.scan(empty).count() == 0


def test_full_texts_make_licence_files_at_any_depth(spark):
    full = {n: (license_scan.FULL_TEXTS / f"{n}.txt").read_text() for n in ("MIT", "Apache-2.0", "GPL-2.0", "LGPL-3.0")}
    deep = "/".join(f"d{k}" for k in range(80))
    filler = "some words of a quite ordinary kind stand in this line and go on\n"
    rows = [(1, "m/LICENSE", full["MIT"].replace("<year>", "2021").replace("<copyright holders>", "Foo")), (2, "m/src/x.py", filler),
            (3, "p/COPYING", full["GPL-2.0"]), (4, "p/y.c", filler), (5, "l/COPYING.LESSER", full["LGPL-3.0"]), (6, "l/z", filler),
            (7, f"{deep}/LICENSE", full["Apache-2.0"]), (8, f"{deep}/e/f/w", filler), (9, "n/a", full["MIT"][:600] + filler * 40), (10, "n/b", filler)]
    rows += [(20 + i, f"o/{i}", filler * 9) for i in range(40)]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert [got[i].license for i in range(1, 9)] == ["MIT"] * 2 + ["GPL-2.0"] * 2 + ["LGPL-3.0"] * 2 + ["Apache-2.0"] * 2
    assert all(got[i].is_license_file for i in (1, 3, 5, 7)) and sum(r.is_license_file for r in got.values()) == 4
    assert got[8].license_dir == deep and got[10].license is None


def test_headers_are_found_at_any_size_of_the_table(spark):
    lines = ["Example notebook. Licensed under the Apache License, Version 2.0.", "Copyright (c) 2021 Foo. Released under the MIT License.",
             "xq1 xq2 xq3 xq4 xq5 xq6 xq7 xq8 xq9 Licensed under CC BY-NC 4.0. xr1 xr2 xr3 xr4 xr5 xr6 xr7"]
    for n in (30, 30_000):
        rows = [(i, f"a/{i}", t) for i, t in enumerate(lines)]
        more = spark.range(100, 100 + n).selectExpr("id as doc_id", "concat('b/', id) as path", """case when id % 3 = 0 then
            'the house under the version of copyright' else 'a river in the garden' end as text""")
        files = spark.createDataFrame(rows, "doc_id long, path string, text string").union(more)
        got = {r.doc_id: r for r in license_scan.scan(files).filter("doc_id < 100 or header_license is not null").collect()}
        assert {i: r.header_license for i, r in got.items()} == {0: "Apache-2.0", 1: "MIT", 2: "CC-BY-NC-4.0"}
        assert got[0].header_score > 0.9 and got[1].header_score > 0.9 and not got[2].is_license_file


# -- URLs ---------------------------------------------------------------------

def test_aliases_share_decisions(spark):
    link = '<html><head><link rel="canonical" href="{}"></head></html>'
    rows = [(1, "http://a.example.com/de/1", None), (2, "http://b.test/x", link.format("http://a.example.com/de/1?utm_source=q")),
            (3, "http://c.test/y", '<meta http-equiv="refresh" content="0; url=http://b.test/x">'), (4, "HTTP://C.test/y.html#top", None),
            (5, "http://d.test/z", link.format("http://e.org/")), (6, "http://d.test/z/", link.format("http://a.example.com/de/1")),
            (7, None, None), (8, "no scheme", "x"), (9, "https://EXAMPLE.org/en/12?x#y", None), (10, "https://m.example.org/en/2", None),
            (11, "http://notexample.org/es/", None), (12, "http://x.example.org/es/q", None), (13, "http://z.com", None), (1, "http://a.example.com/de/1", None)]
    got = defaultdict(list)
    for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
        got[r.page_id].append((r.host, r.path, r.rule, r.verdict))
    assert got[1] == [("a.example.com", "/de/1", "com/de/", "block")] * 2
    # 2, 3, 4 lead to the blocked page, but 5 and 6 (one form) tie it to one that a rule allows: allow takes precedence
    assert {got[i][0][3] for i in (2, 3, 4, 5, 6)} == {"allow"}
    assert got[4][0][:2] == ("c.test", "/y.html")
    assert got[7] == [("", "", None, "allow")] and got[8] == [("", "", None, "allow")]
    assert got[9][0] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got[10][0][2:] == ("org/", "allow") and got[11][0][2:] == ("org/", "allow")
    assert got[12][0][2:] == ("example.org/es/", "block") and got[13][0][1:3] == ("", None)
    untied = [r for r in rows if r[0] != 5]
    got = {r.page_id: r.verdict for r in url_filter.judge(spark.createDataFrame(untied, "page_id long, url string, html string")).collect()}
    assert got[2] == got[3] == got[6] == "block" and got[1] == "block"
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_every_link_of_a_page_is_followed(spark):
    page = "HTTPS://Site.test/a/b/page.html?old=1#top"
    targets = {"index2.html": "site.test/a/b/index2", "../new/": "site.test/a/new", "?id=2&amp;k=3": "site.test/a/b/page?id=2&k=3",
               "/r/./x/../y": "site.test/r/y", "//o.test/z": "o.test/z", "http://p.test/q?u=a&#38;v=b": "p.test/q?u=a&v=b",
               "../../../up": "site.test/up", "go?to=http://x.test/": "site.test/a/b/go?to=http://x.test/", "mailto:a@b.test": None,
               "#part": "site.test/a/b/page?old=1", "..": "site.test/a"}
    html = ["".join(f'<link rel="canonical" href="{t}">' for t in targets),
            """<meta http-equiv="refresh" content="0; url='http://q.test/1'"><META content='1;URL="sub/2"' http-equiv=refresh>"""]
    rows = [(1, page, html[0]), (2, "http://bare.test", html[1]), (3, "no scheme", html[1])]
    got = sorted(map(tuple, url_filter.page_links(spark.createDataFrame(rows, "page_id long, url string, html string")).select("a", "b").collect()))
    assert got == sorted([("site.test/a/b/page?old=1", t) for t in targets.values() if t] + [
        ("bare.test", "q.test/1"), ("bare.test", "bare.test/sub/2")])
    blocked = [(1, "http://w.test/d/s.html", '<link rel=canonical href="http://n.test/"><link href="../e" rel="canonical">'),
               (2, "http://w.test/e", """<meta http-equiv=refresh content="0; url='http://x.com/de/1'">"""), (3, "http://x.com/de/1", None)]
    judged = url_filter.judge(spark.createDataFrame(blocked, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.verdict for r in judged} == {1: "block", 2: "block", 3: "block"}


def judged_by_force(rows, rules=url_filter.RULES):
    """page_id -> (host, path, rule, verdict): rules by trying all, aliases by merging sets until nothing changes."""
    def parts(url):
        rest = url.partition("://")[2] if "://" in (url or "") else ""
        cut = re.search(r"[/?#]|$", rest).start()
        host, more = rest[:cut].translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)), rest[cut:]
        path = re.split(r"[?#]", more, maxsplit=1)[0]
        asked = re.match(r"[^?#]*\?([^#]*)", more)
        return host, path, asked[1] if asked else ""

    def form(url):
        host, path, asked = parts(url)
        asked = "&".join(p for p in asked.split("&") if p and not re.fullmatch(r"(utm_[^=&]*|ref|fbclid|gclid)(=.*)?", p))
        host2 = re.sub(r"^(www|m|amp)\.(?=[^.]+\.)", "", host)
        return host and host2 + re.sub(r"(/index)?(\.html?)?/*$", "", path) + ("?" + asked if asked else "")

    def rule(url):
        host, path, _ = parts(url)
        fit = [(len(r), v == "allow", r, v) for r, v in rules for h, _, p in [r.partition("/")]
               if host and ("." + host).endswith("." + h) and path.startswith("/" + p)]
        return max(fit)[2:] if fit else (None, None)

    groups, said = [], defaultdict(set)
    for _, url, html in rows:
        targets = re.findall(r'href="([^"]+)"', html or "")
        for u in [url, *targets]:
            if form(u):
                said[form(u)].add(rule(u)[1])
        groups.append({f for f in [form(url), *map(form, targets)] if f} if form(url) else set())
    merged = True
    while merged:
        merged = False
        for a in range(len(groups)):
            for b in range(a):
                if groups[a] & groups[b]:
                    groups[b] |= groups[a]
                    groups[a], merged = set(), True
    out = {}
    for i, url, _ in rows:
        members = next((g for g in groups if form(url) and form(url) in g), set())
        verdicts = set().union(*[said[f] for f in members]) if members else set()
        method = "allow" if "allow" in verdicts or "block" not in verdicts else "block"
        out[i] = (*parts(url)[:2], rule(url)[0], rule(url)[1] or method)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_url_verdicts_match_brute_force(spark, seed):
    rng = random.Random(seed)
    hosts = ["a.com", "www.a.com", "B.org", "x.example.org", "n.test", "m.n.test", "deep.er.and.deep.er.example.org", "t.test", "u.test"]
    paths = ["", "/", "/de/1", "/fr/1.html", "/es/q", "/en/12", "/p/index.html", "/p", "/q?utm_a=1&k=2", "/q?k=2#z", "/z/"]

    def url():
        return rng.choice(["http", "https"]) + "://" + rng.choice(hosts) + rng.choice(paths)

    link = '<link rel="canonical" href="{}">'
    rows = [(i, url(), "".join(link.format(url()) for _ in range(rng.choice([0, 0, 1, 2])))) for i in range(60)]
    rows += [(100, None, link.format(url())), (101, "no scheme", link.format(url())), (102, "http://", None),
             (103, "http://" + "l." * 3000 + "example.org/es/", None), (104, rows[0][1], None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, rule string, verdict int").repartition(4)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df).collect()}
    assert got == judged_by_force(rows)


# -- toxicity -----------------------------------------------------------------

def test_toxic_texts_are_told_apart(spark, docs):
    rng = random.Random(9)
    calm = [f"{a}{b}" for a in ("house", "river", "tree", "cloud", "stone") for b in ("", "s", "like", "ward")]
    rude = ["idiot", "moron", "scumbag", "worthless"]

    def text(toxic):
        words = [rng.choice(calm) for _ in range(rng.randint(20, 150))]
        for _ in range(rng.randint(2, 6) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(rude))
        return " ".join(words)

    truth = {i: i % 4 == 0 for i in range(400)}
    rows = [(i, text(t)) for i, t in truth.items()] + [(900, None), (901, "")]
    labels = spark.createDataFrame([(i, int(t)) for i, t in truth.items() if i < 250] + [(0, 0), (3, None), (None, 1), (9999, 1)],
                                   "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.judge(docs(*rows), labels).collect()}
    held = [i for i in truth if i >= 250]
    assert sum(got[i].rejected == truth[i] for i in held) / len(held) > 0.97
    assert not got[900].rejected and not got[901].rejected
    df = docs(*rows)
    kept = toxicity.keep(df, labels)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.rejected}
    none = toxicity.judge(docs((1, "a"), (1, "a")), labels.limit(0)).collect()
    assert [(r.p_toxic, r.rejected) for r in none] == [(0.0, False)] * 2
    assert toxicity.judge(docs().limit(0), labels).count() == 0


def test_verdicts_do_not_depend_on_the_sample_cap(spark, docs):
    rng = random.Random(10)
    fill = [f"{a}{b}" for a in ("moss", "fern", "reed") for b in ("", "y", "bed")]
    truth = {i: i % 9 == 0 for i in range(1800)}
    rows = [(i, " ".join(rng.choice(fill) for _ in range(12)) + (" stupid" if rng.random() < (0.8 if t else 0.3) else "")
             + (" idiot" if t and rng.random() < 0.5 else "")) for i, t in truth.items()]
    df = docs(*rows).cache()
    labels = spark.createDataFrame([(i, int(t)) for i, t in truth.items()], "doc_id long, toxic int")
    whole, capped = (toxicity.train(df, labels, sample=n) for n in (1600, 150))
    tried = docs(*[(i, t) for i, t in enumerate(["moss fern reedy stupid", "moss fern reedy", "moss stupid idiot"])]).coalesce(1)
    odds = [np.array([[r.p_toxic for r in toxicity.map_texts(
        tried.select("doc_id", "text"), toxicity._score(c, False),
        "doc_id long, p_toxic double, p_repeated double, p_dense double, p_verdict double, rejected boolean").orderBy("doc_id").collect()]]) for c in (whole, capped)]
    assert np.abs(odds[0] - odds[1]).max() < 0.2
    assert [list(p[0] >= 0.5) for p in odds] == [[False, False, True]] * 2
    assert all(_plain_scores(c, "moss stupid idiot")[1] and not _plain_scores(c, "moss fern reedy")[1] for c in (whole, capped))


def _plain_scores(chain, text):
    """(probabilities, rejected) by looking up each word and word beginning, link after link."""
    def number(part, prefix):
        data = np.frombuffer(part, np.uint8)
        h = int(toxicity.word_hashes(data, np.array([0]), np.array([len(part)]), toxicity._CODES)[0])
        return h ^ int(toxicity._OF_PREFIX) if prefix else h

    words = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    here = {number(w, False) for w in words} | {number(w[:4], True) for w in words if len(w) > 4}
    odds = []
    for w in chain.weights:
        n = len(chain.features)
        z = w[n] + sum(w[i] for i, f in enumerate(chain.features.tolist()) if f in here) + sum(a * b for a, b in zip(odds, w[n + 1:]))
        odds.append(max(-30.0, min(30.0, z)))
    return [round(1 / (1 + np.exp(-o)), 6) for o in odds], odds[-1] >= chain.least


def test_scores_match_brute_force_through_the_chain(spark, docs):
    rng = random.Random(11)
    fill = ["moss", "fern", "Reedbed", "münze", "a", "bb"]
    truth = {i: i % 5 == 0 for i in range(600)}

    def text(t):
        return " ".join(rng.choice(fill) for _ in range(rng.randint(3, 30))) + "".join(
            f" {rng.choice(['Scoundrel', 'scoundrels', 'villain', 'cad'])}" for _ in range(rng.randint(1, 4) if t and rng.random() < 0.9 else 0))

    rows = [(i, text(t)) for i, t in truth.items()] + [(900, None), (901, ""), (902, "x" * 100_000 + " villain villain villain cad " * 2000)]
    labels = spark.createDataFrame([(i, int(t)) for i, t in truth.items() if i % 2], "doc_id long, toxic int")
    df = docs(*rows)
    chain = toxicity.train(df, labels)
    assert any(abs(x) > 0 for x in chain.weights[-1][len(chain.features) + 1:])  # earlier links reach the verdict
    for r in toxicity.judge(df, labels).collect():
        p, rejected = _plain_scores(chain, dict(rows)[r.doc_id])
        assert [r.p_toxic, r.p_repeated, r.p_dense, r.p_verdict] == pytest.approx(p, abs=2e-6) and r.rejected == rejected


@pytest.mark.parametrize("seed", range(4))
def test_best_cut_is_the_best_of_all(seed):
    rng = np.random.default_rng(seed)
    odds, y, s = np.round(rng.normal(size=60), 1), (rng.random(60) < 0.3).astype(float), rng.integers(1, 4, 60).astype(float)

    def f1(cut):
        hit = odds >= cut
        return 2 * (s * y * hit).sum() / ((s * hit).sum() + (s * y).sum())

    assert f1(toxicity.best_cut(odds, y, s)) == max(f1(c) for c in odds)


def test_later_models_see_out_of_fold_log_odds():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (300, 6)).astype(float)
    y = (x[:, 0] + x[:, 1] > 1).astype(float)
    chain = toxicity.fit_chain(x, [y, y * x[:, 2]], np.arange(6, dtype=np.uint64), np.arange(300) % toxicity.FOLDS)
    odds = chain.log_odds(x)
    assert ((odds[:, 0] > 0) == (y > 0)).mean() > 0.95 and ((odds[:, 1] > 0) == (y * x[:, 2] > 0)).mean() > 0.95
    assert len(chain.weights[1]) == 8 and chain.weights[1][-1] > 0
