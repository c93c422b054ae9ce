"""Line, near and exact duplicates against brute force on small texts."""

import hashlib
import random
import re
import string

import pytest

from tabloom.llm import exact_dedup, line_dedup, ngram_join
from tabloom.llm.components import connected

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def spelled(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta"]) for _ in range(n))


# -- line dedup ---------------------------------------------------------------

def removed_by_force(rows, least):
    """Lines inside runs of ``least`` words that start at an earlier place as well."""
    lines = [(d, i, line) for d, t in rows if t is not None for i, line in enumerate(t.split("\n"))]
    doc = {d: t.split("\n") for d, t in rows if t is not None}
    gone = set()
    for a, (d, i, _) in enumerate(lines):
        for e, j, _ in lines[:a]:
            k = 0
            while i + k < len(doc[d]) and j + k < len(doc[e]) and doc[d][i + k] == doc[e][j + k]:
                k += 1
            if k and sum(len(WORD.findall(x)) for x in doc[d][i:i + k]) >= least:
                gone |= {(d, i + m) for m in range(k)}
    return gone


@pytest.mark.parametrize("seed", [1])
def test_line_dedup_matches_brute_force(docs, seed):
    rng = random.Random(seed)
    stock = [spelled(rng, rng.randint(0, 6)) for _ in range(6)]
    rows = [(i, "\n".join(rng.choice(stock) for _ in range(rng.randint(1, 9)))) for i in range(25)]
    rows += [(30, None), (31, ""), (32, "one two\n" * 30)]
    gone = removed_by_force(rows, 10)
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs(*rows)).collect()}
    for i, t in rows:
        want = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone)
        assert got[i].text == want, i
        assert got[i].lines_removed == sum(d == i for d, _ in gone)


def test_line_dedup_of_nothing_and_of_repeated_rows(docs):
    assert line_dedup.dedup_lines(docs().limit(0)).count() == 0
    text = spelled(random.Random(4), 60)
    got = sorted((r.lines_removed, r.text) for r in line_dedup.dedup_lines(docs((1, text), (1, text), (None, text))).collect())
    assert got == [(0, text), (1, ""), (1, "")]


def test_line_clean_keeps_columns_and_drops_what_is_empty(docs):
    text = "\n".join(spelled(random.Random(s), 40) for s in range(3))
    df = docs((1, text), (2, text), (3, text + "\nown line here"), (4, "short"))
    out = {r.doc_id: r for r in line_dedup.clean(df).collect()}
    assert sorted(out) == [1, 3, 4] and out[3].text == "own line here" and out[3].n_chars == len("own line here")
    assert line_dedup.clean(df).columns == df.columns


# -- near duplicates ----------------------------------------------------------

def components_by_force(rows):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("seed,heavy", [(2, 2)])
def test_near_duplicates_match_brute_force(docs, monkeypatch, seed, heavy):
    monkeypatch.setattr(ngram_join, "HEAVY", heavy)
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    passage = [word() for _ in range(30)]
    rows, i = [], 0
    for _ in range(12):  # chains of edits, so that components reach beyond a first set's links
        text = [word() for _ in range(rng.randint(20, 120))]
        if rng.random() < 0.5:
            text += passage
        for _ in range(rng.randint(1, 8)):
            rows.append((i, " ".join(text)))
            i += 1
            text = list(text)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = word()
            if rng.random() < 0.3:
                text = text[: max(5, int(len(text) * 0.9))]
    rows += [(900, None), (901, " \n"), (902, "One two"), (903, "one  TWO"), (904, "one two three"), (905, "a"), (906, "É é"),
             (907, "é é")]
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs(*rows)).collect()}
    assert got == components_by_force(rows)


def test_near_duplicates_send_bitmaps_not_lists_to_tasks(docs, spark, monkeypatch):
    """What reaches the driver doesn't grow with common shingles or with the rows that meet."""
    monkeypatch.setattr(ngram_join, "HEAVY", 2)
    monkeypatch.setattr(ngram_join, "SENT_ROWS", 0, raising=False)
    sent, plain = [], ngram_join.map_texts

    def seen(df, run, shape):
        sent.append(sum(c.cell_contents.nbytes for c in run.__closure__ or () if hasattr(c.cell_contents, "nbytes")))
        return plain(df, run, shape)

    monkeypatch.setattr(ngram_join, "map_texts", seen)
    monkeypatch.setattr(ngram_join, "MAP_BITS", 16, raising=False)
    rng = random.Random(3)
    base = [[f"{rng.randrange(1 << 20):x}" for _ in range(800)] for _ in range(25)]
    rows = [(3 * i + c, " ".join(t[: 800 - 100 * c])) for i, t in enumerate(base) for c in range(3)]
    rows += [(-4, rows[0][1]), (1 << 40, rows[3][1]), (900, None)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs(*rows)).collect()}
    assert got == components_by_force(rows)
    assert 0 < max(sent) <= 2 * (1 << 16) // 8  # before: 8 bytes for each of some 15,000 common shingles


def test_near_duplicates_of_nothing_and_of_repeated_rows(docs):
    assert ngram_join.near_duplicates(docs().limit(0)).count() == 0
    t = "one two three four five six seven"
    got = sorted(tuple(r) for r in ngram_join.near_duplicates(docs((3, t), (3, t), (5, t), (4, "other"))).collect())
    assert got == [(3, 3, 3), (3, 3, 3), (4, 1, 4), (5, 3, 3)]


def test_components_of_a_long_chain(spark):
    order = list(range(40))
    random.Random(5).shuffle(order)
    edges = spark.createDataFrame([(a, b) for a, b in zip(order, order[1:])] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in connected(edges).collect()}
    assert got == {**{i: 0 for i in range(40)}, 100: 100, 101: 100}


# -- exact duplicates ---------------------------------------------------------

def groups_by_force(rows):
    blank = str.maketrans("", "", " \t\n\x0b\x0c\r")
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(blank), []).append((-len(t or ""), i))
    return sorted((i, min(g)[1], len(g), i == min(g)[1], hashlib.sha256(b.encode()).hexdigest())
                  for b, g in groups.items() for _, i in g)


@pytest.mark.parametrize("table_bytes", [300])
def test_exact_dedup_matches_brute_force(docs, table_bytes):
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice(["a", "b ", "\n", "é", "\xa0"]) for _ in range(rng.randint(0, 4)))) for i in range(120)]
    rows += [(200, None), (201, "x" * 50_000), (202, "x" * 50_000 + " "), (203, " \t")]
    got = sorted(tuple(r) for r in exact_dedup.exact_dedup(docs(*rows), target_bytes=200, table_bytes=table_bytes).collect())
    assert got == groups_by_force(rows)


def test_exact_dedup_of_nothing_and_of_repeated_rows(docs):
    assert exact_dedup.exact_dedup(docs().limit(0)).count() == 0
    got = exact_dedup.exact_dedup(docs((1, "a b"), (1, "a b"), (None, "ab"), (2, "z"))).collect()
    assert sum(r.kept for r in got if r.group_size == 3) == 1 and {r.keep_id for r in got} == {1, 2}
    assert sorted(r.group_size for r in got) == [1, 3, 3, 3]


def test_content_table_compares_contents_not_hashes():
    t = exact_dedup.ContentTable(1 << 20)
    assert t.add(5, b"one", 1, 3, 1) and t.add(5, b"two", 1, 3, 2) and t.add(5, b"one", 1, 9, 3)
    assert t.copies == [2, 1] and t.best == [(9, -3), (3, -2)]


def test_words_of_regular_structure_are_told_apart(docs):
    """Thue-Morse words and their letter swaps collide under sums of powers modulo 2^64."""
    def word(order, swap):
        return "".join("ab"[bin(i).count("1") % 2 ^ swap] for i in range(1 << order))

    rows = [(order * 2 + swap, word(order, swap)) for order in (7, 10, 11, 12) for swap in (0, 1)]
    found = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs(*rows, (100, word(10, 0).upper()))).collect()}
    assert found == {**{i: i for i, _ in rows}, 100: 20}
