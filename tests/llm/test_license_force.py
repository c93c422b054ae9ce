"""The licence scan against a brute-force version: every line, every window, every file, every directory."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from tabloom.llm import license_scan as scan

TERM = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")


def terms(text):
    return TERM.findall((text or "").lower())


def cosine(a, b):
    dot = sum(v * b.get(t, 0.0) for t, v in a.items())
    return round(dot / math.sqrt(sum(v * v for v in a.values())) / math.sqrt(sum(v * v for v in b.values())), 6)


def by_force(rows):
    n = len(rows)
    df = Counter(t for _, _, text in rows for t in set(terms(text)))
    idf = lambda t: math.log((n + 1) / (df[t] + 1)) + 1
    plain = lambda ts: {t: k * idf(t) for t, k in Counter(ts).items()}
    damped = lambda ts: {t: (math.log(k) + 1) * idf(t) for t, k in Counter(ts).items()}
    full = {f.stem: damped(terms(f.read_text(encoding="utf-8"))) for f in scan.FULL_TEXTS.glob("*.txt")}
    met = []
    for doc, path, text in rows:
        best, matched = [], 0
        for i, line in enumerate((text or "").split("\n")):
            found = []
            ts = terms(line)
            for name, template in scan.TEMPLATES:
                own = terms(template)
                spans = [(0, ts)] + [(k + 1, ts[k:k + len(own)]) for k in range(len(ts)) if len(ts) > len(own) and ts[k] in own]
                found += [(-cosine(plain(s), plain(own)), name, start, len(s)) for start, s in spans if s]
            found = [f for f in found if -f[0] >= scan.THRESHOLD]
            if found:
                top = min(found)
                best.append((top[0], i, top[1]))
                matched += top[3]
        whole = damped(terms(text))
        files = sorted((-c, name) for name, vector in full.items() for c in [cosine(whole, vector) if whole else 0.0] if c >= scan.FILE_THRESHOLD)
        header = min(best) if best else None
        is_file = bool(files) or bool(header and matched >= scan.FILE_SHARE * len(terms(text)))
        own = (files[0][1], files[0][0]) if files else (header[2], header[0]) if header else None
        met.append((doc, path or "", header, is_file, own))
    licensed = defaultdict(list)
    for _, path, _, is_file, own in met:
        if is_file:
            licensed[re.sub(r"/?[^/]*$", "", path)].append((own[1], path, own[0]))
    out = {}
    for doc, path, header, is_file, own in met:
        parts = [p for p in [re.sub(r"/?[^/]*$", "", path)]][0]
        levels = parts.split("/") if parts else []
        near = next((d for k in range(len(levels), -1, -1) for d in ["/".join(levels[:k])] if d in licensed), None)
        license_ = own[0] if own else min(licensed[near])[2] if near is not None else None
        out[doc] = (header and header[2], header and -header[0], header and header[1], is_file, license_, near if not own else None)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_scan_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    words = "the code file of a we software open license notice version copyright house tree river 2.0".split()
    fulls = [f.read_text(encoding="utf-8") for f in sorted(scan.FULL_TEXTS.glob("*.txt")) if f.stem in ("MIT", "ISC", "BSD-2-Clause")]

    def line():
        kind = rng.random()
        filler = " ".join(rng.choice(words) for _ in range(rng.randint(0, 8)))
        if kind < 0.25:
            template = rng.choice(scan.TEMPLATES)[1].split()
            cut = template[rng.randint(0, 2): len(template) - rng.randint(0, 2)]
            return f"# {filler} {' '.join(cut).upper() if rng.random() < 0.3 else ' '.join(cut)} {filler if rng.random() < 0.5 else ''}"
        return filler

    folders = ["", "a", "a/b", "a/b/c", "d", "d//e"]
    rows = []
    for i in range(40):
        text = rng.choice(fulls) if rng.random() < 0.1 else "\n".join(line() for _ in range(rng.randint(0, 4)))
        rows.append((i, f"{rng.choice(folders)}/f{i}".lstrip("/"), text))
    rows += [(100, None, None), (101, "a/b/c/d/e/deep", "x"), (102, "d/empty", ""), (103, "a/long", "river " * 20_000 + "Released under the MIT License. " + "tree " * 500)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, path string, text string, license string, terms int").repartition(3)
    got = {r.doc_id: (r.header_license, r.header_score, r.header_line, r.is_license_file, r.license, r.license_dir) for r in scan.scan(df).collect()}
    want = by_force(rows)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][:1] + got[k][2:] == want[k][:1] + want[k][2:] and got[k][1] == pytest.approx(want[k][1], abs=2e-6), (k, got[k], want[k])
