"""Importance resampling against a brute-force version on small texts."""

import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter

import pytest

from tabloom.llm import common, importance

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest, buckets):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), Counter(zlib.crc32(r.encode()) % buckets for r in runs)


def by_force(rows, targets, percent=10, least=20, buckets=10_000, longest=1):
    found = [(i, *features(t, longest, buckets)) for i, t in rows]
    source, target = Counter(), Counter()
    for _, _, f in found:
        source += f
    for t in targets:
        target += features(t, longest, buckets)[1]
    s, t = sum(source.values()), sum(target.values())
    gain = [math.floor(1000 * math.log((target[b] + 1) * (s + buckets) / ((source[b] + 1) * (t + buckets)))) for b in range(buckets)]
    out = []
    for i, n, f in found:
        weight = sum(gain[b] * k for b, k in f.items())
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, sum(f.values()), weight, score, n >= least))
    able = sorted((x for x in out if x[4]), key=lambda x: (-x[3], x[0] is not None, x[0] or 0))
    ranks = {id(x): k + 1 for k, x in enumerate(able[:percent * len(able) // 100])}
    return sorted((x[0] is None, x[0] or 0, *x[1:4], ranks.get(id(x)) or 0) for x in out)


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma1", "δέλτα", "x-y", "Éa", "\0z", "A\x7fb", "ÀB"]
    lines = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 9))) for _ in range(25)]
    return [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 12)))) for i in range(n)]


def compared(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_features, r.weight, r.score, r["rank"] or 0) for r in df.collect())


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_matches_brute_force(spark, docs, monkeypatch, longest):
    monkeypatch.setattr(common, "LEAST_HOT", 3)  # so that common lines are dealt over salts
    rows = corpus(longest) + [(100, None), (101, ""), (102, "\n\n"), (None, "alpha " * 30), (103, "beta " * 5000 + "\n" + "gamma1\n" * 4000)]
    targets = ["alpha beta\nalpha δέλτα", None, "", "Éa"]
    goal = spark.createDataFrame([(i, t, 5) for i, t in enumerate(targets)], "item_id long, text string, row_key int")
    got = importance.resample(docs(*rows).repartition(3), goal, buckets=50, longest=longest)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert compared(got) == by_force(rows, targets, buckets=50, longest=longest)


def test_repeated_rows_and_ties_are_drawn_each(spark, docs):
    rows = [(7, "alpha " * 25)] * 20 + [(8, "beta " * 25)] * 20
    goal = spark.createDataFrame([(0, "beta")], "item_id long, text string")
    got = compared(importance.resample(docs(*rows), goal, percent=50))
    assert sorted(r[5] for r in got if r[5]) == list(range(1, 21))
    assert [r[:5] for r in got] == [r[:5] for r in by_force(rows, ["beta"], percent=50)]


def test_empty_tables(spark, docs):
    goal = spark.createDataFrame([], "text string")
    assert importance.resample(docs().limit(0), goal).count() == 0
    got = importance.resample(docs((1, "alpha " * 30)), goal, percent=100).collect()
    assert [(r.n_features, r["rank"]) for r in got] == [(30, 1)] and got[0].weight < 0


def test_drawn_documents_resemble_the_target(spark, docs):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["red", "green", "blue"] if i % 5 else ["one", "two", "three"]) for _ in range(40))) for i in range(200)]
    goal = spark.createDataFrame([("one two three " * 20,)], "text string")
    drawn = [r.doc_id for r in importance.resample(docs(*rows), goal).collect() if r["rank"]]
    assert len(drawn) == 20 and all(i % 5 == 0 for i in drawn)
