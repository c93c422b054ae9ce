import difflib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tests.helpers import rows

from tabloom.operators import similarity as N


def brute(ids, vecs, k, metric, exclude):
    if metric == "cosine":
        u = vecs / np.maximum(np.linalg.norm(vecs, axis=1, keepdims=True), 1e-300)
        s = u @ u.T
    else:
        s = -np.sqrt(np.maximum(((vecs[:, None] - vecs[None]) ** 2).sum(-1), 0))
    s = np.round(s, 6)
    out = {}
    for i, q in enumerate(ids):
        order = sorted((j for j in range(len(ids)) if not (exclude and j == i)), key=lambda j: (-s[i, j], -ids[j]))
        out[int(q)] = [int(ids[j]) for j in order[:k]]
    return out


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("exclude", [True, False])
def test_nearest_equals_brute_force_with_hot_copies(spark, metric, exclude):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8)) * 4
    vecs = centres[rng.integers(0, 6, 240)] + rng.normal(size=(240, 8)) * 0.3
    vecs[:80] = vecs[0]  # a third of the rows are copies of one vector
    ids = np.arange(240)
    df = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vecs, strict=True)], "id long, vec array<double>")
    got: dict[int, list] = {}
    for r in N.nearest(df, df, 4, metric, exclude_same_id=exclude, pivots=8, block_rows=16).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["base_id"])
    assert got == brute(ids, vecs, 4, metric, exclude)


def test_pruning_skips_cells(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 16)) * 50
    vecs = centres[np.arange(400) % 8] + rng.normal(size=(400, 16)) * 0.1
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "id long, vec array<double>")
    pivots = centres
    assigned = N._assign(df, pivots)
    routed = N._route(df, pivots, N._cell_stats(assigned, pivots, 3), 3, None, ["id"])
    assert routed.count() == 400  # each query visits one cell of eight


def test_close_names_equal_difflib(spark):
    rng = np.random.default_rng(5)
    letters = list("abcde")
    pool = sorted({"".join(rng.choice(letters, rng.integers(2, 9))) for _ in range(120)})
    asked = sorted({"".join(rng.choice(letters, rng.integers(2, 9))) for _ in range(60)})
    q = spark.createDataFrame([(a,) for a in asked], "n string")
    b = spark.createDataFrame([(a,) for a in pool], "n string")
    got: dict[str, list] = {}
    for r in N.close_names(q, b, block_rows=8).orderBy("name", "rank").collect():
        got.setdefault(r["name"], []).append(r["match"])
    want = {a: m for a in asked if (m := difflib.get_close_matches(a, pool))}
    assert got == want


def test_similar_names_fall_back(spark):
    q = spark.createDataFrame([("Robert",), ("Jonathon",), ("Zzyzx",), (None,)], "n string")
    b = spark.createDataFrame([("Rupert",), ("Nathon",)], "n string")
    got = rows(N.similar_names(q, b), "name", "match")
    assert got == [("Jonathon", "Nathon", "close"), ("Robert", "Rupert", "phonetic"), ("Zzyzx", "Zzyz", "prefix")]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("t", [1, 2, 3])
def test_edit_matches_equal_all_pairs(spark, t, monkeypatch):
    from tabloom.operators import joins

    monkeypatch.setattr(joins.is_small, "__defaults__", (10, 100))  # the salted way
    rng = np.random.default_rng(t)
    letters = list("abcé")
    pool = sorted({"".join(rng.choice(letters, rng.integers(1, 11))) for _ in range(150)} | {"a", "ab", "🙂b", "a" * 300})
    asked = sorted({"".join(rng.choice(letters, rng.integers(1, 11))) for _ in range(80)} | {"", "b", "🙂", "a" * 299})
    q = spark.createDataFrame([(a, 1) for a in asked] + [(None, 1), ("b", 2)], "n string, match int")
    b = spark.createDataFrame([(a, 1) for a in pool] + [(None, 1), ("ab", 3)], "n string, len int")
    got = sorted(tuple(r) for r in N.edit_matches(q, b, t).collect())
    assert got == sorted((x, y, edits(x, y)) for x in asked if x for y in pool if abs(len(x) - len(y)) <= t and edits(x, y) <= t)
    assert N.edit_matches(q.limit(0), b, t).count() == 0


def test_edit_join_compares_few_pairs(spark):
    """Candidates come from the index: a plan without any Python, and without a cross product."""
    words = spark.range(3000).select(F.substring(F.md5(F.col("id").cast("string")), 1, 12).alias("n"))
    out = N.edit_matches(words, words, 1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert out.count() == 3000


def test_a_large_pattern_set_gives_the_same_similarity(spark, monkeypatch):
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=5)]) for i in range(60)] + [(60, [0.0] * 5), (61, None)], "k long, v array<double>")
    patterns = spark.createDataFrame([([float(x) for x in rng.normal(size=5)],) for _ in range(12)] + [(None,)], "p array<double>")
    small = {r["k"]: r["s"] for r in N.max_pattern_similarity(df, "v", patterns, "p", "s").collect()}
    monkeypatch.setattr(N, "PATTERN_ROWS", 3)
    large = {r["k"]: r["s"] for r in N.max_pattern_similarity(df, "v", patterns, "p", "s").collect()}
    assert large.keys() == small.keys() and large[60] is None and large[61] is None
    assert all(large[k] == pytest.approx(small[k], abs=1e-6) for k in range(60))


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("scale", [1.0, 1e-20, 1e4])
def test_a_block_finds_what_sorting_all_scores_finds(monkeypatch, metric, scale):
    monkeypatch.setattr(N, "FIRST_ROWS", 8)
    monkeypatch.setattr(N, "BASE_ROWS", 32)
    rng = np.random.default_rng(11)
    held = rng.normal(size=(300, 12))
    held[50:90] = held[50] + rng.normal(size=(40, 12)) * 1e-8  # equal to 6 digits, or nearly
    held[100:110] = 0.0
    asked = np.concatenate([held[40:120], rng.normal(size=(30, 12))])
    if metric == "cosine":
        asked, held = (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300) for v in (asked, held))
    asked, held = asked * scale, held * scale
    ids = rng.permutation(300)
    got = N.best_of_block(pd.DataFrame({"id": np.arange(len(asked)), "vec": list(asked)}), pd.DataFrame({"id": ids, "vec": list(held)}), 7, metric)
    by_id = held[np.argsort(ids)]
    exact = asked @ by_id.T if metric == "cosine" else -np.sqrt(np.square(asked[:, None] - by_id[None]).sum(-1))
    exact = np.round(exact, 6)
    for i, row in enumerate(exact):
        want = sorted(range(300), key=lambda j: (-row[j], -j))[:7]
        assert got[got["rep"] == i]["base_id"].tolist() == want


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_vectors_that_no_bound_excludes_are_copied_for_bundles_not_cells(spark, monkeypatch, metric):
    rng = np.random.default_rng(6)
    vecs = rng.normal(size=(500, 32))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "id long, vec array<double>").persist()
    sent = []
    whole = N._search_blocks
    monkeypatch.setattr(N, "_search_blocks", lambda routed, *rest: (sent.append(routed.count()), whole(routed, *rest))[1])
    got: dict[int, list] = {}
    for r in N.nearest(df, df, 3, metric, exclude_same_id=True, block_rows=16).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["base_id"])
    assert got == brute(np.arange(500), vecs, 3, metric, True)
    assert sent[0] <= 500 * (N.LEAST_BLOCKS + 1)  # before: one copy for each of 32 cells
