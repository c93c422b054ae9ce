"""The hashed vector join: recall against the exact join, and what must hold at any recall."""

import numpy as np
import pandas as pd
import pytest

from tabloom.operators import vector_hash as V
from tabloom.operators.similarity import nearest


def vectors(spark, rows):
    return spark.createDataFrame([(int(i), None if v is None else [float(x) for x in v]) for i, v in rows], "id long, vec array<double>")


def clustered(seed, n, dims=16, centres=40):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    return middle[rng.integers(0, centres, n)] + rng.normal(size=(n, dims)) * 0.35


def share(found, exact):
    rows = V.recall(found, exact).collect()
    return sum(r["n_found"] for r in rows) / sum(r["n_exact"] for r in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_recall_and_exact_scores(spark, seed):
    df = vectors(spark, enumerate(clustered(seed, 2000)))
    exact = nearest(df, df, 5, exclude_same_id=True)
    found = V.hashed_nearest(df, df, 5, exclude_same_id=True, bucket_rows=64)
    assert share(found, exact) >= 0.9
    rows = found.collect()
    assert len({(r["query_id"], r["base_id"]) for r in rows}) == len(rows) and all(r["query_id"] != r["base_id"] for r in rows)
    v = np.array([r["vec"] for r in df.orderBy("id").collect()])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    assert all(abs(r["score"] - v[r["query_id"]] @ v[r["base_id"]]) < 1e-5 for r in rows)


def test_work_does_not_grow_with_the_table(spark):
    """Rows that a query meets: tables x probes x about bucket_rows, whatever the size."""
    met = []
    for n in (1000, 4000):
        v = clustered(3, n, centres=n // 25)
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        planes = V.planes_for(6, V.plane_count(n, 64), v.shape[1])
        cells, sizes = np.unique(V.bucket_codes(v, planes, 1), return_counts=True)
        size = dict(zip(cells.tolist(), sizes.tolist()))
        met.append(np.mean([sum(size.get(c, 0) for c in row.ravel().tolist()) for row in V.bucket_codes(v[:200], planes, 4)]))
    assert met[1] < 1.6 * met[0]


def test_python_holds_a_vector_once_not_once_for_each_bucket(spark, monkeypatch):
    v = clustered(6, 3000)
    df, runs = vectors(spark, enumerate(v)), []
    plain = type(df).mapInPandas
    monkeypatch.setattr(type(df), "mapInPandas", lambda self, run, *rest: runs.append(run) or plain(self, run, *rest))
    planes = V.planes_for(5, 7, v.shape[1])
    got = V._coded(df, planes, 9)
    frames = list(runs[0](iter([pd.DataFrame({"id": np.arange(len(v)), "vec": list(v)})])))
    assert sum(map(len, frames)) == len(v) and max(map(len, frames)) <= 1024  # before: 135,000 rows in one frame
    want = [(i, c) for i, row in enumerate(V.bucket_codes(v, planes, 9).reshape(len(v), -1).tolist()) for c in row]
    assert sorted((r["id"], r["cell"]) for r in got.select("id", "cell").collect()) == sorted(want)
    assert got.where("id = 7").select("vec").distinct().collect() == [(v[7].tolist(),)]


def test_own_bucket_first_and_probes_differ():
    rng = np.random.default_rng(4)
    v = rng.normal(size=(50, 8))
    planes = V.planes_for(3, 7, 8)
    codes = V.bucket_codes(v, planes, 10)
    assert codes.shape == (50, 3, 10) and (codes[:, :, :1] == V.bucket_codes(v, planes, 1)).all()
    assert all(len(set(c)) == 10 for row in codes.tolist() for c in row)
    assert ((codes >> 7) == np.arange(3)[None, :, None]).all()


def test_hot_buckets_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(200)]  # a third are copies of one vector
    rows += [(200 + i, rng.normal(size=3)) for i in range(400)] + [(900, None), (901, [0.0, 0.0, 0.0])]
    df = vectors(spark, rows)
    found = V.hashed_nearest(df, df, 4, exclude_same_id=True, bucket_rows=32, block_rows=16)
    exact = nearest(df, df, 4, exclude_same_id=True)
    assert share(found, exact) >= 0.9
    first = {r["query_id"]: r for r in found.where("rank = 1").collect()}
    assert first[0]["base_id"] == 199 and first[199]["base_id"] == 198 and first[0]["score"] == 1.0 and 900 not in first


def test_empty_sides(spark):
    none, one = vectors(spark, []), vectors(spark, [(1, [1.0, 0.0])])
    assert V.hashed_nearest(one, none, 3).count() == 0 and V.hashed_nearest(none, one, 3).count() == 0
    assert [tuple(r) for r in V.hashed_nearest(one, one, 3).collect()] == [(1, 1, 1.0, 1)]
