"""Correlations from Gram sums against Spark's own, and against numpy on odd values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import gram
from tabloom.operators.profiling import correlation_pairs


def frame(spark, columns):
    names = [f"v{i}" for i in range(len(columns))]
    rows = [tuple(None if x is None else float(x) for x in r) for r in zip(*columns)]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)


def test_pairs_equal_spark_with_missing_values(spark, monkeypatch):
    monkeypatch.setattr(gram, "BLOCK_COLS", 3)
    monkeypatch.setattr(gram, "BATCH_CELLS", 64)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(7, 300))
    base[1] = base[0] * 3 + base[1]
    base[2] += 1e9  # a large mean must not cost the digits
    cols = [[None if rng.random() < 0.2 and i % 2 else x for x in c] for i, c in enumerate(base)]
    df = frame(spark, cols)
    got = {(r["a"], r["b"]): r["r"] for r in correlation_pairs(df).collect()}
    want = df.agg(*[F.corr(a, b).alias(f"{a} {b}") for a, b in got]).first().asDict()
    assert len(got) == 21 and all(r == pytest.approx(want[f"{a} {b}"], abs=1e-7) for (a, b), r in got.items())


def test_odd_columns(spark):
    nan, inf = float("nan"), float("inf")
    df = frame(spark, [[1, 2, 3, 4], [5, 5, 5, 5], [None] * 4, [nan, 1, 2, 4], [inf, 1, 2, 3], [7, 7, None, 9], [1, None, 5, None]])
    got = {(r["a"], r["b"]): r["r"] for r in correlation_pairs(df).collect()}
    assert {c for pair in got for c in pair} == {"v0", "v3", "v4", "v5", "v6"}  # constant and empty columns have none
    assert np.isnan(got["v0", "v3"]) and np.isnan(got["v0", "v4"])
    assert got["v0", "v5"] == pytest.approx(np.corrcoef([1, 2, 4], [7, 7, 9])[0, 1])
    assert got["v0", "v6"] == pytest.approx(1.0) and got["v5", "v6"] is None  # one common row


def test_one_scan_for_many_columns(spark):
    x = F.col("id").cast("double")
    wide = spark.range(400).select(*[F.sin(x * (i + 1)).alias(f"c{i}") for i in range(300)])
    got = correlation_pairs(wide)
    assert got.count() == 300 * 299 // 2
    some = wide.agg(F.corr("c3", "c250")).first()[0]
    assert got.where("a = 'c3' and b = 'c250'").first()["r"] == pytest.approx(some)


def test_no_rows_and_no_columns(spark):
    df = spark.createDataFrame([], "a double, b int, c string")
    assert correlation_pairs(df).count() == 0 and correlation_pairs(df.select("a")).count() == 0
