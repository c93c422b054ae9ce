"""Keyed state against the batch result, over replays, late and repeated files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from tests.helpers import rows

from tabloom.streaming import keyed
from tabloom.streaming.incremental import stream_files

SCHEMA = "claim string, plan string, ts timestamp, value double"


def at(day):
    return None if day is None else dt.datetime(2024, 1, day)


def arrive(spark, folder, batch):
    spark.createDataFrame([(c, p, at(d), v) for c, p, d, v in batch], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def advance(spark, folder, out, mark, score=lambda b: b):
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = stream_files(spark, folder, schema, files_per_batch=1)
    query = keyed.run_keyed(stream, score, out, mark, ["claim", "plan"], ["ts"])
    query.awaitTermination()
    return query


def test_late_and_repeated_files_equal_the_batch_result(spark, tmp_path):
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    arrive(spark, folder, [("a", "P1", 5, 1.0), ("a", "P2", 5, 2.0), ("b", "P1", 3, 3.0), (None, "P1", None, 4.0)])
    advance(spark, folder, out, mark)
    arrive(spark, folder, [("a", "P1", 4, 9.0), ("b", "P1", 6, 5.0)])  # late; newer
    arrive(spark, folder, [("a", "P2", 5, 2.5), ("c", "P1", 1, 7.0), ("c", "P1", 2, 8.0), (None, "P1", 1, 4.5)])  # a tie: what arrives last stays
    advance(spark, folder, out, mark)
    want = [(None, "P1", at(1), 4.5), ("a", "P1", at(5), 1.0), ("a", "P2", at(5), 2.5), ("b", "P1", at(6), 5.0), ("c", "P1", at(2), 8.0)]
    assert rows(keyed.current(spark, out, ["claim", "plan"]), "claim", "plan") == want
    # written: 4 rows, then one each for what was accepted; nothing again
    assert spark.read.parquet(out).count() == 4 + 1 + 3
    advance(spark, folder, out, mark)  # nothing new
    assert spark.read.parquet(out).count() == 8


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.createDataFrame([("hot", "P", at(1 + i % 28), float(i)) for i in range(5000)] + [("x", "P", None, 1.0)], SCHEMA)
    marked = df.withColumn("_order0", F.unix_micros("ts")).coalesce(1)
    left = keyed.latest_of_batch(marked, ["claim", "plan"], ["_order0"]).collect()
    assert sorted((r["claim"], r["value"]) for r in left) == [("hot", 4983.0), ("x", 1.0)]


@pytest.mark.parametrize("a,b,after", [([1], [1], True), ([None], [None], True), ([None], [0], False), ([2, None], [1, 5], True), (["b"], ["c"], False)])
def test_order(a, b, after):
    assert keyed._comes_after(a, b) is after


def test_versions_are_kept_without_python_for_each_key(spark, tmp_path):
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    # one file: ties go to its last row, NaN and null come first, whatever the other columns hold
    schema = "claim string, plan string, ts double, value double, seen array<string>"
    batch = [("a", "P", 1.0, 9.0, ["x"]), ("a", "P", 1.0, 2.0, None), ("b", "P", float("nan"), 3.0, []), ("b", "P", None, 1.0, ["z"]),
             ("c", None, 2.0, 5.0, ["y"]), ("c", None, float("nan"), 6.0, ["y"])]
    spark.createDataFrame(batch, schema).coalesce(1).write.parquet(folder)
    stream = stream_files(spark, folder, spark.createDataFrame([], schema).schema, files_per_batch=1)
    plan = keyed.keyed_versions(stream, ["claim", "plan"], ["ts"])._jdf.queryExecution().analyzed().toString()
    assert "FlatMapGroupsInPandasWithState" not in plan
    keyed.run_keyed(stream, lambda b: b, out, mark, ["claim", "plan"], ["ts"]).awaitTermination()
    got = rows(keyed.current(spark, out, ["claim", "plan"]).select("claim", "plan", "value", "seen"), "claim")
    assert got == [("a", "P", 2.0, None), ("b", "P", 1.0, ["z"]), ("c", None, 5.0, ["y"])]
