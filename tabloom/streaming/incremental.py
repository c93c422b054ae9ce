"""Incremental scoring and summary over arriving claim files.

Scoring runs inside ``foreachBatch``: a micro-batch writes its own folder beside the
stream's offsets, named by its number, so a replayed one writes the same folder again.
When a run has taken in what has arrived, its batches are merged together into the
key-hash partitions that they touch (the latest in order stays, also when it came
earlier) by dynamic overwrite, so what a run writes doesn't grow with its number of
batches. Batches that a failed run left unmerged are merged by the next one; merging
a batch again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tabloom.operators.ordered import one_per_key
from tabloom.session import scratch_path
from tabloom.sources.writers import replace_slice

ARRIVED, MERGED, BATCH = "arrived", "merged", "_batch"


def stream_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                 files_per_batch: int = 100, glob: str | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path)


def upsert_partitions(batch: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], buckets: int) -> None:
    """Keep-last merge of a batch into the bucket partitions it touches."""
    spark = batch.sparkSession
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    fresh = one_per_key(batch, keys, [F.col(c) for c in order], last=True).withColumn("bucket", bucket)
    staged = scratch_path(spark, "upsert")
    fresh.write.parquet(staged)
    fresh = spark.read.schema(fresh.schema).parquet(staged)
    touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]  # at most `buckets`
    if not touched:
        return
    merged = fresh
    try:
        old = spark.read.schema(fresh.schema).parquet(path).where(F.col("bucket").isin(*touched))
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
    else:
        # the latest in order stays, whichever batch brought it; at a tie the new batch's
        stacked = old.withColumn("_v", F.lit(0)).unionByName(fresh.withColumn("_v", F.lit(1)))
        merged = one_per_key(stacked, [*keys, "bucket"], [*map(F.col, order), F.col("_v")], last=True).drop("_v")
        # the target is being replaced, so the merged rows are written aside first
        aside = scratch_path(spark, "merged")
        merged.write.parquet(aside)
        merged = spark.read.schema(fresh.schema).parquet(aside)
    replace_slice(merged, path, ["bucket"])


def run_incremental(
    source: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    detail_path: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    buckets: int = 16,
) -> StreamingQuery:
    """Score whatever has arrived, upsert it, stop (``availableNow``); the query that is returned has ended."""
    folder = checkpoint.rstrip("/")

    def one(batch: DataFrame, number: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{folder}/{ARRIVED}/{BATCH}={number}")

    query = (
        source.writeStream.foreachBatch(one)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    _merge_arrived(source.sparkSession, folder, detail_path, keys, order, buckets)
    return query


def _merge_arrived(spark: SparkSession, folder: str, path: str, keys: Sequence[str], order: Sequence[str], buckets: int) -> None:
    """Merges the batches that no run has merged yet; at a tie the later one's row stays."""
    arrived, merged = _read_if_there(spark, f"{folder}/{ARRIVED}"), _read_if_there(spark, f"{folder}/{MERGED}")
    if arrived is None:
        return
    if merged is not None:
        arrived = arrived.where(F.col(BATCH) > merged.agg(F.max(BATCH)).scalar())
    last = arrived.agg(F.max(BATCH).alias("last")).first()["last"]  # one row
    if last is None:
        return
    latest = one_per_key(arrived, keys, [*map(F.col, order), F.col(BATCH)], last=True).drop(BATCH)
    upsert_partitions(latest, path, keys, order, buckets)
    spark.range(1).select(F.lit(last).cast("long").alias(BATCH)).write.mode("append").parquet(f"{folder}/{MERGED}")


def _read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
    return None
