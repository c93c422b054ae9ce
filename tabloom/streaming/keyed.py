"""Incremental upsert by keyed state: a batch writes in proportion to its own rows.

The state store holds, for each key (claim id and plan, say), the version that
stands: the last by order values, then by arrival. It is Spark's own streaming
aggregate, so no Python runs for each key. An arriving row that is older than the
standing one changes nothing; a newer one, or one of the same order that arrives
later, is appended to the detail as the key's next version. Nothing that was written
is read or rewritten. A micro-batch writes its own folder, named by its number, so a
repeated one writes the same folder again, and the state's checkpoint belongs to the
same batch: replays and late files end at the batch result. ``current`` reads the
standing version of each key.

Batches are told apart by the time that the stream's log holds for them, so that
ties need a clock that does not run backwards between them.

A key with a third of all rows loses its superseded rows before the shuffle, some
thousand rows at a time; its task streams what is left and holds one row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tabloom.operators.ordered import one_per_key

VERSION = "_version"
_RANK = "_order"
_PLACE, _ARRIVED = "_place", "_arrived"
REDUCED_ROWS = 10_000  # rows among which superseded ones are dropped before the shuffle, at least


def _sortable(df: DataFrame, c: str) -> Column:
    """Times as numbers, so that they mean the same in Spark, Arrow and the state store; NaN counts as null."""
    kind = df.schema[c].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.DateType):
        return F.unix_date(c)
    if isinstance(kind, T.FloatType | T.DoubleType):
        return F.nanvl(c, F.lit(None).cast(kind))
    return F.col(c)


def _comes_after(a: Sequence, b: Sequence) -> bool:
    """Whether order values ``a`` are at least ``b``; nulls come first."""
    def place(values: Sequence) -> list[tuple]:
        return [(False, 0) if pd.isna(v) else (True, v) for v in values]

    return place(a) >= place(b)


def latest_of_batch(df: DataFrame, keys: Sequence[str], ranks: Sequence[str]) -> DataFrame:
    """Without rows that a later one of some thousand rows of a task supersedes; no shuffle.

    ``_place`` is added: where in the task's input a row came.
    """
    def latest(held: list[pd.DataFrame], first: int) -> pd.DataFrame:
        pdf = pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
        pdf = pdf.assign(**{_PLACE: range(first, first + len(pdf))})
        return pdf.sort_values(list(ranks), kind="stable", na_position="first").drop_duplicates(list(keys), keep="last")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, first = [], 0, TaskContext.get().partitionId() << 33
        for pdf in batches:
            held.append(pdf)
            size += len(pdf)
            if size >= REDUCED_ROWS:
                yield latest(held, first)
                held, size, first = [], 0, first + size
        if size:
            yield latest(held, first)

    return df.mapInPandas(run, T.StructType([*df.schema.fields, T.StructField(_PLACE, T.LongType())]))


def keyed_versions(scored: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The version of each key that a micro-batch accepts, as a stream in update mode: the columns of ``scored``."""
    ranks = [f"{_RANK}{i}" for i in range(len(order))]
    marked = scored.withColumns({r: _sortable(scored, c) for r, c in zip(ranks, order)})
    arrived = latest_of_batch(marked, keys, ranks).withColumn(_ARRIVED, F.current_timestamp())
    others = [c for c in scored.columns if c not in keys]
    standing = arrived.groupBy(*keys).agg(F.max_by(F.struct(_ARRIVED, *others), F.struct(*ranks, _ARRIVED, _PLACE)).alias("_top"))
    # keys that the batch touched; those whose standing row came earlier have no new version
    return standing.where(F.col("_top")[_ARRIVED] == F.current_timestamp()).select(
        *[F.col(c) if c in keys else F.col("_top")[c].alias(c) for c in scored.columns])


def run_keyed(
    source: DataFrame, score: Callable[[DataFrame], DataFrame], detail_path: str, checkpoint: str,
    keys: Sequence[str], order: Sequence[str],
) -> StreamingQuery:
    """Score what has arrived, add its accepted versions under ``detail_path``, stop (``availableNow``)."""
    def write(accepted: DataFrame, batch: int) -> None:
        accepted.write.mode("overwrite").parquet(f"{detail_path.rstrip('/')}/{VERSION}={batch + 1}")

    return (
        keyed_versions(score(source), keys, order).writeStream.foreachBatch(write).outputMode("update")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def current(spark: SparkSession, detail_path: str, keys: Sequence[str]) -> DataFrame:
    """The standing version of each key."""
    versions = spark.read.parquet(detail_path)
    return one_per_key(versions, keys, [F.col(VERSION)], last=True).drop(VERSION)
