"""Joins, match reports and key audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.ordered import one_per_key
from tabloom.session import settle

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Proof of size: at most ``rows`` rows and ``size`` bytes as text, found by reading rows + 1."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    seen = df.limit(rows + 1).select(F.octet_length(F.to_json(row)).alias("b")).agg(
        F.count("*").alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
    return seen["n"] <= rows and seen["b"] <= size


HOT_SHARE = 1000  # a key with more than one in so many rows is hot; so there are no more hot keys than that
SLICE_SHARE = 100_000  # a slice of a hot key holds about one in so many rows,
LEAST_SLICE = 100_000  # but so many rows at least


def hot_keys(fact: DataFrame, on: Sequence[str], least: int = LEAST_SLICE) -> DataFrame:
    """(on..., _salts): the hot keys of ``fact`` and into how many slices their rows are cut; stored.

    Counting is map-side combined, so it moves each distinct key once per task.
    """
    sizes = fact.groupBy(*on).agg(F.count("*").alias("_n"))
    total = sizes.agg(F.sum("_n")).scalar()
    size = F.greatest(F.lit(least), F.floor(total / SLICE_SHARE))
    known = F.lit(True)
    for c in on:
        known = known & F.col(c).isNotNull()
    hot = sizes.where(known & (F.col("_n") > F.greatest(F.lit(least), F.floor(total / HOT_SHARE))))
    return settle(hot.select(*on, F.ceil(F.col("_n") / size).cast("int").alias("_salts")))


def dimension_join(
    fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "inner", rows: int = BROADCAST_ROWS,
    least: int = LEAST_SLICE,
) -> DataFrame:
    """Fact x dimension on equal keys.

    A dimension proved small is broadcast.  Beyond that the fact's hot keys are
    found by counting; only their rows are dealt over slices (row by row, so equal
    rows part as well) and only their dimension rows are copied to each slice.
    Rows with a null key match nothing and are dealt out too.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError("dimension_join keeps the fact side: inner, left or left_semi")
    on = list(on)
    if is_small(dim, rows):
        return fact.join(F.broadcast(dim), on, how)
    hot = hot_keys(fact, on, least)
    lost = F.lit(False)
    for c in on:
        lost = lost | F.col(c).isNull()
    number = F.monotonically_increasing_id()
    dealt = F.when(lost, F.pmod(number, F.lit(HOT_SHARE))).otherwise(F.coalesce(F.pmod(number, F.col("_salts").cast("long")), F.lit(0)))
    left = fact.join(F.broadcast(hot), on, "left").withColumn("_salt", dealt.cast("int")).drop("_salts")
    right = dim.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return left.join(right, [*on, "_salt"], how).select(*[F.col(f"`{c}`") for c in _joined_columns(fact, dim, on, how)])


def _joined_columns(fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str) -> list[str]:
    rest = [c for c in fact.columns if c not in on]
    return [*on, *rest] if how == "left_semi" else [*on, *rest, *[c for c in dim.columns if c not in on]]


def suffixed(df: DataFrame, other: DataFrame, keys: Sequence[str], suffix: str) -> DataFrame:
    clash = {c for c in df.columns if c in other.columns and c not in keys}
    return df.select(*[F.col(c).alias(c + suffix if c in clash else c) for c in df.columns])


def three_way_merge(
    base: DataFrame,
    left: DataFrame,
    left_key: str,
    inner: DataFrame,
    inner_key: str,
    suffixes: tuple[str, str, str] = ("_base", "_left", "_inner"),
) -> DataFrame:
    """Left join on a composite key, then inner join on the id; colliding
    columns get suffixes; ``_matched`` marks rows that found the left source."""
    marked = suffixed(left, base, [left_key], suffixes[1]).withColumn("_matched", F.lit(True))
    first = suffixed(base, left, [left_key], suffixes[0]).join(marked, left_key, "left")
    right = suffixed(inner, first, [inner_key], suffixes[2])
    return first.join(right, inner_key, "inner")


def merge_report(base: DataFrame, left: DataFrame, left_key: str, inner: DataFrame, inner_key: str) -> DataFrame:
    """One row of match statistics for the three-way merge."""
    marks = left.select(left_key).withColumn("_m", F.lit(1))
    first = base.select(left_key, inner_key).join(marks, left_key, "left")
    stage1 = first.agg(
        F.count("*").alias("rows_after_left"),
        F.count("_m").alias("left_matched"),
    )
    sizes = {
        "base_rows": base.agg(F.count("*")).scalar(),
        "left_rows": left.agg(F.count("*")).scalar(),
        "inner_rows": inner.agg(F.count("*")).scalar(),
        "merged_rows": first.join(inner.select(inner_key), inner_key).agg(F.count("*")).scalar(),
    }
    return stage1.withColumns(sizes).withColumns(
        {
            "match_rate": F.try_divide(F.col("left_matched") * 100.0, F.col("rows_after_left")),
            "success_rate": F.try_divide(F.col("merged_rows") * 100.0, F.col("inner_rows")),
        }
    )


def label_by_membership(df: DataFrame, key: str, members: DataFrame, out: str = "is_error") -> DataFrame:
    """``out`` = trimmed key is in the trimmed, de-duplicated list; null -> false."""
    listed = members.select(F.trim(F.col(members.columns[0]).cast("string")).alias("_k")).where(
        F.col("_k").isNotNull()
    ).distinct().withColumn("_hit", F.lit(True))
    return (
        df.withColumn("_k", F.trim(F.col(key).cast("string")))
        .join(listed, "_k", "left")
        .withColumn(out, F.coalesce("_hit", F.lit(False)))
        .drop("_k", "_hit")
    )


def unmatched_keys(df: DataFrame, key: str, members: DataFrame) -> DataFrame:
    listed = members.select(F.trim(F.col(members.columns[0]).cast("string")).alias("key")).distinct()
    have = df.select(F.trim(F.col(key).cast("string")).alias("key"))
    return listed.join(have, "key", "left_anti")


def membership_report(
    df: DataFrame, key: str, members: DataFrame, alert_below: float = 0.9
) -> DataFrame:
    """Match statistics of an error list against the documents it names."""
    listed = members.select(F.trim(F.col(members.columns[0]).cast("string")).alias("key")).distinct()
    labelled = label_by_membership(df, key, members, "_err")
    flags = labelled.agg(
        F.count("*").alias("total_files"),
        F.sum(F.col("_err").cast("long")).alias("error_files"),
    )
    unmatched = unmatched_keys(df, key, members).agg(F.count("*")).scalar()
    return (
        flags.withColumn("listed_keys", listed.agg(F.count("*")).scalar())
        .withColumn("unmatched_keys", unmatched)
        .withColumn("matched_keys", F.col("listed_keys") - F.col("unmatched_keys"))
        .withColumn("error_rate", F.try_divide(F.col("error_files").cast("double"), F.col("total_files")))
        .withColumn("alert", F.coalesce(
            F.try_divide(F.col("matched_keys").cast("double"), F.col("listed_keys")) < alert_below, F.lit(False)))
    )


def key_overlap(a: DataFrame, a_key: str, b: DataFrame, b_key: str) -> DataFrame:
    """Distinct canonical keys per side and in common, in one grouped pass."""
    from tabloom.functions.text import canonical_key

    both = (
        a.select(canonical_key(F.col(a_key)).alias("k"), F.lit(1).alias("in_a"), F.lit(0).alias("in_b"))
        .unionByName(b.select(canonical_key(F.col(b_key)).alias("k"), F.lit(0).alias("in_a"), F.lit(1).alias("in_b")))
        .where(F.col("k").isNotNull())
        .groupBy("k")
        .agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    )
    return both.agg(
        F.sum("in_a").alias("a_keys"),
        F.sum("in_b").alias("b_keys"),
        F.sum(F.col("in_a") * F.col("in_b")).alias("common_keys"),
    )


def rate_and_size(df: DataFrame, category: str, target: str) -> DataFrame:
    """Category rate x category size: one aggregate instead of a join."""
    return (
        df.where(F.col(category).isNotNull())
        .groupBy(category)
        .agg(F.coalesce(F.avg(target), F.lit(0.0)).alias("rate"), F.count("*").alias("size"))
    )


def decode_labels(df: DataFrame, col: str, labels: Sequence[str], out: str) -> DataFrame:
    """Index -> label from a fitted label list."""
    table = F.array(*[F.lit(x) for x in labels])
    return df.withColumn(out, F.get(table, F.col(col).cast("int")))


def upsert_keep_last(
    old: DataFrame, new: DataFrame, keys: Sequence[str], prefer: str = "new"
) -> DataFrame:
    """Stack old and new and keep one row per key; ``prefer`` names the winner."""
    rank = {"new": (0, 1), "old": (1, 0)}[prefer]
    stacked = old.withColumn("_v", F.lit(rank[0])).unionByName(new.withColumn("_v", F.lit(rank[1])))
    tie = [F.col(c) for c in old.columns if c not in keys]
    return one_per_key(stacked, keys, [F.col("_v"), *tie], last=True).drop("_v")
