"""Sampling, ranking and standardising without whole-group windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.joins import dimension_join
from tabloom.operators.ordered import exact_quantiles, positions, previous_value
from tabloom.operators.sets import flag_first_by_hash
from tabloom.session import settle


def capped_sample(
    df: DataFrame, group: str, key: str, cap: int, floor: int
) -> DataFrame:
    """At most ``cap`` rows per group in md5 order of the key; a group stays
    only when its capped count exceeds ``floor``.  Only grouped counts and one
    key per group are shuffled, never the rows."""
    wanted = F.when(F.least(F.col("_total"), F.lit(cap)) > floor, F.lit(cap)).otherwise(F.lit(0))
    return flag_first_by_hash(df, key, wanted, [group], "_keep").where(F.col("_keep")).drop("_keep")


def tiered_sample(df: DataFrame, group: str, key: str, large: int, small: int) -> DataFrame:
    """Above ``large`` rows: that many in md5 order; above ``small``: all;
    otherwise none."""
    wanted = F.when(F.col("_total") > small, F.lit(large)).otherwise(F.lit(0))
    return flag_first_by_hash(df, key, wanted, [group], "_keep").where(F.col("_keep")).drop("_keep")


def fill_group_median(df: DataFrame, group: str, col: str) -> DataFrame:
    """Nulls take their group's exact median; an all-null group stays null."""
    med = settle(exact_quantiles(df, [col], [0.5], [group]).select(F.struct(group).alias("_g"), F.col("q0").alias("_med")))
    joined = dimension_join(df.withColumn("_g", F.struct(group)), med, ["_g"], "left")
    return joined.withColumn(col, F.coalesce(F.col(col).cast("double"), "_med")).select(*df.columns)


def frequency_ranks(values: DataFrame, col: str) -> DataFrame:
    """(value, code): 0-based rank by count desc then value; singletons share
    one code, the number of non-singletons."""
    counts = values.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    many = counts.where(F.col("n") > 1).withColumn("neg", -F.col("n"))
    ranked = positions(many, ["neg", col], "code").select(col, "code")
    last = many.agg(F.count("*")).scalar()
    single = counts.where(F.col("n") == 1).select(col, last.alias("code"))
    return ranked.unionByName(single)


def frequency_encode(train: DataFrame, test: DataFrame, col: str, out: str) -> tuple[DataFrame, DataFrame]:
    codes = frequency_ranks(train.select(col).unionByName(test.select(col)), col).withColumnRenamed("code", out)
    return train.join(codes, col, "left"), test.join(codes, col, "left")


def standardize(df: DataFrame, cols: Sequence[str], suffix: str = "_std") -> DataFrame:
    """z-scores with the sample deviation; statistics enter as a scalar
    subquery, so the rows are neither joined nor moved."""
    stats = df.agg(
        F.struct(*[s for c in cols for s in (F.avg(c).alias(f"m_{c}"), F.stddev(c).alias(f"s_{c}"))])
    ).scalar()
    return df.withColumns(
        {c + suffix: F.try_divide(F.col(c) - stats[f"m_{c}"], stats[f"s_{c}"]) for c in cols}
    )


def lag_differences(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, out: str = "delta"
) -> DataFrame:
    """Value minus the previous value of the group (unique order)."""
    prev = previous_value(df, by, order, value, "_prev")
    return prev.withColumn(out, F.col(value) - F.col("_prev")).drop("_prev")


def array_differences(values: Column) -> Column:
    """First differences along an array of successive lags."""
    n = F.size(values)
    head = F.slice(values, F.lit(1), F.greatest(n - 1, F.lit(0)))
    tail = F.slice(values, F.lit(2), F.greatest(n - 1, F.lit(0)))
    return F.zip_with(tail, head, lambda b, a: b - a)


def group_count(df: DataFrame, by: Sequence[str], out: str) -> DataFrame:
    """Group size mapped back to the rows (aggregate and join, not a window)."""
    sizes = df.groupBy(*by).agg(F.count("*").alias(out))
    return df.join(sizes, list(by), "left")


# -- sorting and limits -------------------------------------------------------


def top_categories(df: DataFrame, col: str, n: int) -> DataFrame:
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(col)).limit(n)


def top_categories_with_hue(df: DataFrame, col: str, hue: str, n: int) -> DataFrame:
    """Counts per (category, hue) for the n largest categories."""
    cells = df.where(F.col(col).isNotNull()).groupBy(col, hue).agg(F.count("*").alias("n"))
    top = cells.groupBy(col).agg(F.sum("n").alias("_t")).orderBy(F.desc("_t"), F.asc(col)).limit(n)
    return cells.join(top.select(col), col, "left_semi")


def largest_abs(df: DataFrame, col: str, key: str, n: int) -> DataFrame:
    return df.withColumn("abs_value", F.abs(col)).orderBy(F.desc("abs_value"), F.asc(key)).limit(n)


def largest_abs_groups(df: DataFrame, col: str, key: str, by: str, n: int) -> DataFrame:
    """How many of the n largest |col| fall in each group."""
    return largest_abs(df, col, key, n).groupBy(by).agg(F.count("*").alias("n"))


def risk_list(df: DataFrame, p: str, key: str, n: int = 10) -> DataFrame:
    return df.orderBy(F.desc(p), F.asc(key)).limit(n)


def stable_order(df: DataFrame, col: str) -> DataFrame:
    return df.orderBy(col)


def mean_importance(df: DataFrame, n: int = 1000) -> DataFrame:
    """(feature, importance) rows of several folds -> the n largest means."""
    return (
        df.groupBy("feature").agg(F.avg("importance").alias("importance"))
        .orderBy(F.desc("importance"), "feature").limit(n)
    )
