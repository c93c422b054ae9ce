"""Row filters.  Plain predicates, so Parquet and JDBC see them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.ordered import exact_quantiles


def keep_status(df: DataFrame, col: str, value: str) -> DataFrame:
    return df.where(F.col(col) == value)


def keep_members(df: DataFrame, col: str, members: Sequence | DataFrame) -> DataFrame:
    """``isin`` for a literal list, a left-semi join for a computed one."""
    if isinstance(members, DataFrame):
        return df.join(members.select(F.col(members.columns[0]).alias(col)), col, "left_semi")
    return df.where(F.col(col).isin(*members))


def drop_leading_blank(df: DataFrame, col: str) -> DataFrame:
    """``NOT LIKE ' %'``; nulls go too (three-valued logic)."""
    return df.where(~F.col(col).like(" %"))


def above(df: DataFrame, col: str, threshold: float) -> DataFrame:
    return df.where(F.col(col) > threshold)


def drop_where(df: DataFrame, cond: Column) -> DataFrame:
    """Drop rows meeting a compound rule; an unknown outcome keeps the row."""
    return df.where(~F.coalesce(cond, F.lit(False)))


def complete_cases(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(subset) if subset else None)


def drop_sentinel_keys(df: DataFrame, col: str, sentinels: Sequence[str] = ("0",)) -> DataFrame:
    return df.where(~F.coalesce(F.col(col).cast("string").isin(*sentinels), F.lit(False)))


def keep_group_size(df: DataFrame, keys: Sequence[str], at_least: int = 2, at_most: int | None = None) -> DataFrame:
    """Rows of groups within a size range: counts are combined map-side and
    semi-joined back, so no group is gathered in a window."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") >= at_least)
    if at_most is not None:
        sizes = sizes.where(F.col("_n") <= at_most)
    return df.join(sizes.drop("_n"), list(keys), "left_semi")


def outlier_bounds(df: DataFrame, col: str, method: str = "iqr") -> DataFrame:
    """One row (lo, hi): ``iqr`` 1.5 fences, ``zscore`` 3 population deviations,
    ``sigma`` 3 sample deviations."""
    if method == "iqr":
        q = exact_quantiles(df, [col], [0.25, 0.75])
        reach = (F.col("q1") - F.col("q0")) * 1.5
        return q.select((F.col("q0") - reach).alias("lo"), (F.col("q1") + reach).alias("hi"))
    spread = {"zscore": F.stddev_pop, "sigma": F.stddev}[method](col)
    return df.agg((F.avg(col) - spread * 3.0).alias("lo"), (F.avg(col) + spread * 3.0).alias("hi"))


def with_outlier_flag(df: DataFrame, col: str, method: str = "iqr", out: str = "is_outlier") -> DataFrame:
    """Bounds reach the rows as a scalar subquery: no join, no shuffle of rows."""
    b = outlier_bounds(df, col, method).select(F.struct("lo", "hi")).scalar()
    return df.withColumn(out, (F.col(col) < b["lo"]) | (F.col(col) > b["hi"]))


def drop_outliers(df: DataFrame, col: str, method: str = "iqr") -> DataFrame:
    return with_outlier_flag(df, col, method, "_out").where(~F.col("_out")).drop("_out")
