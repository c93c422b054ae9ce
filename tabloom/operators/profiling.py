"""Aggregations and column profiles.

Wide profiles unpivot to (column, value) and count in two levels: the first
shuffle is keyed by the value, so a dominant value is combined map-side and a
dominant column is spread over its values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.operators.gram import correlations
from tabloom.operators.ordered import exact_quantiles, long_values
from tabloom.operators.shaping import names_by_type


def value_counts(
    df: DataFrame, col: str, normalize: bool = False, dropna: bool = True, n: int | None = None
) -> DataFrame:
    src = df.where(F.col(col).isNotNull()) if dropna else df
    counts = src.groupBy(col).agg(F.count("*").alias("n"))
    if normalize:
        total = src.agg(F.count("*")).scalar()
        counts = counts.withColumn("share", F.col("n") / total)
    return counts.orderBy(F.desc("n"), F.asc(col)).limit(n) if n else counts


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, missing, mean, sample std, min, exact quartiles, max per column."""
    # nulls stay in, so a column or group without values still has its row
    number = F.when(~F.isnan("value"), F.col("value"))
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(by), list(cols), "variable", "value").withColumn("value", number)
    basic = long.groupBy(*by, "variable").agg(
        F.count("value").alias("n_values"),
        F.avg("value").alias("mean"),
        F.stddev("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quart = exact_quantiles(df, cols, [0.25, 0.5, 0.75], by).drop("n").withColumnsRenamed(
        {"q0": "p25", "q1": "p50", "q2": "p75"}
    )
    names = {b: f"_key{i}" for i, b in enumerate([*by, "variable"])}
    same = reduce(and_, [F.col(b).eqNullSafe(F.col(k)) for b, k in names.items()])
    out = basic.join(quart.withColumnsRenamed(names), same, "left").drop(*names.values())
    if not by:
        out = out.withColumn("missing", df.agg(F.count("*")).scalar() - F.col("n_values"))
    return out


def crosstab(df: DataFrame, a: str, b: str, margins: bool = False) -> DataFrame:
    """Long-form cross table; with ``margins`` the ``All`` rows come from cube."""
    text = df.select(F.col(a).cast("string").alias(a), F.col(b).cast("string").alias(b))
    text = text.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    grouped = text.cube(a, b) if margins else text.groupBy(a, b)
    counts = grouped.agg(F.count("*").alias("n"))
    return counts.fillna("All", [a, b]) if margins else counts


def row_shares(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cross table with each cell's share of its row."""
    counts = crosstab(df, a, b)
    totals = counts.groupBy(a).agg(F.sum("n").alias("_t"))
    return counts.join(totals, a).withColumn("share", F.col("n") / F.col("_t")).drop("_t")


def group_rate(df: DataFrame, by: Sequence[str], target: str) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(target).alias("rate"))


def _is_missing(df: DataFrame, c: str) -> Column:
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return F.col(c).isNull() | F.isnan(c)
    return F.col(c).isNull()


def missing_profile(df: DataFrame, top: int | None = None) -> DataFrame:
    """(variable, missing, percent) from one aggregate row, unpivoted."""
    row = df.agg(
        F.count("*").alias("_rows"),
        *[F.sum(_is_missing(df, c).cast("long")).alias(c) for c in df.columns],
    )
    long = row.unpivot(["_rows"], df.columns, "variable", "missing").select(
        "variable", "missing", (F.try_divide(F.col("missing") * 100.0, F.col("_rows"))).alias("percent")
    )
    return long.orderBy(F.desc("missing"), "variable").limit(top) if top else long


def completeness(df: DataFrame, by: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """1 - missing cells / (rows x columns) per group."""
    cols = cols or [c for c in df.columns if c not in by]
    miss = F.lit(0)
    for c in cols:
        miss = miss + _is_missing(df, c).cast("int")
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        (1.0 - F.sum(miss) / (F.count("*") * float(len(cols)))).alias("completeness"),
    )


def missing_by_category(df: DataFrame, by: str, col: str) -> DataFrame:
    return df.groupBy(by).agg(
        F.count(col).alias("present"),
        F.count("*").alias("size"),
        (F.count("*") - F.count(col)).alias("missing"),
    )


def value_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(variable, value, n): every column's values as text with counts."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "variable", "value")
    return long.groupBy("variable", "value").agg(F.count("*").alias("n"))


def column_statistics(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """distinct, % null, % of the top category (null counts as one), type."""
    cols = list(cols or df.columns)
    types = F.create_map(*[F.lit(x) for c in cols for x in (c, df.schema[c].dataType.simpleString())])
    per = value_table(df, cols).groupBy("variable").agg(
        F.count("value").alias("n_distinct"),
        F.sum("n").alias("_rows"),
        F.coalesce(F.max(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("_null"),
        F.max("n").alias("_top"),
    )
    return per.select(
        "variable", "n_distinct",
        (F.col("_null") * 100.0 / F.col("_rows")).alias("pct_null"),
        (F.col("_top") * 100.0 / F.col("_rows")).alias("pct_top"),
        F.element_at(types, F.col("variable")).alias("dtype"),
    )


def cardinalities(df: DataFrame, cols: Sequence[str] | None = None, count_null: bool = False) -> DataFrame:
    """Exact distinct counts; ``count_null`` makes null a value of its own."""
    cols = list(cols or df.columns)
    n = F.count("*") if count_null else F.count("value")
    return (
        value_table(df, cols).groupBy("variable").agg(n.alias("n_distinct"))
        .withColumn("single_valued", F.col("n_distinct") <= 1)
        .withColumn("binary", F.col("n_distinct") == 2)
    )


def value_domains(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per (column, value): the domain saved at fit time."""
    return value_table(df, cols).where(F.col("value").isNotNull()).select("variable", "value")


def shape_ranking(df: DataFrame, cols: Sequence[str], bias_corrected: bool = False) -> DataFrame:
    """Skewness and excess kurtosis per column (population by default)."""
    long = long_values(df, cols)
    out = long.groupBy("variable").agg(
        F.count("*").alias("n"), F.skewness("value").alias("skewness"), F.kurtosis("value").alias("kurtosis")
    )
    if bias_corrected:
        n = F.col("n").cast("double")
        out = out.withColumn("skewness", F.when(n > 2, F.sqrt(n * (n - 1)) / (n - 2) * F.col("skewness")))
    return out.drop("n")


def correlation_pairs(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Long upper triangle (a, b, r) of the varying columns, each pair over the rows
    where both are known; one scan for any number of columns."""
    return correlations(df, list(cols or names_by_type(df)[0]))


# a value of any column fits one of these places, in its own order
_PLACES = "struct<text:string,whole:bigint,real:double,exact:decimal(38,18)>"


def _place(kind: T.DataType) -> tuple[str, Callable[[Column], Column], Callable[[Column], Column]]:
    """(place, how a value gets there, how it comes back); types not named here are ordered as text."""
    back = lambda x: x.cast(kind)
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return "whole", lambda x: x.cast("int").cast("long") if isinstance(kind, T.BooleanType) else x.cast("long"), back
    if isinstance(kind, T.DateType):
        return "whole", lambda x: F.unix_date(x).cast("long"), lambda x: F.date_from_unix_date(x.cast("int"))
    if isinstance(kind, T.TimestampType):
        return "whole", F.unix_micros, F.timestamp_micros
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return "real", lambda x: x.cast("double"), back
    if isinstance(kind, T.DecimalType) and kind.scale <= 18 and kind.precision - kind.scale <= 20:
        return "exact", lambda x: x.cast("decimal(38,18)"), back
    return "text", lambda x: x.cast("string"), back


def mode_per_group(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Most frequent value per column, smallest on ties, null where a group has no value in it.

    One scan for any number of columns: rows become (column, value) pairs, counts
    are keyed by value (map-side combined), so neither a group's distinct values
    nor a dominant value sit in one buffer, and no column needs a join.
    """
    places = {c: _place(df.schema[c].dataType) for c in cols}
    slots = [f.name for f in T._parse_datatype_string(_PLACES)]

    def pair(i: int, c: str) -> Column:
        slot, there, _ = places[c]
        value = F.struct(*[(there(F.col(c)) if s == slot else F.lit(None)).alias(s) for s in slots]).cast(_PLACES)
        return F.struct(F.lit(i).alias("i"), F.col(c).isNotNull().alias("known"), value.alias("v"))

    long = df.select(*by, F.explode(F.array(*[pair(i, c) for i, c in enumerate(cols)])).alias("_p"))
    counts = long.groupBy(*by, "_p").agg(F.count("*").alias("_n"))
    first = F.min_by("_p.v", F.when(F.col("_p.known"), F.struct(-F.col("_n"), F.col("_p.v"))))
    best = counts.groupBy(*by, F.col("_p.i").alias("_i")).agg(first.alias("_v"))
    # at most one entry per column
    rows = best.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_i", "_v"))).alias("_m"))
    found = [F.try_element_at("_m", F.lit(i)) for i in range(len(cols))]
    return rows.select(*by, *[places[c][2](found[i][places[c][0]]).alias(c) for i, c in enumerate(cols)])


def latest_non_null(df: DataFrame, by: Sequence[str], version: str, cols: Sequence[str]) -> DataFrame:
    """Per column the value of the latest version where it is not null."""
    return df.groupBy(*by).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(version))).alias(c) for c in cols]
    )


def group_size_distribution(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """How many groups have 1, 2-5 and 6+ members, and member min/mean/max."""
    sizes = df.groupBy(*by).agg(F.count("*").alias("n"))
    band = F.when(F.col("n") == 1, "1").when(F.col("n") <= 5, "2-5").otherwise("6+")
    return sizes.groupBy(band.alias("members")).agg(
        F.count("*").alias("n_groups"), F.min("n").alias("min_n"), F.avg("n").alias("mean_n"), F.max("n").alias("max_n")
    )


def within_group_spread(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(col).alias("n"), F.avg(col).alias("mean"), F.stddev(col).alias("std")
    )


def mean_within_spread(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """Mean of the group deviations; singletons have none and are skipped."""
    return within_group_spread(df, by, col).agg(
        F.count("*").alias("n_groups"), F.avg("mean").alias("mean_of_means"), F.avg("std").alias("mean_of_std")
    )


def coverage(df: DataFrame, entities: Sequence[str]) -> DataFrame:
    """Distinct entities per column, rows per entity min/avg/max."""
    long = value_table(df, entities).where(F.col("value").isNotNull())
    return long.groupBy("variable").agg(
        F.count("*").alias("n_entities"), F.min("n").alias("min_rows"),
        F.avg("n").alias("mean_rows"), F.max("n").alias("max_rows"),
    )


def load_gate(df: DataFrame, id_col: str, tolerated: int = 10) -> DataFrame:
    """One row: null ids and whether the load counts as done."""
    return df.agg(F.count("*").alias("n_rows"), F.sum(F.col(id_col).isNull().cast("long")).alias("null_ids")).select(
        "n_rows", "null_ids", (F.col("null_ids") <= tolerated).alias("passed")
    )


def nan_gate(df: DataFrame) -> DataFrame:
    """(variable, n_bad): nulls plus NaN (floating columns only)."""
    row = df.agg(*[F.sum(_is_missing(df, c).cast("long")).alias(c) for c in df.columns])
    return row.unpivot([], df.columns, "variable", "n_bad")


def key_audit(df: DataFrame, key: str) -> DataFrame:
    """Format audit of an id column in one row."""
    per = df.groupBy(F.col(key).cast("string").alias("k")).agg(F.count("*").alias("n"))
    return per.agg(
        F.sum("n").alias("n_rows"),
        F.count("k").alias("n_distinct"),
        F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.min(F.length("k")).alias("min_length"),
        F.max(F.length("k")).alias("max_length"),
        F.min("k").alias("min_key"),
        F.max("k").alias("max_key"),
        F.coalesce(F.sum(F.when(F.col("k").isNotNull() & (F.col("n") > 1), 1)), F.lit(0)).alias("n_repeated"),
    )


def off_domain(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    """Codes outside a standard list, with row counts."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n")).where(
        ~F.col(col).isin(*allowed)
    )


def entity_fingerprint(
    df: DataFrame,
    key: str,
    maxima: Sequence[str],
    modes: Sequence[str],
    share_of: str,
    share_when: Column,
) -> DataFrame:
    """Per entity: max of accumulators, mode of categoricals, frequency shares
    of reject codes, and all of it as text with absent parts left out."""
    top = df.groupBy(key).agg(*[F.max(F.col(c).try_cast("double")).alias(f"max_{c}") for c in maxima])
    mode = mode_per_group(df, modes, [key]).withColumnsRenamed({c: f"mode_{c}" for c in modes})
    rejects = df.where(share_when & F.col(share_of).isNotNull()).groupBy(key, share_of).agg(F.count("*").alias("_n"))
    shares = rejects.groupBy(key).agg(
        F.sum("_n").alias("_t"),
        F.sort_array(F.collect_list(F.struct(F.col(share_of).alias("code"), F.col("_n").alias("n")))).alias("_codes"),
    )
    out = top.join(mode, key, "left").join(shares, key, "left")

    def part(label: str, value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNotNull() & (F.trim(text) != ""), F.concat(F.lit(label + " is "), text))

    code_text = F.array_join(
        F.transform(
            "_codes",
            lambda e: F.concat(
                e["code"].cast("string"), F.lit(" "),
                F.round(e["n"] * 100.0 / F.col("_t"), 1).cast("string"), F.lit("%"),
            ),
        ),
        "; ",
    )
    pieces = [part(f"max {c}", F.round(F.col(f"max_{c}"), 2)) for c in maxima]
    pieces += [part(f"usual {c}", F.col(f"mode_{c}")) for c in modes]
    pieces.append(part(f"{share_of} shares", code_text))
    return out.withColumn("fingerprint", F.concat_ws(", ", *pieces)).drop("_t", "_codes")
