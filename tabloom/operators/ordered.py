"""Total-order operators that never put one group into one task.

A window over a whole group (or over no partition at all) sorts that group in
a single task.  Here the ordered key space is first cut into pieces at keys
picked uniformly by hash, each piece is handled on its own, and a tiny
per-piece table carries the running offset from one piece to the next.  The
result equals the plain window, whatever share of the rows one group holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabloom.session import settle

def pieces_for(df: DataFrame) -> int:
    """A power of two, about four pieces per shuffle partition, however many the session asks for."""
    wanted = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = 16
    while pieces < wanted:
        pieces *= 2
    return pieces


def _with_piece(df: DataFrame, key_cols: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Adds ``_piece``: the number of cut keys at or below this row's key.

    The cuts are the keys of smallest hash: a uniform, repeatable choice (same
    input, same cuts, also when a task is retried) found with a bounded top-n,
    not a sort of the data.  ``carry`` names further columns of an aggregated
    ``df``: reading them too keeps its plan equal to the main one, so Spark
    reuses that shuffle for the cuts.
    """
    pieces = pieces_for(df)
    key = F.struct(*[F.col(c) for c in key_cols])
    cuts = (
        df.select(key.alias("k"), *carry)
        .orderBy(F.xxhash64("k"), "k")
        .limit(pieces - 1)
        .agg(F.struct(F.sort_array(F.collect_list("k")).alias("cuts"), *[F.max(c).alias(c) for c in carry]))
        .scalar()["cuts"]
    )
    # binary search, one codegen step per halving; a missing cut counts as infinite
    out = df.withColumns({"_cuts": cuts, "_key": key, "_piece": F.lit(0)})
    step = pieces // 2
    while step:
        cut = F.get("_cuts", F.col("_piece") + (step - 1))
        reached = F.coalesce(cut <= F.col("_key"), F.lit(False))
        out = out.withColumn("_piece", F.col("_piece") + F.when(reached, step).otherwise(0))
        step //= 2
    return out.drop("_cuts", "_key")


def _grouped_pieces(
    df: DataFrame, by: Sequence[str], order: Sequence[str], carry: Sequence[str] = ()
) -> tuple[DataFrame, list[str]]:
    """Pieces plus the group as one struct, which compares equal on nulls."""
    keyed = _with_piece(df, [*by, *order], carry)
    return (keyed.withColumn("_group", F.struct(*by)), ["_group"]) if by else (keyed, [])


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    measures: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Exclusive running sums and totals of ``measures`` in key order.

    ``df`` holds one row per (``by``, ``order``): aggregate first.  Adds
    ``<m>_before`` and ``<m>_total`` per measure.
    """
    keyed, group = _grouped_pieces(df, by, order, measures)
    sums = keyed.groupBy(*group, "_piece").agg(*[F.sum(m).alias(m) for m in measures])
    earlier = W.partitionBy(*group).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(
        *group, "_piece",
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_off_{m}") for m in measures],
        *[F.sum(m).over(W.partitionBy(*group)).alias(f"{m}_total") for m in measures],
    )
    # the join and the window share one partitioning: (group, piece)
    joined = keyed.join(offsets, [*group, "_piece"])
    inside = W.partitionBy(*group, "_piece").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return joined.select(
        *df.columns,
        *[
            (F.col(f"_off_{m}") + F.coalesce(F.sum(m).over(inside), F.lit(0))).alias(f"{m}_before")
            for m in measures
        ],
        *[F.col(f"{m}_total") for m in measures],
    )


def positions(df: DataFrame, order: Sequence[str], out: str = "pos", by: Sequence[str] = ()) -> DataFrame:
    """0-based position of each (unique) key in order, as a long."""
    counted = running_totals(df.withColumn("_one", F.lit(1).cast("long")), order, ["_one"], by)
    return counted.withColumn(out, F.col("_one_before")).drop("_one", "_one_before", "_one_total")


def previous_value(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
) -> DataFrame:
    """``lag(value)`` per group over a unique order, safe for a hot group.

    The first row of a piece takes the last value of the nearest earlier piece
    of its group, read from the per-piece table.
    """
    keyed, group = _grouped_pieces(df, by, order)
    last = keyed.groupBy(*group, "_piece").agg(
        F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("_last")
    )
    carried = last.select(
        *group, "_piece", F.lag("_last").over(W.partitionBy(*group).orderBy("_piece")).alias("_carry")
    )
    joined = keyed.join(carried, [*group, "_piece"])
    inside = W.partitionBy(*group, "_piece").orderBy(*order)
    prev = F.lag(F.struct(F.col(value).alias("v"))).over(inside)
    return joined.select(*df.columns, F.coalesce(prev, F.col("_carry"))["v"].alias(out))


def long_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., variable, value) as doubles, nulls and NaN left out."""
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(by), list(cols), "variable", "value"
    )
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))


# rank error of the sketch (its guarantee) and the margin taken around each rank
SKETCH_ACCURACY = 10_000
MARGIN = 10 / SKETCH_ACCURACY


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact linear-interpolation quantiles: (by..., variable, n, q0, q1, ...).

    ``percentile`` keeps every distinct value of a group in one buffer.  Here a
    first pass sketches each group and brackets every wanted rank with ten
    times the sketch's error; a second pass counts what lies below a bracket
    (map-side combined) and moves only the values inside it, about 0.2% of the
    rows per probability.  Running totals then find the rank exactly; a bracket
    that missed its rank would stop the job rather than give a wrong value.
    The sketching job runs when this is called.
    """
    from tabloom.operators.joins import dimension_join

    keys = [*by, "variable"]
    long = long_values(df, cols, by).withColumn("_g", F.struct(*keys))
    edges = [min(max(x, 0.0), 1.0) for p in probs for x in (p - MARGIN, p + MARGIN)]
    # one row per group, written once; broadcast after a size check, else salted
    brackets = settle(long.groupBy("_g").agg(
        F.percentile_approx("value", edges, SKETCH_ACCURACY).alias("_e"), F.count("*").alias("_n")))
    v, e = F.col("value"), F.col("_e")
    # a small group is counted whole: there the margin is less than a few ranks
    inside, zone = F.col("_n") <= SKETCH_ACCURACY, F.lit(0)
    for i in range(len(probs)):
        inside = inside | ((v >= e[2 * i]) & (v <= e[2 * i + 1]))
        zone = zone + (v > e[2 * i + 1]).cast("int")
    # one row per value inside a bracket and one per stretch between brackets;
    # (zone, cell) with the null cell first is the order of the values
    counts = dimension_join(long.select("_g", "value"), brackets, ["_g"]).select("_g", zone.alias("zone"), F.when(inside, v).alias("cell")).groupBy(
        "_g", "zone", "cell").agg(F.count("*").alias("c"))
    run = running_totals(counts, ["zone", "cell"], ["c"], ["_g"])

    def rank(p: float) -> Column:
        return (F.col("c_total") - 1) * F.lit(float(p))

    def at(position: Column) -> Column:
        hit = (F.col("c_before") <= position) & (position < F.col("c_before") + F.col("c"))
        return F.max(F.when(hit, F.col("cell")))

    found = run.groupBy("_g").agg(
        F.max("c_total").alias("n"),
        *[at(F.floor(rank(p))).alias(f"lo{i}") for i, p in enumerate(probs)],
        *[at(F.ceil(rank(p))).alias(f"hi{i}") for i, p in enumerate(probs)],
    )

    def value(i: int) -> Column:
        r = (F.col("n") - 1) * F.lit(float(probs[i]))
        q = F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * (r - F.floor(r))
        return F.coalesce(q, F.raise_error(F.lit("quantile bracket missed its rank")).cast("double"))

    return found.select("_g.*", "n", *[value(i).alias(f"q{i}") for i in range(len(probs))])


def top_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int
) -> DataFrame:
    """First ``n`` rows of each group, in two rounds so no group is hot.

    Round one ranks inside (group, salt) where the salt spreads a group over
    tasks; at most ``n * salts`` rows per group reach round two.  Both rounds
    are lone rank filters, so Spark also trims map-side (WindowGroupLimit).
    For small ``n``; samples by hash use ``sets.flag_first_by_hash`` instead.
    """
    salts = max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts))
    first = W.partitionBy(*by, "_salt").orderBy(*order)
    second = W.partitionBy(*by).orderBy(*order)
    return (
        df.withColumn("_salt", salt)
        .withColumn("_rn", F.row_number().over(first))
        .where(F.col("_rn") <= n)
        .drop("_rn")
        .withColumn("_rn", F.row_number().over(second))
        .where(F.col("_rn") <= n)
        .drop("_rn", "_salt")
    )


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], last: bool = False) -> DataFrame:
    """One whole row per key: the first (or last) in ``order``.

    ``min_by``/``max_by`` combine map-side, so a key held by a third of the
    rows sends one candidate per task instead of all its rows.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    row = pick(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)
