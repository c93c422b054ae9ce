"""Set operations, holdouts, splits and folds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabloom.functions.numeric import hash_bucket, hash_order
from tabloom.operators.joins import dimension_join
from tabloom.operators.ordered import one_per_key, positions
from tabloom.session import settle


def union_tagged(frames: Mapping[str, DataFrame], tag: str = "origin") -> DataFrame:
    """Union by name with missing columns as null, tagged by origin."""
    tagged = [f.withColumn(tag, F.lit(name)) for name, f in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return one_per_key(df, keys, order)


def key_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def key_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct keys of ``a`` that ``b`` lacks."""
    return a.subtract(b)


DIGITS = 4  # hash digits that one level of the selection looks at
HASH_DIGITS = 32
FEW_KEYS = 10_000  # keys of a group that one task may rank


def _narrowed(hashed: DataFrame, per: DataFrame) -> DataFrame:
    """Radix selection: lengthens each group's hash prefix until few keys share it.

    ``per`` has a row per group with ``_hit``: the prefix that holds the wanted key,
    the key's rank among the rows of that prefix, and their number. All groups that
    still hold more than FEW_KEYS are refined together, one counting scan (map-side
    combined) for every DIGITS digits: two levels for up to 10^9 rows a group, three
    for 10^14. A prefix that a single repeated hash fills is not refined.
    """
    width = DIGITS
    while width < HASH_DIGITS and per.where(F.col("_hit.c") > FEW_KEYS).limit(1).count():
        width += DIGITS
        wide = per.where(F.col("_hit.c") > FEW_KEYS).select("_g", F.col("_hit.p").alias("_p"), F.col("_hit.r").alias("_r"))
        inside = dimension_join(hashed.select("_g", "h"), wide, ["_g"]).where(F.startswith("h", F.col("_p")))
        counts = inside.groupBy("_g", "_r", F.substring("h", 1, width).alias("_p")).agg(
            F.count("*").alias("c"), F.min("h").alias("_lo"), F.max("h").alias("_hi"))
        run = counts.withColumn("_upto", F.sum("c").over(W.partitionBy("_g").orderBy("_p")))
        found = run.where((F.col("_upto") >= F.col("_r")) & (F.col("_upto") - F.col("c") < F.col("_r")))
        size = F.when(F.col("_lo") == F.col("_hi"), F.lit(1).cast("long")).otherwise(F.col("c"))
        found = found.select("_g", F.struct(
            F.col("_p").alias("p"), (F.col("_r") - F.col("_upto") + F.col("c")).alias("r"), size.alias("c")).alias("_next"))
        per = settle(per.join(found, "_g", "left").select("_g", "_whole", F.coalesce("_next", "_hit").alias("_hit")))
    return per


def flag_first_by_hash(
    df: DataFrame, key: str, n: Column | int, by: Sequence[str] = (), out: str = "is_first", hashed: bool = False
) -> DataFrame:
    """True for the first ``n`` rows (per group) in md5 order of a unique key
    (rows that share a key are flagged together).  Where ``hashed``, the key is
    a ``hash_order`` already.

    ``n`` may be an expression over ``_total``, the group's row count.  No row
    is sorted or moved to find them: rows are counted per hash prefix (map-side
    combined), running sums name the prefix that holds rank n, prefixes that
    hold many keys are lengthened (see :func:`_narrowed`), only the last one's
    few keys are ranked, and every row then compares itself with its group's
    n-th key (broadcast after a size check).  Work per group is even, whatever
    share of rows it has.  The counting jobs run when this is called.
    """
    wanted = n if isinstance(n, Column) else F.lit(n)
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    order = F.col(key) if hashed else hash_order(F.col(key))
    keys = df.select(group.alias("_g"), order.alias("h"), F.col(key).alias("k"))
    counts = keys.groupBy("_g", F.substring("h", 1, DIGITS).alias("_p")).agg(F.count("*").alias("c"))
    run = counts.withColumns({
        "_upto": F.sum("c").over(W.partitionBy("_g").orderBy("_p")),
        "_total": F.sum("c").over(W.partitionBy("_g")),
    }).withColumn("_n", wanted)
    hit = (F.col("_upto") >= F.col("_n")) & (F.col("_upto") - F.col("c") < F.col("_n")) & (F.col("_n") < F.col("_total"))
    rank = (F.col("_n") - F.col("_upto") + F.col("c")).cast("long")
    # one row per group, written once: it steers the later scans
    per = settle(run.groupBy("_g").agg(
        F.max(F.col("_n") >= F.col("_total")).alias("_whole"),
        F.max(F.when(hit, F.struct(F.col("_p").alias("p"), rank.alias("r"), "c"))).alias("_hit"),
    ))
    per = _narrowed(keys, per)
    at = per.where(F.col("_hit").isNotNull()).select("_g", F.col("_hit.p").alias("_p"), F.col("_hit.r").alias("_r"))
    inside = dimension_join(keys, at, ["_g"]).where(F.startswith("h", F.col("_p")))
    # keys are counted before they are ranked, so a repeated key is one row here
    ranked = inside.groupBy("_g", "_r", "h", "k").agg(F.count("*").alias("c"))
    ranked = ranked.withColumn("_cum", F.sum("c").over(W.partitionBy("_g").orderBy("h", "k")))
    reached = (F.col("_cum") >= F.col("_r")) & (F.col("_cum") - F.col("c") < F.col("_r"))
    nth = ranked.where(reached).select("_g", F.struct("h", "k").alias("_nth"))
    cuts = settle(per.select("_g", "_whole").join(nth, "_g", "left"))
    own = F.struct(order.alias("h"), F.col(key).alias("k"))
    if by:
        tagged = dimension_join(df.withColumn("_g", group), cuts, ["_g"], "left")
        whole, last = F.col("_whole"), F.col("_nth")
    else:
        tagged = df
        one = cuts.select(F.struct("_whole", "_nth")).scalar()
        whole, last = one["_whole"], one["_nth"]
    flag = F.coalesce(whole, F.lit(False)) | F.coalesce(own <= last, F.lit(False))
    return tagged.withColumn(out, flag).select(*df.columns, out)


def exact_holdout(df: DataFrame, key: str, n: int, out: str = "is_holdout") -> DataFrame:
    """Marks exactly ``n`` rows (all, when fewer) in md5 order of a unique key;
    the complement needs no anti join."""
    return flag_first_by_hash(df, key, n, (), out)


def hash_split(df: DataFrame, key: str, fraction: float, out: str = "part") -> DataFrame:
    """train/test by a stable hash of the key."""
    is_train = hash_bucket(F.col(key)) < int(round(fraction * 10_000))
    return df.withColumn(out, F.when(is_train, "train").otherwise("test"))


def stratified_split(
    df: DataFrame, label: str, key: str, test_fraction: float, out: str = "part", hashed: bool = False
) -> DataFrame:
    """Exactly floor(n_label * fraction) test rows per label, in md5 order (of ``key``, or ``key`` itself where ``hashed``)."""
    flagged = flag_first_by_hash(df, key, F.floor(F.col("_total") * F.lit(test_fraction)), [label], "_test", hashed)
    return flagged.withColumn(out, F.when(F.col("_test"), "test").otherwise("train")).drop("_test")


def group_split(df: DataFrame, group: str, fraction: float, out: str = "part") -> DataFrame:
    """Whole groups on one side: the hash is of the group key."""
    return hash_split(df, group, fraction, out)


def assign_folds(df: DataFrame, key: str, k: int, out: str = "fold") -> DataFrame:
    return df.withColumn(out, F.pmod(hash_bucket(F.col(key), 2**31), F.lit(k)).cast("int"))


def assign_stratified_folds(df: DataFrame, label: str, key: str, k: int, out: str = "fold") -> DataFrame:
    """Position of the key in md5 order within its label, modulo k: keys per
    label differ by at most one between folds, and a key's rows (also those of a
    null key) stay together.
    Only the distinct keys are ordered; the rows are joined to them."""
    keys = df.select(F.col(label).alias("_l"), F.col(key).alias("_k")).distinct().withColumn("_h", hash_order(F.col("_k")))
    ranked = positions(keys, ["_h", "_k"], "_pos", ["_l"]).select(
        "_l", "_k", F.pmod("_pos", F.lit(k)).cast("int").alias(out))
    same = F.col(label).eqNullSafe(F.col("_l")) & F.col(key).eqNullSafe(F.col("_k"))
    return df.join(ranked, same, "left").drop("_l", "_k")
