"""Nearest-vector and fuzzy-name joins that are exact without a cross join.

Vectors.  A few base vectors act as pivots; each base vector belongs to the
cell of its nearest pivot.  Distances to the pivots bound the distance to
every cell (triangle inequality), so a query is sent only to the cells that
can hold one of its k nearest.  Cells are cut into slices of bounded size and
the queries of a crowded cell are salted, so every task sees a bounded block
against a bounded block and emits k rows per query, never the pairs.  Where the
bounds exclude little (vectors of many dimensions) cells that lie together make
one bundle, so that a row is copied for each bundle, not for each cell.  Inside
a block a single-precision product finds the few candidates that can matter;
these alone are scored and ordered in double precision.
"""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.numeric import norm
from tabloom.operators.ordered import top_per_group
from tabloom.session import settle

BLOCK_ROWS = 4096
PATTERN_ROWS, PATTERN_BYTES = 2_000, 16 << 20  # a pattern set that every task may hold
RINGS = 128
LEAST_PIVOTS, MOST_PIVOTS = 32, 1024
ROUTED_CELLS = 1 << 18  # (query, cell) pairs whose bounds are worked out at once
MOST_COPIES = 16  # cells that a query is sent to on average; beyond, cells are bundled
BUNDLE_ROWS = 1 << 16  # rows of a bundle that one task compares, at most
LEAST_BLOCKS = 8  # bundles and salts that the rows are cut into before blocks grow
QUERY_ROWS, BASE_ROWS, FIRST_ROWS = 4096, 2048, 512  # one product; the first one of a block is smaller
DIGITS = 6


def as_double(v: Column) -> Column:
    return v.cast("array<double>")


def unit(v: Column) -> Column:
    """Scaled to length 1 (a zero vector stays zero).  The length is spread to
    an array first, so it is computed once and not per element."""
    lengths = F.array_repeat(norm(v), F.size(v))
    return F.zip_with(v, lengths, lambda x, n: F.when(n == 0, F.lit(0.0)).otherwise(x / n))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    sq = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(sq, 0.0))


def _matrix(col: pd.Series) -> np.ndarray:
    return np.stack(col.to_numpy()).astype(np.float64, copy=False)


def _assign(base: DataFrame, pivots: np.ndarray, bundles: np.ndarray | None = None) -> DataFrame:
    """Adds the nearest pivot (or the bundle it is in) and the distance to it."""

    @F.pandas_udf("cell int, dist double")
    def to_pivot(v: pd.Series) -> pd.DataFrame:
        d = _distances(_matrix(v), pivots)
        cell = d.argmin(1)
        named = cell if bundles is None else bundles[cell]
        return pd.DataFrame({"cell": named.astype("int32"), "dist": d[np.arange(len(d)), cell]})

    return base.withColumn("_a", to_pivot("vec")).select("id", "vec", "_a.cell", "_a.dist")


def _cell_stats(assigned: DataFrame, centers: np.ndarray, need: int) -> dict[int, dict]:
    """Size, nearest and farthest member per cell, and upper bounds of its
    ``need`` smallest distances, from one grouped pass over distance rings
    (at most cells x RINGS rows reach the driver)."""
    width = max(float(_distances(centers, centers).max()) / (RINGS / 2), 1e-12)
    ring = F.least(F.floor(F.col("dist") / F.lit(width)), F.lit(RINGS - 1))
    rows = assigned.groupBy("cell", ring.alias("ring")).agg(
        F.count("*").alias("n"), F.min("dist").alias("lo"), F.max("dist").alias("hi")
    ).collect()
    stats: dict[int, dict] = {}
    for r in sorted(rows, key=lambda r: (r["cell"], r["ring"])):
        s = stats.setdefault(r["cell"], {"n": 0, "lo": r["lo"], "hi": r["hi"], "close": []})
        s["n"] += r["n"]
        s["lo"], s["hi"] = min(s["lo"], r["lo"]), max(s["hi"], r["hi"])
        s["close"] += [r["hi"]] * min(r["n"], need - len(s["close"]))
    return stats


def _bundles(centers: np.ndarray, stats: dict[int, dict], rows: int) -> np.ndarray:
    """For each pivot the number of its bundle: neighbours along the pivots' main direction, of about ``rows`` rows."""
    spread = centers - centers.mean(0)
    along = spread @ np.linalg.svd(spread, full_matrices=False)[2][0]
    order = np.argsort(along, kind="stable")
    sizes = np.array([stats[c]["n"] if c in stats else 0 for c in order.tolist()])
    out = np.empty(len(centers), np.int64)
    out[order] = (np.cumsum(sizes) - sizes) // max(rows, 1)
    return out


def _route(
    queries: DataFrame, centers: np.ndarray, stats: dict, need: int, probes: int | None, keep: list[str],
    bundles: np.ndarray | None = None,
) -> DataFrame:
    """One row per (query, cell or bundle it must visit), with the ``keep`` columns."""
    cells = np.array(sorted(stats))
    rmin = np.array([stats[c]["lo"] for c in cells])
    rmax = np.array([stats[c]["hi"] for c in cells])
    close = np.full((len(cells), need), np.inf)
    for i, c in enumerate(cells):
        close[i, : len(stats[c]["close"])] = stats[c]["close"]
    own = centers[cells]
    named = cells if bundles is None else bundles[cells]
    firsts = np.unique(named, return_index=True)[0]

    def visits(vectors: np.ndarray) -> list[np.ndarray]:
        d = _distances(vectors, own)
        if probes is not None:
            return list(named[np.argsort(d, axis=1)[:, :probes]])
        reach = (d[:, :, None] + close[None, :, :]).reshape(len(d), -1)
        limit = np.partition(reach, need - 1, axis=1)[:, need - 1] if reach.shape[1] >= need else np.inf
        below = np.maximum(d - rmax[None, :], rmin[None, :] - d)
        near = below <= np.reshape(limit, (-1, 1)) + 1e-5
        if bundles is None:
            return [cells[row] for row in near]
        met = np.stack([near[:, named == b].any(1) for b in firsts], axis=1)
        return [firsts[row] for row in met]

    step = max(1, ROUTED_CELLS // len(cells))

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for first in range(0, len(pdf), step):
                some = pdf.iloc[first: first + step]
                yield some[keep].assign(cells=[c.astype("int32") for c in visits(_matrix(some["vec"]))])

    fields = [queries.schema[c] for c in keep]
    shape = T.StructType([*fields, T.StructField("cells", T.ArrayType(T.IntegerType()))])
    # copies are made by Spark, row by row; Python holds each query once
    return queries.select("id", "vec").mapInPandas(go, shape).select(*keep, F.explode("cells").alias("cell"))


def _with_vector_key(df: DataFrame) -> DataFrame:
    """128 bits of hash per vector, to find exact copies without moving vectors."""
    return df.withColumn("_key", F.struct(F.xxhash64("vec").alias("a"), F.xxhash64(F.lit(7), F.col("vec")).alias("b")))


def _limit_copies(base: DataFrame, need: int) -> DataFrame:
    """At most ``need`` copies of one vector, those of highest id: with ties
    going to the higher id no other copy can be among a query's best ``need``."""
    keys = base.select("id", "_key")
    crowded = keys.groupBy("_key").agg(F.count("*").alias("n")).where(F.col("n") > need).select("_key")
    last = top_per_group(keys.join(crowded, "_key", "left_semi"), ["_key"], [F.desc("id")], need)
    cut = last.groupBy("_key").agg(F.min("id").alias("_cut"))
    return base.join(cut, "_key", "left").where(F.col("_cut").isNull() | (F.col("id") >= F.col("_cut"))).drop("_cut")


def nearest(
    queries: DataFrame,
    base: DataFrame,
    k: int,
    metric: str = "cosine",
    query_id: str = "id",
    query_vec: str = "vec",
    base_id: str = "id",
    base_vec: str = "vec",
    exclude_same_id: bool = False,
    pivots: int | None = None,
    probes: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The k best base vectors per query: (query_id, base_id, score, rank).

    ``score`` is the cosine, or minus the Euclidean distance, to 6 digits; ties
    go to the higher base id.  Exact by default; with ``probes`` only that many
    nearest cells are searched (faster, recall below 1).

    Copies of one vector are searched once: equal queries share one search and
    a base vector is kept at most ``k`` (+ 1) times, which loses no result.
    """
    shape = unit if metric == "cosine" else (lambda v: v)

    def prepared(df: DataFrame, key: str, vec: str) -> DataFrame:
        out = df.select(F.col(key).alias("id"), shape(as_double(F.col(vec))).alias("vec"))
        return _with_vector_key(out.where(F.col("vec").isNotNull()))

    need = k + int(exclude_same_id)
    if pivots is None:  # cells of about the square root of the rows, in a number that every task may hold
        pivots = min(MOST_PIVOTS, max(LEAST_PIVOTS, int(base.count() ** 0.5)))
    asked = prepared(queries, query_id, query_vec)
    q = asked.groupBy("_key").agg(F.min("id").alias("id"), F.any_value("vec").alias("vec"))
    b = prepared(base, base_id, base_vec)

    # fitted parameters: a bounded number of pivots and a few rows per cell.
    # The ids are chosen from the id column alone; only their vectors are read.
    ids = [r[0] for r in base.select(F.col(base_id).alias("id")).orderBy(F.xxhash64("id"), "id").limit(pivots).collect()]
    picked = b.where(F.col("id").isin(ids)).limit(4 * pivots).collect() if ids else []
    if not picked:
        empty = T.StructType([
            T.StructField("query_id", q.schema["id"].dataType), T.StructField("base_id", b.schema["id"].dataType),
            T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType())])
        return queries.sparkSession.createDataFrame([], empty)
    centers = np.unique(np.array([r["vec"] for r in picked], dtype=np.float64), axis=0)
    assigned = _assign(_limit_copies(b, need), centers)
    stats = _cell_stats(assigned, centers, need)
    asking = {r["cell"]: r["n"] for r in _route(q, centers, stats, need, probes, []).groupBy("cell").agg(
        F.count("*").alias("n")).collect()}
    bundles, rows = None, block_rows
    crowd = {c: -(-n // (4 * block_rows)) for c, n in asking.items()}
    if probes is None and sum(asking.values()) > MOST_COPIES * (n_queries := q.count()):
        held = sum(s["n"] for s in stats.values())
        rows = min(BUNDLE_ROWS, max(block_rows, -(-held // LEAST_BLOCKS)))
        salts = -(-n_queries // min(BUNDLE_ROWS, max(block_rows, -(-n_queries // LEAST_BLOCKS))))
        bundles = _bundles(centers, stats, rows)
        sizes = {int(b): sum(s["n"] for c, s in stats.items() if bundles[c] == b) for b in {bundles[c] for c in stats}}
        # its last cell may lift a bundle over the size; a cell alone may be far over it
        slices, crowd = {b: max(1, round(n / rows)) for b, n in sizes.items()}, dict.fromkeys(sizes, salts)
        assigned = _assign(_limit_copies(b, need), centers, bundles)
    else:
        slices = {c: -(-s["n"] // rows) for c, s in stats.items()}
    found = _search_blocks(
        _route(q.select("id", "vec"), centers, stats, need, probes, ["id", "vec"], bundles), assigned.drop("dist"),
        slices, crowd, need, metric)
    best = F.row_number().over(W.partitionBy("rep").orderBy(F.desc("score"), F.desc("base_id")))
    top = found.withColumn("rank", best).where(F.col("rank") <= need)
    lists = top.groupBy("rep").agg(
        F.sort_array(F.collect_list(F.struct("rank", "base_id", "score"))).alias("hits"))
    answers = q.select("_key", F.col("id").alias("rep")).join(lists, "rep").drop("rep")
    own = F.filter("hits", lambda h: h["base_id"] != F.col("id")) if exclude_same_id else F.col("hits")
    rows = asked.select("id", "_key").join(answers, "_key").select("id", F.slice(own, 1, k).alias("hits"))
    return rows.select(F.col("id").alias("query_id"), F.posexplode("hits").alias("_pos", "h")).select(
        "query_id", "h.base_id", "h.score", (F.col("_pos") + 1).alias("rank"))


def _search_blocks(
    routed: DataFrame, assigned: DataFrame, slices: dict[int, int], crowd: dict[int, int], need: int, metric: str
) -> DataFrame:
    """(rep, base_id, score): the best ``need`` of every bounded block pair."""
    cells = sorted(slices)

    def per_cell(table: dict[int, int]) -> Column:
        pairs = [F.lit(x) for c in cells for x in (int(c), int(table.get(c, 1)))]
        return F.element_at(F.create_map(*pairs), F.col("cell"))

    def upto(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    def spread(n: Column, seed: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(seed)), n.cast("long")).cast("int")

    left = routed.withColumn("salt", spread(per_cell(crowd), 1)).withColumn("part", upto(per_cell(slices)))
    right = assigned.withColumn("part", spread(per_cell(slices), 2)).withColumn("salt", upto(per_cell(crowd)))
    names = ["rep", "base_id", "score"]
    schema = T.StructType([
        T.StructField("rep", routed.schema["id"].dataType), T.StructField("base_id", assigned.schema["id"].dataType),
        T.StructField("score", T.DoubleType())])

    def block(lq: pd.DataFrame, rb: pd.DataFrame) -> pd.DataFrame:
        return best_of_block(lq, rb, need, metric)

    keys = ["cell", "part", "salt"]
    blocks = sum(slices[c] * crowd.get(c, 1) for c in cells)
    left, right = left.select("id", "vec", *keys), right.select("id", "vec", *keys)
    if blocks <= MOST_PIVOTS:  # few large blocks: work follows their number, not their bytes
        left, right = left.repartition(blocks, *keys), right.repartition(blocks, *keys)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(block, schema)


def best_of_block(asked: pd.DataFrame, held: pd.DataFrame, need: int, metric: str = "cosine") -> pd.DataFrame:
    """(rep, base_id, score): the best ``need`` of ``held`` (id, vec) for each row of ``asked``; equal scores by higher id."""
    names = ["rep", "base_id", "score"]
    if asked.empty or held.empty:
        return pd.DataFrame({n: [] for n in names})
    held = held.sort_values("id", ascending=False)
    qid, bid = asked["id"].to_numpy(), held["id"].to_numpy()
    qa, ba = _matrix(asked["vec"]), _matrix(held["vec"])
    parts = []
    for start in range(0, len(qa), QUERY_ROWS):
        rows = slice(start, start + QUERY_ROWS)
        at, base, score = _best_of_rows(qa[rows], ba, need, metric)
        parts.append(pd.DataFrame({"rep": qid[rows][at], "base_id": bid[base], "score": score + 0.0}))
    return pd.concat(parts)


def _first_of_each(at: np.ndarray, base: np.ndarray, score: np.ndarray, need: int, n: int) -> tuple:
    """The best ``need`` entries of each of ``n`` rows (equal scores by place), and each row's last such score."""
    order = np.lexsort((base, -score, at))
    at, base, score = at[order], base[order], score[order]
    begins = np.searchsorted(at, np.arange(n))
    keep = np.arange(len(at)) - begins[at] < need
    at, base, score = at[keep], base[keep], score[keep]
    ends = np.searchsorted(at, np.arange(n), side="right")
    full = np.bincount(at, minlength=n) >= need
    last = np.full(n, -np.inf)
    last[full] = score[ends[full] - 1]
    return at, base, score, last


def _best_of_rows(a: np.ndarray, b: np.ndarray, need: int, metric: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``a``, row of ``b``, score to 6 digits) of each row's best ``need``, ties to the earlier row of ``b``.

    A product in single precision, with a margin for its error and for what rounds to
    the same digits, tells which pairs can be among the best so far; they are scored exactly.
    """
    def exact(at: np.ndarray, base: np.ndarray) -> np.ndarray:
        if metric == "cosine":
            return np.round(np.einsum("ij,ij->i", a[at], b[base]), DIGITS)
        return -np.round(np.sqrt(np.square(a[at] - b[base]).sum(1)), DIGITS)

    top = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if not np.isfinite(top) or not np.isfinite(a).all() or not np.isfinite(b).all():
        s = np.round(a @ b.T if metric == "cosine" else -_distances(a, b), DIGITS)
        best = np.argsort(-s, axis=1, kind="stable")[:, :need]
        return np.repeat(np.arange(len(a)), best.shape[1]), best.ravel(), np.take_along_axis(s, best, 1).ravel()
    kind = np.float32 if 1e-12 < top < 1e12 else np.float64
    fast_a, fast_b = a.astype(kind), b.astype(kind)
    own, longest = np.sqrt((a * a).sum(1)), float(np.sqrt((b * b).sum(1).max()))
    less = ((b * b).sum(1) / 2.0).astype(kind)
    error = np.finfo(np.float32).eps * (4 * a.shape[1] + 64) * (own * longest + longest**2) + 1e-30
    digit = 2.0 * 10.0**-DIGITS
    at, base, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    last = np.full(len(a), -np.inf)
    first, width = 0, max(FIRST_ROWS, need)
    while first < len(b):
        near = fast_a @ fast_b[first: first + width].T
        if metric != "cosine":  # a b - b b / 2 falls as the distance grows
            near -= less[None, first: first + width]
        if metric == "cosine":
            least = last - digit - error
        else:
            reach = np.minimum(digit - last, own + longest + digit)  # no vector lies farther
            least = (own**2 - reach**2) / 2.0 - error
            least[np.isneginf(last)] = -np.inf
        if first == 0 and near.shape[1] > need:
            kth = np.partition(near, near.shape[1] - need, axis=1)[:, near.shape[1] - need]
            slack = digit + 2.0 * error
            if metric != "cosine":
                slack = 2.0 * error + digit * (own + longest + digit)
            least = kth - slack
        # rounded down, so that no candidate is lost to the comparison's precision
        bound = np.nextafter(least.astype(kind), kind(-np.inf))
        hits = np.flatnonzero(near >= bound[:, None])
        for part in np.array_split(hits, -(-len(hits) // (1 << 16)) or 1):
            row, column = np.divmod(part, near.shape[1])
            column += first
            at, base, score, last = _first_of_each(
                np.concatenate([at, row]), np.concatenate([base, column]), np.concatenate([score, exact(row, column)]), need, len(a))
        first += width
        width = min(max(BASE_ROWS, need), first)
    return at, base, score


def retrieval_accuracy(matches: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """Top-1 and top-k accuracy.  ``matches``: query_id, predicted, rank;
    ``truth``: query_id, true_id."""
    per = (
        truth.join(matches, "query_id", "left")
        .groupBy("query_id")
        .agg(
            F.max(F.coalesce(((F.col("rank") == 1) & (F.col("predicted") == F.col("true_id"))).cast("int"),
                             F.lit(0))).alias("hit1"),
            F.max(F.coalesce(((F.col("rank") <= k) & (F.col("predicted") == F.col("true_id"))).cast("int"),
                             F.lit(0))).alias("hitk"),
        )
    )
    return per.agg(
        F.count("*").alias("n_queries"),
        (F.avg("hit1") * 100.0).alias("top1_pct"),
        (F.avg("hitk") * 100.0).alias("topk_pct"),
    )


def score_extremes(queries: DataFrame, base: DataFrame, exclude_same_id: bool = False) -> DataFrame:
    """(query_id, max_score, min_score) of the cosine against all base vectors.

    The minimum is minus the best match of the negated query, so both ends use
    the pruned nearest join and no pair list exists.
    """
    best = nearest(queries, base, 1, exclude_same_id=exclude_same_id)
    flipped = queries.select("id", F.transform(as_double(F.col("vec")), lambda x: -x).alias("vec"))
    worst = nearest(flipped, base, 1, exclude_same_id=exclude_same_id)
    return best.select("query_id", F.col("score").alias("max_score")).join(
        worst.select("query_id", (-F.col("score")).alias("min_score")), "query_id"
    )


def max_pattern_similarity(df: DataFrame, vec: str, patterns: DataFrame, pattern_vec: str, out: str) -> DataFrame:
    """Best cosine against a pattern set.  A set proved small is one scalar subquery that every
    row is compared with, JVM-side; a larger one is searched by :func:`nearest` (to 6 digits)."""
    from tabloom.operators.joins import is_small

    shapes = patterns.select(unit(as_double(F.col(pattern_vec))).alias("vec")).where(F.col("vec").isNotNull())
    if is_small(shapes, PATTERN_ROWS, PATTERN_BYTES):
        table = shapes.agg(F.collect_list("vec")).scalar()
        v = F.col("_v")
        best = F.array_max(F.transform(
            "_patterns", lambda p: F.aggregate(F.zip_with(v, p, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        ))
        held = df.withColumns({"_v": as_double(F.col(vec)), "_patterns": table})
        return held.withColumn(out, F.try_divide(best, norm(v))).drop("_v", "_patterns")
    # numbers are given once and stored, so that they mean the same rows in both uses
    rows = settle(df.withColumn("_row", F.monotonically_increasing_id()))
    base = settle(shapes.distinct().withColumn("id", F.monotonically_increasing_id()))
    asked = rows.where(norm(as_double(F.col(vec))) > 0).select(F.col("_row").alias("id"), F.col(vec).alias("vec"))
    found = nearest(asked, base, 1).select(F.col("query_id").alias("_row"), F.col("score").alias(out))
    return rows.join(found, "_row", "left").drop("_row")


def knn_vote(matches: DataFrame, labels: DataFrame) -> DataFrame:
    """Majority label of the neighbours, smallest label on ties.
    ``labels``: base_id, label."""
    votes = matches.join(labels, "base_id").groupBy("query_id", "label").agg(F.count("*").alias("votes"))
    return votes.groupBy("query_id").agg(
        F.min_by(F.struct("label", "votes"), F.struct(-F.col("votes"), F.col("label"))).alias("w")
    ).select("query_id", F.col("w.label").alias("predicted"), F.col("w.votes").alias("votes"))


def knn_mean(matches: DataFrame, values: DataFrame) -> DataFrame:
    """Mean neighbour value.  ``values``: base_id, value."""
    return matches.join(values, "base_id").groupBy("query_id").agg(F.avg("value").alias("predicted"))


# -- names --------------------------------------------------------------------


def close_names(
    queries: DataFrame, names: DataFrame, n: int = 3, cutoff: float = 0.6, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Top ``n`` close matches per distinct name: (name, match, ratio, rank).

    Matching characters cannot exceed the shorter length, so a ratio of at
    least ``cutoff`` bounds the other length to a band: a query visits only the
    lengths inside it.  Lengths are cut into bounded slices; each block emits
    at most ``n`` rows per query.
    """
    q = queries.select(F.col(queries.columns[0]).alias("name")).where(F.length("name") > 0).distinct()
    base = names.select(F.col(names.columns[0]).alias("match")).where(F.length("match") > 0).distinct()
    base = base.withColumn("len", F.length("match"))
    sizes = {r["len"]: r["n"] for r in base.groupBy("len").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return queries.sparkSession.createDataFrame([], "name string, match string, ratio double, rank int")
    cut = F.create_map(*[F.lit(x) for k, v in sorted(sizes.items()) for x in (k, -(-v // block_rows))])
    lens = F.array(*[F.lit(k) for k in sorted(sizes)])
    own = F.length("name")
    band = F.filter(lens, lambda m: F.least(m, own) * 2.0 / (m + own) >= cutoff)
    left = q.withColumn("len", F.explode(band)).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.element_at(cut, F.col("len")) - 1))
    )
    crowd = {r["len"]: -(-r["n"] // block_rows) for r in left.where(F.col("part") == 0).groupBy("len").agg(
        F.count("*").alias("n")).collect()}
    salts = F.create_map(*[F.lit(x) for k in sorted(sizes) for x in (k, crowd.get(k, 1))])
    left = left.withColumn(
        "salt", F.pmod(F.xxhash64("name"), F.element_at(salts, F.col("len")).cast("long")).cast("int"))
    right = base.withColumn(
        "part", F.pmod(F.xxhash64("match"), F.element_at(cut, F.col("len")).cast("long")).cast("int")
    ).withColumn("salt", F.explode(F.sequence(F.lit(0), F.element_at(salts, F.col("len")) - 1)))

    def block(lq: pd.DataFrame, rb: pd.DataFrame) -> pd.DataFrame:
        pool = rb["match"].tolist()
        found = []
        for name in lq["name"]:
            for m in difflib.get_close_matches(name, pool, n, cutoff):
                found.append((name, m, difflib.SequenceMatcher(None, m, name).ratio()))
        return pd.DataFrame(found, columns=["name", "match", "ratio"])

    keys = ["len", "part", "salt"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        block, "name string, match string, ratio double"
    )
    w = W.partitionBy("name").orderBy(F.desc("ratio"), F.desc("match"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def phonetic_matches(queries: DataFrame, names: DataFrame) -> DataFrame:
    """(name, match) for distinct names whose phonetic codes agree."""
    from tabloom.functions.text import phonetic_code
    from tabloom.operators.joins import dimension_join

    q = queries.select(F.col(queries.columns[0]).alias("name")).where(F.length("name") > 0).distinct()
    base = names.select(F.col(names.columns[0]).alias("match")).where(F.length("match") > 0).distinct()
    q = q.withColumn("code", phonetic_code(F.col("name")))
    return dimension_join(q, base.withColumn("code", phonetic_code(F.col("match"))), ["code"])


def phonetic_classes(queries: DataFrame, names: DataFrame) -> DataFrame:
    """(name, code, n_matches, first_match): how many of ``names`` share each query's code, and the smallest.

    One row per query whatever the size of a code's class; :func:`phonetic_matches` spells out the pairs.
    """
    from tabloom.functions.text import phonetic_code
    from tabloom.operators.joins import dimension_join

    q = queries.select(F.col(queries.columns[0]).alias("name")).where(F.length("name") > 0).distinct()
    base = names.select(F.col(names.columns[0]).alias("match")).where(F.length("match") > 0).distinct()
    classes = base.groupBy(phonetic_code(F.col("match")).alias("code")).agg(
        F.count("*").alias("n_matches"), F.min("match").alias("first_match"))
    found = dimension_join(q.withColumn("code", phonetic_code(F.col("name"))), classes, ["code"], "left")
    return found.select("name", "code", F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"), "first_match")


def similar_names(queries: DataFrame, names: DataFrame, prefix_fallback: bool = True) -> DataFrame:
    """(name, match, how): same phonetic code; else close matches; else (male
    list only in the original rule) the first four letters."""
    q = queries.select(F.col(queries.columns[0]).alias("name")).where(F.length("name") > 0).distinct()
    same = phonetic_matches(q, names).select("name", "match", F.lit("phonetic").alias("how"))
    rest = q.join(same.select("name").distinct(), "name", "left_anti")
    close = close_names(rest, names).select("name", "match", F.lit("close").alias("how"))
    out = same.unionByName(close)
    if prefix_fallback:
        last = rest.join(close.select("name").distinct(), "name", "left_anti")
        out = out.unionByName(last.select("name", F.substring("name", 1, 4).alias("match"), F.lit("prefix").alias("how")))
    return out


def _cut(length: Column, t: int) -> list[tuple[Column, Column]]:
    """(first place, length) of the t + 1 even segments of a name; the last ones take what is left over."""
    short = F.floor(length / (t + 1)).cast("int")
    longer = length - short * (t + 1)  # so many segments, the last ones, are one letter longer
    out = []
    for i in range(t + 1):
        before = F.greatest(F.lit(i) - (F.lit(t + 1) - longer), F.lit(0))
        out.append((short * i + before + 1, short + F.when(F.lit(i) >= F.lit(t + 1) - longer, 1).otherwise(0)))
    return out


def edit_matches(queries: DataFrame, names: DataFrame, t: int = 2) -> DataFrame:
    """(name, match, distance) for all distinct names within edit distance ``t``; exact and JVM-side.

    A name is cut into t + 1 segments; t edits leave at least one of them as it is,
    at most t places away. Names are indexed by (length, segment number, segment), a
    query looks up its substrings at those places for every length within t of its
    own, and only names found so are compared, by a distance that stops at t. Names
    too short to be cut share one entry per length. A crowded entry is dealt over
    salts (or sent to the queries when the index is small).
    """
    from tabloom.operators.joins import dimension_join

    q = queries.select(F.col(queries.columns[0]).alias("name")).where(F.length("name") > 0).distinct()
    base = names.select(F.col(names.columns[0]).alias("match")).where(F.length("match") > 0).distinct()
    empty, whole = F.lit(""), F.lit(-1)
    size = F.length("match")

    def entry(place: Column, text: Column) -> Column:
        return F.struct(place.cast("int").alias("part"), text.alias("segment"))

    own = [entry(F.lit(i), F.substr("match", at, n)) for i, (at, n) in enumerate(_cut(size, t))]
    index = base.select("match", size.alias("len"), F.explode(
        F.when(size > t, F.array(*own)).otherwise(F.array(entry(whole, empty)))).alias("e")).select("match", "len", "e.*")

    def substrings(part: int, at: Column, n: Column) -> Column:
        """Entries of the query's substrings of length ``n`` up to t places from ``at``."""
        first, last = F.greatest(at - t, F.lit(1)).cast("int"), F.least(at + t, F.col("_q") - n + 1).cast("int")
        places = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda p: entry(F.lit(part), F.substr("name", p, n)))

    # every length a match can have, then every place a segment of such a name can be at
    lens = F.sequence(F.greatest(F.length("name") - t, F.lit(1)), F.length("name") + t)
    asked = q.select("name", F.length("name").alias("_q"), F.explode(lens).alias("len"))
    looked = [substrings(i, at, n) for i, (at, n) in enumerate(_cut(F.col("len"), t))]
    parts = F.when(F.col("len") > t, F.array_distinct(F.concat(*looked))).otherwise(F.array(entry(whole, empty)))
    asked = asked.select("name", "len", F.explode(parts).alias("e")).select("name", "len", "e.*")
    met = dimension_join(asked, index, ["len", "part", "segment"])
    near = met.withColumn("distance", F.levenshtein("name", "match", t)).where(F.col("distance") >= 0)
    return near.select("name", "match", "distance").distinct()
