"""Approximate nearest vectors of large x large sets: hashed join, re-ranked exactly.

Each of several tables cuts the sphere by random planes; a unit vector's signs are
its bucket. The number of planes follows the size of the base, so a bucket holds
about BUCKET_ROWS vectors at any size, and a query looks into a fixed number of
buckets: its own and those behind the planes it lies closest to. Work per row
therefore does not grow with the table. Inside a bucket scores are exact; what is
approximate is only which vectors are met. A crowded bucket is cut into slices of
bounded size and its queries are dealt over salts, so no task sees more than a
block against a block. Recall against the exact join is to be measured, see
:func:`recall`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.operators.joins import dimension_join
from tabloom.operators.similarity import BLOCK_ROWS, _limit_copies, _matrix, _with_vector_key, as_double, best_of_block, unit
from tabloom.session import settle

TABLES = 12
PROBES = 12
BUCKET_ROWS = 512
CODED_ROWS = 1024  # vectors whose buckets are worked out at once; each takes some 20 kB meanwhile
NEAR_PLANES = 6  # planes whose crossings are probed, at most
SEED = 7


def plane_count(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    return int(max(0, np.ceil(np.log2(max(rows, 1) / bucket_rows))))


def planes_for(tables: int, bits: int, dims: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(tables, bits, dims))


def bucket_codes(vectors: np.ndarray, planes: np.ndarray, probes: int) -> np.ndarray:
    """(vectors, tables, probes) bucket numbers: the own one first, then by how little is crossed."""
    tables, bits, _ = planes.shape
    if not bits:
        return np.zeros((len(vectors), tables, 1), np.int64) + np.arange(tables)[None, :, None]
    side = np.einsum("nd,tbd->ntb", vectors, planes)
    own = ((side > 0) * (1 << np.arange(bits))).sum(2)
    own += np.arange(tables)[None, :] << bits
    if probes == 1:
        return own[:, :, None]
    close = min(bits, NEAR_PLANES)
    order = np.argsort(np.abs(side), axis=2)[:, :, :close]
    margin = np.take_along_axis(side, order, 2) ** 2
    subsets = (np.arange(1 << close)[:, None] >> np.arange(close)) & 1
    crossed = np.argsort(margin @ subsets.T, axis=2, kind="stable")[:, :, :probes]
    flips = np.einsum("ntpc,ntc->ntp", subsets[crossed], 1 << order)
    return own[:, :, None] ^ flips


def _coded(df: DataFrame, planes: np.ndarray, probes: int) -> DataFrame:
    """(id, vec, cell): one row for each bucket of a vector; Python holds each vector once, Spark copies it row by row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for first in range(0, len(pdf), CODED_ROWS):
                some = pdf.iloc[first: first + CODED_ROWS]
                yield some.assign(cells=list(bucket_codes(_matrix(some["vec"]), planes, probes).reshape(len(some), -1)))

    shape = T.StructType([df.schema["id"], df.schema["vec"], T.StructField("cells", T.ArrayType(T.LongType()))])
    return df.select("id", "vec").mapInPandas(run, shape).select("id", "vec", F.explode("cells").alias("cell"))


def _crowded(coded: DataFrame, block_rows: int, out: str) -> DataFrame:
    """(cell, out): into how many pieces the rows of a bucket over ``block_rows`` are cut."""
    sizes = coded.groupBy("cell").agg(F.count("*").alias("n"))
    return settle(sizes.where(F.col("n") > block_rows).select("cell", F.ceil(F.col("n") / block_rows).cast("int").alias(out)))


def hashed_nearest(
    queries: DataFrame, base: DataFrame, k: int, query_id: str = "id", query_vec: str = "vec", base_id: str = "id",
    base_vec: str = "vec", exclude_same_id: bool = False, tables: int = TABLES, probes: int = PROBES,
    bucket_rows: int = BUCKET_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The k best base vectors by cosine that share a probed bucket: (query_id, base_id, score, rank).

    Scores are exact, to 6 digits, ties go to the higher base id; a neighbour can
    be missed, never invented. Equal queries share one search, and of equal base
    vectors at most ``k`` (+ 1) are kept. Rows without a vector are left out.
    """
    def prepared(df: DataFrame, key: str, vec: str) -> DataFrame:
        out = df.select(F.col(key).alias("id"), unit(as_double(F.col(vec))).alias("vec"))
        return _with_vector_key(out.where(F.col("vec").isNotNull()))

    need = k + int(exclude_same_id)
    asked, held = prepared(queries, query_id, query_vec), prepared(base, base_id, base_vec)
    shape = T.StructType([T.StructField("query_id", asked.schema["id"].dataType), T.StructField("base_id", held.schema["id"].dataType),
                          T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType())])
    size = held.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("d")).first()
    if not size["n"]:
        return queries.sparkSession.createDataFrame([], shape)
    planes = planes_for(tables, plane_count(size["n"], bucket_rows), size["d"])
    single = asked.groupBy("_key").agg(F.min("id").alias("id"), F.any_value("vec").alias("vec"))
    left = _coded(single, planes, probes)
    right = _coded(_limit_copies(held, need), planes, 1)
    slices, salts = _crowded(right, block_rows, "slices"), _crowded(left, block_rows, "salts")

    def marked(df: DataFrame) -> DataFrame:
        for extra, name in ((slices, "slices"), (salts, "salts")):
            df = dimension_join(df, extra, ["cell"], "left").withColumn(name, F.coalesce(name, F.lit(1)))
        return df

    def dealt(n: str, seed: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.col(n)).cast("int")

    def copied(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    keys = ["cell", "slice", "salt"]
    left = marked(left).withColumn("salt", dealt("salts", 1)).withColumn("slice", copied("slices")).select("id", "vec", *keys)
    right = marked(right).withColumn("slice", dealt("slices", 2)).withColumn("salt", copied("salts")).select("id", "vec", *keys)
    pair = T.StructType([T.StructField("rep", single.schema["id"].dataType), T.StructField("base_id", held.schema["id"].dataType),
                         T.StructField("score", T.DoubleType())])
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(lambda asked, held: best_of_block(asked, held, need), pair)
    # a neighbour met in several tables counts once; lists hold tables x probes x need entries at most
    hits = found.groupBy("rep").agg(F.slice(F.sort_array(F.collect_set(F.struct("score", "base_id")), asc=False), 1, need).alias("hits"))
    answers = single.select("_key", F.col("id").alias("rep")).join(hits, "rep").drop("rep")
    own = F.filter("hits", lambda h: h["base_id"] != F.col("id")) if exclude_same_id else F.col("hits")
    rows = asked.select("id", "_key").join(answers, "_key").select("id", F.slice(own, 1, k).alias("hits"))
    return rows.select(F.col("id").alias("query_id"), F.posexplode("hits").alias("_pos", "h")).select(
        "query_id", "h.base_id", "h.score", (F.col("_pos") + 1).alias("rank"))


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(query_id, n_exact, n_found): how many of each query's exact neighbours were found.

    A vector as good as the last exact one counts as found, whichever of them the
    ids happened to pick.
    """
    floor = exact.groupBy("query_id").agg(F.count("*").alias("n_exact"), F.min("score").alias("floor"))
    good = found.join(floor, "query_id").where(F.col("score") >= F.col("floor")).groupBy("query_id").agg(F.count("*").alias("n_found"))
    return floor.join(good, "query_id", "left").select(
        "query_id", "n_exact", F.coalesce("n_found", F.lit(0)).cast("long").alias("n_found"))
