"""Pairwise-complete correlations of any number of columns from one scan.

Every task adds up, for its rows, what all pairs of columns need: how many rows
know both, and the sums, squares and products over just those rows. With values
(0 where missing) and presence (0/1) as matrices these are four matrix products per
batch, done by column block so that a batch's temporary arrays stay small. Tasks
emit one row per pair, which Spark sums by pair with map-side combine. Values are
shifted by a few rows' mean and scaled first, so the squares keep their digits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.session import settle

SHIFT_ROWS = 1000  # rows that choose the shift; it changes rounding only
BLOCK_COLS = 256
BATCH_CELLS = 1 << 21  # cells of a batch worked on at once
FLAT = 1e-13  # share of a sum of squares below which a variance is rounding

SUMS = ("n", "sa", "sb", "saa", "sbb", "sab", "bad")
SUMS_DDL = "i int, j int, " + ", ".join(f"{s} double" for s in SUMS) + ", lo double, hi double"


def _finite(c: str) -> Column:
    x = F.col(c)
    return F.when(F.abs(x) < float("inf"), x)  # neither null, NaN nor infinite


def _shifts(values: DataFrame, cols: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """A place and a width of each column, from its first rows."""
    some = values.limit(SHIFT_ROWS)
    row = some.agg(*[F.avg(_finite(c)) for c in cols], *[F.max(F.abs(_finite(c))) for c in cols]).first()
    at = np.array([x or 0.0 for x in row[: len(cols)]])
    wide = np.array([x or 1.0 for x in row[len(cols):]])
    return at, wide


class _Totals:
    """Running sums of one task, by column block."""

    def __init__(self, p: int) -> None:
        self.p = p
        self.sums = {s: np.zeros((p, p)) for s in ("n", "sum", "square", "product", "bad")}
        self.lo, self.hi = np.full(p, np.inf), np.full(p, -np.inf)

    def add(self, x: np.ndarray, known: np.ndarray) -> None:
        """``x``: values, anything where not ``known``."""
        with np.errstate(invalid="ignore"):
            odd = known & ~np.isfinite(x)
        good = known & ~odd
        self.lo = np.minimum(self.lo, np.where(good, x, np.inf).min(0))
        self.hi = np.maximum(self.hi, np.where(good, x, -np.inf).max(0))
        x = np.where(good, x, 0.0)
        whole = bool(good.all())
        m = good.astype(np.float64)
        for first in range(0, self.p, BLOCK_COLS):
            cut = slice(first, first + BLOCK_COLS)
            part, square = x[:, cut], x[:, cut] ** 2
            self.sums["product"][cut] += part.T @ x
            if whole:  # every pair is known in every row
                self.sums["n"][cut] += len(x)
                self.sums["sum"][cut] += part.sum(0)[:, None]
                self.sums["square"][cut] += square.sum(0)[:, None]
            else:
                self.sums["n"][cut] += m[:, cut].T @ m
                self.sums["sum"][cut] += part.T @ m
                self.sums["square"][cut] += square.T @ m
        if odd.any():
            both = odd.astype(np.float64).T @ known.astype(np.float64)
            self.sums["bad"] += both + both.T

    def rows(self) -> Iterator[pa.RecordBatch]:
        s = self.sums
        for i in range(self.p):
            j = np.arange(i, self.p)
            parts = [np.full(len(j), i, np.int32), j.astype(np.int32), s["n"][i, i:], s["sum"][i, i:], s["sum"][i:, i],
                     s["square"][i, i:], s["square"][i:, i], s["product"][i, i:], s["bad"][i, i:]]
            edge = [np.where(j == i, e[i], np.nan) for e in (self.lo, self.hi)]
            arrays = [pa.array(np.ascontiguousarray(a)) for a in parts] + [pa.array(e, from_pandas=True) for e in edge]
            yield pa.RecordBatch.from_arrays(arrays, ["i", "j", *SUMS, "lo", "hi"])


def gram_sums(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(i, j, n, sa, sb, saa, sbb, sab, bad, lo, hi) for each pair i <= j of ``cols`` by number.

    Sums run over rows where both values are known; ``bad`` counts rows where one
    of them is NaN or infinite; ``lo`` and ``hi`` are a column's range (i = j).
    """
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(cols)])
    at, wide = _shifts(values, values.columns)
    p = len(cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, step = _Totals(p), max(1, BATCH_CELLS // p)
        for batch in batches:
            for first in range(0, batch.num_rows, step):
                piece = batch.slice(first, step)
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in piece.columns])
                known = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in piece.columns])
                totals.add((x - at) / wide, known)
        yield from totals.rows()

    rows = values.mapInArrow(run, SUMS_DDL)
    return rows.groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in SUMS], F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, r) for each pair of varying ``cols`` in their order; null where the rows that know both
    show no variance, NaN where one of their values is NaN or infinite. One scan of ``df``."""
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], "a string, b string, r double")
    sums = settle(gram_sums(df, cols))
    # one row per column reaches the driver
    ranges = sums.where("i = j").select("i", F.coalesce((F.col("lo") < F.col("hi")) | (F.col("bad") > 0), F.lit(False)).alias("v")).collect()
    varying = [r["i"] for r in ranges if r["v"]]
    n = F.col("n")
    va = F.col("saa") - F.try_divide(F.col("sa") * F.col("sa"), n)
    vb = F.col("sbb") - F.try_divide(F.col("sb") * F.col("sb"), n)
    cov = F.col("sab") - F.try_divide(F.col("sa") * F.col("sb"), n)
    r = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cov / F.sqrt(va * vb)))
    r = F.when(F.col("bad") > 0, F.lit(float("nan"))).when(
        (va > F.col("saa") * FLAT) & (vb > F.col("sbb") * FLAT), r)
    names = F.array(*[F.lit(c) for c in cols])
    pairs = sums.where((F.col("i") < F.col("j")) & F.col("i").isin(varying) & F.col("j").isin(varying))
    return pairs.select(F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), r.alias("r"))


def moment_points(df: DataFrame, vec: str, label: str, group: str) -> DataFrame | None:
    """(vec, label, group, weight): a few weighted rows for each whole-numbered ``group`` that have the
    group's count, means, variances and covariances of the vector's values and the label, from one scan.

    Whatever follows from those sums alone, as least squares and its squared errors do, is the same on the
    points as on the rows. A group of p values has 2 (p + 1) points, on both sides of the mean; a row without
    a group counts in group -1. None where a value is null, NaN or infinite.
    """
    rows = df.select(F.coalesce(F.col(group).cast("int"), F.lit(-1)).alias("g"), vector_to_array(vec).alias("x"),
                     F.col(label).cast("double").alias("y"))

    def matrix(x: pa.Array, y: pa.Array) -> np.ndarray:
        z = np.column_stack([x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1), y.to_numpy(zero_copy_only=False)])
        return z.astype(np.float64)

    some = rows.limit(SHIFT_ROWS).toArrow().combine_chunks()
    if not some.num_rows:
        return None
    first = matrix(some["x"].combine_chunks(), some["y"].combine_chunks())
    if not np.isfinite(first).all():
        return None
    at, wide = first.mean(0), np.maximum(np.abs(first).max(0), np.finfo(np.float64).tiny)
    p = len(at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                g, z = batch.column(0).to_numpy(), (matrix(batch.column(1), batch.column(2)) - at) / wide
                z = np.column_stack([z, np.ones(len(z))])
                for k in np.unique(g).tolist():
                    part = z[g == k]
                    sums[k] = sums.get(k, 0.0) + part.T @ part
        i, j = (a.ravel().astype(np.int32) for a in np.indices((p + 1, p + 1)))
        for k, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), k, np.int32)), pa.array(i), pa.array(j), pa.array(total.ravel())],
                                             ["g", "i", "j", "s"])

    totals: dict[int, np.ndarray] = {}
    # (p + 1)^2 rows per group reach the driver
    for r in rows.mapInArrow(run, "g int, i int, j int, s double").groupBy("g", "i", "j").agg(F.sum("s").alias("s")).collect():
        totals.setdefault(r["g"], np.zeros((p + 1, p + 1)))[r["i"], r["j"]] = r["s"]
    points = []
    for k, total in sorted(totals.items()):
        if not np.isfinite(total).all():
            return None
        n, mean = total[p, p], total[p, :p] / total[p, p]
        power, axes = np.linalg.eigh(total[:p, :p] / n - np.outer(mean, mean))
        steps = np.sqrt(np.maximum(power, 0.0) * p) * axes
        for z in (*(mean + steps.T), *(mean - steps.T)):
            place = (z * wide + at).tolist()
            points.append((place[:-1], place[-1], k, float(n / (2 * p))))
    found = df.sparkSession.createDataFrame(points, "x array<double>, y double, g int, weight double").coalesce(1)
    return found.select(array_to_vector("x").alias(vec), F.col("y").alias(label), F.col("g").alias(group), "weight")
