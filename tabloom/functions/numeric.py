"""Numeric, array and scoring expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pay-unit spellings and the factor that makes each yearly.
PAY_FACTORS = {
    "hr": 2000.0, "Hour": 2000.0,
    "wk": 50.0, "Week": 50.0,
    "mth": 12.0, "Month": 12.0,
    "bi": 25.0, "Bi-Weekly": 25.0,
    "yr": 1.0, "Year": 1.0,
}


def number(x: Column) -> Column:
    """Text or number to double; anything unreadable becomes null."""
    return x.try_cast("double")


def yearly_amount(amount: Column, unit: Column) -> Column:
    """Comma-grouped amount text per pay unit -> yearly double (unknown unit: as is)."""
    value = F.replace(amount, F.lit(","), F.lit("")).try_cast("double")
    factor = F.lit(1.0)
    for spelling, f in PAY_FACTORS.items():
        factor = F.when(unit == spelling, F.lit(f)).otherwise(factor)
    return value * factor


def yearly_unit(unit: Column) -> Column:
    return F.when(unit.isin(*PAY_FACTORS), F.lit("Year")).otherwise(unit)


def bin_label(x: Column, edges: Sequence[float], labels: Sequence[str], right: bool = False) -> Column:
    """Interval label; left-closed by default, right-closed with ``right``.
    Outside the edges (and null) gives null."""
    out = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels, strict=True):
        inside = (x > lo) & (x <= hi) if right else (x >= lo) & (x < hi)
        out = F.when(inside, F.lit(label)) if out is None else out.when(inside, F.lit(label))
    return out


def open_bin(x: Column, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Open-ended cases below each bound; the last label also takes nulls."""
    out = None
    for bound, label in zip(bounds, labels[:-1], strict=True):
        out = F.when(x < bound, F.lit(label)) if out is None else out.when(x < bound, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def boxcox1p(x: Column, lam: float = 0.15) -> Column:
    return F.log1p(x) if lam == 0 else (F.pow(x + 1.0, F.lit(lam)) - 1.0) / F.lit(lam)


def decide(rules: Sequence[tuple[Column, object]], default: object) -> Column:
    """Rule scoring where the last matching rule wins over earlier ones."""
    out = F.lit(default)
    for cond, label in rules:
        out = F.when(F.coalesce(cond, F.lit(False)), F.lit(label)).otherwise(out)
    return out


def confidence(p: Column) -> Column:
    return F.abs(p - 0.5) * 2.0


def label_at(p: Column, threshold: float | Column) -> Column:
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return (p >= t).cast("int")


def parse_vector(x: Column) -> Column:
    """``"[0.1, 0.2]"`` -> array<double>."""
    return F.from_json(x, "array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, v: s + v * v))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def vector_stats(v: Column) -> dict[str, Column]:
    """mean, population std, max, min and dimension of an array."""
    n = F.size(v).cast("double")
    total = F.aggregate(v, F.lit(0.0), lambda s, x: s + x)
    mean = F.try_divide(total, n)
    spread = F.aggregate(
        v, F.struct(F.lit(0.0).alias("s"), mean.alias("m")),
        lambda acc, x: F.struct((acc["s"] + (x - acc["m"]) * (x - acc["m"])).alias("s"), acc["m"].alias("m")),
    )["s"]
    return {
        "vec_mean": mean,
        "vec_std": F.sqrt(F.try_divide(spread, n)),
        "vec_max": F.array_max(v),
        "vec_min": F.array_min(v),
        "vec_dim": F.size(v),
    }


def hash_bucket(key: Column, buckets: int = 10_000) -> Column:
    """Stable bucket from md5 of the key text; other engines can repeat it."""
    head = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(head, F.lit(buckets))


def hash_order(key: Column) -> Column:
    """A repeatable shuffle order for sampling."""
    return F.md5(key.cast("string"))


def effect_size(r2_full: Column, r2_reduced: Column) -> Column:
    """Cohen's f squared."""
    return F.try_divide(r2_full - r2_reduced, 1.0 - r2_full)


def effect_label(f2: Column) -> Column:
    return (
        F.when(f2 < 0.02, "negligible").when(f2 < 0.15, "small").when(f2 < 0.35, "medium").otherwise("large")
    )


def gaussian_log_likelihood(residual_squares: Column, n: Column) -> Column:
    """Log likelihood of a linear model at its best variance; null without residuals."""
    variance = F.try_divide(residual_squares, n)
    return F.when(variance > 0, -n / 2.0 * (F.log(variance * (2.0 * math.pi)) + 1.0))


def likelihood_r2(ll_model: Column, ll_null: Column) -> Column:
    """Pseudo R2 by likelihoods: 1 - model / null."""
    return 1.0 - F.try_divide(ll_model, ll_null)


def variance_r2(fitted_variance: Column, total_variance: Column) -> Column:
    """Pseudo R2 by variances: the fitted values' share."""
    return F.try_divide(fitted_variance, total_variance)
