"""Merge -> clean -> standardise -> random-intercept models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tabloom.operators.encoding import fill_statistic
from tabloom.operators.filters import complete_cases
from tabloom.operators.joins import three_way_merge
from tabloom.operators.mixed import MixedFit, comparison_table, fit_random_intercept
from tabloom.operators.windows import standardize
from tabloom.session import settle


def prepare(
    base: DataFrame, left: DataFrame, left_key: str, inner: DataFrame, inner_key: str,
    outcome: str, impute: Sequence[str], scaled: Sequence[str],
) -> DataFrame:
    merged = three_way_merge(base, left, left_key, inner, inner_key)
    filled = fill_statistic(merged, impute, "mean", indicator=True) if impute else merged
    return standardize(complete_cases(filled, [outcome, *scaled]), scaled)


def fit_ladder(
    df: DataFrame, outcome: str, group: str, level1: Sequence[str], level2: Sequence[str]
) -> dict[str, MixedFit]:
    """Null model, + level 1, + level 2.  The rows are worked out and stored once for all passes of the three fits."""
    df = settle(df.select(*dict.fromkeys([group, outcome, *level1, *level2])))
    return {
        "null": fit_random_intercept(df, outcome, [], group),
        "level1": fit_random_intercept(df, outcome, level1, group),
        "level2": fit_random_intercept(df, outcome, [*level1, *level2], group),
    }


def variance_shares(fits: dict[str, MixedFit]) -> dict[str, float]:
    total = {k: f.var_group + f.var_resid for k, f in fits.items()}
    return {
        "level1": (total["null"] - total["level1"]) / total["null"],
        "level2": (total["level1"] - total["level2"]) / total["null"],
        "remaining": total["level2"] / total["null"],
    }


def refits(df: DataFrame, outcome: str, terms: Sequence[str], groups: Sequence[str],
           squares: Sequence[str] = (), products: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Nonlinear, interaction and other-grouping refits as one table."""
    from tabloom.operators.shaping import derived_columns

    fits = {}
    for g in groups:
        fits[f"linear|{g}"] = fit_random_intercept(df, outcome, terms, g)
    extra = derived_columns(df, squares=squares, products=products)
    if squares:
        fits["squares"] = fit_random_intercept(extra, outcome, [*terms, *[f"{c}_squared" for c in squares]], groups[0])
    if products:
        fits["products"] = fit_random_intercept(
            extra, outcome, [*terms, *[f"{a}_x_{b}" for a, b in products]], groups[0])
    return comparison_table(df.sparkSession, fits)
