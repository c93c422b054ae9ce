"""Random-intercept model from grouped sufficient statistics.

y = X b + u_group + e.  With n_g, s_g = sum X and t_g = sum y per group, the
profile REML over the ratio lam = var_u / var_e needs only sums over groups of
w(n_g) s s', w(n_g) s t and w(n_g) t^2 with w(n) = lam / (1 + n lam).  The
weight depends on the group size alone, so groups are first folded by size:
one pass over the rows, one over the groups, then a small table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.evaluation import normal_p
from tabloom.session import settle


@dataclass
class MixedFit:
    names: list[str]
    coef: np.ndarray
    se: np.ndarray
    var_group: float
    var_resid: float
    n: int
    groups: int
    ll_reml: float
    ll_ml: float
    group: str
    outcome: str
    p_values: list[float] = field(default_factory=list)

    @property
    def icc(self) -> float:
        return self.var_group / (self.var_group + self.var_resid)

    @property
    def aic(self) -> float:
        return -2 * self.ll_ml + 2 * (len(self.names) + 2)

    @property
    def bic(self) -> float:
        return -2 * self.ll_ml + math.log(self.n) * (len(self.names) + 2)


def _fold_by_size(df: DataFrame, y: str, xs: Sequence[str], group: str, centre: dict[str, float]) -> DataFrame:
    cols = {f"x{i + 1}": F.col(c).cast("double") - F.lit(centre[c]) for i, c in enumerate(xs)}
    z = df.select(F.col(group).alias("g"), F.lit(1.0).alias("x0"), *[v.alias(k) for k, v in cols.items()],
                  (F.col(y).cast("double") - F.lit(centre[y])).alias("y"))
    names = ["x0", *cols, "y"]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    # within-group products are only needed in total, so they ride along per group
    per = z.groupBy("g").agg(
        F.count("*").alias("n"),
        *[F.sum(a).alias(f"s_{a}") for a in names],
        *[F.sum(F.col(a) * F.col(b)).alias(f"q_{a}_{b}") for a, b in pairs],
    )
    return per.groupBy("n").agg(
        F.count("*").alias("groups"),
        *[F.sum(F.col(f"s_{a}") * F.col(f"s_{b}")).alias(f"p_{a}_{b}") for a, b in pairs],
        *[F.sum(f"q_{a}_{b}").alias(f"q_{a}_{b}") for a, b in pairs],
    )


def _sums(folded: DataFrame, lams: Sequence[float], names: Sequence[str]):
    """Per lam: cross-product matrix of [X y] under V^-1, and sum ln(1+n lam)."""
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    grid = folded.withColumn("lam", F.explode(F.array(*[F.lit(float(v)) for v in lams])))
    w = F.col("lam") / (1.0 + F.col("n") * F.col("lam"))
    rows = grid.groupBy("lam").agg(
        F.sum(F.col("groups") * F.log1p(F.col("n") * F.col("lam"))).alias("logdet"),
        *[F.sum(F.col(f"q_{a}_{b}") - w * F.col(f"p_{a}_{b}")).alias(f"m_{a}_{b}") for a, b in pairs],
    ).collect()
    out = {}
    for r in rows:
        m = np.zeros((len(names), len(names)))
        for a, b in pairs:
            i, j = names.index(a), names.index(b)
            m[i, j] = m[j, i] = r[f"m_{a}_{b}"]
        out[r["lam"]] = (m, r["logdet"])
    return out


def _profile(m: np.ndarray, logdet: float, n: int):
    a, b, c = m[:-1, :-1], m[:-1, -1], m[-1, -1]
    beta = np.linalg.solve(a, b)
    rss = max(float(c - beta @ b), 1e-300)
    p = len(b)
    s2 = rss / (n - p)
    sign, ld = np.linalg.slogdet(a)
    reml = -0.5 * ((n - p) * (math.log(2 * math.pi * s2) + 1) + logdet + ld)
    s2_ml = rss / n
    ml = -0.5 * (n * (math.log(2 * math.pi * s2_ml) + 1) + logdet)
    return float(reml), float(ml), beta, float(s2), a


def fit_random_intercept(
    df: DataFrame, outcome: str, predictors: Sequence[str], group: str, rounds: int = 4, points: int = 40
) -> MixedFit:
    """REML fit; rows with a null in any used column are left out."""
    xs = list(predictors)
    data = df.select(group, outcome, *xs).dropna()
    row = data.agg(F.count("*").alias("n"), *[F.avg(F.col(c).cast("double")).alias(c) for c in [outcome, *xs]]).first()
    n = row["n"]
    centre = {c: row[c] for c in [outcome, *xs]}
    folded = settle(_fold_by_size(data, outcome, xs, group, centre))  # one row per distinct group size
    groups = folded.agg(F.sum("groups")).first()[0]
    names = [f"x{i}" for i in range(len(xs) + 1)] + ["y"]
    lams = [0.0, *np.exp(np.linspace(math.log(1e-6), math.log(1e3), points))]
    best = None
    for _ in range(rounds):
        scored = []
        for lam, (m, logdet) in _sums(folded, lams, names).items():
            scored.append((lam, *_profile(m, logdet, n)))
        scored.sort(key=lambda s: s[0])
        i = max(range(len(scored)), key=lambda k: scored[k][1])
        best = scored[i]
        lo, hi = scored[max(i - 1, 0)][0], scored[min(i + 1, len(scored) - 1)][0]
        lams = sorted({*np.linspace(lo, hi, points), best[0]})
    lam, reml, ml, beta, s2, a = best
    cov = np.linalg.inv(a) * s2
    se = np.sqrt(np.diag(cov))
    coef = beta.copy()
    # undo the centring: only the intercept and its variance change
    mean_x = np.array([centre[c] for c in xs])
    coef[0] = centre[outcome] + beta[0] - float(mean_x @ beta[1:])
    grad = np.concatenate([[1.0], -mean_x])
    se[0] = math.sqrt(float(grad @ cov @ grad))
    fit = MixedFit(["intercept", *xs], coef, se, float(lam * s2), s2, n, int(groups), reml, ml, group, outcome)
    fit.p_values = [normal_p(c / s) if s > 0 else float("nan") for c, s in zip(coef, se, strict=True)]
    return fit


def with_predictions(df: DataFrame, fit: MixedFit) -> DataFrame:
    """Adds fixed part, group effect (shrunken; 0 for rows without a group), fitted value and residual."""
    fixed = F.lit(float(fit.coef[0]))
    for c, b in zip(fit.names[1:], fit.coef[1:], strict=True):
        fixed = fixed + F.col(c).cast("double") * F.lit(float(b))
    base = df.withColumn("fixed_part", fixed)
    lam = fit.var_group / fit.var_resid
    gap = F.col(fit.outcome).cast("double") - F.col("fixed_part")
    effect = base.groupBy(fit.group).agg(
        (F.sum(gap) * F.lit(lam) / (1.0 + F.count(gap) * F.lit(lam))).alias("group_effect"))
    return base.join(effect, fit.group, "left").fillna(0.0, ["group_effect"]).withColumn(
        "fitted", F.col("fixed_part") + F.col("group_effect")
    ).withColumn("residual", F.col(fit.outcome).cast("double") - F.col("fitted"))


def comparison_table(spark, fits: dict[str, MixedFit]) -> DataFrame:
    """One row per model: variance parts, ICC, likelihoods, AIC/BIC and deltas
    against the first; likelihood-based criteria use the ML likelihood."""
    first = next(iter(fits.values()))
    rows = [
        (name, f.n, f.groups, f.var_group, f.var_resid, f.icc, f.ll_reml, f.ll_ml, f.aic, f.bic,
         f.aic - first.aic, 1.0 - (f.var_group + f.var_resid) / (first.var_group + first.var_resid))
        for name, f in fits.items()
    ]
    return spark.createDataFrame(rows, (
        "model string, n long, n_groups int, var_group double, var_resid double, icc double, ll_reml double,"
        "ll_ml double, aic double, bic double, delta_aic double, variance_explained double"))


def coefficient_table(spark, fits: dict[str, MixedFit], max_p: float | None = None) -> DataFrame:
    rows = [(m, c, float(b), float(s), float(p)) for m, f in fits.items()
            for c, b, s, p in zip(f.names, f.coef, f.se, f.p_values, strict=True)
            if max_p is None or p < max_p]
    return spark.createDataFrame(rows, "model string, term string, coef double, se double, p_value double")


def anova_icc(df: DataFrame, outcome: str, group: str) -> DataFrame:
    """ICC by the one-way ANOVA estimator, one row."""
    per = df.where(F.col(outcome).isNotNull()).groupBy(group).agg(
        F.count("*").cast("double").alias("n"), F.avg(outcome).alias("m"), F.var_pop(outcome).alias("v"))
    t = per.agg(
        F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("n2"),
        F.sum(F.col("n") * F.col("m")).alias("s"), F.sum(F.col("n") * F.col("m") * F.col("m")).alias("s2"),
        F.sum(F.col("n") * F.col("v")).alias("ssw"),
    )
    msb = (F.col("s2") - F.col("s") * F.col("s") / F.col("n")) / (F.col("k") - 1)
    msw = F.col("ssw") / (F.col("n") - F.col("k"))
    n0 = (F.col("n") - F.col("n2") / F.col("n")) / (F.col("k") - 1)
    parts = t.select(F.col("k").alias("n_groups"), msb.alias("msb"), msw.alias("msw"), n0.alias("n0"))
    var_u = (F.col("msb") - F.col("msw")) / F.col("n0")
    return parts.withColumn("var_group", var_u).withColumn(
        "icc", F.try_divide(F.col("var_group"), F.col("var_group") + F.col("msw")))


def interaction_ols(df: DataFrame, outcome: str, a: str, b: str) -> DataFrame:
    """OLS of outcome on a, b and a*b with p-values: (term, coef, p_value)."""
    z = df.select(F.col(outcome).cast("double").alias("label"), F.col(a).cast("double").alias(a),
                  F.col(b).cast("double").alias(b)).dropna().withColumn(f"{a}_x_{b}", F.col(a) * F.col(b))
    terms = [a, b, f"{a}_x_{b}"]
    model = GeneralizedLinearRegression(family="gaussian", link="identity").fit(
        VectorAssembler(inputCols=terms, outputCol="features").transform(z))
    p = model.summary.pValues
    rows = [(t, float(c), float(v)) for t, c, v in zip([*terms, "intercept"], [*model.coefficients, model.intercept], p,
                                                       strict=True)]
    return df.sparkSession.createDataFrame(rows, "term string, coef double, p_value double")
