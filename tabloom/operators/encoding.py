"""Encoding, imputation, column selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import (
    PCA,
    OneHotEncoder,
    PolynomialExpansion,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.ordered import exact_quantiles, positions
from tabloom.operators.profiling import cardinalities, correlation_pairs, mode_per_group, value_domains
from tabloom.operators.shaping import names_by_type

# -- statistics-driven pruning: one aggregate, then a plain select -------------


def sparse_columns(df: DataFrame, min_share: float = 0.7) -> list[str]:
    """Columns whose non-null share is below ``min_share``."""
    row = df.agg(F.count("*").alias("_n"), *[F.count(c).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row["_n"] and row[c] / row["_n"] < min_share]


def constant_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    """Columns with at most one non-null value, by min = max: no distinct, no
    shuffle beyond one row per task."""
    cols = list(cols or df.columns)
    row = df.agg(*[F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias(c) for c in cols]).first()
    return [c for c in cols if row[c]]


def null_bearing_columns(df: DataFrame) -> list[str]:
    from tabloom.operators.profiling import _is_missing

    row = df.agg(*[F.max(_is_missing(df, c)).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c]]


def high_cardinality_columns(df: DataFrame, limit: int = 30, keep: Sequence[str] = ()) -> list[str]:
    """Categorical columns with more than ``limit`` or at most one value."""
    text = [c for c in names_by_type(df)[1] if c not in keep]
    if not text:
        return []
    rows = cardinalities(df, text).select("variable", "n_distinct").collect()
    n = {r["variable"]: r["n_distinct"] for r in rows}
    return [c for c in text if n.get(c, 0) > limit or n.get(c, 0) <= 1]


def correlated_columns(df: DataFrame, cols: Sequence[str] | None = None, limit: float = 0.90) -> list[str]:
    """The later column of each pair with signed correlation above ``limit``."""
    rows = correlation_pairs(df, cols).where(F.col("r") > limit).select("b").distinct().collect()
    later = {r["b"] for r in rows}
    return [c for c in (cols or df.columns) if c in later]


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in set(cols)])


def prune_and_fill(df: DataFrame, keys: Sequence[str], limit: int = 30) -> tuple[DataFrame, list[str]]:
    """Drop over-wide categoricals and constants, then 'NA' / 0 for nulls."""
    dropped = high_cardinality_columns(df, limit, keys)
    numeric = [c for c in names_by_type(df)[0] if c not in keys]
    dropped += constant_columns(df, numeric) if numeric else []
    out = drop_columns(df, dropped)
    num, text = names_by_type(out)
    return out.fillna("NA", text).fillna(0, num), dropped


# -- encoders -----------------------------------------------------------------


def feature_pipeline(
    categorical: Sequence[str], numeric: Sequence[str], unseen: str = "keep", out: str = "features"
) -> Pipeline:
    """Index (frequency desc, ties by value) + one-hot + assemble."""
    idx = [f"{c}_idx" for c in categorical]
    hot = [f"{c}_hot" for c in categorical]
    stages = []
    if categorical:
        stages = [
            StringIndexer(inputCols=list(categorical), outputCols=idx, handleInvalid=unseen,
                          stringOrderType="frequencyDesc"),
            OneHotEncoder(inputCols=idx, outputCols=hot, dropLast=False),
        ]
    stages.append(VectorAssembler(inputCols=[*hot, *numeric], outputCol=out, handleInvalid=unseen))
    return Pipeline(stages=stages)


def fit_domains(df: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    """Sorted value list per column, saved at fit time.  Each value becomes a
    column of the encoded table, so the lists are as long as that is wide."""
    rows = value_domains(df, cols).collect()
    return {c: sorted(r["value"] for r in rows if r["variable"] == c) for c in cols}


def dummies(
    df: DataFrame, domains: Mapping[str, Sequence[str]], drop_first: bool = False, sep: str = "_=_"
) -> DataFrame:
    """0/1 columns ``col_=_value`` from saved domains; null gives all zeros."""
    new = {}
    for c, values in domains.items():
        for v in list(values)[1 if drop_first else 0:]:
            new[f"{c}{sep}{v}"] = F.coalesce((F.col(c).cast("string") == v).cast("int"), F.lit(0))
    return df.withColumns(new).drop(*domains)


def align_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The training columns in order; those absent are 0."""
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(0).alias(c) for c in wanted])


def label_codes(df: DataFrame, col: str, order: str | None = None) -> DataFrame:
    """(value, code): sorted order, or order of first appearance by ``order``."""
    src = df.where(F.col(col).isNotNull())
    if order is None:
        return positions(src.select(col).distinct(), [col], "code")
    first = src.groupBy(col).agg(F.min(order).alias("_first"))
    return positions(first, ["_first", col], "code").drop("_first")


def label_encode(df: DataFrame, col: str, codes: DataFrame, out: str) -> DataFrame:
    """Codes joined on; values unknown to the fit get -1."""
    return df.join(codes.withColumnRenamed("code", out), col, "left").fillna(-1, [out])


def label_decode(df: DataFrame, code: str, codes: DataFrame, out: str) -> DataFrame:
    value = [c for c in codes.columns if c != "code"][0]
    return df.join(codes.select(F.col("code").alias(code), F.col(value).alias(out)), code, "left")


def scale(df: DataFrame, cols: Sequence[str], method: str = "standard", suffix: str = "_scaled") -> DataFrame:
    """standard (population deviation), minmax, or robust (median and IQR).

    Statistics are a scalar subquery, so rows stay where they are.
    """
    if method == "robust":
        q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
        stats = q.agg(F.map_from_entries(F.collect_list(F.struct("variable", F.struct("q0", "q1", "q2"))))).scalar()
        parts = {c: (F.element_at(stats, c)["q1"], F.element_at(stats, c)["q2"] - F.element_at(stats, c)["q0"])
                 for c in cols}
    else:
        lo, span = {"standard": (F.avg, F.stddev_pop), "minmax": (F.min, lambda c: F.max(c) - F.min(c))}[method]
        stats = df.agg(F.struct(
            *[s for c in cols for s in (lo(c).cast("double").alias(f"a_{c}"), span(c).cast("double").alias(f"b_{c}"))]
        )).scalar()
        parts = {c: (stats[f"a_{c}"], stats[f"b_{c}"]) for c in cols}
    return df.withColumns({
        c + suffix: F.coalesce(F.try_divide(F.col(c) - a, b), F.when(F.col(c).isNotNull(), F.lit(0.0)))
        for c, (a, b) in parts.items()
    })


def present(col: str) -> Column:
    """The column as a double; null where it is NaN."""
    return F.nanvl(F.col(f"`{col}`").cast("double"), F.lit(None).cast("double"))


def assemble(
    df: DataFrame, cols: Sequence[str], out: str = "features", fill: Mapping[str, Column] | None = None
) -> DataFrame:
    """A vector for every row: a null or NaN counts as its column's ``fill``, else as 0."""
    fill = fill or {}
    held = {f"_in{i}": F.coalesce(present(c), *([fill[c]] if c in fill else []), F.lit(0.0)) for i, c in enumerate(cols)}
    return VectorAssembler(inputCols=list(held), outputCol=out).transform(df.withColumns(held)).drop(*held)


def principal_components(
    df: DataFrame, cols: Sequence[str], share: float | None = 0.95, k: int | None = None
) -> tuple[DataFrame, list[float], int]:
    """Scores ``pca`` plus explained variances; ``k`` fixed or from ``share``.
    A missing value counts as its column's mean, which adds no variance."""
    means = df.agg(F.struct(*[F.avg(present(c)).alias(c) for c in cols])).scalar()
    vec = assemble(df, cols, "_v", {c: means[c] for c in cols})
    full = PCA(k=len(cols), inputCol="_v", outputCol="_pca").fit(vec)
    explained = [float(x) for x in full.explainedVariance]
    if k is None:
        total, k = 0.0, 0
        for x in explained:
            total += x
            k += 1
            if total >= share:
                break
    scores = full.transform(vec).withColumn("pca", F.slice(vector_to_array("_pca"), 1, k)).drop("_v", "_pca")
    return scores, explained, k


def polynomial(df: DataFrame, cols: Sequence[str], degree: int = 2, out: str = "poly") -> DataFrame:
    vec = assemble(df, cols, "_v")
    return PolynomialExpansion(degree=degree, inputCol="_v", outputCol=out).transform(vec).drop("_v")


# -- imputation ---------------------------------------------------------------


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(values))


def fill_statistic(
    df: DataFrame, cols: Sequence[str], how: str = "median", indicator: bool = False
) -> DataFrame:
    """Nulls take the column's mode, exact median or mean; optional 0/1 flag."""
    if how == "median":
        q = exact_quantiles(df, cols, [0.5])
        table = q.agg(F.map_from_entries(F.collect_list(F.struct("variable", "q0")))).scalar()
        value = {c: F.element_at(table, c) for c in cols}
    elif how == "mean":
        row = df.agg(F.struct(*[F.avg(c).alias(c) for c in cols])).scalar()
        value = {c: row[c] for c in cols}
    else:
        value = {c: mode_per_group(df, [c]).scalar() for c in cols}
    out = {f"{c}_missing": F.col(c).isNull().cast("int") for c in cols} if indicator else {}
    return df.withColumns({**out, **{c: F.coalesce(F.col(c), value[c]) for c in cols}})


def fill_by_tree(df: DataFrame, target: str, features: Sequence[str], depth: int = 5) -> DataFrame:
    """Nulls of ``target`` predicted by a regression tree fitted on the rest."""
    vec = VectorAssembler(inputCols=list(features), outputCol="_f", handleInvalid="keep").transform(df)
    model = DecisionTreeRegressor(featuresCol="_f", labelCol=target, predictionCol="_p", maxDepth=depth, seed=7).fit(
        vec.where(F.col(target).isNotNull())
    )
    return model.transform(vec).withColumn(target, F.coalesce(F.col(target).cast("double"), "_p")).drop("_f", "_p")


# -- selection ----------------------------------------------------------------


def anova_f(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """(variable, f_value) of the one-way ANOVA; null where nothing varies within groups."""
    return _mean_squares(df, label, cols).select("variable", F.try_divide("between", "within").alias("f_value"))


def _mean_squares(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """(variable, between, within) from one pass of moments, keyed by label and column number."""
    values = df.select(F.col(label).alias("_l"), F.posexplode(F.array(*[F.col(c).cast("double") for c in cols])).alias("_i", "_x"))
    per = values.groupBy("_l", "_i").agg(F.count("_x").alias("n"), F.avg("_x").alias("m"), F.var_pop("_x").alias("v"))
    names = F.array(*[F.lit(c) for c in cols])
    long = per.where(F.col("n") > 0).select(F.get(names, F.col("_i")).alias("variable"), F.col("n").cast("double").alias("n"), "m", "v")
    t = long.groupBy("variable").agg(
        F.sum("n").alias("n"), F.count("*").alias("g"),
        F.sum(F.col("n") * F.col("m")).alias("s"),
        F.sum(F.col("n") * F.col("m") * F.col("m")).alias("s2"),
        F.sum(F.col("n") * F.col("v")).alias("within"),
    )
    between = F.col("s2") - F.col("s") * F.col("s") / F.col("n")
    return t.select("variable", F.try_divide(between, F.col("g") - 1).alias("between"),
                    F.try_divide("within", F.col("n") - F.col("g")).alias("within"))


def k_best(df: DataFrame, label: str, cols: Sequence[str], k: int = 8) -> list[str]:
    """The k columns of largest F, in the order of ``cols``; ties go to the first name.
    A column that varies between groups alone tells them apart and comes first."""
    f = F.when((F.col("within") == 0) & (F.col("between") > 0), F.lit(float("inf"))).otherwise(
        F.try_divide("between", "within"))
    best = _mean_squares(df, label, cols).orderBy(f.desc_nulls_last(), "variable").limit(k).collect()
    chosen = {r["variable"] for r in best}
    return [c for c in cols if c in chosen]


def recursive_elimination(
    df: DataFrame, label: str, cols: Sequence[str], keep: int = 15, step: int = 1, trees: int = 20
) -> list[str]:
    """Drop the least important forest feature(s) until ``keep`` remain."""
    left = list(cols)
    while len(left) > keep:
        model = RandomForestClassifier(featuresCol="_v", labelCol=label, numTrees=trees, maxDepth=5, seed=7).fit(
            assemble(df, left, "_v")
        )
        weight = model.featureImportances.toArray()
        worst = sorted(range(len(left)), key=lambda i: (weight[i], -i))[: min(step, len(left) - keep)]
        left = [c for i, c in enumerate(left) if i not in worst]
    return left


def base_features(df: DataFrame, col: str, extra: Sequence[str] = (), markers: Sequence[str] = ("NA", "single value"),
                  sep: str = "_=_") -> DataFrame:
    """Distinct feature names behind comma lists of encoded names."""
    one = F.explode(F.split(F.coalesce(col, F.lit("NA")), ",")).alias("f")
    names = df.select(one).select(F.substring_index("f", sep, 1).alias("feature")).distinct()
    names = names.where(~F.col("feature").isin(*markers))
    if extra:
        names = names.unionByName(
            df.sparkSession.createDataFrame([(e,) for e in extra], "feature string")).distinct()
    return names
