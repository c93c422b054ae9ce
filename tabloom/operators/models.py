"""Distributed training and scoring on pyspark.ml."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.numeric import hash_bucket
from tabloom.operators.encoding import assemble
from tabloom.operators.gram import moment_points
from tabloom.operators.ordered import positions
from tabloom.operators.sets import (
    assign_folds,
    assign_stratified_folds,
    flag_first_by_hash,
)
from tabloom.operators.similarity import nearest
from tabloom.session import settle, stored

SEED = 7
CELL_ROWS = 2_000_000  # rows from which on boosted regressions look for cells
ROWS_A_CELL = 4  # rows of a cell on average, at least, that make cells worth it
CELL_VALUES = 16  # values of a vector, at most, that name a cell
MOMENT_VALUES = 200  # values of a vector up to which a grid of regressions is searched on sums


def max_probability(probability: str = "probability") -> Column:
    return F.array_max(vector_to_array(probability))


def positive_probability(probability: str = "probability") -> Column:
    return vector_to_array(probability)[1]


# -- model choice -------------------------------------------------------------


@dataclass
class Choice:
    family: str
    score: float
    model: object
    scores: dict[str, float]


def choose_classifier(
    train: DataFrame, key: str, folds: int = 4, grids: Mapping[str, tuple] | None = None, parallelism: int = 4
) -> Choice:
    """Forest against logistic regression, grid-searched on hash folds by F1;
    the family with the best mean score is refitted on everything.
    ``train`` has ``features`` and ``label``."""
    rf = RandomForestClassifier(seed=SEED)
    lr = LogisticRegression(maxIter=50)
    grids = grids or {
        "forest": (rf, ParamGridBuilder().addGrid(rf.numTrees, [20, 40]).addGrid(rf.maxDepth, [5, 8]).build()),
        "logistic": (lr, ParamGridBuilder().addGrid(lr.regParam, [0.01, 0.1]).addGrid(
            lr.elasticNetParam, [0.0, 0.5]).build()),
    }
    folded = assign_folds(train, key, folds).select("features", "label", "fold").persist()
    try:
        results = {}
        for family, (estimator, grid) in grids.items():
            cv = CrossValidator(
                estimator=estimator, estimatorParamMaps=grid, numFolds=folds, foldCol="fold",
                evaluator=MulticlassClassificationEvaluator(metricName="f1"), parallelism=parallelism,
            ).fit(folded)
            results[family] = (float(max(cv.avgMetrics)), cv.bestModel)
    finally:
        folded.unpersist()
    best = max(results, key=lambda f: results[f][0])
    return Choice(best, results[best][0], results[best][1], {f: r[0] for f, r in results.items()})


def forest_report(df: DataFrame, key: str, trees: int = 20, depth: int = 8) -> tuple[DataFrame, DataFrame]:
    """80/20 hash split, forest on ``features``; (scored test rows, confusion)."""
    train = hash_bucket(F.col(key)) < 8000
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED).fit(df.where(train))
    scored = model.transform(df.where(~train))
    return scored, scored.groupBy("label", "prediction").agg(F.count("*").alias("n"))


def score_batch(df: DataFrame, model: PipelineModel, labels: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Transform, decode the predicted index, attach the max probability."""
    table = F.array(*[F.lit(x) for x in labels])
    return model.transform(df).select(
        *keep,
        F.get(table, F.col("prediction").cast("int")).alias("predicted_label"),
        max_probability().alias("probability_score"),
    )


def sole_best(scores: Mapping[str, float], otherwise: str = "boosted") -> str:
    """The one family at the top score; ``otherwise`` where several share it."""
    top = max(scores.values())
    leaders = [family for family, score in scores.items() if score == top]
    return leaders[0] if len(leaders) == 1 else otherwise


def tree_rules(df: DataFrame, features: Sequence[str], label: str, depth: int = 5) -> str:
    """Decision rules of a shallow tree with feature names filled in."""
    model = DecisionTreeClassifier(labelCol=label, maxDepth=depth, seed=SEED).fit(assemble(df, features))
    text = model.toDebugString
    for i in range(len(features) - 1, -1, -1):
        text = text.replace(f"feature {i} ", f"{features[i]} ")
    return text


# -- regressors and classifiers ----------------------------------------------


def grid_regression(train: DataFrame, kind: str, key: str, folds: int = 4, grid: Sequence[float] = (0.01, 0.1, 1.0)):
    """linear, ridge, lasso or elastic net by cross-validated RMSE.

    Fits and errors of the folds follow from their sums of values, squares and products, so the grid is
    searched on a few weighted points that have those sums; the chosen model is fitted on all rows."""
    mix = {"linear": [0.0], "ridge": [0.0], "lasso": [1.0], "elastic": [0.25, 0.5, 0.75]}[kind]
    reg = [0.0] if kind == "linear" else list(grid)
    lr = LinearRegression(maxIter=50)
    if kind == "linear":
        return lr.fit(train)
    maps = ParamGridBuilder().addGrid(lr.regParam, reg).addGrid(lr.elasticNetParam, mix).build()
    folded = assign_folds(train, key, folds).select("features", "label", "fold")
    points = moment_points(folded, "features", "label", "fold") if _width(folded) <= MOMENT_VALUES else None
    if points is None:  # wide vectors, or values that a fit refuses
        folded = folded.persist()
        try:
            return _search(lr, maps, folds, RegressionEvaluator(metricName="rmse")).fit(folded).bestModel
        finally:
            folded.unpersist()
    found = _search(lr.copy({lr.weightCol: "weight"}), maps, folds, RegressionEvaluator(metricName="rmse", weightCol="weight")).fit(points)
    return lr.fit(train, maps[found.avgMetrics.index(min(found.avgMetrics))])


def _width(df: DataFrame) -> int:
    first = df.select(F.size(vector_to_array("features")).alias("n")).first()
    return first["n"] if first else 0


def _search(lr: LinearRegression, maps: Sequence[dict], folds: int, evaluator: RegressionEvaluator) -> CrossValidator:
    return CrossValidator(estimator=lr, estimatorParamMaps=maps, numFolds=folds, foldCol="fold", evaluator=evaluator, parallelism=4)


class CellBoostedRegressor(GBTRegressor):
    """Boosted regression trees that need one pass over many rows, not one for each level of each tree.

    Trees see a row only by the bin of each of its values, and a boosted tree of squared errors needs no more than the
    number and the sum of the labels of a bin: squares within a cell (rows that share all bins) are the same on both
    sides of each split. So rows are added up by cell and Spark's own trees are fitted on weighted cells, one for all
    their rows. A value of few kinds has a bin for each; others have ``maxBins`` of about as many rows, from all rows
    where Spark draws a sample. Rows are fitted one by one where they are few, or cells as many as they,
    and where a parameter asks for single rows.
    """

    def _fit(self, dataset: DataFrame):
        cells = None if self._wants_rows() else tree_cells(dataset, self.getFeaturesCol(), self.getLabelCol(), self.getMaxBins())
        if cells is None:
            return super()._fit(dataset)
        # of up to maxBins^2 rows Spark takes all to find its splits
        bins = max(self.getMaxBins(), math.isqrt(cells.count()) + 1)
        own = self.copy({self.weightCol: "weight", self.maxBins: bins, self.featuresCol: "features", self.labelCol: "label"})
        return self._copyValues(super(CellBoostedRegressor, own)._fit(cells))

    def _wants_rows(self) -> bool:
        odd = any(self.isSet(p) for p in (self.weightCol, self.validationIndicatorCol))
        return (odd or self.getLossType() != "squared" or self.getSubsamplingRate() != 1.0 or self.getMinInstancesPerNode() != 1
                or self.getFeatureSubsetStrategy() != "all" or self.getMinInfoGain() != 0.0 or self.getMinWeightFractionPerNode() != 0.0)


def tree_cells(df: DataFrame, features: str, label: str, bins: int) -> DataFrame | None:
    """(features, label, weight): one row for each cell of ``df``, stored, or None where rows are as well taken as they are.

    A value's bin is that of the nearest of up to ``bins`` values: all that occur, or the middles of as many quantiles;
    Spark's splits, half-way between neighbours, lie where these bins end. The label is the mean.
    """
    rows = df.count()
    width = 0
    if rows >= CELL_ROWS:
        width = df.select(F.size(vector_to_array(features)).alias("n")).first()["n"]
    if not 0 < width <= CELL_VALUES:
        return None
    x, y = vector_to_array(features), F.col(label).cast("double")
    flat = df.select(*[x[i].alias(f"x{i}") for i in range(width)], y.alias("y"))
    names = flat.columns[:-1]
    middles = [(i + 0.5) / bins for i in range(bins)]
    odd = reduce(lambda a, b: a | b, [~F.coalesce(F.abs(c) < float("inf"), F.lit(False)) for c in flat.columns])
    seen = flat.agg(F.count_if(odd).alias("odd"), *[F.approx_count_distinct(c).alias(f"n_{c}") for c in names],
                    *[F.percentile_approx(c, middles, 10_000).alias(c) for c in names]).first()
    if seen["odd"]:
        return None
    few = [c for c in names if seen[f"n_{c}"] <= 2 * bins]  # the count is an estimate
    kinds = flat.agg(F.lit(0), *[F.collect_set(c).alias(c) for c in few]).first().asDict()
    values = [np.unique(kinds[c] if c in few and len(kinds[c]) <= bins else seen[c]) for c in names]
    sizes = [len(v) for v in values]
    if math.prod(sizes) * ROWS_A_CELL > rows:
        return None
    ends = [(v[1:] + v[:-1]) / 2 for v in values]

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [np.searchsorted(e, c.to_numpy(zero_copy_only=False)) for e, c in zip(ends, batch.columns)]
            cell = np.ravel_multi_index(columns, sizes) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int64)), batch.columns[-1]], ["cell", "y"])

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unravel_index(batch.column(0).to_numpy(), sizes)
            x = np.column_stack([v[i] for v, i in zip(values, at)])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * width), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([lists, *batch.columns[1:]], ["x", "label", "weight"])

    sums = flat.mapInArrow(named, "cell long, y double").groupBy("cell").agg(
        F.avg("y").alias("label"), F.count("*").cast("double").alias("weight"))
    cells = sums.repartition(2 * df.sparkSession.sparkContext.defaultParallelism).mapInArrow(
        spelled, "x array<double>, label double, weight double")
    return stored(cells.select(array_to_vector("x").alias("features"), "label", "weight"), "cells")


def tree_family(kind: str, task: str, trees: int = 20, depth: int = 5):
    """forest / boosted / tree estimators for classify or regress."""
    table = {
        ("forest", "classify"): lambda: RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED),
        ("forest", "regress"): lambda: RandomForestRegressor(numTrees=trees, maxDepth=depth, seed=SEED),
        ("boosted", "classify"): lambda: GBTClassifier(maxIter=trees, maxDepth=depth, seed=SEED),
        ("boosted", "regress"): lambda: CellBoostedRegressor(maxIter=trees, maxDepth=depth, seed=SEED),
        ("tree", "classify"): lambda: DecisionTreeClassifier(maxDepth=depth, seed=SEED),
        ("tree", "regress"): lambda: DecisionTreeRegressor(maxDepth=depth, seed=SEED),
    }
    return table[kind, task]()


def bagged_forest(task: str, trees: int = 50, rate: float = 0.1, replace: bool = True):
    """Bagged (with replacement) or pasted (without) trees over all features."""
    cls = RandomForestClassifier if task == "classify" else RandomForestRegressor
    return cls(numTrees=trees, subsamplingRate=rate, bootstrap=replace, featureSubsetStrategy="all", seed=SEED)


def linear_svm(reg: float = 0.01) -> LinearSVC:
    return LinearSVC(maxIter=30, regParam=reg)


def feed_forward(inputs: int, classes: int = 2) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(layers=[inputs, 12, 8, classes], maxIter=40, seed=SEED)


def bagged_svms(train: DataFrame, key: str, members: int = 5, share: float = 0.3) -> Callable[[DataFrame], DataFrame]:
    """Linear SVMs on hash samples; majority vote in ``prediction``."""
    models = []
    for m in range(members):
        member = hash_bucket(F.concat(F.lit(f"{m}:"), F.col(key).cast("string"))) < int(share * 10_000)
        models.append(linear_svm().fit(train.where(member)))

    def predict(df: DataFrame) -> DataFrame:
        out = df
        for i, m in enumerate(models):
            out = m.transform(out).withColumnRenamed("prediction", f"_p{i}").drop("rawPrediction")
        votes = reduce(lambda a, b: a + b, [F.col(f"_p{i}") for i in range(len(models))])
        return out.withColumn("prediction", (votes * 2 > len(models)).cast("double")).drop(
            *[f"_p{i}" for i in range(len(models))])

    return predict


def boost_stumps(
    train: DataFrame, rounds: int = 10, base: str = "stump", cut_every: int = 5
) -> Callable[[DataFrame], DataFrame]:
    """Discrete AdaBoost: reweight the rows each round; lineage is cut by
    checkpoints.  Returns a scorer adding ``prediction`` and ``margin``."""
    data = train.select("features", F.col("label").cast("double").alias("label")).withColumn("w", F.lit(1.0))
    data = settle(data)
    fitted: list[tuple[float, object]] = []
    for r in range(rounds):
        est = DecisionTreeClassifier(maxDepth=1, seed=SEED, weightCol="w") if base == "stump" else LogisticRegression(
            maxIter=20, regParam=0.01, weightCol="w")
        model = est.fit(data)
        scored = model.transform(data)
        miss = (F.col("prediction") != F.col("label")).cast("double")
        row = scored.agg((F.sum(F.col("w") * miss) / F.sum("w")).alias("err"), F.avg("w").alias("mean_w")).first()
        err = min(max(row["err"], 1e-10), 1.0)
        if err >= 0.5:
            if not fitted:
                fitted.append((1.0, model))
            break
        alpha = math.log((1 - err) / err)
        fitted.append((alpha, model))
        if err <= 1e-9:
            break
        weight = F.col("w") * F.exp(F.lit(alpha) * miss) / F.lit(row["mean_w"])
        data = scored.select("features", "label", weight.alias("w"))
        if (r + 1) % cut_every == 0:
            data = settle(data)

    def predict(df: DataFrame) -> DataFrame:
        out = df.withColumn("margin", F.lit(0.0))
        for alpha, m in fitted:
            drop = [c for c in ("rawPrediction", "probability", "prediction") if c not in df.columns]
            out = m.transform(out).withColumn(
                "margin", F.col("margin") + F.lit(alpha) * (F.col("prediction") * 2.0 - 1.0)).drop(*drop)
        return out.withColumn("prediction", (F.col("margin") > 0).cast("double"))

    return predict


# -- out-of-fold and ensembles ------------------------------------------------


def out_of_fold(
    df: DataFrame, key: str, estimator, folds: int = 3, stratify: str | None = None,
    test: DataFrame | None = None, score: Column | None = None,
) -> tuple[DataFrame, DataFrame | None, list]:
    """Fold scores for every row, the folds' mean score for ``test`` rows, and
    the fitted models.  Needs ``features`` and ``label``."""
    value = score if score is not None else positive_probability()
    folded = (
        assign_stratified_folds(df, stratify, key, folds) if stratify else assign_folds(df, key, folds)
    ).persist()
    models, scored, tested = [], [], []
    try:
        for f in range(folds):
            m = estimator.fit(folded.where(F.col("fold") != f))
            models.append(m)
            scored.append(m.transform(folded.where(F.col("fold") == f)).select(key, "fold", "label", value.alias("score")))
            if test is not None:
                tested.append(m.transform(test).select(key, value.alias("score")))
        oof = settle(reduce(DataFrame.unionByName, scored))
    finally:
        folded.unpersist()
    mean = reduce(DataFrame.unionByName, tested).groupBy(key).agg(F.avg("score").alias("score")) if tested else None
    return oof, mean, models


def mean_of_models(scores: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Average score per key over models, without joining them one by one."""
    rows = [d.select(key, "score") for d in scores.values()]
    return reduce(DataFrame.unionByName, rows).groupBy(key).agg(F.avg("score").alias("score"))


def vote(df: DataFrame, cols: Sequence[str], hard: bool = True, weights: Sequence[float] | None = None) -> Column:
    """Hard: most votes on 0/1 predictions (ties to 0); soft: mean of scores."""
    weights = list(weights or [1.0] * len(cols))
    total = reduce(lambda a, b: a + b, [F.col(c) * F.lit(w) for c, w in zip(cols, weights, strict=True)])
    share = total / F.lit(float(sum(weights)))
    return (share > 0.5).cast("int") if hard else share


def stack(
    df: DataFrame, key: str, estimators: Mapping[str, object], folds: int = 3
) -> tuple[DataFrame, LogisticRegression]:
    """Meta logistic regression on out-of-fold scores of the base models."""
    longs = []
    for name, est in estimators.items():
        oof, _, _ = out_of_fold(df, key, est, folds)
        longs.append(oof.select(key, "label", F.lit(name).alias("model"), "score"))
    names = list(estimators)
    wide = reduce(DataFrame.unionByName, longs).groupBy(key).agg(
        F.max("label").alias("label"),
        *[F.max(F.when(F.col("model") == n, F.col("score"))).alias(f"s_{n}") for n in names])
    meta_in = settle(wide)
    vec = assemble(meta_in, [f"s_{n}" for n in names])
    meta = LogisticRegression(maxIter=50).fit(vec)
    return meta.transform(vec), meta


# -- imbalance ----------------------------------------------------------------


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """weight = n / (k * n_class), from one small count table in a subquery;
    a row without a label has no weight and counts for none."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("l")).agg(F.count("*").alias("c"))
    total = F.lit(0.0) + counts.agg(F.sum("c")).scalar()
    k = counts.agg(F.count("*")).scalar()
    table = counts.agg(F.map_from_entries(F.collect_list(F.struct("l", "c")))).scalar()
    return df.withColumn(out, total / (k * F.element_at(table, F.col(label))))


def oversample(df: DataFrame, label: str, key: str, minority: object, ratio: float = 0.4) -> DataFrame:
    """Copies minority rows until they number floor(ratio * majority).

    Every row gets the whole number of copies; the remainder goes to the first
    rows in md5 order.  Adds ``copy_no`` (0 = original).
    """
    small = df.where(F.col(label) == F.lit(minority))
    n_small = small.agg(F.count("*")).scalar()
    n_big = df.where(F.col(label) != F.lit(minority)).agg(F.count("*")).scalar()
    goal = F.greatest(F.floor(n_big * F.lit(ratio)), n_small)
    extra = flag_first_by_hash(small.select(key), key, F.pmod(goal, n_small), (), "_extra")
    copies = extra.select(key, (F.floor(goal / n_small) + F.col("_extra").cast("long")).alias("_copies"))
    more = df.join(copies, key, "left").withColumn("_copies", F.coalesce("_copies", F.lit(1).cast("long")))
    return more.withColumn("copy_no", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1))).drop("_copies")


def synthesize(df: DataFrame, key: str, vec: str, per_row: int = 1, k: int = 5, counts: DataFrame | None = None) -> DataFrame:
    """New minority vectors between a row and one of its k nearest neighbours;
    the neighbour and the fraction come from hashes of (key, copy).

    Every row gives ``per_row`` of them, or as many as ``counts`` (key, n_new) names."""
    near = nearest(df, df, k, "euclidean", key, vec, key, vec, exclude_same_id=True)
    lists = near.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "base_id"))).alias("near"))
    if counts is None:
        lists = lists.withColumn("_n", F.lit(per_row).cast("long"))
    else:
        lists = lists.join(counts.select(F.col(key).alias("query_id"), F.col("n_new").alias("_n")).where("_n > 0"), "query_id")
    copies = lists.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    seed = F.concat_ws(":", F.col("query_id").cast("string"), F.col("copy").cast("string"))
    pick = F.pmod(hash_bucket(seed), F.size("near")).cast("int")
    drawn = copies.select(
        F.col("query_id"), "copy", F.get("near", pick)["base_id"].alias("base_id"),
        (hash_bucket(F.concat(seed, F.lit(":u"))) / 10_000.0).alias("u"))
    a = df.select(F.col(key).alias("query_id"), F.col(vec).cast("array<double>").alias("a"))
    b = df.select(F.col(key).alias("base_id"), F.col(vec).cast("array<double>").alias("b"))
    return drawn.join(a, "query_id").join(b, "base_id").select(
        F.col("query_id").alias("source_id"), F.col("base_id").alias("neighbour_id"), "copy", "u",
        F.zip_with("a", "b", lambda x, y: x + F.col("u") * (y - x)).alias("vec"))


def density_counts(
    df: DataFrame, key: str, vec: str, label: str, minority: object, total: int, k: int = 5
) -> DataFrame:
    """(key, n_other, n_new) of every minority row: how many of its k nearest rows of all classes are of
    another one, and its share of ``total`` new points, in proportion to that.

    Shares are whole numbers that add up to ``total`` (largest remainders, ties to the smaller key), unless
    no minority row has a neighbour of another class: then there are none.
    """
    rare = df.where(F.col(label) == F.lit(minority))
    near = nearest(rare, df, k, "euclidean", key, vec, key, vec, exclude_same_id=True)
    others = df.where(~F.col(label).eqNullSafe(F.lit(minority))).select(F.col(key).alias("base_id"))
    met = near.join(others, "base_id").groupBy(F.col("query_id").alias(key)).agg(F.count("*").alias("_m"))
    rows = settle(rare.select(key).join(met, key, "left").select(key, F.coalesce("_m", F.lit(0)).cast("long").alias("n_other")))
    whole = rows.agg(F.sum("n_other")).scalar()
    wanted = F.lit(total).cast("long") * F.col("n_other")
    cut = rows.withColumns({"_floor": F.coalesce(F.floor(F.try_divide(wanted, whole)), F.lit(0)).cast("long"),
                            "_rest": -F.coalesce(F.try_mod(wanted, whole), F.lit(0))})
    placed = positions(settle(cut), ["_rest", key], "_place")
    left = F.when(whole > 0, F.lit(total).cast("long") - cut.agg(F.sum("_floor")).scalar()).otherwise(F.lit(0).cast("long"))
    return placed.select(key, "n_other", (F.col("_floor") + (F.col("_place") < left).cast("long")).alias("n_new"))


def synthesize_by_density(
    df: DataFrame, key: str, vec: str, label: str, minority: object, total: int, k: int = 5
) -> DataFrame:
    """``total`` new minority vectors, most where other classes crowd the minority (ADASYN); a minority of one
    row has no neighbour to draw towards and gives none."""
    counts = density_counts(df, key, vec, label, minority, total, k)
    return synthesize(df.where(F.col(label) == F.lit(minority)), key, vec, k=k, counts=counts)


def array_features(df: DataFrame, vec: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(vec).cast("array<double>")))


def importances(model, names: Sequence[str], fold: int = 0) -> list[tuple[int, str, float]]:
    return [(fold, n, float(v)) for n, v in zip(names, model.featureImportances.toArray(), strict=True)]
