"""Models per target as a job: train and save, load and score, votes per plan."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import count

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.numeric import hash_order
from tabloom.operators.encoding import k_best
from tabloom.operators.evaluation import binary_metrics
from tabloom.operators.models import SEED, balanced_weights, sole_best
from tabloom.operators.sets import stratified_split
from tabloom.sources.models import load_model, save_model

METADATA = ("consolidated_target string, target string, features string, mapped_to string, model string, "
            "precision double, accuracy double, path string")
SINGLE_VALUE = "single value"
SEPARATOR = "_=_"
_KEY = "_hashed_key"
_MADE = ("features", "rawPrediction", "probability", "prediction")


def input_stages(cols: Sequence[str]) -> tuple[list, list[str]]:
    """Stages that make ``features`` of ``cols`` (null and NaN count as 0), and the columns they add on the way."""
    held = [f"_in{i}" for i in range(len(cols))]
    filled = ", ".join(f"coalesce(nanvl(cast(`{c}` as double), cast(null as double)), 0D) as {h}"
                       for c, h in zip(cols, held, strict=True))
    return [SQLTransformer(statement=f"select *, {filled} from __THIS__"),
            VectorAssembler(inputCols=held, outputCol="features")], held


def train_targets(
    df: DataFrame, targets: Sequence[str], features: Sequence[str], key: str, folder: str, k: int = 8,
    test_share: float = 0.25, trees: int = 20, rounds: int = 10, workers: int = 4,
) -> DataFrame:
    """Fits every 0/1 column ``target_=_value`` and saves what scoring needs under ``folder``.

    Logistic regression, boosted trees and a forest on the k best features; the
    family that alone has the highest test precision is saved, boosted trees
    where several share it.  A column that is 1 in every row is a target of one
    value, which needs no model; one that is never 1 is left out.  Returns the
    metadata, a row for each saved column.

    Keys are hashed once for all targets.  A target's split is held until its
    features are chosen; its fits read those features and weights alone.
    """
    hashed = hash_order(F.col(key)).alias(_KEY)
    base = df.select(hashed, *features, *[F.col(f"`{t}`").cast("double").alias(t) for t in targets]).persist()
    split_so_far = count(1)

    def one(numbered: tuple[int, str]) -> tuple:
        i, target = numbered
        name, _, value = target.partition(SEPARATOR)
        labelled = base.select(_KEY, *features, F.col(f"`{target}`").alias("label"))
        split = stratified_split(labelled, "label", _KEY, test_share, hashed=True).select(*features, "label", "part").persist()
        held = [split]
        try:
            train, test = (split.where(F.col("part") == p).drop("part") for p in ("train", "test"))
            chosen = k_best(train, "label", features, k)
            if next(split_so_far) == len(varied):
                base.unpersist()
            train, test = (d.select("label", *chosen) for d in (train, test))
            train = balanced_weights(train, "label")
            for part in (train, test):
                held.append(part.persist())
                part.count()
            split.unpersist()
            families = {
                "logistic": LogisticRegression(maxIter=50, weightCol="weight"),
                "boosted": GBTClassifier(maxIter=rounds, seed=SEED),
                "forest": RandomForestClassifier(numTrees=trees, seed=SEED),
            }
            stages, _ = input_stages(chosen)
            vectors = PipelineModel(stages).transform(train).select("label", "weight", "features")
            fitted = {f: PipelineModel([*stages, e.fit(vectors)]) for f, e in families.items()}
            metric = {f: binary_metrics(m.transform(test), "label", "prediction").first() for f, m in fitted.items()}
        finally:
            for part in held:
                part.unpersist()
        win = sole_best({f: m["precision"] for f, m in metric.items()})
        path = save_model(fitted[win], f"{folder}/model-{i}")
        return (name, target, ",".join(chosen), value, win, float(metric[win]["precision"]), float(metric[win]["accuracy"]), path)

    try:
        span = base.agg(*[F.struct(F.min(f"`{t}`").alias("low"), F.max(f"`{t}`").alias("high")).alias(t) for t in targets]).first()
        fixed = [t for t in targets if span[t]["low"] == 1.0]
        varied = [t for t in targets if span[t]["low"] == 0.0 and span[t]["high"] == 1.0]
        with ThreadPoolExecutor(workers) as pool:
            rows = list(pool.map(one, enumerate(varied)))
    finally:
        base.unpersist()
    for target in fixed:
        name, _, value = target.partition(SEPARATOR)
        rows.append((name, target, "", value, SINGLE_VALUE, 1.0, 1.0, None))
    df.sparkSession.createDataFrame(rows, METADATA).write.mode("overwrite").parquet(f"{folder}/metadata")
    return df.sparkSession.read.schema(METADATA).parquet(f"{folder}/metadata")


def score_targets(df: DataFrame, folder: str) -> tuple[DataFrame, list[str], dict[str, str]]:
    """``df`` with a 0/1 column for each saved model, those columns' names, and the targets of one value."""
    saved = df.sparkSession.read.schema(METADATA).parquet(f"{folder}/metadata").orderBy("target").collect()
    out, columns, constants = df, [], {}
    for row in saved:
        if row["model"] == SINGLE_VALUE:
            constants[row["consolidated_target"]] = row["mapped_to"]
            continue
        held = input_stages(row["features"].split(","))[1]
        out = load_model(row["path"]).transform(out).withColumn(row["target"], F.col("prediction").cast("int")).drop(*held, *_MADE)
        columns.append(row["target"])
    return out, columns, constants


def with_constants(votes: DataFrame, plan: str, constants: dict[str, str]) -> DataFrame:
    """Votes of the targets of one value: every claim of a plan."""
    plans = votes.groupBy(plan).agg(F.max("claims").alias("claims"))
    for name, value in sorted(constants.items()):
        votes = votes.unionByName(plans.select(plan, "claims", F.lit(name).alias("target"), F.lit(value).alias("value"),
                                               F.lit(-1).alias("col_order"), F.col("claims").alias("votes")))
    return votes
