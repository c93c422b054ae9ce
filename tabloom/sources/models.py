"""Model persistence and the model registry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY_SCHEMA = "model_name string, model_path string, family string, metric string, value double"


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def fit_labelled(df: DataFrame, stages: Sequence, label: str, classifier) -> PipelineModel:
    """A classifier of the text column ``label``, saved as one model with its label indexer and decoder.

    Rows without a label are left out.  When scoring, rows need no label column, and
    ``predicted_label`` holds the label's text.
    """
    known = df.where(F.col(label).isNotNull())
    index = StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc").fit(known)
    back = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=index.labels)
    return Pipeline(stages=[*stages, index, classifier.copy().setLabelCol("_label"), back]).fit(known)


def score_labelled(df: DataFrame, model: PipelineModel, keep: Sequence[str]) -> DataFrame:
    """``keep``, ``predicted_label`` and ``probability_score`` (the largest class probability) of each row."""
    found = model.transform(df)
    share = F.array_max(vector_to_array("probability")) if "probability" in found.columns else F.lit(None).cast("double")
    return found.select(*keep, "predicted_label", share.alias("probability_score"))


def label_names(model: PipelineModel) -> list[str]:
    """The labels a saved model decodes to, in the order of their indexes."""
    return next(list(s.getLabels()) for s in model.stages if isinstance(s, IndexToString))


def register_model(spark: SparkSession, registry_path: str, row: Mapping[str, object]) -> DataFrame:
    """Append one row to the registry and return the whole registry."""
    names = [f.split()[0] for f in REGISTRY_SCHEMA.split(", ")]
    spark.createDataFrame([tuple(row.get(n) for n in names)], REGISTRY_SCHEMA).write.mode("append").parquet(
        registry_path
    )
    return spark.read.schema(REGISTRY_SCHEMA).parquet(registry_path)
