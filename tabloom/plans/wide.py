"""Wide-table preparation: prune -> encode -> forest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame

from tabloom.operators.encoding import (
    constant_columns,
    correlated_columns,
    drop_columns,
    feature_pipeline,
    null_bearing_columns,
    sparse_columns,
)
from tabloom.operators.models import forest_report
from tabloom.operators.shaping import names_by_type, to_numeric


def prune(df: DataFrame, keep: Sequence[str], numeric_text: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Sparse, constant, correlated and null-bearing columns out, in that order."""
    gone: list[str] = []

    def drop(frame: DataFrame, cols: Sequence[str]) -> DataFrame:
        cols = [c for c in cols if c not in keep]
        gone.extend(cols)
        return drop_columns(frame, cols)

    df = drop(df, sparse_columns(df))
    df = drop(df, constant_columns(df))
    df = to_numeric(df, [c for c in numeric_text if c in df.columns]) if numeric_text else df
    df = drop(df, correlated_columns(df, [c for c in names_by_type(df)[0] if c not in keep]))
    df = drop(df, null_bearing_columns(df))
    return df, gone


def prune_encode_forest(
    df: DataFrame, key: str, label: str, numeric_text: Sequence[str] = (), trees: int = 10, depth: int = 5
) -> tuple[DataFrame, DataFrame, list[str]]:
    """(scored test rows, confusion counts, dropped columns)."""
    ready, gone = prune(df, [key, label], numeric_text)
    numeric, text = names_by_type(ready)
    numeric = [c for c in numeric if c not in (key, label)]
    text = [c for c in text if c not in (key, label)]
    indexed = StringIndexer(inputCol=label, outputCol="label", handleInvalid="skip").fit(ready).transform(ready)
    feats = feature_pipeline(text, numeric).fit(indexed).transform(indexed).select(key, "label", "features")
    scored, cells = forest_report(feats, key, trees, depth)
    return scored, cells, gone
