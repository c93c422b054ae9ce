"""Metrics and diagnostics as aggregates."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.ordered import running_totals


def _count(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def binary_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """TP/FP/TN/FN, precision, recall, F1, accuracy in one pass (0 when undefined)."""
    y, p = F.col(label) == 1, F.col(pred) == 1
    row = df.agg(_count(y & p).alias("tp"), _count(~y & p).alias("fp"),
                 _count(~y & ~p).alias("tn"), _count(y & ~p).alias("fn"))
    precision = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return row.withColumns({
        "precision": precision,
        "recall": recall,
        "f1": _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")),
        "accuracy": _ratio(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")),
    })


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(F.count("*").alias("n"))


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class precision, recall, F1, support, from the confusion counts."""
    cells = confusion(df, label, pred)
    both = cells.select(F.explode(F.array(
        F.struct(F.col("label").alias("cls"), F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
                 .alias("hit"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("long").alias("hit"),
                 F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")),
    )).alias("e")).select("e.*")
    t = both.groupBy("cls").agg(F.sum("hit").alias("hit"), F.sum("support").alias("support"),
                                F.sum("predicted").alias("predicted"))
    return t.select(
        "cls", "support",
        _ratio(F.col("hit"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hit"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hit"), F.col("predicted") + F.col("support")).alias("f1"),
    )


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score (pre-aggregated)."""
    return df.groupBy(F.col(score).alias("score")).agg(
        _count(F.col(label) == 1).alias("pos"), _count(F.col(label) != 1).alias("neg")
    )


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Rank-sum ROC AUC with ties at half weight."""
    run = running_totals(score_counts(df, label, score), ["score"], ["pos", "neg"])
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") * 0.5))
    return run.agg(F.try_divide(wins, F.max("pos_total").cast("double") * F.max("neg_total")).alias("auc"))


def roc_pr_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """One point per distinct threshold: fpr, tpr (= recall), precision."""
    counts = score_counts(df, label, score).withColumn("_down", -F.col("score"))
    run = running_totals(counts, ["_down"], ["pos", "neg"])
    tp, fp = F.col("pos_before") + F.col("pos"), F.col("neg_before") + F.col("neg")
    return run.select(
        F.col("score").alias("threshold"),
        F.try_divide(fp.cast("double"), F.col("neg_total")).alias("fpr"),
        F.try_divide(tp.cast("double"), F.col("pos_total")).alias("tpr"),
        F.try_divide(tp.cast("double"), tp + fp).alias("precision"),
    )


def regression_metrics(df: DataFrame, truth: str, pred: str, log_target: bool = False) -> DataFrame:
    """MAE, MSE, RMSE, R2 (and RMSE of log1p values on request)."""
    y, p = F.col(truth).cast("double"), F.col(pred).cast("double")
    aggs = [F.count("*").alias("n"), F.avg(F.abs(y - p)).alias("mae"), F.avg((y - p) * (y - p)).alias("mse"),
            F.var_pop(y).alias("_v")]
    if log_target:
        aggs.append(F.sqrt(F.avg(F.pow(F.log1p(y) - F.log1p(p), 2))).alias("rmse_log"))
    return df.agg(*aggs).withColumns({
        "rmse": F.sqrt("mse"), "r2": 1.0 - F.try_divide(F.col("mse"), F.col("_v"))
    }).drop("_v")


def fold_summary(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """(metric, mean, std) over folds; population deviation."""
    long = df.select(*[F.col(m).cast("double").alias(m) for m in metrics]).unpivot([], list(metrics), "metric", "v")
    return long.groupBy("metric").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))


def outcome_lists(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Adds ``outcome``: correct error, missed error, false alarm, correct pass."""
    y, p = F.col(label) == 1, F.col(pred) == 1
    out = F.when(y & p, "caught").when(y & ~p, "missed").when(~y & p, "false alarm").otherwise("passed")
    return df.withColumn("outcome", out)


def error_rate(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.count("*").alias("n"), _count(F.col(label) == 1).alias("errors"),
                  F.avg((F.col(label) == 1).cast("double")).alias("error_rate"))


def residual_diagnostics(df: DataFrame, resid: str, fitted: str) -> DataFrame:
    r = F.col(resid)
    return df.agg(
        F.stddev(r).alias("resid_std"), F.min(r).alias("resid_min"), F.max(r).alias("resid_max"),
        F.corr(F.abs(r), F.col(fitted)).alias("abs_resid_fitted_corr"),
    )


def jarque_bera(df: DataFrame, col: str) -> DataFrame:
    """Normality check from moments; p-value of the chi-square with 2 df."""
    m = df.where(F.col(col).isNotNull()).agg(
        F.count("*").alias("n"), F.skewness(col).alias("skewness"), F.kurtosis(col).alias("kurtosis"))
    jb = F.col("n") / 6.0 * (F.pow("skewness", 2) + F.pow("kurtosis", 2) / 4.0)
    return m.withColumn("jb", jb).withColumn("p_value", F.exp(-F.col("jb") / 2.0))


def gram(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """X'X of the columns as one aggregate row (p x p on the driver)."""
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    row = df.agg(*[F.sum(F.col(cols[i]).cast("double") * F.col(cols[j]).cast("double")) for i, j in pairs]).first()
    out = np.zeros((len(cols), len(cols)))
    for (i, j), v in zip(pairs, row, strict=True):
        out[i, j] = out[j, i] = v
    return out


def vif(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Variance inflation without a constant (uncentred), from X'X."""
    g = gram(df.dropna(subset=list(cols)), cols)
    values = np.diag(g) * np.diag(np.linalg.inv(g))
    return df.sparkSession.createDataFrame(
        [(c, float(v)) for c, v in zip(cols, values, strict=True)], "variable string, vif double")


def threshold_table(df: DataFrame, label: str, p: str, thresholds: Sequence[float]) -> DataFrame:
    """(threshold, tp, fp, fn, tn): all thresholds in one aggregate row."""
    y, s = F.col(label) == 1, F.col(p)
    aggs = []
    for i, t in enumerate(thresholds):
        hit = s >= F.lit(float(t))
        aggs += [_count(y & hit).alias(f"tp{i}"), _count(~y & hit).alias(f"fp{i}"),
                 _count(y & ~hit).alias(f"fn{i}"), _count(~y & ~hit).alias(f"tn{i}")]
    entries = F.array(*[
        F.struct(F.lit(i).alias("step"), F.lit(float(t)).alias("threshold"),
                 *[F.col(f"{m}{i}").alias(m) for m in ("tp", "fp", "fn", "tn")])
        for i, t in enumerate(thresholds)
    ])
    return df.agg(*aggs).select(F.explode(entries).alias("e")).select("e.*")


def f2_thresholds(lo: float = 0.2, hi: float = 0.8, points: int = 20) -> list[float]:
    return [lo + (hi - lo) * i / (points - 1) for i in range(points)]


def best_threshold(df: DataFrame, label: str, p: str, thresholds: Sequence[float], score: str = "f2") -> DataFrame:
    """The threshold of best F2 or weighted F1; the first wins on ties; 0.5 when
    none scores above zero."""
    t = threshold_table(df, label, p, thresholds)
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    if score == "f2":
        value = _ratio(5 * tp, 5 * tp + 4 * fn + fp)
    else:
        f_pos, f_neg = _ratio(2 * tp, 2 * tp + fp + fn), _ratio(2 * tn, 2 * tn + fp + fn)
        value = _ratio(f_pos * (tp + fn) + f_neg * (tn + fp), tp + fn + tn + fp)
    best = t.withColumn("score", value).agg(
        F.max_by(F.struct("threshold", "score"), F.struct("score", -F.col("step"))).alias("b"))
    return best.select(
        F.when(F.col("b.score") > 0, F.col("b.threshold")).otherwise(F.lit(0.5)).alias("threshold"),
        F.col("b.score").alias("score"),
    )


def normal_p(z: float) -> float:
    """Two-sided p-value of a standard normal statistic."""
    return math.erfc(abs(z) / math.sqrt(2.0))
