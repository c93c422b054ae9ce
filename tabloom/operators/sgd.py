"""Linear regression by stochastic gradient descent, partition by partition.

Each epoch every task goes through its rows in mini-batches, starting from the same
parameters; Spark averages what the tasks end with, weighted by their rows. Only
that average (one number per feature) reaches the driver and the next epoch's tasks.
Rows are standardised and stored once, so all epochs see the same partitions and a
repeated task the same batches. Every epoch's parameters are appended to a state
folder: a job that is started again goes on behind the last one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.session import scratch_path

STATE = "epoch int, weights array<double>, loss double, n bigint"


@dataclass(frozen=True)
class LinearFit:
    """Coefficients on the original scale, and the loss (half mean squared error, standardised) of each epoch."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    losses: tuple[float, ...]

    def predict(self) -> Column:
        out = F.lit(self.intercept)
        for c, b in zip(self.features, self.coefficients):
            out = out + F.col(c).cast("double") * b
        return out


def _standardised(df: DataFrame, features: Sequence[str], label: str) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Rows without nulls or NaN as one array (features, label), stored; means and widths."""
    names = [*features, label]
    rows = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    whole = F.lit(True)
    for c in rows.columns:
        whole = whole & (F.abs(c) < float("inf"))
    rows = rows.where(whole)
    stats = rows.agg(*[F.avg(c) for c in rows.columns], *[F.stddev_pop(c) for c in rows.columns]).first()
    means = np.array([x or 0.0 for x in stats[: len(names)]])
    widths = np.array([x or 1.0 for x in stats[len(names):]])  # a constant stays 0
    scaled = F.array(*[(F.col(c) - F.lit(float(m))) / F.lit(float(w)) for c, m, w in zip(rows.columns, means, widths)])
    path = scratch_path(df.sparkSession, "sgd-rows")
    rows.select(scaled.alias("x")).write.parquet(path)
    return df.sparkSession.read.schema("x array<double>").parquet(path), means, widths


def _epoch(weights: np.ndarray, step: int, rate: float, power: float, l2: float, batch: int, seed: int):
    """One task's pass: its end parameters times its rows, its loss sum before each batch, its rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, n, loss, done = weights.copy(), 0, 0.0, step
        for k, rows in enumerate(batches):
            if not rows.num_rows:
                continue
            flat = rows.column(0).flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
            flat = flat[np.random.default_rng([seed, step, k]).permutation(len(flat))]
            for first in range(0, len(flat), batch):
                part = flat[first: first + batch]
                x, y = part[:, :-1], part[:, -1]
                error = x @ w[:-1] + w[-1] - y
                loss += float(error @ error) / 2
                done += 1
                eta = rate / done**power
                w[:-1] -= eta * (x.T @ error / len(part) + l2 * w[:-1])
                w[-1] -= eta * error.mean()
            n += rows.num_rows
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([(w * n).tolist()], pa.list_(pa.float64())), pa.array([loss]), pa.array([n], pa.int64()), pa.array([done - step], pa.int64())],
                ["w", "loss", "n", "steps"])

    return run


def _resume(spark: SparkSession, path: str) -> list:
    try:
        return spark.read.schema(STATE).parquet(path).orderBy("epoch").collect()  # one small row an epoch
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return []


def sgd_regression(
    df: DataFrame, features: Sequence[str], label: str, epochs: int = 20, rate: float = 0.05, power: float = 0.25,
    l2: float = 0.0, batch: int = 64, tolerance: float = 1e-6, seed: int = 1, state_path: str | None = None,
) -> LinearFit:
    """Fits ``label`` on ``features``; stops after ``epochs``, or when the loss improves by less than ``tolerance``.

    The step of batch t is ``rate / t**power``, counted over the epochs by the mean number of batches of a task.
    Rows with a null, NaN or infinite value are left out; without rows all parameters are 0.
    """
    rows, means, widths = _standardised(df, features, label)
    spark, p = df.sparkSession, len(features)
    state_path = state_path or scratch_path(spark, "sgd-state")
    past = _resume(spark, state_path)
    weights = np.array(past[-1]["weights"]) if past else np.zeros(p + 1)
    losses = [r["loss"] for r in past]
    steps = sum(r["n"] for r in past)
    for epoch in range(len(past), epochs):
        if len(losses) > 1 and losses[-2] - losses[-1] < tolerance:
            break
        ends = rows.mapInArrow(_epoch(weights, steps, rate, power, l2, batch, seed), "w array<double>, loss double, n bigint, steps bigint")
        total = ends.agg(
            F.array(*[F.sum(F.get("w", F.lit(i))) for i in range(p + 1)]).alias("w"), F.sum("loss").alias("loss"),
            F.sum("n").alias("n"), F.ceil(F.avg("steps")).alias("steps")).first()
        if not total["n"]:
            break
        weights = np.array(total["w"]) / total["n"]
        losses.append(total["loss"] / total["n"])
        steps += total["steps"]
        spark.createDataFrame([(epoch, weights.tolist(), losses[-1], int(total["steps"]))], STATE).write.mode("append").parquet(state_path)
    slopes = weights[:-1] * widths[-1] / widths[:-1]
    intercept = means[-1] + weights[-1] * widths[-1] - float(slopes @ means[:-1])
    return LinearFit(tuple(features), tuple(slopes.tolist()), float(intercept), tuple(losses))
