"""Stochastic gradient regression against the closed form."""

import numpy as np
import pytest

from tabloom.operators.sgd import sgd_regression


def table(spark, n, p=3, noise=0.5, parts=5, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p)) * np.array([1.0, 30.0, 0.01])[:p] + np.array([5.0, -100.0, 2.0])[:p]
    y = x @ np.array([2.0, -0.3, 150.0])[:p] + 7 + rng.normal(size=n) * noise
    names = [f"f{i}" for i in range(p)]
    rows = [tuple(float(v) for v in r) for r in np.column_stack([x, y])]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*names, "y"])).repartition(parts)
    return df, names, x, y


def test_coefficients_near_the_closed_form(spark):
    df, names, x, y = table(spark, 6000)
    fit = sgd_regression(df, names, "y", epochs=15)
    want = np.linalg.lstsq(np.column_stack([x, np.ones(len(x))]), y, rcond=None)[0]
    assert np.allclose(np.array(fit.coefficients) * x.std(0), want[:-1] * x.std(0), atol=0.02 * y.std())
    residual = y - x @ np.array(fit.coefficients) - fit.intercept
    best = y - np.column_stack([x, np.ones(len(x))]) @ want
    assert (residual @ residual) < 1.02 * (best @ best)
    assert fit.losses[-1] < fit.losses[0]
    predicted = df.select(fit.predict().alias("p"), "y").toPandas()
    assert np.abs((predicted["y"] - predicted["p"]).mean()) < 0.05


def test_goes_on_from_its_state_and_repeats_itself(spark, tmp_path):
    df, names, *_ = table(spark, 500, noise=3.0)
    one = df.coalesce(1)
    whole = sgd_regression(one, names, "y", epochs=6, tolerance=-1.0)
    sgd_regression(one, names, "y", epochs=2, tolerance=-1.0, state_path=str(tmp_path / "s"))
    again = sgd_regression(one, names, "y", epochs=6, tolerance=-1.0, state_path=str(tmp_path / "s"))
    assert again.losses == whole.losses and again.coefficients == pytest.approx(whole.coefficients)
    ridge = sgd_regression(one, names, "y", epochs=6, l2=0.5)
    assert sum(abs(b) for b in ridge.coefficients) < sum(abs(b) for b in whole.coefficients)


def test_odd_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0, 7.0), (2.0, 4.0, 7.0), (3.0, 6.0, 7.0), (None, 1.0, 7.0), (float("nan"), 1.0, 7.0), (4.0, None, 7.0)],
                               "a double, y double, k double")
    fit = sgd_regression(df, ["a", "k"], "y", epochs=60, rate=0.2, batch=2, tolerance=0.0)
    assert fit.coefficients[0] == pytest.approx(2.0, abs=0.1) and fit.coefficients[1] == pytest.approx(0.0)
    empty = sgd_regression(df.limit(0), ["a"], "y")
    assert empty.coefficients == (0.0,) and empty.intercept == 0.0 and empty.losses == ()
