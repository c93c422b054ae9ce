import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.operators import encoding as E
from tabloom.operators import mixed as R
from tabloom.operators import models as L
from tabloom.operators.evaluation import vif


@pytest.fixture(scope="module")
def separable(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 4))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(float)
    pdf = pd.DataFrame(x, columns=list("abcd")).assign(label=y, id=np.arange(400))
    return E.assemble(spark.createDataFrame(pdf), list("abcd")).persist()


def test_balanced_design_reml_is_anova(spark):
    rng = np.random.default_rng(7)
    k, m = 30, 8
    u = np.repeat(rng.normal(0, 2, k), m)
    pdf = pd.DataFrame({"g": np.repeat(np.arange(k), m), "y": 5 + u + rng.normal(0, 1, k * m)})
    df = spark.createDataFrame(pdf)
    fit = R.fit_random_intercept(df, "y", [], "g")
    a = R.anova_icc(df, "y", "g").first()
    assert fit.var_resid == pytest.approx(a["msw"], rel=1e-4)
    assert fit.var_group == pytest.approx(a["var_group"], rel=1e-3)
    assert fit.icc == pytest.approx(a["icc"], rel=1e-3)
    assert fit.coef[0] == pytest.approx(pdf.y.mean())


def test_the_fit_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(10)
    g = np.sort(rng.integers(0, 20, 400))
    df = spark.createDataFrame(pd.DataFrame({"g": g, "x": rng.normal(size=400), "y": rng.normal(size=20)[g] + rng.normal(size=400)}))
    here = R.fit_random_intercept(df, "y", ["x"], "g", rounds=2)
    there = R.fit_random_intercept(df.repartition(13), "y", ["x"], "g", rounds=2)
    assert there.coef == pytest.approx(here.coef) and there.icc == pytest.approx(here.icc) and there.groups == here.groups == 20


def test_mixed_slope_and_residuals(spark):
    rng = np.random.default_rng(8)
    n, k = 1200, 40
    g = rng.integers(0, k, n)
    x = rng.normal(10, 3, n)
    y = 2 + 0.7 * x + rng.normal(0, 1.5, k)[g] + rng.normal(0, 1, n)
    df = spark.createDataFrame(pd.DataFrame({"g": g, "x": x, "y": y}))
    fit = R.fit_random_intercept(df, "y", ["x"], "g")
    assert fit.coef[1] == pytest.approx(0.7, abs=0.05)
    assert fit.var_group == pytest.approx(2.25, rel=0.6) and fit.var_resid == pytest.approx(1, rel=0.15)
    assert fit.p_values[1] < 1e-6
    # direct GLS check of the slope at the fitted ratio
    lam = fit.var_group / fit.var_resid
    X = np.column_stack([np.ones(n), x])
    A, b = X.T @ X, X.T @ y
    for i in range(k):
        s, t, m = X[g == i].sum(0), y[g == i].sum(), (g == i).sum()
        A, b = A - lam / (1 + m * lam) * np.outer(s, s), b - lam / (1 + m * lam) * s * t
    beta = np.linalg.solve(A, b)
    assert fit.coef == pytest.approx(beta, rel=1e-6)
    out = R.with_predictions(df, fit)
    assert out.count() == n
    assert out.agg(F.stddev("residual")).first()[0] == pytest.approx(1, rel=0.15)


def test_vif_matches_numpy(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 3))
    x[:, 2] += x[:, 0]
    got = {r["variable"]: r["vif"] for r in vif(spark.createDataFrame(pd.DataFrame(x, columns=list("abc"))), list("abc")).collect()}
    for i, c in enumerate("abc"):
        others = np.delete(x, i, 1)
        coef, *_ = np.linalg.lstsq(others, x[:, i], rcond=None)
        r2 = 1 - ((x[:, i] - others @ coef) ** 2).sum() / (x[:, i] ** 2).sum()
        assert got[c] == pytest.approx(1 / (1 - r2))


def test_boosting_learns(separable):
    out = L.boost_stumps(separable, rounds=8)(separable)
    acc = out.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert acc > 0.85 and out.count() == 400


def test_out_of_fold_covers_each_row_once(separable):
    from pyspark.ml.classification import LogisticRegression

    oof, _, models = L.out_of_fold(separable, "id", LogisticRegression(maxIter=10), 3, "label")
    assert oof.count() == 400 and oof.select("id").distinct().count() == 400 and len(models) == 3


def test_recursive_elimination_keeps_signal(separable):
    assert "a" in E.recursive_elimination(separable.drop("features"), "label", list("abcd"), keep=2, trees=10)


def test_synthetic_points_lie_between(spark):
    df = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(12)], "id long, v array<double>")
    made = L.synthesize(df, "id", "v", 2, 3).collect()
    assert len(made) == 24
    for r in made:
        lo, hi = sorted((r["source_id"], r["neighbour_id"]))
        assert lo <= r["vec"][0] <= hi and r["source_id"] != r["neighbour_id"]


def test_model_round_trip(separable, tmp_path, spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression

    from tabloom.sources.models import load_model, register_model, save_model

    m = Pipeline(stages=[LogisticRegression(maxIter=5)]).fit(separable)
    path = save_model(m, str(tmp_path / "m"))
    a = m.transform(separable).select("id", "prediction")
    b = load_model(path).transform(separable).select("id", "prediction")
    assert a.exceptAll(b).count() == 0
    for _ in range(2):
        reg = register_model(spark, str(tmp_path / "reg"), {"model_name": "x", "value": 1.0})
    assert reg.count() == 2


def test_fill_by_tree_leaves_no_null(spark):
    df = spark.createDataFrame([(float(i), float(i % 5) if i % 3 else None) for i in range(60)], "x double, age double")
    assert E.fill_by_tree(df, "age", ["x"]).where("age is null").count() == 0


def test_density_counts_add_up_and_follow_the_crowd(spark):
    rng = np.random.default_rng(3)
    rare = [(i, [float(x) for x in rng.normal(size=2)], 1) for i in range(30)]
    common = [(100 + i, [float(x) for x in rng.normal(size=2) + np.array([1.5, 0])], 0) for i in range(200)]
    df = spark.createDataFrame([*rare, *common, (999, [0.0, 0.1], None)], "k long, v array<double>, y int").repartition(4)
    counts = {r["k"]: r for r in L.density_counts(df, "k", "v", "y", 1, 77, 5).collect()}
    assert sorted(counts) == list(range(30)) and sum(r["n_new"] for r in counts.values()) == 77
    total = sum(r["n_other"] for r in counts.values())
    assert all(abs(r["n_new"] - 77 * r["n_other"] / total) < 1 for r in counts.values())
    made = sorted(tuple(r)[:4] for r in L.synthesize_by_density(df, "k", "v", "y", 1, 77, 5).collect())
    again = sorted(tuple(r)[:4] for r in L.synthesize_by_density(df.repartition(7), "k", "v", "y", 1, 77, 5).collect())
    assert len(made) == 77 and made == again and all(m[1] < 30 for m in made)
    # nobody of another class near: no new points
    alone = df.where("y = 1")
    assert {r["n_new"] for r in L.density_counts(alone, "k", "v", "y", 1, 77, 5).collect()} == {0}
    assert L.synthesize_by_density(alone, "k", "v", "y", 1, 77, 5).count() == 0


def test_saved_labels_come_back_by_name(spark, tmp_path):
    from pyspark.ml.classification import DecisionTreeClassifier

    from tabloom.sources.models import fit_labelled, label_names, load_model, save_model, score_labelled

    df = spark.createDataFrame([("x", "zeta"), ("y", "alpha"), ("y", "alpha"), ("x", "zeta"), ("x", None)] * 10, "c string, plan string")
    path = save_model(fit_labelled(df, E.feature_pipeline(["c"], []).getStages(), "plan", DecisionTreeClassifier(seed=1)), str(tmp_path / "m"))
    model = load_model(path)
    assert label_names(model) == ["alpha", "zeta"]
    out = score_labelled(df.select("c"), model, ["c"]).distinct().collect()
    assert sorted(map(tuple, out)) == [("x", "zeta", 1.0), ("y", "alpha", 1.0)]


@pytest.mark.parametrize("kind", ["ridge", "lasso", "elastic"])
def test_a_grid_searched_on_sums_is_the_search_on_rows(spark, kind):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import LinearRegression
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 3)) * [1, 50, 1] + [0, 1000, 5]
    pdf = pd.DataFrame(x, columns=list("abc")).assign(label=3 * x[:, 0] - 0.1 * x[:, 1] + rng.normal(0, 4, 120), id=np.arange(120))
    df = E.assemble(spark.createDataFrame(pdf), list("abc"))
    mix = {"ridge": [0.0], "lasso": [1.0], "elastic": [0.25, 0.5, 0.75]}[kind]
    lr = LinearRegression(maxIter=50)
    maps = ParamGridBuilder().addGrid(lr.regParam, [0.05, 5.0]).addGrid(lr.elasticNetParam, mix).build()
    folded = L.assign_folds(df, "id", 3).select("features", "label", "fold")
    want = CrossValidator(estimator=lr, estimatorParamMaps=maps, numFolds=3, foldCol="fold", evaluator=RegressionEvaluator(metricName="rmse")).fit(folded)
    points = L.moment_points(folded, "features", "label", "fold")
    assert points.count() == 3 * 2 * 4
    on_sums = L._search(lr.copy({lr.weightCol: "weight"}), maps, 3, RegressionEvaluator(metricName="rmse", weightCol="weight")).fit(points)
    assert on_sums.avgMetrics == pytest.approx(want.avgMetrics, rel=1e-6)
    got = L.grid_regression(df, kind, "id", 3, (0.05, 5.0))
    assert [*got.coefficients, got.intercept] == pytest.approx([*want.bestModel.coefficients, want.bestModel.intercept])
    assert got.summary.rootMeanSquaredError == pytest.approx(want.bestModel.summary.rootMeanSquaredError)


def test_sums_of_missing_values_are_refused(spark):
    df = spark.createDataFrame([(0, 1.0), (1, None), (2, 3.0)], "fold int, label double").withColumn("a", F.lit(1.0))
    assert L.moment_points(E.assemble(df, ["a"]), "features", "label", "fold") is None


def test_models_read_stored_rows(spark):
    from tabloom.catalog import modelling as M

    df = E.assemble(spark.range(50).select("id", F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("label")).join(
        spark.range(40), "id"), ["a"])
    stored, plain = M._stored_split(df, "id"), M._split(df, "id")
    for got, want in zip(stored, plain):
        assert sorted(map(tuple, got.select("id", "features", "label").collect())) == sorted(map(tuple, want.select("id", "features", "label").collect()))
        assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_boosted_regressions_are_fitted_on_cells_with_the_same_trees(spark, monkeypatch):
    rng = np.random.default_rng(12)
    x = np.column_stack([rng.integers(0, 6, 4000) / 2, rng.choice([-1.0, 0.0, 7.0], 4000, p=[0.495, 0.495, 0.01]), rng.integers(1, 9, 4000)])
    pdf = pd.DataFrame(x, columns=list("abc")).assign(label=x[:, 0] * x[:, 2] + 5 * (x[:, 1] > 0) + rng.normal(size=4000))
    df = E.assemble(spark.createDataFrame(pdf), list("abc")).persist()
    monkeypatch.setattr(L, "CELL_ROWS", 1000, raising=False)
    fitted, plain = [], L.GBTRegressor._fit
    monkeypatch.setattr(L.GBTRegressor, "_fit", lambda self, data: fitted.append(data.count()) or plain(self, data), raising=False)
    model = L.tree_family("boosted", "regress", 5, 3).fit(df)
    assert fitted == [len(pdf.drop_duplicates(list("abc")))]  # before: all 4,000 rows
    rows = L.GBTRegressor(maxIter=5, maxDepth=3, seed=L.SEED).fit(df)
    assert model.treeWeights == rows.treeWeights
    a, b = (np.array([r[0] for r in m.transform(df).select("prediction").collect()]) for m in (model, rows))
    assert np.allclose(a, b, rtol=1e-9)


def test_cells_of_continuous_values_cover_all_rows(spark, monkeypatch):
    monkeypatch.setattr(L, "CELL_ROWS", 1000)
    rng = np.random.default_rng(13)
    pdf = pd.DataFrame({"a": rng.exponential(size=5000), "b": rng.integers(0, 4, 5000).astype(float), "label": rng.normal(size=5000)})
    df = E.assemble(spark.createDataFrame(pdf), ["a", "b"])
    cells = L.tree_cells(df, "features", "label", 32).toPandas()
    assert cells.weight.sum() == 5000 and 100 < len(cells) <= 128
    assert (cells.label * cells.weight).sum() == pytest.approx(pdf.label.sum())
    sizes = cells.assign(a=[f[0] for f in cells.features]).groupby("a").weight.sum()
    assert len(sizes) == 32 and sizes.max() < 2 * 5000 / 32
    # nothing to gain, too few rows, or a value that a fit refuses: the rows themselves are fitted
    assert L.tree_cells(df, "features", "label", 2000) is None
    assert L.tree_cells(df.limit(500), "features", "label", 32) is None
    odd = df.withColumn("label", F.when(F.col("b") > 2, float("nan")).otherwise(F.col("label")))
    assert L.tree_cells(odd, "features", "label", 32) is None
