"""Model training and scoring on the given tables (property checks)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tabloom.catalog.base import Tables, as_int, claims, query, rd
from tabloom.operators import encoding as E
from tabloom.operators import evaluation as V
from tabloom.operators import mixed as R
from tabloom.operators import models as L
from tabloom.operators.sgd import sgd_regression
from tabloom.operators.similarity import as_double
from tabloom.operators.windows import mean_importance
from tabloom.plans import research
from tabloom.plans.targets import train_targets
from tabloom.session import scratch_path, stored
from tabloom.sources.models import fit_labelled, load_model, register_model, save_model, score_labelled

DOC_FEATURES = ["n_chars", "n_words", "digit_share", "upper_share", "mark_share", "line_share", "word_length"]


def document_features(t: Tables):
    """Labelled documents with simple text shares over the whole text."""
    x, n = F.col("text"), F.greatest(F.length("text"), F.lit(1))
    words = F.size(F.split(x, r"\s+"))

    def share(pattern: str):
        return F.regexp_count(x, F.lit(pattern)) / n

    d = t.documents.join(t.labels, "doc_id")
    return d.select(
        "doc_id", "lang", F.col("quality").cast("double").alias("label"), F.col("toxic").cast("double").alias("toxic"),
        F.col("n_chars").cast("double").alias("n_chars"), words.cast("double").alias("n_words"), share("[0-9]").alias("digit_share"),
        share(r"\p{Lu}").alias("upper_share"), share(r"[^\p{L}\p{N}\s]").alias("mark_share"), share("\n").alias("line_share"),
        (n / words).alias("word_length"))


def labelled_vectors(t: Tables):
    """features + label (0/1: label below 5), and the original class."""
    d = t.embeddings.select("vec_id", F.col("label").alias("cls"), (F.col("label") < 5).cast("double").alias("label"),
                            as_double(F.col("embedding")).alias("vec"))
    return L.array_features(d, "vec")


def multiclass_vectors(t: Tables):
    return labelled_vectors(t).withColumn("label", F.col("cls").cast("double")).drop("cls")


def price_rows(t: Tables):
    """features + label for regression: extended price from the line and its part."""
    d = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("row_id"), "l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice",
        F.col("l_extendedprice").alias("label"))
    return E.assemble(d, ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"])


def _accuracy(scored, model: str):
    return scored.agg(F.lit(model).alias("model"), F.count("*").alias("n"),
                      rd(F.avg((F.col("label") == F.col("prediction")).cast("double")), 4).alias("accuracy"))


def _split(df, key):
    from tabloom.operators.sets import hash_split

    s = hash_split(df, key, 0.8)
    return s.where(F.col("part") == "train"), s.where(F.col("part") == "test")


def _stored_split(df, key, keep_key: bool = True):
    """The split of rows that many jobs read: joins and hashes are worked out once."""
    from tabloom.operators.sets import hash_split

    s = hash_split(df.select(key, "features", "label"), key, 0.8)
    s = stored(s if keep_key else s.drop(key), "split")
    return s.where(F.col("part") == "train"), s.where(F.col("part") == "test")


def _stack_rows(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@query("a15_model_registry")
def a15(t: Tables):
    d = document_features(t)
    idx = StringIndexer(inputCol="lang", outputCol="lang_label").fit(d)
    model = Pipeline(stages=[*E.feature_pipeline(["lang"], DOC_FEATURES).getStages(),
                             LogisticRegression(maxIter=20)]).fit(d)
    path = save_model(model, scratch_path(t.spark, "model"))
    same = load_model(path).transform(d).select("doc_id", F.col("prediction").alias("again")).join(
        model.transform(d).select("doc_id", "prediction"), "doc_id").where(F.col("again") != F.col("prediction")).count()
    reg = register_model(t.spark, scratch_path(t.spark, "registry"), {
        "model_name": "quality", "model_path": path, "family": "logistic", "metric": "changed_predictions", "value": float(same)})
    return reg.select("model_name", "family", "metric", "value").withColumn("classes", F.lit(len(idx.labels)))


@query("a15_decoded_model", """
select event_type, 'plan of ' || event_type as plan, count(*) as n, 1.0::double as probability_score from events group by event_type""")
def a15d(t: Tables):
    """Fitted, saved and loaded again; rows to score hold no label, and plans come back by name."""
    d = t.events.select("event_type", F.concat(F.lit("plan of "), "event_type").alias("plan"))
    path = save_model(fit_labelled(d, E.feature_pipeline(["event_type"], []).getStages(), "plan",
                                   DecisionTreeClassifier(maxDepth=6, seed=7)), scratch_path(t.spark, "model"))
    found = score_labelled(t.events.select("event_type"), load_model(path), ["event_type"])
    return found.groupBy("event_type", F.col("predicted_label").alias("plan")).agg(
        F.count("*").alias("n"), rd(F.avg("probability_score")).alias("probability_score"))


@query("l01_choose_classifier")
def l01(t: Tables):
    from pyspark.ml.tuning import ParamGridBuilder

    rf, lr = RandomForestClassifier(seed=7, numTrees=10), LogisticRegression(maxIter=20)
    grids = {"forest": (rf, ParamGridBuilder().addGrid(rf.maxDepth, [4, 6]).build()),
             "logistic": (lr, ParamGridBuilder().addGrid(lr.regParam, [0.01, 0.1]).build())}
    c = L.choose_classifier(multiclass_vectors(t), "vec_id", 4, grids)
    return t.spark.createDataFrame([(k, round(v, 4), k == c.family) for k, v in sorted(c.scores.items())],
                                   "family string, f1 double, chosen boolean")


@query("l02_forest_report")
def l02(t: Tables):
    _, cells = L.forest_report(multiclass_vectors(t), "vec_id", 10, 6)
    return cells


@query("l03_score_batch")
def l03(t: Tables):
    d = document_features(t)
    target = StringIndexer(inputCol="lang", outputCol="label_idx").fit(d)
    train = target.transform(d)
    model = Pipeline(stages=[*E.feature_pipeline([], DOC_FEATURES).getStages(),
                             RandomForestClassifier(labelCol="label_idx", numTrees=10, seed=7)]).fit(train)
    return L.score_batch(d, model, target.labels, ["doc_id"]).withColumn("probability_score", rd("probability_score", 4))


@query("l04_per_target_models")
def l04(t: Tables):
    d = document_features(t)
    d = E.dummies(d.withColumn("tongue", F.col("lang")), E.fit_domains(d.withColumnRenamed("lang", "tongue"), ["tongue"]))
    targets = [c for c in d.columns if c.startswith("tongue_=_")]
    saved = train_targets(d, targets, DOC_FEATURES, "doc_id", scratch_path(t.spark, "targets"), k=4, trees=10, rounds=5)
    return saved.drop("path").withColumns({"precision": rd("precision", 4), "accuracy": rd("accuracy", 4)})


@query("l05_tree_rules")
def l05(t: Tables):
    rules = L.tree_rules(document_features(t), DOC_FEATURES, "label", 3)
    return t.spark.createDataFrame([(i, line) for i, line in enumerate(rules.splitlines())], "line_no int, rule string")


@query("l06_linear_models")
def l06(t: Tables):
    train, test = _stored_split(price_rows(t), "row_id")
    out = []
    for kind in ("linear", "ridge", "lasso", "elastic"):
        m = L.grid_regression(train, kind, "row_id", folds=3, grid=(0.1, 10.0))
        out.append(V.regression_metrics(m.transform(test), "label", "prediction").withColumn("model", F.lit(kind)))
    return _stack_rows(out).select("model", "n", rd("mae", 2).alias("mae"), rd("r2", 5).alias("r2"))


@query("l06_sgd_regression", """
select 'quantity' as term, round(regr_slope(l_extendedprice, l_quantity), 4) as closed_form, 1 as sgd_within from lineitem
union all select 'intercept', round(regr_intercept(l_extendedprice, l_quantity), 4), 1 from lineitem""")
def l06s(t: Tables):
    """The gradient form beside the closed one: slope, and the line at the mean quantity, within 0.01 standard deviations."""
    d = t.lineitem.select(F.col("l_quantity").cast("double").alias("q"), F.col("l_extendedprice").cast("double").alias("y"))
    fit = sgd_regression(d, ["q"], "y", epochs=12)
    exact = d.agg(F.regr_slope("y", "q").alias("slope"), F.regr_intercept("y", "q").alias("cut"), F.avg("q").alias("q"), F.avg("y").alias("y"),
                  (F.stddev_pop("q") / F.stddev_pop("y")).alias("unit"), F.stddev_pop("y").alias("sd"))
    slope, cut = F.lit(fit.coefficients[0]), F.lit(fit.intercept)
    near = {"quantity": ("slope", F.abs(slope - F.col("slope")) * F.col("unit")),
            "intercept": ("cut", F.abs(cut + slope * F.col("q") - F.col("y")) / F.col("sd"))}
    rows = F.array(*[F.struct(F.lit(term).alias("term"), F.col(c).alias("c"), (gap < 0.01).alias("w")) for term, (c, gap) in near.items()])
    return exact.select(F.explode(rows).alias("r")).select("r.term", rd("r.c", 4).alias("closed_form"), as_int("r.w").alias("sgd_within"))


@query("l07_tree_families")
def l07(t: Tables):
    train, test = _stored_split(price_rows(t), "row_id", keep_key=False)
    out = [V.regression_metrics(L.tree_family(k, "regress", 10, 5).fit(train).transform(test), "label", "prediction").select(
        F.lit(k + " regress").alias("model"), "n", rd("r2", 4).alias("score")) for k in ("forest", "boosted")]
    a, b = _split(labelled_vectors(t), "vec_id")
    out += [_accuracy(L.tree_family(k, "classify", 10, 4).fit(a).transform(b), k + " classify").withColumnRenamed("accuracy", "score")
            for k in ("forest", "boosted")]
    return _stack_rows(out)


@query("l08_out_of_fold")
def l08(t: Tables):
    train, test = _split(labelled_vectors(t), "vec_id")
    oof, mean, models = L.out_of_fold(train, "vec_id", RandomForestClassifier(numTrees=10, seed=7), 3, "label", test)
    rows = [r for i, m in enumerate(models) for r in L.importances(m, [f"x{j}" for j in range(64)], i)]
    top = mean_importance(t.spark.createDataFrame(rows, "fold int, feature string, importance double"), 1)
    return _stack_rows([
        oof.agg(F.lit("out of fold").alias("what"), F.count("*").alias("n"), rd(F.avg("score"), 4).alias("value")),
        mean.agg(F.lit("mean test score").alias("what"), F.count("*").alias("n"), rd(F.avg("score"), 4).alias("value")),
        top.select(F.lit("top importance").alias("what"), F.lit(1).cast("long").alias("n"), rd("importance", 4).alias("value"))])


@query("l09_stacking")
def l09(t: Tables):
    d = labelled_vectors(t)
    scored, _ = L.stack(d, "vec_id", {"forest": RandomForestClassifier(numTrees=10, seed=7),
                                      "logistic": LogisticRegression(maxIter=20, regParam=0.1)}, 3)
    return _accuracy(scored, "stacked")


@query("l09_mean_of_models")
def l09m(t: Tables):
    d = labelled_vectors(t)
    train, test = _split(d, "vec_id")
    fits = {"forest": RandomForestClassifier(numTrees=10, seed=7), "logistic": LogisticRegression(maxIter=20, regParam=0.1)}
    scores = {k: e.fit(train).transform(test).select("vec_id", L.positive_probability().alias("score")) for k, e in fits.items()}
    return L.mean_of_models(scores, "vec_id").withColumn("score", rd("score", 4))


@query("l10_bagging")
def l10(t: Tables):
    train, test = _split(labelled_vectors(t), "vec_id")
    return _stack_rows([
        _accuracy(L.bagged_forest("classify", 20, 0.5, True).fit(train).transform(test), "bagged trees"),
        _accuracy(L.bagged_forest("classify", 20, 0.5, False).fit(train).transform(test), "pasted trees"),
        _accuracy(L.bagged_svms(train, "vec_id", 3, 0.5)(test), "bagged svms")])


@query("l11_boosted_weights")
def l11(t: Tables):
    train, test = _split(labelled_vectors(t), "vec_id")
    return _stack_rows([_accuracy(L.boost_stumps(train, 6)(test), "stumps"),
                        _accuracy(L.boost_stumps(train, 2, "logistic")(test), "logistic")])


@query("l12_linear_svm")
def l12(t: Tables):
    train, test = _split(labelled_vectors(t), "vec_id")
    return _accuracy(L.linear_svm().fit(train).transform(test), "linear svm")


@query("l14_decision_trees")
def l14(t: Tables):
    a, b = _split(labelled_vectors(t), "vec_id")
    c, d = _split(price_rows(t), "row_id")
    return _stack_rows([
        _accuracy(L.tree_family("tree", "classify").fit(a).transform(b), "tree classify").withColumnRenamed("accuracy", "score"),
        V.regression_metrics(L.tree_family("tree", "regress").fit(c).transform(d), "label", "prediction").select(
            F.lit("tree regress").alias("model"), "n", rd("r2", 4).alias("score"))])


@query("l15_feed_forward")
def l15(t: Tables):
    train, test = _split(labelled_vectors(t), "vec_id")
    return _accuracy(L.feed_forward(64).fit(train).transform(test), "feed forward")


@query("l16_synthesize")
def l16(t: Tables):
    rare = t.embeddings.join(t.embeddings.groupBy("label").count().orderBy("count", "label").limit(1).select("label"), "label", "left_semi")
    made = L.synthesize(rare, "vec_id", "embedding", 2, 5)
    return made.select("source_id", "neighbour_id", "copy", "u", F.size("vec").alias("dims"), rd(F.col("vec")[0], 6).alias("first"))


def rarest(t: Tables) -> int:
    return t.embeddings.groupBy("label").count().orderBy("count", "label").first()["label"]  # one row


_SHARES = """(with c as (select label from embeddings group by label order by count(*), label limit 1),
n as (select query_id, count(*) filter (base_label <> query_label) as n_other from (
   select a.vec_id as query_id, a.label as query_label, b.label as base_label, row_number() over (partition by a.vec_id
     order by round(list_distance(a.embedding::double[], b.embedding::double[]), 6), b.vec_id desc) as rn
   from embeddings a, embeddings b, c where a.vec_id <> b.vec_id and a.label = c.label) where rn <= 5 group by query_id),
s as (select query_id, n_other, 200 * n_other // sum(n_other) over () as base, 200 * n_other % sum(n_other) over () as rest from n)
select query_id as vec_id, n_other, cast(base + cast(row_number() over (order by rest desc, query_id) <= 200 - sum(base) over () as integer) as bigint) as n_new
from s)"""


@query("l16_density_counts", f"select * from {_SHARES}")
def l16c(t: Tables):
    return L.density_counts(t.embeddings, "vec_id", "embedding", "label", rarest(t), 200, 5)


@query("l16_density_points", f"""
select vec_id as source_id, n_new as n_points, 1 as on_the_way from {_SHARES} where n_new > 0""")
def l16p(t: Tables):
    """Every new point lies between its source and its neighbour, which is of the minority as well."""
    e, label = t.embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v")), rarest(t)
    made = L.synthesize_by_density(t.embeddings, "vec_id", "embedding", "label", label, 200, 5)
    both = made.join(e.select(F.col("vec_id").alias("source_id"), F.col("v").alias("a")), "source_id").join(
        e.where(F.col("label") == label).select(F.col("vec_id").alias("neighbour_id"), F.col("v").alias("b")), "neighbour_id")
    off = F.aggregate(F.zip_with("vec", F.zip_with("a", "b", lambda x, y: x + (y - x) * F.col("u")), lambda m, w: F.abs(m - w)),
                      F.lit(0.0), lambda s, x: s + x)
    return both.groupBy("source_id").agg(F.count("*").alias("n_points"), F.min(as_int((off < 1e-9) & F.col("u").between(0, 1))).alias("on_the_way"))


# -- random intercepts --------------------------------------------------------


def hierarchical(t: Tables):
    """Order value with priority dummies (level 1) and nation wealth (level 2)."""
    wealth = t.customer.groupBy(F.col("c_nationkey").alias("nation")).agg(F.avg("c_acctbal").alias("wealth"))
    d = claims(t).join(wealth, "nation")
    flags = {f"prio_{i}": F.col("priority").startswith(str(i)).cast("double") for i in (2, 3, 4, 5)}
    return d.withColumns({**flags, "y": F.col("amount") / 1000.0 + F.col("nation") * 3.0, "wealth": F.col("wealth") / 1000.0})


LEVEL1, LEVEL2 = ["prio_2", "prio_3", "prio_4", "prio_5"], ["wealth"]


@query("l18_random_intercept")
def l18(t: Tables):
    fits = research.fit_ladder(hierarchical(t), "y", "nation", LEVEL1, LEVEL2)
    shares = research.variance_shares(fits)
    table = R.comparison_table(t.spark, fits)
    return table.select("model", "n", "n_groups", *[rd(c, 4).alias(c) for c in ("var_group", "var_resid", "icc", "ll_reml")]).withColumn(
        "remaining_share", F.lit(round(shares["remaining"], 4)))


@query("m14_model_comparison")
def m14(t: Tables):
    fits = research.fit_ladder(hierarchical(t), "y", "nation", LEVEL1, LEVEL2)
    coefs = R.coefficient_table(t.spark, fits, 0.05)
    table = R.comparison_table(t.spark, fits).select("model", rd("ll_ml", 4).alias("ll_ml"), rd("aic", 4).alias("aic"), rd("bic", 4).alias("bic"),
                                                     rd("delta_aic", 4).alias("delta_aic"))
    return table.join(coefs.groupBy("model").agg(F.count("*").alias("significant_terms")), "model", "left")


@query("m11_mixed_residuals")
def m11(t: Tables):
    d = hierarchical(t)
    fit = R.fit_random_intercept(d, "y", LEVEL1, "nation")
    r = V.residual_diagnostics(R.with_predictions(d, fit), "residual", "fitted")
    return r.select(*[rd(c, 4).alias(c) for c in r.columns])


@query("l20_interaction_ols")
def l20(t: Tables):
    d = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return R.interaction_ols(d, "l_extendedprice", "l_quantity", "p_retailprice").select(
        "term", rd("coef", 4).alias("coef"), rd("p_value", 6).alias("p_value"))


@query("l21_refits")
def l21(t: Tables):
    d = hierarchical(t)
    out = research.refits(d, "y", ["prio_2", "wealth"], ["nation", "plan"], ["wealth"], [("prio_2", "wealth")])
    return out.select("model", "n", "n_groups", rd("icc", 4).alias("icc"), rd("aic", 2).alias("aic"))
