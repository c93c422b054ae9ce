"""Order-based operators against pandas, with one group holding most rows."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from tests.helpers import rows
from pyspark.sql import functions as F

from tabloom.operators import sets as H
from tabloom.operators import windows as Wn
from tabloom.operators.evaluation import auc
from tabloom.operators.ordered import exact_quantiles, positions, previous_value, top_per_group


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(1)
    n = 6000
    g = np.where(rng.random(n) < 0.6, "hot", rng.choice(list("abcde"), n))
    pdf = pd.DataFrame({"id": np.arange(n), "g": g, "x": np.round(rng.normal(0, 50, n), 1)})
    pdf.loc[pdf.id % 13 == 0, "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    df = df.withColumn("g", F.when(F.col("id") % 997 != 0, F.col("g")))
    pdf.loc[pdf.id % 997 == 0, "g"] = None
    return df.persist(), pdf


def test_quantiles_equal_pandas(skewed):
    df, pdf = skewed
    got = {r["g"]: (r["n"], r["q0"], r["q1"]) for r in exact_quantiles(df, ["x"], [0.1, 0.5], ["g"]).collect()}
    want = pdf.groupby("g", dropna=False).x
    for g, s in want:
        s = s.dropna()
        key = None if not isinstance(g, str) else g
        assert got[key][0] == len(s)
        assert got[key][1:] == pytest.approx((s.quantile(0.1), s.quantile(0.5)))


def test_quantiles_of_large_groups_use_brackets(spark):
    rng = np.random.default_rng(11)
    n = 60_000
    pdf = pd.DataFrame({"g": np.where(rng.random(n) < 0.7, "hot", "cold"), "x": np.exp(rng.normal(0, 3, n))})
    pdf.loc[pdf.index % 5 == 0, "x"] = 1.5  # a value of many copies
    probs = [0.0, 0.001, 0.5, 0.75, 0.9999, 1.0]
    df = spark.createDataFrame(pdf)
    for r in exact_quantiles(df, ["x"], probs, ["g"]).collect():
        want = pdf[pdf.g == r["g"]].x.quantile(probs)
        assert [r[f"q{i}"] for i in range(len(probs))] == pytest.approx(list(want))


def test_rows_of_one_key_stay_together(spark):
    df = spark.createDataFrame(pd.DataFrame({"k": np.where(np.arange(3000) < 1000, 7, np.arange(3000)), "g": "a"}))
    for out, flag in ((H.exact_holdout(df, "k", 50), "is_holdout"), (H.assign_stratified_folds(df, "g", "k", 3), "fold")):
        assert out.count() == 3000
        assert out.groupBy("k").agg(F.countDistinct(flag).alias("d")).where("d > 1").count() == 0


@pytest.mark.parametrize("partitions", [1, 7, 32])
def test_previous_value_and_partition_counts(skewed, partitions):
    df, pdf = skewed
    prev = previous_value(df.repartition(partitions), ["g"], ["id"], "x", "p").collect()
    want = pdf.sort_values("id").groupby("g", dropna=False).x.shift(1)
    want = dict(zip(pdf.id, want, strict=True))
    for r in prev:
        w = want[r["id"]]
        assert r["p"] == (None if pd.isna(w) else w)


def test_positions_are_a_permutation(skewed):
    df, _ = skewed
    got = positions(df, ["id"], "pos").select("id", "pos").collect()
    assert all(r["id"] == r["pos"] for r in got) and len(got) == 6000


def test_first_by_hash_is_exact(skewed):
    df, pdf = skewed
    import hashlib

    pdf = pdf.assign(h=[hashlib.md5(str(i).encode()).hexdigest() for i in pdf.id])
    got = {r["id"] for r in H.flag_first_by_hash(df, "id", 100, ["g"]).where("is_first").collect()}
    want = set(pdf.sort_values(["h", "id"]).groupby("g", dropna=False).head(100).id)
    assert got == want
    assert {r["id"] for r in H.exact_holdout(df, "id", 77).where("is_holdout").collect()} == set(
        pdf.sort_values(["h", "id"]).head(77).id)
    assert H.exact_holdout(df, "id", 10**6).where("is_holdout").count() == 6000
    assert H.exact_holdout(df, "id", 0).where("is_holdout").count() == 0


def test_capped_and_tiered(skewed):
    df, pdf = skewed
    sizes = pdf.g.value_counts()
    capped = Wn.capped_sample(df, "g", "id", 450, 440).groupBy("g").count()
    assert dict(rows(capped)) == {g: min(n, 450) for g, n in sizes.items() if min(n, 450) > 440}
    tiers = dict(rows(Wn.tiered_sample(df, "g", "id", 1000, 460).groupBy("g").count()))
    assert tiers == {g: (1000 if n > 1000 else n) for g, n in sizes.items() if n > 460}


def test_splits_cover_and_do_not_overlap(skewed):
    df, _ = skewed
    s = H.stratified_split(df, "g", "id", 0.2)
    assert s.count() == 6000
    per = s.groupBy("g").agg(F.count("*").alias("n"), F.sum((F.col("part") == "test").cast("int")).alias("t")).collect()
    assert all(r["t"] == int(r["n"] * 0.2) for r in per)
    folds = H.assign_stratified_folds(df, "g", "id", 4).groupBy("g", "fold").count().groupBy("g").agg(
        F.max("count") - F.min("count")).collect()
    assert all(r[1] <= 1 for r in folds)


def test_top_per_group(skewed):
    df, pdf = skewed
    got = {(r["g"], r["id"]) for r in top_per_group(df.where("g is not null"), ["g"], [F.desc("id")], 3).collect()}
    want = {(r.g, r.id) for r in pdf.dropna(subset=["g"]).sort_values("id", ascending=False).groupby("g").head(3).itertuples()}
    assert got == want


def test_group_median_fill(skewed):
    df, pdf = skewed
    got = {r["id"]: r["x"] for r in Wn.fill_group_median(df, "g", "x").collect()}
    med = pdf.groupby("g", dropna=False).x.transform("median")
    want = pdf.x.fillna(med)
    assert len(got) == 6000
    assert all(got[i] == pytest.approx(w) for i, w in zip(pdf.id, want, strict=True))


def test_auc_with_ties(spark):
    rng = np.random.default_rng(2)
    y, p = rng.integers(0, 2, 500), np.round(rng.random(500), 1)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    pos, neg = p[y == 1], p[y == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert auc(df, "y", "p").first()[0] == pytest.approx(want)


@pytest.mark.parametrize("digits,few", [(1, 2), (2, 5)])
def test_selection_refines_prefixes(spark, monkeypatch, digits, few):
    monkeypatch.setattr(H, "DIGITS", digits)
    monkeypatch.setattr(H, "FEW_KEYS", few)
    # a third of one group's rows share a key; another group is small, one is null
    data = [(i, "a") for i in range(400)] + [(7, "a")] * 200 + [(i, "b") for i in range(40)] + [(i, None) for i in range(90)]
    df = spark.createDataFrame(data, "k long, g string")
    per = {"a": 150, "b": 60, None: 33}
    n = F.when(F.col("_g.g") == "a", 150).when(F.col("_g.g") == "b", 60).otherwise(33)
    got = {}
    for r in H.flag_first_by_hash(df, "k", n, ["g"]).where("is_first").collect():
        got.setdefault(r["g"], []).append(r["k"])
    for g, wanted in per.items():
        order = sorted((hashlib.md5(str(k).encode()).hexdigest(), k) for k, x in data if x == g)
        last = order[min(wanted, len(order)) - 1]
        assert sorted(got[g]) == sorted(k for h, k in order if (h, k) <= last)
