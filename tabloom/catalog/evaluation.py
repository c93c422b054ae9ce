"""Metrics and diagnostics on labelled documents and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog.base import CLAIMS, Tables, claims, query, rd
from tabloom.functions import numeric as X
from tabloom.operators import evaluation as V
from tabloom.operators import mixed as R
from tabloom.operators.models import balanced_weights, oversample, vote

# a score with ties, correlated with the label
_S = """(select doc_id, toxic as label, least(1.0, greatest(0.0, ((doc_id * 7919) % 100) / 125.0 + toxic * 0.2)) as p,
  cast(((doc_id * 7919) % 100) / 125.0 + toxic * 0.2 >= 0.5 as integer) as pred from labels)"""


def judged(t: Tables):
    p = ((F.col("doc_id") * 7919) % 100) / 125.0 + F.col("toxic") * 0.2
    return t.labels.select("doc_id", F.col("toxic").alias("label"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), p)).alias("p"),
                           (p >= 0.5).cast("int").alias("pred"))


_CELLS = f"""select count(case when label = 1 and pred = 1 then 1 end) as tp, count(case when label = 0 and pred = 1 then 1 end) as fp,
 count(case when label = 0 and pred = 0 then 1 end) as tn, count(case when label = 1 and pred = 0 then 1 end) as fn from {_S}"""


@query("m01_binary_metrics", f"""
select tp, fp, tn, fn, round(tp / (tp + fp), 8) as precision, round(tp / (tp + fn), 8) as recall, round(2 * tp / (2 * tp + fp + fn), 8) as f1,
 round((tp + tn) / (tp + fp + tn + fn), 8) as accuracy from ({_CELLS})""")
def m01(t: Tables):
    m = V.binary_metrics(judged(t), "label", "pred")
    return m.withColumns({c: rd(c, 8) for c in ("precision", "recall", "f1", "accuracy")})


@query("m02_confusion", f"select label, pred as prediction, count(*) as n from {_S} group by label, pred")
def m02(t: Tables):
    return V.confusion(judged(t), "label", "pred")


@query("m02_class_report", f"""
with c as (select 0 as cls union all select 1), j as (select cls, (select count(*) from {_S} where label = cls) as support,
  (select count(*) from {_S} where pred = cls) as predicted, (select count(*) from {_S} where pred = cls and label = cls) as hit from c)
select cls, support, round(hit / predicted, 8) as precision, round(hit / support, 8) as recall, round(2 * hit / (predicted + support), 8) as f1 from j""")
def m02r(t: Tables):
    return V.class_report(judged(t), "label", "pred").withColumns({c: rd(c, 8) for c in ("precision", "recall", "f1")})


@query("m03_auc", f"""
select round((sum(case when label = 1 then r end) - n1 * (n1 + 1) / 2.0) / (n1 * (n - n1)), 8) as auc from (
 select label, (rank() over (order by round(p, 9)) + count(*) over (partition by round(p, 9)) / 2.0 - 0.5) as r, count(*) over () as n,
  sum(label) over () as n1 from {_S}) group by n, n1""")
def m03(t: Tables):
    return V.auc(judged(t).withColumn("p", rd("p", 9)), "label", "p").select(rd("auc", 8).alias("auc"))


@query("m03_curves", f"""
with g as (select round(p, 9) as threshold, sum(label) as pos, sum(1 - label) as neg from {_S} group by 1)
select threshold, round(sum(neg) over w / sum(neg) over (), 8) as fpr, round(sum(pos) over w / sum(pos) over (), 8) as tpr,
 round(sum(pos) over w / (sum(pos) over w + sum(neg) over w), 8) as precision from g window w as (order by threshold desc)""")
def m03c(t: Tables):
    c = V.roc_pr_curve(judged(t).withColumn("p", rd("p", 9)), "label", "p")
    return c.withColumns({x: rd(x, 8) for x in ("fpr", "tpr", "precision")})


_FIT = "(select o_totalprice as y, 250000.0 + (o_orderkey % 100) * 100.0 as f from orders)"


@query("m04_regression_metrics", f"""
select count(*) as n, round(avg(abs(y - f)), 4) as mae, round(avg(pow(y - f, 2)) / 1e6, 4) as mse, round(sqrt(avg(pow(y - f, 2))), 4) as rmse,
 round(1 - avg(pow(y - f, 2)) / var_pop(y), 8) as r2, round(sqrt(avg(pow(ln(1 + y) - ln(1 + f), 2))), 8) as rmse_log from {_FIT}""")
def m04(t: Tables):
    d = t.orders.select(F.col("o_totalprice").alias("y"), (F.lit(250000.0) + (F.col("o_orderkey") % 100) * 100.0).alias("f"))
    m = V.regression_metrics(d, "y", "f", log_target=True)
    return m.select("n", rd("mae", 4).alias("mae"), rd(F.col("mse") / 1e6, 4).alias("mse"), rd("rmse", 4).alias("rmse"),
                    rd("r2", 8).alias("r2"), rd("rmse_log", 8).alias("rmse_log"))


@query("m05_fold_summary", f"""
with f as (select doc_id % 5 as fold, avg(cast(label = pred as integer)) as accuracy, avg(p) as mean_p from {_S} group by 1)
select 'accuracy' as metric, round(avg(accuracy), 8) as mean, round(stddev_pop(accuracy), 8) as std from f
union all select 'mean_p', round(avg(mean_p), 8), round(stddev_pop(mean_p), 8) from f""")
def m05(t: Tables):
    folds = judged(t).groupBy((F.col("doc_id") % 5).alias("fold")).agg(
        F.avg((F.col("label") == F.col("pred")).cast("int")).alias("accuracy"), F.avg("p").alias("mean_p"))
    return V.fold_summary(folds, ["accuracy", "mean_p"]).withColumns({"mean": rd("mean", 8), "std": rd("std", 8)})


@query("m08_outcome_lists", f"""
select doc_id, round(p, 8) as p, case when label = 1 and pred = 1 then 'caught' when label = 1 then 'missed' when pred = 1 then 'false alarm'
 else 'passed' end as outcome from {_S} order by p desc, doc_id""")
def m08(t: Tables):
    return V.outcome_lists(judged(t), "label", "pred").orderBy(F.desc("p"), "doc_id").select("doc_id", rd("p", 8).alias("p"), "outcome")


@query("m09_vif")
def m09(t: Tables):
    d = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return V.vif(d, ["l_quantity", "l_discount", "p_size", "p_retailprice"]).withColumn("vif", rd("vif", 4))


@query("m10_effect_sizes", """
with r as (select p_brand, 1 - sum(pow(p_retailprice - m, 2)) / sum(pow(p_retailprice - g, 2)) as r2 from (
  select p_brand, p_retailprice, avg(p_retailprice) over (partition by p_brand, p_type) as m, avg(p_retailprice) over (partition by p_brand) as g from part)
  group by p_brand)
select p_brand, round(r2 / nullif(1 - r2, 0), 6) as f2, case when r2 / nullif(1 - r2, 0) < 0.02 then 'negligible'
  when r2 / nullif(1 - r2, 0) < 0.15 then 'small' when r2 / nullif(1 - r2, 0) < 0.35 then 'medium' else 'large' end as label from r""")
def m10(t: Tables):
    cells = t.part.groupBy("p_brand", "p_type").agg(F.count("*").alias("n"), F.avg("p_retailprice").alias("m"), F.var_pop("p_retailprice").alias("v"))
    per = cells.groupBy("p_brand").agg(F.sum(F.col("n") * F.col("v")).alias("ssw"), F.sum(F.col("n") * F.col("m")).alias("s"), F.sum("n").alias("n"),
                                       F.sum(F.col("n") * F.col("m") * F.col("m")).alias("s2"))
    ssb = F.col("s2") - F.col("s") * F.col("s") / F.col("n")
    f2 = X.effect_size(ssb / (ssb + F.col("ssw")), F.lit(0.0))
    return per.select("p_brand", rd(f2).alias("f2"), X.effect_label(f2).alias("label"))


@query("m10_pseudo_r2", """
with r as (select l_returnflag, l_linestatus, count(*) as n, regr_syy(l_extendedprice, l_quantity) as syy, regr_r2(l_extendedprice, l_quantity) as r2
  from lineitem group by all),
l as (select *, -n / 2.0 * (ln(2 * pi() * syy / n) + 1) as ll_null, -n / 2.0 * (ln(2 * pi() * syy * (1 - r2) / n) + 1) as ll_model from r)
select l_returnflag, l_linestatus, n, round(ll_null, 3) as ll_null, round(ll_model, 3) as ll_model, round(1 - ll_model / ll_null, 9) as likelihood_r2,
  round(r2, 9) as variance_r2 from l""")
def m10p(t: Tables):
    """Of a line through quantity and price, per status: both pseudo R2."""
    d = t.lineitem.select("l_returnflag", "l_linestatus", F.col("l_quantity").cast("double").alias("x"), F.col("l_extendedprice").cast("double").alias("y"))
    r = d.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.regr_syy("y", "x").alias("syy"), F.regr_r2("y", "x").alias("r2"))
    r = r.withColumns({"ll_null": X.gaussian_log_likelihood(F.col("syy"), F.col("n")),
                       "ll_model": X.gaussian_log_likelihood(F.col("syy") * (1 - F.col("r2")), F.col("n"))})
    return r.select("l_returnflag", "l_linestatus", "n", rd("ll_null", 3).alias("ll_null"), rd("ll_model", 3).alias("ll_model"),
                    rd(X.likelihood_r2(F.col("ll_model"), F.col("ll_null")), 9).alias("likelihood_r2"),
                    rd(X.variance_r2(F.col("r2") * F.col("syy"), F.col("syy")), 9).alias("variance_r2"))


_RES = """(select o_orderkey, o_totalprice - m as resid, m as fitted from (
  select *, avg(o_totalprice) over (partition by o_custkey) as m from orders))"""


@query("m11_residual_diagnostics", f"""
select round(stddev_samp(resid), 4) as resid_std, round(min(resid), 4) as resid_min, round(max(resid), 4) as resid_max,
 round(corr(abs(resid), fitted), 6) as abs_resid_fitted_corr from {_RES}""")
def m11(t: Tables):
    mean = t.orders.groupBy("o_custkey").agg(F.avg("o_totalprice").alias("fitted"))
    d = t.orders.join(mean, "o_custkey").withColumn("resid", F.col("o_totalprice") - F.col("fitted"))
    r = V.residual_diagnostics(d, "resid", "fitted")
    return r.select(*[rd(c, 6 if c.endswith("corr") else 4).alias(c) for c in r.columns])


@query("m12_normality", """
with m as (select avg(o_totalprice) as m from orders), s as (select count(*) as n, avg(pow(o_totalprice - m, 3)) / pow(avg(pow(o_totalprice - m, 2)), 1.5) as g1,
 avg(pow(o_totalprice - m, 4)) / pow(avg(pow(o_totalprice - m, 2)), 2) - 3 as g2 from orders, m)
select n, round(g1, 6) as skewness, round(g2, 6) as kurtosis, round(n / 6.0 * (g1 * g1 + g2 * g2 / 4), 3) as jb,
 round(exp(-n / 12.0 * (g1 * g1 + g2 * g2 / 4)), 6) as p_value from s""")
def m12(t: Tables):
    j = V.jarque_bera(t.orders, "o_totalprice")
    return j.select("n", rd("skewness").alias("skewness"), rd("kurtosis").alias("kurtosis"), rd("jb", 3).alias("jb"), rd("p_value").alias("p_value"))


@query("m13_error_rate", "select count(*) as n, count(case when toxic = 1 then 1 end) as errors, round(avg(toxic), 8) as error_rate from labels")
def m13(t: Tables):
    return V.error_rate(t.labels, "toxic").withColumn("error_rate", rd("error_rate", 8))


_T20 = ", ".join(str(x) for x in V.f2_thresholds())


@query("l17_best_threshold_f2", f"""
with t as (select unnest([{_T20}])::double as threshold), c as (select threshold, count(case when label = 1 and p >= threshold then 1 end) as tp,
 count(case when label = 0 and p >= threshold then 1 end) as fp, count(case when label = 1 and p < threshold then 1 end) as fn from t, {_S} group by threshold)
select round(threshold, 8) as threshold, round(5 * tp / (5 * tp + 4 * fn + fp), 8) as score from c order by 5 * tp / (5 * tp + 4 * fn + fp) desc, threshold limit 1""")
def l17(t: Tables):
    b = V.best_threshold(judged(t), "label", "p", V.f2_thresholds())
    return b.select(rd("threshold", 8).alias("threshold"), rd("score", 8).alias("score"))


@query("l17_best_threshold_f1", f"""
with t as (select unnest([0.3, 0.4, 0.5]) as threshold), c as (select threshold::double as threshold, count(case when label = 1 and p >= threshold then 1 end) as tp,
 count(case when label = 0 and p >= threshold then 1 end) as fp, count(case when label = 1 and p < threshold then 1 end) as fn,
 count(case when label = 0 and p < threshold then 1 end) as tn from t, {_S} group by threshold),
s as (select threshold, (2 * tp / (2 * tp + fp + fn) * (tp + fn) + 2 * tn / (2 * tn + fp + fn) * (tn + fp)) / (tp + fp + fn + tn) as score from c)
select threshold, round(score, 8) as score from s order by score desc, threshold limit 1""")
def l17f(t: Tables):
    b = V.best_threshold(judged(t), "label", "p", [0.3, 0.4, 0.5], "f1")
    return b.select("threshold", rd("score", 8).alias("score"))


@query("l16_class_weights", """
select doc_id, round((select count(*) from labels) / (2.0 * count(*) over (partition by toxic)), 8) as weight from labels""")
def l16(t: Tables):
    return balanced_weights(t.labels, "toxic").select("doc_id", rd("weight", 8).alias("weight"))


@query("l16_oversample", """
with n as (select count(case when toxic = 1 then 1 end) as s, floor(count(case when toxic = 0 then 1 end) * 0.4) as g from labels),
r as (select doc_id, row_number() over (order by md5(cast(doc_id as varchar)), doc_id) - 1 as pos from labels where toxic = 1)
select doc_id, toxic, cast(1 + case when toxic = 1 then floor(greatest(g, s) / s) - 1 + cast(pos < greatest(g, s) % s as integer) else 0 end as bigint) as copies
from labels left join r using (doc_id), n""")
def l16o(t: Tables):
    more = oversample(t.labels.select("doc_id", "toxic"), "toxic", "doc_id", 1, 0.4)
    return more.groupBy("doc_id", "toxic").agg(F.count("*").alias("copies"))


@query("l09_votes", f"""
select doc_id, cast((pred + cast(p > 0.4 as integer) + cast(doc_id % 3 = 0 as integer)) / 3 > 0.5 as integer) as hard,
  round((p + pred + 0.5) / 3, 8) as soft from {_S}""")
def l09v(t: Tables):
    d = judged(t).withColumns({"b": (F.col("p") > 0.4).cast("int"), "c": (F.col("doc_id") % 3 == 0).cast("int"), "h": F.lit(0.5)})
    return d.select("doc_id", vote(d, ["pred", "b", "c"]).alias("hard"), rd(vote(d, ["p", "pred", "h"], hard=False), 8).alias("soft"))


@query("l19_anova_icc", f"""
with c as (select * from {CLAIMS}), g as (select nation, count(*) as n, avg(amount) as m, var_pop(amount) as v from c group by nation),
a as (select count(*) as k, sum(n) as n, sum(n * n) as n2, sum(n * pow(m - (select avg(amount) from c), 2)) as ssb, sum(n * v) as ssw from g),
q as (select k, ssb / (k - 1) as msb, ssw / (n - k) as msw, (n - n2 / n) / (k - 1) as n0 from a)
select k as n_groups, round(msb / 1e6, 2) as msb, round(msw / 1e6, 2) as msw, round(n0, 6) as n0,
 round((msb - msw) / n0 / ((msb - msw) / n0 + msw), 7) as icc from q""")
def l19(t: Tables):
    r = R.anova_icc(claims(t), "amount", "nation")
    return r.select("n_groups", rd(F.col("msb") / 1e6, 2).alias("msb"), rd(F.col("msw") / 1e6, 2).alias("msw"), rd("n0").alias("n0"),
                    rd("icc", 7).alias("icc"))
