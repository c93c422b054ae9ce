"""Aggregations and profiles."""

from __future__ import annotations

from pyspark.ml.stat import Correlation
from pyspark.sql import functions as F

from tabloom.catalog.base import CLAIMS, DIRTY_EVENTS, SCORED, Tables, as_int, as_long, claims, dirty_events, query, rd, scored
from tabloom.operators import profiling as P
from tabloom.operators.encoding import assemble
from tabloom.operators.ordered import exact_quantiles
from tabloom.plans import claims as jobs

# 0/1 prediction columns, one per (target, value)
_COLS = {
    "line_status_=_O": "l_linestatus = 'O'",
    "line_status_=_F": "l_linestatus = 'F'",
    "qty_band_=_low": "l_quantity < 17",
    "qty_band_=_mid": "l_quantity >= 17 and l_quantity < 34",
    "qty_band_=_high": "l_quantity >= 34",
    "disc_band_=_none": "l_discount < 0.01",
    "disc_band_=_some": "l_discount >= 0.01 and l_discount < 0.06",
    "disc_band_=_deep": "l_discount >= 0.06",
}
_VOTES = "(" + " union all ".join(
    f"""select l_returnflag as plan, '{c.split('_=_')[0]}' as target, '{c.split('_=_')[1]}' as value, {i} as ord,
    count(*) as claims, sum(cast(({cond}) as integer)) as votes from lineitem group by l_returnflag"""
    for i, (c, cond) in enumerate(_COLS.items())) + ")"
_WINNERS = f"""(select plan, target, value, greatest(round(votes * 100.0 / claims, 1), 33.0) as accuracy from (
  select *, row_number() over (partition by plan, target order by votes desc, ord) as rn from {_VOTES}) where rn = 1)"""


def predictions(t: Tables):
    return t.lineitem.select(
        F.col("l_returnflag").alias("client_plan_id"),
        *[F.expr(f"cast(({cond}) as int)").alias(c) for c, cond in _COLS.items()])


@query("e01_plan_summary", f"""
select client_plan_id, predicted_plan_id, count(*) as claim_count, round(avg(probability_score), 10) as probability,
  'C1' as client_code, '2024-01-31' as run_date
from {SCORED} where probability_score > 0.15 group by client_plan_id, predicted_plan_id""")
def e01(t: Tables):
    return jobs.plan_summary(scored(t), 0.15, client_code="C1", run_date="2024-01-31").withColumn(
        "probability", rd("probability", 10))


@query("e02_vote_winners", f"select plan, target, value, cast(accuracy as double) as accuracy from {_WINNERS}")
def e02(t: Tables):
    votes = jobs.votes_long(predictions(t), "client_plan_id", "event_id", list(_COLS))
    return jobs.vote_winners(votes, "client_plan_id").withColumnRenamed("client_plan_id", "plan")


@query("e02_vote_table", f"""
with w as (select * from {_WINNERS})
select plan, max(case when target = 'line_status' then value end) as line_status,
  max(case when target = 'qty_band' then value end) as qty_band, max(case when target = 'disc_band' then value end) as disc_band,
  'fixed' as network, '{{"discBand":' || max(case when target = 'disc_band' then cast(cast(accuracy as double) as varchar) end) ||
  ',"lineStatus":' || max(case when target = 'line_status' then cast(cast(accuracy as double) as varchar) end) ||
  ',"network":100.0,"qtyBand":' || max(case when target = 'qty_band' then cast(cast(accuracy as double) as varchar) end) || '}}'
  as field_accuracy_json from w group by plan""")
def e02t(t: Tables):
    votes = jobs.votes_long(predictions(t), "client_plan_id", "event_id", list(_COLS))
    wins = jobs.vote_winners(votes, "client_plan_id").withColumnRenamed("client_plan_id", "plan")
    return jobs.vote_table(wins, "plan", ["line_status", "qty_band", "disc_band"], {"network": "fixed"})


@query("e03_value_counts", f"""
select etype, count(*) as n, round(count(*) / (select count(*) from {DIRTY_EVENTS}), 8) as share
from {DIRTY_EVENTS} group by etype""")
def e03(t: Tables):
    return P.value_counts(dirty_events(t), "etype", normalize=True, dropna=False).withColumn("share", rd("share", 8))


@query("e03_value_counts_top", "select p_name, count(*) as n from part group by p_name order by n desc, p_name limit 10")
def e03t(t: Tables):
    return P.value_counts(t.part, "p_name", n=10)


def _describe_sql(src: str, cols: list[str]) -> str:
    return " union all ".join(f"""
select '{c}' as variable, count({c}) as n_values, round(avg({c}), 9) as mean, round(stddev_samp({c}), 6) as std,
 round(min({c}), 6) as min, round(quantile_cont({c}, 0.25), 6) as p25, round(quantile_cont({c}, 0.5), 6) as p50,
 round(quantile_cont({c}, 0.75), 6) as p75, round(max({c}), 6) as max, count(*) - count({c}) as missing from {src}""" for c in cols)


@query("e04_describe", _describe_sql(f"(select cast(user_id as double) as user_id, value, amount from {DIRTY_EVENTS})",
                                     ["user_id", "value", "amount"]))
def e04(t: Tables):
    d = P.describe(dirty_events(t), ["user_id", "value", "amount"])
    return d.withColumns({c: rd(c, 9 if c == "mean" else 6) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")})


@query("e05_crosstab", """
select coalesce(l_returnflag, 'All') as l_returnflag, coalesce(l_linestatus, 'All') as l_linestatus, count(*) as n
from lineitem group by cube(l_returnflag, l_linestatus)""")
def e05(t: Tables):
    return P.crosstab(t.lineitem, "l_returnflag", "l_linestatus", margins=True)


@query("e05_row_shares", f"""
select plan, priority, count(*) as n, round(count(*) / sum(count(*)) over (partition by plan), 8) as share
from {CLAIMS} group by plan, priority""")
def e05r(t: Tables):
    return P.row_shares(claims(t), "plan", "priority").withColumn("share", rd("share", 8))


@query("e06_group_rate", """
select source, lang, round(avg(toxic), 8) as rate from documents join labels using (doc_id) group by source, lang""")
def e06(t: Tables):
    return P.group_rate(t.documents.join(t.labels, "doc_id"), ["source", "lang"], "toxic").withColumn("rate", rd("rate", 8))


_MISS_COLS = ["event_id", "user_id", "value", "etype", "amount_text", "amount"]


@query("e07_missing_profile", " union all ".join(
    f"select '{c}' as variable, count(*) - count({c}) as missing, round((count(*) - count({c})) * 100.0 / count(*), 6) as percent "
    f"from {DIRTY_EVENTS}" for c in _MISS_COLS))
def e07(t: Tables):
    return P.missing_profile(dirty_events(t).select(*_MISS_COLS)).withColumn("percent", rd("percent"))


@query("e08_completeness", f"""
select user_id, count(*) as n_rows,
  round(1.0 - sum(cast(etype is null as integer) + cast(amount is null as integer)) / (count(*) * 2.0), 8) as completeness
from {DIRTY_EVENTS} group by user_id""")
def e08(t: Tables):
    return P.completeness(dirty_events(t), ["user_id"], ["etype", "amount"]).withColumn("completeness", rd("completeness", 8))


@query("e09_missing_by_category", f"""
select etype, count(amount) as present, count(*) as size, count(*) - count(amount) as missing from {DIRTY_EVENTS} group by etype""")
def e09(t: Tables):
    return P.missing_by_category(dirty_events(t), "etype", "amount")


def _stat_sql(src: str, cols: dict[str, str]) -> str:
    return " union all ".join(f"""
select '{c}' as variable, (select count(distinct {c}) from {src}) as n_distinct,
  round((select (count(*) - count({c})) * 100.0 / count(*) from {src}), 6) as pct_null,
  round((select max(n) from (select count(*) as n from {src} group by {c})) * 100.0 / (select count(*) from {src}), 6) as pct_top,
  '{d}' as dtype""" for c, d in cols.items())


_LP = "(select * from lineitem join part on l_partkey = p_partkey)"


def line_parts(t: Tables):
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))


@query("e10_column_statistics", _stat_sql(_LP, {"p_name": "string", "l_suppkey": "bigint", "l_returnflag": "string",
                                                "l_quantity": "double", "p_size": "int"}))
def e10(t: Tables):
    d = P.column_statistics(line_parts(t), ["p_name", "l_suppkey", "l_returnflag", "l_quantity", "p_size"])
    return d.withColumns({"pct_null": rd("pct_null"), "pct_top": rd("pct_top")})


@query("e11_cardinalities", " union all ".join(f"""
select '{c}' as variable, count(distinct {c}) + cast(count({c}) < count(*) as integer) as n_distinct,
  cast(count(distinct {c}) + cast(count({c}) < count(*) as integer) <= 1 as integer) as single_valued,
  cast(count(distinct {c}) + cast(count({c}) < count(*) as integer) = 2 as integer) as binary
from (select *, 1 as k_const, event_id % 2 as parity from {DIRTY_EVENTS})"""
                                            for c in ("etype", "user_id", "amount", "k_const", "parity")))
def e11(t: Tables):
    d = dirty_events(t).withColumns({"k_const": F.lit(1), "parity": F.col("event_id") % 2})
    out = P.cardinalities(d, ["etype", "user_id", "amount", "k_const", "parity"], count_null=True)
    return out.withColumns({"single_valued": as_int("single_valued"), "binary": as_int("binary")})


@query("e11_value_domains", """
select distinct 'p_type' as variable, p_type as value from part union all select distinct 'p_brand', p_brand from part""")
def e11d(t: Tables):
    return P.value_domains(t.part, ["p_type", "p_brand"])


def _moments(src: str, c: str) -> str:
    return f"""select '{c}' as variable, avg(pow({c} - m, 3)) / pow(avg(pow({c} - m, 2)), 1.5) as g1,
      avg(pow({c} - m, 4)) / pow(avg(pow({c} - m, 2)), 2) - 3 as g2, count({c}) as n
      from {src}, (select avg({c}) as m from {src})"""


_SHAPE = "(select o_totalprice, exp(o_totalprice / 100000.0) as grown, 1.0 * o_custkey as custkey from orders)"


@query("e12_shape_ranking", f"""
select variable, round(g1, 6) as skewness, round(g2, 6) as kurtosis,
  round(sqrt(n * (n - 1.0)) / (n - 2) * g1, 6) as skew_corrected from (
  {' union all '.join(_moments(_SHAPE, c) for c in ('o_totalprice', 'grown', 'custkey'))})""")
def e12(t: Tables):
    d = t.orders.select("o_totalprice", F.exp(F.col("o_totalprice") / 100000.0).alias("grown"),
                        F.col("o_custkey").cast("double").alias("custkey"))
    cols = ["o_totalprice", "grown", "custkey"]
    plain = P.shape_ranking(d, cols)
    fixed = P.shape_ranking(d, cols, bias_corrected=True).select("variable", rd("skewness").alias("skew_corrected"))
    return plain.join(fixed, "variable").withColumns({"skewness": rd("skewness"), "kurtosis": rd("kurtosis")})


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "p_size", "p_retailprice"]


@query("e13_correlation_pairs", " union all ".join(
    f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as r from {_LP}"
    for i, a in enumerate(_CORR) for b in _CORR[i + 1:]))
def e13(t: Tables):
    d = line_parts(t).withColumn("k_const", F.lit(1.0))
    return P.correlation_pairs(d, [*_CORR, "k_const"]).withColumn("r", rd("r"))


@query("e13_wide_correlations", """
with l as (select vec_id, i, case when (vec_id + i) % 7 <> 0 then embedding[i]::double end as x from embeddings, range(1, 65) as d(i))
select 'c' || a.i as a, 'c' || b.i as b, round(corr(a.x, b.x), 6) as r
from l a join l b on a.vec_id = b.vec_id and a.i < b.i group by a.i, b.i""")
def e13w(t: Tables):
    known = [F.when((F.col("vec_id") + i) % 7 != 0, F.col("embedding")[i - 1].cast("double")).alias(f"c{i}") for i in range(1, 65)]
    return P.correlation_pairs(t.embeddings.select(*known)).withColumn("r", rd("r"))


@query("e13_correlation_matrix", " union all ".join(
    f"select '{a}' as variable, " + ", ".join(
        f"round(corr({a}, {b}), 6) as {b}" if a != b else f"1.0::double as {b}" for b in _CORR) + f" from {_LP}" for a in _CORR))
def e13m(t: Tables):
    m = Correlation.corr(assemble(line_parts(t), _CORR), "features").first()[0].toArray()
    return t.spark.createDataFrame([(a, *[round(float(x), 6) for x in r]) for a, r in zip(_CORR, m, strict=True)],
                                   ["variable", *_CORR])


@query("e14_exact_quantiles", """
select l_returnflag, 'l_extendedprice' as variable, count(*) as n, round(quantile_cont(l_extendedprice, 0.25), 6) as q0,
 round(median(l_extendedprice), 6) as q1, round(quantile_cont(l_extendedprice, 0.75), 6) as q2,
 round(quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25), 6) as iqr from lineitem group by l_returnflag""")
def e14(t: Tables):
    q = exact_quantiles(t.lineitem, ["l_extendedprice"], [0.25, 0.5, 0.75], ["l_returnflag"])
    return q.withColumn("iqr", rd(F.col("q2") - F.col("q0"))).withColumns({c: rd(c) for c in ("q0", "q1", "q2")})


def _mode_sql(src: str, by: str, c: str) -> str:
    return (f"select {by}, {c} from (select {by}, {c}, row_number() over (partition by {by} order by count(*) desc, {c}) as rn "
            f"from {src} where {c} is not null group by {by}, {c}) where rn = 1")


@query("e15_mode", f"""
select a.p_brand, a.p_type, b.p_size from ({_mode_sql('part', 'p_brand', 'p_type')}) a
join ({_mode_sql('part', 'p_brand', 'p_size')}) b on a.p_brand = b.p_brand""")
def e15(t: Tables):
    return P.mode_per_group(t.part, ["p_type", "p_size"], ["p_brand"])


@query("e16_latest_non_null", f"""
select user_id, max_by(etype, event_id) filter (where etype is not null) as etype,
  max_by(amount, event_id) filter (where amount is not null) as amount from {DIRTY_EVENTS} group by user_id""")
def e16(t: Tables):
    return P.latest_non_null(dirty_events(t), ["user_id"], "event_id", ["etype", "amount"])


@query("e17_group_sizes", """
with s as (select o_custkey, count(*) as n from orders group by o_custkey)
select case when n = 1 then '1' when n <= 5 then '2-5' else '6+' end as members, count(*) as n_groups, min(n) as min_n,
  round(avg(n), 9) as mean_n, max(n) as max_n from s group by 1""")
def e17(t: Tables):
    return P.group_size_distribution(t.orders, ["o_custkey"]).withColumn("mean_n", rd("mean_n", 9))


@query("e18_within_group", """
select o_custkey, count(o_totalprice) as n, round(avg(o_totalprice), 8) as mean, round(stddev_samp(o_totalprice), 6) as std
from orders group by o_custkey""")
def e18(t: Tables):
    return P.within_group_spread(t.orders, ["o_custkey"], "o_totalprice").withColumns(
        {"mean": rd("mean", 8), "std": rd("std")})


@query("e18_mean_within_spread", """
select count(*) as n_groups, round(avg(m), 5) as mean_of_means, round(avg(s), 5) as mean_of_std from (
 select avg(o_totalprice) as m, stddev_samp(o_totalprice) as s from orders group by o_custkey)""")
def e18m(t: Tables):
    return P.mean_within_spread(t.orders, ["o_custkey"], "o_totalprice").withColumns(
        {"mean_of_means": rd("mean_of_means", 5), "mean_of_std": rd("mean_of_std", 5)})


@query("e19_entity_fingerprint", f"""
with c as (select * from {CLAIMS}),
m as ({_mode_sql('c', 'plan', 'priority')}),
r as (select plan, nation, count(*) as n from c where claim_status = 'F' group by plan, nation),
s as (select plan, string_agg(cast(nation as varchar) || ' ' || cast(cast(round(n * 100.0 / tot, 1) as double) as varchar) || '%', '; ' order by nation) as codes
  from (select *, sum(n) over (partition by plan) as tot from r) group by plan)
select t.plan, round(t.mx, 2) as max_amount, m.priority as mode_priority,
  'max amount is ' || cast(round(t.mx, 2) as varchar) || ', usual priority is ' || m.priority || ', nation shares is ' || s.codes as fingerprint
from (select plan, max(amount) as mx from c group by plan) t join m on m.plan = t.plan join s on s.plan = t.plan""")
def e19(t: Tables):
    f = P.entity_fingerprint(claims(t), "plan", ["amount"], ["priority"], "nation",
                             F.col("claim_status") == "F")
    return f.withColumn("max_amount", rd("max_amount", 2))


@query("e20_class_distribution", """
select toxic, count(*) as n, round(count(*) / (select count(*) from labels), 8) as share from labels group by toxic""")
def e20(t: Tables):
    return P.value_counts(t.labels, "toxic", normalize=True).withColumn("share", rd("share", 8))


@query("e21_coverage", " union all ".join(f"""
select '{c}' as variable, count(*) as n_entities, min(n) as min_rows, round(avg(n), 9) as mean_rows, max(n) as max_rows
from (select {c}, count(*) as n from {CLAIMS} group by {c})""" for c in ("plan", "nation", "member")))
def e21(t: Tables):
    return P.coverage(claims(t), ["plan", "nation", "member"]).withColumn("mean_rows", rd("mean_rows", 9))


@query("e22_load_gate", f"""
select count(*) as n_rows, cast(sum(cast(etype is null as integer)) as bigint) as null_ids,
  cast(sum(cast(etype is null as integer)) <= 10 as integer) as passed from {DIRTY_EVENTS}""")
def e22(t: Tables):
    return P.load_gate(dirty_events(t), "etype").withColumn("passed", as_int("passed"))


@query("e23_nan_gate", f"""
select 'etype' as variable, count(*) - count(etype) as n_bad from {DIRTY_EVENTS}
union all select 'amount', count(*) - count(amount) + count(case when event_id % 6 = 0 and event_id % 9 <> 0 then 1 end) from {DIRTY_EVENTS}
union all select 'event_id', 0 from region where r_regionkey = 0""")
def e23(t: Tables):
    k = F.col("event_id")
    d = dirty_events(t).select("event_id", "etype", F.when((k % 6 == 0) & (k % 9 != 0), F.lit(float("nan"))).otherwise(
        F.col("amount")).alias("amount"))
    return P.nan_gate(d)


@query("e24_key_audit", """
with k as (select '0' || cast(o_custkey as varchar) as k from orders), g as (select k, count(*) as n from k group by k)
select cast(sum(n) as bigint) as n_rows, count(k) as n_distinct, cast(0 as bigint) as n_null, min(length(k)) as min_length,
  max(length(k)) as max_length, min(k) as min_key, max(k) as max_key, count(case when n > 1 then 1 end) as n_repeated from g""")
def e24(t: Tables):
    k = t.orders.select(F.concat(F.lit("0"), F.col("o_custkey").cast("string")).alias("k"))
    return P.key_audit(k, "k").withColumns({"min_length": as_long("min_length"), "max_length": as_long("max_length"),
                                            "n_repeated": as_long("n_repeated"), "n_null": as_long("n_null")})


@query("e25_off_domain", "select p_type, count(*) as n from part where p_type not in ('ECONOMY', 'SMALL', 'LARGE') group by p_type")
def e25(t: Tables):
    return P.off_domain(t.part, "p_type", ["ECONOMY", "SMALL", "LARGE"])
