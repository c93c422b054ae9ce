"""Samples, ranks, sorts, set operations and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog.base import CLAIMS, DIRTY_EVENTS, SCORED, Tables, as_int, claims, dirty_events, query, rd, scored
from tabloom.functions.numeric import bin_label
from tabloom.operators import sets as H
from tabloom.operators import windows as Wn
from tabloom.operators.joins import upsert_keep_last

_MD5 = "md5(cast({} as varchar))"
_BUCKET = "(cast('0x' || substr(md5(cast({} as varchar)), 1, 8) as bigint) % {})"


@query("f01_capped_sample", f"""
with c as (select * from {CLAIMS}), s as (select nation, least(count(*), 600) as n from c group by nation having least(count(*), 600) > 590)
select claim_id, nation from (select claim_id, nation, row_number() over (partition by nation order by {_MD5.format('claim_id')}, claim_id) as rn
  from c where nation in (select nation from s)) where rn <= 600""")
def f01(t: Tables):
    return Wn.capped_sample(claims(t), "nation", "claim_id", 600, 590).select("claim_id", "nation")


@query("f02_tiered_sample", f"""
with c as (select *, count(*) over (partition by nation) as n, row_number() over (partition by nation
  order by {_MD5.format('claim_id')}, claim_id) as rn from {CLAIMS})
select claim_id, nation from c where (n > 620 and rn <= 620) or (n <= 620 and n > 580)""")
def f02(t: Tables):
    return Wn.tiered_sample(claims(t), "nation", "claim_id", 620, 580).select("claim_id", "nation")


@query("f03_keep_last_upsert", f"""
with old as (select claim_id, client_plan_id, probability_score as p from {SCORED}),
new as (select claim_id, 'fresh' as client_plan_id, probability_score + 1 as p from {SCORED} where cast(claim_id as bigint) % 3 = 0),
s as (select *, 0 as v from old union all select *, 1 from new)
select claim_id, client_plan_id, round(p, 6) as p from (select *, row_number() over (partition by claim_id order by v desc) as rn from s)
where rn = 1""")
def f03(t: Tables):
    old = scored(t).select("claim_id", "client_plan_id", F.col("probability_score").alias("p"))
    new = old.where(F.col("claim_id").cast("long") % 3 == 0).select(
        "claim_id", F.lit("fresh").alias("client_plan_id"), (F.col("p") + 1).alias("p"))
    return upsert_keep_last(old, new, ["claim_id"]).withColumn("p", rd("p"))


@query("f04_group_median_fill", f"""
select event_id, round(coalesce(amount, median(amount) over (partition by event_type)), 6) as amount
from (select d.*, e.event_type from {DIRTY_EVENTS} d join events e using (event_id))""")
def f04(t: Tables):
    d = dirty_events(t).join(t.events.select("event_id", "event_type"), "event_id")
    return Wn.fill_group_median(d, "event_type", "amount").select("event_id", rd("amount").alias("amount"))


_VALS = "(select p_name as v from part union all select s_name from supplier)"


@query("f05_frequency_encode", f"""
with c as (select v, count(*) as n from {_VALS} group by v),
m as (select v, row_number() over (order by n desc, v) - 1 as code from c where n > 1),
k as (select v, code from m union all select v, (select count(*) from m) from c where n = 1)
select p_partkey, code from part join k on p_name = v""")
def f05(t: Tables):
    train = t.part.select("p_partkey", F.col("p_name").alias("v"))
    test = t.supplier.select(F.col("s_name").alias("v"))
    return Wn.frequency_encode(train, test, "v", "code")[0].select("p_partkey", "code")


@query("f06_standardize", """
select o_orderkey, round((o_totalprice - avg(o_totalprice) over ()) / stddev_samp(o_totalprice) over (), 6) as z from orders""")
def f06(t: Tables):
    return Wn.standardize(t.orders, ["o_totalprice"]).select("o_orderkey", rd("o_totalprice_std").alias("z"))


@query("f07_lag_differences", """
select event_id, user_id, round(value - lag(value) over (partition by user_id order by ts, event_id), 6) as delta from events""")
def f07(t: Tables):
    return Wn.lag_differences(t.events, ["user_id"], ["ts", "event_id"], "value").select(
        "event_id", "user_id", rd("delta").alias("delta"))


@query("f07_array_differences", """
select user_id, [round(v[i + 1] - v[i], 6) for i in range(1, 7)] as diffs from (
 select user_id, list_value(
  sum(case when b = 0 then value else 0 end), sum(case when b = 1 then value else 0 end), sum(case when b = 2 then value else 0 end),
  sum(case when b = 3 then value else 0 end), sum(case when b = 4 then value else 0 end), sum(case when b = 5 then value else 0 end),
  sum(case when b = 6 then value else 0 end)) as v from (select user_id, value, event_id % 7 as b from events) group by user_id)""")
def f07a(t: Tables):
    lag = F.col("event_id") % 7
    per = t.events.groupBy("user_id").agg(
        F.array(*[F.sum(F.when(lag == i, F.col("value")).otherwise(0.0)) for i in range(7)]).alias("v"))
    return per.select("user_id", F.transform(Wn.array_differences(F.col("v")), lambda x: F.round(x, 6)).alias("diffs"))


@query("f08_group_count_binned", """
with g as (select o_custkey, count(*) as n from orders group by o_custkey)
select o_orderkey, g.n as member_orders, case when n > 0 and n <= 5 then 'Small' when n > 5 and n <= 15 then 'Medium'
  when n > 15 and n <= 50 then 'Large' when n > 50 and n <= 100 then 'Very_Large' end as volume
from orders join g using (o_custkey)""")
def f08(t: Tables):
    d = Wn.group_count(t.orders, ["o_custkey"], "member_orders")
    return d.select("o_orderkey", "member_orders", bin_label(
        F.col("member_orders"), [0, 5, 15, 50, 100], ["Small", "Medium", "Large", "Very_Large"], right=True).alias("volume"))


@query("g01_top_categories", """
with top as (select p_name, count(*) as n from part group by p_name order by n desc, p_name limit 10)
select p_name, p_type, count(*) as n from part where p_name in (select p_name from top) group by p_name, p_type""")
def g01(t: Tables):
    return Wn.top_categories_with_hue(t.part, "p_name", "p_type", 10)


_RESID = "(select o_orderkey, o_custkey, o_totalprice - (select avg(o_totalprice) from orders) as r from orders)"


@query("g02_largest_residuals", f"""
select o_orderkey, round(r, 4) as r from {_RESID} order by abs(r) desc, o_orderkey limit 20""")
def g02(t: Tables):
    r = F.col("o_totalprice") - t.orders.agg(F.avg("o_totalprice")).scalar()
    top = Wn.largest_abs(t.orders.withColumn("r", r), "r", "o_orderkey", 20)
    return top.select("o_orderkey", rd("r", 4).alias("r"))


@query("g02_residual_groups", f"""
select o_orderpriority, count(*) as n from (select o_orderpriority from {_RESID} q join orders using (o_orderkey)
  order by abs(r) desc, o_orderkey limit 200) group by o_orderpriority""")
def g02g(t: Tables):
    r = F.col("o_totalprice") - t.orders.agg(F.avg("o_totalprice")).scalar()
    return Wn.largest_abs_groups(t.orders.withColumn("r", r), "r", "o_orderkey", "o_orderpriority", 200)


@query("g03_risk_list", f"select claim_id, round(probability_score, 6) as p from {SCORED} order by probability_score desc, claim_id limit 10")
def g03(t: Tables):
    return Wn.risk_list(scored(t), "probability_score", "claim_id").select("claim_id", rd("probability_score").alias("p"))


@query("g04_stable_order", "select url, page_id from pages order by url")
def g04(t: Tables):
    return Wn.stable_order(t.pages.select("url", "page_id"), "url")


@query("g05_mean_importance", """
select feature, round(avg(importance), 9) as importance from (
 select p_brand || ':' || p_type as feature, p_retailprice / 1000.0 as importance from part) group by feature
order by round(avg(importance), 9) desc, feature limit 1000""")
def g05(t: Tables):
    rows = t.part.select(F.concat_ws(":", "p_brand", "p_type").alias("feature"), (F.col("p_retailprice") / 1000.0).alias("importance"))
    return Wn.mean_importance(rows).withColumn("importance", rd("importance", 9))


@query("h01_union_tagged", """
select 'customer' as origin, c_custkey as k, c_name as name, c_mktsegment as segment, c_acctbal as balance from customer
union all select 'supplier', s_suppkey, s_name, null, s_acctbal from supplier""")
def h01(t: Tables):
    a = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
                          F.col("c_acctbal").alias("balance"))
    b = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    return H.union_tagged({"customer": a, "supplier": b})


@query("h02_distinct_rows", "select distinct l_suppkey, l_returnflag from lineitem")
def h02(t: Tables):
    return H.distinct_rows(t.lineitem.select("l_suppkey", "l_returnflag"))


@query("h02_keep_first", """
select o_custkey, o_orderkey, o_totalprice from (
 select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as rn from orders) where rn = 1""")
def h02k(t: Tables):
    d = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return H.keep_first(d, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).drop("o_orderdate")


@query("h03_key_sets", """
select 'both' as side, count(*) as n from (select c_custkey from customer intersect select o_custkey from orders)
union all select 'customer only', count(*) from (select c_custkey from customer except select o_custkey from orders)""")
def h03(t: Tables):
    a, b = t.customer.select(F.col("c_custkey").alias("k")), t.orders.select(F.col("o_custkey").alias("k"))
    both = H.key_intersection(a, b).agg(F.count("*").alias("n")).withColumn("side", F.lit("both"))
    only = H.key_difference(a, b).agg(F.count("*").alias("n")).withColumn("side", F.lit("customer only"))
    return both.unionByName(only)


@query("h04_exact_holdout", f"""
select o_orderkey, cast(row_number() over (order by {_MD5.format('o_orderkey')}, o_orderkey) <= 5000 as integer) as is_holdout from orders""")
def h04(t: Tables):
    return H.exact_holdout(t.orders.select("o_orderkey"), "o_orderkey", 5000).withColumn("is_holdout", as_int("is_holdout"))


@query("h05_hash_split", f"""
select o_orderkey, case when {_BUCKET.format('o_orderkey', 10000)} < 8000 then 'train' else 'test' end as part from orders""")
def h05(t: Tables):
    return H.hash_split(t.orders.select("o_orderkey"), "o_orderkey", 0.8)


@query("h06_stratified_split", f"""
select doc_id, toxic, case when row_number() over (partition by toxic order by {_MD5.format('doc_id')}, doc_id) - 1
  < floor(count(*) over (partition by toxic) * 0.25) then 'test' else 'train' end as part from labels""")
def h06(t: Tables):
    return H.stratified_split(t.labels.select("doc_id", "toxic"), "toxic", "doc_id", 0.25)


@query("h07_group_split", f"""
select o_orderkey, case when {_BUCKET.format('o_custkey', 10000)} < 8000 then 'train' else 'test' end as part from orders""")
def h07(t: Tables):
    return H.group_split(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", 0.8).select("o_orderkey", "part")


@query("h08_folds", f"""
select doc_id, cast(({_BUCKET.format('doc_id', 2147483648)}) % 5 as integer) as fold,
  cast((row_number() over (partition by toxic order by {_MD5.format('doc_id')}, doc_id) - 1) % 5 as integer) as strat_fold from labels""")
def h08(t: Tables):
    a = H.assign_folds(t.labels, "doc_id", 5)
    return H.assign_stratified_folds(a, "toxic", "doc_id", 5, "strat_fold").select("doc_id", "fold", "strat_fold")
