"""Projection, schema shaping and filters on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog.base import CLAIMS, DIRTY_EVENTS, SCORED, Tables, as_int, as_long, claims, dirty_events, query, rd, scored
from tabloom.operators import filters as K
from tabloom.operators import shaping as S


@query("b01_headers_basic", """
select o_orderkey as order_key_id, o_totalprice as total_price_usd, o_orderstatus as status_code from orders""")
def b01(t: Tables):
    o = t.orders.select(F.col("o_orderkey").alias("Order-Key, ID"), F.col("o_totalprice").alias("Total/Price USD"),
                        F.col("o_orderstatus").alias("Status Code"))
    return S.normalize_headers(o, "basic").select(
        F.col("order_key_id"), "total_price_usd", "status_code")


@query("b01_headers_strict", """
select o_orderkey as order_key, o_totalprice as total_price_raw_value, o_orderstatus as status from orders""")
def b01s(t: Tables):
    o = t.orders.select(F.col("o_orderkey").alias("% Order.Key"), F.col("o_totalprice").alias("Total Price (raw+value)"),
                        F.col("o_orderstatus").alias("[Status]="))
    return S.normalize_headers(o, "strict")


@query("b01_headers_formula", """
select o_orderkey as "Order_Key", o_totalprice as "pct_Total_price" from orders""")
def b01f(t: Tables):
    o = t.orders.select(F.col("o_orderkey").alias("Order-Key"), F.col("o_totalprice").alias("% Total price"))
    return S.normalize_headers(o, "formula")


@query("b02_map_columns", "select o_orderkey as claim_number, o_totalprice as paid_amount, o_orderstatus as claim_status from orders")
def b02(t: Tables):
    mapping = t.spark.createDataFrame(
        [("A", "o_orderkey", "claim_number"), ("A", "o_totalprice", "paid_amount"), ("A", "o_orderstatus", "claim_status"),
         ("B", "o_custkey", "member")],
        "client_code string, prediction_column_name string, training_column_name string")
    return S.map_columns(t.orders, mapping, "A")


@query("b03_add_literals", "select n_nationkey, n_name, 'C1' as client_code, '2024-01-31' as rundate, s_suppkey from nation join supplier on n_nationkey = s_nationkey")
def b03(t: Tables):
    df = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("n_nationkey", "n_name", "s_suppkey")
    return S.add_literals(df, {"client_code": "C1", "rundate": "2024-01-31"})


@query("b04_cast_trim", f"select cast(event_id as varchar) as event_id, trim(etype) as etype, trim(amount_text) as amount_text from {DIRTY_EVENTS}")
def b04(t: Tables):
    return S.trim_all(S.cast_all(dirty_events(t).select("event_id", "etype", "amount_text")))


@query("b05_drop_matching", "select l_orderkey, l_quantity, l_discount, l_tax from lineitem")
def b05(t: Tables):
    return S.drop_matching(t.lineitem, ["date", "flag$", "^l_.*price", "status", "part", "supp", "linenumber"])


@query("b06_drop_identical", "select o_orderkey, o_totalprice, o_orderstatus, o_custkey from orders")
def b06(t: Tables):
    o = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus", "o_custkey",
                        F.col("o_totalprice").alias("price_copy"), F.col("o_orderstatus").alias("status_copy"))
    return S.drop_identical_columns(o)


@query("b06_drop_repeated_names", "select c_custkey, c_name from customer")
def b06n(t: Tables):
    return S.drop_repeated_names(t.customer.select("c_custkey", "c_name", F.col("c_acctbal").alias("c_name")))


@query("b07_select_available", "select p_partkey, p_brand, cast(1 as integer) as n_missing from part")
def b07(t: Tables):
    df, _, missing = S.select_available(t.part, ["p_partkey", "p_brand", "p_colour"])
    return df.withColumn("n_missing", F.lit(len(missing)))


@query("b08_split_by_dtype", """
select 'numeric' as kind, count(*) as n, round(sum(p_size + p_retailprice), 2) as total from part
union all select 'text', count(*), sum(length(p_name || p_brand || p_type)) from part""")
def b08(t: Tables):
    num, text = S.names_by_type(t.part)
    num = [c for c in num if c != "p_partkey"]
    a = t.part.agg(F.count("*").alias("n"), rd(F.sum(sum((F.col(c) for c in num), F.lit(0))), 2).alias("total"))
    b = t.part.agg(F.count("*").alias("n"), F.sum(F.length(F.concat(*text))).cast("double").alias("total"))
    return a.withColumn("kind", F.lit("numeric")).unionByName(b.withColumn("kind", F.lit("text")))


@query("b09_coalesce_columns", """
select o_orderkey, coalesce(case when o_orderkey % 3 = 0 then null else 'A' || o_custkey end, 'B' || o_orderkey) as case_no from orders""")
def b09(t: Tables):
    o = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit("A"), F.col("o_custkey").cast("string"))).alias("case_no"),
        F.concat(F.lit("B"), F.col("o_orderkey").cast("string")).alias("case_number"))
    return S.coalesce_columns(o, ["case_no", "case_number"], "case_no")


@query("b10_narrow_types", """
select p_size, count(*) as n, round(sum(cast(cast(p_retailprice as float) as double)), 1) as total, 'tinyint' as size_type
from part group by p_size""")
def b10(t: Tables):
    narrow = S.narrow_types(t.part)
    kind = narrow.schema["p_size"].dataType.simpleString()
    return narrow.groupBy(as_int("p_size").alias("p_size")).agg(
        F.count("*").alias("n"), rd(F.sum(F.col("p_retailprice").cast("double")), 1).alias("total")
    ).withColumn("size_type", F.lit(kind))


@query("b11_to_numeric", f"""
select event_id, coalesce(try_cast(amount_text as double), 0.0) as amount_text, try_cast(etype as integer) as etype
from {DIRTY_EVENTS}""")
def b11(t: Tables):
    d = dirty_events(t).select("event_id", "amount_text", "etype")
    return S.to_numeric(S.to_numeric(d, ["amount_text"], fill=0.0), ["etype"], dtype="int")


@query("b12_promote_categorical", "select p_partkey, cast(p_size as varchar) as p_size from part")
def b12(t: Tables):
    return S.promote_categorical(t.part.select("p_partkey", "p_size"), ["p_size"])


@query("b13_rename_and_order", 'select o_orderstatus as status, o_orderkey as third_key, o_totalprice from orders')
def b13(t: Tables):
    src = t.orders.select(F.col("o_orderkey").alias("3rdkey"), F.col("o_orderstatus").alias("status_"), "o_totalprice")
    return S.rename_and_order(src, {"3rdkey": "third_key", "status_": "status"}, ["status", "third_key", "o_totalprice"])


# -- filters ------------------------------------------------------------------


@query("c01_status_filter", f"select claim_id, plan, amount from {CLAIMS} where claim_status = 'P'")
def c01(t: Tables):
    return K.keep_status(claims(t), "claim_status", "P").select("claim_id", "plan", "amount")


@query("c02_membership_filter", f"""
select claim_id, plan from {CLAIMS} where plan in ('BUILDING', 'MACHINERY')
and nation in (select s_nationkey from supplier where s_acctbal > 5000)""")
def c02(t: Tables):
    kept = K.keep_members(claims(t), "plan", ["BUILDING", "MACHINERY"])
    rich = t.supplier.where(F.col("s_acctbal") > 5000).select("s_nationkey")
    return K.keep_members(kept, "nation", rich).select("claim_id", "plan")


@query("c03_leading_blank", f"select event_id, etype from {DIRTY_EVENTS} where etype not like ' %'")
def c03(t: Tables):
    return K.drop_leading_blank(dirty_events(t), "etype").select("event_id", "etype")


@query("c04_score_threshold", f"select claim_id, round(probability_score, 6) as p from {SCORED} where probability_score > 0.15")
def c04(t: Tables):
    return K.above(scored(t), "probability_score", 0.15).select("claim_id", rd("probability_score").alias("p"))


@query("c05_compound_rule", f"""
select event_id, amount from {DIRTY_EVENTS} where not coalesce(amount > 50 and user_id < 40, false)""")
def c05(t: Tables):
    return K.drop_where(dirty_events(t), (F.col("amount") > 50) & (F.col("user_id") < 40)).select("event_id", "amount")


@query("c06_complete_cases", f"select event_id from {DIRTY_EVENTS} where etype is not null and amount is not null")
def c06(t: Tables):
    return K.complete_cases(dirty_events(t), ["etype", "amount"]).select("event_id")


@query("c07_sentinel_keys", "select c_custkey, c_nationkey from customer where c_nationkey <> 0")
def c07(t: Tables):
    return K.drop_sentinel_keys(t.customer, "c_nationkey").select("c_custkey", "c_nationkey")


@query("c08_group_size", """
select o_orderkey, o_custkey from orders where o_custkey in (
  select o_custkey from orders group by o_custkey having count(*) between 5 and 12)""")
def c08(t: Tables):
    return K.keep_group_size(t.orders, ["o_custkey"], 5, 12).select("o_orderkey", "o_custkey")


_WIDE = "(select o_orderkey, exp(o_totalprice / 60000.0) as x from orders)"


def _wide(t: Tables):
    return t.orders.select("o_orderkey", F.exp(F.col("o_totalprice") / 60000.0).alias("x"))


@query("c09_outliers_iqr", f"""
with q as (select quantile_cont(x, 0.25) as a, quantile_cont(x, 0.75) as b from {_WIDE})
select o_orderkey, round(x, 4) as x from {_WIDE}, q where x >= a - 1.5 * (b - a) and x <= b + 1.5 * (b - a)""")
def c09(t: Tables):
    return K.drop_outliers(_wide(t), "x", "iqr").select("o_orderkey", rd("x", 4).alias("x"))


@query("c09_outliers_zscore", f"""
with q as (select avg(x) as m, stddev_pop(x) as s from {_WIDE})
select o_orderkey, cast(abs(x - m) / s > 3 as integer) as is_outlier from {_WIDE}, q""")
def c09z(t: Tables):
    return K.with_outlier_flag(_wide(t), "x", "zscore").select("o_orderkey", as_int("is_outlier").alias("is_outlier"))


@query("c09_outliers_sigma", f"""
with q as (select avg(x) as m, stddev_samp(x) as s from {_WIDE})
select count(*) as n_kept from {_WIDE}, q where x between m - 3 * s and m + 3 * s""")
def c09s(t: Tables):
    return K.drop_outliers(_wide(t), "x", "sigma").agg(as_long(F.count("*")).alias("n_kept"))
