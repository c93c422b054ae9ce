"""Encoding, imputation and column selection."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.catalog.base import DIRTY_EVENTS, Tables, as_int, dirty_events, query, rd
from tabloom.operators import encoding as E

# part with constant, sparse, copied and null-bearing columns beside the real ones
_P = """(select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, 'x' as k_const, case when p_partkey % 10 < 4 then p_type end as sparse,
  case when p_partkey % 10 < 8 then p_size end as some_null, p_retailprice * 2 + p_size * 0.001 as price2, -p_retailprice as price_neg from part)"""


def wide_parts(t: Tables):
    k = F.col("p_partkey") % 10
    return t.part.select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice", F.lit("x").alias("k_const"),
        F.when(k < 4, F.col("p_type")).alias("sparse"), F.when(k < 8, F.col("p_size")).alias("some_null"),
        (F.col("p_retailprice") * 2 + F.col("p_size") * 0.001).alias("price2"), (-F.col("p_retailprice")).alias("price_neg"))


@query("k00_prune_by_statistics", f"select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, price_neg from {_P}")
def k00(t: Tables):
    from tabloom.plans.wide import prune

    return prune(wide_parts(t), ["p_partkey"])[0]


@query("k01_encode_features")
def k01(t: Tables):
    d = dirty_events(t).fillna("UNK", ["etype"]).fillna(0.0, ["amount"])
    out = E.feature_pipeline(["etype"], ["amount", "value"]).fit(d).transform(d)
    return out.select("event_id", F.transform(vector_to_array("features"), lambda x: F.round(x, 6)).alias("features"))


_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("k02_dummies", f"""
select p_partkey, cast(p_type = 'LARGE' as integer) as type_large, cast(p_type = 'SMALL' as integer) as type_small, 0 as absent from part""")
def k02(t: Tables):
    domains = E.fit_domains(t.part, ["p_type"])
    d = E.dummies(t.part.select("p_partkey", "p_type"), domains)
    a = E.align_columns(d, ["p_partkey", "p_type_=_LARGE", "p_type_=_SMALL", "p_type_=_ABSENT"])
    return a.toDF("p_partkey", "type_large", "type_small", "absent")


@query("k02_dummies_drop_first", """
select p_type, count(*) as n, cast(sum(cast(p_type <> (select min(p_type) from part) as integer)) as bigint) as ones from part group by p_type""")
def k02d(t: Tables):
    src = t.part.select("p_partkey", "p_type", F.col("p_type").alias("kind"))
    d = E.dummies(src, E.fit_domains(t.part.withColumnRenamed("p_type", "kind"), ["kind"]), drop_first=True)
    ones = sum((F.col(f"`{c}`") for c in d.columns if c.startswith("kind_=_")), F.lit(0))
    return d.groupBy("p_type").agg(F.count("*").alias("n"), F.sum(ones).alias("ones"))


@query("k03_label_codes", """
select v.p_brand, v.code as sorted_code, f.code as first_code from
 (select p_brand, row_number() over (order by p_brand) - 1 as code from (select distinct p_brand from part)) v join
 (select p_brand, row_number() over (order by k, p_brand) - 1 as code from (select p_brand, min(p_partkey) as k from part group by p_brand)) f
 on v.p_brand = f.p_brand""")
def k03(t: Tables):
    a = E.label_codes(t.part, "p_brand").withColumnRenamed("code", "sorted_code")
    b = E.label_codes(t.part, "p_brand", "p_partkey").withColumnRenamed("code", "first_code")
    return a.join(b, "p_brand")


@query("k03_label_encode", """
with c as (select p_type, row_number() over (order by p_type) - 1 as code from (select distinct p_type from part where p_size < 10))
select p_partkey, coalesce(code, -1) as code, c.p_type as decoded from part left join c on part.p_type = c.p_type""")
def k03e(t: Tables):
    codes = E.label_codes(t.part.where(F.col("p_size") < 10), "p_type")
    e = E.label_encode(t.part.select("p_partkey", "p_type"), "p_type", codes, "code").drop("p_type")
    return E.label_decode(e, "code", codes, "decoded").select("p_partkey", "code", "decoded")


@query("k04_scale_standard", """
select p_partkey, round((p_retailprice - avg(p_retailprice) over ()) / stddev_pop(p_retailprice) over (), 6) as z,
 round((p_size - min(p_size) over ()) / (max(p_size) over () - min(p_size) over ()), 6) as m from part""")
def k04(t: Tables):
    d = E.scale(E.scale(t.part, ["p_retailprice"]), ["p_size"], "minmax")
    return d.select("p_partkey", rd("p_retailprice_scaled").alias("z"), rd("p_size_scaled").alias("m"))


@query("k04_scale_robust", """
select p_partkey, round((p_retailprice - b) / (c - a), 6) as r from part, (select quantile_cont(p_retailprice, 0.25) as a,
 quantile_cont(p_retailprice, 0.5) as b, quantile_cont(p_retailprice, 0.75) as c from part)""")
def k04r(t: Tables):
    return E.scale(t.part, ["p_retailprice"], "robust").select("p_partkey", rd("p_retailprice_scaled").alias("r"))


@query("k05_principal_components")
def k05(t: Tables):
    cols = [f"x{i}" for i in range(64)]
    d = t.embeddings.select("vec_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(cols)])
    scores, explained, k = E.principal_components(d, cols, 0.95)
    return scores.select("vec_id", F.lit(k).alias("k"), F.lit(round(sum(explained[:k]), 6)).alias("explained"),
                         rd(F.abs(F.col("pca")[0]), 5).alias("first"))


@query("k06_polynomial", """
select p_partkey, p_size::double as x, (p_size * p_size)::double as xx, p_retailprice as y, round(p_size * p_retailprice, 4) as xy,
 round(p_retailprice * p_retailprice, 4) as yy from part""")
def k06(t: Tables):
    d = E.polynomial(t.part, ["p_size", "p_retailprice"]).withColumn("a", vector_to_array("poly"))
    return d.select("p_partkey", *[rd(F.col("a")[i], 4).alias(n) for i, n in enumerate(["x", "xx", "y", "xy", "yy"])])


@query("k07_fill_constants", f"select event_id, coalesce(etype, 'None') as etype, coalesce(amount, 0) as amount from {DIRTY_EVENTS}")
def k07(t: Tables):
    return E.fill_constants(dirty_events(t).select("event_id", "etype", "amount"), {"etype": "None", "amount": 0.0})


@query("k08_fill_statistic", f"""
with m as (select median(amount) as med, avg(amount) as mean from {DIRTY_EVENTS}),
mo as (select etype as mode from {DIRTY_EVENTS} where etype is not null group by etype order by count(*) desc, etype limit 1)
select event_id, round(coalesce(amount, med), 6) as med_fill, round(coalesce(amount, mean), 6) as mean_fill,
  cast(amount is null as integer) as amount_missing, coalesce(etype, mode) as etype from {DIRTY_EVENTS}, m, mo""")
def k08(t: Tables):
    d = dirty_events(t).withColumns({"med_fill": F.col("amount"), "mean_fill": F.col("amount")})
    d = E.fill_statistic(d, ["med_fill"], "median")
    d = E.fill_statistic(d, ["mean_fill"], "mean")
    d = E.fill_statistic(d, ["amount"], "mean", indicator=True)
    d = E.fill_statistic(d, ["etype"], "mode")
    return d.select("event_id", rd("med_fill").alias("med_fill"), rd("mean_fill").alias("mean_fill"), "amount_missing", "etype")


@query("k09_fill_by_tree", f"""
select p_partkey, some_null is not null as was_known, round(some_null::double, 6) as known_value, 1 as within_known from {_P}""")
def k09(t: Tables):
    """Known values stay; filled ones lie between the least and the largest known value."""
    d = wide_parts(t).withColumn("some_null", F.col("some_null").cast("double")).withColumn("before", F.col("some_null"))
    out = E.fill_by_tree(d, "some_null", ["p_retailprice", "price2"])
    least, most = (d.agg(f("before")).scalar() for f in (F.min, F.max))
    fits = F.col("some_null").between(least, most) & F.coalesce(F.col("some_null") == F.col("before"), F.lit(True))
    return out.select("p_partkey", F.col("before").isNotNull().alias("was_known"),
                      rd(F.when(F.col("before").isNotNull(), F.col("some_null"))).alias("known_value"), as_int(fits).alias("within_known"))


@query("k10_drop_sparse", f"select p_partkey, some_null, k_const from {_P}")
def k10(t: Tables):
    d = wide_parts(t).select("p_partkey", "some_null", "sparse", "k_const")
    return E.drop_columns(d, E.sparse_columns(d, 0.7))


@query("k11_drop_constant", f"select p_partkey, some_null, sparse from {_P}")
def k11(t: Tables):
    d = wide_parts(t).select("p_partkey", "some_null", "sparse", "k_const")
    return E.drop_columns(d, E.constant_columns(d))


@query("k12_drop_high_cardinality", f"select p_partkey, p_brand, p_type, coalesce(sparse, 'NA') as sparse, coalesce(some_null, 0) as some_null from {_P}")
def k12(t: Tables):
    d = wide_parts(t).select("p_partkey", "p_name", "p_brand", "p_type", "sparse", "some_null", "k_const")
    return E.prune_and_fill(d, ["p_partkey"])[0]


@query("k13_drop_correlated", f"select p_partkey, p_size, price_neg, p_retailprice from {_P}")
def k13(t: Tables):
    d = wide_parts(t).select("p_partkey", "p_size", "p_retailprice", "price2", "price_neg")
    return E.drop_columns(d, E.correlated_columns(d, ["p_size", "p_retailprice", "price2", "price_neg"]))


@query("k14_drop_null_bearing", f"select p_partkey, k_const from {_P}")
def k14(t: Tables):
    d = wide_parts(t).select("p_partkey", "some_null", "sparse", "k_const")
    return E.drop_columns(d, E.null_bearing_columns(d))


def _f_sql(c: str) -> str:
    return f"""select '{c}' as variable, round((sum(n * pow(m - g, 2)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))), 4) as f_value
 from (select label, count(*) as n, avg({c}) as m, var_pop({c}) as v from x group by label), (select avg({c}) as g from x)"""


_KCOLS = [f"x{i}" for i in range(1, 65)]
_X = "(select label, " + ", ".join(f"embedding[{i}]::double as x{i}" for i in range(1, 65)) + " from embeddings)"


def embedding_columns(t: Tables, n: int = 64):
    return t.embeddings.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"x{i + 1}") for i in range(n)])


@query("k15_anova_f", f"with x as (select * from {_X}) " + " union all ".join(_f_sql(c) for c in _KCOLS))
def k15(t: Tables):
    return E.anova_f(embedding_columns(t), "label", _KCOLS).withColumn("f_value", rd("f_value", 4))


@query("k15_k_best", f"""with x as (select * from {_X}) select variable from ({' union all '.join(_f_sql(c) for c in _KCOLS)})
order by f_value desc limit 8""")
def k15b(t: Tables):
    best = E.k_best(embedding_columns(t), "label", _KCOLS, 8)
    return t.spark.createDataFrame([(b,) for b in best], "variable string")


@query("k16_recursive_elimination")
def k16(t: Tables):
    left = E.recursive_elimination(embedding_columns(t), "label", _KCOLS, keep=8, step=14, trees=10)
    return t.spark.createDataFrame([(c,) for c in left], "variable string")


@query("k17_base_features", """
select distinct split_part(f, '_=_', 1) as feature from (select unnest(['p_type_=_' || p_type, 'p_brand_=_' || p_brand, 'p_size']) as f from part)
union select 'claim_number'""")
def k17(t: Tables):
    d = t.part.select(F.concat(F.lit("p_type_=_"), "p_type", F.lit(",p_brand_=_"), "p_brand", F.lit(",p_size,NA")).alias("features"))
    return E.base_features(d, "features", ["claim_number"])
