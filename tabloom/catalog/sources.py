"""Sources and sinks: the given tables written out and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog.base import Tables, as_int, as_long, query, rd
from tabloom.operators.shaping import cast_all
from tabloom.session import scratch_path
from tabloom.sources.readers import (
    read_corpus,
    read_csv_header,
    read_csv_promote_header,
    read_delimited,
    read_table,
    read_with_schema,
)
from tabloom.sources.writers import (
    control_repartition,
    export_flat,
    export_hashed,
    replace_slice,
    write_documents,
    write_partitioned,
)


@query("a01_read_delimited", """
select l_returnflag, l_linestatus, count(*) as n, round(sum(l_quantity), 2) as qty,
  round(sum(l_extendedprice), 2) as price from lineitem group by l_returnflag, l_linestatus""")
def a01(t: Tables):
    src = t.lineitem
    path = scratch_path(t.spark, "a01")
    export_flat(cast_all(src), path, "^", header=False)
    back = read_delimited(t.spark, path, "^", src.columns)
    return back.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"),
        rd(F.sum(F.col("l_quantity").cast("double")), 2).alias("qty"),
        rd(F.sum(F.col("l_extendedprice").cast("double")), 2).alias("price"),
    )


@query("a02_read_csv_header", """
select o_orderkey, o_orderpriority, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') as order_day from orders""")
def a02(t: Tables):
    src = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice", F.col("o_orderdate").cast("date"))
    path = scratch_path(t.spark, "a02")
    # padded values: the reader strips the leading blanks
    export_flat(src.withColumn("o_orderpriority", F.concat(F.lit("  "), "o_orderpriority")), path)
    back = read_csv_header(t.spark, path, "o_orderkey bigint, o_orderpriority string, o_totalprice double, o_orderdate date",
                           date_format="yyyy-MM-dd")
    return back.select("o_orderkey", "o_orderpriority", "o_totalprice",
                       F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"))


def _two_header_source(t: Tables, df, codes, path: str) -> None:
    """Part files that each start with a code header and a name header."""
    names = df.columns
    parts = 8
    body = cast_all(df).withColumn("_p", F.pmod(F.xxhash64(*names), F.lit(parts)).cast("int")).withColumn("_d", F.lit(1))
    heads = t.spark.range(parts).select(*[F.lit(n).alias(n) for n in names], F.col("id").cast("int").alias("_p"),
                                        F.lit(0).alias("_d"))
    rows = body.unionByName(heads).repartition(parts, "_p").sortWithinPartitions("_p", "_d")
    export_flat(rows.drop("_p", "_d").toDF(*codes), path)


@query("a03_read_csv_promote_header", """
select 'suppliers' as source_tag, s_suppkey as row_key, s_name as name, null as segment, s_acctbal as balance from supplier
union all select 'customers', c_custkey, c_name, c_mktsegment, c_acctbal from customer""")
def a03(t: Tables):
    sup = t.supplier.select(F.col("s_suppkey").alias("row_key"), F.col("s_name").alias("name"),
                            F.col("s_acctbal").alias("balance"))
    cus = t.customer.select(F.col("c_custkey").alias("row_key"), F.col("c_name").alias("name"),
                            F.col("c_acctbal").alias("balance"))
    p1, p2, p3 = (scratch_path(t.spark, "a03") for _ in range(3))
    _two_header_source(t, sup, ["v001", "v002", "v003"], p1)
    _two_header_source(t, cus, ["v001", "v002", "v003"], p2)
    seg = t.customer.select(F.col("c_custkey").alias("row_key"), F.col("c_mktsegment").alias("segment"))
    _two_header_source(t, seg, ["v001", "v009"], p3)
    two = read_csv_promote_header(t.spark, {"suppliers": p1, "customers": p2}, 3)
    more = read_csv_promote_header(t.spark, {"customers": p3}, 2)
    return two.join(more, ["source_tag", "row_key"], "left").select(
        "source_tag", as_long("row_key").alias("row_key"), "name", "segment",
        F.col("balance").cast("double").alias("balance"))


@query("a06_read_table", "select o_orderstatus, count(*) as n from orders group by o_orderstatus")
def a06(t: Tables):
    t.orders.createOrReplaceTempView("tabloom_orders")
    return read_table(t.spark, "tabloom_orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("a07_read_corpus", """
select page_id, cast(strlen(html) + 1 as bigint) as size, md5(html || chr(10)) as digest from pages""")
def a07(t: Tables):
    path = scratch_path(t.spark, "a07")
    write_documents(t.pages, path, "page_id", "html")
    page = F.regexp_extract("path", r"page_id=(\d+)", 1).cast("long").alias("page_id")
    return read_corpus(t.spark, path, "*.txt").select(page, "size", F.md5(F.encode("content", "UTF-8")).alias("digest"))


@query("a08_read_with_schema", """
select l_returnflag, l_linenumber, count(*) as n, round(sum(l_quantity), 2) as qty from lineitem
group by l_returnflag, l_linenumber""")
def a08(t: Tables):
    path = scratch_path(t.spark, "a08")
    export_flat(t.lineitem.drop("l_shipdate"), path)
    types = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "int", "l_linenumber": "tinyint",
             "l_quantity": "float", "l_extendedprice": "double", "l_discount": "float", "l_tax": "float",
             "l_returnflag": "string", "l_linestatus": "string"}
    df = read_with_schema(t.spark, path, types, ["l_returnflag", "l_linenumber", "l_quantity"])
    return df.groupBy("l_returnflag", as_int("l_linenumber").alias("l_linenumber")).agg(
        F.count("*").alias("n"), rd(F.sum(F.col("l_quantity").cast("double")), 2).alias("qty"))


@query("a09_write_partitioned", """
select o_orderstatus, year(o_orderdate) as order_year, count(*) as n, round(sum(o_totalprice), 2) as total
from orders group by o_orderstatus, year(o_orderdate)""")
def a09(t: Tables):
    path = scratch_path(t.spark, "a09")
    write_partitioned(t.orders.withColumn("order_year", F.year("o_orderdate")), path, ["o_orderstatus", "order_year"])
    back = t.spark.read.parquet(path)
    return back.groupBy("o_orderstatus", as_long("order_year").alias("order_year")).agg(
        F.count("*").alias("n"), rd(F.sum("o_totalprice"), 2).alias("total"))


@query("a10_replace_slice", """
select o_orderstatus, count(*) as n, round(sum(case when o_orderstatus = 'P' then 2 else 1 end * o_totalprice), 2) as total
from orders group by o_orderstatus""")
def a10(t: Tables):
    path = scratch_path(t.spark, "a10")
    orders = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    replace_slice(orders, path, ["o_orderstatus"])
    again = orders.where(F.col("o_orderstatus") == "P").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    replace_slice(again, path, ["o_orderstatus"])
    replace_slice(again, path, ["o_orderstatus"])
    return t.spark.read.parquet(path).groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), rd(F.sum("o_totalprice"), 2).alias("total"))


@query("a12_export_flat", "select c_custkey, c_name, c_mktsegment, c_acctbal from customer")
def a12(t: Tables):
    path = scratch_path(t.spark, "a12")
    src = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    export_flat(src, path, "|")
    return t.spark.read.schema(src.schema).option("sep", "|").option("header", True).csv(path)


_HASHED = """select cast(c_custkey as varchar) as c_custkey,
  case when c_custkey % 10 = 0 then '' else to_base64(unhex(sha256(c_name))) end as c_name,
  c_mktsegment, c_mktsegment as "c_mktsegment_MASTER" from customer"""


@query("a13_export_hashed", _HASHED)
def a13(t: Tables):
    c = t.customer.select(
        "c_custkey", F.when(F.col("c_custkey") % 10 != 0, F.col("c_name")).alias("c_name"), "c_mktsegment",
        F.col("c_mktsegment"))
    path = scratch_path(t.spark, "a13")
    export_hashed(c, path, ["c_name"])
    back = t.spark.read.option("sep", "|").option("header", True).option("escape", '"').csv(path)
    return back.select(*[F.coalesce(x, F.lit("")).alias(x) for x in back.columns])


@query("a13_manifest", """
select count(*) as n_rows, cast(sum(('0x' || substr(md5(c_custkey || chr(31) || to_base64(unhex(sha256(c_name))) || chr(31) || c_mktsegment), 1, 15))::bigint) as varchar) as digest
from customer""")
def a13_manifest(t: Tables):
    sent = export_hashed(t.customer.select("c_custkey", "c_name", "c_mktsegment"), scratch_path(t.spark, "a13m"), ["c_name"])
    return sent.select("n_rows", F.col("digest").cast("string").alias("digest"))


@query("a14_control_repartition", """
select l_shipdate_year, count(*) as n from (select year(l_shipdate) as l_shipdate_year from lineitem) group by 1""")
def a14(t: Tables):
    path = scratch_path(t.spark, "a14")
    control_repartition(t.lineitem.select(F.year("l_shipdate").cast("long").alias("l_shipdate_year"))).write.parquet(path)
    return t.spark.read.parquet(path).groupBy("l_shipdate_year").agg(F.count("*").alias("n"))
