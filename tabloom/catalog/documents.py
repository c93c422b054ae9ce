"""Document structure: strict XML made from orders, tolerant HTML from pages."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, CountVectorizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.catalog.base import Tables, query, rd
from tabloom.operators import documents as D

# one document per order; every tenth is cut off and cannot be parsed
_XML = """(select o_orderkey as k, '<order key="' || o_orderkey || '" status="' || o_orderstatus || '"><price>' ||
 cast(floor(o_totalprice) as bigint) || '</price>' || case o_orderkey % 3 when 0 then '<CRDID> ' || o_custkey || ' </CRDID>'
 when 1 then '<detail><CRD>' || o_custkey || '</CRD></detail>' else '<CRD></CRD>' end || '<who><cust id="' || o_custkey || '">' || o_custkey
 || '</cust><prio>' || o_orderpriority || '</prio></who>' || case when o_orderkey % 10 = 0 then '' else '</order>' end as xml from orders)"""


def xml_docs(t: Tables):
    k, cust = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    key = F.when(k % 3 == 0, F.concat(F.lit("<CRDID> "), cust, F.lit(" </CRDID>"))).when(
        k % 3 == 1, F.concat(F.lit("<detail><CRD>"), cust, F.lit("</CRD></detail>"))).otherwise("<CRD></CRD>")
    return t.orders.select(k.alias("k"), F.concat(
        F.lit('<order key="'), k.cast("string"), F.lit('" status="'), F.col("o_orderstatus"), F.lit('"><price>'),
        F.floor("o_totalprice").cast("string"), F.lit("</price>"), key, F.lit('<who><cust id="'), cust, F.lit('">'), cust,
        F.lit("</cust><prio>"), F.col("o_orderpriority"), F.lit("</prio></who>"),
        F.when(k % 10 == 0, "").otherwise("</order>")).alias("xml"))


@query("j01_basic_structure", """
select o_orderkey as k, case when o_orderkey % 10 <> 0 then case when o_orderkey % 3 = 1 then 6 else 5 end end as total_tags,
 case when o_orderkey % 10 <> 0 then 2 end as max_depth, case when o_orderkey % 10 <> 0 then 3 end as total_attributes from orders""")
def j01(t: Tables):
    d = xml_docs(t).withColumn("s", D.basic_structure(F.col("xml")))
    return d.select("k", "s.total_tags", "s.max_depth", "s.total_attributes")


@query("j01_tag_patterns", """
select page_id, cast(len(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) as integer) as n_tags,
  cast(len(list_distinct(list_transform(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1), lambda x: lower(x)))) as integer) as n_unique,
  cast(len(regexp_extract_all(html, '[a-zA-Z-]+="[^"]*"')) as integer) as n_attributes from pages""")
def j01p(t: Tables):
    tags = D.tag_names(F.col("html"))
    return t.pages.select("page_id", F.size(tags).alias("n_tags"), F.size(F.array_distinct(tags)).alias("n_unique"),
                          D.attribute_count(F.col("html")).alias("n_attributes"))


@query("j02_structure_features", f"""
with d as (select x.*, o_custkey as c, o_orderpriority as p, cast(floor(o_totalprice) as bigint) as v, k % 3 as m,
  case when k % 3 = 1 then 7.0 else 6.0 end as n from {_XML} x join orders on k = o_orderkey where k % 10 <> 0),
-- elements below the root, elements in the documents' inner nodes, texts, and how long names and values are
e as (select *, n - 1 as below, case when m = 1 then 14.0 else 13.0 end as s2, case when m = 1 then 36.0 else 35.0 end as s3,
  case when m = 2 then 3.0 else 4.0 end as texts, length(v::varchar) + case when m = 2 then 1 else 2 end * length(c::varchar) + length(p) as chars,
  [length(k::varchar), 1, length(c::varchar)]::double[] as vals, case when m = 1 then [1, 2, 2, 3, 2, 3, 3] else [1, 2, 2, 2, 3, 3] end::double[] as depths
  from d)
select k, n::double as unique_tags, n::double as total_tags, 3.0::double as max_depth, cast(strlen(xml) as double) as file_size,
  1.0::double as tag_diversity, round(3 / n, 8) as avg_attributes, round(1 / n, 8) as top_tag_share, round(chars / texts, 8) as avg_text_length,
  3.0::double as total_attributes, round(n / strlen(xml), 8) as tag_density, round(list_var_pop(depths), 8) as depth_variance,
  round(list_var_pop(vals), 8) as attr_length_variance, round(s2 / below, 8) as sibling_mean,
  round(s3 / below - (s2 / below) ** 2, 8) as sibling_variance, round(case when m = 1 then 4 else 3 end / n, 8) as path_diversity,
  round((n - texts) / n, 8) as empty_ratio, round(4 / n, 8) as leaf_ratio, 0.0::double as repeated_tag_ratio, round(3 / n, 8) as attr_name_ratio,
  round(case when m = 2 then 2 else 3 end / n, 8) as numeric_ratio from e""")
def j02(t: Tables):
    f = D.structure_features(xml_docs(t), "xml").where(F.col("total_tags").isNotNull())
    return f.select("k", *[rd(c, 8).alias(c) for c in D.FEATURES])


@query("j02_page_features")
def j02p(t: Tables):
    return D.structure_features(t.pages, "html", tolerant=True).select("page_id", *[rd(c).alias(c) for c in D.FEATURES])


@query("j03_key_element", """
select o_orderkey as k, case when o_orderkey % 10 <> 0 and o_orderkey % 3 <> 2 then cast(o_custkey as varchar) end as crd from orders""")
def j03(t: Tables):
    return xml_docs(t).withColumn("e", D.elements(F.col("xml"))).select("k", D.key_element(F.col("e")).alias("crd"))


@query("j04_element_rows", f"""
with d as (select o_orderkey as k, o_custkey as c, o_orderpriority as p, cast(floor(o_totalprice) as bigint) as v, o_orderkey % 3 as m
  from orders where o_orderkey % 10 <> 0)
select k, '/order' as path, null as text, 1 as depth, 2 as n_attrs from d
union all select k, '/order/price', cast(v as varchar), 2, 0 from d
union all select k, '/order/CRDID', ' ' || c || ' ', 2, 0 from d where m = 0
union all select k, '/order/detail', null, 2, 0 from d where m = 1
union all select k, '/order/detail/CRD', cast(c as varchar), 3, 0 from d where m = 1
union all select k, '/order/CRD', null, 2, 0 from d where m = 2
union all select k, '/order/who', null, 2, 0 from d
union all select k, '/order/who/cust', cast(c as varchar), 3, 1 from d
union all select k, '/order/who/prio', p, 3, 0 from d""")
def j04(t: Tables):
    return D.element_rows(xml_docs(t), "k", "xml").select("k", "path", "text", "depth", F.size("attrs").alias("n_attrs"))


_TAGS = "(select page_id, unnest(list_distinct(list_transform(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1), lambda x: lower(x)))) as tag from pages)"


@query("j05_common_tags", f"""
select tag, count(*) as n_docs from {_TAGS} group by tag having count(*) >= 0.8 * (select count(*) from pages)""")
def j05(t: Tables):
    return D.common_tags(t.pages.withColumn("tags", D.tag_names(F.col("html"))), "page_id", "tags")


@query("j05_tag_flags", """
select page_id, cast(len(list_filter(p, lambda x: contains(x, 'h1'))) > 0 as integer) as has_tag_h1,
 cast(len(list_filter(p, lambda x: contains(x, 'li'))) > 0 as integer) as has_tag_li,
 cast(len(list_filter(p, lambda x: contains(x, 'table'))) > 0 as integer) as has_tag_table from (
 select page_id, list_transform(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1), lambda x: lower(x)) as p from pages)""")
def j05f(t: Tables):
    d = t.pages.select("page_id", D.tag_names(F.col("html")).alias("p"))
    return D.tag_flags(d, "p", ["h1", "li", "table"]).drop("p")


@query("j06_breadcrumb_text", """
select o_orderkey as k, '[order] attributes: price is ' || cast(floor(o_totalprice) as bigint) || case o_orderkey % 3
  when 0 then ', CRDID is ' || o_custkey || '.' when 1 then '. [order > detail] attributes: CRD is ' || o_custkey || '.' else '.' end ||
  ' [order > who] attributes: cust is ' || o_custkey || ', prio is ' || o_orderpriority || '.' as text from orders where o_orderkey % 10 <> 0""")
def j06(t: Tables):
    return D.breadcrumb_text(xml_docs(t), "k", "xml")


@query("j07_augment")
def j07(t: Tables):
    made = D.augment(xml_docs(t), "k", "xml", 0.3)
    return made.groupBy("variant").agg(F.count("*").alias("n"), F.countDistinct("k").alias("n_docs"),
                                       F.sum(F.col("xml").contains("_modified").cast("int")).alias("n_modified"))


@query("j08_term_weights")
def j08(t: Tables):
    words = RegexTokenizer(inputCol="text", outputCol="w", pattern=r"[^\p{L}]+")
    counts = CountVectorizer(inputCol="w", outputCol="c", vocabSize=50)
    model = Pipeline(stages=[words, counts, IDF(inputCol="c", outputCol="tfidf")]).fit(t.documents)
    return model.transform(t.documents).select(
        "doc_id", F.transform(vector_to_array("tfidf"), lambda x: F.round(x, 6)).alias("weights"))


@query("j09_score_documents", f"""
select k, case when k % 10 = 0 then 'failed' else 'ok' end as status,
  case when k % 10 <> 0 then round(1 / (1 + exp(-(case when k % 3 = 1 then 7 else 6 end * 0.5 - strlen(xml) * 0.02))), 6) end as error_probability
from {_XML}""")
def j09(t: Tables):
    z = F.col("total_tags") * 0.5 - F.col("file_size") * 0.02
    d = D.score_documents(xml_docs(t), "xml", 1 / (1 + F.exp(-z)))
    return d.select("k", "status", rd("error_probability").alias("error_probability"))
