import xml.etree.ElementTree as ET

import numpy as np
import pytest
from tests.helpers import rows
from pyspark.sql import functions as F

from tabloom.operators import documents as D

DOC = '<a x="1"><b>12</b><b y="22" z="3">text</b><c><d/></c></a>'


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(1, DOC), (2, "<a><b></a>"), (3, None), (4, "<r/>")], "id int, xml string")


def test_features_by_hand(docs):
    f = {r["id"]: r for r in D.structure_features(docs, "xml").collect()}
    one = f[1].asDict()
    assert f[2]["total_tags"] is None and f[3]["total_tags"] is None
    # a(1) b(2) b(2) c(2) d(3); a has 3 children, c has 1
    want = {
        "unique_tags": 4, "total_tags": 5, "max_depth": 3, "file_size": len(DOC), "tag_diversity": 0.8, "avg_attributes": 0.6,
        "top_tag_share": 0.4, "avg_text_length": 3, "total_attributes": 3, "tag_density": 5 / len(DOC), "depth_variance": 0.4,
        "attr_length_variance": 2 / 9, "sibling_mean": 2.5, "sibling_variance": 0.75, "path_diversity": 0.6, "empty_ratio": 0.6,
        "leaf_ratio": 0.6, "repeated_tag_ratio": 0.25, "attr_name_ratio": 0.6, "numeric_ratio": 0.2,
    }
    assert {k: one[k] for k in D.FEATURES} == pytest.approx(want)
    assert f[4]["leaf_ratio"] == 1.0 and f[4]["sibling_mean"] == 0.0


def test_counts_follow_the_element_list(spark):
    texts = [DOC, "<a>12\n</a>", "<a>12&#13;&#10;</a>", "<a> 12 \n</a>", "<a>12&#8232;</a>", "<a>\t</a>", "<a b='x' c=''><b/><b/> t <c><b><b/></b></c></a>",
             "<a>é😀<b x='😀' z='1'>٣</b></a>", "<a", "", "text only", "<p>1<br>2<li x=1 x=2 y>3</p>", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, x string")
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, v: s + v)
    for tolerant in (False, True):
        e = df.withColumn("e", D.elements(F.col("x"), tolerant))
        words = F.filter(F.transform("e", lambda e: F.trim(F.coalesce(e["text"], F.lit("")))), lambda t: t != "")
        kids = F.transform("e", lambda e: e["children"])
        values = F.flatten(F.transform("e", lambda e: F.map_values(e["attrs"])))
        want = e.select("id", F.when(F.col("e").isNotNull(), F.struct(
            F.size("e").alias("tags"), F.size(F.array_distinct(F.transform("e", lambda e: e["tag"]))).alias("unique"),
            total(F.transform("e", lambda e: e["depth"] * e["depth"])).alias("d2"), total(F.transform(kids, lambda k: k * k * k)).alias("k3"),
            F.size(F.array_distinct(F.transform(F.filter("e", lambda e: e["children"] > 0), lambda e: e["path"]))).alias("inner"),
            F.size(words).alias("texts"), F.size(F.filter(words, lambda t: t.rlike("^[0-9]+$"))).alias("numeric"),
            total(F.transform(values, lambda v: F.length(v))).alias("v1"), F.size(values).alias("vals"))).alias("c"))
        got = e.select("id", D.structure_counts(F.col("x"), tolerant).alias("c"))
        names = ("tags", "unique", "d2", "k3", "inner", "texts", "numeric", "v1", "vals")
        assert rows(got.select("id", *[f"c.{n}" for n in names]), "id") == rows(want.select("id", *[f"c.{n}" for n in names]), "id")


def test_basic_structure(docs):
    got = rows(docs.select("id", D.basic_structure(F.col("xml")).alias("s")).select("id", "s.total_tags", "s.max_depth", "s.total_attributes"), "id")
    assert got == [(1, 4, 2, 3), (2, None, None, None), (3, None, None, None), (4, 0, 0, 0)]


@pytest.mark.parametrize("text", [
    '<a x="1"><b>12</b><b y="22" z="3">te&amp;xt&#65;</b><c><d/></c></a>', "<a><b></a>", "<r/>", "<a/><b/>", "<a>x & y</a>", '<a b="1" b="2"/>',
    "<?xml version='1.0'?><!-- <c> --><a>x<!-- d -->y<![CDATA[<z> & ]]><q/>tail</a>\n", "", "text", "<a></a>x", "x<a/>", "<a <b></b></a>", "<a></b>",
    "<a><b></a></b>", '<a b="x > y"><c d=\'"\'/></a>', "<a b=1/>", "<1a/>", "<a>&nbsp;</a>", "<a>\x01</a>", "</a>", "<a", "<é><ü/></é >", "<a><a><a/></a></a>",
    "<a>" * 40 + "</a>" * 40, "<a>" * 40 + "</a>" * 39, "<a>]]</a><!-- after -->", "<!DOCTYPE a [<!ELEMENT a ANY>]><a/>"])
def test_basic_structure_equals_a_parser(spark, text):
    got = spark.createDataFrame([(text,)], "x string").select(D.basic_structure(F.col("x")).alias("s")).first()["s"]
    try:
        root = ET.fromstring(text)
    except ET.ParseError:
        assert got is None
        return

    def depth(e):
        return 1 + max(map(depth, e), default=-1)

    nodes = list(root.iter())
    assert tuple(got) == (len(nodes) - 1, depth(root), sum(len(e.attrib) for e in nodes))


def test_elements_and_key(spark):
    df = spark.createDataFrame([("<a><CRD> 7 </CRD></a>",), ("<a><x><CRD>8</CRD></x><CRDID>9</CRDID></a>",), ("<a><CRD/></a>",)], "x string")
    assert [r[0] for r in df.select(D.key_element(D.elements(F.col("x")))).collect()] == ["7", "9", None]


def test_tolerant_parse(spark):
    df = spark.createDataFrame([(1, '<div><p>one<p>two<br></div><img src="a"></span>')], "id int, h string")
    got = rows(D.element_rows(df, "id", "h", tolerant=True).select("path", "depth", "text"), "pos")
    assert got == [("/div", 1, None), ("/div/p", 2, "one"), ("/div/p/p", 3, "two"), ("/div/p/p/br", 4, None), ("/img", 1, None)]


def test_augmentation_is_repeatable(spark, docs):
    many = spark.range(200).select(F.col("id"), F.concat(F.lit('<a x="'), F.col("id"), F.lit('"><b><c>1</c><d>2</d></b><e/></a>')).alias("xml"))
    a = sorted(rows(D.augment(many.repartition(1), "id", "xml")))
    b = sorted(rows(D.augment(many.repartition(13), "id", "xml")))
    assert a == b and 0 < len(a) < 600
    assert D.augment(docs.where("id > 1 and id < 4"), "id", "xml", 1.0).count() == 0


def test_scoring_keeps_every_document(docs):
    got = rows(D.score_documents(docs, "xml", F.col("leaf_ratio")).select("id", "status", "error_probability"), "id")
    assert got == [(1, "ok", 0.6), (2, "failed", None), (3, "failed", None), (4, "ok", 1.0)]


def test_variants_change_what_they_say(spark):
    text = '<a x="1"><b y="2">t<c/>u</b><d><e/><f/></d></a>'
    df = spark.createDataFrame([(i, text) for i in range(60)], "id int, xml string")
    made = rows(D.augment(df, "id", "xml", 0.9, keep_original=True))
    assert sum(v == "original" and x == text for _, v, x in made) == 60

    def tags(x):
        return sorted(e.tag for e in ET.fromstring(x).iter())

    for _, variant, x in made:
        if variant == "attributes":
            assert x.replace("_modified", "").replace(" /", "/") == text
        elif variant == "siblings":
            assert tags(x) == list("abcdef") and len(x.replace(" /", "/")) == len(text)
        elif variant == "hoist":
            assert set(tags(x)) <= set("abcdef")
    assert any(v == "hoist" and len(tags(x)) < 6 for _, v, x in made)
    # d is taken out: its children come last in the root; c, whose parent isn't picked, would go as well
    assert D._new_children("hoist", [[1, 3], [2], [], [4, 5], [], []], np.array([[0, .9, 0]] * 6), [0]) == {0: [1, 4, 5]}
    assert D._new_children("siblings", [[1, 2, 3], [], [], []], np.array([[0, 0, .9]] * 4), [0, 1]) == {0: [3, 2, 1]}
