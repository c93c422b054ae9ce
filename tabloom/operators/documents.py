"""Document structure: XML (strict) and HTML (tolerant) as data.

One vectorised parse turns a document into an array of elements; features,
paths, flags and texts are SQL over that array.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections import Counter
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# HTML elements that never have content.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)

ELEMENT = (
    "array<struct<pos:int,parent:int,tag:string,path:string,depth:int,text:string,"
    "attrs:map<string,string>,children:int>>"
)

FEATURES = (
    "unique_tags", "total_tags", "max_depth", "file_size", "tag_diversity", "avg_attributes",
    "top_tag_share", "avg_text_length", "total_attributes", "tag_density", "depth_variance",
    "attr_length_variance", "sibling_mean", "sibling_variance", "path_diversity", "empty_ratio",
    "leaf_ratio", "repeated_tag_ratio", "attr_name_ratio", "numeric_ratio",
)


# positions inside an element record while parsing
_PARENT, _TAG, _PATH, _DEPTH, _TEXT, _ATTRS, _KIDS = range(7)


def _xml_elements(text: str) -> list[list] | None:
    try:
        root = ET.fromstring(text)
    except ET.ParseError:
        return None
    out: list[list] = []
    stack = [(root, -1, "", 1)]
    while stack:
        e, parent, path, depth = stack.pop()
        here = f"{path}/{e.tag}"
        pos = len(out)
        out.append([parent, e.tag, here, depth, e.text, e.attrib, len(e)])
        stack.extend((c, pos, here, depth + 1) for c in reversed(e))
    return out


class _Tolerant(HTMLParser):
    """Unclosed elements end with their parent; stray end tags are ignored."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[list] = []
        self.open: list[int] = []

    def handle_starttag(self, tag, attrs):
        parent, path = -1, ""
        if self.open:
            parent = self.open[-1]
            path = self.out[parent][_PATH]
            self.out[parent][_KIDS] += 1
        self.out.append([parent, tag, f"{path}/{tag}", len(self.open) + 1, None, {k: v or "" for k, v in attrs}, 0])
        if tag not in VOID_TAGS:
            self.open.append(len(self.out) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.open.pop()

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.out[self.open[i]][_TAG] == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        if self.open:
            e = self.out[self.open[-1]]
            if e[_KIDS] == 0:
                e[_TEXT] = (e[_TEXT] or "") + data


def _html_elements(text: str) -> list[list]:
    parser = _Tolerant()
    parser.feed(text)
    parser.close()
    return parser.out


def elements(content: Column, tolerant: bool = False) -> Column:
    """Array of elements in document order; null when strict parsing fails."""
    parse = _html_elements if tolerant else _xml_elements

    @F.arrow_udf(ELEMENT)
    def run(docs: pa.Array) -> pa.Array:
        flat: list[list] = []
        pos: list[int] = []
        starts: list[int | None] = []
        for text in docs.to_pylist():
            found = None if text is None else parse(text)
            starts.append(None if found is None else len(flat))
            if found:
                pos.extend(range(len(found)))
                flat.extend(found)
        ends = pa.array([*starts, len(flat)], pa.int32())
        attr_at, names, values = [0], [], []
        for e in flat:
            names.extend(e[_ATTRS])
            values.extend(e[_ATTRS].values())
            attr_at.append(len(names))

        def column(i: int, kind: pa.DataType) -> pa.Array:
            return pa.array([e[i] for e in flat], kind)

        parts = {
            "pos": pa.array(pos, pa.int32()), "parent": column(_PARENT, pa.int32()), "tag": column(_TAG, pa.string()),
            "path": column(_PATH, pa.string()), "depth": column(_DEPTH, pa.int32()), "text": column(_TEXT, pa.string()),
            "attrs": pa.MapArray.from_arrays(
                pa.array(attr_at, pa.int32()), pa.array(names, pa.string()), pa.array(values, pa.string())),
            "children": column(_KIDS, pa.int32()),
        }
        return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(list(parts.values()), list(parts)))

    return run(content)


# possessive throughout, so nothing is tried twice
_NAME = r"[\p{L}_:][^\s<>/='\"]*+"
_PAIR = r"""[^\s<>/='"]++\s*+=\s*+(?:"[^"<]*+"|'[^'<]*+')"""
_START = rf"<{_NAME}(?:\s++{_PAIR})*+\s*+/?>"
_LEAF = rf"<({_NAME})(?:\s++{_PAIR})*+\s*+(?:/>|>[^<]*+</\1\s*+>)"
_CDATA = r"<!\[CDATA\[(?:[^\]]|\](?!\]>))*+\]\]>"
_ASIDE = r"<!--(?:[^-]|-(?!-))*+-->|<\?(?:[^?]|\?(?!>))*+\?>|<!DOCTYPE[^>\[]*+(?:\[[^\]]*+\])?\s*+>"
_BARE = "&(?!(?:lt|gt|amp|quot|apos|#[0-9]+|#x[0-9a-fA-F]+);)"
_DONE = "\x01"  # no XML text may hold it


def basic_structure(content: Column) -> Column:
    """struct(total_tags, max_depth, total_attributes); null on parse failure.

    Tags exclude the root and the root has depth 0; attributes include the
    root's.  JVM-side: every element without elements inside becomes one mark, again
    and again; a text is well formed if one mark is left, and the rounds it took are
    its depth, so the work is a text's length times its depth.
    """
    plain = F.regexp_replace(F.regexp_replace(content, f"({_CDATA})|{_ASIDE}", "$1"), _CDATA, "x")
    starts = F.regexp_extract_all(plain, F.lit(_START), F.lit(0))
    names = lambda tag: F.regexp_extract_all(tag, F.lit(r"""([^\s<>/='"]++)\s*+=\s*+(?:"[^"]*+"|'[^']*+')"""), F.lit(1))
    twice = F.exists(starts, lambda t: F.size(F.array_distinct(names(t))) < F.size(names(t)))

    def state(text: Column, depth: Column, before: Column) -> Column:
        return F.struct(text.alias("text"), depth.alias("depth"), before.alias("before"))

    def round_of(s: Column, _: Column) -> Column:
        # a round that marked nothing is the last one
        open_ = F.contains(s["text"], F.lit("<")) & (F.length(s["text"]) < s["before"])
        return F.when(open_, state(F.regexp_replace(s["text"], _LEAF, _DONE), s["depth"] + 1, F.length(s["text"]))).otherwise(s)

    rounds = F.sequence(F.lit(1), F.size(starts) + 1)
    left = F.aggregate(rounds, state(plain, F.lit(0), F.length(plain) + 1), round_of)
    ok = (F.trim(F.regexp_replace(left["text"], r"\s++", " ")) == _DONE) & ~plain.rlike(_BARE) & ~content.contains(_DONE) & ~twice
    found = F.struct(
        (F.size(starts) - 1).alias("total_tags"), (left["depth"] - 1).alias("max_depth"),
        F.size(F.regexp_extract_all(F.array_join(starts, ""), F.lit(_PAIR), F.lit(0))).alias("total_attributes"))
    return F.when(content.isNotNull() & ok, found)


def tag_names(content: Column) -> Column:
    """Opening tags by pattern, lower case: JVM-side and tolerant."""
    return F.transform(F.regexp_extract_all(content, F.lit("<([a-zA-Z][a-zA-Z0-9]*)"), F.lit(1)), lambda t: F.lower(t))


def attribute_count(content: Column) -> Column:
    return F.size(F.regexp_extract_all(content, F.lit(r'[a-zA-Z-]+="[^"]*"'), F.lit(0)))


def _share(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _variance(total: Column, squares: Column, n: Column) -> Column:
    m = _share(total, n)
    return F.greatest(_share(squares, n) - m * m, F.lit(0.0))


# what the features of a document are made of, element lists never leave the parse
_COUNTED = ("tags", "unique", "most", "repeated", "deepest", "d1", "d2", "k1", "k2", "k3", "leaves", "inner", "texts", "text_chars",
            "numeric", "vals", "v1", "v2", "names")
# digits alone, also before a final line end
_NUMBER = re.compile("[0-9]+(?:\r\n|[\n\r\u0085\u2028\u2029])?")


def _numbers(tags: list[str], kids: list[int], depths: tuple[int, int, int], inner: int, texts: list, pairs: list) -> tuple[int, ...]:
    """The numbers of _COUNTED, of lists over a document's elements."""
    unique, most, repeated = len(set(tags)), min(len(tags), 1), 0
    if unique < len(tags):
        counts = Counter(tags).values()
        most, repeated = max(counts), sum([c > 1 for c in counts])
    texts = [u for t in texts if t and (u := t.strip(" "))]
    lengths, parents = [len(v) for _, v in pairs], [k for k in kids if k]
    return (len(tags), unique, most, repeated, *depths, sum(parents), sum([k * k for k in parents]), sum([k * k * k for k in parents]),
            len(kids) - len(parents), inner, len(texts), sum(map(len, texts)), sum([_NUMBER.fullmatch(t) is not None for t in texts]),
            len(lengths), sum(lengths), sum([n * n for n in lengths]), len({n for n, _ in pairs}))


def _xml_counted(text: str) -> tuple[int, ...] | None:
    """Level by level, without the list of elements."""
    try:
        root = ET.fromstring(text)
    except ET.ParseError:
        return None
    nodes, inner, depth, d1, d2 = [], set(), 0, 0, 0
    level, above = [root], [""]
    while level:
        nodes += level
        depth += 1
        d1 += depth * len(level)
        d2 += depth * depth * len(level)
        below, paths = [], []
        for e, path in zip(level, above):
            if n := len(e):
                here = f"{path}/{e.tag}"
                inner.add(here)
                below += e
                paths += [here] * n
        level, above = below, paths
    return _numbers([e.tag for e in nodes], [len(e) for e in nodes], (depth, d1, d2), len(inner), [e.text for e in nodes],
                    [p for e in nodes for p in e.items()])


def _html_counted(text: str) -> tuple[int, ...]:
    found = _html_elements(text)
    depths = [e[_DEPTH] for e in found]
    return _numbers([e[_TAG] for e in found], [e[_KIDS] for e in found], (max(depths, default=0), sum(depths), sum([d * d for d in depths])),
                    len({e[_PATH] for e in found if e[_KIDS]}), [e[_TEXT] for e in found], [p for e in found for p in e[_ATTRS].items()])


def structure_counts(content: Column, tolerant: bool = False) -> Column:
    """struct of _COUNTED (long); null when strict parsing fails."""
    count = _html_counted if tolerant else _xml_counted

    @F.arrow_udf("struct<" + ",".join(f"{c}:long" for c in _COUNTED) + ">")
    def run(docs: pa.Array) -> pa.Array:
        known = [None if text is None else count(text) for text in docs.to_pylist()]
        rows = np.array([k or (0,) * len(_COUNTED) for k in known], np.int64).reshape(-1, len(_COUNTED))
        parts = [pa.array(np.ascontiguousarray(rows[:, i])) for i in range(len(_COUNTED))]
        return pa.StructArray.from_arrays(parts, list(_COUNTED), mask=pa.array([k is None for k in known], pa.bool_()))

    return run(content)


def structure_features(df: DataFrame, content: str, tolerant: bool = False) -> DataFrame:
    """The 20 structure features per document (null where unparsable).

    Siblings of an element are its parent's children, so their sum over all
    elements is the sum of squared child counts, and no element is looked up.
    """
    size = F.octet_length(content)
    e = {c: F.col("_e")[c] for c in _COUNTED}
    n = e["tags"]
    features = {
        "unique_tags": e["unique"],
        "total_tags": n,
        "max_depth": e["deepest"],
        "file_size": size,
        "tag_diversity": _share(e["unique"], n),
        "avg_attributes": _share(e["vals"], n),
        "top_tag_share": _share(e["most"], n),
        "avg_text_length": _share(e["text_chars"], e["texts"]),
        "total_attributes": e["vals"],
        "tag_density": _share(n, size),
        "depth_variance": _variance(e["d1"], e["d2"], n),
        "attr_length_variance": _variance(e["v1"], e["v2"], e["vals"]),
        "sibling_mean": _share(e["k2"], e["k1"]),
        "sibling_variance": _variance(e["k2"], e["k3"], e["k1"]),
        # ancestor paths: those of the inner elements, and the empty one of the root
        "path_diversity": _share(e["inner"] + 1, n),
        "empty_ratio": _share(n - e["texts"], n),
        "leaf_ratio": _share(e["leaves"], n),
        "repeated_tag_ratio": _share(e["repeated"], e["unique"]),
        "attr_name_ratio": _share(e["names"], n),
        "numeric_ratio": _share(e["numeric"], n),
    }
    out = df.withColumn("_e", structure_counts(F.col(content), tolerant))
    return out.withColumns({k: F.when(F.col("_e").isNotNull(), v.cast("double")) for k, v in features.items()}).drop("_e")


def key_element(els: Column, tags: Sequence[str] = ("CRD", "CRDID")) -> Column:
    """Text of the first key element: direct children by tag order first, then
    anywhere in the document; trimmed, empty text does not count."""

    def first(tag: str, direct: bool) -> Column:
        hit = F.filter(els, lambda e: (e["tag"] == tag) & ((e["depth"] == 2) if direct else (e["depth"] >= 2)))
        return F.nullif(F.trim(F.get(hit, F.lit(0))["text"]), F.lit(""))

    return F.coalesce(*[first(t, True) for t in tags], *[first(t, False) for t in tags])


def element_rows(df: DataFrame, doc: str, content: str, tolerant: bool = False) -> DataFrame:
    """One row per element: (doc, pos, parent, tag, path, depth, text, attrs)."""
    return (
        df.select(doc, F.explode(elements(F.col(content), tolerant)).alias("e")).select(doc, "e.*")
    )


def common_tags(df: DataFrame, doc: str, tags: str, share: float = 0.8) -> DataFrame:
    """Tags found in at least ``share`` of all documents (unparsable ones count)."""
    total = df.agg(F.count("*")).scalar()
    seen = df.select(doc, F.explode(F.array_distinct(tags)).alias("tag")).groupBy("tag").agg(
        F.count("*").alias("n_docs")
    )
    return seen.where(F.col("n_docs") >= F.lit(share) * total)


def tag_flags(df: DataFrame, paths: str, tags: Sequence[str]) -> DataFrame:
    """0/1 per tag: the tag is a substring of any path."""
    def found(tag: str) -> Column:
        return F.exists(paths, lambda p: F.contains(p, F.lit(tag))).cast("int")

    return df.withColumns({f"has_tag_{t}": found(t) for t in tags})


def breadcrumb_text(df: DataFrame, doc: str, content: str, tolerant: bool = False) -> DataFrame:
    """(doc, text): leaf values grouped under their parent's lineage,
    ``[a > b] attributes: c is 1, d is 2.`` Empty leaves are left out."""
    rows = element_rows(df, doc, content, tolerant)
    leaf = rows.where((F.col("children") == 0) & (F.trim(F.coalesce("text", F.lit(""))) != "") & (F.col("parent") >= 0))
    lineage = F.array_join(F.filter(F.split(F.regexp_replace("path", "/[^/]*$", ""), "/"), lambda p: p != ""), " > ")
    item = F.struct("pos", F.concat("tag", F.lit(" is "), F.trim("text")).alias("t"))
    lines = leaf.withColumn("lineage", lineage).groupBy(doc, "parent", "lineage").agg(
        F.sort_array(F.collect_list(item)).alias("items")
    )
    line = F.concat(
        F.lit("["), "lineage", F.lit("] attributes: "), F.array_join(F.transform("items", lambda i: i["t"]), ", "),
        F.lit("."),
    )
    per = lines.select(doc, F.struct("parent", line.alias("t")).alias("l"))
    return per.groupBy(doc).agg(F.sort_array(F.collect_list("l")).alias("ls")).select(
        doc, F.array_join(F.transform("ls", lambda x: x["t"]), " ").alias("text")
    )


# -- augmentation -------------------------------------------------------------


# what a variant changes; every element has three draws: whether it changes, and up to two picks
VARIANTS = ("attributes", "siblings", "hoist")


def _pick(items: list, draw: float):
    return items[int(draw * len(items))]


def _new_children(variant: str, children: list[list[int]], draws: np.ndarray, chosen: list[int]) -> dict[int, list[int]]:
    """The child lists that change, by element number; all picks are made on the tree as given."""
    if variant == "siblings":
        out = {}
        for i in chosen:
            if len(children[i]) > 1:
                first = _pick(children[i], draws[i, 1])
                other = _pick([c for c in children[i] if c != first], draws[i, 2])
                traded = {first: other, other: first}
                out[i] = [traded.get(c, c) for c in children[i]]
        return out
    # an element taken out leaves its children at the end of its parent; one whose parent is picked too stays
    picked = {_pick(children[i], draws[i, 1]): i for i in chosen if children[i]}
    return {i: [c for c in children[i] if c != gone] + children[gone] for gone, i in picked.items() if i not in picked}


def _variant(text: str, variant: str, draws: np.random.Generator, probability: float) -> str:
    nodes = list(ET.fromstring(text).iter())
    number = {node: i for i, node in enumerate(nodes)}
    table = draws.random((len(nodes), 3))
    chosen = np.flatnonzero(table[:, 0] < probability).tolist()
    if variant == "attributes":
        for node, draw in [(nodes[i], table[i, 1]) for i in chosen if nodes[i].attrib]:
            name = _pick(sorted(node.attrib), draw)
            node.attrib[name] += "_modified"
    else:
        children = [[number[c] for c in node] for node in nodes]
        for i, order in _new_children(variant, children, table, chosen).items():
            nodes[i][:] = [nodes[c] for c in order]
    return ET.tostring(nodes[0], encoding="unicode")


def augment(df: DataFrame, doc: str, content: str, probability: float = 0.3, keep_original: bool = False) -> DataFrame:
    """(doc, variant, content): up to three altered copies per document, each
    made with the given probability, and with ``keep_original`` the document
    itself.  Texts that don't parse have no copies.  The draws depend on the
    document and the variant alone, so a retried task makes the same copies."""
    seeded = df.select(doc, content, F.xxhash64(doc, content).alias("_seed"))
    schema = T.StructType([df.schema[doc], T.StructField("variant", T.StringType()), df.schema[content]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, text, seed in zip(pdf[doc], pdf[content], pdf["_seed"], strict=True):
                found = [(key, "original", text)] if keep_original and text is not None else []
                for i, name in enumerate(VARIANTS):
                    draws = np.random.default_rng([int(seed) & (2**63 - 1), i])
                    if text is None or draws.random() >= probability:
                        continue
                    try:
                        found.append((key, name, _variant(text, name, draws, probability)))
                    except ET.ParseError:
                        break
                rows.extend(found)
            yield pd.DataFrame(rows, columns=[doc, "variant", content])

    return seeded.mapInPandas(run, schema)


def score_documents(df: DataFrame, content: str, score: Column) -> DataFrame:
    """Every document yields a row: features, ``status`` and, where parsed,
    ``error_probability`` (an expression over the features)."""
    feats = structure_features(df, content)
    ok = F.col("total_tags").isNotNull()
    return feats.withColumn("status", F.when(ok, "ok").otherwise("failed")).withColumn(
        "error_probability", F.when(ok, score)
    )
