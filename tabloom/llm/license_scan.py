"""Licence scans by sparse TF-IDF cosine and directory inheritance, in DataFrame functions alone.

Every line of a file is a possible licence header. Lines and licence templates
are sparse vectors of term counts times inverse document frequency, which all
documents together give. Scored are whole lines and their windows of a template's
number of terms, and of these only such as hold terms that carry enough of the
template's length to reach the threshold. A line scores as its best window, a file
takes the licence of its best line.

Whole files are compared with the full texts of licences in the same way, by
vectors whose counts are damped (1 + log); only files that hold enough of a
text's terms are weighed. Files that reach FILE_THRESHOLD of a full text, or of
which the matching lines make up most, are licence files: they hold for their
directory. A full text decides before a line. A file without a header takes the licence of the nearest
directory above it that has a licence file, found by joining directories with
their ancestors.

Defined cases: a null or empty text has no header; null parts of a path are
empty; ties of lines go to the first line and then the licence's name, ties of
licence files of a directory to the first path; repeated rows are scanned alike;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import keyed, own_columns, salted_join, stored

THRESHOLD = 0.6
FILE_SHARE = 0.5  # matching lines make up this share of a licence file's terms, at least
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
FILE_THRESHOLD = 0.8  # cosine of a file to a full text; a short notice with code of its own stays below
FULL_TEXTS = Path(__file__).parent / "licenses"  # public texts, named by licence

# fixed values: statements by which public licences are given
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved. No part may be copied or redistributed without permission."),
)


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"))


def directory_of(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def template_terms(spark) -> DataFrame:
    """(template, license, term, count), a bounded table."""
    names = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(TEMPLATES)], "template int, license string, text string")
    return names.select("template", "license", F.explode(terms_of(F.col("text"))).alias("term")).groupBy(
        "template", "license", "term").agg(F.count("*").alias("times"))


def full_terms(spark) -> DataFrame:
    """(license, term, times) of the full texts, a bounded table that ships with this module."""
    texts = [(f.stem, f.read_text(encoding="utf-8")) for f in sorted(FULL_TEXTS.glob("*.txt"))]
    found = spark.createDataFrame(texts, "license string, text string").select(
        "license", F.explode(terms_of(F.col("text"))).alias("term"))
    return found.groupBy("license", "term").agg(F.count("*").alias("times"))


def held_terms(rows: DataFrame, *tables: DataFrame) -> DataFrame:
    """(row_key, term): the terms of ``tables`` that each document holds, once each."""
    known = sorted({r["term"] for t in tables for r in t.select("term").distinct().collect()})
    return rows.select("row_key", F.explode(F.array_intersect(
        terms_of(F.col("text")), F.array(*map(F.lit, known)))).alias("term"))


def idf(df: Column, total: int) -> Column:
    return F.log((F.lit(total) + 1) / (df + 1)) + 1


def term_weights(terms: DataFrame, held: DataFrame, total: int) -> DataFrame:
    """(term, idf) of the templates' terms over all documents."""
    docs = held.groupBy("term").agg(F.count("*").alias("df"))
    return terms.select("term").distinct().join(F.broadcast(docs), "term", "left").select(
        "term", idf(F.coalesce("df", F.lit(0)), total).alias("idf"))


def with_found(rows: DataFrame, weights: DataFrame, total: int, *counted: DataFrame) -> DataFrame:
    """``weights`` and those of the other terms that ``counted`` hold, by one count over all documents.

    Tasks add up their own terms before anything is moved, so a common term is a row of each.
    """
    wanted = counted[0].select("term")
    for c in counted[1:]:
        wanted = wanted.union(c.select("term"))
    wanted = stored(wanted.distinct().join(F.broadcast(weights), "term", "left_anti"), "wanted")
    if not wanted.take(1):
        return weights
    docs = rows.select(F.explode(F.array_distinct(terms_of(F.col("text")))).alias("term")).groupBy("term").agg(
        F.count("*").alias("df"))
    return weights.union(docs.join(wanted, "term").select("term", idf(F.col("df"), total).alias("idf")))


def damped(times: str) -> Column:
    return F.log(F.col(times)) + 1


def near_files(rows: DataFrame, texts: DataFrame, held: DataFrame, weights: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vectors of the full texts, term counts of the files that may reach FILE_THRESHOLD)."""
    vectors = texts.join(F.broadcast(weights), "term").withColumn("w", damped("times") * F.col("idf"))
    norms = vectors.groupBy("license").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("t_norm"))
    vectors = stored(vectors.join(F.broadcast(norms), "license").select("license", "term", "w", "t_norm"), "full-vectors")
    # a cosine is at most the share of the text's length that the terms of both make up
    share = F.col("w") * F.col("w") / (F.col("t_norm") * F.col("t_norm"))
    near = held.join(F.broadcast(vectors.select("license", "term", share.alias("share"))), "term").groupBy(
        "row_key", "license").agg(F.sum("share").alias("share"))
    near = stored(near.filter(F.col("share") >= FILE_THRESHOLD * FILE_THRESHOLD - 1e-9).select("row_key").distinct(), "near")
    counted = rows.join(near, "row_key").select("row_key", F.explode(terms_of(F.col("text"))).alias("term")).groupBy(
        "row_key", "term").agg(F.count("*").alias("times"))
    return vectors, stored(counted, "near-terms")


def file_scores(vectors: DataFrame, counted: DataFrame, weights: DataFrame) -> DataFrame:
    """(row_key, file_license, file_score) of the files that reach FILE_THRESHOLD, by their best full text."""
    weighed = stored(counted.join(weights, "term").select(
        "row_key", "term", (damped("times") * F.col("idf")).alias("x")), "files")
    norm = weighed.groupBy("row_key").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = weighed.join(F.broadcast(vectors), "term").groupBy("row_key", "license", "t_norm").agg(
        F.sum(F.col("x") * F.col("w")).alias("dot"))
    scored = dots.join(norm, "row_key").withColumn("score", F.round(F.col("dot") / F.col("norm") / F.col("t_norm"), 6))
    best = F.min(F.struct((-F.col("score")).alias("s"), "license"))
    return scored.filter(F.col("score") >= FILE_THRESHOLD).groupBy("row_key").agg(best.alias("b")).select(
        "row_key", F.col("b.license").alias("file_license"), (-F.col("b.s")).alias("file_score"))


def near_windows(rows: DataFrame, terms: DataFrame, weights: DataFrame,
                 threshold: float) -> tuple[DataFrame, DataFrame]:
    """(vectors of the templates, term counts of the lines and windows that may reach the threshold)."""
    vectors = terms.join(F.broadcast(weights), "term").withColumn("w", F.col("times") * F.col("idf"))
    norms = vectors.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("t_norm"),
                                            F.sum("times").cast("int").alias("t_terms"))
    vectors = stored(vectors.join(F.broadcast(norms), "template").select(
        "template", "license", "term", "w", "t_norm", "t_terms"), "vectors")

    # the rarest terms of a template that leave too little of it for a match without them
    by_template: dict[int, list] = {}
    for v in vectors.collect():
        by_template.setdefault(v["template"], []).append(v)
    keys: dict[int, list[str]] = {}
    for template, found in by_template.items():
        found.sort(key=lambda v: (-v["w"], v["term"]))
        left = 1.0
        for v in found:
            if left < threshold * threshold:
                break
            keys.setdefault(template, []).append(v["term"])
            left -= (v["w"] / v["t_norm"]) ** 2

    def literal(names: list[str]) -> Column:
        return F.array(*map(F.lit, sorted(names)))

    def windows(template: int, found: list) -> Column:
        """Starts and lengths of what may match: a cosine is at most the share that the terms of both make up."""
        size, own = found[0]["t_terms"], literal([v["term"] for v in found])
        shares = F.create_map(*[F.lit(x) for v in found for x in (v["term"], (v["w"] / v["t_norm"]) ** 2)])

        def near(part: Column) -> Column:
            return F.aggregate(F.array_intersect(part, own), F.lit(0.0),
                               lambda total, t: total + F.element_at(shares, t)) >= threshold * threshold - 1e-9

        inside = F.filter(F.sequence(F.lit(1), F.size("terms")),
                          lambda i: F.array_contains(own, F.get("terms", i - 1)) & near(F.slice("terms", i, size)))
        parts = F.concat(F.array(F.lit(0)), F.when(F.size("terms") > size, inside).otherwise(F.array().cast("array<int>")))
        held = F.transform(parts, lambda i: F.struct(
            F.lit(template).alias("template"), i.alias("start"),
            F.when(i == 0, F.col("terms")).otherwise(F.slice("terms", i, size)).alias("window")))
        # a line that holds too little has no window that holds enough
        return F.when(F.arrays_overlap("terms", literal(keys[template])) & near(F.col("terms")), held)

    lines = rows.select("row_key", F.posexplode(F.split("text", "\n")).alias("line", "content"))
    lines = lines.select("row_key", "line", terms_of(F.col("content")).alias("terms")).filter(
        F.arrays_overlap("terms", literal(list({k for found in keys.values() for k in found}))))
    tried = F.filter(F.array(*[windows(t, found) for t, found in sorted(by_template.items())]), lambda w: w.isNotNull())
    spans = lines.select("row_key", "line", F.explode(F.flatten(tried)).alias("s")).select(
        "row_key", "line", "s.template", "s.start", F.size("s.window").alias("n_terms"), F.explode("s.window").alias("term"))
    return vectors, stored(spans.groupBy("row_key", "line", "template", "start", "n_terms", "term").agg(
        F.count("*").alias("times")), "near-windows")


def header_scores(vectors: DataFrame, counted: DataFrame, weights: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(row_key, line, n_terms, license, score) of the lines that reach the threshold, by their best window and template."""
    weighed = counted.join(weights, "term").withColumn("x", F.col("times") * F.col("idf"))
    both = weighed.join(F.broadcast(vectors.select("template", "term", "w")), ["template", "term"], "left")
    about = vectors.select("template", "license", "t_norm").distinct()
    scored = both.groupBy("row_key", "line", "template", "start", "n_terms").agg(
        F.sum(F.col("x") * F.col("w")).alias("dot"), F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm")).join(
        F.broadcast(about), "template").withColumn("score", F.round(F.col("dot") / F.col("norm") / F.col("t_norm"), 6))
    best = F.min(F.struct((-F.col("score")).alias("s"), "license", "start", "n_terms"))
    return scored.filter(F.col("score") >= threshold).groupBy("row_key", "line").agg(best.alias("b")).select(
        "row_key", "line", "b.n_terms", "b.license", (-F.col("b.s")).alias("score"))


def inherited(dirs: DataFrame, licensed: DataFrame) -> DataFrame:
    """(dir, license, license_dir) of each of ``dirs`` (dir) below, or equal to, a directory of ``licensed`` (dir, license)."""
    parts = F.when(F.col("dir") == "", F.array().cast("array<string>")).otherwise(F.split("dir", "/"))
    above = F.transform(F.sequence(F.lit(0), F.size(parts)),
                        lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    tried = dirs.select("dir", F.posexplode(above).alias("level", "up"))
    found = tried.join(licensed.withColumnRenamed("dir", "up"), "up")
    return found.groupBy("dir").agg(F.max(F.struct("level", "license", F.col("up").alias("license_dir"))).alias("n")).select(
        "dir", "n.license", "n.license_dir")


def scan(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per file of ``files`` (doc_id, path, text): doc_id, path, header_license, header_score, header_line,
    is_license_file, license and the directory that it was inherited from (null where the file's own text or header decides)."""
    rows = keyed(own_columns(files, {"doc_id": "doc_id", "path": "path", "text": "text"}))
    rows = rows.withColumn("path", F.coalesce("path", F.lit("")))
    bare = rows.select("row_key", "text")
    terms, texts = (stored(t, "template-terms") for t in (template_terms(files.sparkSession), full_terms(files.sparkSession)))
    held = stored(held_terms(bare, terms, texts), "held")
    total = rows.count()
    weights = stored(term_weights(terms.select("term").union(texts.select("term")), held, total), "weights")
    line_vectors, line_terms = near_windows(bare, terms, weights, threshold)
    file_vectors, file_terms = near_files(bare, texts, held, weights)
    weights = stored(with_found(bare, weights, total, line_terms, file_terms), "all-weights")
    lines = stored(header_scores(line_vectors, line_terms, weights, threshold), "headers")
    wholes = stored(file_scores(file_vectors, file_terms, weights), "wholes")
    best = F.min(F.struct((-F.col("score")).alias("s"), "line", "license"))
    heads = lines.groupBy("row_key").agg(best.alias("b"), F.sum("n_terms").alias("matched"))
    sizes = rows.select("row_key", "doc_id", "path", directory_of(F.col("path")).alias("dir"),
                        F.size(terms_of(F.coalesce("text", F.lit("")))).alias("n_all"))
    met = stored(sizes.join(heads, "row_key", "left").join(wholes, "row_key", "left").select(
        "doc_id", "path", "dir", "row_key", F.col("b.license").alias("header_license"),
        (-F.col("b.s")).alias("header_score"), F.col("b.line").alias("header_line"),
        (F.col("file_license").isNotNull() | F.coalesce(
            F.col("matched") >= FILE_SHARE * F.col("n_all"), F.lit(False))).alias("is_license_file"),
        F.coalesce("file_license", "b.license").alias("own"), F.coalesce("file_score", -F.col("b.s")).alias("own_score")), "met")
    licensed = met.filter("is_license_file").groupBy("dir").agg(F.min(F.struct(
        (-F.col("own_score")).alias("s"), "path", "own")).alias("b")).select("dir", F.col("b.own").alias("license"))
    dirs = stored(met.groupBy("dir").agg(F.count("*").alias("files")), "dirs")
    above = stored(dirs.join(inherited(dirs.select("dir"), licensed), "dir", "left"), "above")
    out = salted_join(met, above, ["dir"], "files", "row_key")
    return out.select("doc_id", "path", "header_license", "header_score", F.col("header_line").cast("long").alias("header_line"),
                      "is_license_file", F.coalesce("own", "license").alias("license"),
                      F.when(F.col("own").isNull(), F.col("license_dir")).alias("license_dir"))
