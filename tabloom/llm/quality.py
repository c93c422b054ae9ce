"""Quality rules by distribution divergence, in DataFrame functions alone.

Base rules reject texts that are very short or repeat themselves. The others are
compared with their language: the shares of character classes and of the
language's common words, each gathered from all documents, by Jensen-Shannon
distance (base 2). Short texts are not compared, their shares say little. How far
words may lie apart depends on the language: a text without any of its common
words has the distance that their shares give, and a text is rejected from
WORD_SHARE of it on, if it is long enough to hold EXPECTED of them.

Defined cases: a null or empty text has no words and fails the base rules; a
null or rare language (under OWN_DOCUMENTS documents or OWN_WORDS words) is
compared with all documents together, as is one called ``*``; repeated rows
are judged alike; ties among common words go to the first in order; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import BLANKS, keyed, own_columns, stored
from tabloom.operators.joins import dimension_join
from tabloom.operators.ordered import top_per_group

WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
COMPARE_WORDS = 50  # shorter texts are not compared
CHAR_DISTANCE = 0.32
WORD_SHARE = 0.95  # of the distance that a text without any common word has
EXPECTED = 8  # common words that a text of its length should hold, at least, to be compared by them
COMMON_WORDS = 16
OWN_DOCUMENTS = 50  # a language has a reference of its own from so many documents
OWN_WORDS = 5_000  # and so many words on
FEW_ROWS = 1_000_000  # rejected rows up to this number are sent to the texts, more are joined with them
CLASSES = ("upper", "lower", "digit", "blank", "symbol", "other")

SPLIT = r"[ \t\n\x0B\f\r]+"
SOLID = r"[^ \t\n\x0B\f\r]"


def words_of(text: Column) -> Column:
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPLIT))


def repeat_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words inside windows of 8 words that occur again in ``words``."""
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    df = df.withColumn("hashes", hashes)
    spans = F.when(F.size("hashes") >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size("hashes") - (WINDOW - 1)),
        lambda i: F.xxhash64(*[F.get("hashes", i + (k - 1)) for k in range(WINDOW)])))
    df = df.withColumn("spans", F.coalesce(spans, F.array().cast("array<bigint>")))
    again = F.size(F.array_distinct("spans")) < F.size("spans")
    df = df.withColumn("sorted", F.when(again, F.sort_array(F.transform(
        "spans", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = F.filter("sorted", lambda e, k: (F.get("sorted", k - 1)["h"] == e["h"])
                     | F.coalesce(F.get("sorted", k + 1)["h"] == e["h"], F.lit(False)))
    starts = F.sort_array(F.transform(twice, lambda e: e["i"]))
    df = df.withColumn("starts", F.when(F.col("sorted").isNotNull(), starts))
    covered = F.aggregate(F.transform("starts", lambda x, k: F.when(k == 0, F.lit(WINDOW)).otherwise(
        F.least(F.lit(WINDOW), x - F.get("starts", k - 1)))), F.lit(0), lambda s, x: s + x)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop(
        "hashes", "spans", "sorted", "starts")


def _length_of(text: Column, pattern: str) -> Column:
    """Characters in matches of ``pattern``."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def measure(rows: DataFrame) -> DataFrame:
    """The base measures and the class counts of each row, stored without texts: they are counted once."""
    df = rows.withColumn("t", F.coalesce("text", F.lit(""))).withColumn("words", words_of(F.col("text")))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(SOLID))
    df = df.withColumns({
        "n_words": F.size("words").cast("long"), "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_chars_all": F.length("t").cast("long"), "lines": lines,
        "rest": F.regexp_replace("t", r"\p{L}+", ""), "upper": _length_of(F.col("t"), r"\p{Lu}+")})
    # what no letter is, is short: the other classes are counted there
    df = df.withColumns({"letters": (F.length("t") - F.length("rest")).cast("long"),
                         "n_symbols": _length_of(F.col("rest"), r"[#*$%&|<>]+"), "digit": _length_of(F.col("rest"), r"[0-9]+")})
    df = df.withColumns({"n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
                         "lower": F.col("letters") - F.col("upper"), "blank": F.col("n_chars_all") - F.col("word_chars"),
                         "symbol": F.col("n_symbols")})
    df = df.withColumn("other", F.col("word_chars") - F.col("letters") - F.col("digit") - F.col("symbol"))
    return stored(repeat_words(df).select("row_key", "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                          "n_repeat_words", "n_chars_all", *CLASSES), "measures")


def divergence(p: str, q: str) -> Column:
    """Jensen-Shannon distance, base 2, of two columns of shares."""
    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(a * 2 / (a + b))).otherwise(F.lit(0.0))

    total = F.aggregate(F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a)), F.lit(0.0), lambda s, x: s + x)
    return F.round(F.sqrt(F.greatest(total / 2, F.lit(0.0))), 6)


def shares(counts: Column, total: Column, rest: bool = False) -> Column:
    """Each count's share of ``total`` (0 of nothing), and with ``rest`` what is left."""
    found = F.transform(counts, lambda c: F.when(total > 0, c / total).otherwise(F.lit(0.0)))
    if not rest:
        return found
    left = F.greatest(F.lit(0.0), F.lit(1.0) - F.aggregate(found, F.lit(0.0), lambda s, x: s + x))
    return F.concat(found, F.array(left))


def references(rows: DataFrame, measured: DataFrame) -> DataFrame:
    """The stored references: a row of counts for each language that has its own (``key``), and for all ('*')."""
    known = F.when(F.col("lang") != "*", F.col("lang")).alias("lang")
    sums = measured.groupBy(known).agg(F.count("*").alias("docs"), F.sum("n_words").alias("n_words"),
                                       *[F.sum(c).alias(c) for c in CLASSES])
    words = rows.select(known, F.explode(words_of(F.col("text"))).alias("word"))
    counts = words.groupBy("lang", "word").agg(F.count("*").alias("n"))
    sums, counts = stored(sums, "class-sums"), stored(counts, "word-counts")
    large = (F.col("docs") >= OWN_DOCUMENTS) & (F.col("n_words") >= OWN_WORDS)
    own = sums.filter(F.col("lang").isNotNull() & large).drop("docs")
    totals = own.union(sums.select(F.lit("*").alias("lang"), "n_words", *CLASSES).groupBy("lang").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_words", *CLASSES)]))
    counts = counts.join(own.select("lang"), "lang", "left_semi").union(
        counts.groupBy("word").agg(F.sum("n").alias("n")).select(F.lit("*").alias("lang"), "word", "n"))
    first = top_per_group(counts, ["lang"], [F.desc("n"), F.col("word")], COMMON_WORDS)
    top = first.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "word"))).alias("top"))
    found = totals.join(top, "lang", "left").select(
        F.col("lang").alias("key"), F.col("n_words").alias("r_words"), *[F.col(c).alias(f"r_{c}") for c in CLASSES],
        F.transform("top.word", lambda w: w).alias("r_common"), F.transform("top.n", lambda n: -n).alias("r_counts"),
        F.array_max(F.transform("top.word", lambda w: F.octet_length(w))).alias("r_longest"))
    return stored(found, "references")


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the base measures, base_failed, the two distances, kept."""
    rows = keyed(own_columns(docs, {"doc_id": "doc_id", "lang": "lang", "text": "text"}))
    return _judged(rows).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                "base_failed", "kept", "char_distance", "word_distance")


def keep(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    rows = keyed(docs)
    verdicts = _judged(own_columns(rows, {"row_key": "row_key", "doc_id": "doc_id", "lang": "lang", "text": "text"}))
    verdicts = stored(verdicts.select("row_key", "kept"), "verdicts")
    gone = verdicts.filter(~F.col("kept")).select("row_key")
    few = gone if gone.count() > FEW_ROWS else F.broadcast(gone)
    return rows.join(few, "row_key", "left_anti").select(*docs.columns)


def _judged(rows: DataFrame) -> DataFrame:
    """``rows``: row_key (unique), doc_id, lang, text."""
    measured = measure(rows)
    reference = references(rows, measured)
    own_names = reference.filter("key <> '*'").select(F.col("key").alias("lang"), F.col("key").alias("own"))

    def keyed_by_language(df: DataFrame, columns: list[str]) -> DataFrame:
        # references are broadcast after a check of their size, else joined over salts
        keys = dimension_join(df, own_names, ["lang"], "left").withColumn("key", F.coalesce("own", F.lit("*")))
        return dimension_join(keys, reference.select("key", *columns), ["key"], "left")

    # a second look at the texts counts their languages' common words: places in the list first, then
    # one fold over the few found; lambdas get arrays as arguments, a captured one would be split anew for each use
    texts = keyed_by_language(rows.select("row_key", "lang", "text"), ["r_common", "r_longest"])
    short = F.filter(words_of(F.col("text")), lambda w: F.octet_length(w) <= F.col("r_longest"))
    places = F.filter(F.transform(short, lambda w: F.array_position("r_common", w)), lambda p: p > 0)
    none_yet = F.transform("r_common", lambda c: F.lit(0).cast("long"))
    here = F.aggregate(places, none_yet, lambda found, p: F.transform(
        found, lambda n, i: n + F.when(i + 1 == p, F.lit(1)).otherwise(F.lit(0))))
    df = keyed_by_language(measured, ["r_words", "r_counts", *[f"r_{c}" for c in CLASSES]]).join(
        texts.select("row_key", here.alias("here")), "row_key", "left")
    df = df.withColumns({
        "p_chars": shares(F.array(*CLASSES), F.col("n_chars_all")),
        "q_chars": shares(F.array(*[f"r_{c}" for c in CLASSES]), reduce(add, [F.col(f"r_{c}") for c in CLASSES]))})
    none = F.array().cast("array<bigint>")
    df = df.withColumns({"p_words": shares(F.coalesce("here", none), F.col("n_words"), rest=True),
                         "q_words": shares(F.coalesce("r_counts", none), F.col("r_words"), rest=True)})
    df = df.withColumn("p_none", F.transform("q_words", lambda q, i: (i == F.size("q_words") - 1).cast("double")))
    df = df.withColumns({"char_distance": divergence("p_chars", "q_chars"), "word_distance": divergence("p_words", "q_words"),
                         "no_words": divergence("p_none", "q_words")})
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    common = F.aggregate(F.coalesce("r_counts", none), F.lit(0).cast("long"), lambda total, n: total + n)
    enough = F.col("n_words") * common >= EXPECTED * F.col("r_words")
    strange = (F.col("n_words") >= COMPARE_WORDS) & (
        (F.col("char_distance") > CHAR_DISTANCE) | (enough & (F.col("word_distance") > WORD_SHARE * F.col("no_words"))))
    return df.withColumn("base_failed", failed).withColumn("kept", ~failed & ~strange)
