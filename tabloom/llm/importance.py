"""Importance resampling towards a target distribution, by segment deduplication.

Documents and target texts are bags of hashed word runs (1 to ``longest`` words).
Separator newlines cut a text into lines, and lines repeat across a corpus: each
distinct line's features are hashed once, and its counts are multiplied by the
line's occurrences. Runs of words that cross a newline belong to no line; they are
taken from the whole text and added separately (with runs of one word there are
none). A bucket's gain is its log ratio of smoothed target and source shares; a
document weighs the sum over its features, gets a Gumbel draw that its id fixes,
and the highest scores are drawn: a sample without replacement by weight.

Lines travel as text once, map-side combined, to be counted; after that only
16-byte digests (128-bit MD5, by which lines are told apart), buckets and sums move.
A line that makes up a third of the corpus is one row after the combine, and the
join that takes its weight back to the documents deals it over salts. Ranks come
from pieces of the score order, not from one sorted task. The driver sees one
number per bucket, whose count is a parameter.

Defined cases: a null or empty text has no features, weight 0 and never 20 words;
ties in score go to the smaller id, then to the row first in order; repeated rows
count each and are drawn each; a null id hashes as an empty one; extra columns are
ignored; an empty source or target leaves smoothed shares and, without documents,
an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import keyed, own_columns, salted_join, stored
from tabloom.operators.ordered import positions

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what words don't hold, once A-Z are lower-cased
HAS_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
BUCKETS = 10_000
LONGEST = 1  # words in a feature
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
NO_BUCKETS = "array<int>"


def words_of(text: Column) -> Column:
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(lower, BREAKS), lambda w: w != "")


def _bucket(feature: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(feature), F.lit(buckets)).cast("int")


def _runs(words: str, n: int, starts: Column, buckets: int) -> Column:
    """Buckets of the runs of ``n`` words that begin at ``starts`` (from 0)."""
    # single places are read: slice() would copy the whole array for every run
    return F.transform(starts, lambda i: _bucket(F.concat_ws(" ", *[F.get(words, i + k) for k in range(n)]), buckets))


def _all_starts(words: str, n: int) -> Column:
    last = F.size(words) - n
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast(NO_BUCKETS))


def line_rows(rows: DataFrame) -> DataFrame:
    """(row_key, doc_id, place, line) of every line that holds a word."""
    cut = rows.select("row_key", "doc_id", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    return cut.filter(F.col("line").rlike(HAS_WORD))


def distinct_lines(lines: DataFrame, buckets: int, longest: int) -> DataFrame:
    """One stored row per distinct line: id, occurrences, n_words, its features' ``buckets``."""
    once = lines.groupBy("line").agg(F.count("*").alias("occurrences"))
    once = once.select(line_id("line"), "occurrences", words_of(F.col("line")).alias("words"))
    own = [F.transform("words", lambda w: _bucket(w, buckets))]
    own += [_runs("words", n, _all_starts("words", n), buckets) for n in range(2, longest + 1)]
    return stored(once.select("line_id", "occurrences", F.size("words").cast("long").alias("n_words"),
                              F.concat(*own).alias("buckets")), "lines")


def line_id(line: str) -> Column:
    return F.unhex(F.md5(line)).alias("line_id")


def crossing(rows: DataFrame, buckets: int, longest: int) -> DataFrame:
    """(row_key, doc_id, buckets): features that begin in one line of a text and end in a later one."""
    parts = rows.select("row_key", "doc_id", F.transform(F.split("text", "\n"), words_of).alias("lines"))
    parts = parts.select("row_key", "doc_id", F.flatten("lines").alias("words"), F.flatten(F.transform(
        "lines", lambda ws, k: F.array_repeat(k, F.size(ws)))).alias("of"))

    def over(n: int) -> Column:
        return F.filter(_all_starts("words", n), lambda i: F.get("of", i) != F.get("of", i + (n - 1)))

    found = [_runs("words", n, over(n), buckets) for n in range(2, longest + 1)]
    # stored: they are counted and weighed, and exploding them as they are made would make them anew for each
    return stored(parts.select("row_key", "doc_id", F.coalesce(F.concat(*found), F.array().cast(NO_BUCKETS)).alias("buckets")), "crossing")


def bucket_counts(lines: DataFrame, across: DataFrame | None) -> DataFrame:
    """(bucket, n) over the whole corpus: distinct lines times their occurrences, and crossing runs."""
    found = lines.select(F.explode("buckets").alias("bucket"), "occurrences")
    if across is not None:
        found = found.union(across.select(F.explode("buckets"), F.lit(1).cast("long")))
    return found.groupBy("bucket").agg(F.sum("occurrences").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> list[int]:
    """floor(1000 ln(target share / source share)) of each bucket, shares smoothed by one."""
    spark = source.sparkSession
    both = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(
        source.withColumnRenamed("n", "s"), "bucket", "left").join(
        target.withColumnRenamed("n", "t"), "bucket", "left").fillna(0, ["s", "t"])
    both = stored(both, "buckets")
    total = both.agg(F.sum("s").alias("S"), F.sum("t").alias("T")).head()
    up = (F.col("t") + 1).cast("double") * F.lit(float(total.S + buckets))
    down = (F.col("s") + 1).cast("double") * F.lit(float(total.T + buckets))
    rows = both.select("bucket", F.floor(F.lit(1000.0) * F.log(up / down)).alias("gain")).collect()
    return [gain for _, gain in sorted(rows)]


def _weight(values: list[int]) -> Column:
    table = F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")
    return F.aggregate("buckets", F.lit(0).cast("long"), lambda total, b: total + F.get(table, b))


def weigh(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(row_key, doc_id, n_words, n_features, weight) of every row of ``docs``, stored.

    ``target`` holds the texts (``text``) whose distribution is sought.
    """
    rows = keyed(own_columns(docs, {"doc_id": "doc_id", "text": "text"}))
    goal = own_columns(target, {"text": "text"}).select(F.lit(0).alias("row_key"), F.lit(0).alias("doc_id"), "text")
    lines, goal_lines = (distinct_lines(line_rows(x), buckets, longest) for x in (rows, goal))
    across, goal_across = (crossing(x, buckets, longest) if longest > 1 else None for x in (rows, goal))
    gain = gains(bucket_counts(lines, across), bucket_counts(goal_lines, goal_across), buckets)
    scored = lines.select("line_id", "occurrences", "n_words", F.size("buckets").cast("long").alias("n_features"),
                          _weight(gain).alias("weight"))
    links = line_rows(rows).select("row_key", "doc_id", F.xxhash64("row_key", "place").alias("spread"), line_id("line"))
    sums = ["n_words", "n_features", "weight"]
    zero = F.lit(0).cast("long")
    parts = salted_join(links, scored, ["line_id"], "occurrences", "spread").select("row_key", "doc_id", *sums)
    parts = parts.union(rows.select("row_key", "doc_id", zero, zero, zero))
    if across is not None:
        parts = parts.union(across.select("row_key", "doc_id", zero, F.size("buckets").cast("long"), _weight(gain)))
    return stored(parts.groupBy("row_key", "doc_id").agg(*[F.sum(c).alias(c) for c in sums]), "weights")


def gumbel(doc_id: str, seed: int) -> Column:
    """floor(1000 g) for a Gumbel draw g that the id fixes."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row; ``rank`` is null where the row isn't drawn."""
    scored = weigh(docs, target, buckets, longest).withColumns({
        "score": F.col("weight") + gumbel("doc_id", seed), "short": F.col("n_words") < least_words})
    drawn = percent * scored.filter(~F.col("short")).count() // 100
    ordered = positions(scored.withColumn("_down", -F.col("score")), ["short", "_down", "doc_id", "row_key"], "place")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1).cast("long")
    return ordered.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))
