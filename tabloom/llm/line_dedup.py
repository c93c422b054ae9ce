"""Line deduplication by a distributed suffix array, in DataFrame functions alone.

Lines that occur once end every repeated run, so suffixes are taken over the
stretches of lines that occur again. Prefix doubling ranks, for each power of
two, the runs of so many lines; a rank is the place where the run first occurs,
which orders suffixes and names the earlier copy at once. The longest common
prefix intervals are then walked from long to short: a suffix that isn't the
first of its interval takes the interval's length and looks for more inside it,
the first one stays and stands for the interval among the shorter ones. What
each suffix ends with is the longest run of lines that also occurs earlier.
Where such a run holds enough words, its lines are deleted; the first copy stays.

Minima and counts combine before shuffles, and a rank that many places share is
dealt over as many salts as it needs.

Defined cases: a null text has no lines and stays null; an empty text is one
empty line; rows are ordered by id (null last), then text, so of repeated rows
the first stays whole; runs never cross documents; runs may overlap their
earlier copy; extra columns are kept; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabloom.llm.common import keyed, salted_join, stored

MIN_WORDS = 10  # a repeated run of fewer words stays

WORDS = r"[^ \t\n\x0B\f\r]+"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def repeated_stretches(rows: DataFrame) -> DataFrame:
    """(pos, row_key, line, rank, n, words, before, end) of each line that occurs more than once.

    ``pos`` numbers them in order of document and line, ``end`` is where their
    stretch of adjacent lines stops, ``before`` counts the words up to them.
    """
    content = F.col("content")
    lines = rows.filter("text is not null").select("row_key", F.posexplode(_lines(F.col("text"))).alias("line", "content"))
    # two seeds: 128 bits tell lines apart
    hashed = lines.select("row_key", "line", F.xxhash64(content).alias("h1"), F.xxhash64(F.lit(1), content).alias("h2"),
                          F.regexp_count(content, F.lit(WORDS)).alias("words"))
    counts = stored(hashed.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1"), "lines")
    again = salted_join(hashed, counts, ["h1", "h2"], "n", "row_key")
    dealt = again.repartitionByRange("row_key").sortWithinPartitions("row_key", "line").withColumn(
        "pos", F.monotonically_increasing_id())
    doc = Window.partitionBy("row_key").orderBy("line")
    dealt = dealt.withColumn("stretch", F.col("line") - F.row_number().over(doc))
    within = Window.partitionBy("row_key", "stretch").orderBy("line")
    placed = stored(dealt.withColumns({
        "before": F.sum("words").over(within) - F.col("words"),
        "end": F.max("pos").over(within.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) + 1}), "places")
    first = stored(placed.groupBy("h1", "h2").agg(F.min("pos").alias("rank"), F.count("*").alias("n")), "ranks")
    return stored(salted_join(placed.drop("n"), first, ["h1", "h2"], "n", "pos").select(
        "pos", "row_key", "line", "rank", "words", "before", "end"), "stretches")


def double_ranks(places: DataFrame) -> list[DataFrame]:
    """Level k: (pos, end, rank) of each place whose run of 2**k lines occurs again; rank is its first place."""
    levels = [places.select("pos", "end", "rank")]
    while True:
        step = 1 << (len(levels) - 1)
        here = levels[-1]
        second = here.select((F.col("pos") - step).alias("pos"), F.col("rank").alias("then"))
        pairs = stored(here.filter(F.col("pos") + 2 * step <= F.col("end")).join(second, "pos"), "pairs")
        ranks = stored(pairs.groupBy("rank", "then").agg(F.min("pos").alias("first"), F.count("*").alias("n"))
                       .filter("n > 1"), "ranks")
        if ranks.isEmpty():
            return levels
        found = salted_join(pairs, ranks, ["rank", "then"], "n", "pos")
        levels.append(stored(found.select("pos", "end", F.col("first").alias("rank")), "level"))


def earlier_runs(levels: list[DataFrame]) -> DataFrame:
    """(pos, length) of the longest run of lines at ``pos`` that also starts at an earlier place."""
    later = levels[0].filter("rank < pos").select("pos", "end", F.lit(0).alias("k"), "rank")
    for k in range(1, len(levels)):
        later = later.union(levels[k].filter("rank < pos").select("pos", "end", F.lit(k).alias("k"), "rank"))
    # where each suffix leaves the root: its longest doubled run that isn't the first of its kind
    start = stored(later.groupBy("pos").agg(F.max(F.struct("k", "rank", "end")).alias("s")).select(
        "pos", "s.end", "s.k", "s.rank"), "starts")
    state = None
    for k in range(len(levels) - 1, 0, -1):
        size = 1 << k
        enter = start.filter(F.col("k") == k)
        enter = enter.select("pos", "end", F.lit(size).alias("length"), F.col("rank").alias("interval"), F.lit(True).alias("asks"))
        heads = levels[k].join(enter.select("interval").distinct(), F.col("pos") == F.col("interval")).select(
            "pos", "end", F.lit(size).alias("length"), "interval", F.lit(False).alias("asks"))
        entered = enter.union(heads)
        state = _extend(entered if state is None else state.union(entered), levels[k - 1], size >> 1)
    short = start.filter("k = 0").select("pos", F.lit(1).alias("length"))
    if state is None:
        return short
    return short.union(state.filter("asks").select("pos", "length"))


def _extend(state: DataFrame, level: DataFrame, size: int) -> DataFrame:
    """One step down: members whose next ``size`` lines agree form a smaller interval; its first member stays."""
    ahead = level.select(F.col("pos").alias("at"), F.col("rank").alias("then"))
    looks = state.withColumn("at", F.when(F.col("pos") + F.col("length") < F.col("end"), F.col("pos") + F.col("length")))
    seen = stored(looks.join(ahead, "at", "left").drop("at"), "looks")
    key = ["length", "interval", "then"]
    inner = stored(seen.filter("then is not null").groupBy(*key).agg(
        F.min("pos").alias("first"), F.count("*").alias("n")).filter("n > 1"), "intervals")
    met = salted_join(seen, inner, key, "n", "pos", how="left")
    into = F.struct((F.col("length") + size).alias("length"), F.col("first").alias("interval"),
                    (F.col("asks") & (F.col("pos") > F.col("first"))).alias("asks"))
    stay = F.struct("length", "interval", "asks")
    moved = F.when(F.col("first").isNull(), F.array(stay)).when(
        F.col("pos") > F.col("first"), F.array(into)).otherwise(F.array(stay, into))
    return stored(met.select("pos", "end", F.explode(moved).alias("m")).select("pos", "end", "m.*"), "state")


def later_copies(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(row_key, line) of the lines inside runs of ``min_words`` words or more that also occur earlier."""
    places = repeated_stretches(rows)
    runs = earlier_runs(double_ranks(places))
    last = places.select((F.col("pos") + 1).alias("stop"), (F.col("before") + F.col("words")).alias("upto"))
    starts = places.join(runs, "pos").withColumn("stop", F.col("pos") + F.col("length")).join(last, "stop")
    long_runs = starts.filter(F.col("upto") - F.col("before") >= min_words).select("pos", "stop")
    doc = Window.partitionBy("row_key").orderBy("pos")
    reach = F.max("stop").over(doc.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return places.select("pos", "row_key", "line").join(long_runs, "pos", "left").withColumn(
        "reach", reach).filter("reach > pos").select("row_key", "line")


def _applied(docs: DataFrame, min_words: int) -> DataFrame:
    rows = keyed(docs)
    gone = later_copies(rows.select("row_key", "text"), min_words).groupBy("row_key").agg(F.collect_list("line").alias("gone"))
    lines = _lines(F.col("text"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    left = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    joined = rows.join(gone, "row_key", "left")
    return joined.withColumns({
        "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long"),
        "lines_removed": F.coalesce(F.size("gone"), F.lit(0)).cast("long"),
        "text": F.when(F.col("gone").isNull(), F.col("text")).otherwise(left)})


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, n_lines, lines_removed, text without later copies of repeated runs."""
    return _applied(docs.select("doc_id", "text"), min_words).select("doc_id", "n_lines", "lines_removed", "text")


def clean(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the shortened texts; documents of which nothing is left go."""
    out = _applied(docs, min_words).filter((F.col("lines_removed") == 0) | (F.col("lines_removed") < F.col("n_lines")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("lines_removed") > 0, F.length("text")).otherwise(
            F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
