"""Delimited files as they arrive: own headers, second headers, broken lines.

All files of a load are read in one job as lines with their file and their place in
it (hidden file metadata), and staged once. A file's header is its first line, or
with ``header_rows`` = 2 the second one; one small row per file names its columns,
mapped to the wanted ones. Each line then finds its values by its own file's header,
so files may order and spell columns differently. Lines that don't fit their header,
have open quotes or hold unreadable values go to quarantine with file, place, text and
reason; nothing is dropped silently, and nothing is guessed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators.joins import dimension_join
from tabloom.session import scratch_path
from tabloom.sources.writers import replace_slice

STAGED = "file string, block bigint, at bigint, line string"
REASONS = ("no such columns", "open quote", "too few values", "too many values", "unreadable value")


def stage_lines(spark: SparkSession, path: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """(file, block, at, line) of every line, stored: ``block`` is where its split of the file begins,
    ``at`` counts lines in the order of the split."""
    reader = spark.read.option("recursiveFileLookup", True)
    lines = (reader.option("pathGlobFilter", glob) if glob else reader).text(path if isinstance(path, str) else list(path))
    staged = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                          F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    where = scratch_path(spark, "lines")
    staged.write.parquet(where)
    return spark.read.schema(STAGED).parquet(where)


def values_of(line: Column, sep: str = ",") -> Column:
    """The values of a delimited line; quoted ones may hold separators and doubled quotes. Trimmed, empty is null."""
    s = "\\" + sep if not sep.isalnum() else sep
    quoted = r' *+"(?:[^"]|"")*+" *+'
    parts = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(f"{s}({quoted}(?={s}|$)|[^{s}]*+)"), F.lit(1))

    def plain(v: Column) -> Column:
        t = F.trim(v)
        inner = F.replace(t.substr(F.lit(2), F.length(t) - 2), F.lit('""'), F.lit('"'))
        return F.nullif(F.when(t.rlike('^".*"$'), inner).otherwise(t), F.lit(""))

    return F.transform(parts, plain)


def open_quote(line: Column) -> Column:
    return F.length(F.regexp_replace(line, '[^"]', "")) % 2 == 1


def basic_names(values: Column) -> Column:
    """Headers in the usual spelling: blanks, dashes and slashes as underscores, no commas, lower case."""
    return F.transform(values, lambda v: F.lower(F.regexp_replace(F.regexp_replace(F.coalesce(v, F.lit("")), r"[ \-/]", "_"), ",", "")))


def _placed(staged: DataFrame) -> DataFrame:
    """Adds ``place``: the line's number from 0 where its split begins the file, else null."""
    first = F.when(F.col("block") == 0, F.col("at"))
    starts = staged.groupBy("file").agg(F.min(first).alias("_start"))  # one row per file
    return dimension_join(staged, starts, ["file"], "left").withColumn(
        "place", F.when(F.col("block") == 0, F.col("at") - F.col("_start"))).drop("_start")


def file_headers(staged: DataFrame, sep: str = ",", header_rows: int = 1) -> DataFrame:
    """(file, names): the column names of each file, from its ``header_rows``-th line."""
    lines = _placed(staged).where(F.col("place") == header_rows - 1)
    return lines.select("file", basic_names(values_of(F.col("line"), sep)).alias("names"))


def mapped_headers(headers: DataFrame, mapping: DataFrame, client: Column) -> DataFrame:
    """``headers`` with each name replaced by the column that the client's mapping gives it (null: none).

    ``mapping``: client_code, prediction_column_name, training_column_name; ``client`` is an expression over ``file``.
    """
    names = headers.withColumn("client_code", client).select("file", "client_code", F.posexplode("names").alias("i", "name"))
    rules = mapping.groupBy("client_code", F.col("prediction_column_name").alias("name")).agg(
        F.max("training_column_name").alias("column"))
    found = dimension_join(names, rules, ["client_code", "name"], "left")
    # as many entries as a file has columns
    return found.groupBy("file", "client_code").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "column"))), lambda e: e["column"]).alias("names"))


def parse_lines(
    staged: DataFrame, headers: DataFrame, columns: Mapping[str, str], sep: str = ",", header_rows: int = 1
) -> DataFrame:
    """One row per data line: ``columns`` (name -> type), file, at, line, and ``reason`` (null: the line is fine).

    Blank lines are left out. A column that a file lacks is null there; a file with none of them, or without
    a header, fails as a whole.
    """
    body = _placed(staged).where(((F.col("place") >= header_rows) | F.col("place").isNull()) & (F.trim("line") != ""))
    rows = dimension_join(body, headers, ["file"], "left").withColumn("_values", values_of(F.col("line"), sep))
    known = F.size(F.array_intersect(F.coalesce("names", F.array().cast("array<string>")), F.array(*[F.lit(c) for c in columns]))) > 0
    n, wanted = F.size("_values"), F.size("names")
    raw = {c: F.get("_values", (F.array_position("names", F.lit(c)) - 1).cast("int")) for c in columns}
    rows = rows.withColumns({f"_raw_{c}": F.when(F.array_position("names", F.lit(c)) > 0, v) for c, v in raw.items()})
    typed = {c: F.col(f"_raw_{c}").try_cast(kind) for c, kind in columns.items()}
    odd = F.lit(False)
    for c in columns:
        odd = odd | (F.col(f"_raw_{c}").isNotNull() & typed[c].isNull())
    tests = [~known, open_quote(F.col("line")), n < wanted, n > wanted, odd]
    reason = F.lit(None).cast("string")
    for text, test in reversed(list(zip(REASONS, tests))):
        reason = F.when(test, F.lit(text)).otherwise(reason)
    extra = [c for c in headers.columns if c not in ("file", "names")]
    return rows.select(*[v.alias(c) for c, v in typed.items()], *extra, "file", "at", "line", reason.alias("reason"))


def ingest_files(
    spark: SparkSession, path: str | Sequence[str], mapping: DataFrame, client: Column, columns: Mapping[str, str],
    target: str, quarantine: str, load_date: str, id_col: str, tolerated: int = 10, sep: str = ",", header_rows: int = 1,
    glob: str | None = None,
) -> DataFrame:
    """Loads all files under ``path``: accepted rows to ``target``, the others to ``quarantine``, both by
    (client_code, load_date), replacing that slice, so a repeated load leaves the same rows.

    Returns a gate row per client, read back from what was written: n_rows, n_rejected, null_ids, passed.
    """
    staged = stage_lines(spark, path, glob)
    headers = mapped_headers(file_headers(staged, sep, header_rows), mapping, client)
    parsed = parse_lines(staged, headers, columns, sep, header_rows)
    parsed = parsed.withColumns({"client_code": F.coalesce("client_code", client), "load_date": F.lit(load_date)})
    keys = ["client_code", "load_date"]
    where = scratch_path(spark, "parsed")
    parsed.write.parquet(where)
    parsed = spark.read.schema(parsed.schema).parquet(where)
    fine = parsed.where("reason is null").select(*columns, *keys)
    broken = parsed.where("reason is not null").select("file", "at", "line", "reason", *keys)
    # clients of this load, so that an emptied slice is emptied in the target as well
    clients = [r[0] for r in parsed.select("client_code").distinct().collect()]
    slices = [{"client_code": c, "load_date": load_date} for c in clients]
    replace_slice(fine, target, keys, slices)
    replace_slice(broken, quarantine, keys, slices)
    this = (F.col("load_date") == load_date) & F.col("client_code").isin(clients)
    back = spark.read.schema(fine.schema).parquet(target).where(this).groupBy("client_code").agg(
        F.count("*").alias("n_rows"), F.sum(F.col(id_col).isNull().cast("long")).alias("null_ids"))
    out = spark.read.schema(broken.schema).parquet(quarantine).where(this).groupBy("client_code").agg(F.count("*").alias("n_rejected"))
    gate = back.join(out, "client_code", "full").fillna(0, ["n_rows", "null_ids", "n_rejected"])
    return gate.select("client_code", "n_rows", "n_rejected", "null_ids", ((F.col("null_ids") <= tolerated) & (F.col("n_rows") > 0)).alias("passed"))
