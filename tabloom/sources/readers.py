"""Readers.  All lazy; schemas are declared, never inferred."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


READ_TASKS = 4  # tasks a core, at least, that read small documents


def string_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_delimited(spark: SparkSession, path: str, sep: str, names: Sequence[str]) -> DataFrame:
    """Headerless delimited text, columns named by position, all strings."""
    return spark.read.schema(string_schema(names)).option("sep", sep).csv(path)


def read_csv_header(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    strip: bool = True,
    date_format: str | None = None,
    timestamp_format: str | None = None,
) -> DataFrame:
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", strip)
        .option("escape", '"')
    )
    if date_format:
        reader = reader.option("dateFormat", date_format)
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    return reader.csv(path if isinstance(path, str) else list(path))


def read_csv_promote_header(
    spark: SparkSession, paths: Mapping[str, str], width: int, promote: bool = True
) -> DataFrame:
    """Files whose first data row is a second header.

    ``paths`` maps a tag (a year, say) to a file or folder.  With ``promote``
    that row's values become the column names, otherwise it is only dropped
    and the first header is kept.  One row per source reaches the driver; the
    header row is removed wherever its exact values occur.
    """
    positional = [f"_c{i}" for i in range(width)]
    frames = []
    for tag, path in paths.items():
        raw = spark.read.schema(string_schema(positional)).option("escape", '"').option("header", True)
        raw = raw.option("enforceSchema", True).csv(path)
        second = raw.limit(1).collect()
        if not second:
            continue
        values = second[0]
        names = list(values) if promote else _first_header(spark, path, width)
        same = reduce(
            lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(values[c])) for c in positional]
        )
        frames.append(raw.where(~same).toDF(*names).withColumn("source_tag", F.lit(tag)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _first_header(spark: SparkSession, path: str, width: int) -> list[str]:
    raw = spark.read.schema(string_schema([f"_c{i}" for i in range(width)])).option("escape", '"').csv(path)
    return list(raw.limit(1).collect()[0])


def read_jdbc(
    spark: SparkSession,
    url: str,
    dbtable: str | None = None,
    query: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Table or subquery over JDBC; a plain ``filter`` afterwards is pushed down.

    Give ``partitionColumn``/``lowerBound``/``upperBound``/``numPartitions``
    in ``options`` for a parallel read.  Credentials come from the caller.
    """
    return _query_reader(spark, "jdbc", {"url": url, **(options or {})}, dbtable, query).load()


def read_query(
    spark: SparkSession, fmt: str, query: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Warehouse query source: any format that takes a ``query`` option."""
    return _query_reader(spark, fmt, options or {}, None, query).load()


def _query_reader(spark, fmt, options, dbtable, query):
    if (dbtable is None) == (query is None):
        raise ValueError("give exactly one of dbtable and query")
    reader = spark.read.format(fmt).options(**options)
    return reader.option("dbtable", dbtable) if dbtable else reader.option("query", query)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_corpus(spark: SparkSession, path: str, glob: str = "*", binary: bool = False) -> DataFrame:
    """One row per whole document: path, filename, size, content.

    Spark counts a file of any size as some megabytes, so a task would read a few documents only; text files are read
    by tasks of as many bytes as the session allows.
    """
    if binary:
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
        return files.select(
            "path",
            F.element_at(F.split("path", "/"), -1).alias("filename"),
            F.col("length").alias("size"),
            F.decode("content", "UTF-8").alias("content"),
        )
    text = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    size = int(str(text._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    most = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))
    tasks = max(READ_TASKS * spark.sparkContext.defaultParallelism, -(-size // most))
    return text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("filename"),
        F.col("_metadata.file_size").alias("size"),
        F.col("value").alias("content"),
    ).coalesce(tasks)


def read_with_schema(
    spark: SparkSession,
    path: str,
    dtypes: Mapping[str, str],
    usecols: Sequence[str] | None = None,
    nrows: int | None = None,
    fmt: str = "csv",
) -> DataFrame:
    """Declared types, chosen columns, optional row cap (a feature of the call)."""
    schema = ", ".join(f"`{k}` {v}" for k, v in dtypes.items())
    df = spark.read.schema(schema).option("header", True).option("escape", '"').format(fmt).load(path)
    df = df.select(*(usecols or list(dtypes)))
    return df.limit(nrows) if nrows is not None else df
