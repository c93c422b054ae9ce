"""Sinks.  Each one is a single distributed job."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.text import pii_hash

FOLDER_FILES = 4096  # documents that a task writes, into a folder of its own


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str], mode: str = "append") -> None:
    df.write.mode(mode).partitionBy(*keys).parquet(path)


def _folder_part(key: str, value: object) -> str:
    """``key=value`` as partition folders spell it."""
    if value is None:
        return f"{key}=__HIVE_DEFAULT_PARTITION__"
    return f"{key}=" + re.sub(r"[\x00-\x1f\"#%'*/:=?\\\x7f{\[\]^]", lambda m: f"%{ord(m[0]):02X}", str(value))


def replace_slice(df: DataFrame, path: str, keys: Sequence[str], slices: Sequence[Mapping[str, object]] = ()) -> None:
    """Idempotent delete-by-key then append: only the partitions present in
    ``df`` are overwritten, so a replay leaves the same rows.

    ``slices`` names key values that are replaced even where ``df`` has no row
    of them: those partitions are emptied first.
    """
    for values in slices:
        nothing = df.sparkSession.createDataFrame([], df.drop(*keys).schema)
        nothing.write.mode("overwrite").parquet("/".join([path.rstrip("/"), *[_folder_part(k, values[k]) for k in keys]]))
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def _local_path(spark: SparkSession, path: str) -> str | None:
    """The path in the machine's own file system, or None where ``path`` lies in another one."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def write_documents(df: DataFrame, path: str, key: str, body: str) -> None:
    """A text file for each value of ``key``, named ``..key=value..``, with a line for each of its rows.

    On a local or mounted folder tasks write ``part=N/part-N-key=value.txt`` by plain file calls. Spark's own writer
    makes two folders, a checksum file and renames for each document, and in a local file system starts a process for
    each of their permissions; its folders must then be listed one by one. It is used for other file systems.
    """
    spark = df.sparkSession
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-df.count() // FOLDER_FILES))
    rows = df.select(key, body).repartition(tasks, key)
    root = _local_path(spark, path)
    if root is None:
        rows.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(key).text(path)
        return

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        folder, start = f"{root}/part={task.partitionId()}", f"part-{task.partitionId():05d}"
        os.makedirs(folder, exist_ok=True)
        written, name, out = 0, None, None
        # under a hidden name until it is whole, so that a task that runs again leaves no torn file
        hidden = f"{folder}/.{start}-{task.taskAttemptId()}"
        for batch in batches:
            for value, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file = f"{folder}/{start}-{_folder_part(key, value)}.txt"
                if file != name:
                    if out is not None:
                        out.close()
                        os.replace(hidden, name)
                    name, out = file, open(hidden, "wb")
                    written += 1
                out.write((text or b"") + b"\n")
        if out is not None:
            out.close()
            os.replace(hidden, name)
        yield pa.RecordBatch.from_arrays([pa.array([written], pa.int64())], ["n"])

    os.makedirs(root)
    ordered = rows.select(key, F.col(body).cast("binary").alias(body)).sortWithinPartitions(key)
    ordered.mapInArrow(run, "n long").agg(F.sum("n")).collect()


def append_jdbc(df: DataFrame, url: str, table: str, options: Mapping[str, str] | None = None) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, **(options or {})).mode("append").save()


def export_flat(
    df: DataFrame, path: str, sep: str = ",", single_file: bool = False, header: bool = True
) -> None:
    """Delimited text; many part files unless one file is asked for."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("sep", sep).option("header", header).option("escape", '"').csv(path)


def master_names(names: Sequence[str]) -> list[str]:
    """A repeated header gets a ``_MASTER`` suffix."""
    seen: set[str] = set()
    out = []
    for n in names:
        out.append(f"{n}_MASTER" if n in seen else n)
        seen.add(n)
    return out


def hashed_projection(df: DataFrame, pii_cols: Sequence[str], salt: str | None = None) -> DataFrame:
    """All columns as text: nulls empty, PII columns hashed, headers unique."""
    names = df.columns
    df = df.toDF(*[f"_{i}" for i in range(len(names))])
    cols = []
    for i, (n, final) in enumerate(zip(names, master_names(names), strict=True)):
        c = F.col(f"_{i}")
        body = pii_hash(c, salt) if n in pii_cols else F.coalesce(c.cast("string"), F.lit(""))
        cols.append(body.alias(final))
    return df.select(*cols)


def row_manifest(df: DataFrame) -> DataFrame:
    """Row count and an order-independent digest of the rows: a sum over the first 60 bits of each
    row's MD5, which also tells how often a row occurs. Other engines can repeat it."""
    line = F.concat_ws(chr(31), *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns])
    part = F.conv(F.substring(F.md5(line), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n_rows"), F.sum(part).alias("digest"))


def export_hashed(
    df: DataFrame, path: str, pii_cols: Sequence[str], sep: str = "|", salt: str | None = None
) -> DataFrame:
    """Write the hashed extract and return its manifest, read back from the files."""
    out = hashed_projection(df, pii_cols, salt)
    (
        out.write.mode("overwrite").option("sep", sep).option("header", True)
        .option("emptyValue", "").option("escape", '"').csv(path)
    )
    back = df.sparkSession.read.schema(out.schema).option("sep", sep).option("header", True).option("escape", '"')
    return row_manifest(back.csv(path))


def control_repartition(df: DataFrame, n: int | None = None) -> DataFrame:
    """Fixed sink parallelism; ``None`` leaves the sizes to AQE."""
    return df.repartition(n) if n else df.hint("rebalance")
