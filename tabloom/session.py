"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults that suit both a laptop and a cluster; anything the caller or
# spark-submit sets wins because these are applied through the builder only.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


_own_folder: tempfile.TemporaryDirectory | None = None  # removed when Python ends


def get_session(app: str = "tabloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Where the session names none, a temporary folder is used in local mode
    (tests), until Python ends; on a cluster that would lose data, so it is refused.
    """
    global _own_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if _own_folder is None:
            _own_folder = tempfile.TemporaryDirectory(prefix="tabloom-", ignore_cleanup_errors=True)
        folder = _own_folder.name
        spark.sparkContext.setCheckpointDir(folder)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for a written intermediate."""
    return f"{shared_folder(spark).rstrip('/')}/tabloom/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint (survives executor loss)."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder once and read back, where several jobs read its rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
