"""The corpus pipeline: toxicity, quality rules, line dedup, near-duplicate join, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which its caller
writes as Parquet and reads again as the next stage's ``docs``. All but the last
return the columns of ``documents``; a document that a stage rejects is gone for
the stages after it. No SQL expresses the trained and token stages, so the
pipeline is tested against its operators' brute-force versions.

Defined cases: null and empty texts fail the quality rules, and a text of which
line dedup leaves nothing is gone; repeated rows and equal texts leave one; without
labels of both kinds nothing is toxic; long texts are judged whole; columns keep
their names, whatever they are; an empty table packs to nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabloom.llm import line_dedup, ngram_join, packing, quality, toxicity
from tabloom.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep(docs, table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.clean(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("quality_rules", drop_poor), ("line_dedup", drop_repeated_lines),
          ("ngram_jaccard_join", drop_near_duplicates), ("packing", pack_sequences)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
