"""Query registry and table access."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

MODULES = ("sources", "shaping", "joins", "profiles", "windows", "scalars", "documents", "encoding",
           "evaluation", "modelling", "jobs")


class Tables:
    """Lazy readers of the given Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise KeyError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def load_all() -> None:
    for m in MODULES:
        importlib.import_module(f"tabloom.catalog.{m}")


def rd(c: Column | str, digits: int = 6) -> Column:
    """Rounded double, so sums in another order compare equal."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def as_int(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("int")


def as_long(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


# -- dirt that both engines can inject ----------------------------------------

DIRTY_EVENTS = """(select event_id, user_id, value, ts,
  case when event_id % 7 = 0 then null when event_id % 11 = 0 then '  ' else event_type end as etype,
  case when event_id % 13 = 0 then 'n/a'
       when event_id % 5 = 0 then '00' || cast(cast(floor(value) as bigint) as varchar)
       else cast(cast(floor(value) as bigint) as varchar) end as amount_text,
  case when event_id % 9 = 0 then null else value end as amount
 from events)"""


def dirty_events(t: Tables) -> DataFrame:
    e, k = t.events, F.col("event_id")
    whole = F.floor("value").cast("string")
    return e.select(
        "event_id", "user_id", "value", "ts",
        F.when(k % 7 == 0, F.lit(None)).when(k % 11 == 0, "  ").otherwise(F.col("event_type")).alias("etype"),
        F.when(k % 13 == 0, "n/a").when(k % 5 == 0, F.concat(F.lit("00"), whole)).otherwise(whole).alias("amount_text"),
        F.when(k % 9 != 0, F.col("value")).alias("amount"),
    )


# scored claims on events
SCORED = """(select cast(event_id as varchar) as claim_id, event_type as client_plan_id,
  'P' || cast(user_id % 5 as varchar) as predicted_plan_id, value / 500.0 as probability_score from events)"""


def scored(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("event_id").cast("string").alias("claim_id"),
        F.col("event_type").alias("client_plan_id"),
        F.concat(F.lit("P"), (F.col("user_id") % 5).cast("string")).alias("predicted_plan_id"),
        (F.col("value") / 500.0).alias("probability_score"),
    )


# claims fact: one row per order, with the plan of its customer
CLAIMS = """(select o_orderkey as claim_id, o_orderstatus as claim_status, o_totalprice as amount,
  o_orderpriority as priority, c_mktsegment as plan, c_nationkey as nation, c_custkey as member
 from orders join customer on o_custkey = c_custkey)"""


def claims(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("claim_id"), F.col("o_orderstatus").alias("claim_status"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("priority"),
        F.col("c_mktsegment").alias("plan"), F.col("c_nationkey").alias("nation"),
        F.col("c_custkey").alias("member"),
    )
