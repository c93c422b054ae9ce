"""Job-level compositions and the incremental form."""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from tabloom.catalog.base import CLAIMS, SCORED, Tables, as_int, claims, query, rd
from tabloom.operators.encoding import feature_pipeline
from tabloom.plans import claims as C
from tabloom.plans import research, targets, wide
from tabloom.plans.rules import rule_table
from tabloom.session import scratch_path
from tabloom.sources import claim_files
from tabloom.sources.models import fit_labelled, save_model
from tabloom.streaming import keyed
from tabloom.streaming.incremental import run_incremental, stream_files

# one control row per nation: loaded unless the key is divisible by 5, predicted where divisible by 7
_CONTROL = """(select cast(n_nationkey as varchar) as client_code, case when n_nationkey % 5 = 0 then '0' else '1' end as data_load_status,
  case when n_nationkey % 7 = 0 then '1' else '0' end as prediction_status from nation)"""


def control(t: Tables):
    k = F.col("n_nationkey")
    return t.nation.select(k.cast("string").alias("client_code"), F.when(k % 5 == 0, "0").otherwise("1").alias("data_load_status"),
                           F.when(k % 7 == 0, "1").otherwise("0").alias("prediction_status"))


def client_claims(t: Tables):
    """Claims with some ids lost: more than the gate tolerates in a few clients."""
    return claims(t).select(F.col("nation").cast("string").alias("client"),
                            F.when((F.col("nation") % 4 != 3) | (F.col("claim_id") % 9 != 0), F.col("claim_id")).alias("claim_id"))


@query("n01_pending_outcome", f"""
with g as (select cast(nation as varchar) as client_code, count(case when nation % 4 = 3 and claim_id % 9 = 0 then 1 end) as bad from {CLAIMS} group by 1)
select client_code, data_load_status, case when data_load_status = '1' and prediction_status = '0' and bad <= 10 then '1' else prediction_status end as prediction_status
from {_CONTROL} left join g using (client_code)""")
def n01(t: Tables):
    return C.pending_outcome(control(t), client_claims(t), "client", "claim_id")


@query("n01_run_together", f"""
with g as (select cast(nation as varchar) as client_code, count(case when nation % 4 = 3 and claim_id % 9 = 0 then 1 end) as bad,
  min(case when nation = 11 and claim_status = 'P' then 'unreadable claim ' || claim_status end) as err from {CLAIMS} where nation <> 13 group by 1),
j as (select c.*, bad, err, case when data_load_status = '1' and prediction_status = '0' then
  case when g.client_code is null then 'no rows' when err is not null then err when bad > 10 then bad || ' rows without an id' else 'done' end end as outcome
  from {_CONTROL} c left join g using (client_code))
select client_code, data_load_status, case when outcome = 'done' then '1' else prediction_status end as prediction_status,
  nullif(outcome, 'done') as prediction_error from j""")
def n01t(t: Tables):
    """One client has no rows, one has rows that can't be read, some lost more ids than the gate tolerates."""
    def work(clients):
        rows = claims(t).where("nation <> 13").withColumn("client_code", F.col("nation").cast("string")).join(clients, "client_code", "left_semi")
        lost = (F.col("nation") % 4 == 3) & (F.col("claim_id") % 9 == 0)
        broken = (F.col("nation") == 11) & (F.col("claim_status") == "P")
        return rows.withColumns({"claim_id": F.when(~lost, F.col("claim_id")),
                                 "error": F.when(broken, F.concat(F.lit("unreadable claim "), "claim_status"))})

    return C.run_pending_together(control(t), work, "client_code", "claim_id", error_col="error")


@query("n01_run_pending", f"""
with g as (select plan as client_code, count(case when plan = 'BUILDING' and claim_id % 2 = 0 then 1 end) as bad from {CLAIMS} group by 1)
select client_code, '1' as data_load_status, case when client_code = 'MACHINERY' then '0' when bad <= 10 then '1' else '0' end as prediction_status from g""")
def n01r(t: Tables):
    ctl = claims(t).select(F.col("plan").alias("client_code")).distinct().withColumns(
        {"data_load_status": F.lit("1"), "prediction_status": F.lit("0")})

    def work(client: str):
        if client == "MACHINERY":
            raise RuntimeError("no file for this client")
        d = claims(t).where(F.col("plan") == client)
        return d.withColumn("claim_id", F.when((F.col("plan") != "BUILDING") | (F.col("claim_id") % 2 != 0), F.col("claim_id")))

    return C.run_pending(ctl, work, "claim_id").drop("prediction_error")


@query("n02_ingest_claims", "select count(*) as n_rows, cast(0 as bigint) as null_ids, 1 as passed from orders")
def n02(t: Tables):
    raw = t.orders.select(F.col("o_orderkey").alias("Claim Number"), F.concat(F.lit(" "), "o_orderstatus").alias("Claim/Status"),
                          F.col("o_totalprice").alias("Total-Paid"))
    mapping = t.spark.createDataFrame([("A", "claim_number", "rxclaim_number"), ("A", "claim_status", "claim_status"), ("A", "total_paid", "paid")],
                                      "client_code string, prediction_column_name string, training_column_name string")
    gate = C.ingest_claims(raw, mapping, "A", {"client_code": "A", "load_date": "2024-01-31"}, scratch_path(t.spark, "n02"), "rxclaim_number")
    return gate.withColumn("passed", as_int("passed"))


_ARRIVED = """(select o_orderkey as k, ['A', 'B', 'C'][o_orderkey % 3 + 1] as client_code, o_orderstatus as status, floor(o_totalprice) as paid,
  case when o_orderkey % 50 = 0 then 'too many values' when o_orderkey % 70 = 0 then 'unreadable value' when o_orderkey % 110 = 0 then 'open quote' end as reason
  from orders)"""
_CLIENT_HEADERS = {"A": ["Claim Number", "Claim/Status", "Total-Paid"], "B": ["paid", "claim id", "STATE"], "C": ["State,", "Note", "Claim", "Paid"]}


def arrived_files(t: Tables) -> str:
    """Three clients' folders of files: their own headers and orders of columns, some lines broken."""
    k, folder = F.col("o_orderkey"), scratch_path(t.spark, "arrived")
    status = F.when(k % 50 == 0, F.concat("o_orderstatus", F.lit(",?"))).when((k % 110 == 0) & (k % 70 != 0), F.concat(F.lit('"'), "o_orderstatus")).otherwise(
        F.col("o_orderstatus"))
    paid = F.when((k % 70 == 0) & (k % 50 != 0), "n/a").otherwise(F.floor("o_totalprice").cast("string"))
    parts = {"A": [k, status, paid], "B": [paid, k, status], "C": [status, F.lit("x"), k, paid]}
    for i, (client, columns) in enumerate(parts.items()):
        names = [h.rstrip(",") for h in _CLIENT_HEADERS[client]]
        rows = t.orders.where(k % 3 == i).select(*[c.cast("string").alias(n) for c, n in zip(columns, names)])
        # no quoting: what holds a separator becomes a broken line
        rows.repartition(3).write.option("header", True).option("quote", "").csv(f"{folder}/{client}")
    return folder


def arrival_mapping(t: Tables):
    wanted = {"claim_number": "claim", "claim_id": "claim", "claim": "claim", "claim_status": "status", "state": "status",
              "total_paid": "paid", "paid": "paid"}
    return t.spark.createDataFrame([(c, theirs, ours) for c in _CLIENT_HEADERS for theirs, ours in wanted.items()],
                                   "client_code string, prediction_column_name string, training_column_name string")


def ingested(t: Tables):
    target, quarantine = scratch_path(t.spark, "claims"), scratch_path(t.spark, "quarantine")
    client = F.element_at(F.split("file", "/"), -2)
    gate = claim_files.ingest_files(
        t.spark, arrived_files(t), arrival_mapping(t), client, {"claim": "bigint", "status": "string", "paid": "bigint"},
        target, quarantine, "2024-01-31", "claim", glob="*.csv")
    return gate, t.spark.read.parquet(target), t.spark.read.parquet(quarantine)


@query("n02_ingest_files", f"""
select client_code, case when reason is null then k end as claim, case when reason is null then status end as status,
  case when reason is null then paid::bigint end as paid, reason, count(*) as n from {_ARRIVED} group by all""")
def n02f(t: Tables):
    _, good, bad = ingested(t)
    rows = good.select("client_code", "claim", "status", "paid", F.lit(None).cast("string").alias("reason")).unionByName(
        bad.select("client_code", "reason"), allowMissingColumns=True)
    return rows.groupBy("client_code", "claim", "status", "paid", "reason").agg(F.count("*").alias("n"))


@query("n02_ingest_gate", f"""
select client_code, count(*) filter (reason is null) as n_rows, count(reason) as n_rejected, 0::bigint as null_ids, 1 as passed
from {_ARRIVED} group by client_code""")
def n02g(t: Tables):
    return ingested(t)[0].withColumn("passed", as_int("passed"))


@query("n03_score_chain", f"""
select client_plan_id, predicted_plan_id, count(*) as claim_count, round(avg(probability_score), 10) as probability, 'C1' as client_code
from {SCORED} where probability_score > 0.2 group by client_plan_id, predicted_plan_id""")
def n03(t: Tables):
    def score(events):
        return events.select(F.concat(F.lit(" "), F.col("event_id").cast("string")).alias("claim_id"),
                             F.concat(F.lit(" "), F.col("event_type")).alias("client_plan_id"),
                             F.concat(F.lit("P"), (F.col("user_id") % 5).cast("string")).alias("predicted_plan_id"),
                             (F.col("value") / 500.0).alias("probability_score"))

    _, summary = C.score_chain(t.events, score, 0.2, {"client_code": "C1"})
    return summary.withColumn("probability", rd("probability", 10))


@query("n03_model_chain", """
select event_type as client_plan_id, 'P' || cast(user_id % 5 as varchar) as predicted_plan_id, count(*) as claim_count, 1.0::double as probability, 'C1' as client_code
from events group by 1, 2""")
def n03m(t: Tables):
    """Train, save, load, score, decode, detail, summary."""
    d = t.events.select("event_id", "event_type", (F.col("user_id") % 5).cast("string").alias("group"))
    trained = d.withColumn("plan", F.concat(F.lit("P"), "group"))
    model = fit_labelled(trained, feature_pipeline(["group"], []).getStages(), "plan", DecisionTreeClassifier(maxDepth=6, seed=7))
    path = save_model(model, scratch_path(t.spark, "plan-model"))
    detail, summary = C.score_saved(d, path, {"claim_id": F.concat(F.lit(" "), F.col("event_id").cast("string")),
                                              "client_plan_id": F.concat(F.lit(" "), "event_type")}, 0.2, {"client_code": "C1"})
    return summary.withColumn("probability", rd("probability", 10))


@query("n04_training_set", f"""
with c as (select *, count(*) over (partition by plan) as n, row_number() over (partition by plan order by md5(cast(claim_id as varchar)), claim_id) as rn
  from {CLAIMS} where claim_status = 'P'),
s as (select claim_id, plan from c where (n > 1000 and rn <= 1000) or (n <= 1000 and n > 500))
select claim_id, s.plan, case when plan in ('BUILDING', 'HOUSEHOLD') then 'home' else 'work' end as kind,
  cast(row_number() over (order by md5(cast(claim_id as varchar)), claim_id) <= 800 as integer) as is_holdout from s""")
def n04(t: Tables):
    master = t.customer.select(F.col("c_mktsegment").alias("plan")).distinct().select(
        "plan", F.when(F.col("plan").isin("BUILDING", "HOUSEHOLD"), "house").otherwise("work").alias("kind"),
        F.col("plan").alias("plan_copy"), F.lit("v1").alias("version"), F.concat("plan", F.lit("_d")).alias("created_date"))
    out = C.training_set(claims(t), master, "plan", "claim_id", "claim_status", [("kind", "house", "home")], ["date", "_copy$"], 1000, 500, 800)
    return out.select("claim_id", "plan", "kind", as_int("is_holdout").alias("is_holdout"))


@query("n05_research")
def n05(t: Tables):
    base = t.customer.select("c_custkey", "c_acctbal", F.when(F.col("c_custkey") % 11 != 0, F.col("c_nationkey")).alias("c_nationkey"))
    left = t.supplier.groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.avg("s_acctbal").alias("wealth"))
    inner = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg((F.avg("o_totalprice") / 1000.0).alias("y"))
    d = research.prepare(base, left, "c_nationkey", inner, "c_custkey", "y", ["wealth"], ["wealth", "c_acctbal"])
    d = d.withColumn("region", F.coalesce(F.col("c_nationkey"), F.lit(-1)))
    fits = research.fit_ladder(d, "y", "region", ["c_acctbal_std", "wealth_missing"], ["wealth_std"])
    from tabloom.operators.mixed import comparison_table

    return comparison_table(t.spark, fits).select("model", "n", "n_groups", rd("icc", 4).alias("icc"), rd("aic", 3).alias("aic"))


@query("n06_wide_forest")
def n06(t: Tables):
    from tabloom.catalog.encoding import wide_parts

    _, cells, gone = wide.prune_encode_forest(wide_parts(t).drop("p_name"), "p_partkey", "p_type")
    return cells.withColumn("dropped", F.lit(",".join(sorted(gone))))


@query("n07_rule_table")
def n07(t: Tables):
    """Rule extraction over the conversations' own text (whole texts)."""
    return rule_table(t.conversations.select("conv_id", "turn", F.concat(F.lit("1. "), "text").alias("txt")), "txt").select(
        "conv_id", "turn", "step", "age", "manual_step", F.size("tokens").alias("n_tokens"))


@query("n08_target_votes", """
with v as (select l_returnflag as plan, count(*) as claims, sum(cast(l_linenumber <= 3 as integer)) as low from lineitem group by l_returnflag)
select plan, 'line_band' as target, 'low' as value, cast(low as bigint) as votes, claims from v
union all select plan, 'line_band', 'high', cast(claims - low as bigint), claims from v union all select plan, 'network', 'fixed', claims, claims from v""")
def n08(t: Tables):
    """Train, save, load, score and vote: the bands follow from a feature, so the models' votes are known."""
    low = (F.col("l_linenumber") <= 3).cast("int")
    lines = t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("claim"), F.col("l_returnflag").alias("plan"), "l_linenumber",
        "l_quantity", "l_discount", "l_tax", low.alias("line_band_=_low"), (1 - low).alias("line_band_=_high"), F.lit(1).alias("network_=_fixed"))
    known = ["line_band_=_low", "line_band_=_high", "network_=_fixed"]
    folder = scratch_path(t.spark, "targets")
    targets.train_targets(lines, known, ["l_linenumber", "l_quantity", "l_discount", "l_tax"], "claim", folder, k=3, trees=5, rounds=3)
    scored, columns, constants = targets.score_targets(lines.drop(*known), folder)
    votes = targets.with_constants(C.votes_long(scored, "plan", "claim", columns), "plan", constants)
    return votes.select("plan", "target", "value", "votes", "claims")


@query("p01_incremental_summary", f"""
select client_plan_id, predicted_plan_id, count(*) as claim_count, round(avg(probability_score), 10) as probability
from {SCORED} where probability_score > 0.15 group by client_plan_id, predicted_plan_id""")
def p01(t: Tables):
    """Events arrive as files, twice over; the result equals the batch one."""
    src, detail, mark = (scratch_path(t.spark, n) for n in ("arrivals", "detail", "offsets"))
    t.events.write.parquet(src)
    t.events.where(F.col("event_type") == "click").write.mode("append").parquet(src)
    stream = stream_files(t.spark, src, t.events.schema, files_per_batch=1)

    def score(batch):
        return batch.select(F.col("event_id").cast("string").alias("claim_id"), F.col("event_type").alias("client_plan_id"),
                            F.concat(F.lit("P"), (F.col("user_id") % 5).cast("string")).alias("predicted_plan_id"),
                            (F.col("value") / 500.0).alias("probability_score"), "ts")

    run_incremental(stream, score, detail, mark, ["claim_id"], ["ts"], buckets=4).awaitTermination()
    back = t.spark.read.parquet(detail)
    return C.plan_summary(back, 0.15).withColumn("probability", rd("probability", 10))


@query("p01_keyed_versions", """
select event_type as client_plan_id, count(*) as n_claims,
  round(sum(case event_type when 'purchase' then value * 2 else value end), 6) as value from events group by event_type""")
def p01k(t: Tables):
    """Files arrive in order: all events, outdated clicks that must lose, corrected purchases that must win, and those again."""
    src, detail, mark = (scratch_path(t.spark, n) for n in ("arrivals", "versions", "offsets"))
    e, kind = t.events, F.col("event_type")
    day = F.expr("interval 1 day")
    late = e.where(kind == "click").withColumns({"ts": F.col("ts") - day, "value": F.lit(0.0)})
    fixed = e.where(kind == "purchase").withColumns({"ts": F.col("ts") + day, "value": F.col("value") * 2})
    for arriving in (e, late, fixed, fixed):
        arriving.write.mode("append").parquet(src)

    def score(batch):
        return batch.select(F.col("event_id").alias("claim_id"), kind.alias("client_plan_id"), "value", "ts")

    keys = ["claim_id", "client_plan_id"]
    keyed.run_keyed(stream_files(t.spark, src, e.schema), score, detail, mark, keys, ["ts"]).awaitTermination()
    return keyed.current(t.spark, detail, keys).groupBy("client_plan_id").agg(
        F.count("*").alias("n_claims"), rd(F.sum("value")).alias("value"))
