"""Claims jobs: ingest, summary, voting, pending work, training sets."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.text import camel_key_col
from tabloom.operators.encoding import prune_and_fill
from tabloom.operators.filters import above, keep_members, keep_status
from tabloom.operators.joins import dimension_join
from tabloom.operators.profiling import load_gate
from tabloom.operators.sets import exact_holdout
from tabloom.operators.shaping import (
    add_literals,
    drop_identical_columns,
    drop_matching,
    map_columns,
    normalize_headers,
    recode,
    trim_all,
)
from tabloom.operators.windows import tiered_sample
from tabloom.session import settle
from tabloom.sources.models import load_model, score_labelled
from tabloom.sources.writers import replace_slice


def plan_summary(scored: DataFrame, threshold: float = 0.15, **tags: object) -> DataFrame:
    """Count and mean score per (client plan, predicted plan) above a threshold.

    One partial + final hash aggregate, one shuffle of a few rows per task.
    """
    kept = above(trim_all(scored), "probability_score", threshold)
    out = kept.groupBy("client_plan_id", "predicted_plan_id").agg(
        F.count("*").alias("claim_count"), F.avg("probability_score").alias("probability"))
    return add_literals(out, tags)


def event_row(df: DataFrame, event_type: str, fields: Sequence[str], status: str) -> DataFrame:
    """JSON event message per row."""
    return df.select(
        F.lit(event_type).alias("event_type"),
        F.to_json(F.struct(*fields)).alias("event_message"),
        F.lit(status).alias("status"),
    )


def votes_long(predictions: DataFrame, plan: str, key: str, columns: Sequence[str], sep: str = "_=_") -> DataFrame:
    """0/1 prediction columns ``target_=_value`` -> (plan, target, value, order, votes).

    Votes are summed in one grouped pass before anything is unpivoted, so the
    long form has plans x columns rows, not claims x columns.
    """
    sums = predictions.where(F.col(plan) != "0").groupBy(plan).agg(
        F.count("*").alias("claims"), *[F.sum(f"`{c}`").cast("long").alias(f"v{i}") for i, c in enumerate(columns)])
    entries = F.array(*[
        F.struct(F.lit(c.split(sep)[0]).alias("target"), F.lit(c.split(sep, 1)[1]).alias("value"),
                 F.lit(i).alias("col_order"), F.col(f"v{i}").alias("votes"))
        for i, c in enumerate(columns)
    ])
    return sums.select(plan, "claims", F.explode(entries).alias("e")).select(plan, "claims", "e.*")


def vote_winners(votes: DataFrame, plan: str, floor: float = 33.0) -> DataFrame:
    """Arg-max value per (plan, target), first column on ties, and accuracy%."""
    best = votes.groupBy(plan, "target").agg(
        F.max("claims").alias("claims"),
        F.max_by(F.struct("value", "votes"), F.struct("votes", -F.col("col_order"))).alias("w"))
    pct = F.round(F.col("w.votes") * 100.0 / F.col("claims"), 1)
    return best.select(plan, "target", F.col("w.value").alias("value"), F.greatest(pct, F.lit(floor)).alias("accuracy"))


def vote_table(
    winners: DataFrame, plan: str, targets: Sequence[str], constants: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per plan: a column per target (fixed list), constant targets at
    100%, and the accuracies as camelCase-keyed JSON."""
    constants = dict(constants or {})
    wide = winners.groupBy(plan).agg(
        *[F.max(F.when(F.col("target") == t, F.col("value"))).alias(t) for t in targets],
        F.sort_array(F.collect_list(F.struct(camel_key_col(F.col("target")).alias("k"), F.col("accuracy").alias("v")))).alias("_e"),
    )
    fixed = [F.struct(camel_key_col(F.lit(t)).alias("k"), F.lit(100.0).alias("v")) for t in constants]
    entries = F.concat(F.col("_e"), F.array(*fixed)) if fixed else F.col("_e")
    return wide.withColumn(
        "field_accuracy_json", F.replace(F.to_json(F.map_from_entries(F.sort_array(entries))), F.lit("_"), F.lit(""))
    ).withColumns({t: F.lit(v) for t, v in constants.items()}).drop("_e")


def pending(control: DataFrame) -> DataFrame:
    return control.where((F.col("data_load_status") == "1") & (F.col("prediction_status") == "0"))


def run_pending(control: DataFrame, work: Callable[[str], DataFrame], id_col: str, tolerated: int = 10,
                workers: int = 4) -> DataFrame:
    """Runs ``work(client)`` for each pending client, ``workers`` jobs at a time;
    the flag flips only where the work succeeds and its result passes the id gate.
    A failure stays with its client: ``prediction_error`` says what it was.
    Where all clients' rows are in one table, use :func:`pending_outcome`."""
    clients = pending(control).select("client_code").where("client_code is not null").distinct()

    def one(client: str) -> tuple[str, bool, str | None]:
        try:
            gate = load_gate(work(client), id_col, tolerated).first()
        except Exception as failure:  # kept with the client; the others go on
            return client, False, f"{type(failure).__name__}: {failure}"
        return client, bool(gate["passed"]), None if gate["passed"] else f"{gate['null_ids']} rows without an id"

    with ThreadPoolExecutor(workers) as pool:
        outcome = list(pool.map(one, [r["client_code"] for r in clients.toLocalIterator()]))
    told = control.sparkSession.createDataFrame(outcome, T.StructType([
        control.schema["client_code"], T.StructField("_done", T.BooleanType()), T.StructField("prediction_error", T.StringType())]))
    flip = (F.col("data_load_status") == "1") & F.col("_done")
    return control.join(told, "client_code", "left").withColumn(
        "prediction_status", F.when(flip, "1").otherwise(F.col("prediction_status"))).select(*control.columns, "prediction_error")


def run_pending_together(
    control: DataFrame, work: Callable[[DataFrame], DataFrame], client_col: str, id_col: str, tolerated: int = 10,
    error_col: str | None = None,
) -> DataFrame:
    """All pending clients in one job: ``work`` gets their ``client_code`` as a DataFrame and returns rows of all of them.

    A client is done if it has rows, none of them holds an error (``error_col``), and at most ``tolerated`` lack an id;
    else ``prediction_error`` says why not.  Clients neither reach the driver nor wait for one another.
    """
    clients = pending(control).select("client_code").where("client_code is not null").distinct()
    error = F.min(error_col) if error_col else F.lit(None).cast("string")
    found = work(clients).groupBy(F.col(client_col).alias("client_code")).agg(
        F.count("*").alias("_rows"), F.sum(F.col(id_col).isNull().cast("long")).alias("_bad"), error.alias("_error"))
    joined = control.join(found, "client_code", "left")
    waiting = (F.col("data_load_status") == "1") & (F.col("prediction_status") == "0")
    reason = F.when(F.col("_rows").isNull(), "no rows").when(F.col("_error").isNotNull(), F.col("_error")).when(
        F.col("_bad") > tolerated, F.concat(F.col("_bad").cast("string"), F.lit(" rows without an id")))
    return joined.withColumn("prediction_error", F.when(waiting, reason)).withColumn(
        "prediction_status", F.when(waiting & reason.isNull(), "1").otherwise(F.col("prediction_status"))).select(
        *control.columns, "prediction_error")


def pending_outcome(control: DataFrame, data: DataFrame, client_col: str, id_col: str, tolerated: int = 10) -> DataFrame:
    """Set form of :func:`run_pending`: every pending client's gate in one
    grouped pass over the data instead of a job per client."""
    gates = data.groupBy(F.col(client_col).alias("client_code")).agg(
        F.sum(F.col(id_col).isNull().cast("long")).alias("_bad"))
    joined = control.join(gates, "client_code", "left")
    ok = (F.col("data_load_status") == "1") & (F.col("prediction_status") == "0") & (F.col("_bad") <= tolerated)
    return joined.withColumn("prediction_status", F.when(ok, "1").otherwise(F.col("prediction_status"))).drop("_bad")


def ingest_claims(
    raw: DataFrame, mapping: DataFrame, client: str, tags: Mapping[str, object], path: str, id_col: str,
    keys: Sequence[str] = ("client_code", "load_date"),
) -> DataFrame:
    """Normalise headers, map columns, tag, write the partition, verify it."""
    shaped = add_literals(trim_all(map_columns(normalize_headers(raw), mapping, client)), tags)
    replace_slice(shaped, path, keys)
    back = raw.sparkSession.read.schema(shaped.schema).parquet(path)
    for k in keys:
        back = back.where(F.col(k) == F.lit(tags[k]))
    return load_gate(back, id_col)


def training_set(
    claims: DataFrame,
    master: DataFrame,
    key: str,
    claim_id: str,
    status: str,
    rules: Sequence[tuple[str, str, str]],
    drop_patterns: Sequence[str],
    large: int,
    small: int,
    holdout: int,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Clean and prune the master, sample paid claims per plan, join, hold out."""
    text = [f.name for f in master.schema if f.dataType.simpleString() == "string" and f.name != key]
    clean = drop_identical_columns(recode(master, rules, text))
    clean = drop_matching(clean, drop_patterns)
    pruned, _ = prune_and_fill(clean, [key, *keep])
    # read by every scan of the sample, so written once
    paid = keep_status(claims, status, "P").distinct()
    known = settle(keep_members(paid, key, master.select(key).distinct()))
    sample = tiered_sample(known, key, claim_id, large, small)
    joined = dimension_join(sample, pruned, [key])
    return exact_holdout(joined, claim_id, holdout)


def score_chain(
    claims: DataFrame, score: Callable[[DataFrame], DataFrame], threshold: float, tags: Mapping[str, object]
) -> tuple[DataFrame, DataFrame]:
    """Score -> trimmed detail -> summary in one session."""
    detail = trim_all(score(claims))
    return detail, plan_summary(detail, threshold, **tags)


def score_saved(
    claims: DataFrame, model_path: str, columns: Mapping[str, Column], threshold: float, tags: Mapping[str, object]
) -> tuple[DataFrame, DataFrame]:
    """(detail, summary) of ``claims`` by a saved model: loaded, decoded to plan names, trimmed, summed up.

    ``columns`` names the detail's own columns (claim_id and client_plan_id at least).
    """
    model = load_model(model_path)

    def score(df: DataFrame) -> DataFrame:
        marked = df.withColumns(dict(columns))
        return score_labelled(marked, model, list(columns)).withColumnRenamed("predicted_label", "predicted_plan_id")

    return score_chain(claims, score, threshold, tags)
