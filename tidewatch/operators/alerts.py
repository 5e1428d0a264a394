"""Alert history: state table + signals of one run -> transitions and the next state table.

Pure functions of DataFrames, so the same merge serves a batch run or a foreachBatch sink.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import finite, rank_of
from ..spec import OK

OPEN, RESOLVED_STATE = "open", "resolved"
NEW, ONGOING, RESOLVED = "NEW", "ONGOING", "RESOLVED"

STATE_SCHEMA = (
    "batch_id string, signal_name string, category string, severity string, state string, "
    "first_seen timestamp_ntz, last_seen timestamp_ntz, resolved_at timestamp_ntz, occurrences bigint, "
    "last_value double, last_detail string, thresholds_source string, model_id string, run_id string, "
    "severity_history array<struct<at:timestamp_ntz,severity:string>>"
)


@dataclass(frozen=True)
class Reconciled:
    state: DataFrame        # open alerts: what the next run has to read
    transitions: DataFrame
    closed: DataFrame       # alerts this run resolved, to be appended to the history


def empty_state(spark) -> DataFrame:
    return spark.createDataFrame([], STATE_SCHEMA)


def severity_change(previous: Column, current: Column) -> Column:
    """up, down, or null when there was no change."""
    return (F.when(previous.isNull(), F.lit(None).cast("string"))
            .when(rank_of(current) > rank_of(previous), "up").when(rank_of(current) < rank_of(previous), "down"))


def firing_signals(signals: DataFrame) -> DataFrame:
    """Failing signals, one per (batch, name): the last one evaluated wins."""
    row = F.struct("category", "status", "value", "detail", "thresholds_source")
    return (
        signals.where(F.col("status") != OK).groupBy("batch_id", F.col("name").alias("signal_name"))
        .agg(F.max_by(row, "seq").alias("now"))
    )


def _next_run(state: DataFrame, signals: DataFrame, reconciled: DataFrame) -> DataFrame:
    opened = state.where(F.col("state") == OPEN).select(
        "batch_id", "signal_name",
        F.struct(*[c for c in state.columns if c not in ("batch_id", "signal_name")]).alias("was"))
    runs = reconciled.select("batch_id", F.lit(True).alias("in_run"))
    merged = opened.join(firing_signals(signals), ["batch_id", "signal_name"], "full").join(runs, "batch_id", "left")
    step = (
        F.when(F.col("in_run").isNull(), F.lit(None).cast("string"))
        .when(F.col("was").isNull(), NEW).when(F.col("now").isNull(), RESOLVED).otherwise(ONGOING)
    )
    # a failing signal of a batch outside this run was never reconciled and opens nothing
    return merged.withColumn("transition", step).where("was IS NOT NULL OR in_run")


def reconcile(state: DataFrame, signals: DataFrame, reconciled: DataFrame, run_id: str, at,
              model_id: str | None = None) -> Reconciled:
    """Merge one run into the open alerts of `state`. Only batches in `reconciled` can resolve an alert; the others stay as they are.

    At most one alert per (batch, signal) is open, because that pair is the join key. A resolved
    alert that fails again is NEW.
    """
    time = F.lit(at).cast("timestamp_ntz")
    run = _next_run(state, signals, reconciled)
    was, now = F.col("was"), F.col("now")
    fired = F.col("transition").isin(NEW, ONGOING)
    changed = F.coalesce(was["severity"] != now["status"], F.lit(True))
    entry = F.struct(time.alias("at"), now["status"].alias("severity"))
    history = F.when(F.col("transition") == NEW, F.array(entry)) \
        .when(fired & changed, F.array_append(was["severity_history"], entry)) \
        .otherwise(was["severity_history"])

    def current(field: str, previous: str) -> Column:
        return F.when(fired, now[field]).otherwise(was[previous])

    fields = {
        "category": F.coalesce(was["category"], now["category"]),
        "severity": current("status", "severity"),
        "state": F.when(F.col("transition") == RESOLVED, RESOLVED_STATE).otherwise(OPEN),
        "first_seen": F.coalesce(was["first_seen"], time),
        "last_seen": F.when(fired, time).otherwise(was["last_seen"]),
        "resolved_at": F.when(F.col("transition") == RESOLVED, time),
        "occurrences": F.coalesce(was["occurrences"], F.lit(0)) + F.when(fired, 1).otherwise(0),
        "last_value": F.when(fired, finite(now["value"])).otherwise(was["last_value"]),
        "last_detail": current("detail", "last_detail"),
        "thresholds_source": current("thresholds_source", "thresholds_source"),
        "model_id": F.when(F.col("transition") == NEW, F.lit(model_id)).otherwise(was["model_id"]),
        "run_id": F.when(F.col("transition") == NEW, F.lit(run_id)).otherwise(was["run_id"]),
        "severity_history": history,
    }
    rows = run.select("batch_id", "signal_name", *[c.alias(n) for n, c in fields.items()])
    rows = rows.select(*state.columns)

    transitions = run.where("transition IS NOT NULL").select(
        F.lit(run_id).alias("run_id"), "batch_id", "signal_name",
        F.when(F.col("transition") == ONGOING, now["category"]).otherwise(fields["category"]).alias("category"),
        fields["severity"].alias("severity"), "transition", fields["occurrences"].alias("occurrences"),
        fields["first_seen"].alias("first_seen"), fields["last_seen"].alias("last_seen"),
        F.when(fired, now["detail"]).otherwise("signal is back to OK").alias("detail"),
        F.when(fired, now["thresholds_source"]).otherwise("default").alias("thresholds_source"),
        F.when((F.col("transition") == ONGOING) & changed, was["severity"]).alias("escalated_from"))
    return Reconciled(rows.where(F.col("state") == OPEN), transitions, rows.where(F.col("state") == RESOLVED_STATE))


def replay(signals: DataFrame, model_id: str | None = None) -> Reconciled:
    """What reconciling a whole history run by run would give, as one plan: signals with run (its order), run_id and at.

    A batch takes part in the runs in which it has signals. For each (batch, signal) the runs from a NEW one to the
    RESOLVED one, or to the last one, are one alert.
    """
    row = F.struct("category", "status", "value", "detail", "thresholds_source")
    firing = signals.where(F.col("status") != OK).groupBy("run", "batch_id", F.col("name").alias("signal_name")).agg(
        F.max_by(row, "seq").alias("now"))
    visits = signals.select("run", "run_id", "at", "batch_id").distinct()
    seen = visits.join(firing.select("batch_id", "signal_name").distinct(), "batch_id").join(
        firing, ["run", "batch_id", "signal_name"], "left")
    line = Window.partitionBy("batch_id", "signal_name").orderBy("run")
    now, was = F.col("now").isNotNull(), F.coalesce(F.lag(F.col("now").isNotNull()).over(line), F.lit(False))
    step = F.when(now & ~was, NEW).when(now, ONGOING).when(was, RESOLVED)
    stepped = seen.withColumn("transition", step).where("transition is not null").withColumn(
        "alert", F.sum(F.when(F.col("transition") == NEW, 1).otherwise(0)).over(line))
    so_far = Window.partitionBy("batch_id", "signal_name", "alert").orderBy("run")
    fired, status = F.col("transition") != RESOLVED, F.col("now")["status"]
    previous = F.lag(status).over(so_far)
    events = stepped.withColumns({
        "occurrences": F.sum(fired.cast("bigint")).over(so_far), "first_seen": F.min("at").over(so_far),
        "last_seen": F.max(F.when(fired, F.col("at"))).over(so_far), "last": F.last("now", ignorenulls=True).over(so_far),
        "escalated_from": F.when((F.col("transition") == ONGOING) & (previous != status), previous),
        "changed": fired & (previous.isNull() | (previous != status))})
    transitions = events.select(
        "run_id", "batch_id", "signal_name", F.col("last")["category"].alias("category"),
        F.col("last")["status"].alias("severity"), "transition", "occurrences", "first_seen", "last_seen",
        F.when(fired, F.col("now")["detail"]).otherwise("signal is back to OK").alias("detail"),
        F.when(fired, F.col("now")["thresholds_source"]).otherwise("default").alias("thresholds_source"), "escalated_from")
    end = F.struct("transition", "occurrences", "first_seen", "last_seen", "last", "at")
    entry = F.struct("run", F.struct("at", status.alias("severity")).alias("entry"))
    alerts = events.groupBy("batch_id", "signal_name", "alert").agg(
        F.max_by(end, "run").alias("e"), F.min_by("run_id", "run").alias("run_id"), F.min_by(F.col("now")["category"], "run").alias("category"),
        F.array_sort(F.collect_list(F.when(F.col("changed"), entry))).alias("changes"))
    closed = F.col("e.transition") == RESOLVED
    rows = alerts.select(
        "batch_id", "signal_name", "category", F.col("e.last.status").alias("severity"),
        F.when(closed, RESOLVED_STATE).otherwise(OPEN).alias("state"), "e.first_seen", "e.last_seen",
        F.when(closed, F.col("e.at")).alias("resolved_at"), "e.occurrences", finite(F.col("e.last.value")).alias("last_value"),
        F.col("e.last.detail").alias("last_detail"),
        F.col("e.last.thresholds_source").alias("thresholds_source"), F.lit(model_id).cast("string").alias("model_id"), "run_id",
        F.transform("changes", lambda c: c["entry"]).alias("severity_history"))
    return Reconciled(rows.where(F.col("state") == OPEN), transitions, rows.where(F.col("state") == RESOLVED_STATE))


def duplicate_open_alerts(state: DataFrame) -> DataFrame:
    """Must be empty: (batch, signal) pairs with more than one open alert."""
    return state.where(F.col("state") == OPEN).groupBy("batch_id", "signal_name").count().where("count > 1")


def open_alerts(state: DataFrame, batch_id: str | None = None) -> DataFrame:
    found = state.where(F.col("state") == OPEN)
    return found.where(F.col("batch_id") == batch_id) if batch_id is not None else found


def recent_history(state: DataFrame, limit: int, batch_id: str | None = None,
                   include_resolved: bool = False) -> DataFrame:
    """Newest alerts first; the limit is the feature."""
    found = state if include_resolved else open_alerts(state)
    if batch_id is not None:
        found = found.where(F.col("batch_id") == batch_id)
    return found.orderBy(F.desc("last_seen"), "batch_id", "signal_name").limit(limit)


def _report_rank() -> Column:
    return F.when(F.col("transition") == NEW, 0).when(F.col("transition") == ONGOING, 1).otherwise(2)


def in_report_order(transitions: DataFrame) -> DataFrame:
    return transitions.orderBy("batch_id", _report_rank(), "signal_name")


def report_positions(transitions: DataFrame) -> DataFrame:
    """The place of each transition in its batch's report, from 1."""
    order = Window.partitionBy("batch_id").orderBy(_report_rank(), "signal_name")
    return transitions.withColumn("position", F.row_number().over(order))
