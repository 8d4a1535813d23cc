"""Daily KPIs and evidence tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scores import (
    bucket_confidence,
    confusion_outcome,
    is_actual_anomaly,
    mean_seconds,
    ratio,
    seconds_between,
)
from tidemill.operators.ordered import MAX_ROWS_PER_TASK, OrderedRuns
from tidemill.operators.rank import grouped_quantiles
from tidemill.schema import AUTONOMOUS_MODE, UNVERSIONED
from tidemill.session import stable


def asset_health_summary(cleaned: DataFrame) -> DataFrame:
    """Events, last seen and priority counts per asset type, device and day."""
    return cleaned.groupBy(
        "asset_type", "device_id", F.date_trunc("day", "timestamp").alias("event_date")
    ).agg(
        F.count("event_id").alias("total_events"),
        F.max("timestamp").alias("last_seen_at"),
        F.count_if(F.col("priority") == "critical").alias("critical_event_count"),
        F.count_if(F.col("priority") == "high").alias("high_priority_event_count"),
    )


# -- mode transitions ---------------------------------------------------------


def time_in_previous_mode(
    modes: DataFrame, at: str = "transition_at", max_rows: int = MAX_ROWS_PER_TASK
) -> DataFrame:
    """Seconds since the device's previous transition; NULL for its first."""
    runs = OrderedRuns.of(modes, ["device_id"], [at, "event_id"], max_rows)
    return (
        runs.frame(1, _previous=lambda w: F.lag(at).over(w))
        .rows()
        .withColumn("time_in_previous_mode_s", seconds_between(F.col("_previous"), F.col(at)))
        .drop("_previous")
    )


def asof_latest(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_at: str,
    right_at: str,
    right_id: str,
    left_id: str = "event_id",
    name: str = "latest_at",
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Left rows with the latest ``right_at`` of the same key at or before ``left_at``.

    Both sides are stacked and swept once in time order with a running maximum, so the cost
    is one sort of n + m rows instead of the n * m pairs of a range join. Right rows sort
    before left rows of the same instant, which makes the bound inclusive.
    """
    columns = left.columns
    stacked = left.select(
        *columns,
        F.col(left_at).alias("_at"),
        F.lit(1).alias("_side"),
        F.col(left_id).cast("string").alias("_tie"),
        F.lit(None).cast(right.schema[right_at].dataType).alias("_seen"),
    ).unionByName(
        right.filter(F.col(right_at).isNotNull()).select(
            F.col(key),
            F.col(right_at).alias("_at"),
            F.lit(0).alias("_side"),
            F.col(right_id).cast("string").alias("_tie"),
            F.col(right_at).alias("_seen"),
        ),
        allowMissingColumns=True,
    )
    swept = OrderedRuns.of(stacked, [key], ["_at", "_side", "_tie"], max_rows).running(
        _latest=("max", F.col("_seen"))
    )
    return (
        swept.rows()
        .filter("_side = 1")
        .select(*columns, F.when(F.col(key).isNotNull(), F.col("_latest")).alias(name))
    )


def asof_latest_breach(
    modes: DataFrame, context: DataFrame, max_rows: int = MAX_ROWS_PER_TASK
) -> DataFrame:
    """Transitions with ``latest_breach_at``: the last breach sample up to the transition."""
    breaches = context.filter("is_breach_sample").select(
        "device_id", F.col("timestamp").alias("breach_at"), F.col("event_id").alias("breach_id")
    )
    return asof_latest(
        modes, breaches, "device_id", "transition_at", "breach_at", "breach_id",
        name="latest_breach_at", max_rows=max_rows,
    )


# The columns of a transition.
TRANSITION_COLUMNS = (
    "event_id",
    "device_id",
    "transition_at",
    "from_mode",
    "to_mode",
    "trigger",
    "rtt_ms",
    "cpu_pct",
    "edge_confidence",
    "breach_count",
    "policy_version",
)


def mode_history(
    orchestrator_mode: DataFrame, context_snapshot: DataFrame, max_rows: int = MAX_ROWS_PER_TASK
) -> DataFrame:
    """Every transition with the time in the mode it leaves and its switch latency."""
    modes = orchestrator_mode.withColumn("transition_at", F.col("timestamp")).select(
        *TRANSITION_COLUMNS
    )
    timed = time_in_previous_mode(modes, max_rows=max_rows)
    return asof_latest_breach(timed, context_snapshot, max_rows).withColumn(
        "mode_switch_latency_s",
        seconds_between(F.col("latest_breach_at"), F.col("transition_at")),
    )


def mode_trigger_breakdown(history: DataFrame) -> DataFrame:
    """Transitions per trigger and mode pair."""
    return history.groupBy("trigger", "from_mode", "to_mode").agg(
        F.count(F.lit(1)).alias("n_transitions"),
        mean_seconds(F.col("time_in_previous_mode_s")).alias("avg_time_in_previous_mode_s"),
        mean_seconds(F.col("mode_switch_latency_s")).alias("avg_mode_switch_latency_s"),
        F.max("mode_switch_latency_s").alias("max_mode_switch_latency_s"),
    )


# -- detection quality --------------------------------------------------------


def with_outcome(inference: DataFrame, null_policy: str = "tn") -> DataFrame:
    """Add ``is_actual_anomaly`` and ``outcome``; ``null_policy='exclude'`` drops unknown rows
    instead of counting them as TN."""
    labelled = inference.withColumn(
        "is_actual_anomaly", is_actual_anomaly(F.col("ground_truth_label"))
    )
    if null_policy == "exclude":
        labelled = labelled.dropna(subset=["anomaly", "is_actual_anomaly"])
    elif null_policy != "tn":
        raise ValueError(f"unknown null policy {null_policy!r}")
    return labelled.withColumn(
        "outcome", confusion_outcome(F.col("anomaly"), F.col("is_actual_anomaly"))
    )


def _with_quantiles(
    counted: DataFrame, keys: list[str], column: str, shares: dict[str, float], count: str, max_rows: int
) -> DataFrame:
    """Sums of ``counted``, a table of counts by keys and value, with exact quantiles of the values."""
    sums = [F.sum(c).alias(c) for c in counted.columns if c not in (*keys, column)]
    found = grouped_quantiles(counted, keys, column, shares, count, max_rows)
    found = found.select(*[F.col(k).alias(f"_of_{k}") for k in keys], *shares)
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    return counted.groupBy(*keys).agg(*sums).join(found, same).drop(*[f"_of_{k}" for k in keys])


def detection_performance(
    inference: DataFrame, null_policy: str = "tn", max_rows: int = MAX_ROWS_PER_TASK
) -> DataFrame:
    """Confusion counts, exact latency percentiles, precision, recall and F1 per mode and model.

    Rows are counted by latency too, once; everything else is worked out from those counts."""
    outcome = F.col("outcome")
    version = F.coalesce("model_version", F.lit(UNVERSIONED)).alias("model_version")
    counted = stable(
        with_outcome(inference, null_policy)
        .groupBy("mode", version, "infer_ms")
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            *[F.count_if(outcome == o.upper()).alias(o) for o in ("tp", "fp", "fn", "tn")],
        )
    )
    shares = {"infer_ms_p50": 0.5, "infer_ms_p99": 0.99}
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    precision, recall = F.col("precision"), F.col("recall")
    return (
        _with_quantiles(counted, ["mode", "model_version"], "infer_ms", shares, "n_events", max_rows)
        .withColumn("precision", ratio(tp, tp + fp))
        .withColumn("recall", ratio(tp, tp + fn))
        .withColumn("f1", ratio(2 * precision * recall, precision + recall))
    )


# -- runs of one state --------------------------------------------------------


def sessions_by_state(
    df: DataFrame,
    key: str,
    at: str,
    state: str,
    tie: str = "event_id",
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Number the runs of consecutive equal states per key (``window_id``, from 1) and add the
    gap in seconds to the row before, whatever its state."""
    runs = OrderedRuns.of(df, [key], [at, tie], max_rows).frame(
        1,
        _before=lambda w: F.lag(F.struct(F.col(at).alias("at"), F.col(state).alias("state"))).over(w),
    )
    changed = F.col("_before").isNull() | ~F.col("_before.state").eqNullSafe(F.col(state))
    return (
        runs.running(window_id=("sum", changed.cast("long")))
        .rows()
        .withColumn("gap_s", seconds_between(F.col("_before.at"), F.col(at)))
        .drop("_before")
    )


def edge_autonomy(
    inference: DataFrame, state: str = AUTONOMOUS_MODE, max_rows: int = MAX_ROWS_PER_TASK
) -> DataFrame:
    """Event counts and gaps of every stretch a device spent in ``state``."""
    events = inference.select(
        "event_id", "device_id", "mode", F.col("timestamp").alias("event_at"), "anomaly"
    )
    return (
        sessions_by_state(events, "device_id", "event_at", "mode", max_rows=max_rows)
        .filter(F.col("mode") == state)
        .groupBy("device_id", "window_id")
        .agg(
            F.min("event_at").alias("window_started_at"),
            F.max("event_at").alias("window_ended_at"),
            F.count(F.lit(1)).alias("n_events_during_outage"),
            F.count_if("anomaly").alias("n_anomalies_during_outage"),
            F.max("gap_s").alias("largest_inter_event_gap_s"),
            mean_seconds(F.col("gap_s")).alias("avg_inter_event_gap_s"),
        )
        .withColumn(
            "outage_duration_s",
            seconds_between(F.col("window_started_at"), F.col("window_ended_at")),
        )
    )


# -- egress and escalation ----------------------------------------------------


def cloud_egress(inference: DataFrame) -> DataFrame:
    """Events landed per device and mode against the device's own processed total.

    The device total is the maximum over its few mode rows, so it needs neither a second scan
    nor a join.
    """
    by_mode = inference.groupBy("device_id", "mode").agg(
        F.count(F.lit(1)).alias("events_landed_in_cloud"),
        F.max("stats_total").alias("max_stats_total_in_mode"),
        F.min("timestamp").alias("first_seen_at"),
        F.max("timestamp").alias("last_seen_at"),
    )
    total = F.expr("max(max_stats_total_in_mode) OVER (PARTITION BY device_id)")
    return by_mode.withColumn("total_events_processed_by_orchestrator", total).withColumn(
        "pct_of_processed_events_landed_in_cloud",
        ratio(F.col("events_landed_in_cloud"), F.col("total_events_processed_by_orchestrator")),
    )


def _known_and_true(name: str, agreement: Column) -> list[Column]:
    return [F.count(agreement).alias(f"_n_{name}"), F.count_if(agreement).alias(f"_true_{name}")]


def escalation_efficacy(
    inference: DataFrame, validation: DataFrame, max_rows: int = MAX_ROWS_PER_TASK
) -> DataFrame:
    """Agreement and accuracy of device and second opinion per mode and confidence bucket, with
    the exact median latency of the second opinions."""
    edge = inference.select(
        F.col("event_id").alias("source_event_id"),
        "mode",
        "anomaly",
        bucket_confidence(F.col("edge_confidence")).alias("edge_confidence_bucket"),
        is_actual_anomaly(F.col("ground_truth_label")).alias("_actual"),
    )
    cloud = validation.select(
        "source_event_id", "cloud_anomaly", "agrees_with_edge", "validation_latency_ms"
    )
    rates = {
        "agreement_rate": F.col("agrees_with_edge"),
        "edge_accuracy": F.col("anomaly") == F.col("_actual"),
        "cloud_accuracy": F.col("cloud_anomaly") == F.col("_actual"),
    }
    keys, latency = ["mode", "edge_confidence_bucket"], "validation_latency_ms"
    counted = stable(
        edge.join(cloud, "source_event_id")
        .groupBy(*keys, latency)
        .agg(
            F.count(F.lit(1)).alias("n_escalations"),
            *[c for name, agreement in rates.items() for c in _known_and_true(name, agreement)],
        )
    )
    summed = _with_quantiles(counted, keys, latency, {f"{latency}_p50": 0.5}, "n_escalations", max_rows)
    return summed.select(
        *keys,
        "n_escalations",
        *[ratio(F.col(f"_true_{name}"), F.col(f"_n_{name}")).alias(name) for name in rates],
        f"{latency}_p50",
    ).withColumn("cloud_accuracy_improvement", F.col("cloud_accuracy") - F.col("edge_accuracy"))
