"""Ingest alarms and layer reconciliation as table jobs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scores import seconds_between

LAG_LIMIT_SECONDS = 60.0
PERIODS = 3


def _seconds(width: str) -> int:
    amount, unit = width.split()
    return int(amount) * {"second": 1, "minute": 60, "hour": 3600}[unit.rstrip("s")]


def _start(at: str, width: str) -> Column:
    return F.window(at, width)["start"].alias("window_start")


def dlq_volume(rejects: DataFrame, at: str = "dlq_timestamp", width: str = "5 minutes") -> DataFrame:
    """Rejects per window; any reject raises the alarm. Works on streams (set a watermark)."""
    return (
        rejects.groupBy(F.window(at, width))
        .agg(F.count(F.lit(1)).alias("n_rejects"))
        .select(F.col("window.start").alias("window_start"), "n_rejects",
                (F.col("n_rejects") > 0).alias("alarm"))
    )


def _later(df: DataFrame, width: str, periods: int) -> DataFrame:
    """Copy each window row to itself and the ``periods - 1`` windows after it."""
    step = _seconds(width)
    shifts = F.array(*[F.lit(i * step) for i in range(periods)])
    return df.withColumn("_shift", F.explode(shifts)).withColumn(
        "window_start",
        F.timestamp_seconds(F.unix_timestamp("window_start") + F.col("_shift")),
    )


def ingest_gaps(
    events: DataFrame, at: str = "timestamp", width: str = "5 minutes", periods: int = PERIODS
) -> DataFrame:
    """Every window between the first and the last event with its count; the alarm is on when
    it and the windows before it, ``periods`` in all, are empty.

    A non-empty window silences itself and the next ``periods - 1`` windows, so the alarm is
    one aggregation over the window table instead of an ordered pass in a single task.
    """
    return gaps_of_windows(events.groupBy(_start(at, width)).agg(F.count(F.lit(1)).alias("n_events")), width, periods)


def gaps_of_windows(counts: DataFrame, width: str, periods: int = PERIODS) -> DataFrame:
    """The same from the windows' counts: window_start, n_events."""
    step = _seconds(width)
    bounds = counts.agg(F.min("window_start").alias("lo"), F.max("window_start").alias("hi"))
    # Two steps, so that no row ever holds all windows of a long time range.
    blocks = bounds.filter("lo IS NOT NULL").selectExpr(
        "hi", f"explode(sequence(lo, hi, make_interval(0, 0, 0, 0, 0, 0, {step * 256}))) AS b"
    ).repartition("b")  # a long range, as after one wrong clock, is filled by many tasks
    every = blocks.selectExpr(
        f"explode(sequence(b, least(hi, b + make_interval(0, 0, 0, 0, 0, 0, {step * 255})), "
        f"make_interval(0, 0, 0, 0, 0, 0, {step}))) AS window_start",
        "0L AS n_events",
        "false AS _live",
        "true AS _own",
    )
    live = _later(counts, width, periods).select(
        "window_start",
        F.when(F.col("_shift") == 0, F.col("n_events")).otherwise(0).alias("n_events"),
        F.lit(True).alias("_live"),
        F.lit(False).alias("_own"),
    )
    return (
        every.unionByName(live)
        .groupBy("window_start")
        .agg(
            F.sum("n_events").alias("n_events"),
            F.max("_live").alias("_live"),
            F.max("_own").alias("_own"),
        )
        .filter("_own")
        .select("window_start", "n_events", (~F.col("_live")).alias("alarm"))
    )


def ingest_lag(
    bronze: DataFrame,
    event_at: str = "timestamp",
    ingested_at: str = "_ingested_at",
    width: str = "5 minutes",
    limit: float = LAG_LIMIT_SECONDS,
    periods: int = PERIODS,
) -> DataFrame:
    """Largest lag per ingestion window; the alarm needs ``periods`` adjacent windows above the
    limit. A window without data does not count as above."""
    lag = seconds_between(F.col(event_at), F.col(ingested_at))
    return lags_of_windows(bronze.groupBy(_start(ingested_at, width)).agg(F.max(lag).alias("max_lag_s")), width, limit, periods)


def lags_of_windows(worst: DataFrame, width: str, limit: float = LAG_LIMIT_SECONDS, periods: int = PERIODS) -> DataFrame:
    """The same from the windows' largest lags: window_start, max_lag_s."""
    seen = _later(worst, width, periods).groupBy("window_start").agg(
        F.count_if(F.col("max_lag_s") > limit).alias("_late"),
        F.max(F.when(F.col("_shift") == 0, F.col("max_lag_s"))).alias("max_lag_s"),
        F.max(F.col("_shift") == 0).alias("_own"),
    )
    return seen.filter("_own").select(
        "window_start", "max_lag_s", (F.col("_late") == periods).alias("alarm")
    )


#: The id in a body that may be broken, cut off or wrapped as text in another one (quotes escaped).
_ID_IN_BODY = r'(?<![A-Za-z0-9_])\\*"event_id\\*"\s*:\s*\\*"([^"\\]+)'


def dead_letter_ids(dead_letters: DataFrame, body: str = "raw_body") -> DataFrame:
    """``event_id`` of each dead letter as far as its text tells, without parsing it; else null."""
    found = F.regexp_extract(F.col(body), _ID_IN_BODY, 1)
    return dead_letters.select(F.when(F.trim(found) != "", found).alias("event_id"))


def layer_reconciliation(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per event id in every layer (one count column per layer); rows without an id together
    in one row."""
    tagged = None
    for name, df in layers.items():
        one = df.select("event_id", F.lit(name).alias("_layer"))
        tagged = one if tagged is None else tagged.unionByName(one)
    return tagged.groupBy("event_id").agg(
        *[F.count_if(F.col("_layer") == name).alias(name) for name in layers]
    )
