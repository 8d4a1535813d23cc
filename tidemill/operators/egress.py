"""Event sizes with and without the waveform, and projected egress."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scores import ratio
from tidemill.schema import EVENT_SIZE_LIMIT


def payload_bytes(
    df: DataFrame, stats: Sequence[str], waveform: str = "waveform", limit: int = EVENT_SIZE_LIMIT
) -> DataFrame:
    """UTF-8 bytes of each event's compact JSON without and with its waveform.

    ``stats`` are the columns of the event without the waveform.
    """
    bare = F.octet_length(F.to_json(F.struct(*stats))).cast("long")
    full = F.octet_length(F.to_json(F.struct(*stats, waveform))).cast("long")
    sized = df.withColumn("stats_only_bytes", bare).withColumn("stats_plus_waveform_bytes", full)
    small, large = F.col("stats_only_bytes"), F.col("stats_plus_waveform_bytes")
    return (
        sized.withColumn("waveform_bytes", large - small)
        .withColumn("waveform_share", (large - small) / large)
        .withColumn("overhead_ratio", large / small)
        .withColumn("bytes_per_sample", ratio(large - small, F.size(waveform)))
        .withColumn("within_limit", large < limit)
    )


def projected_egress(sized: DataFrame, rates: Sequence[float]) -> DataFrame:
    """Bytes sent at each escalation rate against sending every waveform.

    ``sized`` comes from ``payload_bytes``; the mean event sizes stand for every event.
    """
    totals = sized.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.avg("stats_only_bytes").alias("_small"),
        F.avg("stats_plus_waveform_bytes").alias("_large"),
    )
    n, small, large = F.col("total_events"), F.col("_small"), F.col("_large")
    rate: Column = F.col("escalation_rate")
    return (
        totals.withColumn("escalation_rate", F.explode(F.array(*[F.lit(float(r)) for r in rates])))
        .withColumn("escalated_events", F.bround(n * rate).cast("long"))
        .withColumn("static_cloud_offload_bytes", n * large)
        .withColumn("escalation_bytes", F.col("escalated_events") * large)
        .withColumn(
            "adaptive_bytes",
            (n - F.col("escalated_events")) * small + F.col("escalation_bytes"),
        )
        .withColumn("edge_only_bytes", F.lit(0).cast("long"))
        .withColumn(
            "egress_reduction_vs_static",
            F.when(
                F.col("static_cloud_offload_bytes") > 0,
                1 - F.col("adaptive_bytes") / F.col("static_cloud_offload_bytes"),
            ),
        )
        .drop("_small", "_large")
    )
