"""ASCII tracker packets to vehicle envelope rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.ids import deterministic_event_id
from tidemill.schema import BRIDGE_NAMESPACE, ENVELOPE_FIELDS

# The packet layout. A position packet starts with
# $$length,imei,command,YYMMDD,HHMMSS,latitude,N|S,longitude,E|W,knots,course,fix
POSITION_PATTERN = (
    r"^\$\$\d+,\d{14,15},[A-Z]{3},\d{6},\d{6},[\d.]+,[NS],[\d.]+,[EW],[\d.]+,[\d.]+,[01]"
)
KEEPALIVE_PATTERN = r"(?i)^\$\$\d+,[^,]+,(HBT|LOG)"
KNOT_KMH = 1.852


def _signed(value: Column, hemisphere: Column, negative: str) -> Column:
    number = value.try_cast("double")
    return F.when(hemisphere == negative, -number).otherwise(number)


def parse_tracker_packets(
    lines: DataFrame,
    body: str = "value",
    device_prefix: str = "tracker",
    received_at: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(envelope rows, rejects). Blank, keep-alive and login lines give neither.

    One pattern test decides whether the line is a position; its fields then come from one
    split. ``received_at`` (text) stands in for a device clock that is no valid time; without
    it such a packet is rejected. The id derives from the packet, so that a repeated packet
    is removed as a duplicate.
    """
    text = F.btrim(F.col(body), F.lit(" \t\n\r\f\v"))
    packets = lines.select(
        text.alias("packet"),
        (F.lit(None).cast("string") if received_at is None else received_at).alias("_received"),
    ).filter((F.col("packet") != "") & ~F.col("packet").rlike(KEEPALIVE_PATTERN))

    # ``explode`` of one array keeps the optimizer from splitting again for every field.
    parts = F.when(F.col("packet").rlike(POSITION_PATTERN), F.split("packet", ","))
    fields = packets.select("*", F.explode(F.array(parts)).alias("_p")).withColumn(
        "_ok", F.col("_p").isNotNull()
    )
    p = lambda i: F.get("_p", F.lit(i))
    clock = F.try_to_timestamp(F.concat(p(3), p(4)), F.lit("yyMMddHHmmss"))
    read = fields.select(
        "packet",
        "_ok",
        p(1).alias("imei"),
        F.coalesce(F.date_format(clock, "yyyy-MM-dd'T'HH:mm:ssXXX"), "_received").alias("time"),
        _signed(p(5), p(6), "S").alias("latitude"),
        _signed(p(7), p(8), "W").alias("longitude"),
        F.round(p(9).try_cast("double") * KNOT_KMH, 1).alias("speed_kmh"),
        p(10).try_cast("double").alias("course_deg"),
        (F.substring(p(11), 1, 1) == "1").alias("gps_valid"),
    )
    numbers = ("latitude", "longitude", "speed_kmh", "course_deg")
    reason = (
        F.when(~F.col("_ok"), "unrecognised_format")
        .when(F.greatest(*[F.col(n).isNull() for n in numbers]), "bad_number")
        .when(F.col("time").isNull(), "bad_time")
    )
    judged = read.withColumn("error_reason", reason)

    payload = F.struct(
        "imei", *numbers, "gps_valid", F.lit("tracker").alias("source"),
        F.col("packet").alias("raw_payload"),
    )
    envelope = {
        "event_id": deterministic_event_id(BRIDGE_NAMESPACE, F.lit(device_prefix), "packet"),
        "device_id": F.concat(F.lit(f"{device_prefix}-"), "imei"),
        "asset_type": F.lit("vehicle"),
        "timestamp": F.col("time"),
        "priority": F.lit("normal"),
        "schema_version": F.lit("1.0"),
        "payload": F.to_variant_object(payload),
    }
    rows = judged.filter(F.col("error_reason").isNull()).select(
        *[envelope[n].alias(n) for n in ENVELOPE_FIELDS]
    )
    rejects = judged.filter(F.col("error_reason").isNotNull()).select(
        F.col("packet").alias("raw_body"), "error_reason"
    )
    return rows, rejects
