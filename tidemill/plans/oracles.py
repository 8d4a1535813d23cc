"""The queries again as ANSI SQL, for an independent check."""

from __future__ import annotations

from tidemill.plans import bindings as b
from tidemill.plans.bindings import GIVEN_TREES

EV = (
    "ev AS (SELECT event_id, ts, user_id, event_type, value, "
    "CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"
)


def _bound(name: str, columns: dict[str, str]) -> str:
    listed = ", ".join(f"{e} AS {n}" for n, e in columns.items())
    return f'{name} AS (SELECT ts AS "timestamp", {listed} FROM ev)'


TELE = EV + ", " + _bound("telemetry", b.TELEMETRY)
SENSOR = EV + ", " + _bound("sensor", b.SENSOR)
RAW = f"""{EV}, base AS (
  SELECT event_id, user_id, event_type, k, CAST(round(value * 100) AS BIGINT) AS cents,
         event_id % 17 AS d, ts AS received_at,
         strftime(CASE WHEN event_id % 17 = 13 THEN ts - INTERVAL 30 DAY ELSE ts END,
                  '%Y-%m-%dT%H:%M:%SZ') AS t,
         date_trunc('second', CASE WHEN event_id % 17 = 13 THEN ts - INTERVAL 30 DAY ELSE ts END) AS at_
  FROM ev),
copies AS (SELECT *, 0 AS c FROM base UNION ALL SELECT *, 1 AS c FROM base WHERE d = 11),
raw AS (
  SELECT *, 'e-' || event_id AS eid, CASE WHEN d = 14 THEN '  ' ELSE 'dev-' || user_id END AS device_id,
         {b.ASSET} AS asset_type,
         CASE WHEN d = 4 THEN 'not-a-real-timestamp' ELSE t END AS "timestamp",
         CASE WHEN d = 10 THEN 'high' ELSE 'normal' END AS priority,
         CASE WHEN d = 10 THEN '2.0.0' ELSE '1.0.0' END AS schema_version,
         'file-' || c AS _source_file,
         {b.BODY} AS body,
         CASE d WHEN 0 THEN 'missing:event_id' WHEN 1 THEN 'empty:event_id'
                WHEN 2 THEN 'extra:unexpected_field' WHEN 3 THEN 'type:payload'
                WHEN 8 THEN 'invalid_json' WHEN 9 THEN 'type:priority' END AS reason
  FROM copies),
bronze AS (SELECT * FROM raw WHERE reason IS NULL),
cleaned AS (SELECT * FROM bronze WHERE d NOT IN (4, 14) AND NOT (d = 11 AND c = 0))"""

ENVELOPE = 'eid AS event_id, device_id, asset_type, "timestamp", priority, schema_version'
CLEAN_ENVELOPE = ENVELOPE.replace('"timestamp"', 'at_ AS "timestamp"')

NAMESPACE_HEX = "6f1b3c2a6e6a4b1a9a7a2b8f6b8b8a2e"
VALIDATION_HEX = "9a2f4c6e3b1d4a8e9c7f1d2e3f4a5b6c"


def _uuid5(namespace: str, key: str) -> str:
    """RFC 4122 version 5 over a key expression: digest first, then the dashes."""
    h = f"sha1(unhex('{namespace}') || encode({key}))"
    return (
        f"(SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || "
        f"substr('89ab', (strpos('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1, 1) || "
        f"substr(h, 18, 3) || '-' || substr(h, 21, 12) FROM (SELECT {h} AS h))"
    )


RECORDS = f"""{EV}, r AS (
  SELECT event_id AS seq, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS t, 'dev-' || user_id AS device,
         event_id % 11 = 0 AS lacking, {b.TELEMETRY['ground_truth_label']} AS label,
         value > 60 AS anomaly, k >= 80 AS breach FROM ev)"""


def _translated(asset: str, key: str, priority: str, extra: str, keep: str = "NOT lacking") -> str:
    return f"""WITH {RECORDS}
SELECT {_uuid5(NAMESPACE_HEX, key)} AS event_id, device AS device_id, '{asset}' AS asset_type,
       t AS "timestamp", {priority} AS priority, '1.0.0' AS schema_version, {extra}
FROM r WHERE {keep}"""


HEARTBEATS = f"""WITH RECURSIVE {EV}, s AS (
  SELECT event_id, 'dev-' || user_id AS device_id, ts, k >= 95 AS breach,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM ev),
w AS (
  SELECT *, ts AS last, TRUE AS kept FROM s WHERE rn = 1
  UNION ALL
  SELECT s.*, CASE WHEN s.breach OR epoch_us(s.ts) - epoch_us(w.last) >= 86400000000 THEN s.ts
                   ELSE w.last END,
         s.breach OR epoch_us(s.ts) - epoch_us(w.last) >= 86400000000
  FROM w JOIN s ON s.device_id = w.device_id AND s.rn = w.rn + 1)
SELECT event_id, device_id, ts AS "timestamp", breach FROM w WHERE kept"""

PACKETS = f"""{EV}, p AS (
  SELECT *, event_id % 13 AS d, '8652800' || lpad(CAST(user_id AS STRING), 8, '0') AS imei,
         CASE WHEN k % 2 = 0 THEN 'N' ELSE 'S' END AS ns,
         CASE WHEN k % 3 = 0 THEN 'E' ELSE 'W' END AS ew FROM ev)"""

TRANSITIONS = f"""{TELE}, modes AS (
  SELECT CAST(event_id AS STRING) AS event_id, 'dev-' || user_id AS device_id, ts AS transition_at,
         'M' || (k % 3) AS from_mode, 'M' || (k % 2) AS to_mode, 'T' || (k % 5) AS trigger,
         value AS rtt_ms, CAST(k AS DOUBLE) AS cpu_pct,
         CASE WHEN k % 10 <> 0 THEN k / 100.0 END AS edge_confidence, k AS breach_count,
         'p1' AS policy_version,
         (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1e6
           AS in_previous
  FROM ev WHERE event_type = 'purchase'),
breaches AS (SELECT DISTINCT device_id, "timestamp" AS breach_at FROM telemetry WHERE is_breach_sample),
history AS (
  SELECT m.*, x.breach_at, (epoch_us(m.transition_at) - epoch_us(x.breach_at)) / 1e6 AS latency
  FROM modes m ASOF LEFT JOIN breaches x
    ON m.device_id = x.device_id AND m.transition_at >= x.breach_at)"""

OUTCOME = (
    "CASE WHEN anomaly AND ground_truth_label <> 'normal' THEN 'TP' WHEN anomaly THEN 'FP' "
    "WHEN ground_truth_label <> 'normal' THEN 'FN' ELSE 'TN' END"
)
#: An unknown prediction or label counts as TN.
OUTCOME_UNKNOWN_TN = f"CASE WHEN anomaly IS NULL OR ground_truth_label IS NULL THEN 'TN' ELSE {OUTCOME} END"


def _performance(outcome: str) -> str:
    return f"""WITH {TELE}, o AS (
  SELECT *, {outcome} AS outcome, coalesce(model_version, 'unversioned') AS version FROM telemetry),
g AS (
  SELECT mode, version AS model_version, count(*) AS n_events,
         count(*) FILTER (outcome = 'TP') AS tp, count(*) FILTER (outcome = 'FP') AS fp,
         count(*) FILTER (outcome = 'FN') AS fn, count(*) FILTER (outcome = 'TN') AS tn,
         quantile_disc(infer_ms, 0.5) AS infer_ms_p50, quantile_disc(infer_ms, 0.99) AS infer_ms_p99
  FROM o GROUP BY mode, version),
pr AS (SELECT *, tp / nullif(CAST(tp + fp AS DOUBLE), 0) AS p, tp / nullif(CAST(tp + fn AS DOUBLE), 0) AS r FROM g)
SELECT mode, model_version, n_events, tp, fp, fn, tn, round(infer_ms_p50, 6) AS infer_ms_p50,
       round(infer_ms_p99, 6) AS infer_ms_p99, round(p, 6) AS "precision", round(r, 6) AS recall,
       round(2 * p * r / nullif(p + r, 0), 6) AS f1 FROM pr"""


SESSIONS = f"""{TELE}, steps AS (
  SELECT *, lag("timestamp") OVER w AS before,
         CASE WHEN row_number() OVER w = 1 OR mode IS DISTINCT FROM lag(mode) OVER w THEN 1 ELSE 0 END
           AS changed
  FROM telemetry WINDOW w AS (PARTITION BY device_id ORDER BY "timestamp", event_id)),
sessions AS (
  SELECT *, (epoch_us("timestamp") - epoch_us(before)) / 1e6 AS gap,
         CAST(sum(changed) OVER (PARTITION BY device_id ORDER BY "timestamp", event_id
              ROWS UNBOUNDED PRECEDING) AS BIGINT) AS window_id FROM steps)"""

BUCKET = (
    "CASE WHEN edge_confidence IS NULL THEN 'unknown' WHEN edge_confidence < 0.5 THEN 'low' "
    "WHEN edge_confidence < 0.8 THEN 'medium' ELSE 'high' END"
)

VALIDATIONS = (
    "validations AS (SELECT CAST(event_id AS STRING) AS source_event_id, k > 40 AS cloud_anomaly, "
    "(k > 40) = (value > 60) AS agrees, value AS latency FROM ev "
    "WHERE event_type = 'click' AND event_id % 2 = 0)"
)
PENDING = f"""{TELE}, {VALIDATIONS}, pending AS (
  SELECT * FROM telemetry WHERE mode = 'HYBRID'
  AND event_id NOT IN (SELECT source_event_id FROM validations))"""


def _split(source: str, name: str = "split") -> str:
    """Recordings of a relation with rank, total and split, the cases written out one by one."""
    return f"""{name} AS (
  SELECT *, CASE
    WHEN ground_truth_label <> 'normal' THEN
      CASE WHEN (rank - 1) / CAST(total AS DOUBLE) < 0.5 THEN 'VALIDATION' ELSE 'TEST' END
    WHEN total = 1 THEN 'TRAIN'
    WHEN total = 2 THEN CASE rank WHEN 1 THEN 'TRAIN' ELSE 'VALIDATION' END
    WHEN total = 3 THEN CASE rank WHEN 1 THEN 'TRAIN' WHEN 2 THEN 'VALIDATION' ELSE 'TEST' END
    WHEN total = 4 THEN CASE rank WHEN 1 THEN 'TRAIN' WHEN 2 THEN 'TRAIN' WHEN 3 THEN 'VALIDATION'
                                  ELSE 'TEST' END
    WHEN (rank - 1) / CAST(total AS DOUBLE) < 0.6 THEN 'TRAIN'
    WHEN (rank - 1) / CAST(total AS DOUBLE) < 0.8 THEN 'VALIDATION'
    ELSE 'TEST' END AS dataset_split
  FROM (SELECT source_file, ground_truth_label,
               row_number() OVER (PARTITION BY ground_truth_label ORDER BY source_file) AS rank,
               count(*) OVER (PARTITION BY ground_truth_label) AS total
        FROM (SELECT DISTINCT source_file, ground_truth_label FROM {source})))"""


VALID = (
    "valid AS (SELECT * FROM sensor WHERE rms IS NOT NULL AND kurtosis IS NOT NULL)"
)
MISSING = (
    "nullif(concat_ws(',', CASE WHEN rms IS NULL THEN 'rms' END, "
    "CASE WHEN kurtosis IS NULL THEN 'kurtosis' END), '')"
)
TREND = f"""{SENSOR}, {VALID}, trends AS (
  SELECT *, avg(rms) OVER w5 AS m5, coalesce(stddev_samp(rms) OVER w5, 0) AS s5,
         coalesce(rms - lag(rms) OVER w, 0) AS d1, avg(kurtosis) OVER w5 AS k5,
         row_number() OVER w AS pos
  FROM valid
  WINDOW w AS (PARTITION BY source_file ORDER BY window_idx),
         w5 AS (PARTITION BY source_file ORDER BY window_idx ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))"""
TREND_COLUMNS = (
    "round(m5, 6) AS rms_roll_mean_5, round(s5, 6) AS rms_roll_std_5, round(d1, 6) AS rms_delta_1, "
    "round(k5, 6) AS kurtosis_roll_mean_5, pos AS window_position, pos >= 5 AS trend_window_complete"
)

SAMPLES = """samples AS (
  SELECT 'part-' || l_partkey AS source_file, l_quantity AS value,
         row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey,
                            l_extendedprice, l_quantity) - 1 AS i
  FROM lineitem),
windows AS (
  SELECT source_file, i // 16 AS window_idx, avg(value) AS mean,
         string_agg(CAST(CAST(value AS INTEGER) AS STRING), ',' ORDER BY i) AS text,
         sqrt(avg(value * value)) AS rms, max(abs(value)) AS peak, var_pop(value) AS variance,
         avg(abs(value)) AS mean_abs
  FROM samples GROUP BY source_file, i // 16 HAVING count(*) = 16),
moments AS (
  SELECT s.source_file, s.i // 16 AS window_idx, avg(pow(s.value - w.mean, 2)) AS m2,
         avg(pow(s.value - w.mean, 3)) AS m3, avg(pow(s.value - w.mean, 4)) AS m4
  FROM samples s JOIN windows w ON s.source_file = w.source_file AND s.i // 16 = w.window_idx
  GROUP BY s.source_file, s.i // 16),
featured AS (
  SELECT *, CASE WHEN m2 > 0 THEN m3 / pow(m2, 1.5) END AS skew,
         CASE WHEN m2 > 0 THEN m4 / (m2 * m2) - 3 END AS kurtosis,
         CASE WHEN rms > 0 THEN peak / rms ELSE 0 END AS crest
  FROM windows JOIN moments USING (source_file, window_idx))"""

FEATURE_LIST = ", ".join(
    f"round({c}, 6) AS {c}" for c in ("rms", "peak", "crest", "kurtosis", "skew", "variance", "mean_abs")
)

SWEEP = """per AS (
  SELECT score, count(*) FILTER (actual) AS pos, count(*) FILTER (NOT actual) AS neg
  FROM scored GROUP BY score),
cum AS (
  SELECT score, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
         CAST(sum(pos) OVER () AS BIGINT) AS p_all, CAST(sum(neg) OVER () AS BIGINT) AS n_all
  FROM per WINDOW w AS (ORDER BY score DESC)),
rated AS (
  SELECT score, tp, fp, p_all - tp AS fn, n_all - fp AS tn,
         CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0 END AS p,
         CASE WHEN p_all > 0 THEN tp / CAST(p_all AS DOUBLE) ELSE 0 END AS r FROM cum),
best AS (
  SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM rated
  ORDER BY f DESC, p DESC, r DESC, score ASC LIMIT 1)"""

SIZED = f"""{EV}, sized AS (
  SELECT event_id, k,
         strlen('{{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"'
                || event_type || '","k":' || k || '}}') AS small,
         strlen(array_to_string(range(1, k + 2), ',')) + strlen(',"waveform":[]') AS wave
  FROM ev)"""

_REJECT = "d IN (0, 1, 2, 3, 8, 9)"


def _time_windows(source: str, at: str, seconds: int) -> str:
    return f"SELECT time_bucket(INTERVAL {seconds} SECOND, {at}, TIMESTAMP '1970-01-01') AS w, * FROM {source}"


ORACLES: dict[str, str] = {
    "envelope_valid": f"WITH {RAW} SELECT {ENVELOPE}, _source_file FROM bronze",
    "envelope_rejects": f"WITH {RAW} SELECT body AS raw_body, reason AS error_reason FROM raw WHERE {_REJECT}",
    "envelope_defaults": f"""WITH {RAW} SELECT priority, schema_version, d = 12 AS empty_payload,
        count(*) AS n FROM bronze GROUP BY ALL""",
    "dead_letter_records": f"""WITH {RAW} SELECT body AS raw_body, reason AS error_reason,
        received_at AS dlq_timestamp FROM raw WHERE {_REJECT}""",
    "dead_letter_replay": f"""WITH {RAW} SELECT CASE WHEN d = 9 THEN eid END AS event_id,
        CASE WHEN d = 9 THEN 'low' END AS priority,
        CASE WHEN d = 9 THEN 'recovered' ELSE reason END AS outcome FROM raw WHERE {_REJECT}""",
    "landing_roundtrip": f"""WITH {RAW} SELECT {ENVELOPE},
        CASE WHEN event_type IN ('view', 'click') AND d <> 12 THEN event_id END AS seq FROM bronze""",
    "stream_ingest_availablenow": f"WITH {RAW} SELECT {ENVELOPE} FROM bronze",
    "table_scan": """SELECT l_orderkey, l_linenumber, round(l_quantity, 6) AS l_quantity FROM lineitem
        WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_quantity > 45""",
    "published_table": _performance(OUTCOME_UNKNOWN_TN),
    "compacted_table_equals_source": """SELECT event_id, user_id, ts AS "timestamp",
        round(value, 6) AS value FROM events""",
    "deterministic_event_ids": f"""SELECT event_id,
        {_uuid5(NAMESPACE_HEX, "'é:' || event_type || ':' || user_id || ':' || event_id")} AS uuid
        FROM events""",
    "translate_sensor_records": _translated(
        "bearing_sensor", "'sensors.bearing:' || device || ':' || seq || ':' || t",
        "CASE WHEN label = 'normal' THEN 'normal' ELSE 'high' END", "label"),
    "translate_inference_records": _translated(
        "bearing_inference", "'inference.bearing:' || device || ':' || seq || ':' || t",
        "CASE WHEN anomaly THEN 'high' ELSE 'normal' END", "anomaly"),
    "translate_mode_records": _translated(
        "orchestrator_mode", "'orchestrator.mode:' || device || ':A:B:' || t", "'high'",
        "'B' AS to_mode"),
    "translate_context_records": _translated(
        "context_snapshot", "'context.snapshot:' || device || ':' || t", "'normal'",
        "breach AS is_breach_sample", "TRUE"),
    "malformed_raw_rejects": """SELECT 'missing:' || f AS error_reason, count(*) AS n
        FROM events, (VALUES ('label'), ('anomaly'), ('from_mode')) v(f)
        WHERE event_id % 11 = 0 GROUP BY f""",
    "heartbeat_downsampled": HEARTBEATS,
    "stream_heartbeats": HEARTBEATS,
    "tracker_packets": f"""WITH {PACKETS} SELECT 'tracker-' || imei AS device_id,
        strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp", imei,
        round(CASE WHEN ns = 'S' THEN -(k + 0.5) ELSE k + 0.5 END, 6)::DOUBLE AS latitude,
        round(CASE WHEN ew = 'W' THEN -(user_id + 0.25) ELSE user_id + 0.25 END, 6)::DOUBLE AS longitude,
        round(k * 1.852::DOUBLE, 1) AS speed_kmh, CAST(k AS DOUBLE) AS course_deg, k % 2 = 1 AS gps_valid
        FROM p WHERE d > 4""",
    "tracker_rejects": f"""WITH {PACKETS} SELECT CASE d WHEN 3 THEN 'junk-' || event_id ELSE
        '$$76,' || imei || ',AAA,' || strftime(ts, '%y%m%d,%H%M%S') || ',' || k || '.5.5,' || ns || ',' ||
        user_id || '.25,' || ew || ',' || k || '.0,' || k || ',' || (k % 2) || ',12,1.2*AB' END AS raw_body,
        CASE d WHEN 3 THEN 'unrecognised_format' ELSE 'bad_number' END AS error_reason
        FROM p WHERE d IN (3, 4)""",
    "expectations_summary": f"""WITH {TELE}
        SELECT 'has_confidence' AS expectation, count(*) AS checked,
               count(*) FILTER (edge_confidence IS NULL) AS broken FROM telemetry
        UNION ALL SELECT 'confident', count(*),
               count(*) FILTER (edge_confidence IS NULL OR edge_confidence < 0.5) FROM telemetry
        UNION ALL SELECT 'fast', count(*), count(*) FILTER (infer_ms >= 100) FROM telemetry
        UNION ALL SELECT 'known_mode', count(*), 0 FROM telemetry""",
    "clean_events_table": f"WITH {RAW} SELECT {CLEAN_ENVELOPE}, _source_file FROM cleaned",
    "dedup_latest_rows": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
        round(l_quantity, 6) AS l_quantity, round(l_extendedprice, 6) AS l_extendedprice,
        round(l_discount, 6) AS l_discount, round(l_tax, 6) AS l_tax, l_returnflag, l_linestatus,
        l_shipdate FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
        l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1""",
    "quarantine_events_table": f"""WITH {RAW} SELECT eid AS event_id, device_id, "timestamp",
        CASE d WHEN 4 THEN 'null_timestamp' ELSE 'invalid_device_id' END AS reasons
        FROM bronze WHERE d IN (4, 14)""",
    "flatten_payload_table": f"""WITH {RAW} SELECT eid AS event_id, device_id, at_ AS "timestamp",
        CASE WHEN d <> 12 THEN event_id END AS seq,
        CASE WHEN d <> 12 THEN 'rec-' || user_id || '.mat' END AS source_file,
        CASE WHEN d <> 12 THEN 'normal' END AS ground_truth_label,
        CASE WHEN d <> 12 THEN k END AS window_idx,
        CASE WHEN d NOT IN (6, 7, 12) THEN CAST(cents AS DOUBLE) END AS rms,
        CASE WHEN d <> 12 THEN CAST(k AS DOUBLE) END AS peak, CAST(NULL AS DOUBLE) AS crest,
        CAST(NULL AS BIGINT) AS sampling_rate_hz
        FROM cleaned WHERE asset_type = 'bearing_sensor'""",
    "flatten_all_types": f"""WITH {RAW} SELECT CASE asset_type
          WHEN 'bearing_sensor' THEN 'silver_bearing_sensor_telemetry'
          WHEN 'bearing_inference' THEN 'silver_bearing_inference_results'
          WHEN 'orchestrator_mode' THEN 'silver_orchestrator_mode'
          WHEN 'context_snapshot' THEN 'silver_context_snapshot'
          ELSE 'silver_vehicle_telemetry' END AS silver_table, eid AS event_id,
        CAST(CASE WHEN d = 12 THEN 0 ELSE
          CASE asset_type WHEN 'bearing_sensor' THEN 6 WHEN 'context_snapshot' THEN 2 ELSE 4 END
          - CASE WHEN d IN (6, 7) THEN 1 ELSE 0 END END AS BIGINT) AS filled
        FROM cleaned WHERE asset_type <> 'mystery_sensor'""",
    "medallion_gold_counts": f"""WITH {RAW}, of AS (SELECT * FROM cleaned WHERE asset_type <> 'mystery_sensor')
        SELECT 'asset_health_summary' AS gold_table,
          count(DISTINCT (asset_type, device_id, date_trunc('day', at_))) AS n FROM cleaned
        UNION ALL SELECT 'mode_history', count(*) FILTER (asset_type = 'orchestrator_mode') FROM of
        UNION ALL SELECT 'detection_performance', count(DISTINCT asset_type) FILTER (asset_type = 'bearing_inference') FROM of
        UNION ALL SELECT 'cloud_egress', count(DISTINCT device_id) FILTER (asset_type = 'bearing_inference') FROM of
        UNION ALL SELECT 'bearing_ml_features_quarantine', count(*) FILTER (asset_type = 'bearing_sensor') FROM of
        UNION ALL SELECT unnest(['edge_autonomy', 'escalation_efficacy', 'bearing_ml_features']), 0""",
    "layer_reconciliation": f"""WITH {RAW} SELECT CASE WHEN d > 1 THEN eid END AS event_id,
        count(*) FILTER (reason IS NOT NULL) AS dead_letters,
        count(*) FILTER (reason IS NULL) AS bronze,
        count(*) FILTER (reason IS NULL AND d NOT IN (4, 14)) AS valid,
        count(DISTINCT CASE WHEN reason IS NULL AND d NOT IN (4, 14) THEN 1 END) AS cleaned,
        count(*) FILTER (reason IS NULL AND d IN (4, 14)) AS quarantined,
        count(DISTINCT CASE WHEN reason IS NULL AND d NOT IN (4, 14) AND asset_type = 'bearing_sensor' THEN 1 END)
          AS flattened FROM raw GROUP BY 1""",
    "asset_health_summary": f"""WITH {TELE} SELECT asset_type, device_id,
        date_trunc('day', "timestamp") AS event_date, count(*) AS total_events,
        max("timestamp") AS last_seen_at, count(*) FILTER (priority = 'critical') AS critical_event_count,
        count(*) FILTER (priority = 'high') AS high_priority_event_count
        FROM telemetry GROUP BY 1, 2, 3""",
    "time_in_previous_mode": f"""WITH {TRANSITIONS} SELECT event_id, device_id, transition_at,
        round(in_previous, 6) AS time_in_previous_mode_s FROM modes""",
    "asof_latest_breach": f"""WITH {TRANSITIONS} SELECT event_id, device_id, transition_at,
        breach_at AS latest_breach_at FROM history""",
    "mode_history": f"""WITH {TRANSITIONS} SELECT event_id, device_id, transition_at, from_mode,
        to_mode, trigger, round(rtt_ms, 6) AS rtt_ms, round(cpu_pct, 6) AS cpu_pct,
        round(CAST(edge_confidence AS DOUBLE), 6) AS edge_confidence, breach_count, policy_version,
        round(in_previous, 6) AS time_in_previous_mode_s, breach_at AS latest_breach_at,
        round(latency, 6) AS mode_switch_latency_s FROM history""",
    "mode_trigger_breakdown": f"""WITH {TRANSITIONS} SELECT trigger, from_mode, to_mode,
        count(*) AS n_transitions, CAST((2 * sum(round(in_previous * 1e6)::BIGINT) + count(in_previous)) // (2 * count(in_previous)) / 1e6 AS DOUBLE) AS avg_time_in_previous_mode_s,
        CAST((2 * sum(round(latency * 1e6)::BIGINT) + count(latency)) // (2 * count(latency)) / 1e6 AS DOUBLE) AS avg_mode_switch_latency_s,
        round(max(latency), 6) AS max_mode_switch_latency_s FROM history GROUP BY 1, 2, 3""",
    "confusion_outcome": f"WITH {TELE} SELECT event_id, mode, {OUTCOME} AS outcome FROM telemetry",
    "detection_performance": _performance(OUTCOME),
    "state_sessions": f"""WITH {SESSIONS} SELECT event_id, device_id, mode, window_id,
        round(gap, 6) AS gap_s FROM sessions""",
    "edge_autonomy": f"""WITH {SESSIONS} SELECT device_id, window_id,
        min("timestamp") AS window_started_at, max("timestamp") AS window_ended_at,
        count(*) AS n_events_during_outage, count(*) FILTER (anomaly) AS n_anomalies_during_outage,
        round(max(gap), 6) AS largest_inter_event_gap_s, CAST((2 * sum(round(gap * 1e6)::BIGINT) + count(gap)) // (2 * count(gap)) / 1e6 AS DOUBLE) AS avg_inter_event_gap_s,
        round((epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / 1e6, 6) AS outage_duration_s
        FROM sessions WHERE mode = 'EDGE_AUTONOMOUS' GROUP BY 1, 2""",
    "cloud_egress": f"""WITH {TELE}, total AS (
        SELECT device_id, max(stats_total) AS total FROM telemetry GROUP BY device_id)
        SELECT device_id, mode, count(*) AS events_landed_in_cloud,
        max(stats_total) AS max_stats_total_in_mode, min("timestamp") AS first_seen_at,
        max("timestamp") AS last_seen_at, total AS total_events_processed_by_orchestrator,
        round(count(*) / CAST(total AS DOUBLE), 6) AS pct_of_processed_events_landed_in_cloud
        FROM telemetry LEFT JOIN total USING (device_id) GROUP BY device_id, mode, total""",
    "confidence_buckets": f"""WITH {TELE} SELECT mode, {BUCKET} AS bucket, count(*) AS n
        FROM telemetry GROUP BY 1, 2""",
    "escalation_efficacy": f"""WITH {TELE}, {VALIDATIONS}, j AS (
        SELECT *, {BUCKET} AS bucket, anomaly = (ground_truth_label <> 'normal') AS edge_ok,
               cloud_anomaly = (ground_truth_label <> 'normal') AS cloud_ok
        FROM telemetry JOIN validations ON event_id = source_event_id)
        SELECT mode, bucket AS edge_confidence_bucket, count(*) AS n_escalations,
        round(avg(agrees::INT), 6) AS agreement_rate, round(avg(edge_ok::INT), 6) AS edge_accuracy,
        round(avg(cloud_ok::INT), 6) AS cloud_accuracy,
        round(quantile_disc(latency, 0.5), 6) AS validation_latency_ms_p50,
        round(avg(cloud_ok::INT) - avg(edge_ok::INT), 6) AS cloud_accuracy_improvement
        FROM j GROUP BY 1, 2""",
    "feature_validity": f"""WITH {SENSOR} SELECT event_id, {MISSING} AS missing_columns,
        rms IS NOT NULL AND kurtosis IS NOT NULL AS is_valid FROM sensor""",
    "feature_quarantine": f"""WITH {SENSOR} SELECT event_id, device_id, "timestamp", source_file, seq,
        window_idx, dataset_run_id, ground_truth_label, {MISSING} AS quarantine_missing_columns,
        'required column NULL' AS quarantine_reason, 'bearing-features-v1' AS feature_set_version
        FROM sensor WHERE rms IS NULL OR kurtosis IS NULL""",
    "recording_split": f"""WITH {SENSOR}, {_split('sensor')}
        SELECT source_file, ground_truth_label, rank, total, dataset_split FROM split""",
    "split_windows": f"""WITH {SENSOR}, {_split('sensor')} SELECT event_id, source_file,
        ground_truth_label, dataset_split FROM sensor JOIN split USING (source_file, ground_truth_label)""",
    "trend_features": f"WITH {TREND} SELECT event_id, {TREND_COLUMNS} FROM trends",
    "training_eligibility": f"""WITH {SENSOR}, {_split('sensor')} SELECT dataset_split,
        ground_truth_label <> 'normal' AS is_actual_anomaly,
        dataset_split = 'TRAIN' AND ground_truth_label = 'normal' AS is_training_eligible,
        count(*) AS n FROM sensor JOIN split USING (source_file, ground_truth_label)
        GROUP BY 1, 2, 3""",
    "bearing_ml_features": f"""WITH {TREND}, {_split('valid')} SELECT event_id, device_id, "timestamp",
        source_file, seq, window_idx, sampling_rate_hz, dataset_run_id, dataset_split,
        ground_truth_label, ground_truth_label <> 'normal' AS is_actual_anomaly,
        dataset_split = 'TRAIN' AND ground_truth_label = 'normal' AS is_training_eligible,
        {FEATURE_LIST}, {TREND_COLUMNS}, 'bearing-features-v1' AS feature_set_version
        FROM trends JOIN split USING (source_file, ground_truth_label)""",
    "segment_windows": f"WITH {SAMPLES} SELECT source_file, window_idx, text AS samples FROM windows",
    "time_domain_features": f"WITH {SAMPLES} SELECT source_file, window_idx, {FEATURE_LIST} FROM featured",
    "waveform_features": f"""WITH x AS (
        SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
        m AS (SELECT vec_id, avg(v) AS mean FROM x GROUP BY vec_id),
        windows AS (SELECT vec_id, label, sqrt(avg(v * v)) AS rms, max(abs(v)) AS peak,
          avg(pow(v - mean, 2)) AS variance, avg(abs(v)) AS mean_abs, avg(pow(v - mean, 3)) AS m3,
          avg(pow(v - mean, 4)) AS m4 FROM x JOIN m USING (vec_id) GROUP BY vec_id, label),
        featured AS (SELECT *, CASE WHEN rms > 0 THEN peak / rms ELSE 0 END AS crest,
          m3 / pow(variance, 1.5) AS skew, m4 / (variance * variance) - 3 AS kurtosis FROM windows)
        SELECT vec_id, label, {FEATURE_LIST} FROM featured""",
    "label_from_prefix": f"""WITH {EV}, f AS (SELECT event_id, CASE user_id % 5 WHEN 0 THEN 'normal'
        WHEN 1 THEN 'inner_race' WHEN 2 THEN 'ball' WHEN 3 THEN 'outer_race' ELSE 'other' END AS p,
        user_id FROM ev) SELECT event_id, p || '_' || user_id || '.mat' AS source_file,
        CASE WHEN p <> 'other' THEN p END AS label FROM f""",
    "pick_channel": """WITH c AS (SELECT 'cust-' || o_custkey AS source_file,
        max(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END) AS best,
        count(*) FILTER (o_orderkey % 3 <> 0) AS n FROM orders GROUP BY 1)
        SELECT source_file, CASE WHEN n > 0 THEN 'X' || best || '_DE_time' END AS variable,
        CASE WHEN n > 0 THEN n END AS n_candidates FROM c""",
    "windows_to_events": f"""WITH {SAMPLES}, numbered AS (
        SELECT *, row_number() OVER (ORDER BY source_file, window_idx) AS seq,
               {b.PART_LABEL} AS label FROM featured),
        stamped AS (SELECT *, strftime(TIMESTAMP '2027-03-02 04:30:00' + to_seconds(seq),
               '%Y-%m-%dT%H:%M:%S.000Z') AS t FROM numbered)
        SELECT {_uuid5(NAMESPACE_HEX, "'sensors.bearing:bearing.1:' || seq || ':' || t")} AS event_id,
        t AS "timestamp", CASE WHEN label = 'normal' THEN 'normal' ELSE 'high' END AS priority,
        seq, source_file, window_idx, round(rms, 6) AS rms, 'run-1' AS dataset_run_id FROM stamped""",
    "recording_summary": f"""WITH {SAMPLES}, counted AS (
        SELECT source_file, {b.PART_LABEL} AS ground_truth_label, count(*) AS n_samples
        FROM samples GROUP BY 1, 2), {_split('counted')},
        rows AS (SELECT *, n_samples // 16 AS n_windows FROM counted
                 JOIN split USING (source_file, ground_truth_label))
        SELECT 'file' AS level, source_file, ground_truth_label, dataset_split, n_windows, n_samples FROM rows
        UNION ALL SELECT 'label_split', NULL, ground_truth_label, dataset_split,
          CAST(sum(n_windows) AS BIGINT), CAST(sum(n_samples) AS BIGINT) FROM rows GROUP BY 3, 4
        UNION ALL SELECT 'label', NULL, ground_truth_label, NULL,
          CAST(sum(n_windows) AS BIGINT), CAST(sum(n_samples) AS BIGINT) FROM rows GROUP BY 3
        UNION ALL SELECT 'total', NULL, NULL, NULL,
          CAST(sum(n_windows) AS BIGINT), CAST(sum(n_samples) AS BIGINT) FROM rows""",
    "anomaly_scores": """SELECT event_id, round(1 / (1 + exp((value - 50) / 128 * 5)), 6) AS anomaly_score
        FROM events""",
    "confusion_at_fixed_threshold": f"""WITH {EV}, c AS (SELECT
        count(*) FILTER (value / 1000 >= 0.06 AND k % 3 <> 0) AS tp,
        count(*) FILTER (value / 1000 >= 0.06 AND k % 3 = 0) AS fp,
        count(*) FILTER (value / 1000 < 0.06 AND k % 3 <> 0) AS fn,
        count(*) FILTER (value / 1000 < 0.06 AND k % 3 = 0) AS tn FROM ev)
        SELECT tp, fp, fn, tn, round(tp / (tp + fp), 6) AS "precision", round(tp / (tp + fn), 6) AS recall,
        round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)), 6) AS f1 FROM c""",
    "select_threshold": f"""WITH {EV}, scored AS (
        SELECT value / 1000 AS score, k % 3 <> 0 AS actual FROM ev), {SWEEP}
        SELECT round(f, 6) AS f1, round(p, 6) AS "precision", round(r, 6) AS recall,
        round(score, 6) AS threshold, tp, fp, fn, tn,
        (SELECT count(*) FROM per) AS candidates_evaluated FROM best""",
    "evaluate_frozen": f"""WITH {SENSOR}, {VALID}, {_split('valid')},
        rows AS (SELECT source_file, dataset_split, rms / 1000 AS score,
                 ground_truth_label <> 'normal' AS actual
                 FROM valid JOIN split USING (source_file, ground_truth_label)),
        scored AS (SELECT * FROM rows WHERE dataset_split = 'VALIDATION'), {SWEEP},
        c AS (SELECT count(*) FILTER (r.score >= best.score AND actual) AS tp,
              count(*) FILTER (r.score >= best.score AND NOT actual) AS fp,
              count(*) FILTER (r.score < best.score AND actual) AS fn,
              count(*) FILTER (r.score < best.score AND NOT actual) AS tn,
              count(*) AS n_windows, count(DISTINCT source_file) AS n_recordings
              FROM rows r, best WHERE dataset_split = 'TEST'),
        e AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p,
              CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r FROM c)
        SELECT tp, fp, fn, tn, n_windows, n_recordings, round(p, 6) AS "precision",
        round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1,
        (SELECT round(score, 6) FROM best) AS selected_threshold FROM e""",
    "train_rows": f"""WITH {SENSOR}, {VALID}, {_split('valid')}
        SELECT event_id, source_file, window_idx, round(rms, 6) AS rms
        FROM valid JOIN split USING (source_file, ground_truth_label)
        WHERE dataset_split = 'TRAIN' AND ground_truth_label = 'normal' AND dataset_run_id = 'run-1'""",
    "frozen_threshold": f"""WITH {SENSOR}, {VALID}, {_split('valid')},
        rows AS (SELECT dataset_split, rms / 1000 AS score, ground_truth_label <> 'normal' AS actual
                 FROM valid JOIN split USING (source_file, ground_truth_label) WHERE dataset_run_id = 'run-1'),
        scored AS (SELECT * FROM rows WHERE dataset_split = 'VALIDATION'), {SWEEP}
        SELECT 'given' AS run_id, 'run-1' AS dataset_run_id, 5.0::DOUBLE AS score_sigmoid_k,
        'validation_max_f1' AS threshold_selection_method, round(score, 6) AS selected_threshold,
        tp AS validation_tp, fp AS validation_fp, fn AS validation_fn, tn AS validation_tn,
        round(p, 6) AS validation_precision, round(r, 6) AS validation_recall, round(f, 6) AS validation_f1,
        (SELECT count(*) FROM per) AS candidates_evaluated,
        (SELECT count(*) FROM rows WHERE dataset_split = 'TRAIN' AND NOT actual) AS n_training_rows FROM best""",
    "second_opinion_loop": f"""WITH {PENDING}, {_bound('sensor', b.SENSOR)}, x AS (
        SELECT p.event_id AS source, p.anomaly, s.rms / 1000 AS score FROM pending p JOIN sensor s USING (device_id, seq))
        SELECT {_uuid5(VALIDATION_HEX, 'source')} AS event_id, source AS source_event_id,
        round(score, 6) AS cloud_score, CASE WHEN score > 0.6 THEN 'anomaly' ELSE 'normal' END AS cloud_decision,
        (score > 0.6) = coalesce(anomaly, FALSE) AS agrees_with_edge, TRUE AS latency_measured FROM x""",
    "forest_samples": """WITH h AS (SELECT tree, vec_id,
          ('0x' || substr(md5('7|' || tree || '|' || vec_id), 1, 15))::BIGINT AS h
          FROM embeddings, (SELECT unnest(generate_series(0, 19)) AS tree)),
        r AS (SELECT tree, vec_id, row_number() OVER (PARTITION BY tree ORDER BY h, vec_id) AS r FROM h)
        SELECT tree, vec_id FROM r WHERE r <= 32""",
    "forest_path_lengths": f"""WITH RECURSIVE {EV}, n(tree, node, f, split, l, r, size, depth) AS (VALUES
          {", ".join(str(t) for t in GIVEN_TREES)}),
        w AS (SELECT event_id, k, value, tree, 0 AS node FROM ev, (VALUES (0), (1)) t(tree)
          UNION ALL SELECT event_id, k, value, w.tree,
            CASE WHEN CASE n.f WHEN 0 THEN k ELSE value END <= n.split THEN n.l ELSE n.r END
          FROM w JOIN n ON w.tree = n.tree AND w.node = n.node WHERE n.f >= 0),
        c AS (SELECT *, CASE WHEN size > 2 THEN 2 * (ln(size - 1) + 0.5772156649015329) - 2 * (size - 1) / size
                             WHEN size = 2 THEN 1 ELSE 0 END AS unseen FROM n),
        p AS (SELECT event_id, sum(depth + unseen)::DOUBLE AS total FROM w JOIN c ON w.tree = c.tree AND w.node = c.node
              WHERE c.f < 0 GROUP BY event_id)
        SELECT event_id, round(0.5 - pow(2, -total / (2 * (2 * (ln(15) + 0.5772156649015329) - 2 * 15 / 16.0::DOUBLE))), 6)
        AS decision FROM p""",
    "pending_escalations": f"WITH {PENDING} SELECT event_id, device_id, seq FROM pending",
    "attach_features": f"""WITH {PENDING}, {_bound('sensor', b.SENSOR)}
        SELECT device_id, seq, p.event_id, {FEATURE_LIST} FROM pending p JOIN sensor s
        USING (device_id, seq)""",
    "validation_events": f"""WITH {PENDING}, x AS (
        SELECT *, infer_ms / 100 AS score, infer_ms / 100 > 0.6 AS cloud FROM pending)
        SELECT {_uuid5(VALIDATION_HEX, 'event_id')} AS event_id, device_id,
        'cloud_validation' AS asset_type, strftime("timestamp", '%Y-%m-%dT%H:%M:%SZ') AS "timestamp",
        CASE WHEN cloud = anomaly THEN 'normal' ELSE 'high' END AS priority,
        event_id AS source_event_id, anomaly AS edge_anomaly,
        round(CAST(edge_confidence AS DOUBLE), 6) AS edge_confidence, round(score, 6) AS cloud_score,
        CASE WHEN cloud THEN 'anomaly' ELSE 'normal' END AS cloud_decision,
        cloud = anomaly AS agrees_with_edge, coalesce(model_version, 'unversioned') AS edge_model_version,
        'second-v1' AS cloud_model_version, round(anomaly_score, 6) AS edge_score,
        round(infer_ms * 2, 6) AS validation_latency_ms, mode FROM x""",
    "payload_bytes": f"""WITH {SIZED} SELECT event_id, small AS stats_only_bytes,
        small + wave AS stats_plus_waveform_bytes, wave AS waveform_bytes,
        round(wave / (small + wave), 6) AS waveform_share,
        round((small + wave) / small, 6) AS overhead_ratio, round(wave / (k + 1), 6) AS bytes_per_sample,
        small + wave < 200 AS within_limit FROM sized""",
    "projected_egress": f"""WITH {SIZED}, t AS (SELECT count(*) AS n, avg(small) AS s,
        avg(small + wave) AS l FROM sized),
        x AS (SELECT *, CAST(round_even(n * rate, 0) AS BIGINT) AS e
              FROM t, (VALUES (0.0::DOUBLE), (0.05::DOUBLE), (0.2::DOUBLE), (0.6::DOUBLE), (1.0::DOUBLE)) v(rate))
        SELECT n AS total_events, rate AS escalation_rate, e AS escalated_events,
        round(n * l, 6) AS static_cloud_offload_bytes, round(e * l, 6) AS escalation_bytes,
        round((n - e) * s + e * l, 6) AS adaptive_bytes, CAST(0 AS BIGINT) AS edge_only_bytes,
        round(1 - ((n - e) * s + e * l) / (n * l), 6) AS egress_reduction_vs_static FROM x""",
    "dlq_volume": f"""WITH {RAW}, r AS ({_time_windows(f"(SELECT * FROM raw WHERE {_REJECT})", "received_at", 21600)})
        SELECT w AS window_start, count(*) AS n_rejects, TRUE AS alarm FROM r GROUP BY w""",
    "stream_dead_letter_volume": f"""WITH {RAW}, r AS ({_time_windows(f"(SELECT * FROM raw WHERE {_REJECT})", "received_at", 21600)})
        SELECT w AS window_start, count(*) AS n_rejects, TRUE AS alarm FROM r GROUP BY w""",
    "ingest_gaps": f"""WITH {EV}, c AS (SELECT w, count(*) AS n FROM ({_time_windows("ev", "ts", 300)}) GROUP BY w),
        a AS (SELECT unnest(generate_series((SELECT min(w) FROM c), (SELECT max(w) FROM c),
              INTERVAL 5 MINUTE)) AS w),
        f AS (SELECT w, coalesce(n, 0) AS n FROM a LEFT JOIN c USING (w))
        SELECT w AS window_start, n AS n_events,
        max(n) OVER (ORDER BY w ROWS 2 PRECEDING) = 0 AS alarm FROM f""",
    "ingest_lag": f"""WITH {EV}, i AS (SELECT ts, ts + to_seconds(k) AS at_ FROM ev),
        g AS (SELECT w, max((epoch_us(at_) - epoch_us(ts)) / 1e6) AS lag
              FROM ({_time_windows("i", "at_", 3600)}) GROUP BY w)
        SELECT g.w AS window_start, round(g.lag, 6) AS max_lag_s,
        g.lag > 95 AND coalesce(h.lag > 95, FALSE) AND coalesce(j.lag > 95, FALSE) AS alarm
        FROM g LEFT JOIN g h ON h.w = g.w - INTERVAL 1 HOUR
        LEFT JOIN g j ON j.w = g.w - INTERVAL 2 HOUR""",
    "stream_ingest_volume": f"""WITH {EV}, i AS (SELECT ts, ts + to_seconds(k) AS at_ FROM ev)
        SELECT w AS window_start, count(*) AS n_events,
        round(max((epoch_us(at_) - epoch_us(ts)) / 1e6), 6) AS max_lag_s
        FROM ({_time_windows("i", "at_", 3600)}) GROUP BY w""",
}

# The same results from a stream.
ORACLES["stream_gap_alarms"] = ORACLES["ingest_gaps"]
ORACLES["stream_lag_alarms"] = ORACLES["ingest_lag"]
ORACLES["stream_upsert_latest"] = ORACLES["dedup_latest_rows"]
ORACLES["small_files_merged_equals_source"] = ORACLES["compacted_table_equals_source"]
ORACLES["exact_quantiles"] = " UNION ALL ".join(
    f"SELECT {q}::DOUBLE AS share, round(quantile_disc(l_extendedprice, {q}), 6) AS price FROM lineitem"
    for q in (0.001, 0.01, 0.1, 0.5, 0.999))
