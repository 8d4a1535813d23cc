"""Order statistics against sorting."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemill.operators.gold import detection_performance, escalation_efficacy, with_outcome
from tidemill.operators.rank import exact_quantile, grouped_quantiles, value_of_rank
from tidemill.plans.oracles import ORACLES, OUTCOME_UNKNOWN_TN
from tidemill.plans.queries import QUERIES

CASES = {
    "uniform": [random.Random(1).random() for _ in range(3000)],
    "ties": [random.Random(2).randrange(5) * 1.5 for _ in range(2000)],
    "one value": [4.25] * 500,
    "far apart": [-1e308, 1e308, 5e-324, 0.0, -5e-324] * 30 + [random.Random(3).gauss(0, 1) for _ in range(300)],
    "steep": [math.exp(random.Random(i).uniform(-300, 300)) for i in range(800)],
}


@pytest.mark.parametrize("name", CASES)
def test_every_rank_is_exact(spark, name):
    values = CASES[name]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double").repartition(3).cache()
    want = sorted(values)
    for k in (1, len(want) // 3, len(want)):
        assert value_of_rank(df, "x", k, bins=64, few=50) == want[k - 1]
    assert value_of_rank(df, "x", len(want) + 1) is None and value_of_rank(df, "x", 0) is None
    for q in (0.0, 0.1):
        assert exact_quantile(df, "x", q) == want[max(1, math.ceil(round(q * len(want), 9))) - 1]
    df.unpersist()


def test_empty_column(spark):
    assert exact_quantile(spark.createDataFrame([], "x double"), "x", 0.5) is None


@pytest.mark.parametrize("max_rows", [20, 10**6])
def test_quantiles_of_groups(spark, max_rows):
    rng = random.Random(5)
    groups = {"a": 300, None: 150, "b": 1, "c": 100, "none": 0}
    values = {g: [rng.choice([rng.gauss(0, 9), rng.randrange(4)]) for _ in range(n)] for g, n in groups.items()}
    values["c"][:3] = [float("nan")] * 3
    rows = [(g, float(v)) for g, vs in values.items() for v in vs] + [(g, None) for g in groups for _ in range(7)]
    counted = spark.createDataFrame(rows, "g string, x double").groupBy("g", "x").agg(F.count(F.lit(1)).alias("n"))
    shares = {"least": 0.0, "one": 0.01, "half": 0.5, "most": 0.99, "last": 1.0}
    got = {r.g: r for r in grouped_quantiles(counted, ["g"], "x", shares, "n", max_rows).collect()}
    assert set(got) == set(groups)
    for g, vs in values.items():
        ordered = sorted(vs, key=lambda v: (math.isnan(v), v))
        for name, q in shares.items():
            want = ordered[max(1, math.ceil(round(q * len(vs), 9))) - 1] if vs else None
            assert got[g][name] == want or math.isnan(want) and math.isnan(got[g][name]), (g, name)


@pytest.mark.parametrize("max_rows", [9_000, 10**6])
def test_percentiles_of_large_groups_are_exact(spark, max_rows):
    """More distinct values than a sketch of the default accuracy keeps apart."""
    n = 60_000
    rows = spark.range(n).select(
        F.col("id").cast("string").alias("event_id"), F.lit("m").alias("mode"), F.lit(None).cast("string").alias("model_version"),
        F.lit("normal").alias("ground_truth_label"), F.lit(False).alias("anomaly"), F.lit(0.9).alias("edge_confidence"),
        (F.pmod(F.col("id") * 7919, F.lit(n)) + 1).cast("double").alias("infer_ms")).repartition(5)
    got = detection_performance(rows, max_rows=max_rows).first()
    assert (got["n_events"], got["tn"], got["infer_ms_p50"], got["infer_ms_p99"]) == (n, n, n / 2, 0.99 * n)
    second = rows.select(F.col("event_id").alias("source_event_id"), F.lit(False).alias("cloud_anomaly"),
                         F.lit(None).cast("boolean").alias("agrees_with_edge"), F.col("infer_ms").alias("validation_latency_ms"))
    got = escalation_efficacy(rows, second, max_rows).first()
    assert (got["n_escalations"], got["agreement_rate"], got["edge_accuracy"], got["validation_latency_ms_p50"]) == (n, None, 1.0, n / 2)


def test_published_percentiles_equal_the_sql(spark, sf_dir):
    con = duckdb.connect()
    path = sf_dir.replace("sf0.001", "sf0.1")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{path}/events.parquet'")
    want = con.execute(f"SELECT mode, model_version, infer_ms_p50, infer_ms_p99 FROM ({ORACLES['published_table']})").fetchall()
    got = QUERIES["published_table"](spark, path).select("mode", "model_version", "infer_ms_p50", "infer_ms_p99").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_published_table_with_unknown_predictions_equals_the_sql(spark, sf_dir, tmp_path):
    con = duckdb.connect()
    con.execute(f"""COPY (SELECT * REPLACE (CASE WHEN event_id % 5 <> 0 THEN value END AS value,
        CASE WHEN event_id % 11 <> 0 THEN props END AS props) FROM '{sf_dir}/events.parquet') TO '{tmp_path}/events.parquet' (FORMAT parquet)""")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    want = con.execute(ORACLES["published_table"])
    columns, want = [c[0] for c in want.description], want.fetchall()
    got = QUERIES["published_table"](spark, str(tmp_path)).select(*columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert all(sum(r[c] for r in got) > 0 for c in ("tp", "fp", "fn", "tn"))


def test_outcomes_of_unknowns_equal_the_sql(spark):
    pairs = [(p, label) for p in (True, False, None) for label in ("normal", "inner_race", None)]
    rows = with_outcome(spark.createDataFrame(pairs, "anomaly boolean, ground_truth_label string"))
    con = duckdb.connect()
    con.execute("CREATE TABLE t (anomaly BOOLEAN, ground_truth_label VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", pairs)
    want = con.execute(f"SELECT anomaly, ground_truth_label, {OUTCOME_UNKNOWN_TN} FROM t").fetchall()
    assert set(map(tuple, rows.select("anomaly", "ground_truth_label", "outcome").collect())) == set(want) and len(want) == 9
