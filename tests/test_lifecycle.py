import random
import uuid

import pytest
from pyspark.sql import functions as F

from tests.fixtures import inference, lines, sensor
from tidemill.config import discover_asset_configs
from tidemill.functions.scores import anomaly_score
from tidemill.operators.escalation import pending_escalations
from tidemill.operators.features import bearing_ml_features
from tidemill.operators.forest import (
    fit_isolation_forest, load_forest, mean_path, save_forest, score_isolation_forest, tree_samples,
)
from tidemill.operators.silver import clean_events, fan_out_assets
from tidemill.operators.envelope import validate_envelope
from tidemill.plans.lifecycle import evaluate_frozen, run_second_opinion, train, train_second_opinion
from tidemill.sources.landing import bronze_from_landing, read_landing, write_landing
from tests.test_features import sensor_rows
from tidemill.schema import FEATURES


@pytest.fixture(scope="module")
def feature_table(spark):
    rows = sensor_rows(spark, {"normal": [f"n{i}" for i in range(10)], "ball": [f"b{i}" for i in range(4)]},
                       windows=30)
    far = F.when(F.col("ground_truth_label") == "ball", F.lit(3.0)).otherwise(F.lit(0.0))
    for c in FEATURES:
        rows = rows.withColumn(c, F.col(c) + far)
    return bearing_ml_features(rows)


def test_train_and_evaluate(spark, feature_table, tmp_path):
    models = str(tmp_path)
    run = train(feature_table, "r1", models, n_trees=20)
    frozen = run.frozen.first()
    assert frozen["validation_f1"] == 1.0 and frozen["n_training_rows"] == 6 * 30
    result = evaluate_frozen(feature_table, models, run.run_id).first()
    assert result["selected_threshold"] == frozen["selected_threshold"]
    assert (result["n_windows"], result["n_recordings"]) == (2 * 30 + 2 * 30, 4)
    assert result["f1"] > 0.95
    with pytest.raises(ValueError):
        evaluate_frozen(feature_table, models, "")
    with pytest.raises(ValueError):
        train(feature_table, "absent", models)


def test_same_forest_whatever_the_partitioning(spark, feature_table, tmp_path):
    rows = feature_table.filter("ground_truth_label = 'normal'")
    one = fit_isolation_forest(rows.coalesce(1), n_trees=5, max_samples=64)
    two = fit_isolation_forest(rows.repartition(9), n_trees=5, max_samples=64)
    other = fit_isolation_forest(rows, n_trees=5, max_samples=64, seed=1)
    nodes = lambda f: sorted(f.nodes.collect())
    assert nodes(one) == nodes(two) != nodes(other)
    save_forest(one, str(tmp_path / "m"))
    back = load_forest(spark, str(tmp_path / "m"))
    a, b = (rows.select(score_isolation_forest(f).alias("s")).agg(F.sum("s")).first()[0] for f in (one, back))
    assert a == pytest.approx(b)


def test_one_sampling_rule_for_every_size(spark):
    """On both sides of trees x samples each tree draws its own subset, and subsets overlap."""
    trees, psi = 20, 16
    for n in (trees * psi - 1, trees * psi, trees * psi + 1):
        rows = tree_samples(spark.range(n), "id", trees, psi, 7, n).collect()
        by_tree = [{r["id"] for r in rows if r["tree"] == t} for t in range(trees)]
        assert all(len(s) == psi for s in by_tree) and len({frozenset(s) for s in by_tree}) == trees
        distinct = len(set().union(*by_tree))
        assert 0.55 * trees * psi < distinct < 0.72 * trees * psi  # about 1 - 1/e of the draws
    assert len(tree_samples(spark.range(5), "id", 3, 16, 7, 5).collect()) == 15


def test_large_forests_are_scored_in_parts(spark, feature_table):
    forest = fit_isolation_forest(feature_table, n_trees=6, max_samples=32)
    whole, parts = score_isolation_forest(forest), score_isolation_forest(forest, max_nodes=70)
    rows = feature_table.select(whole.alias("a"), parts.alias("b")).collect()
    assert all(r["a"] == pytest.approx(r["b"], abs=1e-12) for r in rows)


def test_trees_are_well_formed_and_samples_bounded(spark, feature_table):
    rows = feature_table.filter("ground_truth_label = 'normal'")
    forest = fit_isolation_forest(rows, n_trees=4, max_samples=16)
    for tree in range(4):
        nodes = {r["node"]: r for r in forest.nodes.filter(f"tree = {tree}").collect()}
        assert nodes[0]["size"] == 16
        for n in nodes.values():
            assert n["depth"] <= 4
            if n["feature"] >= 0:
                assert nodes[n["left"]]["size"] + nodes[n["right"]]["size"] == n["size"]


def test_contamination_moves_the_offset(spark, feature_table):
    rows = feature_table.filter("ground_truth_label = 'normal'")
    forest = fit_isolation_forest(rows, n_trees=10, contamination=0.1)
    share = rows.select((score_isolation_forest(forest) < 0).cast("double").alias("x")).agg(F.avg("x")).first()[0]
    assert 0.05 < share < 0.15


def test_limits(spark, feature_table):
    with pytest.raises(ValueError, match="9 training rows"):
        fit_isolation_forest(feature_table.limit(9))
    assert mean_path(1) == 0 and mean_path(2) == 1 and mean_path(256) == pytest.approx(10.244, abs=1e-3)
    df = spark.createDataFrame([(0.0,), (5.0,), (-5.0,)], "r double")
    half, low, high = [r[0] for r in df.select(anomaly_score(F.col("r"))).collect()]
    assert half == 0.5 and low < 1e-6 and high > 1 - 1e-6


def test_missing_feature_has_no_score(spark, feature_table):
    forest = fit_isolation_forest(feature_table, n_trees=3)
    holed = feature_table.limit(3).withColumn("rms", F.lit(None).cast("double"))
    assert [r[0] for r in holed.select(score_isolation_forest(forest)).collect()] == [None] * 3


def test_second_opinions_re_enter_once(spark, tmp_path):
    rng = random.Random(3)
    changes = lambda: {c: rng.random() for c in FEATURES}
    events = [sensor("bearing.DE", i, i, **changes()) for i in range(20)]
    events += [sensor("bearing.DE", 500 + i, 500 + i, **changes()) for i in range(5)]
    for i in range(5):
        e = inference("bearing.DE", 500 + i + 0.1, "normal", False, "HYBRID", confidence=0.44)
        e["payload"]["seq"] = 500 + i
        events.append(e)
    landing = str(tmp_path / "landing")
    write_landing(validate_envelope(lines(spark, events))[0], landing)

    def tables():
        return fan_out_assets(clean_events(bronze_from_landing(read_landing(spark, landing))),
                              discover_asset_configs())

    def parts(t):
        return (t["silver_bearing_inference_results"], t["silver_cloud_validation_results"],
                t["silver_bearing_sensor_telemetry"])

    inf, val, sen = parts(tables())
    assert pending_escalations(inf, val).count() == 5
    forest = train_second_opinion(sen, n_trees=10)
    run_second_opinion(spark, inf, val, sen, forest, "second-v1", landing)
    inf2, val2, sen2 = parts(tables())
    rows = val2.collect()
    assert len(rows) == 5 and pending_escalations(inf2, val2).count() == 0
    assert all(0 <= r["cloud_score"] <= 1 and r["edge_model_version"] == "unversioned" for r in rows)
    ns = uuid.UUID("9a2f4c6e-3b1d-4a8e-9c7f-1d2e3f4a5b6c")
    assert all(r["event_id"] == str(uuid.uuid5(ns, r["source_event_id"])) for r in rows)
    empty = val2.filter("1 = 0")
    run_second_opinion(spark, inf2, empty, sen2, forest, "second-v1", landing)
    assert parts(tables())[1].count() == 5
