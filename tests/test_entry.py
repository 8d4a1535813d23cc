import pytest

from __spark_entry__ import entry, oracle_sql, queries


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", ["mode_history", "edge_autonomy", "select_threshold"])
def test_results_do_not_depend_on_partitioning(spark, sf_dir, name):
    make = queries()[name]
    first = sorted(map(str, make(spark, sf_dir).collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert sorted(map(str, make(spark, sf_dir).collect())) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
