"""The chunked way of every ordered computation equals the plain window."""

import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators.ordered import OrderedRuns


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = []
    for i in range(600):
        key = "hot" if i % 3 else rng.choice(["a", "b", None])
        # many equal order values, so that chunk borders fall inside ties
        data.append((key, rng.randint(0, 40), i, rng.choice([None, rng.random()])))
    return spark.createDataFrame(data, "k string, t int, id int, x double").repartition(5)


def both(rows, keys, work):
    plain = OrderedRuns.of(rows, keys, ["t", "id"])
    chunked = OrderedRuns.of(rows, keys, ["t", "id"], max_rows=37)
    assert not plain.chunked and chunked.chunked
    return [
        sorted(map(repr, work(r).rows().select("k", "t", "id", "x", "a", "b").collect()))
        for r in (plain, chunked)
    ]


@pytest.mark.parametrize("keys", [["k"], []])
def test_frames(rows, keys):
    left, right = both(
        rows,
        keys,
        lambda r: r.frame(
            4,
            a=lambda w: F.lag("id").over(w),
            b=lambda w: F.count("x").over(w.rowsBetween(-4, 0)),
        ),
    )
    assert left == right and len(left) == 600


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_sum_and_max(rows, keys):
    left, right = both(
        rows, keys, lambda r: r.running(a=("sum", F.col("id")), b=("max", F.col("x")))
    )
    assert left == right and len(left) == 600


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_last_after_frame(rows, keys):
    def work(r):
        r = r.frame(1, a=lambda w: F.lag("x").over(w))
        return r.running(b=("last", F.col("a")))

    left, right = both(rows, keys, work)
    assert left == right and len(left) == 600


def test_many_hot_keys(rows, monkeypatch):
    """With more hot keys than may be listed, all rows are cut into chunks."""
    from tidemill.operators import ordered

    monkeypatch.setattr(ordered, "MAX_HOT_KEYS", 1)
    left, right = both(
        rows,
        ["k"],
        lambda r: r.frame(2, a=lambda w: F.lag("id", 2).over(w)).running(b=("max", F.col("x"))),
    )
    assert left == right and len(left) == 600
