"""Named row predicates: drop, fail or only count the rows that break them."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class ExpectationFailed(ValueError):
    """A ``fail`` expectation was broken."""


def holds(predicate: str | Column) -> Column:
    """The predicate as a never-NULL boolean: unknown counts as broken."""
    column = F.expr(predicate) if isinstance(predicate, str) else predicate
    return F.coalesce(column, F.lit(False))


def all_hold(predicates: dict[str, str | Column]) -> Column:
    return reduce(lambda a, b: a & b, (holds(p) for p in predicates.values()))


def broken_names(predicates: dict[str, str | Column]) -> Column:
    """Array of the names of the predicates a row breaks."""
    return F.array_compact(F.array(*[F.when(~holds(p), n) for n, p in predicates.items()]))


def violations(df: DataFrame, predicates: dict[str, str | Column]) -> DataFrame:
    """One row per predicate: rows checked and rows that break it, in a single pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("checked"),
        *[F.count_if(~holds(p)).alias(f"_b{i}") for i, p in enumerate(predicates.values())],
    )
    pairs = F.array(
        *[
            F.struct(F.lit(n).alias("expectation"), F.col(f"_b{i}").alias("broken"))
            for i, n in enumerate(predicates)
        ]
    )
    return counted.select("checked", F.explode(pairs).alias("p")).select(
        "p.expectation", "checked", "p.broken"
    )


def expect(
    df: DataFrame, predicates: dict[str, str | Column], action: str = "drop",
    observation: Observation | None = None,
) -> DataFrame:
    """Apply expectations.

    ``drop`` filters the violators; ``fail`` raises when the run meets one, in the pass that
    computes the rows; ``warn`` leaves the rows as they are and counts violations in
    ``observation``, whose ``get`` holds them by name after the run.
    """
    if action == "drop":
        return df.filter(all_hold(predicates))
    if action == "fail":
        names = F.array_join(broken_names(predicates), ", ")
        message = F.concat(F.lit("expectation broken: "), names)
        return df.filter(F.when(all_hold(predicates), True).otherwise(F.raise_error(message).cast("boolean")))
    if action == "warn":
        counts = [F.count_if(~holds(p)).alias(n) for n, p in predicates.items()]
        return df.observe(observation or Observation(f"expectations-{uuid.uuid4().hex}"), *counts)
    raise ValueError(f"unknown action {action!r}")
