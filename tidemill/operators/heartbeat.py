"""Heartbeat sampling of context snapshots: a greedy choice along each device's time line.

Every breach is kept; another sample only if at least ``interval`` has passed since the last
kept one. The choice at a row depends on the choices before it, which no window function
expresses, so the rows of a device are walked in Arrow batches. A device above ``max_rows``
is cut into time-ordered chunks:

1. each chunk is summed up as a step function "last kept time before -> last kept time after";
2. these functions, one small row per chunk, are applied in order to get every chunk's entry;
3. every chunk is walked on its own from its entry.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.ordered import _CHUNK, MAX_ROWS_PER_TASK, OrderedRuns
from tidemill.schema import HEARTBEAT_SECONDS

NEVER = np.iinfo(np.int64).min // 4
_FOREVER = np.iinfo(np.int64).max


def next_kept(times: np.ndarray, breach: np.ndarray, interval: int) -> np.ndarray:
    """For each row, the row kept next if this one is kept (len(times) if none)."""
    n = len(times)
    due = np.searchsorted(times, times + interval, side="left")
    due = np.maximum(due, np.arange(1, n + 1))
    at = np.where(breach, np.arange(n), n)
    following = np.minimum.accumulate(at[::-1])[::-1]
    next_breach = np.append(following[1:], n)
    return np.minimum(due, next_breach)


def first_kept(times: np.ndarray, breach: np.ndarray, last: int, interval: int) -> int:
    due = int(np.searchsorted(times, last + interval, side="left"))
    breaches = np.flatnonzero(breach)
    return min(due, int(breaches[0])) if len(breaches) else due


def walk(times: np.ndarray, breach: np.ndarray, last: int, interval: int) -> np.ndarray:
    """Mask of kept rows; ``times`` ascending in microseconds."""
    kept = np.zeros(len(times), dtype=bool)
    following = next_kept(times, breach, interval)
    i = first_kept(times, breach, last, interval)
    while i < len(times):
        kept[i] = True
        i = following[i]
    return kept


def step_function(
    times: np.ndarray, breach: np.ndarray, interval: int
) -> tuple[np.ndarray, np.ndarray]:
    """(cuts, exits): with entry ``last``, the exit belongs to the first cut >= last + interval;
    beyond all cuts nothing is kept and the entry passes through."""
    n = len(times)
    following = next_kept(times, breach, interval)
    end = np.where(following < n, following, np.arange(n))
    while True:
        further = end[end]
        if np.array_equal(further, end):
            break
        end = further
    # An entry is no later than the first row, so the row due is no later than this one.
    last_due = int(np.searchsorted(times, times[0] + interval, side="left"))
    breaches = np.flatnonzero(breach)
    first_breach = int(breaches[0]) if len(breaches) else n
    upto = min(last_due, first_breach, n - 1)
    cuts, exits = times[: upto + 1].copy(), times[end[: upto + 1]]
    if first_breach <= upto:
        cuts[first_breach] = _FOREVER
    ends_run = np.append(exits[1:] != exits[:-1], True)
    return cuts[ends_run], exits[ends_run]


def _lines(table: pa.Table, at: str, breach: str) -> tuple[np.ndarray, np.ndarray]:
    micros = table[at].cast(pa.timestamp("us", table[at].type.tz)).cast(pa.int64())
    flags = pc.fill_null(table[breach], False)
    return micros.to_numpy(), flags.to_numpy(zero_copy_only=False).astype(bool)


def heartbeat_downsample(
    df: DataFrame,
    key: str = "device_id",
    at: str = "timestamp",
    breach: str = "breach",
    interval: float = HEARTBEAT_SECONDS,
    tie: str = "event_id",
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Rows to forward. The clock is event time; rows without a time are not considered."""
    micros = int(interval * 1_000_000)
    runs = OrderedRuns.of(df.filter(F.col(at).isNotNull()), [key], [at, tie], max_rows)
    order = [(at, "ascending"), (tie, "ascending")]

    def keep(table: pa.Table) -> pa.Table:
        table = table.sort_by(order)
        times, flags = _lines(table, at, breach)
        last = table["_entry"][0].as_py() if "_entry" in table.column_names else None
        kept = walk(times, flags, NEVER if last is None else last, micros)
        return table.filter(pa.array(kept))

    if not runs.chunked:
        return runs.df.groupBy(key).applyInArrow(keep, df.schema)

    def summarise(table: pa.Table) -> pa.Table:
        table = table.sort_by(order)
        cuts, exits = step_function(*_lines(table, at, breach), micros)
        one = table.slice(0, 1).select([key, _CHUNK])
        return one.append_column("cuts", pa.array([cuts.tolist()], pa.list_(pa.int64()))).append_column(
            "exits", pa.array([exits.tolist()], pa.list_(pa.int64()))
        )

    def compose(steps: pd.DataFrame) -> pd.DataFrame:
        steps = steps.sort_values(_CHUNK)
        last, entries = NEVER, []
        for cuts, exits in zip(steps["cuts"], steps["exits"]):
            entries.append(last)
            i = int(np.searchsorted(cuts, last + micros, side="left"))
            last = int(exits[i]) if i < len(cuts) else last
        return pd.DataFrame({"_of_key": steps[key], "_of_chunk": steps[_CHUNK], "_entry": entries})

    key_type = df.schema[key].dataType.simpleString()
    narrow = runs.df.filter(F.col(_CHUNK) >= 0).select(key, _CHUNK, at, tie, breach)
    steps = narrow.groupBy(key, _CHUNK).applyInArrow(
        summarise, f"`{key}` {key_type}, {_CHUNK} int, cuts array<bigint>, exits array<bigint>"
    )
    entries = steps.groupBy(key).applyInPandas(
        compose, f"_of_key {key_type}, _of_chunk int, _entry bigint"
    )
    # A key's first chunk has no entry; the others are at most one per chunk.
    entries = F.broadcast(entries.filter(F.col("_entry") != NEVER))
    entered = runs.df.join(
        entries,
        F.col(key).eqNullSafe(F.col("_of_key")) & (F.col(_CHUNK) == F.col("_of_chunk")),
        "left",
    ).drop("_of_key", "_of_chunk")
    return entered.groupBy(key, _CHUNK).applyInArrow(keep, entered.schema).select(*df.columns)
