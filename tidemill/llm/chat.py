"""Multi-party dialogues rendered from each participant's point of view, native.

For every participant (role other than the system's) of a conversation the dialogue is rendered with
that speaker as the assistant and all others as named users; the mask holds the spans to train on:
the assistant's words and end marks. A long dialogue is rendered in parts of ``PART_TURNS`` turn
numbers, so that no task holds a whole conversation; messages are gathered once per part, before
they are multiplied by the participants.

Defined cases: repeated rows are one message; messages with equal turns follow by role and text; null
turns come first, in a part of their own (-1); null text is empty; a null role speaks as an unnamed
user and has no point of view; rows with a null conversation id are one conversation; a conversation
without participants, like an empty table, has no dialogue. Marks inside a text are broken up, names
are percent-encoded, so neither can forge a turn. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_TURNS = 256
SYSTEM = "system"
END = "<|end|>"


def _opening(role: Column, perspective: Column) -> Column:
    return (F.when(role == SYSTEM, F.lit("<|system|>\n")).when(role == perspective, F.lit("<|assistant|>\n"))
            .when(role.isNull(), F.lit("<|user|>\n"))
            .otherwise(F.concat(F.lit("<|user name="), F.url_encode(role), F.lit("|>\n"))))


def rotate(messages: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """(conv_id, turn, role, text) → conv_id, perspective, part, n_turns, dialogue, mask.

    ``mask`` is an array of (start, end) in code points of ``dialogue``, end exclusive."""
    part = F.coalesce(F.floor(F.col("turn") / F.lit(part_turns)).cast("long"), F.lit(-1).cast("long"))
    own = messages.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).distinct()
    people = own.filter(F.col("role").isNotNull() & (F.col("role") != SYSTEM)).select(
        F.col("conv_id").alias("_conv"), F.col("role").alias("perspective")).distinct()
    parts = own.groupBy("conv_id", part.alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text")), _before).alias("_messages"))
    rows = parts.join(people, F.col("conv_id").eqNullSafe(F.col("_conv")))
    pieces = F.transform("_messages", lambda m: F.struct(
        _opening(m["role"], F.col("perspective")).alias("opening"),
        F.concat(F.replace(m["text"], F.lit("<|"), F.lit("< |")), F.lit(END)).alias("body"),
        F.coalesce((m["role"] == F.col("perspective")), F.lit(False)).alias("own")))
    rows = rows.withColumn("_pieces", pieces)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    mask = F.aggregate("_pieces", start, lambda acc, p: F.struct(
        (acc["at"] + F.length(p["opening"]) + F.length(p["body"]) + 1).alias("at"),
        F.when(p["own"], F.array_append(acc["spans"], F.struct(
            (acc["at"] + F.length(p["opening"])).alias("start"),
            (acc["at"] + F.length(p["opening"]) + F.length(p["body"])).alias("end")))).otherwise(acc["spans"]).alias("spans")))
    return rows.select(
        "conv_id", "perspective", "part", F.size("_pieces").cast("long").alias("n_turns"),
        F.array_join(F.transform("_pieces", lambda p: F.concat(p["opening"], p["body"], F.lit("\n"))), "").alias("dialogue"),
        mask["spans"].alias("mask"))


def _before(a: Column, b: Column) -> Column:
    """By turn, role and text, nulls first."""
    out = F.lit(0)
    for name in ("text", "role", "turn"):
        x, y = a[name], b[name]
        out = (F.when(x.isNull() & y.isNotNull(), -1).when(x.isNotNull() & y.isNull(), 1)
               .when(x < y, -1).when(x > y, 1).otherwise(out))
    return out


def written(mask: Column) -> Column:
    return F.array_join(F.transform(mask, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")


def oracle(part_turns: int = PART_TURNS) -> str:
    """The same in the SQL of an embedded database, the mask as text."""
    return f"""
WITH m AS (SELECT DISTINCT conv_id, turn, role, replace(coalesce(text, ''), '<|', '< |') || '{END}' AS body,
             coalesce(floor(turn / {part_turns})::BIGINT, -1) AS part FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS perspective FROM m WHERE role IS NOT NULL AND role <> '{SYSTEM}'),
r AS (SELECT m.*, perspective,
        CASE WHEN role = '{SYSTEM}' THEN '<|system|>' WHEN role = perspective THEN '<|assistant|>'
             WHEN role IS NULL THEN '<|user|>' ELSE '<|user name=' || url_encode(role) || '|>' END || chr(10) AS opening
      FROM m JOIN p ON m.conv_id IS NOT DISTINCT FROM p.conv_id),
o AS (SELECT *, coalesce(sum(length(opening) + length(body) + 1) OVER (PARTITION BY conv_id, perspective, part
        ORDER BY turn NULLS FIRST, role NULLS FIRST, body ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT
        + length(opening) AS s FROM r)
SELECT conv_id, perspective, part, count(*) AS n_turns,
       string_agg(opening || body || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, body) AS dialogue,
       coalesce(string_agg(s || ':' || (s + length(body)), ',' ORDER BY s) FILTER (role = perspective), '') AS mask
FROM o GROUP BY conv_id, perspective, part"""
