"""Repeated passages across documents, found by sorting suffixes.

Removed is each byte covered by a string of ``LENGTH`` bytes that also starts in a document with a
smaller id. Only suffixes that can begin such a string are sorted:

1. Anchors: in each window of ``LENGTH`` bytes the least hash of its strings of ``K`` bytes. Equal
   windows choose equal anchors, so a repeated window shares an anchor with its other occurrence.
   Hashes of anchors are dealt by value; those found in one document only are done with.
2. The surroundings of the anchors left (all windows that hold the anchor) are dealt by anchor.
   Equal surroundings are one, with their least id.
   What surrounds an anchor that more than ``CROWD`` documents hold (a common line, each with
   neighbours of its own) is dealt string by string instead, so that no task gets all of it.
3. Equal surroundings are found by comparing them whole. Where an anchor has several different ones, the suffixes that start in them are sorted to LENGTH
   bytes, deep-shallow: a multikey sort for the first ``SHALLOW`` words of eight bytes, then blind
   tries for the groups with a longer common prefix: a trie node branches at the first word in
   which its group differs, and only that word is looked at. Leaves of equal strings give the least
   id for each start.
4. The least ids go back to the documents, which are cut there. They find their surroundings by a hash
   of 64 bits.

Documents move in blocks of about ``BLOCK_BYTES``; anchors and surroundings as packed arrays, once
for each block however many of its documents hold them. Nothing is limited in number.

Defined cases: null or empty text has no bytes and nothing is removed; rows with a null id neither
remove nor lose anything; rows with equal ids don't affect each other; an empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import settled

LENGTH = 50
SPAN = 32  # strings of K bytes in a window
K = LENGTH - SPAN + 1
SIDE = LENGTH - K  # bytes of surroundings on each side of an anchor
CONTEXT = SIDE + K + SIDE
SHALLOW = 2
BLOCK_BYTES = 1_000_000
BLOCKS_PER_BUCKET = 8
CROWD = 50_000
_ROW = 88  # surroundings, their lengths on both sides, padding to whole words
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_TOP = 48
_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


class Texts:
    """The bytes of some documents, end to end."""

    def __init__(self, texts) -> None:
        parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.lengths = np.array([len(p) for p in parts], dtype=np.int64)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        self.n = int(self.lengths.sum())
        self.padded = np.frombuffer(bytes(SIDE) + b"".join(parts) + bytes(CONTEXT), dtype=np.uint8)
        self.bytes = self.padded[SIDE:]

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, hash of 48 bits, document) of each anchor."""
        none = np.empty(0, dtype=np.int64)
        if self.n < LENGTH:
            return none, none.astype(np.uint64), none
        words = np.ndarray((self.n + 8,), dtype="<u8", buffer=self.bytes, strides=(1,))
        n = self.n - K + 1
        h = words[:n] * _A
        h ^= h >> np.uint64(29)
        h += words[8:n + 8] * _B
        h ^= h >> np.uint64(32)
        h *= _C
        h += words[K - 8:n + K - 8] * _A
        h ^= h >> np.uint64(31)
        h *= _B
        h >>= np.uint64(64 - _TOP)
        h += np.uint64(1)
        least = h
        for s in (1, 2, 4, 8, 16):
            least = np.minimum(least[:-s], least[s:])
        # windows that reach beyond their document choose nothing
        crossing = np.zeros(self.n + 1, dtype=np.int8)
        late = np.maximum(self.starts, self.ends - LENGTH + 1)
        np.add.at(crossing, late, 1)
        np.add.at(crossing, self.ends, -1)
        least = np.where(np.cumsum(crossing[:len(least)], dtype=np.int8) > 0, np.uint64(0), least)
        best = np.concatenate([np.zeros(SPAN - 1, np.uint64), least, np.zeros(SPAN - 1, np.uint64)])
        for s in (1, 2, 4, 8, 16):
            best = np.maximum(best[:-s], best[s:])
        at = np.flatnonzero(best[:n] == h)
        return at, h[at], np.searchsorted(self.ends, at, side="right")

    def surroundings(self, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """A row of bytes for each anchor; what lies beyond the document is 0."""
        left = np.minimum(SIDE, at - self.starts[doc])
        right = np.minimum(SIDE, self.ends[doc] - at - K)
        out = np.zeros((len(at), _ROW), dtype=np.uint8)
        out[:, :CONTEXT] = np.lib.stride_tricks.sliding_window_view(self.padded, CONTEXT)[at]
        out[:, CONTEXT], out[:, CONTEXT + 1] = left, right + 1
        short = np.flatnonzero((left < SIDE) | (right < SIDE))
        _blanked(out, short, left[short], right[short])
        return out


def _blanked(rows: np.ndarray, which: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Sets to 0 what lies beyond ``left`` and ``right`` bytes from the anchor."""
    offsets = np.arange(CONTEXT) - SIDE
    kept = (offsets >= -left[:, None]) & (offsets < K + right[:, None])
    rows[which, :CONTEXT] = np.where(kept, rows[which, :CONTEXT], 0)
    rows[which, CONTEXT], rows[which, CONTEXT + 1] = left, right + 1


def single_starts(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Surroundings cut to one string of LENGTH bytes each: (row, number of the surroundings)."""
    left, right = rows[:, CONTEXT].astype(np.int64), rows[:, CONTEXT + 1].astype(np.int64) - 1
    parts, of = [np.empty((0, _ROW), np.uint8)], [np.empty(0, np.int64)]
    for back in range(SIDE + 1):
        valid = np.flatnonzero((left >= back) & (right >= SIDE - back))
        own = rows[valid]
        size = np.full(len(valid), back)
        _blanked(own, np.arange(len(valid)), size, SIDE - size)
        parts.append(own)
        of.append(valid)
    return np.concatenate(parts), np.concatenate(of)


def _hashed(rows: np.ndarray) -> np.ndarray:
    words = rows.view("<u8")
    total = np.zeros(len(rows), dtype=np.uint64)
    for k in range(words.shape[1]):
        total = (total ^ words[:, k]) * _B
        total ^= total >> np.uint64(29)
    return total


def _planes(h: np.ndarray) -> bytes:
    """Sorted numbers of 48 bits, most significant bytes first: the leading planes compress well."""
    return np.ascontiguousarray(h.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].T).tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(6, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, 2:] = planes.T
    return out.view(">u8").ravel().astype(np.uint64)


def deep_shallow(words: np.ndarray, group: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Sorts the rows of ``words`` (strings as big-endian words) inside their groups.

    Returns the order, and for each place of it the number of its leaf (equal strings)."""
    n = len(words)
    order = np.argsort(group, kind="stable")
    group = group[order]
    leaf = np.r_[True, group[1:] != group[:-1]] if n else np.empty(0, bool)

    def refined(key: np.ndarray, order: np.ndarray, leaf: np.ndarray, at: np.ndarray) -> None:
        """Sorts the places ``at`` (whole groups) by ``key`` and parts groups where it changes."""
        number = np.cumsum(leaf)[at]
        by = np.lexsort((key, number))
        order[at] = order[at][by]
        key, number = key[by], number[by]
        leaf[at[1:]] |= (key[1:] != key[:-1]) & (number[1:] == number[:-1])

    def open_groups(leaf: np.ndarray) -> np.ndarray:
        return np.flatnonzero(~leaf | np.r_[~leaf[1:], False])

    for d in range(shallow):
        at = open_groups(leaf)
        if not len(at):
            break
        refined(words[order[at], d], order, leaf, at)
    at = open_groups(leaf)
    while len(at):
        own = words[order[at], shallow:]
        first = np.flatnonzero(leaf[at])
        number = np.cumsum(leaf[at]) - 1
        differs = own != own[first][number]
        depth = np.where(differs.any(1), differs.argmax(1), words.shape[1])
        branch = np.minimum.reduceat(depth, first)[number]
        more = branch < words.shape[1]
        at, own, branch = at[more], own[more], branch[more]
        if not len(at):
            break
        refined(own[np.arange(len(at)), branch], order, leaf, at)
        still = ~leaf[at] | np.r_[~leaf[at][1:], False]
        at = at[still]
    return order, np.cumsum(leaf) - 1


def least_ids(rows: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For surroundings with their ids: the least id of each distinct one, the number of each row's
    distinct one, its line in the table if its anchor has several, and the table: for each start, which
    distinct surroundings have the least id."""
    order = np.argsort(rows.view(f"S{_ROW}").ravel(), kind="stable")
    ordered = rows[order]
    new = np.r_[True, (ordered[1:] != ordered[:-1]).any(1)]
    kind = np.cumsum(new) - 1
    distinct = ordered[new]
    own = np.minimum.reduceat(ids[order], np.flatnonzero(new))
    number = np.empty(len(rows), dtype=np.int64)
    number[order] = kind
    _, anchor, count = np.unique(np.ascontiguousarray(distinct[:, SIDE:SIDE + K]).view(f"S{K}").ravel(),
                                 return_inverse=True, return_counts=True)
    several = np.flatnonzero(count[anchor] > 1)
    table = np.repeat(several[:, None].astype(np.int32), SIDE + 1, axis=1)  # which surroundings have the least id
    texts, group = distinct[several], anchor[several]
    left, right = texts[:, CONTEXT].astype(int), texts[:, CONTEXT + 1].astype(int) - 1
    for back in range(SIDE + 1):  # the suffixes that start ``back`` bytes before the anchor
        valid = np.flatnonzero((left >= back) & (right >= SIDE - back))
        if not len(valid):
            continue
        strings = np.zeros((len(valid), 56), dtype=np.uint8)
        strings[:, :LENGTH] = texts[valid, SIDE - back:SIDE - back + LENGTH]
        place, leaf = deep_shallow(strings.view(">u8").astype(np.uint64), group[valid])
        starts = np.flatnonzero(np.r_[True, leaf[1:] != leaf[:-1]])
        first = np.lexsort((own[several][valid][place], leaf))[starts]
        table[valid[place], back] = several[valid][place][first][leaf].astype(np.int32)
    slot = np.full(len(distinct), -1, dtype=np.int64)
    slot[several] = np.arange(len(several))
    return own, number, slot, table


def _slices(texts, limit: int = BLOCK_BYTES) -> Iterator[slice]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def remove_repeats(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each document (doc_id, text)."""
    text = F.coalesce("text", F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_BYTES))
    buckets = max(1, blocks // BLOCKS_PER_BUCKET)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    lost = named.filter(F.col("doc_id").isNull()).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
    named = named.filter(F.col("doc_id").isNotNull()).withColumn(
        "block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int"))

    def bucket_of(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(8)) % np.uint64(buckets)

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in _slices(frame["text"].tolist()):
                f = frame.iloc[part]
                _, h, doc = Texts(f["text"]).anchors()
                if not len(h):
                    continue
                h, doc = _unique_pairs(h, doc)
                block = f["block"].to_numpy()[doc]
                order = np.lexsort((block, h, bucket_of(h)))
                h, block = h[order], block[order]
                first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (block[1:] != block[:-1])])
                count = np.diff(np.r_[first, len(h)])
                h, block = h[first], block[first]
                edges = np.flatnonzero(np.r_[True, np.diff(bucket_of(h).astype(np.int64)) != 0, True])
                yield pd.DataFrame([(int(bucket_of(h[s:s + 1])[0]), _planes(h[s:e]), block[s:e].astype("<u4").tobytes(), count[s:e].astype("<u4").tobytes())
                                    for s, e in zip(edges, edges[1:])], columns=["bucket", "h", "blocks", "counts"])

    def shared(f: pd.DataFrame) -> pd.DataFrame:
        h = np.concatenate([_unplanes(x) for x in f["h"]])
        block = np.concatenate([np.frombuffer(x, "<u4") for x in f["blocks"]])
        _, number = np.unique(h, return_inverse=True)
        documents = np.bincount(number, np.concatenate([np.frombuffer(x, "<u4") for x in f["counts"]]))[number]
        more = documents > 1
        h, block, documents = h[more], block[more], documents[more]
        order = np.lexsort((h, block))
        h, block, documents = h[order], block[order], documents[order]
        first = np.r_[True, (h[1:] != h[:-1]) | (block[1:] != block[:-1])][:len(h)]
        h, block, crowded = h[first], block[first], documents[first] > crowd
        edges = np.flatnonzero(np.r_[True, np.diff(block.astype(np.int64)) != 0, True]) if len(h) else np.array([0])
        return pd.DataFrame([(int(block[s]), h[s:e].astype("<u8").tobytes(), h[s:e][crowded[s:e]].astype("<u8").tobytes())
                             for s, e in zip(edges, edges[1:])], columns=["block", "h", "crowded"])

    repeated = settled(named.select("block", "text", "doc_id").mapInPandas(find, "bucket int, h binary, blocks binary, counts binary")
                       .groupBy("bucket").applyInPandas(shared, "block int, h binary, crowded binary"))

    def surround(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = ["bucket", "block", "rows", "ids", "crowded"]
        if not len(left) or not len(right):
            return pd.DataFrame([], columns=columns)
        texts = Texts(left["text"])
        at, h, doc = texts.anchors()
        wanted = np.isin(h, np.concatenate([np.frombuffer(x, "<u8") for x in right["h"]]))
        at, h, doc = at[wanted], h[wanted], doc[wanted]
        if not len(at):
            return pd.DataFrame([], columns=columns)
        rows, ids = texts.surroundings(at, doc), left["doc_id"].to_numpy()[doc]
        crowded = np.isin(h, np.concatenate([np.frombuffer(x, "<u8") for x in right["crowded"]]))
        rows, ids, to = rows[~crowded], ids[~crowded], bucket_of(h[~crowded])
        if crowded.any():
            each, of = single_starts(texts.surroundings(at[crowded], doc[crowded]))
            rows, ids = np.concatenate([rows, each]), np.r_[ids, left["doc_id"].to_numpy()[doc[crowded]][of]]
            to = np.r_[to, bucket_of(_hashed(each))]
        order = np.argsort(rows.view(f"S{_ROW}").ravel(), kind="stable")
        rows, ids, to = rows[order], ids[order], to[order]
        first = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(1)][:len(rows)])
        if not len(first):
            return pd.DataFrame([], columns=columns)
        rows, ids, to = rows[first], np.minimum.reduceat(ids, first), to[first]
        order = np.argsort(to, kind="stable")
        rows, ids, to = rows[order], ids[order], to[order].astype(np.int64)
        edges = np.flatnonzero(np.r_[True, np.diff(to) != 0, True])
        block, split = int(left["block"].iloc[0]), np.unique(h[crowded]).astype("<u8").tobytes()
        return pd.DataFrame([(int(to[s]), block, rows[s:e].tobytes(), ids[s:e].astype("<i8").tobytes(), split if not i else b"")
                             for i, (s, e) in enumerate(zip(edges, edges[1:]))], columns=columns)

    def compared(f: pd.DataFrame) -> pd.DataFrame:
        rows = [np.frombuffer(x, np.uint8).reshape(-1, _ROW) for x in f["rows"]]
        own, number, slot, table = least_ids(np.concatenate(rows), np.concatenate([np.frombuffer(x, "<i8") for x in f["ids"]]))
        out, done = [], 0
        for block, part, crowded in zip(f["block"], rows, f["crowded"]):
            mine = number[done:done + len(part)]
            done += len(part)
            s = slot[mine]
            # the ids that this block needs, once each, and their numbers in the table
            needed, at = np.unique(table[s[s >= 0]], return_inverse=True)
            out.append((block, _hashed(part).tobytes(), own[mine].tobytes(), (s >= 0).tobytes(), own[needed].tobytes(), at.astype(np.int32).tobytes(), crowded))
        return pd.DataFrame(out, columns=["block", "keys", "own", "several", "ids", "starts", "crowded"])

    texts = named.groupBy("block")
    around = texts.cogroup(repeated.groupBy("block")).applyInPandas(surround, "bucket int, block int, rows binary, ids binary, crowded binary")
    answers = settled(around.groupBy("bucket").applyInPandas(
        compared, "block int, keys binary, own binary, several binary, ids binary, starts binary, crowded binary"))

    def cut(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        if not len(left):
            return pd.DataFrame([], columns=columns)
        texts, ids = Texts(left["text"]), left["doc_id"].to_numpy()
        step = np.zeros(texts.n + 1, dtype=np.int32)
        if len(right):
            keys, own, several = (np.concatenate([np.frombuffer(x, t) for x in right[c]]) for c, t in (("keys", np.uint64), ("own", np.int64), ("several", bool)))
            # numbers of ids go on from one answer to the next
            known = [np.frombuffer(x, np.int64) for x in right["ids"]]
            starts = [np.frombuffer(x, np.int32).reshape(-1, SIDE + 1) for x in right["starts"]]
            for shift, part in zip(np.cumsum([0, *map(len, known[:-1])]), range(len(starts))):
                starts[part] = starts[part] + np.int32(shift)
            known, table = np.concatenate(known), np.concatenate(starts)
            slot = np.cumsum(several) - 1
            order = np.argsort(keys)
            answers = _Answers(keys[order], order, own, several, slot, known, table)
            at, h, doc = texts.anchors()
            crowded = np.isin(h, np.concatenate([np.frombuffer(x, "<u8") for x in right["crowded"]]))
            for chosen, alone in ((~crowded, False), (crowded, True)):
                places, docs_of, many = at[chosen], doc[chosen], 5_000 if alone else 50_000
                for s in range(0, len(places), many):
                    _cover(step, texts, places[s:s + many], docs_of[s:s + many], ids, answers, alone)
        gone = np.cumsum(step[:-1]) > 0
        rise = np.r_[gone[:1], gone[1:] & ~gone[:-1]] if texts.n else gone
        inner = texts.starts[(texts.lengths > 0)]
        rise[inner] = gone[inner]  # a run ends with its document
        out = []
        for doc_id, s, e in zip(ids, texts.starts, texts.ends):
            kept = texts.bytes[s:e][~gone[s:e]].tobytes()
            out.append((int(doc_id), e - s, e - s - len(kept), int(rise[s:e].sum()), hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(out, columns=columns)

    done = texts.cogroup(answers.groupBy("block")).applyInPandas(cut, _RESULT)
    return done.unionByName(lost)


def _unique_pairs(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    first = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]
    return h[first], doc[first]


@dataclass(frozen=True)
class _Answers:
    """Surroundings by sorted key: their least id, or the least id for each start."""

    keys: np.ndarray
    order: np.ndarray
    own: np.ndarray
    several: np.ndarray
    slot: np.ndarray
    known: np.ndarray
    table: np.ndarray


def _cover(step, texts, at, doc, ids, answers: _Answers, alone: bool) -> None:
    """Adds +1 and -1 where runs of repeated bytes begin and end. ``alone``: start by start."""
    rows = texts.surroundings(at, doc)
    if alone:
        rows, of = single_starts(rows)
        at, doc = at[of], doc[of]
    key = _hashed(rows)
    found = np.minimum(np.searchsorted(answers.keys, key), len(answers.keys) - 1)
    hit = answers.keys[found] == key
    at, doc, rows, number = at[hit], doc[hit], rows[hit], answers.order[found[hit]]
    left, right = rows[:, CONTEXT].astype(np.int64), rows[:, CONTEXT + 1].astype(np.int64) - 1
    several = answers.several[number]
    one = ~several & (answers.own[number] < ids[doc]) & (left + right >= SIDE)
    np.add.at(step, (at - left)[one], 1)
    np.add.at(step, (at + K + right)[one], -1)
    many = np.flatnonzero(several)
    line = answers.slot[number[many]]
    for back in range(SIDE + 1):
        least = answers.known[answers.table[line, back]]
        ok = many[(least < ids[doc[many]]) & (left[many] >= back) & (right[many] >= SIDE - back)]
        np.add.at(step, at[ok] - back, 1)
        np.add.at(step, at[ok] - back + LENGTH, -1)


def oracle(length: int = LENGTH) -> str:
    """The same in the SQL of an embedded database, string by string (for small tables)."""
    return f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
-- in short pieces first, as a position in a long text is found by counting
q AS (SELECT doc_id, o, substr(h, 2 * o + 1, 2 * (256 + {length - 1})) AS h FROM (
        SELECT doc_id, h, unnest(range(0, length(h) // 2 - {length - 1}, 256)) AS o FROM d WHERE length(h) >= {2 * length})),
w AS (SELECT doc_id, o + i AS p, substr(h, 2 * i + 1, {2 * length}) AS s FROM (
        SELECT doc_id, o, h, unnest(range(0, length(h) // 2 - {length - 1})) AS i FROM q)),
f AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
c AS (SELECT doc_id, p FROM w JOIN f USING (s) WHERE least < doc_id),
g AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {length} THEN 0 ELSE 1 END AS new FROM c),
r AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM g),
s AS (SELECT doc_id, min(p) AS a, max(p) + {length} AS b FROM r GROUP BY doc_id, run),
k AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_ FROM s),
t AS (SELECT doc_id, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed, max(b) AS last,
             string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY a) AS head FROM k JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)"""
