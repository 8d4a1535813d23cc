"""Cost-balanced packing of token sequences.

A shard of documents (consecutive rows of a partition, about ``shard_tokens`` tokens) is packed in
the task that reads it, without a shuffle: documents fill whole sequences first, the rest are pieces
shorter than a sequence. A piece of n tokens costs ``n + quadratic * n * n`` (the linear layers and
attention). Pieces, in descending order, go to the sequence with the lowest cost among those with
room for all of it, found by an exact index over the room left; only if there is none, it is cut to
fill the cheapest one. A shard has as many sequences as its tokens need, so only its last one is padded.

Defined cases: null or empty text is a document of the end token alone; null ids and repeated rows
are documents like others; an empty table has no pieces; texts are encoded whole, and cut at any
length. Other columns are ignored. A retried task makes the same pieces and numbers.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

CAPACITY = 2048
QUADRATIC = 1.0 / 4096
SHARD_TOKENS = 4_000_000
_SHARD_BITS = 36

_NONE = (float("inf"), -1, 0)
_ENCODERS: dict[str, object] = {}


def encoder(path: str, pattern: str, special_tokens: Mapping[str, int]):
    """Byte-level BPE from a file of ranks, kept in the worker process. A special token's string in
    a text is that token, as in the vocabulary's own library."""
    if path not in _ENCODERS:
        import base64

        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODERS[path] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special_tokens))
    return _ENCODERS[path]


class _Rooms:
    """Sequences in a heap of costs for each room left, and a tree of the cheapest over the rooms."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.heaps: dict[int, list[tuple[float, int, int]]] = {}
        self.tree = [_NONE] * (2 * self.size)

    def add(self, cost: float, sequence: int, room: int) -> None:
        heap = self.heaps.setdefault(room, [])
        heapq.heappush(heap, (cost, sequence, room))
        if heap[0][1] == sequence:
            self._renew(room)

    def take(self, least: int) -> tuple[float, int, int] | None:
        """The cheapest sequence with room for ``least``, taken out."""
        tree, i = self.tree, self.size + least
        best = tree[i]
        while i > 1:
            if not i & 1 and tree[i + 1] < best:
                best = tree[i + 1]
            i >>= 1
        if best is _NONE:
            return None
        heapq.heappop(self.heaps[best[2]])
        self._renew(best[2])
        return best

    def _renew(self, room: int) -> None:
        tree, i, heap = self.tree, self.size + room, self.heaps[room]
        tree[i] = heap[0] if heap else _NONE
        i >>= 1
        while i:
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
            i >>= 1


def assign(lengths: np.ndarray, capacity: int = CAPACITY, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents with these lengths."""
    pieces, rest, sequence = [], [], 0
    for doc, n in enumerate(lengths.tolist()):
        whole = n // capacity
        for i in range(whole):
            pieces.append((doc, i * capacity, capacity, sequence, 0))
            sequence += 1
        if n % capacity:
            rest.append((n % capacity, doc, whole * capacity))
    rest.sort(key=lambda r: (-r[0], r[1]))
    left = sum(r[0] for r in rest)
    sizes = [capacity] * (left // capacity) + [left % capacity] * bool(left % capacity)
    rooms, used = _Rooms(capacity), {}
    for i, size in enumerate(sizes):
        rooms.add(0.0, sequence + i, size)
        used[sequence + i] = 0
    for n, doc, start in rest:
        while n:
            cost, to, room = rooms.take(n) or rooms.take(1)
            taken = min(n, room)
            pieces.append((doc, start, taken, to, used[to]))
            used[to] += taken
            if room > taken:
                rooms.add(cost + taken + quadratic * taken * taken, to, room - taken)
            n, start = n - taken, start + taken
    return pieces


def pack(
    docs: DataFrame, tokenizer_path: str, pattern: str, special_tokens: Mapping[str, int] | None = None, *, end_id: int = 1, capacity: int = CAPACITY,
    quadratic: float = QUADRATIC, shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Pieces of all documents (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, ids."""
    fields = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    schema = StructType([
        StructField("doc_id", docs.schema["doc_id"].dataType), *(StructField(f, LongType(), False) for f in fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, pattern, special_tokens or {}).encode_to_numpy
        first = TaskContext.get().partitionId() << _SHARD_BITS

        def packed(names: list, tokens: list[np.ndarray]) -> pa.RecordBatch:
            nonlocal first
            lengths = np.array([len(t) for t in tokens], dtype=np.int64)
            pieces = np.array(assign(lengths, capacity, quadratic), dtype=np.int64).reshape(-1, 5)
            doc, start, length, sequence, offset = pieces.T
            crc = [zlib.crc32(tokens[d][s:s + n].astype("<u4", copy=False).tobytes())
                   for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist())]
            columns = (start, length, np.array(crc, dtype=np.int64), lengths[doc], sequence + first, offset)
            first += int(sequence.max()) + 1
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays(names).take(pa.array(doc)), *(pa.array(c) for c in columns)], ["doc_id", *fields])

        names, tokens, total = [], [], 0
        for batch in batches:
            done = 0
            texts = batch.column("text")
            for i in range(batch.num_rows):
                ids = encode(texts[i].as_py() or "", allowed_special="all")
                tokens.append(np.append(ids.astype(np.uint32, copy=False), np.uint32(end_id)))
                total += len(tokens[-1])
                if total >= shard_tokens:
                    yield packed([*names, batch.column("doc_id")[done:i + 1]], tokens)
                    names, tokens, total, done = [], [], 0, i + 1
            if done < batch.num_rows:
                names.append(batch.column("doc_id")[done:])
        if tokens:
            yield packed(names, tokens)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
