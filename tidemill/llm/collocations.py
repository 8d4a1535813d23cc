"""Phrase collocations by marginalising counts of the longest windows.

A window holds a word and its (lead) next three words of the same piece, padded at the end. Only these
longest windows are counted; Spark's ROLLUP over the four columns sums the counts of windows that
begin alike, which is the number of occurrences of each phrase of three, two and one words and, at the
level of the language alone, of all words. So no phrase length is exploded by itself.

Two passes before count phrases in sketches of hashed cells (a cell counts up to ``least`` and is never
too low): words and pairs of words, then the phrases of three and four words all of whose pairs may
be frequent. A window is padded from where its cells prove that no phrase goes on ``least`` times:
every phrase that has ``least`` occurrences keeps them all. A sketch has a cell of one byte for every
``BYTES_PER_CELL`` bytes of text, ``MOST_CELLS`` (256 MB) at most, so that as much is pruned from more
text; beyond that windows only get longer, with the same result.

A candidate's score is that of its lowest cut. Cuts and contained phrases are looked up by joins on
(language, phrase). The best of a language are chosen in ``SHARES`` shares first, so that the task
that ranks a language reads a bounded number of rows.

Defined cases: null text has no words; a null language is ``und``; documents aren't told apart, so
ids may be null or repeated and repeated rows count each; any length of text is cut into blocks at
the ends of pieces; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import settled, text_or_empty

LONGEST = 4
LEAST, CONTAINED, PER_LANG = 30, 80, 2000
BYTES_PER_CELL, LEAST_CELLS, MOST_CELLS, SEGMENTS = 32, 1 << 20, 1 << 28, 256
BLOCK_BYTES = 2_000_000
SHARES = 64
#: Lengths of phrases that the two sketches count.
FIRST, THEN = (1, 2), (3, 4)
_W = [f"w{k}" for k in range(1, LONGEST + 1)]
_END = b"."
_MARKS = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d", b"\n" * 10)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _cut(data: bytes, limit: int) -> Iterator[bytes]:
    start = 0
    while start < len(data):
        end = start + limit
        end = len(data) if end >= len(data) else data.find(b"\n", end)
        end = len(data) if end < 0 else end
        yield data[start:end]
        start = end


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """(language, words, numbers): the words' numbers one after the other, 0 between pieces."""
    texts: dict[str, list[bytes]] = defaultdict(list)
    sizes: dict[str, int] = defaultdict(int)

    def numbered(lang: str) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
        del sizes[lang]
        for part in _cut(b"\n".join(texts.pop(lang)).lower().translate(_MARKS), limit):  # lower() touches A-Z only
            number = {_END: 0}
            tokens = part.replace(b"\n", b" . ").split()
            ids = np.fromiter((number.setdefault(t, len(number)) for t in tokens), dtype=np.int64, count=len(tokens))
            yield lang, list(number), ids

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            lang, text = lang.as_py(), text.as_py()
            texts[lang].append(text)
            sizes[lang] += len(text) + 1
            if sizes[lang] >= limit:
                yield from numbered(lang)
            elif len(sizes) > 16:  # many languages wait with little text each
                yield from numbered(max(sizes, key=sizes.get))
    for lang in list(sizes):
        yield from numbered(lang)


class _Block:
    """The windows of a block: columns of numbers and the cells of what they begin with."""

    def __init__(self, lang: str, words: list[bytes], ids: np.ndarray, cells: int):
        seed = xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))
        self.hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), dtype=np.uint64, count=len(words))
        self.columns, self.cells = [ids], cells
        for _ in range(LONGEST - 1):
            self.columns.append(np.where(self.columns[-1] > 0, np.r_[self.columns[-1][1:], 0][:len(ids)], 0))

    def cell(self, n: int) -> np.ndarray:
        """The cells of the first n words of each window."""
        code = self.hashes[self.columns[0]]
        for column in self.columns[1:n]:
            code = ((code ^ (code >> np.uint64(29))) * _FACTOR + self.hashes[column]) * _FACTOR
        return ((code ^ (code >> np.uint64(32))) % np.uint64(self.cells)).astype(np.int64)

    def keep(self, n: int, begins: np.ndarray) -> None:
        """Pads windows from the n-th word on where the first n words don't begin a window to keep, nor
        those that end there a phrase to keep."""
        self.columns[n - 1] = np.where(begins, self.columns[n - 1], 0)
        for k in range(n, LONGEST):
            ends = np.r_[begins[k - n + 1:], np.zeros(k - n + 1, bool)][:len(begins)]
            self.columns[k] = np.where((self.columns[k - 1] > 0) & ends, self.columns[k], 0)

    def prune(self, sketch: np.ndarray, lengths: tuple[int, ...], most: int) -> None:
        # all cells are of whole windows, so they come before the first is cut
        for n, cells in [(n, self.cell(n)) for n in lengths]:
            self.keep(n, (self.columns[n - 1] > 0) & (sketch[cells] >= most))


def sketched(texts: DataFrame, most: int, cells: int, lengths: tuple[int, ...], before: Broadcast | None = None) -> np.ndarray:
    """Counts by cell, up to ``most``, of the phrases of these lengths that ``before``, the sketch of words
    and pairs, leaves."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(cells, dtype=np.uint8)
        for lang, words, ids in blocks(batches):
            block = _Block(lang, words, ids, cells)
            if before is not None:
                block.prune(before.value, FIRST, most)
            for n in lengths:
                found, counts = np.unique(block.cell(n)[block.columns[n - 1] > 0], return_counts=True)
                sketch[found] = np.minimum(sketch[found] + counts, most)
        parts = sketch.reshape(SEGMENTS, -1)
        for s in np.flatnonzero(parts.any(axis=1)):
            yield pa.RecordBatch.from_pydict({"segment": pa.array([s], pa.int32()), "cells": [zlib.compress(parts[s].tobytes(), 1)]})

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                more = np.frombuffer(zlib.decompress(part), np.uint8)
                total[s] = np.minimum(total[s].astype(np.uint16) + more, most).astype(np.uint8) if s in total else more
        if total:
            yield pa.RecordBatch.from_pydict({"segment": pa.array(list(total), pa.int32()), "cells": [zlib.compress(x.tobytes(), 1) for x in total.values()]})

    kind = "segment int, cells binary"
    out = np.zeros((SEGMENTS, cells // SEGMENTS), dtype=np.uint8)
    for row in settled(texts.mapInArrow(count, kind).repartition("segment").mapInArrow(fold, kind)).collect():
        out[row.segment] = np.frombuffer(zlib.decompress(row.cells), np.uint8)
    return out.ravel()


def windows(texts: DataFrame, least: int, cells: int) -> DataFrame:
    """(lang, w1 ... w4, c): counts of the windows; '' pads. (They are counted as one text, without
    the padding, and parted into columns then.)"""
    most, context = min(least, 255), texts.sparkSession.sparkContext
    first = context.broadcast(sketched(texts, most, cells, FIRST))
    then = context.broadcast(sketched(texts, most, cells, THEN, first))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids in blocks(batches):
            block = _Block(lang, words, ids, cells)
            block.prune(first.value, FIRST, most)
            block.prune(then.value, THEN, most)
            distinct, counts = _counted([c[ids > 0] for c in block.columns])
            words[0] = b""
            for s in range(0, len(counts), 50_000):
                rows = zip(*(c[s:s + 50_000].tolist() for c in distinct))
                joined = [b" ".join([words[i] for i in row if i]) for row in rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(joined), pa.string()), pa.array(joined, pa.binary()).cast(pa.string()), pa.array(counts[s:s + 50_000])],
                    names=["lang", "words", "c"])

    found = texts.mapInArrow(count, "lang string, words string, c long").groupBy("lang", "words").agg(F.sum("c").alias("c"))
    each = F.split("words", " ")
    return found.select("lang", *(F.coalesce(F.get(each, F.lit(k)), F.lit("")).alias(w) for k, w in enumerate(_W)), "c")


def _counted(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of the columns and how often each is there."""
    code, size = columns[0], int(columns[0].max(initial=0)) + 1
    firsts = []
    for c in columns[1:]:
        # the rows so far get consecutive numbers, so that a code of two stays below 2^63
        found, code = np.unique(code * (int(c.max(initial=0)) + 1) + c, return_inverse=True)
        firsts.append((found, int(c.max(initial=0)) + 1))
    counts = np.bincount(code, minlength=len(firsts[-1][0])) if len(code) else np.empty(0, np.int64)
    out, rows = [], np.arange(len(counts))
    for found, base in reversed(firsts):
        code = found[rows]
        out.append(code % base)
        rows = code // base
    return [rows, *reversed(out)], counts


def phrase_counts(docs: DataFrame, least: int = LEAST, cells: int | None = None) -> DataFrame:
    """(lang, words, phrase, f): phrases of 1 to 4 words with ``least`` occurrences, and for each
    language a row with 0 words, the number of all its words."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_or_empty().cast("binary").alias("text"))
    if cells is None:
        size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        cells = min(MOST_CELLS, max(LEAST_CELLS, 1 << (size // BYTES_PER_CELL).bit_length()))
    rolled = windows(texts, least, cells).rollup("lang", *_W).agg(F.sum("c").alias("f"), F.grouping_id().alias("_level"))
    words = F.element_at(F.array(*(F.lit(k) for k in range(LONGEST, -1, -1))), (F.log2(F.col("_level") + 1) + 1).cast("int"))
    rolled = rolled.filter(f"_level < {2 ** (LONGEST + 1) - 1}").withColumn("words", words)
    last = F.when(F.col("words") == 0, F.lit("x"))
    for k, w in enumerate(_W, 1):
        last = last.when(F.col("words") == k, F.col(w))
    rolled = rolled.filter((last != "") & ((F.col("words") == 0) | (F.col("f") >= least)))
    return settled(rolled.select("lang", "words", F.concat_ws(" ", *_W).alias("phrase"), "f"))


def scored(counts: DataFrame, contained: int = CONTAINED) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates that are in no longer one."""
    found = counts.filter("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("_w"))
    f = counts.filter("words > 0").select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), "f")

    def looked_up(rows: DataFrame, part: str, name: str) -> DataFrame:
        return rows.join(f, (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_part"))).withColumnRenamed("f", name).drop("_lang", "_part", part)

    cuts = found.select("lang", "phrase", "a", "_w", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("_w", F.lit(1), F.col("k")), " ").alias("_first"),
                       F.array_join(F.slice("_w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("_rest"))
    cuts = looked_up(looked_up(cuts, "_first", "l"), "_rest", "r")
    exact = F.expr("(2000000bd * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    best = cuts.withColumn("score", exact.cast("long")).groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("_b"))

    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: F.array_join(F.slice("_w", i, n), " "))))
    longer = found.filter("words > 2").select("lang", "a", F.explode(F.array_distinct(inner)).alias("phrase"))
    longer = longer.groupBy(F.col("lang").alias("_lang"), F.col("phrase").alias("_inner")).agg(F.max("a").alias("_most"))
    joined = best.join(longer, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_inner")), "left")
    free = F.col("_most").isNull() | (F.col("_most").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * contained)
    return joined.filter(free).select("lang", "phrase", "a", "_b.l", "_b.r", "_b.score")


def collocations(
    docs: DataFrame, *, least: int = LEAST, contained: int = CONTAINED, per_lang: int = PER_LANG, cells: int | None = None,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language of ``docs`` (text, lang)."""
    counts = phrase_counts(docs, least, cells)
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    rows = scored(counts, contained).withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    rows = rows.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*order))).filter(F.col("_r") <= per_lang)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= per_lang)
    n = counts.filter("words = 0").select(F.col("lang").alias("_lang"), F.col("f").alias("n"))
    return rows.join(n, F.col("lang") == F.col("_lang")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle(least: int = LEAST, contained: int = CONTAINED, per_lang: int = PER_LANG) -> str:
    """The same in the SQL of an embedded database, phrase length by phrase length."""
    lengths = range(1, LONGEST + 1)
    grams = "\n  UNION ALL ".join(
        f"SELECT lang, {n} AS words, array_to_string(w[i:i + {n - 1}], ' ') AS phrase FROM (SELECT lang, w, unnest(range(1, len(w) - {n} + 2)) AS i FROM p)"
        for n in lengths)
    return f"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM t),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
f AS (SELECT lang, words, phrase, string_split(phrase, ' ') AS w, count(*) AS f FROM ({grams})
      GROUP BY ALL HAVING count(*) >= {least}),
k AS (SELECT *, unnest(range(1, words)) AS k FROM f WHERE words > 1),
c AS (SELECT k.lang, k.phrase, k.f AS a, k, x.f AS l, y.f AS r, ((2000000::HUGEINT * k.f) // (x.f + y.f))::BIGINT AS score
      FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.w[1:k], ' ')
             JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.w[k + 1:], ' ')),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, array_to_string(w[i:i + n - 1], ' ') AS phrase, max(f) AS most FROM (
        SELECT lang, w, f, n, unnest(range(1, words - n + 2)) AS i FROM (
          SELECT *, unnest(range(2, words)) AS n FROM f WHERE words > 2)) GROUP BY 1, 2),
r AS (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, score
      FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase
      WHERE most IS NULL OR 100 * most < {contained} * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM r JOIN n USING (lang) WHERE rank <= {per_lang}"""
