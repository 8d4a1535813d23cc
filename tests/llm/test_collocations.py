"""Collocations against a plain count of every phrase."""

import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tests.llm.test_documents import edges, frame
from tidemill.llm import collocations


def plain(rows, least, contained=80, per_lang=2000):
    counts, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.lowered(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3, 4):
                counts[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        most = Counter()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    most[p[i:i + size]] = max(most[p[i:i + size]], a)
        found = []
        for p, a in candidates.items():
            if p in most and 100 * most[p] >= contained * a:
                continue
            score, _, l, r = min((int(Fraction(2_000_000 * a, f[p[:k]] + f[p[k:]])), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:per_lang], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def got(df, **options):
    return sorted(tuple(r) for r in collocations.collocations(df, **options).collect())


@pytest.mark.parametrize("least, per_lang", [(5, 2000), (30, 7), (300, 50)])
def test_equal_to_plain_counts(spark, sf_dir, least, per_lang):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = plain([(r.text, r.lang) for r in docs.collect()], least, per_lang=per_lang)
    assert got(docs, least=least, per_lang=per_lang) == want and (want or least == 300)


def test_cells_that_collide_lose_nothing(spark, sf_dir):
    """With 256 cells next to nothing is pruned: the same result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    rows = [(r.text, r.lang) for r in docs.collect()]
    assert got(spark.createDataFrame(rows, "text string, lang string"), least=4, cells=256) == plain(rows, 4)


def test_edges(spark):
    rows = [(i, "of The State, of the state\tof the\x0bstate of the state", lang, "a") for i in range(8) for lang in ("en", None, "")]
    rows += [(None, "a a a a a a a", "en", None), (1, "x y x y x y", "en", None), (1, "é Ä ä é Ä ä", "de", None)] * 5
    rows += edges()
    assert got(frame(spark, rows), least=5) == plain([(r[1], r[2]) for r in rows], 5)
    assert got(frame(spark, []), least=5) == []


def test_blocks_end_with_pieces():
    text = b"one two. three four five\nsix, seven " * 50
    batch = pa.RecordBatch.from_pydict({"lang": ["en"], "text": [text]})
    whole = [words[i] for _, words, ids in collocations.blocks(iter([batch]), 10**9) for i in ids]
    small = [words[i] for _, words, ids in collocations.blocks(iter([batch]), 64) for i in ids]
    assert [w for w in whole if w != b"."] == [w for w in small if w != b"."]
    assert [w for w in whole] == small


def test_counted_rows():
    rng = np.random.default_rng(1)
    columns = [rng.integers(0, 4, 500) for _ in range(4)]
    distinct, counts = collocations._counted(columns)
    assert dict(zip(zip(*distinct), counts)) == Counter(zip(*columns))
    assert len(collocations._counted([np.empty(0, np.int64)] * 4)[1]) == 0
