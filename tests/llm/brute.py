"""Plain and slow versions of the operators' contracts, on lists of rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, n: int = 5) -> set:
    words = WORD.findall(lowered(text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))}


def near_duplicates(docs, percent: int) -> dict:
    """doc_id -> (set size, component) from all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    common = Counter()
    for ids in where.values():
        ids = sorted(set(ids))
        for a in range(len(ids)):
            for b in range(a):
                common[ids[b], ids[a]] += 1
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def removed_bytes(docs, length: int = 50) -> dict:
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256)."""
    data = [(i, (t or "").encode()) for i, t in docs]
    least: dict[bytes, int] = {}
    for i, b in data:
        for s in range(len(b) - length + 1):
            x = b[s:s + length]
            least[x] = min(least.get(x, i), i)
    out = {}
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if least[b[s:s + length]] < i:
                gone[s:s + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(b) else 0
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def statistics(text) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    windows = [tuple(words[i:i + 8]) for i in range(n - 7)]
    count = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = n < 20 or 100 * len(repeated) > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed


def nearest(vectors, queries, k: int = 20) -> dict:
    """query_id -> [(vec_id, score)] over all others."""
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors], dtype=np.float64)
    out = {}
    for q in queries:
        score = x @ x[ids == q][0]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def crc_of(ids) -> int:
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())
