"""Near duplicates of documents by fast similarity sketching, banding and exact verification.

A document's set holds the hashes of its distinct shingles of five words. Its sketch has ``T``
coordinates, filled in rounds: in the first T rounds each element goes to a bin of its own choice, in
later rounds all elements go to one bin, and a coordinate keeps the least (round, hash); rounds end
when every coordinate is filled. So all are filled, and agreements are concentrated around the
Jaccard similarity. Bands of ``ROWS`` coordinates make candidates, which are verified on full sets.

Copies (equal sets) are one class with one node from the start. A bucket of a band links each member
to one hub, not all pairs; what the hubs leave in different components is tried again with other
hubs, then with the center of its family (all that buckets connect). What is still apart meets only
where prefixes of its differences from the center agree (``_far_members``), first with one hub for
each shared element and then in pairs, which loses no similar pair. So no link
between different components is lost, and a large group costs a few times its size.

At a similarity of 0.8 a pair shares no band with probability 5e-8, at 0.85 with 6e-11.

Defined cases: a text of fewer than five words is one shingle; null or empty texts or texts without
words have an empty set and stay alone; rows with a null id stay alone, with a null component;
repeated rows are copies; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemill.llm.common import cell_counts, settled, settled_if_any

SHINGLE = 5
BANDS, ROWS = 32, 4
T = BANDS * ROWS
HUB_ROUNDS, FAR_ROUNDS = 2, 1
CELLS = 1 << 22
_MEMO = 150_000
_ODD = np.random.default_rng(11).integers(1, 2**63, size=2 * T + SHINGLE + ROWS + 1, dtype=np.uint64) | np.uint64(1)
_WORDS: dict[bytes, int] = {}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct shingles (A-Z lower-cased)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # both touch ASCII only
    if not words:
        return np.empty(0, dtype=np.uint64)
    known = _WORDS
    if len(known) > _MEMO:
        known.clear()
    ids = np.empty(len(words), dtype=np.uint64)
    for i, w in enumerate(words):
        h = known.get(w)
        if h is None:
            h = known[w] = xxhash.xxh3_64_intdigest(w)
        ids[i] = h
    if len(words) < SHINGLE:
        out = np.array([len(words)], dtype=np.uint64)
        for x in ids:
            out = _mixed(out * _ODD[0] + x)
        return out
    n = len(words) - SHINGLE + 1
    total = np.zeros(n, dtype=np.uint64)
    for k in range(SHINGLE):
        total = _mixed(total * _ODD[k] + ids[k:k + n])
    return np.unique(total)


def sketch(items: np.ndarray, t: int = T) -> np.ndarray:
    """The fast similarity sketch of a non-empty set: t filled coordinates. A coordinate is the
    round in its top 16 bits and a hash below."""
    out = np.full(t, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(2 * t):
        h = _mixed(items * _ODD[SHINGLE + i % (2 * T)] + np.uint64(i))
        value = (np.uint64(i) << np.uint64(48)) | (h >> np.uint64(16))
        if i < t:
            np.minimum.at(out, (h % np.uint64(t)).astype(np.int64), value)
        else:
            out[i - t] = min(out[i - t], value.min())
        if out.max() != np.iinfo(np.uint64).max:
            break
    return out


def band_hashes(coordinates: np.ndarray) -> np.ndarray:
    rows = coordinates.reshape(BANDS, ROWS)
    total = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        total = _mixed(total * _ODD[2 * T + SHINGLE + k] + rows[:, k])
    return total.view(np.int64)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Jaccard similarity of at least ``percent`` / 100, in whole numbers; both sorted, distinct."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int((large[at] == small).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


@contextmanager
def _small_batches(df: DataFrame, rows: int):
    """Arrow batches of few rows, where each may carry the sets of two whole texts."""
    key, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    before = conf.get(key)
    conf.set(key, str(rows))
    try:
        yield
    finally:
        conf.set(key, before)


def features(docs: DataFrame) -> DataFrame:
    """doc_id, mark (hash of the text), n, digest (of the set; null if empty), bands."""
    @F.pandas_udf("n long, digest binary, bands array<long>")
    def measure(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            items = shingles(text)
            if len(items):
                out.append((len(items), xxhash.xxh3_128_digest(items.tobytes()), band_hashes(sketch(items))))
            else:
                out.append((0, None, None))
        return pd.DataFrame(out, columns=["n", "digest", "bands"])

    return docs.select("doc_id", F.xxhash64("text").alias("mark"), measure("text").alias("f")).select("doc_id", "mark", "f.*")


def components(links: DataFrame) -> DataFrame:
    """(a, b) → (node, root) for the connected components of the links.

    Each node hooks to its least neighbour, pointers are followed to the end, and the links between
    roots go to the next round."""
    everything, open_links = None, settled_if_any(links.select("a", "b"))
    while open_links is not None:
        both = open_links.union(open_links.select("b", "a"))
        hook = settled(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_least")).select(
            "node", F.least("node", "_least").alias("root")))
        while True:
            moved = Observation()
            next_ = hook.select(F.col("node").alias("root"), F.col("root").alias("_up"))
            jumped = hook.join(next_, "root").observe(moved, F.count_if(F.col("_up") != F.col("root")).alias("n"))
            hook = settled(jumped.select("node", F.col("_up").alias("root")))
            if not moved.get["n"]:
                break
        if everything is None:
            everything = hook
        else:
            up = hook.select(F.col("node").alias("root"), F.col("root").alias("_up"))
            changed = everything.join(up, "root", "left").select("node", F.coalesce("_up", "root").alias("root"))
            everything = settled(changed)
        a = hook.select(F.col("node").alias("a"), F.col("root").alias("_ra"))
        b = hook.select(F.col("node").alias("b"), F.col("root").alias("_rb"))
        open_links = settled_if_any(open_links.join(a, "a").join(b, "b").filter("_ra <> _rb").select(
            F.col("_ra").alias("a"), F.col("_rb").alias("b")).distinct())
    if everything is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return everything


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """The pairs (a, b) whose sets are similar; None without any."""
    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            ok = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                  for x, y in zip(f["_sa"], f["_sb"])]
            yield f.loc[ok, ["a", "b"]]

    both = pairs.join(sets.select(F.col("digest").alias("b"), F.col("items").alias("_sb")), "b").join(
        sets.select(F.col("digest").alias("a"), F.col("items").alias("_sa")), "a")
    with _small_batches(pairs, 256):
        return settled_if_any(both.select("a", "b", "_sa", "_sb").mapInPandas(check, "a binary, b binary"))


def _hub_pairs(buckets: DataFrame, number: int) -> DataFrame:
    """In each bucket with several labels: one hub, paired with all members of other labels.

    First the hub is the member with most company in its buckets: copies of a text differ from it
    each in its own way, so the text they come from has their most frequent bands. Later it is
    any member."""
    first = -F.col("company") if number == 0 else F.xxhash64("digest", F.lit(number))
    order = F.struct(first.alias("h"), "digest", "label", "n")
    hubs = buckets.groupBy("band").agg(F.min(order).alias("_hub"), F.min("label").alias("_l"), F.max("label").alias("_m")).filter("_l <> _m")
    return _distinct_pairs(buckets.join(hubs.select("band", "_hub"), "band"), "_hub")


def _distinct_pairs(joined: DataFrame, other: str) -> DataFrame:
    o = F.col(other)
    return joined.filter(o["label"] != F.col("label")).select(
        F.least("digest", o["digest"]).alias("a"), F.greatest("digest", o["digest"]).alias("b"), "n", o["n"].alias("_on")).distinct()


def _relabelled(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``label``: the root of a digest's component so far."""
    if roots is None:
        return rows.drop("label").withColumn("label", F.col("digest"))
    label = roots.select(F.col("node").alias("digest"), F.col("root").alias("_root"))
    return rows.drop("label").join(label, "digest", "left").withColumn("label", F.coalesce("_root", "digest")).drop("_root")


def _mixed_only(rows: DataFrame, key: list[str]) -> DataFrame | None:
    """The rows of keys with several labels; None without any."""
    mixed = rows.groupBy(*key).agg(F.min("label").alias("_l"), F.max("label").alias("_m")).filter("_l <> _m").select(*key)
    return settled_if_any(rows.join(mixed, key))


def _families(near: DataFrame, buckets: DataFrame, links: DataFrame | None) -> DataFrame:
    """For the members of buckets with several labels: the family (what buckets connect, similar or
    not) and its center, the member with most links: family, digest, n, center, center_n."""
    members = buckets.select("digest", "n", "company").distinct().join(
        near.select(F.col("node").alias("digest"), F.col("root").alias("family")), "digest")
    if links is None:
        degree = members.select("digest", F.lit(0).cast("long").alias("_links"))
    else:
        degree = links.select(F.explode(F.array("a", "b")).alias("digest")).groupBy("digest").agg(F.count(F.lit(1)).alias("_links"))
    ranked = members.join(degree, "digest", "left").groupBy("family").agg(
        F.max(F.struct(F.coalesce("_links", F.lit(0)).alias("l"), "company", F.col("digest").alias("center"), F.col("n").alias("center_n"))).alias("_c"))
    return settled(members.join(ranked, "family").select("family", "digest", "n", "_c.center", "_c.center_n"))


def _far_members(families: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """For each member of a family its difference D from the center's set, in prefixes: a row (family,
    digest, n, d = |D|, at, token) for the first elements of D in an order common to the family.

    Two sets of sizes n, m are similar if they differ in at most e = (n + m)(100 - percent)/(100 +
    percent) elements, and they differ in |Dx| + |Dy| - 2 |Dx & Dy|. So similar members share at least
    o = (|Dx| + |Dy| - e)/2 elements of their differences, hence one among the first |D| - o + 1 of
    each in any common order. (If o is not positive, both are similar to the center, which is known
    by now.) The order is by how often an element is in the family's differences, rarest first, as
    counted in a sketch of ``CELLS`` cells, whose collisions only change the order. Elements of a
    passage that most members share come last, and those of one member, which meet nobody, first.
    """
    def differences(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for x, c in zip(f["_sx"], f["_sc"]):
                out.append(np.setxor1d(np.frombuffer(x, np.uint64), np.frombuffer(c, np.uint64), assume_unique=True).tobytes())
            yield f.drop(columns=["_sx", "_sc"]).assign(tokens=out)

    both = families.join(sets.select("digest", F.col("items").alias("_sx")), "digest").join(
        sets.select(F.col("digest").alias("center"), F.col("items").alias("_sc")), "center")
    with _small_batches(families, 256):
        apart = settled(both.select("family", "digest", "n", "_sx", "_sc").mapInPandas(
            differences, "family binary, digest binary, n long, tokens binary"))

    def cells_of(family: bytes, tokens: bytes) -> tuple[np.ndarray, np.ndarray]:
        tokens = np.frombuffer(tokens, np.uint64)
        return tokens, _mixed(tokens + np.uint64(xxhash.xxh3_64_intdigest(family))) % np.uint64(CELLS)

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
        for f in frames:
            for family, tokens in zip(f["family"], f["tokens"]):
                yield cells_of(family, tokens)[1].astype(np.int64)

    sketch = families.sparkSession.sparkContext.broadcast(cell_counts(apart.select("family", "tokens"), counted, CELLS))

    def prefixes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            size, first = [], []
            for family, n, tokens in zip(f["family"], f["n"], f["tokens"]):
                tokens, cells = cells_of(family, tokens)
                size.append(len(tokens))
                order = np.lexsort((tokens, sketch.value[cells.astype(np.int64)]))
                first.append(tokens[order][: (100 - percent) * n // percent + 1].view(np.int64))
            yield f.drop(columns="tokens").assign(d=size, tokens=first)

    with _small_batches(families, 1000):
        written = settled(apart.mapInPandas(prefixes, "family binary, digest binary, n long, d long, tokens array<long>"))
    each = written.select("family", "digest", "n", "d", F.posexplode("tokens").alias("at", "token"))
    shared = each.groupBy("family", "token").agg(F.count(F.lit(1)).alias("_in")).filter("_in > 1").drop("_in")
    return settled(each.join(shared, ["family", "token"]))


def _far_hub_pairs(members: DataFrame, number: int) -> DataFrame:
    """In each (family, token) with several labels: one hub, paired with the members of other labels."""
    order = F.struct(F.xxhash64("digest", F.lit(number)).alias("h"), "digest", "label", "n")
    hubs = members.groupBy("family", "token").agg(F.min(order).alias("_hub"), F.min("label").alias("_l"), F.max("label").alias("_m")).filter("_l <> _m")
    return _distinct_pairs(members.join(hubs.select("family", "token", "_hub"), ["family", "token"]), "_hub")


def _far_pairs(members: DataFrame, percent: int) -> DataFrame:
    """All pairs of different labels that may be similar by what their prefixes share."""
    y = members.select(*(F.col(c).alias(f"y_{c}") for c in members.columns))
    apart = F.floor((F.col("n") + F.col("y_n")) * (100 - percent) / (100 + percent))
    shared = F.ceil((F.col("d") + F.col("y_d") - apart) / 2)
    joined = members.join(
        y, (F.col("family") == F.col("y_family")) & (F.col("token") == F.col("y_token")) & (F.col("label") != F.col("y_label"))
        & (F.col("digest") < F.col("y_digest")) & (F.least("n", "y_n") * 100 >= F.greatest("n", "y_n") * percent)
        & (F.col("at") <= F.col("d") - shared) & (F.col("y_at") <= F.col("y_d") - shared))
    return joined.select(F.col("digest").alias("a"), F.col("y_digest").alias("b"), "n", F.col("y_n").alias("_on")).distinct()


def _long_enough(pairs: DataFrame, percent: int) -> DataFrame:
    return pairs.filter(F.least("n", "_on") * 100 >= F.greatest("n", "_on") * percent).select("a", "b")


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each document (doc_id, text)."""
    return _grouped(docs, percent).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def survivors(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, mark) of the documents with an id that stay, ``mark`` being a hash of the text: of each
    group the least id with the least hash, as an id may repeat with other texts, and all texts
    without words."""
    rows = _grouped(docs, percent).filter(F.col("doc_id").isNotNull()).select("doc_id", "mark", "root")
    least = rows.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min(F.struct("doc_id", "mark")).alias("m"))
    return least.select("m.*").unionByName(rows.filter(F.col("root").isNull()).select("doc_id", "mark")).distinct()


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, mark, n_shingles, component_id, root (of the group of sets; null without words)."""
    found = settled(features(docs))
    own = found.filter(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    classes = settled(own.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands")))
    exploded = classes.select("digest", "n", F.explode("bands").alias("band"))
    shared = exploded.groupBy("band").agg(F.count(F.lit(1)).alias("_in")).filter("_in > 1")
    met = settled(exploded.join(shared, "band").select("band", "digest", "n", "_in"))
    company = met.groupBy("digest").agg(F.sum("_in").alias("company"))
    buckets = settled(met.join(company, "digest").select("band", "digest", "n", "company", F.col("digest").alias("label")))
    members = classes.join(buckets.select("digest").distinct(), "digest", "left_semi").select("digest", F.col("rep").alias("doc_id"))

    def sets_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            items = [shingles(t) for t in f["text"]]
            # a repeated id may stand for other texts too
            same = [xxhash.xxh3_128_digest(x.tobytes()) == d for x, d in zip(items, f["digest"])]
            yield pd.DataFrame({"digest": f["digest"], "items": [x.tobytes() for x in items]})[same]

    texts = docs.select("doc_id", "text").join(members, "doc_id").withColumn("_h", F.xxhash64("text"))
    texts = texts.dropDuplicates(["doc_id", "_h", "digest"]).select("digest", "text")
    with _small_batches(docs, 2000):
        sets = settled(texts.mapInPandas(sets_of, "digest binary, items binary"))

    buckets = None if buckets.isEmpty() else buckets
    links, tested, roots, families, far = None, None, None, None, None
    for number in range(HUB_ROUNDS + 2 + FAR_ROUNDS):
        if number < HUB_ROUNDS and buckets is not None:
            pairs = _hub_pairs(buckets, number)
        elif buckets is None:
            break
        elif number == HUB_ROUNDS:
            families = _families(components(families), buckets, links)
            pairs = families.filter("digest <> center").select(
                F.least("digest", "center").alias("a"), F.greatest("digest", "center").alias("b"), "n", F.col("center_n").alias("_on"))
        else:
            if far is None:
                far = _far_members(families, sets, percent)
            far = _mixed_only(_relabelled(far, roots), ["family", "token"])
            if far is None:
                break
            last = number == HUB_ROUNDS + 1 + FAR_ROUNDS
            pairs = _far_pairs(far, percent) if last else _far_hub_pairs(far, number)
        if number == 0:
            families = pairs = settled(pairs)  # each bucket's members are joined here, similar or not
        pairs = _long_enough(pairs, percent)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = settled_if_any(pairs)
        if pairs is None:
            continue
        new = _verified(pairs, sets, percent)
        tested = pairs if tested is None else tested.union(pairs)
        if new is not None:
            links = new if links is None else links.union(new)
            roots = components(links)
        if number < HUB_ROUNDS and roots is not None:
            buckets = _mixed_only(_relabelled(buckets, roots), ["band"])
    if roots is None:
        classes = classes.select("digest", F.col("rep").alias("component"), F.col("digest").alias("root"))
    else:
        labelled = classes.select("digest", "rep").join(
            roots.select(F.col("node").alias("digest"), "root"), "digest", "left").withColumn("root", F.coalesce("root", "digest"))
        least = labelled.groupBy("root").agg(F.min("rep").alias("component"))
        classes = settled(labelled.join(least, "root").select("digest", "component", "root"))
    named = found.select("doc_id", "mark", F.col("n").alias("n_shingles"), "digest").join(classes, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return named.select("doc_id", "mark", "n_shingles", component.alias("component_id"), "root")


def oracle(percent: int, words: int = SHINGLE) -> str:
    """The same in the SQL of an embedded database, from all pairs that share a shingle (for small
    tables)."""
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {words - 1}], ' ') AS x FROM (
        SELECT doc_id, w, unnest(range(1, greatest(len(w) - {words - 2}, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM d UNION SELECT u.b, r.root FROM r JOIN u ON u.a = r.doc_id),
m AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM m LEFT JOIN n USING (doc_id)"""
