"""Personal data, dialogues, neighbours and the pipeline."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_documents import edges, frame
from tidemill.llm import chat, neighbours, pii, queries, toxicity

KEY = "test key"


def replaced(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in pii.replace_entities(docs, KEY).orderBy("doc_id").collect()]


def test_surrogates_keep_format_and_coreference(spark):
    got = replaced(spark, [
        "write to Ann.B-7@mail3.example.com or +1 (375) 555-4393, card 4207-0512-7910-8084.",
        "ANN.B-7@MAIL3.EXAMPLE.COM called from 28.125.121.88; ssn 123-45-6789",
        "Mrs. Anna Smith met Mr. John Smith and Frau Müller; Mr. Smith left. Господин Иван Петров",
        None, "", "version 4.0. and 2.0. of 1984", "card 4207051279108084, IBAN DE44500105175407324931",
    ])
    a, b, c = got[:3]
    mail = re.search(r"\S+@\S+", a).group()
    assert re.fullmatch(r"[A-Z][a-z]{2}\.[A-Z]-\d@[a-z0-9]+\.example", re.search(r"\S+@\S+", a).group()) or mail.islower()
    assert re.search(r"\S+@\S+", b).group().lower() == mail.lower()
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}, card 4\d{3}-\d{4}-\d{4}-\d{4}\.", a)
    assert "555-4393" not in a and "28.125.121.88" not in b and "123-45-6789" not in b
    assert re.search(r"card (\d{16}),", got[6]).group(1) == re.sub(r"\D", "", re.search(r"4[\d-]+(?=\.)", a).group())
    names = re.fullmatch(r"Mrs\. (\w+) (\w+) met Mr\. (\w+) (\w+) and Frau (\w+); Mr\. (\w+) left\. Господин (\w+) (\w+)", c).groups()
    assert names[1] == names[3] == names[5] != "Smith" and names[4] != "Müller"
    assert re.fullmatch("[А-Я][а-я]+", names[6]) and re.fullmatch("[А-Я][а-я]+", names[7])
    assert names[0][-1] in "ae" and names[2][-1] not in "ae"
    assert got[3] is None and got[4] == "" and got[5] == "version 4.0. and 2.0. of 1984"


def test_valid_card_numbers_stay_valid(spark):
    def luhn(d):
        return sum(x if i % 2 == 0 else (2 * x - 9 * (x > 4)) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0

    good, bad = "4539578763621486", "4539578763621487"
    assert luhn(good) and not luhn(bad)
    assert luhn(re.search(r"\d{16}", replaced(spark, [f"card {good}"])[0]).group())


def test_collisions_are_resolved(spark):
    """More one-letter addresses of a host than letters: surrogates stay distinct and new."""
    users = [f"{c}{d}@h.example.org" for c in "abcdefghij" for d in "0123456789"]
    entities = spark.createDataFrame([("email", u) for u in users] + [("email", "zz@h.example.org")], "kind string, value string")
    rows = pii.assign_surrogates(entities, KEY).collect()
    assert len({r.surrogate for r in rows}) == 101 and not {r.surrogate for r in rows} & set(users)


def test_real_entities_are_never_surrogates(spark):
    start = spark.createDataFrame([("ip", "1.2.3.4")], "kind string, value string")
    taken = pii.assign_surrogates(start, KEY).first().surrogate
    both = spark.createDataFrame([("ip", "1.2.3.4"), ("ip", taken)], "kind string, value string")
    made = {r.value: r.surrogate for r in pii.assign_surrogates(both, KEY).collect()}
    assert not set(made.values()) & set(made) and len(set(made.values())) == 2


def test_pii_edges(spark):
    docs = frame(spark, edges())
    got = pii.replace_entities(docs, KEY)
    assert got.columns == docs.columns and sorted(map(str, got.collect())) == sorted(map(str, docs.collect()))
    assert pii.replace_entities(frame(spark, []), KEY).count() == 0


def test_query_replaces_all_and_keeps_distinctness(spark, sf_dir):
    pattern = re.compile(r"[A-Za-z0-9.]+@[a-z0-9.]+\.[a-z]+|\(\d{3}\) \d{3}-\d{4}|\b\d{16}\b|\b\d+\.\d+\.\d+\.\d+\b")
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    map_ = {}
    for r in queries.op8_pii_surrogates(spark, sf_dir).collect():
        a, b = pattern.findall(before[r.doc_id]), pattern.findall(r.text)
        assert len(a) == len(b) and (a or r.text == before[r.doc_id])
        for x, y in zip(a, b):
            assert map_.setdefault(x, y) == y
    assert map_ and len(set(map_.values())) == len(map_) and not set(map_) & set(map_.values())


def test_dialogue_rotation(spark):
    rows = [(1, 0, "system", "rules"), (1, 1, "ann", "hi <|end|>"), (1, 2, "bob b", "yo"), (1, 2, "bob b", "yo"), (1, None, None, None),
            (2, 0, "system", "alone"), (None, 0, "ann", "lost"), (3, 300, "ann", "late"), (3, 1, "ann", "early")]
    messages = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, part int, perspective string")
    got = {(r.conv_id, r.perspective, r.part): r for r in chat.rotate(messages).collect()}
    assert set(got) == {(1, "ann", 0), (1, "ann", -1), (1, "bob b", 0), (1, "bob b", -1), (None, "ann", 0), (3, "ann", 0), (3, "ann", 1)}
    r = got[1, "ann", 0]
    assert r.dialogue == "<|system|>\nrules<|end|>\n<|assistant|>\nhi < |end|><|end|>\n<|user name=bob+b|>\nyo<|end|>\n"
    assert [r.dialogue[m.start:m.end] for m in r["mask"]] == ["hi < |end|><|end|>"]
    assert [got[1, "bob b", 0].dialogue[m.start:m.end] for m in got[1, "bob b", 0]["mask"]] == ["yo<|end|>"]
    assert got[1, "ann", -1].dialogue == "<|user|>\n<|end|>\n"
    assert chat.rotate(messages.filter("false")).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, id int, cell string")


def test_neighbours_of_the_small_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(queries.op4_nearest_neighbours(spark, sf_dir), rows)


def check(got, rows, k=20, least=1.0):
    want = brute.nearest(rows, [i for i, _ in rows if i % 20 == 0], k)
    found = {}
    for r in sorted(got.collect(), key=lambda r: r["rank"]):
        assert r["rank"] == len(found.setdefault(r.query_id, [])) + 1
        found[r.query_id].append((r.vec_id, r.score))
    assert set(found) == {q for q in want if want[q]}
    recall = np.mean([len({i for i, _ in found[q]} & {i for i, _ in want[q]}) / max(1, len(want[q])) for q in found])
    assert recall >= least
    return found, want


def test_forest_reaches_recall_without_seeing_all(spark, sf_dir):
    sf = sf_dir.replace("sf0.001", "sf0.1")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, min_candidates=2 * len(rows))
    check(got, rows, least=0.9)


def test_copies_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(60)]
    rows += [(100 + i, [1.0] * 8) for i in range(80)]  # one vector, many times
    bad = [(200, None), (201, [0.0] * 8), (202, [float("nan")] * 8), (203, [1.0] * 7), (204, [None] * 8), (None, [1.0] * 8), (220, [float("inf")] * 8)]
    found, want = check(neighbours.nearest(vectors(spark, rows + bad + rows[:3]), F.col("vec_id") % 20 == 0), rows)
    for q in want:
        assert [i for i, _ in found[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in found[q]], [s for _, s in want[q]], atol=1e-12)
    few = neighbours.nearest(vectors(spark, rows[:5]), F.col("vec_id") % 20 == 0).collect()
    assert [r["rank"] for r in few] == [1, 2, 3, 4]
    assert neighbours.nearest(vectors(spark, bad), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.nearest(vectors(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_inner_products_of_unequal_lengths(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(size=16) * rng.uniform(0.2, 3)).astype(np.float32).tolist()) for i in range(1500)]
    got = neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, min_candidates=6000, min_share=0.0)
    check(got, rows, least=0.9)


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels.filter(~toxicity.held_out(F.col("doc_id"))))
    texts = {r.doc_id: r.text for r in docs.collect()}
    clean = stages["toxicity"](spark, docs, sf_dir)
    assert {r.doc_id for r in clean.collect()} == {i for i, t in texts.items() if model.score(t) < toxicity.THRESHOLD}
    one = stages["near_duplicates"](spark, docs, sf_dir)
    assert sorted(r.doc_id for r in one.collect()) == sorted(
        i for i, (_, c) in brute.near_duplicates(texts.items(), 80).items() if c == i)
    private = stages["personal_data"](spark, docs, sf_dir)
    assert private.count() == docs.count() and private.filter("n_chars <> length(text)").count() == 0
    mixed = stages["mixing"](spark, docs, sf_dir)
    assert {r.text for r in mixed.collect()} <= set(texts.values())
    assert all(d.columns == columns for d in (clean, one, private, mixed))
    total = corpus_pipeline.run(spark, sf_dir)
    assert total.agg(F.max("length")).first()[0] <= 2048 and total.count() > 0


def test_pipeline_stages_take_edges(spark, sf_dir):
    for rows in (edges(), []):
        for _, stage in corpus_pipeline.STAGES:
            docs = frame(spark, rows)
            out = stage(spark, docs, sf_dir)
            assert out.count() <= 40 or out.columns != docs.columns


def test_random_words_stay_whole(spark):
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("abcdehinorst") for _ in range(rng.randrange(1, 9))) for _ in range(200)) for _ in range(30)]
    assert replaced(spark, texts) == texts


def test_every_entity_satisfies_the_hint(spark):
    """The forms with the fewest adjacent digits that each pattern takes."""
    spare = {
        "email": "a@b.cd", "ip": "1.2.3.4", "iban": "GB82 WEST 1234", "card": " ".join("4111111111111111"),
        "ssn": "123-45-6789", "phone": "(12)345-678", "person": "Mr Bo"}
    also = [("card", "-".join("4111111111111111")), ("card", "4 1-1 1-1 1-1 1-1 1-1 1-1"), ("phone", "+12345678"), ("person", "Frau. Li")]
    rows = spark.createDataFrame([*spare.items(), *also], "kind string, found string")
    assert set(spare) == set(pii.PATTERNS)
    for r in rows.select("kind", "found", F.col("found").rlike(pii.HINT).alias("hint"), pii._kind_of(F.col("found")).alias("of")).collect():
        assert r.hint and r.of == r.kind, r
    texts = [f"pay {found} now" for _, found in also[:2]]
    new = replaced(spark, texts)
    for a, b in zip(texts, new):
        assert a != b and re.sub(r"\d", "0", a) == re.sub(r"\d", "0", b)


def test_texts_that_share_an_id_are_told_apart(spark, sf_dir):
    """A near copy under a kept id goes, and the other texts of that id stay."""
    rng = random.Random(6)

    def made():
        return " ".join(f"w{rng.randrange(10_000)}" for _ in range(200))

    a, b, c = made(), made(), made()
    rows = [(1, b), (5, a), (5, b + " tail"), (5, c), (5, c + " tail"), (5, c), (5, ""), (5, a), (6, a), (None, b)]
    for order in (rows, rows[::-1]):
        got = corpus_pipeline.without_near_duplicates(spark, frame(spark, order), sf_dir).collect()
        kept = [(r.doc_id, r.text) for r in got]
        assert len(kept) == 5 and {(1, b), (5, a), (5, ""), (None, b)} < set(kept)
        assert len({(5, c), (5, c + " tail")} & set(kept)) == 1
