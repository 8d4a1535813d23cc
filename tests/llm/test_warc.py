"""Archives: round trips, the seek table, and the query against a plain grouping."""

import random
import struct
from collections import defaultdict

import pytest
import zstandard

from tidemill.llm import queries, warc

SCHEMA = "page_id long, url string, html string, payload binary, revisit string, refers_to int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, b"x", "y", 3) for r in rows], SCHEMA)


def plain(rows, least=0):
    last = defaultdict(list)
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= least:
            last[html or ""].append(i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        best = max(last.get(html or "", [i or 0])) if len(data) >= least and last.get(html or "") else i
        revisit = i != best
        out.append((i, len(data), warc.digest_of(data), "revisit" if revisit else "response", best if revisit else None))
    return sorted(out, key=repr)


def edges():
    rng = random.Random(1)
    long = "".join(rng.choice("abc <>é\r\n") for _ in range(400_000))
    return [(1, "http://a/", "x"), (2, "http://b/ c\r\nWARC-Type: x", "x"), (3, None, None), (4, "", ""), (5, "http://é", long), (6, "http://l", long),
            (None, "http://n", "x"), (None, "http://n", "alone"), (7, "http://t", "tie"), (7, "http://t", "tie"), (-8, "http://m", "tie"),
            (9, "http://w", "WARC/1.1\r\n\r\nHTTP/1.1\r\n\r\n\r\n\r\n"), *((100 + i, f"http://h/{i}", "hot") for i in range(300))]


def test_query_equals_a_plain_grouping(spark, sf_dir):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op13_warc_bundles(spark, sf_dir).collect()), key=repr) == plain(rows)


@pytest.mark.parametrize("least", [0, 4])
def test_edges(spark, least):
    rows = edges()
    got = [tuple(r) for r in warc.archived(frame(spark, rows).repartition(5), least=least).collect()]
    assert sorted(got, key=repr) == plain(rows, least)


def test_empty_table(spark, tmp_path):
    assert warc.archived(frame(spark, [])).count() == 0
    warc.write(frame(spark, []), str(tmp_path / "none"))
    assert warc.index(spark, str(tmp_path / "none")).count() == 0


def test_payloads_and_places(spark, tmp_path):
    rows = edges()
    path = str(tmp_path / "bundles")
    warc.write(frame(spark, rows).repartition(3), path, frame_bytes=2_000, bundle_bytes=20_000)
    read = warc.read(spark, path).collect()
    want = {(i, (h or "").encode()) for i, _, h in rows}
    assert len(read) == len(rows) and {(r.page_id, bytes(r.payload)) for r in read if r.record_type == "response"} <= want
    assert {bytes(r.payload) for r in read if r.payload is not None} == {p for _, p in want}
    assert {r.uri for r in read if r.page_id == 2} == {"http://b/%20c%0D%0AWARC-Type:%20x"} and [r.uri for r in read if r.page_id == 3] == [None]
    places = warc.index(spark, path).collect()
    files = {p.path for p in places}
    assert len(files) > 3
    for p in random.Random(2).sample(places, 40):  # one frame alone gives the record
        with open(p.path.removeprefix("file:"), "rb") as f:
            f.seek(p.frame_offset)
            packed = f.read(p.frame_bytes)
        (found,) = warc.records_in(zstandard.ZstdDecompressor().decompress(packed)[p.offset:p.offset + p.length])
        assert (found.id, found.type) == (p.record_id, p.record_type)


def test_fetch_reads_what_is_asked_for(spark, tmp_path):
    rows, path = edges(), str(tmp_path / "bundles")
    warc.write(frame(spark, rows).repartition(4), path, frame_bytes=1_000, bundle_bytes=10_000)
    places = warc.index(spark, path)
    by = {i: (h or "").encode() for i, _, h in rows}
    got = {r.page_id: bytes(r.payload) for r in warc.fetch(places, [1, 2, 3, 5, 100, 250, 9, 12345]).collect()}
    assert got == {i: by[i] for i in (1, 2, 3, 5, 100, 250, 9)}
    assert warc.fetch(places, [777]).count() == 0
    asked = warc.fetch(places, [9]).inputFiles()
    assert len(asked) == 1


def test_whole_bundle_is_a_zstandard_stream():
    made = list(warc.bundles((warc.record(i, "u", b"p" * i) for i in range(200)), frame_bytes=500, bundle_bytes=1 << 20))
    assert len(made) == 1
    stream = zstandard.ZstdDecompressor().stream_reader(made[0], read_across_frames=True)
    assert [r.payload for r in warc.records_in(stream.read())] == [b"p" * i for i in range(200)]
    count, _, magic = struct.unpack("<IBI", made[0][-9:])
    frames = warc.frames_of(made[0])
    assert magic == 0x8F92EAB1 and count == len(frames) > 50 and frames[-1][0] + frames[-1][1] == len(made[0]) - 9 - 8 * count - 8
    assert list(warc.bundles([])) == []


def test_damage_is_found():
    good = warc.record(1, "u", b"payload")
    with pytest.raises(ValueError):
        list(warc.records_in(good.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n")))
    with pytest.raises(ValueError):
        warc.frames_of(b"no bundle at all")
