from __future__ import annotations

import glob
import hashlib
import random

import pytest
import zstandard

from cartwright.llm import warc

DDL = "page_id bigint, url string, html string, id string, frame int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], DDL)


def round_trip(spark, tmp_path, rows):
    path = str(tmp_path / "warc")
    warc.write_archives(pages(spark, rows), path)
    return path, {r["page_id"]: r for r in warc.read_archives(spark, path, with_payload=True).collect()}


def test_round_trip_with_revisits(spark, small_parts, tmp_path):
    big, small = "é" * 60, "short"
    rows = [(5, "http://a/é", big), (3, "http://b/\r\nX: 1", big), (9, None, big), (1, "u", small), (2, "u", small), (4, "u", None), (6, "u", "")]
    _, got = round_trip(spark, tmp_path, rows)
    assert {i: (r["record_type"], r["refers_to"]) for i, r in got.items()} == {
        3: ("response", None), 5: ("revisit", 3), 9: ("revisit", 3), 1: ("response", None), 2: ("response", None),
        4: ("response", None), 6: ("response", None)}
    for i, url, html in rows:
        body = (html or "").encode()
        assert (got[i]["payload_bytes"], got[i]["payload_digest"]) == (len(body), hashlib.sha256(body).hexdigest())
        if got[i]["record_type"] == "response":
            assert bytes(got[i]["payload"]) == body
    assert got[9]["url"] is None and got[3]["url"] == "http://b/%0D%0AX:%201" and got[5]["url"] == "http://a/é"


def test_null_and_repeated_ids(spark, small_parts, tmp_path):
    big = "z" * 100
    path = str(tmp_path / "warc")
    warc.write_archives(pages(spark, [(None, "u", big), (7, "u", big), (7, "u", big), (8, "u", big), (None, "v", None)]), path)
    got = sorted(((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in warc.read_archives(spark, path).collect()), key=str)
    assert got == [(0, "response", None), (0, "revisit", 7), (7, "response", None), (7, "response", None), (8, "revisit", 7)]


def test_leading_frame_is_a_dictionary_and_pays(spark, small_parts, tmp_path):
    rows = [(i, f"http://h/{i}", f"<html><head><title>Common layout {i * 7919}</title></head><body class='page'>{i}</body></html>") for i in range(4000)]
    path, got = round_trip(spark, tmp_path, rows)
    assert len(got) == 4000
    for file in glob.glob(f"{path}/part-*"):
        data = open(file, "rb").read()
        if not data:
            continue
        assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_MAGIC
        size = int.from_bytes(data[4:8], "little")
        assert zstandard.ZstdCompressionDict(data[8:8 + size]).dict_id() != 0
        raw = list(warc.frames(memoryview(data)))
        alone = sum(len(zstandard.ZstdCompressor(level=warc.LEVEL).compress(r)) for r in raw)
        assert len(data) - size < alone / 2 and all(r.startswith(b"WARC/1.1\r\n") for r in raw)


def test_damage_is_an_error():
    good = warc.record("1", b"u", b"payload", hashlib.sha256(b"payload").hexdigest(), 7, None, False)
    assert warc.parsed(good)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parsed(good.replace(b"payload", b"qayload"))
    with pytest.raises(ValueError):
        list(warc.frames(memoryview(zstandard.ZstdCompressor().compress(good)[:-3])))


def test_empty_table_and_very_long_page(spark, small_parts, tmp_path):
    assert round_trip(spark, tmp_path / "a", [])[1] == {}
    long = "long page " * 600_000
    assert round_trip(spark, tmp_path / "b", [(1, "u", long)])[1][1]["payload_bytes"] == len(long)


def test_archives_of_a_stated_size(spark, small_parts, tmp_path):
    """Many archives from few tasks: each small, each readable alone, with the dictionary in its leading frame."""
    rng, path, limit = random.Random(2), str(tmp_path / "warc"), 60_000
    words = [f"w{rng.getrandbits(40):x}" for _ in range(5000)]
    rows = [(i, f"http://h/{i}", "<html>" + " ".join(rng.choice(words) for _ in range(rng.randrange(20, 400))) + "</html>") for i in range(3000)]
    rows.append((5000, "u", " ".join(f"{rng.getrandbits(64):x}" for _ in range(20_000))))  # larger than an archive
    warc.write_archives(pages(spark, rows).coalesce(2), path, archive_bytes=limit)
    files = [open(f, "rb").read() for f in glob.glob(f"{path}/part-*")]
    files = [f for f in files if f]
    assert len(files) > 20
    seen = []
    for data in files:
        assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_MAGIC or len(data) < 5000
        records = [warc.parsed(r)["id"] for r in warc.frames(memoryview(data))]
        assert len(data) < limit + (64 << 10) + 8 * warc.LINES + limit // 128 + 4000 or 5000 in records
        seen += records
    assert sorted(seen) == sorted(i for i, *_ in rows)
    got = {r["page_id"]: r["payload_digest"] for r in warc.read_archives(spark, path).collect()}
    assert got == {i: hashlib.sha256(h.encode()).hexdigest() for i, _, h in rows}


def test_frames_pass_through_text_unchanged(spark, tmp_path):
    """The writer relies on this: text that is no UTF-8 is written as it is."""
    raw = bytes(range(256)).replace(b"\n", b"") * 3
    frame = spark.createDataFrame([(bytearray(raw),)], "frame binary").coalesce(1)
    frame.selectExpr("CAST(frame AS STRING) AS value").write.option("lineSep", warc.EMPTY_FRAME).text(str(tmp_path / "raw"))
    (file,) = glob.glob(f"{tmp_path}/raw/part-*")
    assert open(file, "rb").read() == raw + warc.EMPTY_FRAME.encode("latin-1")
