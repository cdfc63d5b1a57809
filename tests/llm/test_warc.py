import io
import random

import pytest
import zstandard

from tidemark.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, sha1 string, revisit boolean"
ROWS = [(1, "http://a/", "<p>same</p>"), (2, "http://b/\r\nX: y", "<p>same</p>"), (3, None, None), (4, "http://c/", ""),
        (5, "http://d/é", "né\r\n\r\nWARC/1.1\r\n" * 3), (6, "http://e/", "x" * 300_000), (7, "http://f/", "\x00\x01"),
        (None, "http://g/", "only null ids"), (None, "http://h/", "<p>same</p>"), (9, "u", "twice"), (9, "u", "twice"),
        (8, "http://i/", "twice")]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "x", "y", False) for r in rows], SCHEMA)


def brute(rows):
    latest = {}
    for i, _, h in rows:
        if i is not None:
            latest[h or ""] = max(latest.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        top = latest.get(h or "")
        revisit = top is not None and i != top
        out.append((i, len(raw), warc.base32_sha1(raw), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=repr)


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_round_trip(spark):
    path = warc.write(pages(spark))
    out = warc.read(spark, path).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in out), key=repr) == brute(ROWS)
    by = {(r["page_id"], r["url"]): r for r in out}
    assert bytes(by[6, "http://e/"]["payload"]) == b"x" * 300_000 and by[1, "http://a/"]["payload"] is None
    assert (2, "http://b/%0D%0AX: y") in by and (3, None) in by


def test_random_pages_over_many_files(spark):
    rng = random.Random(4)
    rows = [(i, f"http://h/{i}", rng.choice(["", None, "dup one", "<b>dup two</b>"]) if rng.random() < 0.4 else
             "<html>" + "word " * rng.randrange(200) + str(rng.random())) for i in range(600)]
    path = warc.write(pages(spark, rows).repartition(7))
    got = sorted((tuple(r[c] for c in COLUMNS) for r in warc.read(spark, path).collect()), key=repr)
    assert got == brute(rows)


def test_short_payloads_are_never_revisits(spark):
    path = warc.write(pages(spark), min_revisit=6)
    kinds = {r["page_id"]: r["record_type"] for r in warc.read(spark, path).where("payload_bytes < 6").collect()}
    assert set(kinds.values()) == {"response"}


def test_layout_each_record_alone(spark):
    path = warc.write(pages(spark))
    files = spark.read.format("binaryFile").load(path).collect()
    seen = 0
    for f in files:
        raw = bytes(f["content"])
        if not raw:
            continue
        assert raw[:4] == warc.DICT_FRAME
        dictionary, at = warc.read_dictionary(raw)
        while at < len(raw):
            if raw[at + 1:at + 4] == warc.SKIPPABLE:
                at += 8 + int.from_bytes(raw[at + 4:at + 8], "little")
                continue
            one = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
            text = one.decompress(raw[at:])
            at = len(raw) - len(one.unused_data)
            assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
            seen += 1
    assert seen == len(ROWS)


def test_archives_of_bounded_size(spark):
    rng = random.Random(6)
    rows = [(i, f"http://h/{i}", "".join(rng.choices("abcdefghij <>", k=rng.randrange(4000)))) for i in range(400)]
    rows.append((400, "http://long/", "".join(rng.choices("abcdefghij <>", k=200_000))))
    bound = 40_000
    path = warc.write(pages(spark, rows).coalesce(1), archive_bytes=bound)
    archives = [bytes(f["content"]) for f in spark.read.format("binaryFile").load(path).collect()]
    archives = [a for a in archives if a]
    assert len(archives) > 8
    held = 0
    for raw in archives:
        dictionary, _ = warc.read_dictionary(raw)
        sizes = [len(block) for _, block in warc.records(raw)]
        held += len(sizes)
        # only an archive that ends in the long record is much larger than the bound
        assert raw[:4] == warc.DICT_FRAME and dictionary is not None and sizes
        assert len(raw) < bound + 8_000 or sizes[-1] > 200_000
    assert held == len(rows)
    got = sorted((tuple(r[c] for c in COLUMNS) for r in warc.read(spark, path).collect()), key=repr)
    assert got == brute(rows)


def test_dictionary_helps_and_small_samples_work():
    texts = [f"<html><head><title>page {i}</title></head><body>boilerplate of this site {i * 7}</body></html>".encode()
             for i in range(2000)]
    d = zstandard.ZstdCompressionDict(warc.train(texts, 4096))
    with_, without = (sum(len(zstandard.ZstdCompressor(**k).compress(t)) for t in texts[:100]) for k in ({"dict_data": d}, {}))
    assert with_ < 0.7 * without
    for few in ([], [b""], [b"one"]):
        frame = warc.dictionary_frame(warc.train(few))
        dictionary, end = warc.read_dictionary(frame)
        body = zstandard.ZstdCompressor(dict_data=dictionary).compress(b"text")
        reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(io.BytesIO(body))
        assert end == len(frame) and reader.read() == b"text"


def test_empty_table(spark):
    assert warc.read(spark, warc.write(pages(spark, []))).count() == 0


@pytest.mark.parametrize("text", ["", "abc", "é" * 50])
def test_digest(text):
    import base64
    import hashlib
    assert warc.base32_sha1(text.encode()) == base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()
