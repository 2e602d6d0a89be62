import base64
import hashlib
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from listenlab.llm import queries, warc

SCHEMA = "page_id long, url string, html string, row string, payload int"
PAGES = [
    (3, "http://a.example/3", "<p>one</p>"), (1, "http://a.example/ü", "<p>one</p>"), (2, None, None), (5, "", ""), (4, "u\r\nWARC-Type: x", "\r\n\r\nWARC/1.1"),
    (9, "http://b.example", "é\U0001f600 中文" * 50), (8, "http://b.example", "é\U0001f600 中文" * 50), (7, "long", "<b>x</b>" * 400000),
    (None, "no id", "<p>one</p>"), (None, "no id", "only without id"), (None, "no id", "only without id"), (1, "http://a.example/ü", "<p>one</p>"),
    (-6, "negative", "<i>neg</i>"), (6, "negative", "<i>neg</i>"), (10, "nul", "zero\x00byte"),
] + [(100 + i, f"http://c.example/{i}", f"<html><body><p>page number {i} of the site</p></body></html>" * 3) for i in range(60)] + [
    (300 + i, f"http://copy.example/{i}", "<html>a copy</html>") for i in range(40)]


def table(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "own", 1) for r in rows], SCHEMA).repartition(3)


def brute(rows, min_bytes=0):
    firsts, out = {}, []
    for i, (page, _, html) in enumerate(rows):
        body = (html or "").encode()
        place = (page is None, page or 0, i)
        firsts[body] = min(firsts.get(body, place), place)
    for i, (page, _, html) in enumerate(rows):
        body = (html or "").encode()
        first = firsts[body]
        own = len(body) < min_bytes or (first[2] == i)
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page, len(body), digest, "response" if own else "revisit", None if own or first[0] else first[1]))
    return sorted(out, key=str)


def test_round_trip_of_the_query(spark, monkeypatch):
    monkeypatch.setattr(queries, "table", lambda *_: table(spark))
    got = queries.op12_warc(spark, "")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(PAGES)


def test_shorter_payloads_are_all_responses(spark, tmp_path):
    warc.write(table(spark), str(tmp_path / "out"), min_bytes=15)
    got = warc.read_files(spark, str(tmp_path / "out")).where("type <> 'warcinfo'").collect()
    assert not any(r["problem"] for r in got)
    assert sorted(((int(r["record_id"].rpartition(":")[2] or 0) or None, r["payload_bytes"], r["payload_digest"], r["type"],
                    r["refers_to"] and (int(r["refers_to"].rpartition(":")[2] or 0) or None)) for r in got), key=str) == brute(PAGES, 15)
    bodies = {(r["record_id"].rpartition(":")[2], r["payload_digest"]): bytes(r["payload"]) for r in got if r["type"] == "response"}
    held = {(str(p) if p is not None else "", base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()): (h or "").encode() for p, _, h in PAGES}
    assert bodies == {k: held[k] for k in bodies} and len(bodies) > 60
    urls = {r["record_id"].rpartition(":")[2]: r["url"] for r in got}
    assert urls["1"] == "http://a.example/ü" and urls["2"] is None and urls["4"] == "u%0D%0AWARC-Type: x"


def test_files_are_archives_for_other_readers(spark, tmp_path):
    rows = [(i, f"http://c.example/{i}", f"<html><body><p>page number {i}</p></body></html>" * 5) for i in range(400)]
    warc.write(table(spark, rows).coalesce(1), str(tmp_path / "out"))
    file, = (tmp_path / "out").glob("part-*")
    data = file.read_bytes()
    magic, size = struct.unpack_from("<II", data)
    assert magic == 0x184D2A5D
    held = zstandard.ZstdCompressionDict(data[8:8 + size])
    assert held.dict_id()
    whole = zstandard.ZstdDecompressor(dict_data=held).stream_reader(data, read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\nWARC-Type") == 401 and len(data) < len(whole) / 3
    assert [type(f) for _, f in warc.records(data)] == [dict] * 401


def test_empty_table_and_few_rows(spark, tmp_path):
    warc.write(table(spark, []), str(tmp_path / "none"))
    assert warc.read_files(spark, str(tmp_path / "none")).count() == 0
    warc.write(table(spark, PAGES[:1]), str(tmp_path / "one"))
    got = warc.read_files(spark, str(tmp_path / "one")).where("type = 'response'").collect()
    assert [(bytes(r["payload"]), r["problem"]) for r in got] == [(b"<p>one</p>", None)]


def archive(*records, samples=()):
    return b"".join(warc.SEPARATOR if not f else f for f in warc.frames(iter([*samples, *records])))


def page(body=b"<p>body</p>", **changes):
    made = warc.page_record("urn:x", "http://x", body, changes.pop("refers_to", None), warc.DATE)
    for old, new in changes.items():
        made = made.replace(old.replace("_", "-").encode(), new.encode())
    return made


@pytest.mark.parametrize("bad, problem", [
    (b"no record at all", "no WARC record"), (page(WARC_Record_ID="WARC-Other"), "no WARC-Record-ID"), (page(WARC_Date="Date"), "no WARC-Date"),
    (page() + page(), "length of the block"), (page()[:-2], "length of the block"), (page().replace(b"<p>body", b"<p>bodi"), "digest of the block"),
    (page().replace(b"/1.1\r\n", b"/2.0\r\n", 1), "no WARC record"), (page(refers_to="urn:y", WARC_Refers_To="X-To"), "revisit of nothing"),
    (page(Content_Length="Content-Size"), "no Content-Length"), (warc.record("response", "urn:x", b"<p>no http</p>", {"WARC-Date": "d"}), "damaged HTTP headers"),
    (warc.record("response", "urn:x", b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nfour", {"WARC-Date": "d", "WARC-Payload-Digest": "sha1:X"}), "length of the payload"),
    (warc.record("response", "urn:x", b"HTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\nfour", {"WARC-Date": "d", "WARC-Payload-Digest": "sha1:X"}), "digest of the payload"),
    (warc.record("response", "urn:x", b"HTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\nfour", {"WARC-Date": "d"}), "no WARC-Payload-Digest"),
])
def test_damaged_records_are_told_and_passed_over(bad, problem):
    found = [f for _, f in warc.records(archive(page(), bad, page(b"<p>next</p>")))]
    assert found[1] == problem
    assert [f["payload"] for f in (found[0], found[2])] == [b"<p>body</p>", b"<p>next</p>"]


def test_damaged_archives(spark):
    samples = [page(f"<p>sample number {i} of this archive</p>".encode() * 9) for i in range(300)]
    whole = archive(samples=samples)
    frames = list(warc.frames(iter(samples)))
    assert struct.unpack_from("<I", frames[0])[0] == warc.DICTIONARY_MAGIC
    # a flipped byte damages one record; a cut, the last; without the dictionary, none can be decoded
    at = len(frames[0]) + len(frames[1]) + len(frames[2]) - 3
    flipped = whole[:at] + bytes([whole[at] ^ 0xFF]) + whole[at + 1:]
    assert [isinstance(f, str) for _, f in warc.records(flipped)] == [False, True] + [False] * 298
    assert [f if isinstance(f, str) else "" for _, f in warc.records(whole[:-1])] == [""] * 299 + ["truncated frame"]
    assert all(isinstance(f, str) for _, f in warc.records(whole[len(frames[0]):]))
    # a dictionary may itself be compressed
    packed = zstandard.ZstdCompressor().compress(frames[0][8:])
    again = struct.pack("<II", warc.DICTIONARY_MAGIC, len(packed)) + packed + whole[len(frames[0]):]
    assert [f["payload"] for _, f in warc.records(again)] == [f["payload"] for _, f in warc.records(whole)]
    stored = spark.createDataFrame([("a", bytearray(flipped)), ("b", bytearray(b"")), ("c", bytearray(b"junk"))], "path string, content binary")
    got = warc.read(stored, with_payload=False).groupBy("path").agg(F.count("*").alias("n"), F.count("problem").alias("bad")).collect()
    assert sorted(map(tuple, got)) == [("a", 300, 1), ("c", 1, 1)]


def test_records_without_known_size_and_wide_frames():
    press = zstandard.ZstdCompressor(write_content_size=False, write_checksum=False)
    big = page(b"<p>x</p>" * 100000)
    out = press.compressobj()
    frame = out.compress(big) + out.flush()
    assert [f["payload_bytes"] for _, f in warc.records(frame + zstandard.ZstdCompressor().compress(page()))] == [800000, 11]
