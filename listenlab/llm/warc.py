"""WARC archives compressed by Zstandard with a dictionary of their own.

An archive starts with a skippable frame (magic number 0x184D2A5D) that holds
its dictionary, followed by one frame per record, so that a reader can decode
any record by itself. The dictionary is trained on the first records of the
archive, ``SAMPLE_BYTES`` at most. A task writes its rows as one archive with
Spark's text sink, whose commit protocol then holds for the files on every
store: a row is a frame, and the line separator is an empty skippable frame,
which readers of Zstandard pass over.

``read`` takes whole archives as Spark's binaryFile source gives them. It
loads the dictionary, finds the frames by the lengths in their headers and
blocks, decodes each one and checks it: exactly one record, known version,
mandatory headers, lengths of block and payload, digests of both. What fails
becomes a row with its ``problem``; reading goes on with the next frame
where the frame's end is known.

Pages of equal payloads (SHA-256 and length) are stored once: the one of the
smallest page_id is a response, the others are revisits with headers only.

Defined cases: a null html is an empty payload; a null page_id comes last, is
an empty name in the record's id and null again when read; among rows of one
id the first one as stored is the response; a null url has no target header;
control characters in a url are percent-encoded; an empty table gives no
records; other columns are not stored."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlab.llm import shared
from listenlab.llm.shared import keep, map_arrow

DICTIONARY_MAGIC = 0x184D2A5D
#: The empty frame between records; all its bytes are ASCII.
SEPARATOR = struct.pack("<II", 0x184D2A50, 0)
SAMPLE_BYTES = 1 << 20
DICTIONARY_BYTES = 1 << 15
LEVEL = 3
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
_ID = "urn:listenlab:page:"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_REQUIRED = ("WARC-Record-ID", "WARC-Type", "WARC-Date", "Content-Length")
_CONTROL = {c: f"%{c:02X}" for c in [*range(32), 127]}


def sha1(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# -- writing -----------------------------------------------------------------------------

def record(kind: str, record_id: str, block: bytes, headers: dict[str, str | None]) -> bytes:
    """A record; headers without a value are left out."""
    fields = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", **headers,
              "WARC-Block-Digest": "sha1:" + sha1(block), "Content-Length": str(len(block))}
    head = "".join(f"{k}: {v.translate(_CONTROL)}\r\n" for k, v in fields.items() if v is not None)
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def page_record(record_id: str, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """A page as a response, or as a revisit of the record that it refers to."""
    head = _HTTP % len(payload)
    headers = {"WARC-Date": date, "WARC-Target-URI": url, "WARC-Payload-Digest": "sha1:" + sha1(payload)}
    if refers_to is None:
        return record("response", record_id, head + payload, headers | {"Content-Type": "application/http;msgtype=response"})
    return record("revisit", record_id, head, headers | {
        "Content-Type": "application/http;msgtype=response", "WARC-Profile": PROFILE, "WARC-Refers-To": f"<{refers_to}>"})


def dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary for records like these; None where there are too few to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8, level=LEVEL)
    except zstandard.ZstdError:
        return None


def frames(records: Iterator[bytes]) -> Iterator[bytes]:
    """The frames of an archive of these records."""
    held, size = [], 0
    for one in records:
        held.append(one)
        size += len(one)
        if size >= SAMPLE_BYTES:
            break
    if not held:
        return
    trained = dictionary([one[:SAMPLE_BYTES] for one in held])
    if trained is not None:
        content = trained.as_bytes()
        yield struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content
    press = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True, write_content_size=True)
    for one in held:
        yield press.compress(one)
    del held
    for one in records:
        yield press.compress(one)


def _archive(date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for n, batch in enumerate(batches):
                if n == 0 and batch.num_rows:
                    made = f"software: listenlab\r\nformat: {VERSION}\r\n".encode()
                    yield record("warcinfo", f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, batch.column(0)[0].as_py())}", made,
                                 {"WARC-Date": date, "Content-Type": "application/warc-fields"})
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    yield page_record(*row, date)

        held, size = [], 0
        for frame in frames(records()):
            held.append(frame)
            size += len(frame)
            if size >= 1 << 20:
                yield pa.record_batch([pa.array(held, pa.binary())], names=["frame"])
                held, size = [], 0
        if held:
            yield pa.record_batch([pa.array(held, pa.binary())], names=["frame"])

    return write


def _record_id(page_id: Column, row: Column) -> Column:
    return F.concat(F.lit(_ID), row.cast("string"), F.lit(":"), F.coalesce(page_id.cast("string"), F.lit("")))


def page_id(record_id: Column) -> Column:
    """The page's id in the id of its record."""
    return F.substring_index(record_id, ":", -1).try_cast("long")


def write(pages: DataFrame, folder: str, page: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0,
          date: str = DATE) -> None:
    """Store ``pages`` as archives in ``folder``, one per task. Payloads of
    ``min_bytes`` or more are stored once."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page).cast("long").alias("page"), F.col(url).cast("string").alias("url"), payload.alias("payload"),
                        F.unhex(F.sha2(payload, 256)).alias("sha"), F.monotonically_increasing_id().alias("row"))
    # row numbers that later jobs find again
    stored = keep(rows, "warc-pages")
    light = stored.where(F.octet_length("payload") >= min_bytes).select(
        "sha", F.octet_length("payload").alias("bytes"), F.col("row"), F.struct(F.col("page").isNull().alias("none"), "page", "row").alias("place"))
    firsts = light.groupBy("sha", "bytes").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = (light.join(firsts, ["sha", "bytes"]).where("row <> first.row")
             .select("row", _record_id(F.col("first.page"), F.col("first.row")).alias("refers_to")))
    marked = stored.join(again, "row", "left").select(_record_id(F.col("page"), F.col("row")).alias("id"), "url", "payload", "refers_to")
    (map_arrow(marked, _archive(date), "frame binary").select(F.col("frame").cast("string"))
     .write.option("lineSep", SEPARATOR.decode()).text(folder))


# -- reading -----------------------------------------------------------------------------

def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that starts at ``at`` ends, from its header and the headers of its blocks."""
    if len(data) - at < 8:
        raise ValueError("truncated frame")
    magic, size = struct.unpack_from("<II", data, at)
    if magic >> 4 == 0x184D2A5:
        end = at + 8 + size
    else:
        head = bytes(data[at:at + 18])
        known = zstandard.get_frame_parameters(head)
        end, last = at + zstandard.frame_header_size(head), False
        while not last:
            if end + 3 > len(data):
                raise ValueError("truncated frame")
            block = int.from_bytes(data[end:end + 3], "little")
            last, kind, size = block & 1, block >> 1 & 3, block >> 3
            if kind == 3:
                raise ValueError("damaged block header")
            end += 3 + (1 if kind == 1 else size)
        end += 4 * known.has_checksum
    if end > len(data):
        raise ValueError("truncated frame")
    return end


def _digest_is(value: str | None, data: bytes) -> bool:
    return value is None or value.lower() == "sha1:" + sha1(data).lower()


def parse(data: bytes) -> dict:
    """The checked fields of the one record in ``data``; ValueError says what is wrong."""
    head, ended, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not ended or not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise ValueError("no WARC record")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError("damaged header")
        fields[name.strip().lower()] = value.strip()
    for name in _REQUIRED:
        if not fields.get(name.lower()):
            raise ValueError(f"no {name}")
    if not re.fullmatch("[0-9]+", fields["content-length"]):
        raise ValueError("damaged Content-Length")
    length = int(fields["content-length"])
    block, tail = rest[:length], rest[length:]
    if len(block) != length or tail != b"\r\n\r\n":
        raise ValueError("length of the block")
    if not _digest_is(fields.get("warc-block-digest"), block):
        raise ValueError("digest of the block")
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest")
    found = {"record_id": fields["warc-record-id"].strip("<>"), "type": kind, "date": fields["warc-date"], "url": fields.get("warc-target-uri"),
             "refers_to": None, "payload_digest": digest and digest.partition(":")[2].upper(), "payload_bytes": None, "payload": None}
    if kind in ("response", "revisit"):
        http, ended, payload = block.partition(b"\r\n\r\n")
        size = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)[ \t]*\r?$", http)
        if not ended or not http.startswith(b"HTTP/") or not size:
            raise ValueError("damaged HTTP headers")
        found["payload_bytes"] = int(size[1])
        if digest is None:
            raise ValueError("no WARC-Payload-Digest")
        if kind == "revisit":
            if not fields.get("warc-refers-to") or not fields.get("warc-profile"):
                raise ValueError("revisit of nothing")
            found["refers_to"] = fields["warc-refers-to"].strip("<>")
        elif len(payload) != found["payload_bytes"]:
            raise ValueError("length of the payload")
        elif not _digest_is(digest, payload):
            raise ValueError("digest of the payload")
        else:
            found["payload"] = payload
    return found


def records(content: bytes) -> Iterator[tuple[int, dict | str]]:
    """(offset, fields or problem) of every record frame of an archive."""
    data, at, first = memoryview(content), 0, True
    press = zstandard.ZstdDecompressor()
    while at < len(data):
        try:
            end = frame_end(data, at)
        except (ValueError, zstandard.ZstdError) as wrong:
            yield at, f"{wrong}"
            return
        magic = int.from_bytes(data[at:at + 4], "little")
        if first and magic == DICTIONARY_MAGIC:
            held = bytes(data[at + 8:end])
            try:
                if held[:4] == zstandard.FRAME_HEADER:
                    held = zstandard.ZstdDecompressor().decompressobj().decompress(held)
                press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held))
            except zstandard.ZstdError as wrong:
                yield at, f"dictionary: {wrong}"
                return
        elif magic >> 4 != 0x184D2A5:
            try:
                yield at, parse(press.decompressobj().decompress(data[at:end]))
            except (ValueError, zstandard.ZstdError) as wrong:
                yield at, f"{wrong}"
        at, first = end, False


_SCHEMA = ("path string, at long, record_id string, type string, date string, url string, refers_to string, payload_digest string, "
           "payload_bytes long, problem string")


def _reader(with_payload: bool):
    names = [f.split()[0] for f in (_SCHEMA + (", payload binary" if with_payload else "")).split(", ")]
    types = [pa.int64() if n in ("at", "payload_bytes") else pa.binary() if n == "payload" else pa.string() for n in names]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                path = batch.column(0)[k].as_py()
                for at, found in records(batch.column(1)[k].as_buffer()):
                    row = {"problem": found} if isinstance(found, str) else found
                    held.append({"path": path, "at": at} | row)
                    size += 256 + (len(row.get("payload") or b"") if with_payload else 0)
                    if size >= 4 << 20:
                        yield pa.record_batch([pa.array([r.get(n) for r in held], t) for n, t in zip(names, types)], names=names)
                        held, size = [], 0
        if held:
            yield pa.record_batch([pa.array([r.get(n) for r in held], t) for n, t in zip(names, types)], names=names)

    return read


def read(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of ``archives`` (path, content): a row per record frame, and per problem."""
    return map_arrow(archives.select("path", "content"), _reader(with_payload), _SCHEMA + (", payload binary" if with_payload else ""))


def read_files(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives in ``folder``."""
    return read(spark.read.format("binaryFile").load(folder), with_payload)


def new_folder(spark: SparkSession) -> str:
    return f"{shared._root(spark)}/warc-{uuid.uuid4().hex}"
