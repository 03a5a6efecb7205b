"""WARC archives of zstandard frames: one record per frame, the dictionary in a leading skippable frame.

Archives are written by Spark's text writer, so they land in whatever store the path names: a line is a frame and the
line separator is an empty skippable frame, which every reader of the format passes over. They are read as whole binary
files, whose size the writer bounds.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from hashlib import sha1

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import fresh_path, settle

# Fixed values of the formats: magic numbers of a data frame, a dictionary and an archive's leading dictionary frame; the
# separator (magic number of a skippable frame and length 0, both little-endian); the profile of revisit records.
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
DICT_MAGIC = b"\x37\xa4\x30\xec"
LEAD_MAGIC = b"\x5d\x2a\x4d\x18"
SKIP_MAGICS = {bytes([0x50 + i]) + b"\x2a\x4d\x18" for i in range(16)}
SEPARATOR = "\x50\x2a\x4d\x18\x00\x00\x00\x00"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary, problem string"


class BadRecord(ValueError):
    """A record that breaks the format."""


# ---------------------------------------------------------------- one record


def digest(payload: bytes) -> str:
    return base64.b32encode(sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None, date: str) -> bytes:
    """A response record, or a revisit without payload of the page ``first``."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if first is None else b"")
    name = sha1(f"{page_id}\n{url}\n".encode() + payload).hexdigest() if page_id is None else str(page_id)
    # a header is one line; the target keeps every character, escaped where it would end the line
    target = "".join(c if c.isprintable() and c != "%" else "".join(f"%{x:02X}" for x in c.encode()) for c in url) if url is not None else None
    head = {
        "WARC-Type": "response" if first is None else "revisit", "WARC-Record-ID": f"<urn:page:{name}>", "WARC-Date": date,
        "WARC-Target-URI": target, "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "WARC-Profile": None if first is None else REVISIT_PROFILE, "WARC-Refers-To": None if first is None else f"<urn:page:{first}>",
        "Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.decode("utf-8").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise BadRecord(f"header line without a name: {line[:80]!r}")
        out[name.strip().lower()] = value.strip()
    return out


def _page_of(urn: str) -> int | None:
    name = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name.lstrip("-").isdigit() and len(name) <= 20 else None


def parse(raw: bytes) -> dict:
    """The fields of one record; raises ``BadRecord`` if headers, lengths or the digest don't hold."""
    head, blank, rest = raw.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not blank or version != b"WARC/1.1":
        raise BadRecord("no WARC/1.1 header")
    h = _headers(lines)
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"} - h.keys()
    if missing:
        raise BadRecord(f"no header {sorted(missing)}")
    if not h["content-length"].isdigit() or len(rest) != int(h["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise BadRecord("the block isn't as long as its header says")
    http, blank, payload = rest[:-4].partition(b"\r\n\r\n")
    status, _, lines = http.partition(b"\r\n")
    if not blank or not status.startswith(b"HTTP/"):
        raise BadRecord("no HTTP header in the block")
    inner = _headers(lines)
    if not inner.get("content-length", "").isdigit():
        raise BadRecord("no payload length")
    kind, size, named = h["warc-type"], int(inner["content-length"]), h["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or digest(payload) != named):
        raise BadRecord("the payload doesn't match its length or digest")
    if kind == "revisit" and (payload or "warc-refers-to" not in h):
        raise BadRecord("a revisit with payload or without a target")
    if kind not in ("response", "revisit"):
        raise BadRecord(f"unknown type {kind[:40]}")
    url = h.get("warc-target-uri")
    if url is not None and "%" in url:
        at = url.encode().split(b"%")
        url = (at[0] + b"".join(bytes([int(x[:2], 16)]) + x[2:] for x in at[1:])).decode("utf-8", "replace")
    return {
        "page_id": _page_of(h["warc-record-id"]), "url": url, "record_type": kind, "payload_bytes": size, "payload_digest": named,
        "refers_to": _page_of(h["warc-refers-to"]) if kind == "revisit" else None, "payload": payload if kind == "response" else None, "problem": None,
    }


# ---------------------------------------------------------------- frames


def lead_frame(dictionary: bytes) -> bytes:
    return LEAD_MAGIC + struct.pack("<I", len(dictionary)) + dictionary


def frames(data: memoryview) -> Iterator[memoryview]:
    """The frames of an archive, skippable ones included, found by walking block headers, nothing decoded."""
    at = 0
    while at < len(data):
        magic = bytes(data[at : at + 4])
        if magic in SKIP_MAGICS and at + 8 <= len(data):
            end = at + 8 + struct.unpack_from("<I", data, at + 4)[0]
        elif magic == FRAME_MAGIC:
            end = at + zstandard.frame_header_size(bytes(data[at : at + 18]))
            last = False
            while not last:
                if end + 3 > len(data):
                    raise BadRecord("a frame breaks off")
                word = int.from_bytes(data[end : end + 3], "little")
                last, kind = bool(word & 1), word >> 1 & 3
                end += 3 + (1 if kind == 1 else word >> 3)
            end += 4 * (data[at + 4] >> 2 & 1)
        else:
            raise BadRecord(f"no frame at byte {at}")
        if end > len(data):
            raise BadRecord("a frame breaks off")
        yield data[at:end]
        at = end


def read_archive(data: bytes) -> Iterator[dict]:
    """The records of one archive. What breaks the format comes back with ``problem`` set; a broken frame ends its archive."""
    empty = dict.fromkeys([f.split()[0] for f in RECORD.split(", ")])
    decoder = None
    try:
        for i, f in enumerate(frames(memoryview(data))):
            if bytes(f[:4]) in SKIP_MAGICS:
                if i == 0 and bytes(f[:4]) == LEAD_MAGIC:
                    raw = bytes(f[8:])
                    if raw[:4] == FRAME_MAGIC:
                        raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
                    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw)) if raw else None
                continue
            decoder = decoder or zstandard.ZstdDecompressor()
            try:
                yield parse(decoder.decompressobj().decompress(f))
            except (BadRecord, zstandard.ZstdError, UnicodeDecodeError, ValueError) as e:
                yield empty | {"problem": str(e)}
    except (BadRecord, zstandard.ZstdError) as e:
        yield empty | {"problem": str(e)}


# ---------------------------------------------------------------- tables


def _pack(sent, date: str, level: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        dictionary = sent.value
        zd = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if zd:
            zd.precompute_compress(level=level)
        packer = zstandard.ZstdCompressor(dict_data=zd, level=level)
        part, number, size, count = TaskContext.get().partitionId(), 0, 0, 0
        for b in batches:
            names, out = [], []
            for page, url, html, first in zip(*(b.column(i) for i in range(4))):
                frame = packer.compress(record(page.as_py(), url.as_py(), html.as_buffer().to_pybytes() if html.is_valid else b"", first.as_py(), date))
                if size == 0 or size + len(frame) > most:
                    number, size = number + 1, 8 + len(dictionary)
                    names.append(f"{part:06d}-{number:06d}")
                    out.append(lead_frame(dictionary))
                size += len(frame) + 8
                names.append(f"{part:06d}-{number:06d}")
                out.append(frame)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(range(count, count + len(out)), pa.int64()), pa.array(out, pa.binary())], names=["archive", "place", "frame"])
            count += len(out)

    return run


def train_dictionary(pages: DataFrame, sample: int = 256, longest: int = 1 << 16, size: int = 1 << 15, date: str = "2024-01-01T00:00:00Z", html_col: str = "html") -> bytes:
    """A dictionary trained on at most ``sample`` payloads of at most ``longest`` bytes, the first by hash; empty if they are too few."""
    html = F.col(html_col)
    short = pages.select(html.alias("html")).where(html.isNotNull() & (F.octet_length(html) <= longest)).withColumn("h", F.xxhash64("html"))
    # hashes are chosen first: every task sends its own smallest, and they are small
    picked = [r["h"] for r in short.select("h").distinct().orderBy("h").limit(sample).collect()]
    rows = sorted(short.where(F.col("h").isin(picked)).groupBy("h").agg(F.min("html").alias("html")).collect()) if picked else []
    texts = [record(1, "http://site.example/", r["html"].encode(), None, date) for r in rows]
    try:
        return zstandard.train_dictionary(size, texts).as_bytes()
    except zstandard.ZstdError:
        return b""


def write(pages: DataFrame, path: str, min_bytes: int = 0, level: int = 3, archive_bytes: int = 16 << 20, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write a record per row of ``pages`` into archives below ``path``.

    Of rows with equal payloads of at least ``min_bytes`` bytes, those with the smallest page id are responses, the others revisit it;
    shorter payloads are all responses. The payload is the text in UTF-8; null is empty. A row without an id is a response and is never revisited,
    unless nothing else has its payload. Repeated rows give repeated records. An archive holds up to ``archive_bytes``, one record at least.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    payload = F.coalesce("html", F.lit("")).cast("binary")
    # equal payloads meet by digest and length, without the payload itself
    marked = rows.select("page_id", "url", "html", F.sha1(payload).alias("sha"), F.octet_length(payload).alias("n"))
    seen = marked.where(F.col("n") >= min_bytes).groupBy("sha", "n").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
    seen = settle(seen.where("copies > 1 and first is not null").select("sha", "n", "first"))
    linked = marked.join(seen, ["sha", "n"], "left").select("page_id", "url", "html", F.when(F.col("first") < F.col("page_id"), F.col("first")).alias("first"))
    sent = pages.sparkSession.sparkContext.broadcast(train_dictionary(pages, date=date, html_col=html_col))
    packed = linked.mapInArrow(_pack(sent, date, level, archive_bytes), "archive string, place long, frame binary")
    # a frame's bytes go through the text writer as they are; the order puts the dictionary first in each archive
    packed.sortWithinPartitions("archive", "place").select(F.col("frame").cast("string").alias("value"), "archive").write.option("lineSep", SEPARATOR).partitionBy("archive").text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``; ``problem`` says what is wrong with a record that breaks the format."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("problem", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                held, size = [], 0
                for r in read_archive(content.as_buffer().to_pybytes()):
                    held.append(r)
                    size += len(r["payload"] or b"") + 500
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def archived(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to archives in the shared work folder and read them back."""
    path = fresh_path(pages.sparkSession, "warc")
    write(pages, path, **options)
    return read(pages.sparkSession, path)
