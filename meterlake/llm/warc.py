"""Zstandard-compressed WARC archives: a writer in Spark's own text files, and a reader that trusts nothing.

An archive starts with a skippable frame that holds a dictionary, as the WARC convention for Zstandard has it, and then
has one frame per record. The writer is Spark's text writer: a row is a frame, and the line separator is an empty
skippable frame, which happens to be plain ASCII. So each partition becomes one archive that any Zstandard tool accepts,
written through Spark's commit protocol and safe against lost executors and repeated tasks.

The reader takes whole files, loads the dictionary from the leading frame, decodes frame after frame, and checks each
record: version line, required headers, ``Content-Length``, the blank lines that end it, and the payload digest.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import scratch_dir, uniform

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
GAP = struct.pack("<II", 0x184D2A50, 0)
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest")
DATE = "2024-01-01T00:00:00Z"

READ = (
    "page_id long, url string, record_type string, refers_to long, content_length long, payload_bytes long, "
    "payload_digest string, payload binary, archive string, position int, problem string"
)


@dataclass(frozen=True)
class Settings:
    level: int = 6
    dictionary_bytes: int = 16_384
    dictionary_rows: int = 200
    """Payloads that the dictionary is taken from: a bounded sample."""


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header_safe(value: str) -> str:
    return re.sub(r"[\r\n]+", " ", value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit carries no payload, only the size and digest of it."""
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else header_safe(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(len(payload))),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", f"<urn:page:{'' if refers_to is None else refers_to}>" if revisit else None),
        ("Content-Length", "0" if revisit else str(len(payload))),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + (b"" if revisit else payload) + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes, str | None]:
    """Headers, block and what is wrong with a record, if anything is."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or not lines[0].startswith(b"WARC/1."):
        return {}, b"", "no WARC header"
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon:
            return headers, b"", "header line without a colon"
        headers[name.strip().lower()] = value.strip()
    missing = [n for n in REQUIRED if n not in headers]
    if missing:
        return headers, b"", "missing " + ", ".join(missing)
    if not headers["content-length"].isdigit():
        return headers, b"", "Content-Length is not a number"
    length = int(headers["content-length"])
    if rest[length:] != b"\r\n\r\n":
        return headers, rest[:length], f"block has {max(0, len(rest) - 4)} bytes, Content-Length says {length}"
    block = rest[:length]
    if headers["warc-type"] == "response" and headers["warc-payload-digest"] != f"sha1:{digest32(block)}":
        return headers, block, "payload digest differs"
    return headers, block, None


def frames(content: bytes) -> Iterator[tuple[bytes | None, str | None]]:
    """The decoded frames of an archive, in order, with what is wrong; reading ends at the first damaged frame."""
    dictionary, at = None, 0
    if len(content) >= 8 and struct.unpack_from("<I", content)[0] == DICTIONARY_FRAME:
        size = struct.unpack_from("<I", content, 4)[0]
        body = content[8 : 8 + size]
        if len(body) < size:
            yield None, "dictionary frame is cut off"
            return
        try:
            if body[:4] == zstd.FRAME_HEADER:
                body = zstd.ZstdDecompressor().decompress(body)
            dictionary = zstd.ZstdCompressionDict(body) if body else None
        except zstd.ZstdError as error:
            yield None, f"dictionary: {error}"
            return
        at = 8 + size
    decoder = zstd.ZstdDecompressor(dict_data=dictionary) if dictionary else zstd.ZstdDecompressor()
    view = memoryview(content)
    while at < len(content):
        if len(content) - at >= 8 and struct.unpack_from("<I", content, at)[0] in SKIPPABLE:
            at += 8 + struct.unpack_from("<I", content, at + 4)[0]
            if at > len(content):
                yield None, "skippable frame is cut off"
            continue
        frame = decoder.decompressobj()
        try:
            # a record's frame is seldom longer than this; a longer one is fed on
            parts, step = [], 1 << 16
            while not frame.eof and at < len(content):
                parts.append(frame.decompress(view[at : at + step]))
                at += min(step, len(content) - at)
            at -= len(frame.unused_data)
        except zstd.ZstdError as error:
            yield None, f"frame: {error}"
            return
        if not frame.eof:
            yield None, "frame is cut off"
            return
        yield b"".join(parts), None


def dictionary_of(pages: DataFrame, settings: Settings) -> bytes:
    """A raw-content dictionary: the heads of a bounded sample of payloads, chosen by hash.

    Rows are passed over by the hash before any head is sorted or sent, so that the tasks together send about twice what
    is taken, however many they are; equal heads are one before they meet.
    """
    head = settings.dictionary_bytes // 8
    share = min(1.0, 2 * settings.dictionary_rows / max(1, pages.count()))
    some = pages.filter("html is not null").filter(uniform(5, F.col("page_id"), F.col("html")) < share)
    rows = some.select(F.substring("html", 1, head).alias("head")).distinct().orderBy(uniform(6, F.col("head")), "head").limit(settings.dictionary_rows).collect()
    return b"".join(r["head"].encode() for r in rows)[: settings.dictionary_bytes]


def plan(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, record_type, refers_to`` per page.

    Of the rows with equal payloads the one with the largest page_id is the response, the others revisit it; rows that
    repeat that page_id with that payload are responses too. A null id counts as the smallest. The copies of a payload
    are counted by its digest and length before they meet anything, and only ids travel with the digests.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    ids = pages.select("page_id", F.sha1(payload).alias("sha1"), F.length(payload).alias("size")).distinct()
    last = ids.groupBy("sha1", "size").agg(F.max("page_id").alias("last"))
    marks = ids.join(last, ["sha1", "size"]).select(
        F.col("page_id").alias("id"), "sha1", F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"), (~F.col("page_id").eqNullSafe(F.col("last"))).alias("revisit")
    )
    whole = pages.withColumn("own", F.sha1(payload))
    return whole.join(marks, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("own") == F.col("sha1"))).select("page_id", "url", "html", "refers_to", "revisit")


def write(pages: DataFrame, path: str, settings: Settings = Settings()) -> None:
    """Write the pages as archives below ``path``: one per partition, named by Spark."""
    spark = pages.sparkSession
    shared = spark.sparkContext.broadcast(dictionary_of(pages, settings))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = shared.value
        dictionary = zstd.ZstdCompressionDict(raw, dict_type=zstd.DICT_TYPE_RAWCONTENT) if raw else None
        coder = zstd.ZstdCompressor(level=settings.level, dict_data=dictionary, write_content_size=True, write_dict_id=False)
        first = True
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = []
                if first:
                    out.append(struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw)
                    first = False
                for row in batch.slice(at, 256).to_pylist():
                    payload = (row["html"] or "").encode()
                    out.append(coder.compress(record(row["page_id"], row["url"], payload, digest32(payload), row["refers_to"], row["revisit"])))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    frames_of = plan(pages).mapInArrow(run, "frame binary")
    frames_of.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", GAP.decode()).option("compression", "none").text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``, good or not; ``problem`` says what is wrong with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows, held = [], 0
                for position, (data, problem) in enumerate(frames(content.as_buffer().to_pybytes())):
                    rows.append(_row(name, position, data, problem))
                    held += len(data or b"")
                    if held > 1 << 24:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, READ)


ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
FIELDS = [f.split(" ") for f in READ.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, ARROW[k]) for c, (_, k) in zip(zip(*rows, strict=True), FIELDS, strict=True)], names=[n for n, _ in FIELDS])


def _id(value: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
    return int(found[1]) if found else None


def _row(name: str, position: int, data: bytes | None, problem: str | None) -> tuple:
    if data is None:
        return (None, None, None, None, None, None, None, None, name, position, problem)
    headers, block, problem = parse(data)
    size = headers.get("x-payload-length") or headers.get("content-length")
    length = headers.get("content-length", "")
    return (
        _id(headers.get("warc-record-id")), headers.get("warc-target-uri"), headers.get("warc-type"), _id(headers.get("warc-refers-to")),
        int(length) if length.isdigit() else None, int(size) if size and size.isdigit() else None,
        headers.get("warc-payload-digest", "").removeprefix("sha1:") or None, block, name, position, problem,
    )


def round_trip(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Write the pages to a new folder of the cluster's shared scratch space and read the records back."""
    path = scratch_dir(pages.sparkSession, "warc")
    write(pages, path, settings)
    return read(pages.sparkSession, path)
