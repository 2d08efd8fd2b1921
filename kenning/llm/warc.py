"""WARC archives in seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames, each of a group of whole WARC records, followed by the seek table of
the public seekable format in a skippable frame. The index maps a record's id to bundle, frame and offset in the frame,
so a record is read by fetching the footer and one frame.

Equal payloads are written once: the record with the largest page_id is the response, the others are revisits of it
whose HTTP header keeps the full length. What decides this is a table of repeated payload digests; it is broadcast only
if a count shows it to be small, and otherwise joined by digest. Only rows that repeat the responding page_id itself are
gathered by id.

Bundles get fresh names and count only if their task's index rows were committed, so retried tasks do no harm. Files
go through pyarrow's file systems (file, hdfs, s3, gs).

Defined results: null html is an empty payload; a null page_id is never chosen as response over another; rows that
repeat page_id and payload give one response and revisits of the same id; line breaks in a URL are percent-encoded, null
is empty; page ids that aren't whole numbers are kept as strings, percent-encoded in records; a payload of any length
is one record, and a frame of its own if it is long; an empty table gives no bundle and an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kenning.llm.common import checked_broadcast, columns, dealt, materialise, new_path

#: Fixed values of the Zstandard seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
FRAME_BYTES, BUNDLE_BYTES, LEVEL = 1 << 18, 1 << 27, 3
INDEX = "page_id {id}, copy int, bundle string, frame int, frame_offset int, record_bytes int"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def name(page_id: int | str | None) -> str:
    """A page id as part of a URN; empty for null."""
    return "" if page_id is None else quote(str(page_id), safe="-") or "%"


def name_back(text: str, whole: bool) -> int | str | None:
    return None if not text else int(text) if whole else "" if text == "%" else unquote(text)


def record(page_id: int | str | None, copy: int, url: str, payload: bytes, refers_to: int | str | None, date: str) -> bytes:
    """A response record, or a revisit record if refers_to is given."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{name(page_id)}:{copy}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {url.replace('\r', '%0D').replace('\n', '%0A')}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{name(refers_to)}:0>"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at `at`."""
    split = data.index(b"\r\n\r\n", at)
    lines = data[at:split].decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    head = dict(x.split(": ", 1) for x in lines[1:])
    begin = split + 4
    end = begin + int(head["Content-Length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("record is cut off")
    return head, data[begin:end], end + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", *x) for x in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(f, size: int) -> list[tuple[int, int, int]]:
    """(offset, compressed size, size) of each frame of an open file of `size` bytes."""
    f.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE_MAGIC or flags:
        raise ValueError("no seek table")
    f.seek(size - 9 - 8 * n)
    raw, at, out = f.read(8 * n), 0, []
    for k in range(n):
        packed, plain = struct.unpack_from("<II", raw, 8 * k)
        out.append((at, packed, plain))
        at += packed
    return out


class Writer:
    """Writes records to bundles below a folder and keeps their index rows."""

    def __init__(self, folder: str):
        self.store, self.base = fs.FileSystem.from_uri(folder)
        self.store.create_dir(self.base, recursive=True)
        self.out = None
        self.index: list[tuple] = []

    def add(self, page_id: int | None, copy: int, data: bytes) -> None:
        if self.out is None:
            self.name = f"bundle-{uuid.uuid4().hex}.warc.zst"
            self.out = self.store.open_output_stream(f"{self.base}/{self.name}", compression=None)
            self.frame, self.held, self.sizes, self.written = [], 0, [], 0
        self.index.append((page_id, copy, self.name, len(self.sizes), self.held, len(data)))
        self.frame.append(data)
        self.held += len(data)
        if self.held >= FRAME_BYTES:
            self.flush()
            if self.written >= BUNDLE_BYTES:
                self.close()

    def flush(self) -> None:
        plain = b"".join(self.frame)
        packed = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress(plain)
        self.out.write(packed)
        self.sizes.append((len(packed), len(plain)))
        self.written += len(packed)
        self.frame, self.held = [], 0

    def close(self) -> None:
        if self.out is not None:
            if self.frame:
                self.flush()
            self.out.write(seek_table(self.sizes))
            self.out.close()
            self.out = None


def plan(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, copy, url, payload, refers_to (null for responses)."""
    pages = columns(pages, page_id="page_id", url="url", html="html")
    base = pages.select(F.col("page_id").cast("long" if isinstance(pages.schema["page_id"].dataType, T.IntegralType) else "string").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    keyed = base.withColumn("sha", F.unhex(F.sha1("payload")))
    top = F.struct("page_id", F.lit(1).alias("one"))
    repeated = (
        keyed.filter(F.octet_length("payload") >= least_bytes)
        .groupBy("sha", "page_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("sha")
        .agg(F.sum("n").alias("rows"), F.max("page_id").alias("response_id"), F.max_by("n", top).alias("same"))
        .filter("rows > 1 and response_id is not null")
        .select(F.col("sha").alias("__sha"), "response_id", "same")
    )
    repeated = materialise(repeated, "payloads")
    joined = keyed.join(checked_broadcast(repeated), F.col("sha") == F.col("__sha"), "left")
    own = F.col("page_id") == F.col("response_id")
    single = joined.filter(F.coalesce(~(own & (F.col("same") > 1)), F.lit(True)))
    rows = single.select("page_id", F.lit(0).alias("copy"), "url", "payload", F.when(F.coalesce(own, F.lit(False)), None).otherwise(F.col("response_id")).alias("refers_to"))
    if repeated.filter("same > 1").limit(1).count():
        many = joined.filter(own & (F.col("same") > 1)).groupBy("page_id", "sha").agg(F.min("url").alias("url"), F.first("payload").alias("payload"), F.count(F.lit(1)).alias("n"))
        each = many.select("page_id", "url", "payload", F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)).alias("copy"))
        rows = rows.unionByName(each.select("page_id", "copy", "url", "payload", F.when(F.col("copy") > 0, F.col("page_id")).alias("refers_to")))
    return rows


def write(planned: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the bundles; the index (INDEX), written to the shared folder."""
    kind = planned.schema["page_id"].dataType.simpleString()
    index = INDEX.format(id=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = Writer(folder)
        for batch in batches:
            for row in batch.to_pylist():
                writer.add(row["page_id"], row["copy"], record(row["page_id"], row["copy"], row["url"], row["payload"], row["refers_to"], date))
        writer.close()
        if writer.index:
            columns = list(zip(*writer.index, strict=True))
            kinds = [pa.int64() if kind == "bigint" else pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in index.split(", ")])

    return materialise(planned.mapInArrow(run, index), "index")


def _row(head: dict[str, str], block: bytes, whole: bool = True) -> tuple:
    page = head["WARC-Record-ID"].split(":")[2]
    split = block.index(b"\r\n\r\n") + 4
    length = int(block[:split].split(b"Content-Length: ")[1].split(b"\r\n")[0])
    told = head["WARC-Payload-Digest"].removeprefix("sha1:")
    if head["WARC-Type"] == "response" and (len(block) - split != length or digest(block[split:]) != told):
        raise ValueError(f"payload of page {page} is damaged")
    refers = head.get("WARC-Refers-To")
    return name_back(page, whole), length, told, head["WARC-Type"], name_back(refers.split(":")[2], whole) if refers else None, block[split:]


def read(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """Every record of the bundles that the index names, frame by frame: one row each, from the archive alone."""
    kind = index.schema["page_id"].dataType.simpleString()
    whole, id_type = kind == "bigint", pa.int64() if kind == "bigint" else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                path = f"{base}/{name}"
                with store.open_input_file(path) as f:
                    for at, packed, _ in read_seek_table(f, f.size()):
                        f.seek(at)
                        plain = zstandard.ZstdDecompressor().decompress(f.read(packed))
                        rows, here = [], 0
                        while here < len(plain):
                            head, block, here = parse(plain, here)
                            rows.append(_row(head, block, whole)[:5])
                        columns = list(zip(*rows, strict=True))
                        kinds = [id_type, pa.int64(), pa.string(), pa.string(), id_type]
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    names = dealt(materialise(index.select("bundle").distinct(), "bundles"))
    return names.mapInArrow(run, f"page_id {kind}, payload_bytes long, payload_digest string, record_type string, refers_to {kind}")


def lookup(folder: str, bundle: str, frame: int, frame_offset: int, whole: bool = True) -> tuple:
    """One record by its index entry, reading the footer and one frame: page_id, bytes, digest, type, refers_to, payload."""
    store, base = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{base}/{bundle}") as f:
        at, packed, _ = read_seek_table(f, f.size())[frame]
        f.seek(at)
        head, block, _ = parse(zstandard.ZstdDecompressor().decompress(f.read(packed)), frame_offset)
        return _row(head, block, whole)


def archive(pages: DataFrame, folder: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write pages to bundles and read them back."""
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    return read(spark, folder, write(plan(pages, least_bytes), folder))
