"""Token ids in packed binary bundles: best-fit-decreasing with a segment tree over free capacities.

Each task tokenises its rows and packs them in groups of a bounded number of tokens, so nothing is shuffled and a hot
source or a huge document changes nothing: documents longer than a row are split losslessly into full rows and a rest.
Pieces are placed from long to short, each in the fullest row that still has room; a segment tree over capacities finds
that row in log2(capacity) steps.

A bundle is a folder:
  ids.bin         rows x length matrix of little-endian uint16, padded with PAD
  cu_seqlens.bin  int32 cumulative lengths of the segments, row by row, padding counted as a segment of its own
  resets.bin      a bit for each place of the matrix (little bit order): 1 where the position counter restarts at 0
  segments.arrow  a row per piece: document ordinal, part, row, start, length
  documents.arrow a row per document: doc_id
Bundles get fresh names and count only if their task's index row was committed, so retried tasks do no harm.

Defined results: null and empty texts have no tokens and no segments, and a row all the same; a null id stays null;
repeated rows are packed as often as they occur; a text of any length is tokenised whole and split into rows; an empty
table gives no bundle; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kenning.llm.common import columns, dealt, materialise, new_path

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PAD, LENGTH, GROUP_TOKENS, CACHE_WORDS = 50256, 2048, 1 << 21, 400_000
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class Tokens:
    """Byte-level BPE. White space before a word belongs to it, so words can be encoded apart and remembered."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.coder, self.known = ranks, None, {}

    def __getstate__(self) -> dict:
        return {"ranks": self.ranks, "coder": None, "known": {}}

    def encode(self, text: str) -> bytes:
        """Little-endian uint16 ids."""
        if self.coder is None:
            import tiktoken

            self.coder = tiktoken.Encoding("kenning", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
            self.words = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+").findall
        known, words = self.known, self.words(text)
        if len(known) > CACHE_WORDS:
            known.clear()
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            for w in set(words).difference(known):
                known[w] = np.array(self.coder.encode_ordinary(w), dtype="<u2").tobytes()
            return b"".join([known[w] for w in words])

    def decode(self, ids: np.ndarray) -> str:
        self.encode("")
        return self.coder.decode(ids.tolist())


def load(path: str = RANKS) -> Tokens:
    with open(path, "rb") as f:
        return Tokens({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


class Capacities:
    """Segment tree over free capacities 0..most: how many open rows have each; the least one that is enough."""

    def __init__(self, most: int):
        self.size = 1
        while self.size <= most:
            self.size *= 2
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        at = capacity + self.size
        while at:
            self.count[at] += 1
            at //= 2

    def take(self, least: int) -> tuple[int, int] | None:
        """(capacity, row) of the fullest open row with room for `least`, taken out; None if there is none."""
        count, at = self.count, least + self.size
        if not count[at]:
            while at > 1 and (at & 1 or not count[at + 1]):
                at //= 2
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if count[2 * at] else 2 * at + 1
        capacity = at - self.size
        while at:
            count[at] -= 1
            at //= 2
        return capacity, self.rows[capacity].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[tuple[int, int]], int]:
    """(row, start) of each piece, and the number of rows. Lengths are 1 to capacity; equal ones keep their order."""
    places: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    free, rows = Capacities(capacity), 0
    for k in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        n = lengths[k]
        found = free.take(n)
        room, row = found or (capacity, rows)
        rows += found is None
        places[k] = (row, capacity - room)
        if room > n:
            free.put(room - n, row)
    return places, rows


class Group:
    """Documents of one bundle."""

    def __init__(self) -> None:
        self.ids: list = []
        self.tokens: list[bytes] = []
        self.size = 0

    def add(self, doc_id, tokens: bytes) -> None:
        self.ids.append(doc_id)
        self.tokens.append(tokens)
        self.size += len(tokens) // 2

    def write(self, store, base: str, length: int, id_type: pa.DataType) -> tuple[str, int, int, int]:
        """Name, documents, rows and tokens of the bundle written."""
        doc, part, size = [], [], []
        for k, t in enumerate(self.tokens):
            n = len(t) // 2
            for p in range((n + length - 1) // length):
                doc.append(k)
                part.append(p)
                size.append(min(length, n - p * length))
        places, rows = best_fit_decreasing(size, length)
        flat = np.full(rows * length, PAD, dtype="<u2")
        resets = np.zeros(rows * length, dtype=bool)
        used = np.zeros(rows, dtype=np.int64)
        for k, p, n, (row, start) in zip(doc, part, size, places, strict=True):
            at = row * length + start
            flat[at : at + n] = np.frombuffer(self.tokens[k], dtype="<u2", count=n, offset=2 * p * length)
            resets[at] = True
            used[row] += n
        for row in np.flatnonzero(used < length):
            resets[row * length + used[row]] = True
        ends = np.append(np.flatnonzero(resets), rows * length)
        name = f"pack-{uuid.uuid4().hex}"
        store.create_dir(f"{base}/{name}", recursive=True)
        for file, data in (("ids.bin", flat.tobytes()), ("cu_seqlens.bin", ends.astype("<i4").tobytes()), ("resets.bin", np.packbits(resets, bitorder="little").tobytes())):
            with store.open_output_stream(f"{base}/{name}/{file}", compression=None) as f:
                f.write(data)
        where = np.array(places, dtype=np.int32).reshape(-1, 2)
        tables = {
            "segments": pa.table({"document": pa.array(doc, pa.int32()), "part": pa.array(part, pa.int32()), "row": where[:, 0], "start": where[:, 1], "length": pa.array(size, pa.int32())}),
            "documents": pa.table({"doc_id": pa.array(self.ids, id_type)}),
        }
        for file, table in tables.items():
            with store.open_output_stream(f"{base}/{name}/{file}.arrow", compression=None) as f, ipc.new_file(f, table.schema) as out:
                out.write_table(table)
        return name, len(self.ids), rows, self.size


def write(docs: DataFrame, tokens: Tokens, folder: str, length: int = LENGTH, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """bundle, documents, rows, tokens of the bundles written below folder."""
    shared = docs.sparkSession.sparkContext.broadcast(tokens)
    docs = columns(docs, doc_id="doc_id", text="text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        coder, group, kind, index = shared.value, Group(), pa.int64(), []
        for batch in batches:
            kind = batch.column(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                group.add(doc_id, coder.encode(text) if text else b"")
                if group.size >= group_tokens or len(group.ids) >= group_tokens:
                    index.append(group.write(store, base, length, kind))
                    group = Group()
        if group.ids:
            index.append(group.write(store, base, length, kind))
        if index:
            name, count, rows, size = zip(*index, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(count, pa.int32()), pa.array(rows, pa.int32()), pa.array(size, pa.int64())], names=["bundle", "documents", "rows", "tokens"])

    return materialise(docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, "bundle string, documents int, rows int, tokens long"), "packs")


def read(spark: SparkSession, folder: str, index: DataFrame, id_type: str = "bigint", length: int = LENGTH) -> DataFrame:
    """One row per document, from the bundles alone: doc_id, n_tokens, n_segments, bundle, placements, ids_sha256."""
    schema = f"doc_id {id_type}, n_tokens long, n_segments int, bundle string, placements array<struct<row:int,start:int,length:int>>, ids_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                files = {}
                for file in ("ids.bin", "cu_seqlens.bin", "resets.bin", "segments.arrow", "documents.arrow"):
                    with store.open_input_file(f"{base}/{name}/{file}") as f:
                        files[file] = f.read()
                flat = np.frombuffer(files["ids.bin"], dtype="<u2")
                ends = np.frombuffer(files["cu_seqlens.bin"], dtype="<i4")
                resets = np.unpackbits(np.frombuffer(files["resets.bin"], np.uint8), bitorder="little")[: len(flat)]
                if not np.array_equal(np.append(np.flatnonzero(resets), len(flat)), ends):
                    raise ValueError(f"{name}: position resets and cumulative lengths differ")
                ids = ipc.open_file(files["documents.arrow"]).read_all()["doc_id"].combine_chunks()
                table = ipc.open_file(files["segments.arrow"]).read_all()
                document, part, row, start, size = (table[c].to_numpy() for c in ("document", "part", "row", "start", "length"))
                order = np.lexsort((part, document))
                first = np.searchsorted(document[order], np.arange(len(ids) + 1))
                at = (row.astype(np.int64) * length + start)[order].tolist()
                n = size[order].tolist()
                digests, totals = [], []
                for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                    h = hashlib.sha256()
                    for k in range(a, b):
                        h.update(flat[at[k] : at[k] + n[k]])
                    digests.append(h.hexdigest())
                    totals.append(sum(n[a:b]))
                places = pa.StructArray.from_arrays([pa.array(x[order]) for x in (row, start, size)], names=["row", "start", "length"])
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), places)
                yield pa.RecordBatch.from_arrays([ids, pa.array(totals, pa.int64()), pa.array(np.diff(first), pa.int32()), pa.array([name] * len(ids)), lists, pa.array(digests)], names=["doc_id", "n_tokens", "n_segments", "bundle", "placements", "ids_sha256"])

    return dealt(index.select("bundle")).mapInArrow(run, schema)


def pack(docs: DataFrame, tokens: Tokens, folder: str | None = None, length: int = LENGTH, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Write the bundles and read them back."""
    spark = docs.sparkSession
    folder = folder or new_path(spark, "packs")
    return read(spark, folder, write(docs, tokens, folder, length, group_tokens), columns(docs, doc_id="doc_id").schema["doc_id"].dataType.simpleString(), length)
