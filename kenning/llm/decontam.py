"""Benchmark decontamination by q-gram lemma filtering.

Passages of a benchmark item are the whole item (or windows of 240 characters, by half overlapping, if it is longer) and
windows of 80 characters, one every 16, so that every contiguous quote of 95 characters or more of a longer item holds a
whole one. A passage of m characters that occurs in a text with at most k edits (7 % of m, rounded down) shares at least
m + 1 - (k + 1) * q character q-grams with the region, all of them within k diagonals of each other. So, per text:

  1. every q-gram of the text is looked up in a hash table of the benchmark's q-grams;
  2. stretches of m + k characters with fewer hits than the bound are dropped by a running sum;
  3. the hits left are counted per passage in overlapping diagonal bands of width 2 (k + 1), and bands under the bound
     are dropped; hits are expanded some hundred thousand at a time and their counts added up;
  4. what remains, touching bands together, is verified by banded alignment (edit distance within the band).

q is 12, or 8, 6, 4 or 3 for passages under 60 characters whose bound would be under 1 with 12; each q has an index of
its own, so the budget is 7 % at every length.

Texts are compared by code points, lower-cased (A-Z), with runs of white space as one space. The benchmark is processed
in blocks of a fixed size, so what is broadcast at a time has a fixed bound however large the benchmark is; the texts
are then read once per block, and what a block leaves is written before the next one is read.

Defined results: null or empty texts and items match nothing; items shorter than 12 characters are compared whole words
only, as exact substrings; repeated rows give equal rows; an empty table on either side gives no matches; texts are
searched whole, and long or periodic ones take memory in proportion to their length; item ids that aren't whole numbers
are given as strings; other columns are ignored by find() and kept by drop_contaminated(), whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kenning.llm.common import columns, materialise, plain

Q, RATE, WINDOW = 12, 0.07, 240
#: Short passages: characters, and characters from one to the next.
QUOTE, STRIDE = 80, 16
#: Most characters of passages in one block: a block's arrays take about 16 bytes a character.
BLOCK_CHARS = 4_000_000
#: Most hits that are expanded at once; most characters of a region that are aligned at once.
SLICE, REGION = 500_000, 1 << 16
_TABLE_BITS = 22
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def normalise(text: bytes) -> str:
    return b" ".join(text.lower().split()).decode("utf-8")


def points(text: str) -> np.ndarray:
    """Code points."""
    return np.frombuffer(text.encode("ascii"), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le"), np.uint32)


def windows(item: str, window: int, stride: int) -> list[str]:
    """The item, or windows that cover it."""
    if len(item) <= window:
        return [item] if item else []
    starts = [*range(0, len(item) - window, stride), len(item) - window]
    return [item[s : s + window] for s in starts]


def passages(item: str, window: int = WINDOW) -> list[str]:
    """The item, or windows that overlap by half and cover it; and the short windows for quotes of a part."""
    return list(dict.fromkeys(windows(item, window, window // 2) + windows(item, QUOTE, STRIDE)))


def edits_allowed(length: int, rate: float = RATE) -> int:
    return int(length * rate)


def gram_size(length: int, q: int = Q, rate: float = RATE) -> int:
    """The largest of q, 8, 6, 4 and 3 for which a passage with all its edits still shares a gram; q for passages shorter than q."""
    fits = [x for x in (q, 8, 6, 4, 3) if x <= q and x * (edits_allowed(length, rate) + 1) <= length]
    return fits[0] if fits and length >= q else q


def gram_hashes(text: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit polynomial hash of each q-gram of the code points, from those of halves: q must be 4 * 2 ** i or 3 * 2 ** i."""
    if len(text) < q:
        return np.zeros(0, dtype=np.uint64)
    part, size = text.astype(np.uint64) + np.uint64(1), 1
    power = np.array([_MULTIPLIER])
    if q % 3 == 0:
        part, size = (part[:-2] * power + part[1:-1]) * power + part[2:], 3
        power = power * power * power
    while size < q:
        part = part[:-size] * power + part[size:]
        power, size = power * power, size * 2
    if size != q:
        raise ValueError("q must be 4 * 2 ** i or 3 * 2 ** i")
    return part


def edit_distance_within(p: np.ndarray, t: np.ndarray, k: int) -> tuple[int, int, int]:
    """(distance, start, end) of the best occurrence of p in t (code points) by banded alignment; distance k + 1 if above k.

    Free start and end in t; the band follows the diagonals 0 to len(t) - len(p), widened by k.
    """
    m, n = len(p), len(t)
    columns = np.arange(n + 1)
    cost = np.zeros(n + 1, dtype=np.int64)
    origin = columns.copy()
    for i in range(1, m + 1):
        low, high = max(0, i - k), min(n, n - m + i + k)
        step_cost = np.full(n + 1, m + k + 1, dtype=np.int64)
        step_from = origin.copy()
        diagonal = cost[:-1] + (t != p[i - 1])
        step_cost[1:], step_from[1:] = diagonal, origin[:-1]
        down = cost + 1
        better = down < step_cost
        step_cost[better], step_from[better] = down[better], origin[better]
        # A run of insertions: the running minimum of cost less position.
        shifted = step_cost - columns
        least = np.minimum.accumulate(shifted)
        source = np.maximum.accumulate(np.where(shifted == least, columns, 0))
        cost, origin = least + columns, step_from[source]
        cost[:low] = m + k + 1
        cost[high + 1 :] = m + k + 1
        if cost.min() > k:
            return k + 1, 0, 0
    end = int(cost.argmin())
    return int(cost[end]), int(origin[end]), end


class Index:
    """The q-grams of passages with the same gram_size(); those under `whole` characters are compared as whole words."""

    def __init__(self, items: list[tuple[object, str]], q: int = Q, rate: float = RATE, whole: int = Q):
        self.q = q
        self.item = [i for i, _ in items]
        self.text = [t for _, t in items]
        self.edits = np.array([edits_allowed(len(t), rate) for t in self.text], dtype=np.int64)
        lengths = np.array([len(t) for t in self.text], dtype=np.int64)
        self.lengths = lengths
        self.need = np.maximum(1, lengths + 1 - (self.edits + 1) * q)
        grams = [gram_hashes(points(t), q) for t in self.text]
        hashes = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(grams), dtype=np.int32), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g), dtype=np.int32) for g in grams]) if grams else np.zeros(0, np.int32)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owner, self.place = hashes[order], owner[order], place[order]
        self.table = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.table[(self.hashes >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True
        long = lengths >= whole
        self.least = int(self.need[long].min()) if long.any() else 1
        self.widest = int((lengths + self.edits)[long].max()) if long.any() else q
        self.short = [k for k in range(len(lengths)) if lengths[k] < whole]

    def _bands(self, grams: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passage, band) of the diagonal bands with hits enough; hit: places of grams that may be in the index."""
        low = np.searchsorted(self.hashes, grams[hit], side="left")
        count = np.searchsorted(self.hashes, grams[hit], side="right") - low
        hit, low, count = hit[count > 0], low[count > 0], count[count > 0]
        none = np.zeros(0, np.int64)
        bands, hits, until = none, none, np.cumsum(count)
        first = 0
        while first < len(hit):
            done = int(until[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(until, done + SLICE, side="right")))
            n = count[first:last]
            entry = np.repeat(low[first:last] - (until[first:last] - n - done), n) + np.arange(int(n.sum()))
            passage = self.owner[entry].astype(np.int64)
            diagonal = np.repeat(hit[first:last], n) - self.place[entry]
            band = np.floor_divide(diagonal, self.edits[passage] + 1)
            # Bands of two widths that overlap by one: diagonals within k of each other share at least one.
            key = (np.concatenate([passage, passage]) << 40) + (np.concatenate([band, band - 1]) + (1 << 20))
            new, number = np.unique(key, return_counts=True)
            if len(bands):
                bands, at = np.unique(np.concatenate([bands, new]), return_inverse=True)
                hits = np.bincount(at, weights=np.concatenate([hits, number])).astype(np.int64)
            else:
                bands, hits = new, number
            first = last
        owner, where = bands >> 40, (bands & ((1 << 40) - 1)) - (1 << 20)
        keep = hits >= self.need[owner]
        return owner[keep], where[keep]

    def _regions(self, owner: np.ndarray, where: np.ndarray, size: int) -> Iterator[tuple[int, int, int]]:
        """(passage, begin, end) of the stretches of text that bands cover; touching ones of a passage are one, long ones are cut with overlap."""
        edits, length = self.edits[owner], self.lengths[owner]
        begin = np.maximum(0, where * (edits + 1) - edits)
        end = np.minimum(size, (where + 2) * (edits + 1) + length + edits)
        apart = np.ones(len(owner), dtype=bool)
        apart[1:] = (owner[1:] != owner[:-1]) | (begin[1:] > end[:-1])
        heads = np.flatnonzero(apart)
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(owner)][: len(heads)], strict=True):
            k, start, stop = int(owner[a]), int(begin[a]), int(end[b - 1])
            while stop - start > REGION:
                yield k, start, start + REGION
                start += REGION - int(self.lengths[k] + 2 * self.edits[k])
            yield k, start, stop

    def search(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(passage, edits, start, end) in the normalised text: the best occurrence in each stretch that may hold one."""
        for k in self.short:
            at = f" {text} ".find(f" {self.text[k]} ")
            if at >= 0:
                yield k, 0, at, at + len(self.text[k])
        code = points(text)
        grams = gram_hashes(code, self.q)
        if not len(grams) or not len(self.hashes):
            return
        hit = np.flatnonzero(self.table[(grams >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)])
        if len(hit) < self.least:
            return
        # Stretches: a hit stays if some stretch of the widest passage's length around it holds enough hits.
        behind = np.searchsorted(hit, hit + self.widest) - np.arange(len(hit))
        dense = behind >= self.least
        if not dense.any():
            return
        reach = np.zeros(len(hit) + 1, dtype=np.int64)
        first = np.flatnonzero(dense)
        np.add.at(reach, first, 1)
        np.add.at(reach, first + behind[first], -1)
        for k, begin, end in self._regions(*self._bands(grams, hit[np.cumsum(reach[:-1]) > 0]), len(text)):
            at = text.find(self.text[k], begin, end)
            if at >= 0:
                yield k, 0, at, at + int(self.lengths[k])
                continue
            edits = int(self.edits[k])
            distance, start, stop = edit_distance_within(points(self.text[k]), code[begin:end], edits)
            if distance <= edits:
                yield k, distance, start + begin, stop + begin


class Block:
    """The indexes of a block of passages, one for each gram_size()."""

    def __init__(self, items: list[tuple[object, str]], q: int = Q, rate: float = RATE):
        sizes: dict[int, list[tuple[object, str]]] = {}
        for item, text in items:
            sizes.setdefault(gram_size(len(text), q, rate), []).append((item, text))
        self.parts = [Index(held, size, rate, q) for size, held in sorted(sizes.items(), reverse=True)]

    def search(self, raw: bytes) -> Iterator[tuple[object, int]]:
        """(item, edits) of the passages found."""
        text = normalise(raw)
        for part in self.parts:
            for k, edits, *_ in part.search(text):
                yield part.item[k], edits


def blocks(benchmark: DataFrame, window: int = WINDOW, limit: int = BLOCK_CHARS) -> Iterator[list[tuple[object, str]]]:
    """(item, passage) lists of bounded size; the benchmark is a stated query set and passes through the driver block by block."""
    held: list[tuple[object, str]] = []
    size = 0
    rows = benchmark.select("item_id", F.col("text").cast("binary").alias("t")).filter("t is not null").orderBy("item_id", "t")
    for item, text in rows.toLocalIterator():
        for p in passages(normalise(bytes(text)), window):
            held.append((item, p))
            size += len(p)
            if size >= limit:
                yield held
                held, size = [], 0
    if held:
        yield held


def _items(benchmark: DataFrame) -> tuple[DataFrame, str, pa.DataType]:
    """item_id and text of the benchmark; ids as long or else as string, and the names of that type."""
    slim = columns(benchmark, item_id="item_id", text="text")
    whole = isinstance(slim.schema["item_id"].dataType, T.IntegralType)
    kind = "bigint" if whole else "string"
    return slim.select(F.col("item_id").cast(kind).alias("item_id"), F.col("text").cast("string").alias("text")), kind, pa.int64() if whole else pa.string()


def find(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE, window: int = WINDOW, limit: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of docs: doc_id, contaminated, n_items, item_ids (sorted), least_edits (of the best passage)."""
    base = columns(docs, doc_id="doc_id", text="text")
    base = base.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("row", F.xxhash64(F.coalesce("text", F.lit(""))))
    kind = base.schema["doc_id"].dataType.simpleString()
    items, item_kind, item_type = _items(benchmark)

    def one(shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                items, edits = [], []
                for text in batch.column(1).cast(pa.binary()).to_pylist():
                    found = list(index.search(text)) if text else []
                    items.append(sorted({i for i, _ in found if i is not None}))
                    edits.append(min((e for _, e in found), default=None))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(items, pa.list_(item_type)), pa.array(edits, pa.int32()), batch.column(2)], names=["doc_id", "items", "edits", "row"])

        return base.mapInArrow(run, f"doc_id {kind}, items array<{item_kind}>, edits int, row long")

    merged, count, done = None, 0, None
    for block in blocks(items, window, limit):
        if merged is not None:  # what the earlier blocks gave is written; one block at a time is in memory
            merged = materialise(merged, "decontam") if count == 1 else done.unionByName(materialise(merged, "decontam"))
            done = merged
            shared.unpersist()
        shared = docs.sparkSession.sparkContext.broadcast(Block(block, q, rate))
        merged, count = one(shared), count + 1
    if not count:
        none = F.array().cast(f"array<{item_kind}>")
        return base.select("doc_id", F.lit(False).alias("contaminated"), F.lit(0).cast("long").alias("n_items"), none.alias("item_ids"), F.lit(None).cast("int").alias("least_edits"))
    if count > 1:
        # Equal rows have equal matches: one merged match list per (doc_id, text), as often as the row occurs.
        each = done.unionByName(merged)
        per = each.groupBy("doc_id", "row").agg(F.flatten(F.collect_set("items")).alias("items"), F.min("edits").alias("edits"), (F.count(F.lit(1)) / count).cast("int").alias("times"))
        merged = per.select("doc_id", "items", "edits", F.explode(F.array_repeat(F.lit(1), F.col("times"))))
    return merged.select("doc_id", F.col("edits").isNotNull().alias("contaminated"), F.size(F.array_distinct("items")).cast("long").alias("n_items"), F.sort_array(F.array_distinct("items")).alias("item_ids"), F.col("edits").alias("least_edits"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE, window: int = WINDOW, limit: int = BLOCK_CHARS) -> DataFrame:
    """docs without the rows that hold a passage of the benchmark."""
    left, text = plain(docs, "text")
    at, schema = left.columns.index(text), left.schema
    shared = None
    for block in blocks(_items(benchmark)[0], window, limit):
        if shared is not None:
            left = materialise(left, "decontam")
            shared.unpersist()
        shared = docs.sparkSession.sparkContext.broadcast(Block(block, q, rate))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [not (t and any(True for _ in shared.value.search(t))) for t in batch.column(at).cast(pa.binary()).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        left = left.mapInArrow(run, schema)
    return left.toDF(*docs.columns)
