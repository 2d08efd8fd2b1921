"""SimHash near-duplicates with bit-sliced comparison.

Fingerprints that may be close share a band (an exact value of some of their bits). Rows are dealt by band; within a
task they are sorted by band and stored as vertical bit planes, so one word holds a bit of 64 fingerprints. Comparing
each row with the row s places on is then a shift and an exclusive or per plane; carry-save counters add up 64
distances at a time, and words whose distances all exceed the radius are abandoned. Linked fingerprints are joined in a
union-find and leave the task as star edges, at most one a row, never as pairs.

Bands: with radius r and r + 2 blocks, two blocks at least are equal, so all pairs of blocks are an exact search.

Near copies by Jaccard similarity (drop_near_copies) take shared shingles as bands instead. Shingles are put in one order
for all documents, frequent ones last; of a set of n, the first n - ceil(0.8 n) + 1 are its heads. Two sets with 0.8 or
more in common share a head whatever the order, so no such pair is missed; as frequent shingles come last, documents
that share a common passage and little else have no head in common and are never compared. Which shingles count as
frequent only decides the cost: those that occur in several documents of one batch, summed up over all batches.

  1. Rows of a band within a wide radius (44 of 128 bits) are joined to loose groups. A band with over HOT rows is joined
     as a whole, by one edge a row.
  2. Within a loose group the full shingle sets are compared, after a narrower fingerprint (140 of 512 bits), and only
     pairs with 0.8 or more in common become edges.
  3. In a large loose group each member is first compared with a few pivots, chosen anew from those that no pivot
     reached. What the pivots join into the largest component needs no comparison with itself; only the members outside
     it are compared with all, in blocks of fixed size. A group of near copies of any size so takes work in proportion to
     its size; work grows with (members outside the main component) x (members) only where a large group falls apart.

A band of fingerprints (near_duplicates) held by more than HOT of them is cut into chunks, and each pair of chunks is a
group of its own; no task ever holds more than 2 * HOT rows of one band.

Defined results: null or empty text (no words) has fingerprint zero and is linked like any other; equal rows are in one
component; a null id is ignored when the smallest id is taken; very long texts are read whole, in time and memory in
proportion to their length; an empty table gives an empty result; other columns are ignored by near_duplicates() and
kept by drop_near_copies(), whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kenning.llm.common import checked_broadcast, columns, drop_cut, materialise, or_empty, plain
from kenning.llm.graph import connected_components

SEED = 42
HOT = 4096
#: Near copies have four fifths of their shingles in common.
SIMILAR = (4, 5)
#: A loose group up to this many rows and bytes of shingles is compared in one task; rows of a block of a larger one.
GROUP_ROWS, GROUP_BYTES, BLOCK_ROWS = 1024, 16 << 20, 1024
#: Pivots of a round, and rounds, in a large loose group.
PIVOTS, ROUNDS = 8, 3
#: Documents of a batch that must hold a shingle for it to count as frequent there; most frequent shingles that are listed.
LOCAL, LISTED = 4, 500_000
#: Rows that a task gathers before it compares whole groups; documents whose shingles are counted at a time.
HELD_ROWS, COUNTED = 100_000, 4000
#: Fingerprint words and radius within loose groups; bytes of shingles that a task gathers before it compares whole groups.
FINE_WORDS, FINE_RADIUS, HELD_BYTES = 8, 140, 16 << 20
#: Odd constants that derive further hash words from the first; fixed values of the SplitMix64 generator.
GAMMA, MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of each shingle of the lower-cased (A-Z) words; the whole sequence if there are fewer words; none if none."""
    words = text.lower().split()
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], dtype=np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    begin, end = starts[: len(words) - size + 1].tolist(), (starts + lengths)[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(begin, end, strict=True)], dtype=np.uint64)


class WordHashes(dict):
    """XXH64 of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return found


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX1
    h = (h ^ (h >> np.uint64(27))) * MIX2
    return h ^ (h >> np.uint64(31))


def shingle_set(text: bytes, size: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of the lower-cased (A-Z) words; the whole sequence if there are fewer words; none if none."""
    words = text.lower().split()
    h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    out = np.zeros(max(len(words) - size + 1, 1 if words else 0), dtype=np.uint64)
    for k in range(min(size, len(words))):  # a polynomial of the words' hashes
        out = out * GAMMA + h[k : k + len(out)]
    return np.unique(_mixed(out + np.array([min(size, len(words))], dtype=np.uint64)))


def fingerprint(hashes: np.ndarray, words: int = 1) -> bytes:
    """64 * words bits, each set where over half of the hashes have it; little-endian words."""
    n, out = len(hashes), []
    for k in range(words):
        h = hashes
        if k:
            h = _mixed(hashes + np.array([GAMMA]) * np.uint64(k))
        counts = np.zeros(64, dtype=np.int64)
        for at in range(0, n, 4096):
            part = np.ascontiguousarray(h[at : at + 4096])
            counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
        out.append(np.packbits(2 * counts > n, bitorder="little").tobytes())
    return b"".join(out)


def fingerprints(docs: DataFrame, size: int, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, copy (hash of the text), fp (binary), node (long: the fingerprint itself, or its hash if wider)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(shingle_hashes(t or b"", size), words) for t in batch.column(2).cast(pa.binary()).to_pylist()]
            whole = np.frombuffer(b"".join(prints), dtype="<i8") if words == 1 else np.array([xxhash.xxh64_intdigest(p) for p in prints], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints, pa.binary()), pa.array(whole)], names=["doc_id", "copy", "fp", "node"])

    docs = columns(docs, doc_id=id_col, text=text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()
    slim = docs.select("doc_id", F.xxhash64(or_empty("text")).alias("copy"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, f"doc_id {kind}, copy long, fp binary, node long")


def exact_bands(radius: int, width: int = 64, equal: int = 2) -> list[np.ndarray]:
    """Bit positions of all choices of `equal` of radius + equal blocks: fingerprints within the radius agree on one of them."""
    blocks = np.array_split(np.arange(width), radius + equal)
    return [np.concatenate(chosen) for chosen in combinations(blocks, equal)]


def _bits(prints: np.ndarray) -> np.ndarray:
    """(rows, width) of 0 and 1."""
    return np.unpackbits(prints, axis=1, bitorder="little")


def _as_rows(column: pa.Array, n: int) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, dtype=np.uint8).reshape(n, -1)


def band_rows(prints: DataFrame, bands: list[np.ndarray]) -> DataFrame:
    """band (long), node, fp: a row for each band of each fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            bits = _bits(_as_rows(batch.column(1), n)).astype(np.int64)
            for k, places in enumerate(bands):
                value = bits[:, places] @ (np.int64(1) << np.arange(len(places), dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(value | (k << 40)), batch.column(0), batch.column(1)], names=["band", "node", "fp"])

    return prints.select("node", "fp").mapInArrow(run, "band long, node long, fp binary")


class Planes:
    """Sorted rows as vertical bit planes, and the comparison of each with the row s places on."""

    def __init__(self, prints: np.ndarray, groups: np.ndarray):
        self.n, self.groups = len(prints), groups
        words = (self.n + 63) // 64
        packed = np.packbits(_bits(prints), axis=0, bitorder="little")
        full = np.zeros((packed.shape[1], (words + 2) * 8), dtype=np.uint8)
        full[:, : packed.shape[0]] = packed.T
        self.planes, self.words = full.view(np.uint64), words

    def valid(self, s: int) -> np.ndarray:
        """Words with a bit for each row whose partner s places on is in the same group."""
        same = np.zeros((self.words + 2) * 64, dtype=bool)
        same[: self.n - s] = self.groups[: self.n - s] == self.groups[s:]
        return np.packbits(same, bitorder="little").view(np.uint64)[: self.words]

    def close(self, s: int, radius: int) -> np.ndarray:
        """Rows within the radius of the row s places on, in the same group."""
        alive = self.valid(s)
        at = np.flatnonzero(alive)
        alive = alive[at]
        skip, turn = divmod(s, 64)
        right, left = np.uint64(turn), np.uint64((64 - turn) % 64)
        bits = radius.bit_length()
        counter = [np.zeros(len(at), dtype=np.uint64) for _ in range(bits)]
        over = np.zeros(len(at), dtype=np.uint64)
        for k in range(0, len(self.planes), 2):
            pair = []
            for plane in self.planes[k : k + 2]:
                far = plane[at + skip] >> right
                if turn:
                    far = far | (plane[at + skip + 1] << left)
                pair.append(plane[at] ^ far)
            a, b = pair
            # Carry-save step: the lowest counter plane takes both bits, the carry ripples up.
            half = a ^ b
            carry = (a & b) | (counter[0] & half)
            counter[0] = counter[0] ^ half
            for c in range(1, bits):
                carry, counter[c] = counter[c] & carry, counter[c] ^ carry
            over |= carry
            if k % 8 == 6 or k + 2 >= len(self.planes):
                more, equal = over, ~over
                for c in range(bits - 1, -1, -1):
                    if radius >> c & 1:
                        equal = equal & counter[c]
                    else:
                        more, equal = more | (equal & counter[c]), equal & ~counter[c]
                alive = alive & ~more
                keep = alive != 0
                if not keep.all():
                    at, alive, over = at[keep], alive[keep], over[keep]
                    counter = [c[keep] for c in counter]
                if not len(at):
                    return np.zeros(0, dtype=np.int64)
        hit = np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, bit = np.nonzero(hit)
        return at[row] * 64 + bit


def star_edges(nodes: np.ndarray, prints: np.ndarray, groups: np.ndarray, radius: int, sets: list[bytes] | None = None, settle: bool = False, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of the rows that link within their groups. groups: sorted.

    sets: only rows whose shingle sets are similar() link. settle: groups that are joined as a whole are left early,
    which saves the comparisons that can't add a link. known: components the rows are in already.
    """
    n = len(nodes)
    _, sizes = np.unique(groups, return_counts=True)
    busy = np.repeat(sizes, sizes) > 1
    nodes, prints, groups = nodes[busy], prints[busy], groups[busy]
    rows = np.flatnonzero(busy)
    n = len(nodes)
    if not n:
        return nodes, nodes
    _, group, sizes = np.unique(groups, return_inverse=True, return_counts=True)
    missing = sizes - 1
    planes, parent = Planes(prints, groups), list(range(n))
    if known is not None:
        first: dict[tuple[int, int], int] = {}
        for i, at in enumerate(zip(group.tolist(), known[rows].tolist(), strict=True)):
            parent[i] = first.setdefault(at, i)
            missing[at[0]] -= parent[i] != i

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for s in range(1, int(sizes.max())):
        if settle and s & (s - 1) == 0:  # a power of two
            planes.groups = np.where(missing[group] > 0, groups, -1 - np.arange(n))
        if settle and s >= sizes[missing > 0].max(initial=0):
            break
        for i in planes.close(s, radius).tolist():
            a, b = find(i), find(i + s)
            if a != b and (sets is None or similar(sets[rows[i]], sets[rows[i + s]])):
                parent[max(a, b)] = min(a, b)
                missing[group[i]] -= 1
    root = np.fromiter((find(i) for i in range(n)), dtype=np.int64, count=n)
    linked = np.flatnonzero(root != np.arange(n))
    return nodes[linked], nodes[root[linked]]


def deal(rows: DataFrame) -> DataFrame:
    """band, node, fp, pair: rows (band, node, fp) with the pairs of chunks they belong to; 0 for bands that aren't hot.

    Chunks go by a hash of the node: a band fixes some of the node's own bits, so these can't split it evenly.
    """
    hot = rows.groupBy("band").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > HOT).select("band", F.ceil(F.col("__n") / HOT).cast("int").alias("__chunks"))
    joined = rows.join(checked_broadcast(materialise(hot, "hot")), "band", "left")
    chunk = F.pmod(F.xxhash64("node"), F.col("__chunks"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("__chunks") - 1), lambda j: F.least(chunk, j) * F.col("__chunks") + F.greatest(chunk, j))
    return joined.select("band", "node", "fp", F.explode(F.when(F.col("__chunks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(pairs)).alias("pair"))


def close_edges(dealt: DataFrame, radius: int, settle: bool = False) -> DataFrame:
    """a, b: star edges that join the rows (band, node, fp, pair) within the radius of each other, and if there is a column
    `shingles`, with similar() ones. settle: a band of over HOT rows is joined as a whole; `known`: components so far."""
    checked, labelled = "shingles" in dealt.columns, "known" in dealt.columns
    loose = settle and not checked
    grouped = dealt.repartition("band", "pair").sortWithinPartitions("band", "pair", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole groups of a sorted partition, some hundred thousand rows at a time."""
        held: list[pa.RecordBatch] = []
        size = 0

        def edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        def links(table: pa.Table) -> pa.RecordBatch:
            table = table.combine_chunks()
            band, pair, node = table["band"].to_numpy(), table["pair"].to_numpy(), table["node"].to_numpy()
            new = np.ones(len(band), dtype=bool)
            new[1:] = (band[1:] != band[:-1]) | (pair[1:] != pair[:-1])
            sets = table["shingles"].to_pylist() if checked else None
            return edges(*star_edges(node, _as_rows(table["fp"], len(band)), np.cumsum(new), radius, sets, settle, table["known"].to_numpy() if labelled else None))

        def whole(table: pa.Table) -> Iterator[pa.RecordBatch]:
            """As links(), but bands of over HOT rows are joined without a comparison."""
            band, node = table["band"].to_numpy(), table["node"].to_numpy()
            _, start, count = np.unique(band, return_index=True, return_counts=True)
            large = np.repeat(count > HOT, count)
            for k in np.flatnonzero(count > HOT).tolist():
                at = slice(int(start[k]), int(start[k] + count[k]))
                yield edges(node[at], np.full(count[k], node[at].min()))
            if not large.all():
                yield links(table.filter(pa.array(~large)))

        compare = whole if loose else lambda table: iter([links(table)])
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= HELD_ROWS or checked and sum(x.nbytes for x in held) >= HELD_BYTES:
                table = pa.Table.from_batches(held)
                band, pair = table["band"].to_numpy(), table["pair"].to_numpy()
                edge = np.flatnonzero((band != band[-1]) | (pair != pair[-1]))
                cut = int(edge[-1]) + 1 if len(edge) else 0
                if cut:
                    yield from compare(table.slice(0, cut))
                elif loose:  # one band fills what is held: join it, and go on with HOT + 1 rows of it, so that the rest is joined as well
                    yield from compare(table)
                    cut = len(table) - HOT - 1
                held = table.slice(cut).to_batches()
                size = len(table) - cut
        if size:
            yield from compare(pa.Table.from_batches(held))

    return grouped.mapInArrow(run, "a long, b long")


def components(prints: DataFrame, bands: list[np.ndarray], radius: int) -> DataFrame:
    """node, root for the fingerprints that link to another."""
    distinct = materialise(prints.groupBy("node").agg(F.first("fp").alias("fp")), "prints")
    return connected_components(close_edges(deal(band_rows(distinct, bands)), radius).distinct())


def near_duplicates(docs: DataFrame, size: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 hex digits), component_id (smallest id reachable)."""
    prints = materialise(fingerprints(docs, size, 1, id_col, text_col), "docs")
    # Bands of 21 bits hold few rows each up to a thousand million texts; beyond that 27 bits do. Both are exact.
    roots = components(prints, exact_bands(radius, equal=2 if prints.count() <= 1 << 30 else 3), radius)
    least = prints.groupBy("node").agg(F.min("doc_id").alias("__least"))
    rooted = materialise(least.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "__least"), "roots")
    whole = rooted.groupBy("root").agg(F.min("__least").alias("component_id"))
    named = rooted.select("node", "root").join(whole, "root").select("node", "component_id")
    return prints.join(named, "node").select("doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id")


def heads(n: int) -> int:
    """How many of n shingles in a fixed order a set needs so that it shares one with every similar() set."""
    return n - -(-n * SIMILAR[0] // SIMILAR[1]) + 1 if n else 0


def similar(a: bytes, b: bytes) -> bool:
    """If the shingle sets (sorted 64-bit hashes) have a Jaccard similarity of SIMILAR at least."""
    part, whole = SIMILAR
    least, most = sorted((len(a) // 8, len(b) // 8))
    if whole * least < part * most:
        return False
    both = np.sort(np.concatenate([np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)]))
    common = int((both[1:] == both[:-1]).sum())
    return whole * common >= part * (least + most - common)


def frequent_shingles(texts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the most frequent shingles, at most LISTED, and about how many documents hold them. texts: a string column.

    Counted are documents of batches in which LOCAL or more documents hold the shingle; what reaches the driver is bounded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for part in (batch.slice(at, COUNTED) for batch in batches for at in range(0, batch.num_rows, COUNTED)):
            sets = [shingle_set(t or b"", size, known) for t in part.column(0).cast(pa.binary()).to_pylist()]
            found, n = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(found[n >= LOCAL].view(np.int64)), pa.array(n[n >= LOCAL].astype(np.int64))], names=["shingle", "n"])

    counted = texts.mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    rows = counted.orderBy(F.desc("n"), "shingle").limit(LISTED).toPandas()
    shingle = rows["shingle"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(shingle)
    return shingle[order], rows["n"].to_numpy(dtype=np.int64)[order]


def marked_sets(docs: DataFrame, size: int, words: int) -> DataFrame:
    """docs (doc_id, copy, text) without the text, with node (hash of the shingle set), fp, n (shingles), heads, and
    common (those of the heads that over HOT documents hold), as sorted hashes."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs.select("text"), size))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, (often, count) = WordHashes(), shared.value
        level = np.floor(np.log2(np.maximum(count, 1))).astype(np.int8)
        for batch in batches:
            prints, nodes, sizes, heads_of, common = [], [], [], [], []
            for text in batch.column(2).cast(pa.binary()).to_pylist():
                x = shingle_set(text or b"", size, known)
                head, hot = x[: heads(len(x))], x[:0]
                if len(often) and len(x):
                    at = np.minimum(np.searchsorted(often, x), len(often) - 1)
                    listed = often[at] == x
                    head = x[np.argsort(np.where(listed, level[at], -1), kind="stable")[: heads(len(x))]]
                    at = np.minimum(np.searchsorted(often, head), len(often) - 1)
                    over = (often[at] == head) & (count[at] > HOT)
                    head, hot = head[~over], head[over]
                prints.append(fingerprint(x, words))
                nodes.append(xxhash.xxh64_intdigest(x.tobytes()))
                sizes.append(len(x))
                heads_of.append(head.tobytes())
                common.append(hot.tobytes())
            new = [pa.array(np.array(nodes, dtype=np.uint64).view(np.int64)), pa.array(prints, pa.binary()), pa.array(sizes, pa.int64()), pa.array(heads_of, pa.binary()), pa.array(common, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *new], names=["doc_id", "copy", "node", "fp", "n", "heads", "common"])

    return docs.mapInArrow(run, f"doc_id {kind}, copy long, node long, fp binary, n long, heads binary, common binary")


def whole_sets(texts: DataFrame, size: int) -> DataFrame:
    """band, node, fp (FINE_WORDS), shingles: the full shingle set of each text. texts: band, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            sets = [shingle_set(t or b"", size, known) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            nodes = np.array([xxhash.xxh64_intdigest(x.tobytes()) for x in sets], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes), pa.array([fingerprint(x, FINE_WORDS) for x in sets], pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary())], names=["band", "node", "fp", "shingles"])

    # Rows that are repeated with their id and text give equal sets, of which one stays.
    return texts.mapInArrow(run, "band long, node long, fp binary, shingles binary").dropDuplicates(["node"])


def head_rows(sets: DataFrame, column: str = "heads") -> DataFrame:
    """band, node, fp: a row for each shingle in the column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2).to_pylist()
            at = np.repeat(np.arange(len(lists)), [len(x) // 8 for x in lists])
            bands = np.frombuffer(b"".join(lists), dtype=np.int64)
            for k in range(0, len(at), 50_000):
                own = pa.array(at[k : k + 50_000])
                yield pa.RecordBatch.from_arrays([pa.array(bands[k : k + 50_000]), batch.column(0).take(own), batch.column(1).take(own)], names=["band", "node", "fp"])

    return sets.select("node", "fp", column).mapInArrow(run, "band long, node long, fp binary")


def loose_edges(distinct: DataFrame, radius: int) -> DataFrame:
    """a, b: edges of the loose groups. distinct: node, fp, heads, common."""
    near = close_edges(head_rows(distinct).withColumn("pair", F.lit(0).cast("long")), radius, True)
    common = head_rows(distinct, "common").select("band", "node")
    least = checked_broadcast(materialise(common.groupBy("band").agg(F.min("node").alias("b")), "common"))
    return near.union(common.join(least, "band").select(F.col("node").alias("a"), "b")).filter("a <> b").distinct()


def pivot_edges(sets: DataFrame, pivots: DataFrame) -> DataFrame:
    """a, b: each row of sets (band, node, shingles) with the pivots (band, ps: array of node and shingles) similar to it."""
    joined = sets.select("band", "node", "shingles").join(checked_broadcast(pivots), "band").select("node", "shingles", F.col("ps.node").alias("p"), F.col("ps.shingles").alias("s"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for node, own, others, theirs in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                    near = [p for p, s in zip(others, theirs, strict=True) if p != node and similar(own, s)]
                    a += [node] * len(near)
                    b += near
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return joined.mapInArrow(run, "a long, b long")


def large_group_edges(sets: DataFrame) -> DataFrame:
    """a, b: edges whose components are those of the similar() rows of large loose groups. sets: band, node, fp, shingles, written."""
    left, edges = sets.select("band", "node"), None
    for k in range(ROUNDS):
        salted = left.withColumn("__h", F.xxhash64("node", F.lit(k)))
        chosen = salted.groupBy("band", F.pmod("__h", F.lit(PIVOTS))).agg(F.min_by("node", "__h").alias("node")).select("band", "node")
        held = sets.join(checked_broadcast(materialise(chosen, "chosen")), ["band", "node"])
        pivots = materialise(held.groupBy("band").agg(F.collect_list(F.struct("node", "shingles")).alias("ps")), "pivots")
        found = materialise(pivot_edges(sets, pivots), "reached")
        edges = found if edges is None else edges.union(found)
        reached = found.select(F.col("a").alias("node")).union(found.select("b")).union(pivots.select(F.explode("ps.node"))).distinct()
        left = materialise(left.join(reached, "node", "left_anti"), "unreached")
        if not left.limit(1).count():
            break
    roots = materialise(connected_components(edges), "roots")
    named = materialise(sets.select("band", "node").join(roots, "node", "left").select("band", "node", F.coalesce("root", "node").alias("known")), "named")
    main = named.groupBy("band", "known").agg(F.count(F.lit(1)).alias("n")).groupBy("band").agg(F.max_by("known", F.struct("n", "known")).alias("main"), F.sum("n").alias("n"))
    outside = named.join(main, "band").withColumn("__out", F.col("known") != F.col("main"))
    sizes = outside.groupBy("band").agg(F.ceil(F.count_if("__out") / BLOCK_ROWS).cast("int").alias("__r"), F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("__m"), F.max("main").alias("main")).filter("__r > 0")
    dealt = named.join(checked_broadcast(materialise(sizes, "sizes")), "band").join(sets.drop("band"), "node")
    at = F.xxhash64("node")
    as_any = F.transform(F.sequence(F.lit(0), F.col("__r") - 1), lambda i: i.cast("long") * F.col("__m") + F.pmod(at, F.col("__m")))
    as_out = F.when(F.col("known") != F.col("main"), F.transform(F.sequence(F.lit(0), F.col("__m") - 1), lambda j: F.pmod(at, F.col("__r")) * F.col("__m") + j)).otherwise(F.array().cast("array<bigint>"))
    pairs = dealt.select("band", "node", "fp", "shingles", "known", F.explode(F.array_distinct(F.concat(as_any, as_out))).alias("pair"))
    return edges.union(close_edges(pairs, FINE_RADIUS, True))


def drop_near_copies(docs: DataFrame, size: int = 5, words: int = 2, radius: int = 44) -> DataFrame:
    """docs with one row of each group of near copies: that with the smallest doc_id (then text hash).

    Texts are near copies when 0.8 or more of their five-word shingles are common (Jaccard similarity of the sets), and
    groups are joined by such pairs alone. Every such pair shares a head; of 64 * words bits it differs in 15 % on
    average (19 % for the shortest texts), so that a radius of 44 of 128 leaves it out in less than one of 10,000 cases.
    """
    safe, key, text = plain(docs, "doc_id", "text")
    marked = safe.withColumn("__text", F.xxhash64(or_empty(text)))
    slim = marked.select(F.col(key).alias("doc_id"), F.col("__text").alias("copy"), F.col(text).cast("string").alias("text"))
    prints = materialise(marked_sets(slim, size, words), "docs")
    distinct = materialise(prints.groupBy("node").agg(*[F.first(c).alias(c) for c in ("fp", "n", "heads", "common")]), "prints")
    loose = materialise(connected_components(loose_edges(distinct, radius)).withColumnRenamed("root", "band"), "loose")
    drop_cut(distinct)
    one = prints.join(loose, "node").groupBy("node", "band").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "copy")).alias("k"), F.max("n").alias("n"))
    one = materialise(one.select("band", "n", F.col("k.doc_id").alias("__id"), F.col("k.copy").alias("__copy")), "one")
    sizes = one.groupBy("band").agg(((F.count(F.lit(1)) > GROUP_ROWS) | (F.sum("n") * 8 > GROUP_BYTES)).alias("large")).filter("large").select("band", "large")
    sized = materialise(one.join(checked_broadcast(materialise(sizes, "sizes")), "band", "left"), "sized")

    def sets_of(some: DataFrame) -> DataFrame:
        return whole_sets(slim.join(checked_broadcast(some), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("copy") == F.col("__copy"))).select("band", "text"), size)

    edges = close_edges(sets_of(sized.filter("large is null")).withColumn("pair", F.lit(0).cast("long")), FINE_RADIUS, True)
    large = sized.filter("large")
    if large.limit(1).count():
        edges = edges.union(large_group_edges(materialise(sets_of(large), "sets")))
    roots = connected_components(edges.filter("a <> b").distinct())
    per_copy = prints.groupBy("node", "doc_id", "copy").agg(F.count(F.lit(1)).alias("__rows"))
    best = per_copy.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("__root")).agg(F.min_by(F.struct("doc_id", "copy", "__rows"), F.struct(F.col("doc_id").isNull(), "doc_id", "copy")).alias("k"))
    keep = materialise(best.select(F.col("k.doc_id").alias("__id"), F.col("k.copy").alias("__copy"), F.col("k.__rows").alias("__rows")), "keep")
    drop_cut(prints)
    stay = marked.join(keep, F.col(key).eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__copy")))
    once, repeated = stay.filter("__rows = 1"), stay.filter("__rows > 1")
    if keep.filter("__rows > 1").limit(1).count():
        once = once.unionByName(repeated.dropDuplicates(["__id", "__copy"]))
    return once.select(*safe.columns).toDF(*docs.columns)
