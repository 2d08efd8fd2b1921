"""Ranked lexical search, score at a time over impact-ordered postings.

  1. build() reads the texts once and writes an index of segments: some million terms of whole documents each, with the
     segment's terms, how many of its documents hold each, and by document the terms and how often they occur.
  2. A block of items asks the index for the numbers of documents and terms and for the document frequencies of the
     items' terms, which give every term its weight and every posting its impact.
  3. In a segment the postings of a term are grouped by exact impact, highest first. An item's groups are processed in
     descending impact over all its terms (all groups down to a level, then the next level), each group adding its impact
     to the scores of its documents. A document can still gain at most the sum of the terms' next impacts. As soon as the
     documents that can still be among the best are so few that completing them costs less than the postings left, their
     scores are completed from their own terms; all others are proved to be out.
  4. The segments' best are merged. The segments of a first share are searched before the others, and the k-th score that
     they give an item is a floor for the others: a segment whose bounds sum to less is left at once.

Nothing is shuffled but the best rows of each task. A block of items has a fixed size, so what is broadcast is bounded;
texts are read once however many blocks there are, the index once a block and share.

Defined results: a null or empty text has no terms and counts neither in the documents nor in the lengths; a null item,
or one without known terms, has no rows; repeated documents take a rank each, repeated items are ranked each; documents
of equal score are ranked by id, null ids last; texts of any length are read whole, and one that is larger than a segment
is a segment; empty tables give an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kenning.llm.common import columns, materialise

#: Terms (with repeats) that close a segment; distinct terms of items, summed over the items, that close a block.
SEGMENT_TERMS, BLOCK_TERMS = 2_000_000, 500_000
#: One segment in so many is searched first, for the floors.
FIRST = 16
#: Each level is this share of the one before it.
LEVEL = 0.75
#: Parameters of the impact: numerator, weight of the constant part and of the length (percent).
SCALE, WHOLE, SLOPE = 1_000_000_000, 100, 90

_TABLE = bytes(ord(chr(b).lower()) if chr(b).isalnum() or b > 127 else 32 for b in range(128)) + bytes(range(128, 256))


def terms(text: bytes) -> list[bytes]:
    """The maximal stretches of ASCII letters and digits and of all characters beyond ASCII; A-Z lower-cased."""
    return text.translate(_TABLE).split()


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Unweighted impact of postings: occurrences tf in documents of n terms."""
    m = (WHOLE - SLOPE) + (SLOPE * n * n_docs) // n_terms
    return (SCALE * tf) // (1000 * tf + 8 * m)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _segment(ids: list, docs: list[np.ndarray], known: dict[bytes, int], id_type: pa.DataType) -> pa.RecordBatch:
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i]))
    lengths = np.array([len(docs[i]) for i in order], dtype=np.int64)
    at = np.repeat(np.arange(len(order), dtype=np.int64), lengths)
    found, tf = np.unique(at * len(known) + np.concatenate([docs[i] for i in order]), return_counts=True)
    doc, term = np.divmod(found, len(known))
    values = dict(
        n_docs=len(ids), n_terms=int(lengths.sum()), terms=b" ".join(known), dfs=np.bincount(term, minlength=len(known)).astype("<i4").tobytes(), lengths=lengths.astype("<i8").tobytes(),
        starts=np.searchsorted(doc, np.arange(len(order) + 1)).astype("<i8").tobytes(), term=term.astype("<i4").tobytes(), tf=tf.astype("<i4").tobytes(),
    )
    return pa.record_batch([pa.array([v]) for v in values.values()] + [pa.array([[ids[i] for i in order]], pa.list_(id_type))], names=[*values, "ids"])


def build(docs: DataFrame, segment_terms: int = SEGMENT_TERMS) -> DataFrame:
    """The index of docs (doc_id, text), written: a row per segment."""
    slim = columns(docs, doc_id="doc_id", text="text").select("doc_id", F.col("text").cast("string").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, known, size, id_type = [], [], {}, 0, None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if found := terms(text or b""):
                    ids.append(i)
                    held.append(np.array([known.setdefault(t, len(known)) for t in found], dtype=np.int64))
                    size += len(found)
                if size >= segment_terms:
                    yield _segment(ids, held, known, id_type)
                    ids, held, known, size = [], [], {}, 0
        if ids:
            yield _segment(ids, held, known, id_type)

    schema = f"n_docs long, n_terms long, terms binary, dfs binary, lengths binary, starts binary, term binary, tf binary, ids array<{kind}>"
    return materialise(slim.mapInArrow(run, schema).withColumn("segment", F.monotonically_increasing_id()), "lexical")


class Segment:
    """The postings of the asked terms in one segment, by document and by exact impact."""

    def __init__(self, row: dict, asked: dict[bytes, int], n_docs: int, n_terms: int):
        own = {t: i for i, t in enumerate(row["terms"].split(b" "))}
        self.ids = row["ids"]
        lengths, starts = np.frombuffer(row["lengths"], "<i8"), np.frombuffer(row["starts"], "<i8")
        term, tf = np.frombuffer(row["term"], "<i4"), np.frombuffer(row["tf"], "<i4").astype(np.int64)
        to = np.full(len(own), -1, dtype=np.int64)
        for t, k in asked.items():
            if (i := own.get(t)) is not None:
                to[i] = k
        doc = np.repeat(np.arange(len(lengths)), np.diff(starts))
        here = np.flatnonzero(to[term] >= 0)
        self.term, self.doc = to[term[here]], doc[here]
        self.impact = impacts(tf[here], lengths[self.doc], n_docs, n_terms)
        self.starts = np.searchsorted(self.doc, np.arange(len(lengths) + 1))
        order = np.lexsort((-self.impact, self.term))
        self.by_impact, self.down = self.doc[order], -self.impact[order]  # down ascends within a term
        self.bounds = np.searchsorted(self.term[order], np.arange(len(asked) + 1))

    def complete(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Whole scores of some documents, from their own terms."""
        sizes = self.starts[docs + 1] - self.starts[docs]
        at = np.repeat(self.starts[docs] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        sums = np.concatenate([[0], np.cumsum(weights[self.term[at]] * self.impact[at])])
        ends = np.cumsum(sizes)
        return sums[ends] - sums[ends - sizes]

    def best(self, asked: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (positions) and scores of the k best with a score of at least floor, and 1; ties by position."""
        lists = [(self.bounds[t], self.bounds[t + 1], int(weights[t])) for t in asked if self.bounds[t] < self.bounds[t + 1] and weights[t]]
        tops = [-w * int(self.down[a]) for a, _, w in lists]
        floor = max(floor, 1)
        if sum(tops) < floor:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lowest = min(-w * int(self.down[b - 1]) for _, b, w in lists)
        levels = [int(max(tops) * LEVEL)]
        while levels[-1] > lowest:
            levels.append(int(levels[-1] * LEVEL))
        # ends[i][j]: where the groups of list i with an impact of levels[j] or more end.
        ends = [a + np.searchsorted(self.down[a:b], [-x // w for x in levels], side="right") for a, b, w in lists]
        scores, at = np.zeros(len(self.ids), dtype=np.int64), [a for a, _, _ in lists]
        left = sum(b - a for a, b, _ in lists)
        stay = None
        for j in range(len(levels)):
            rest = 0
            for i, (_, b, w) in enumerate(lists):
                if (end := int(ends[i][j])) > at[i]:
                    scores[self.by_impact[at[i] : end]] -= w * self.down[at[i] : end]
                    left -= end - at[i]
                    at[i] = end
                if at[i] < b:
                    rest -= w * int(self.down[at[i]])
            if not left:
                break
            least = max(floor, int(np.partition(scores, -k)[-k])) if len(scores) > k else floor
            stay = np.flatnonzero(scores + rest >= least)
            if (self.starts[stay + 1] - self.starts[stay]).sum() < left:
                break
        if left:
            own = np.zeros_like(weights)
            own[asked] = weights[asked]
            docs, scores = stay, self.complete(stay, own)
        else:
            docs = np.arange(len(scores))
        good = np.flatnonzero(scores >= floor)
        good = good[np.lexsort((docs[good], -scores[good]))[:k]]
        return docs[good], scores[good]


def _blocks(items: DataFrame, limit: int) -> Iterator[list[tuple]]:
    held, size = [], 0
    for r in items.toLocalIterator():
        own = set(terms((r["text"] or "").encode()))
        held.append((r["item_id"], own))
        size += len(own)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def _frequencies(index: DataFrame, asked: dict[bytes, int]) -> dict[int, int]:
    """Documents by number of the asked term, of those that occur."""
    shared = index.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), dtype=np.int64)
        for batch in batches:
            for own, dfs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for t, n in zip(own.split(b" "), np.frombuffer(dfs, "<i4").tolist(), strict=True):
                    if (k := shared.value.get(t)) is not None:
                        total[k] += n
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some, pa.int64()), pa.array(total[some])], names=["term", "n"])

    return {r["term"]: r["n"] for r in index.select("terms", "dfs").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}


def search(index: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS, first: int = FIRST) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of the index for each row of items (item_id, text)."""
    spark = index.sparkSession
    slim = columns(items, item_id="item_id", text="text").select("item_id", F.col("text").cast("string").alias("text"))
    id_kind = index.schema["ids"].dataType.elementType.simpleString()
    all_docs, all_terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()

    def scan(part: DataFrame, block) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked, weights, queries, floors = block.value
            floors, best = list(floors), [[] for _ in queries]
            id_type = None
            for batch in batches:
                id_type = batch.schema.field("ids").type.value_type
                for row in range(batch.num_rows):
                    part = Segment(batch.slice(row, 1).to_pylist()[0], asked, all_docs, all_terms)
                    for q, own in enumerate(queries):
                        docs, scores = part.best(own, weights, k, floors[q])
                        if len(docs):
                            best[q] = sorted([*best[q], *((-s, part.ids[d] is None, part.ids[d]) for d, s in zip(docs.tolist(), scores.tolist(), strict=True))])[:k]
                            if len(best[q]) == k:
                                floors[q] = max(floors[q], -best[q][-1][0])
            if id_type is not None:
                rows = [(q, -s, i) for q, found in enumerate(best) for s, _, i in found]
                yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], id_type)], names=["item", "score", "doc_id"])

        return part.drop("segment", "n_docs", "n_terms", "dfs").mapInArrow(run, f"item long, score long, doc_id {id_kind}")

    def top(found: DataFrame) -> DataFrame:
        w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)

    out, share = None, F.pmod(F.xxhash64("segment"), F.lit(first))
    for held in _blocks(slim, block_terms) if all_docs else ():
        asked = {t: i for i, t in enumerate(sorted(set().union(*(own for _, own in held))))}
        weights = np.zeros(len(asked), dtype=np.int64)
        for t, n in _frequencies(index, asked).items():
            weights[t] = weight(all_docs, n)
        queries = [np.array(sorted(asked[t] for t in own), dtype=np.int64) for _, own in held]
        before = materialise(top(scan(index.filter(share == 0), spark.sparkContext.broadcast((asked, weights, queries, [0] * len(held))))), "best")
        floors = {r["item"]: r["score"] for r in before.filter(F.col("rank") == k).select("item", "score").collect()}
        after = scan(index.filter(share != 0), spark.sparkContext.broadcast((asked, weights, queries, [floors.get(i, 0) for i in range(len(held))])))
        names = spark.createDataFrame([(i, n) for i, (n, _) in enumerate(held)], f"item long, item_id {slim.schema['item_id'].dataType.simpleString()}")
        ranked = top(before.drop("rank").unionByName(after)).join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = ranked if out is None else out.unionByName(materialise(ranked, "ranked"))
    if out is None:
        return spark.createDataFrame([], f"item_id {slim.schema['item_id'].dataType.simpleString()}, rank int, doc_id {id_kind}, score long")
    return out
