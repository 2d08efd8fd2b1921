"""Exact top-k search over vectors by MaxScore.

Components become whole numbers (floor of 256 x) and the score is their inner product. The terms of a query are its
components; the postings of a term are the values that a shard's rows have in that component. In a shard a term's
contribution to a score lies between two bounds, of which one belongs to the largest and one to the smallest value there.

With the k-th best score found so far as threshold, terms are ordered by the spread of their bounds. The last ones are
non-essential: even a row that has the most of each of them, and the least of all others, stays below the threshold. So
the postings of the essential terms are traversed first; rows whose partial score and the bounds of the rest reach the
threshold are probed in the other terms, some terms at a time, while they are competitive. What is left has its exact
score. Ties at the threshold are kept, as a smaller id may win.

Queries are handed to the tasks in blocks of a fixed size. A task keeps the k best rows of each query over its shards,
and these are merged by query. A first share of the rows, by a hash of the id, is searched before the others: the k-th
score that it gives a query is the threshold that the other tasks begin with, so they hand on few rows that don't win.

Defined results: vectors that are null or hold a null or a non-finite component (or one whose 256-fold isn't finite) take
no part; shorter vectors count as filled up with zeros, so an empty one scores zero; rows of the query's own id are not
its candidates; repeated candidates take a rank each, repeated queries are ranked each; a null id is a candidate, ranked
after equal scores, and no query; scores beyond 64 bits are cut off at their ends; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kenning.llm.common import columns, materialise

#: Rows in a shard; bytes of queries in a block.
SHARD, BLOCK_BYTES = 4096, 32 << 20
#: One row in so many is searched first, for the thresholds; terms that are probed at a time.
FIRST, PROBE = 16, 4
LONG = (1 << 63) - 1


def whole(vectors: list[list[float]]) -> np.ndarray:
    """Rows of floor(256 x), filled up with zeros; Python's integers where they may not fit in 63 bits."""
    wide = max(map(len, vectors), default=0)
    flat = np.zeros((len(vectors), wide))
    for i, v in enumerate(vectors):
        flat[i, : len(v)] = v
    flat = np.floor(256 * flat)
    if np.abs(flat).max(initial=0) < 2.0**62:
        return flat.astype(np.int64)
    return np.array([[int(x) for x in row] for row in flat], dtype=object).reshape(flat.shape)


def widened(rows: np.ndarray, wide: int) -> np.ndarray:
    return rows if rows.shape[1] >= wide else np.pad(rows, ((0, 0), (0, wide - rows.shape[1])))


class Shard:
    """Rows as postings by component, in the smallest type that holds every partial score exactly."""

    def __init__(self, rows: np.ndarray, most: list[int]):
        """most: by component, the largest absolute value in the queries."""
        wide = max(rows.shape[1], len(most))
        rows = widened(rows, wide)
        self.least, self.largest = rows.min(axis=0), rows.max(axis=0)
        total = sum(max(abs(int(a)), abs(int(b))) * m for a, b, m in zip(self.least, self.largest, [*most, *[0] * (wide - len(most))], strict=True))
        self.kind = np.float32 if total < 1 << 24 else np.float64 if total < 1 << 53 else np.int64 if total < 1 << 63 else object
        self.postings = np.ascontiguousarray(rows.T.astype(self.kind))

    def best(self, query: np.ndarray, k: int, threshold: int | None, own: np.ndarray) -> tuple[np.ndarray, list[int], int]:
        """Rows (positions in order) that may be among the k best, with exact scores, and how many values were read.

        threshold: rows below it are out; own: a mask of the rows that are no candidates.
        """
        threshold = None if threshold == -LONG - 1 else threshold
        terms = np.flatnonzero(query)
        q = query[terms].astype(self.kind)
        a, b = q * self.least[terms].astype(self.kind), q * self.largest[terms].astype(self.kind)
        low, high = np.minimum(a, b), np.maximum(a, b)
        order = np.argsort(-(high - low), kind="stable")
        terms, q, low, high = terms[order], q[order], low[order], high[order]
        rest = np.concatenate([np.cumsum(high[::-1])[::-1], np.zeros(1, self.kind)])  # most that terms i and on can give
        if threshold is None:
            essential = len(terms)
        else:
            reach = np.concatenate([np.zeros(1, self.kind), np.cumsum(low)]) + rest  # the least of terms before i, the most of the others
            essential = min(int((reach >= threshold).sum()), len(terms))
        partial = q[:essential] @ self.postings[terms[:essential]] if essential else np.zeros(self.postings.shape[1], self.kind)
        read = essential * self.postings.shape[1]
        stay = ~own if threshold is None else ~own & (partial + rest[essential] >= threshold)
        rows = np.flatnonzero(stay)
        partial = partial[rows]
        for at in range(essential, len(terms), PROBE):
            some = slice(at, at + PROBE)
            partial = partial + q[some] @ self.postings[np.ix_(terms[some], rows)]
            read += len(terms[some]) * len(rows)
            stay = partial + rest[min(at + PROBE, len(terms))] >= threshold
            rows, partial = rows[stay], partial[stay]
            if not len(rows):
                break
        if self.kind is object:
            partial = np.array([max(-LONG - 1, min(LONG, x)) for x in partial], dtype=object)
        if len(rows) > k:  # keep what ties with the k-th
            cut = np.sort(partial)[-k] if self.kind is object else np.partition(partial, -k)[-k]
            rows, partial = rows[partial >= cut], partial[partial >= cut]
        return rows, [int(x) for x in partial], read


def _blocks(queries: DataFrame, limit: int) -> Iterator[tuple[list, list[list[float]]]]:
    ids, held, size = [], [], 0
    for r in queries.toLocalIterator():
        ids.append(r["vec_id"])
        held.append(r["embedding"])
        size += 64 + 8 * len(r["embedding"])
        if size >= limit:
            yield ids, held
            ids, held, size = [], [], 0
    if ids:
        yield ids, held


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part."""
    slim = columns(vectors, vec_id="vec_id", embedding="embedding").withColumn("embedding", F.col("embedding").cast("array<double>"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(7.0e305)))
    return slim.filter(F.col("embedding").isNotNull() & fine)


def search(vectors: DataFrame, is_query: Column, k: int = 5, block_bytes: int = BLOCK_BYTES, shard: int = SHARD, first: int = FIRST) -> DataFrame:
    """query_id, rank, vec_id, score: for each row that meets is_query (over vec_id), the k best of all other rows."""
    rows, spark = usable(vectors), vectors.sparkSession
    kind = rows.schema["vec_id"].dataType.simpleString()

    def scan(part: DataFrame, block) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, queries, thresholds = block.value
            best: list[list[tuple]] = [[] for _ in names]
            thresholds = list(thresholds)
            most = [int(x) for x in np.abs(queries).max(axis=0)]
            ids, held, id_type = [], [], None

            def flush() -> None:
                order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i]))
                mine = [ids[i] for i in order]
                own: dict = {}
                for i, x in enumerate(mine):
                    own.setdefault(x, []).append(i)
                values = whole([held[i] for i in order])
                here = Shard(values, most)
                asked, none = widened(queries, here.postings.shape[0]), np.zeros(len(mine), dtype=bool)
                for q, name in enumerate(names):
                    mask = none
                    if name in own:
                        mask = none.copy()
                        mask[own[name]] = True
                    found, scores, _ = here.best(asked[q], k, thresholds[q], mask)
                    if len(found):
                        near = [(-s, mine[i] is None, i) for i, s in zip(found.tolist(), scores, strict=True)]
                        near = [(s, n, mine[i]) for s, n, i in sorted(near)[:k]]
                        best[q] = sorted([*best[q], *near])[:k]
                        if len(best[q]) == k:
                            worst = -best[q][-1][0]
                            thresholds[q] = worst if thresholds[q] is None else max(thresholds[q], worst)

            for batch in batches:
                id_type = batch.schema.field(0).type
                for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    ids.append(i)
                    held.append(v)
                    if len(ids) == shard:
                        flush()
                        ids, held = [], []
            if ids:
                flush()
            if id_type is not None:
                out = [(q, -s, i) for q, found in enumerate(best) for s, _, i in found]
                yield pa.record_batch([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], id_type)], names=["query", "score", "vec_id"])

        return part.mapInArrow(run, f"query long, score long, vec_id {kind}")

    def top(found: DataFrame) -> DataFrame:
        w = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
        return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)

    out, share = None, F.pmod(F.xxhash64("vec_id"), F.lit(first))
    for names, held in _blocks(rows.filter(is_query), block_bytes):
        queries = whole(held)
        before = materialise(top(scan(rows.filter(share == 0), spark.sparkContext.broadcast((names, queries, [None] * len(names))))), "best")
        floors = {r["query"]: r["score"] for r in before.filter(F.col("rank") == k).select("query", "score").collect()}
        after = scan(rows.filter(share != 0), spark.sparkContext.broadcast((names, queries, [floors.get(i) for i in range(len(names))])))
        listed = spark.createDataFrame(list(enumerate(names)), f"query long, query_id {kind}")
        ranked = top(before.drop("rank").unionByName(after)).join(F.broadcast(listed), "query").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
        out = ranked if out is None else out.unionByName(materialise(ranked, "ranked"))
    if out is None:
        return rows.limit(0).select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score"))
    return out
