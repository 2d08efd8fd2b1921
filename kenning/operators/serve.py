"""Serving: facets, search pages, session lists, gaps, registry status."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def facets(experiences: DataFrame, top: int = 8) -> DataFrame:
    """facet, value, n over layer, outcome, confidence bucket, lifecycle, service and phase (top ones) in one pass."""
    rows = experiences.select("layer", "outcome", F.round("confidence", 1).cast("string").alias("confidence"), "lifecycle", "service", "phase")
    names = rows.columns
    counted = rows.groupingSets([[F.col(c)] for c in names], *names).agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"))
    facet = F.element_at(F.create_map(*[x for i, c in enumerate(names) for x in (F.lit((2 ** len(names) - 1) ^ (1 << (len(names) - 1 - i))).cast("long"), F.lit(c))]), F.col("gid"))
    flat = counted.select(facet.alias("facet"), F.coalesce(*names).alias("value"), "n")
    order = Window.partitionBy("facet").orderBy(F.col("n").desc(), "value")
    return flat.withColumn("__r", F.row_number().over(order)).filter(~F.col("facet").isin("service", "phase") | (F.col("__r") <= top)).drop("__r")


def search(experiences: DataFrame, layers: list[str] | None = None, session_prefix: str = "", needle: str = "", page: int = 1, size: int = 20) -> DataFrame:
    """A page of matching rows in id order, each with the total of all matches."""
    found = experiences
    if layers:
        found = found.filter(F.col("layer").isin(layers))
    if session_prefix:
        found = found.filter(F.col("session_id").startswith(session_prefix))
    if needle:
        found = found.filter(F.lower("text").contains(needle.lower()))
    total = found.agg(F.count(F.lit(1)).alias("total"))
    shown = found.orderBy("exp_id").offset((page - 1) * size).limit(size)
    return shown.join(F.broadcast(total)).select("exp_id", "layer", "session_id", "service", "total")


def session_list(experiences: DataFrame) -> DataFrame:
    """Per session: first row's service, counts by layer, newest first."""
    counts = [F.sum((F.col("layer") == x).cast("int")).alias(f"n_{x.lower()}") for x in ("FACTUAL", "PROCEDURAL_POS", "PROCEDURAL_NEG", "METACOGNITIVE", "CONCEPTUAL")]
    return experiences.groupBy("session_id").agg(F.min_by("service", "exp_id").alias("service"), F.min("age_days").alias("newest_age"), F.count(F.lit(1)).alias("n"), *counts)


def gap_scores(experiences: DataFrame, top: int = 30) -> DataFrame:
    """Services by how much raw knowledge waits for consolidation: max(0, rows - 3 x consolidated); the top ones."""
    rows = experiences.filter("lifecycle <> 'conflicted'")
    grouped = rows.groupBy(F.coalesce(F.nullif("service", F.lit("")), F.lit("Unknown")).alias("service")).agg(
        F.count(F.lit(1)).alias("raw_count"),
        F.sum((F.col("maturity") == "consolidated").cast("int")).alias("consolidated_count"),
    )
    score = F.greatest(F.lit(0), F.col("raw_count") - 3 * F.col("consolidated_count"))
    first = grouped.withColumn("gap_score", score).orderBy(F.desc("gap_score"), "service").limit(top)
    # Only the CVEs of the top services are listed, each made distinct before it is gathered.
    named = F.coalesce(F.nullif("service", F.lit("")), F.lit("Unknown"))
    own = rows.select(named.alias("service"), F.explode("cves").alias("cve")).join(first.select("service"), "service", "left_semi").distinct()
    listed = own.groupBy("service").agg(F.array_join(F.array_sort(F.collect_list("cve")), ",").alias("cve_list"))
    return first.join(listed, "service", "left").withColumn("cve_list", F.coalesce("cve_list", F.lit(""))).orderBy(F.desc("gap_score"), "service").limit(top)


def union_precedence(registry: DataFrame, other: DataFrame, key: str = "exp_id") -> DataFrame:
    """All rows, the registry's winning by key."""
    both = registry.withColumn("__p", F.lit(0)).unionByName(other.withColumn("__p", F.lit(1)))
    w = Window.partitionBy(key).orderBy("__p")
    return both.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n", "__p")


def registry_status(rows: DataFrame) -> DataFrame:
    return rows.groupBy("lifecycle", "maturity").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("confidence"), 6).alias("mean_confidence"))


def consolidated_stats(made: DataFrame, members: DataFrame) -> DataFrame:
    """facet (layer, maturity or all), value, n, mean_p (of p_fused), n_sources: what consolidation came to.

    made: consolidated rows with cluster_id; members: cluster_id, exp_id. Deprecated layers don't count.
    """
    sources = members.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n_src"))
    shown_rows = made.filter("layer <> 'RAG_EVALUATION'").join(sources, "cluster_id").withColumn("layer", F.when(F.col("layer").startswith("FACTUAL_"), "FACTUAL").otherwise(F.col("layer")))
    sums = shown_rows.groupingSets([["layer"], ["maturity"], []], "layer", "maturity").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.round("p_fused", 4)), 4).alias("mean_p"), F.sum("n_src").alias("n_sources"), F.grouping("layer").alias("gl"), F.grouping("maturity").alias("gm"))
    facet = F.when(F.col("gl") == 0, "layer").when(F.col("gm") == 0, "maturity").otherwise("all")
    return sums.select(facet.alias("facet"), F.coalesce("layer", "maturity", F.lit("")).alias("value"), "n", "mean_p", "n_sources")


def consolidated_page(registry: DataFrame, layers: list[str] | None = None, page: int = 1, size: int = 20) -> DataFrame:
    """A page of the registry's consolidated rows, surest first: what a list of them shows."""
    rows = registry.filter("session_id = 'consolidated'")
    rows = rows.filter(F.col("layer").isin(layers)) if layers else rows
    return rows.orderBy(F.desc_nulls_last("p_fused"), "exp_id").offset((page - 1) * size).limit(size).select("exp_id", "name", "layer", "service", "maturity", F.round("p_fused", 4).alias("p_fused"), "n_members", "n_sessions", "text")


def conflict_page(pairs: DataFrame, registry: DataFrame, page: int = 1, size: int = 20) -> DataFrame:
    """A page of conflict pairs (a, b, score), closest first, with the texts and services of both."""
    top = pairs.orderBy(F.desc("score"), "a", "b").offset((page - 1) * size).limit(size)
    side = lambda c: registry.select(F.col("exp_id").alias(c), F.col("text").alias(f"text_{c}"), F.col("service").alias(f"service_{c}"))
    return top.join(side("a"), "a", "left").join(side("b"), "b", "left").orderBy(F.desc("score"), "a", "b")


def compression(experiences: DataFrame, clusters: DataFrame) -> DataFrame:
    """One row: rows in, clusters out, ratio."""
    a = experiences.agg(F.count(F.lit(1)).alias("n_rows"))
    b = clusters.agg(F.count_distinct("cluster_id").alias("n_clusters"))
    return a.join(F.broadcast(b)).withColumn("ratio", F.round(F.col("n_rows") / F.nullif("n_clusters", F.lit(0)), 6))


def cosine_top(queries: DataFrame, vectors: DataFrame, top: int = 5, block: int = 8192) -> DataFrame:
    """query, neighbour, score, rank: exact cosine top-k of a stated query set against all vectors.

    Both sides: vec_id, embedding (of one length). Queries go out in blocks of a fixed number of rows, as a matrix; each task keeps the
    best of its own rows for each query, and what the tasks keep is ranked together, so no pair beyond tasks x queries x
    top leaves a task. A score with a zero vector is null and ranks last.
    """
    spark = vectors.sparkSession
    slim = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).filter("embedding is not null")
    out, held = None, []

    def unit(rows: np.ndarray) -> np.ndarray:
        norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
        return np.divide(rows, norms, out=np.full_like(rows, np.nan), where=norms > 0)

    def search(ids: np.ndarray, matrix: np.ndarray) -> DataFrame:
        shared = spark.sparkContext.broadcast((ids, unit(matrix).T.copy()))

        def best(q: np.ndarray, i: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            order = np.lexsort((i, -s, q))
            q, i, s = q[order], i[order], s[order]
            begin = np.searchsorted(q, q, side="left")
            keep = np.arange(len(q)) - begin < top
            return q[keep], i[keep], s[keep]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, right = shared.value
            kept = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    part = batch.slice(at, 1024)
                    here = part.column(0).to_numpy()
                    flat = part.column(1).flatten().to_numpy().reshape(len(here), -1)
                    scores = np.nan_to_num(np.round(unit(flat) @ right, 6), nan=-2.0)
                    scores[here[:, None] == own[None, :]] = -np.inf
                    k = max(0, len(here) - top)
                    row, col = np.nonzero(scores >= np.maximum(np.partition(scores, k, axis=0)[k], -3.0))
                    kept = best(np.concatenate([kept[0], col]), np.concatenate([kept[1], here[row]]), np.concatenate([kept[2], scores[row, col]]))
            yield pa.RecordBatch.from_arrays([pa.array(own[kept[0]]), pa.array(kept[1]), pa.array(kept[2], mask=kept[2] < -1.5)], names=["query", "neighbour", "score"])

        return slim.mapInArrow(run, "query long, neighbour long, score double")

    def block_of(rows: list) -> DataFrame:
        return search(np.array([r[0] for r in rows], dtype=np.int64), np.array([r[1] for r in rows], dtype=np.float64))

    asked = queries.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).filter("embedding is not null")
    for row in asked.toLocalIterator():
        held.append(row)
        if len(held) == block:
            out, held = (block_of(held) if out is None else out.unionByName(block_of(held))), []
    if held:
        out = block_of(held) if out is None else out.unionByName(block_of(held))
    if out is None:
        out = spark.createDataFrame([], "query long, neighbour long, score double")
    w = Window.partitionBy("query").orderBy(F.desc("score"), "neighbour")
    return out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


def by_id(rows: DataFrame, key, key_col: str = "exp_id") -> DataFrame:
    """The rows with a given id."""
    return rows.filter(F.col(key_col) == F.lit(key))


# What a lesson doesn't show in the interface.
HIDDEN = {"METACOGNITIVE": ["rag_effectiveness", "rag_adoption_stats", "rag_utility"]}


def shown(rows: DataFrame, hidden: dict[str, list[str]] | None = None) -> DataFrame:
    """rows (layer, content: map of text) without the entries that their layer doesn't show."""

    def without(keys: list[str]):
        return F.map_filter("content", lambda k, _: ~k.isin(keys))

    out = F
    for layer, keys in (HIDDEN if hidden is None else hidden).items():
        out = out.when(F.col("layer") == layer, without(keys))
    return rows.withColumn("content", out.otherwise(F.col("content")))
