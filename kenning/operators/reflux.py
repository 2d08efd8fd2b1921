"""Consolidated knowledge on its way to a retrieval store, and what a finished session changes."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kenning.operators import consolidate, fusion, govern, increments
from kenning.plans.store import materialise

# Where a layer goes, and keys that never leave.
DATASETS = {"FACTUAL": "facts", "PROCEDURAL_POS": "procedures", "PROCEDURAL_NEG": "procedures", "METACOGNITIVE": "lessons", "CONCEPTUAL": "concepts"}
SENSITIVE, REDACTED = ["command", "cmd", "payload", "exploit_code", "exec"], "[REDACTED]"


def dataset(layer: Column) -> Column:
    out = F
    for name, target in DATASETS.items():
        out = out.when(layer == name, target)
    return out


def strip_sensitive(json_text: Column, keys: list[str] = SENSITIVE) -> Column:
    """JSON text with the whole value of each sensitive key, at any depth, replaced; what isn't JSON stays as it is.

    A value may hold any structure, which no regular expression can skip, so texts are parsed, in Arrow batches.
    """
    hidden = frozenset(keys)

    def safe(value):
        if isinstance(value, dict):
            return {k: REDACTED if k in hidden else safe(v) for k, v in value.items()}
        return [safe(v) for v in value] if isinstance(value, list) else value

    def one(text: str | None) -> str | None:
        try:
            return None if text is None else json.dumps(safe(json.loads(text)), ensure_ascii=False)
        except ValueError:
            return text

    @F.pandas_udf("string")
    def strip(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(one)

    return strip(json_text)


def candidates(registry: DataFrame) -> DataFrame:
    """Active consolidated rows that aren't out yet."""
    return registry.filter("lifecycle = 'active' AND maturity = 'consolidated' AND NOT coalesce(refluxed, false)")


def flush(registry: DataFrame, sink: Callable[[DataFrame], None] | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents of the candidates, validated and routed, and the registry with those marked. sink gets the documents."""
    texts = govern.retrieval_document(candidates(registry)).withColumn("issues", govern.document_issues())
    docs = materialise(texts.select("exp_id", dataset(F.col("layer")).alias("dataset"), "doc_text", F.array_join("issues", ";").alias("issues"), govern.route(F.col("issues")).alias("route")), "reflux")
    if sink:
        sink(docs)
    return docs, marked(registry, docs)


def remove_conflicted(documents: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents that stay, and those whose row is now in conflict."""
    bad = registry.filter("lifecycle = 'conflicted'").select("exp_id")
    return documents.join(bad, "exp_id", "left_anti"), documents.join(bad, "exp_id", "left_semi")


def marked(registry: DataFrame, docs: DataFrame) -> DataFrame:
    """registry with the rows of docs marked as out."""
    out = registry.join(docs.select("exp_id", F.lit(True).alias("__out")), "exp_id", "left")
    return out.withColumn("refluxed", F.coalesce("__out", "refluxed", F.lit(False))).drop("__out")


def on_session(registry: DataFrame, fresh: DataFrame, clusters_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The registry after a finished session: new rows in, active rows under the hard keys of new ones fused again, what
    became consolidated put in and its sources suspended, positives that a new negative contradicts in conflict. And the
    conflict pairs. Clusters never cross hard keys, so rows under other keys are as fused as before.

    With clusters_path, the state of increments.extend(), only the components that fresh rows belong to are looked at."""
    rows = materialise(govern.insert_if_absent(registry, fresh).select(*registry.columns), "registry")
    if clusters_path:
        increments.extend(registry.sparkSession, clusters_path, rows)
        clustered = increments.touched(registry.sparkSession, clusters_path, consolidate.pending(rows), consolidate.pending(fresh))
    else:
        touched = fusion.hard_key(fresh).select(*increments.KEY).distinct()
        clustered = fusion.clusters(fusion.hard_key(consolidate.pending(rows)).join(touched, increments.KEY, "left_semi").select(*rows.columns))
    made, members = consolidate.merged(fusion.weigh(clustered))
    settled = consolidate.fold_in(rows, made.filter("should_reflux"), members)
    shape = lambda d: d.select(F.col("exp_id").alias("id"), "text", "service", "cves")
    pairs = materialise(govern.conflicts(shape(fresh.filter("layer = 'PROCEDURAL_NEG'")), shape(rows.filter("layer = 'PROCEDURAL_POS' AND lifecycle = 'active'"))).filter("recommends AND band = 'conflict'"), "pairs")
    hit = pairs.select(F.col("b").alias("exp_id"), F.lit(True).alias("__hit")).distinct()
    after = settled.join(hit, "exp_id", "left").withColumn("lifecycle", F.when(F.col("__hit"), "conflicted").otherwise(F.col("lifecycle")))
    return after.select(*registry.columns), pairs
