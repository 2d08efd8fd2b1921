"""The batch from logs to knowledge, stage by stage, with a state table."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kenning.functions.text import cves
from kenning.operators import annotate, consolidate, distil, fusion, registry
from kenning.plans.store import materialise
from kenning.sources import logs


def run_stages(spark: SparkSession, stages: list[tuple[str, Callable[[dict[str, DataFrame]], DataFrame]]], given: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Run stages in order, each over what is there so far; after a failure the rest is skipped. Tables and the state."""
    tables, state, failed = dict(given), [], ""
    for name, stage in stages:
        began = time.time()
        if failed:
            state.append((name, "skipped", f"after {failed}", 0.0))
            continue
        try:
            tables[name] = materialise(stage(tables), name)
            state.append((name, "done", "", time.time() - began))
        except Exception as error:  # the state table is how a stage's failure is told
            failed = name
            state.append((name, "failed", str(error)[:500], time.time() - began))
    return tables, spark.createDataFrame(state, "stage string, status string, message string, seconds double")


def experiences(tables: dict[str, DataFrame]) -> DataFrame:
    """Positive and negative rows in the shape that fusion takes."""
    a = tables["annotated"]
    outcome = annotate.session_outcome(a).select("session_id", F.col("session_outcome").alias("outcome"))
    told = F.col("rule.next_actions")
    rule = F.struct(F.col("rule.if").alias("IF"), F.col("rule.then").alias("THEN"), F.col("rule.not").alias("NOT"), F.array_join(F.transform(told, lambda x: x["command"]), " ; ").alias("next"))
    pos = distil.positives(a, annotate.session_outcome(a)).select("session_id", "turn_index", "phase", "confidence", F.lit("PROCEDURAL_POS").alias("layer"), F.col("template").alias("text"), F.lit("").alias("dimension"), F.lit("").alias("sub_dimension"), F.to_json(F.struct("tool_name", F.col("template").alias("command_template"), "preconditions", F.col("indicators").alias("success_indicators"))).alias("content"))
    neg = distil.negatives(a).select("session_id", "turn_index", "phase", "confidence", F.lit("PROCEDURAL_NEG").alias("layer"), F.col("failed_command").alias("text"), "dimension", "sub_dimension", F.to_json(F.struct("tool_name", rule.alias("decision_rule"), F.lit("rule").alias("rule_source"))).alias("content"))
    rows = pos.unionByName(neg).join(outcome, "session_id")
    return rows.select(
        F.xxhash64("session_id", "layer", "turn_index", "text").alias("exp_id"), "*", F.coalesce(F.nullif(F.regexp_extract("text", r"https?://([\w.-]+)", 1), F.lit("")), F.lit("")).alias("service"),
        cves(F.col("text")).alias("cves"), F.lit("").alias("version"), F.lit("raw").alias("maturity"), F.lit(0).alias("age_days"), F.lit("active").alias("lifecycle"), F.col("turn_index").cast("int").alias("max_turn"),
    )


STAGES = [
    ("annotated", lambda t: annotate.annotate(t["events"].withColumn("event_id", F.xxhash64("source_file", "turn_index", "slot")))),
    ("facts", lambda t: distil.session_facts(t["annotated"])),
    ("experiences", experiences),
    ("members", lambda t: fusion.weigh(fusion.clusters(t["experiences"]))),
    ("consolidated", lambda t: consolidate.merged(t["members"])[0]),
    ("registry", lambda t: consolidate.fold_in(consolidate.widened(t["experiences"]), t["consolidated"], t["members"])),
]


def run(spark: SparkSession, log_path: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """All stages over a folder of logs."""
    return run_stages(spark, STAGES, {"events": logs.read(spark, log_path)})


def store(spark: SparkSession, tables: dict[str, DataFrame], path: str) -> int:
    """Commit the batch's registry: as the first version, or its new rows put into what is there; the version."""
    if not registry.versions(spark, path):
        return registry.commit(tables["registry"], path, 0)
    return registry.update(spark, path, lambda rows: registry.merge(rows, tables["registry"].withColumn("op", F.lit("insert"))))


def gates(tables: dict[str, DataFrame]) -> DataFrame:
    """gate, ok: there are sessions, there are experiences, not every cause is a fallback."""
    a, e = tables["annotated"], tables["experiences"]
    rows = a.agg((F.count_distinct("session_id") > 0).alias("has_sessions"), F.coalesce(F.bool_or(F.col("rule").isNotNull()) | (F.count("cause") == 0), F.lit(True)).alias("not_only_fallback"))
    more = e.agg((F.count(F.lit(1)) > 0).alias("has_experiences"))
    return rows.join(F.broadcast(more)).select(F.explode(F.map_from_arrays(F.array(F.lit("has_sessions"), F.lit("not_only_fallback"), F.lit("has_experiences")), F.array("has_sessions", "not_only_fallback", "has_experiences"))).alias("gate", "ok"))
