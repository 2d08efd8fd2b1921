"""What a run reports of itself: clusters, lifecycle counts, smoke checks, stages, an audit trail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kenning.operators.fusion import heaviest

STATES = ["active", "archived", "suspended", "conflicted"]


def cluster_report(weighted: DataFrame, by: Column | None = None) -> DataFrame:
    """A row per cluster: key, size, heaviest member (or that with most of `by`), total weight, and its members with their weights, heaviest first."""
    by = heaviest() if by is None else by
    members = F.sort_array(F.collect_list(F.struct((-F.col("weight")).alias("o"), "exp_id", "weight")))
    per = weighted.groupBy("cluster_id", "key_layer", "key_service", "key_sub").agg(F.count(F.lit(1)).alias("source_count"), F.round(F.sum("weight"), 6).alias("total_weight"), F.max_by("exp_id", by).alias("dominant_id"), members.alias("m"))
    slim = F.transform("m", lambda x: F.struct(x["exp_id"].alias("exp_id"), x["weight"].alias("weight")))
    return per.withColumn("weights", slim).drop("m")


def lifecycle_summary(registry: DataFrame) -> DataFrame:
    """One row: n_rows, a count for each state, and rows that went into another."""
    return registry.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col("lifecycle") == s).alias(f"n_{s}") for s in STATES], F.count("merged_into").alias("n_merged"))


def hollow(keys: Column, values: Column, cves: Column) -> Column:
    """Whether facts tell nothing that lasts: no CVE, and no value under a key of versions or CVEs."""
    told = F.exists(F.arrays_zip(keys.alias("k"), values.alias("v")), lambda f: F.lower(f["k"]).rlike("version|cve") & (F.coalesce(F.trim(f["v"]), F.lit("")) != ""))
    return ~F.coalesce(told, F.lit(False)) & (F.size(F.filter(F.coalesce(cves, F.array().cast("array<string>")), lambda c: F.trim(c) != "")) == 0)


def smoke(experiences: DataFrame, clustered: DataFrame) -> DataFrame:
    """check, ok: positives are there, negatives fuse, hollow facts (column `is_hollow`) stay out of clusters, and
    clustering doesn't split negatives finer than their raw sub-dimensions."""
    negative, no, none = F.col("layer") == "PROCEDURAL_NEG", F.lit(False), F.lit(None).cast("string")
    raw = experiences.select((F.col("layer") == "PROCEDURAL_POS").alias("positive"), F.when(negative, F.col("sub_dimension")).alias("raw_sub"), none.alias("sub"), no.alias("fused"), no.alias("is_hollow"))
    of = Window.partitionBy("cluster_id")
    made = clustered.select(no.alias("positive"), none.alias("raw_sub"), F.when(negative, F.col("key_sub")).alias("sub"), (negative & (F.count(F.lit(1)).over(of) > 1)).alias("fused"), "is_hollow")
    n = raw.unionByName(made).agg(F.count_if("positive").alias("p"), F.count_if("fused").alias("f"), F.count_if("is_hollow").alias("h"), F.count_distinct("raw_sub").alias("r"), F.count_distinct("sub").alias("s"))
    checks = {"has_positives": F.col("p") > 0, "negatives_fuse": F.col("f") > 0, "no_hollow_facts": F.col("h") == 0, "no_finer_than_raw": F.col("s") <= F.col("r")}
    return n.select(F.explode(F.create_map(*[x for name, ok in checks.items() for x in (F.lit(name), ok)])).alias("check", "ok"))


def sample_first(rows: DataFrame, first: Column, name: str, n: int) -> DataFrame:
    """The n rows a quick look takes: those asked for first, then by name."""
    return rows.orderBy(F.desc(first), name).limit(n)


def correlation(session_a: Column, session_b: Column) -> Column:
    """How far two rows depend on each other: 0.8 within a session, else 0."""
    return F.when((session_a != "") & (session_a == session_b), 0.8).otherwise(0.0)


def stage_table(stages: DataFrame, state: DataFrame) -> DataFrame:
    """Every stage in order with its status, `pending` where it hasn't run."""
    return stages.join(state.select("stage", "status", "message"), "stage", "left").withColumn("status", F.coalesce("status", F.lit("pending"))).orderBy("place")


def audit(changes: DataFrame, path: str, dry_run: bool = False) -> DataFrame:
    """action, n of the changes; unless it is a dry run, the changes are appended to the trail and the summary replaced."""
    summary = changes.groupBy("action").agg(F.count(F.lit(1)).alias("n"))
    if not dry_run:
        changes.write.mode("append").parquet(f"{path}/trail")
        summary.write.mode("overwrite").parquet(f"{path}/summary")
    return summary


def event_prompt(tool: Column, args: Column, stdout: Column, stderr: Column) -> Column:
    """What a model is shown of one event: its call and the starts of its outputs."""
    cut = lambda v, n: F.nullif(F.substr(F.trim(v), F.lit(1), F.lit(n)), F.lit(""))
    return F.concat_ws("\n", F.concat(F.lit("tool: "), tool), F.concat(F.lit("args: "), cut(args, 400)), F.concat(F.lit("stdout: "), cut(stdout, 800)), F.concat(F.lit("stderr: "), cut(stderr, 500)))
