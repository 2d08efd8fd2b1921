"""From the members of clusters to consolidated rows in the registry: merged by layer, named, their sources suspended."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kenning.operators import fusion, merge
from kenning.plans.store import materialise

#: What a row's content (JSON) may hold; what a row without content says is its text.
CONTENT = "struct<tool_name:string,command_template:string,preconditions:array<string>,success_indicators:array<string>,decision_rule:struct<`IF`:string,`THEN`:array<string>,`NOT`:string,next:string>,rule_source:string,facts:array<struct<key:string,value:string>>,key_lessons:array<string>,core_insight:string,applicable_conditions:array<string>,target_version:string,cve_context:struct<attempted:array<string>,unexplored:array<string>,exploitation_results:map<string,string>,known_ineffective_vectors:array<string>>>"
#: Facts and lessons that a consolidated row's content lists, heaviest first; `n_facts` tells how many there are.
LISTED = 100


def _members(weighted: DataFrame) -> DataFrame:
    """Members of clusters that may be fused, with their content as `c` and a text that is never null."""
    fusable = fusion.rollup(weighted).filter("fusable").select("cluster_id")
    raw = F.col("content") if "content" in weighted.columns else F.lit(None).cast("string")
    read = weighted.join(fusable, "cluster_id", "left_semi").withColumn("c", F.from_json(raw, CONTENT)).withColumn("text", F.coalesce("text", F.lit("")))
    return materialise(read, "fusable")


def _items(members: DataFrame, items: Column) -> DataFrame:
    return members.select("cluster_id", "exp_id", "weight", F.explode(items).alias("item")).filter("item <> ''")


def _or_text(items: Column) -> Column:
    return F.when(F.size(items) > 0, items).otherwise(F.array("text"))


def _ranked(rows: DataFrame, value: Column, out: str) -> DataFrame:
    """cluster_id, the LISTED first by rank as an array, and how many there are."""
    n = rows.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    top = rows.filter(F.col("rank") <= LISTED).groupBy("cluster_id").agg(F.sort_array(F.collect_list(F.struct("rank", value.alias("x")))).alias("__x"))
    return n.join(top, "cluster_id").select("cluster_id", F.transform("__x", lambda x: x["x"]).alias(out), F.col("n").alias(f"n_{out}"))


def _positive(m: DataFrame) -> DataFrame:
    rows = m.select("cluster_id", "exp_id", "weight", F.coalesce("c.command_template", "text").alias("template"), F.coalesce("c.tool_name", F.lit("")).alias("tool_name"), "phase")
    made = merge.positive(_items(m, F.col("c.preconditions")), _items(m, F.col("c.success_indicators")), rows)
    return made.select("cluster_id", F.col("template").alias("text"), F.to_json(F.struct(F.col("template").alias("command_template"), "tool_name", "phase", "preconditions", "indicators")).alias("content"))


def _negative(m: DataFrame) -> DataFrame:
    rule = F.col("c.decision_rule")
    rows = m.select("cluster_id", "exp_id", "weight", F.coalesce(rule["IF"], F.lit("")).alias("if_text"), F.coalesce(rule["next"], F.lit("")).alias("next_actions"), F.coalesce("c.rule_source", F.lit("rule")).alias("source"), "dimension", "sub_dimension")
    avoid = m.select("cluster_id", "exp_id", "weight", F.coalesce(F.nullif(rule["NOT"], F.lit("")), "text").alias("item")).filter("item <> ''")
    then = _items(m, F.coalesce(rule["THEN"], F.array().cast("array<string>")))
    made = merge.negative(_items(m, F.coalesce(rule["THEN"], F.array().cast("array<string>"))), avoid, rows)
    told = F.struct("if_text", "then_actions", "avoid", "next_actions", "alternatives", "sources", "dimension", "sub_dimension")
    return made.select("cluster_id", F.concat_ws(" | ", F.nullif("then_actions", F.lit("")), "avoid").alias("text"), F.to_json(told).alias("content"))


def _factual(m: DataFrame) -> DataFrame:
    own = F.when(F.size("c.facts") > 0, F.col("c.facts")).otherwise(F.array(F.struct(F.lit("text").alias("key"), F.col("text").alias("value"))))
    rows = m.select("cluster_id", "exp_id", "weight", F.explode(own).alias("f")).select("cluster_id", "exp_id", "weight", "f.key", "f.value")
    made = _ranked(merge.factual(rows), F.struct("key", "value", "n", "support"), "facts")
    return made.select("cluster_id", F.array_join(F.transform("facts", lambda f: F.concat_ws("=", f["key"], f["value"])), " | ").alias("text"), F.to_json(F.struct("facts", "n_facts")).alias("content"))


def _model_facts(m: DataFrame) -> DataFrame:
    """What a model wrote of CVEs: a vote by CVE, and the sets of what was attempted, is unexplored, or didn't work."""
    base = ["cluster_id", "exp_id", "weight"]
    told = F.col("c.cve_context")
    sets = [m.select(*base, F.lit(kind).alias("kind"), F.explode(told[field]).alias("item")) for kind, field in (("attempted", "attempted"), ("unexplored", "unexplored"), ("vector", "known_ineffective_vectors"))]
    found = merge.cve_sets(sets[0].unionByName(sets[1]).unionByName(sets[2]))
    results = m.select(*base, F.explode(told["exploitation_results"]).alias("cve", "status"))
    shares = merge.vote_breakdown(results).groupBy("cluster_id", "cve").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "share")))).alias("vote_breakdown"))
    votes = fusion.status_vote(results).join(shares, ["cluster_id", "cve"])
    told_of = F.struct(F.col("label").alias("consensus_status"), F.col("winner").alias("consensus_category"), F.round("share", 4).alias("confidence"), "vote_breakdown", F.col("evidence").alias("evidence_count"))
    heaviest = Window.partitionBy("cluster_id").orderBy(F.desc("evidence"), "cve")
    listed = votes.withColumn("rank", F.row_number().over(heaviest)).filter(F.col("rank") <= LISTED).groupBy("cluster_id").agg(F.map_from_entries(F.collect_list(F.struct("cve", told_of.alias("told")))).alias("cve_exploitation_map"))
    out = merge.dominant(m.withColumn("target_version", F.coalesce("c.target_version", F.lit(""))), ["target_version"]).join(listed, "cluster_id", "left")
    for kind, item in (("attempted", F.col("item")), ("unexplored", F.col("item")), ("vector", F.struct(F.col("item").alias("path"), F.col("n").alias("verified_count"), F.col("support").alias("total_weight")))):
        out = out.join(_ranked(found.filter(F.col("kind") == kind), item, kind), "cluster_id", "left")
    named = F.struct("target_version", "cve_exploitation_map", F.struct("attempted", "n_attempted", "unexplored", "n_unexplored").alias("cve_context"), F.col("vector").alias("known_ineffective_endpoints"), F.col("n_vector").alias("n_endpoints"))
    said = F.array_join(F.array_sort(F.transform(F.map_entries("cve_exploitation_map"), lambda e: F.concat_ws("=", e["key"], e["value"]["consensus_status"]))), " | ")
    return out.select("cluster_id", F.coalesce(said, F.array_join("attempted", " | "), F.lit("")).alias("text"), F.to_json(named).alias("content"))


def _metacognitive(m: DataFrame) -> DataFrame:
    made = _ranked(merge.metacognitive(_items(m, _or_text(F.col("c.key_lessons")))), F.struct("lesson", "n", "weight"), "lessons")
    return made.select("cluster_id", F.array_join(F.transform("lessons", lambda x: x["lesson"]), " | ").alias("text"), F.to_json(F.struct("lessons", "n_lessons")).alias("content"))


def _conceptual(m: DataFrame) -> DataFrame:
    said = m.select("cluster_id", "exp_id", "weight", F.coalesce(F.nullif("c.core_insight", F.lit("")), "text").alias("item"))
    made = merge.conceptual(said, _items(m, F.coalesce("c.applicable_conditions", F.array().cast("array<string>"))))
    return made.select("cluster_id", F.col("insight").alias("text"), F.to_json(F.struct("insight", "supplements", "conditions")).alias("content"))


BY_LAYER = {"PROCEDURAL_POS": _positive, "PROCEDURAL_NEG": _negative, "FACTUAL": _factual, "METACOGNITIVE": _metacognitive, "CONCEPTUAL": _conceptual}


def merged(weighted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Consolidated rows of the clusters of weighted members that may be fused, and those members (cluster_id, exp_id).

    A row has its cluster's name and id, what its members say by layer as text and content, their CVEs, and what
    calibration makes of them: confidence, maturity, lifecycle, sessions, and whether it is to leave for a store.
    """
    members = _members(weighted)
    by_model = F.coalesce(F.col("key_sub") == "FACTUAL::LLM", F.lit(False))
    parts = [f(members.filter((F.col("key_layer") == layer) & ~by_model)) for layer, f in BY_LAYER.items()] + [_model_facts(members.filter(by_model))]
    said = parts[0]
    for p in parts[1:]:
        said = said.unionByName(p)
    roll = fusion.rollup(members).withColumn("cves", F.filter(F.split("cve_union", ","), lambda c: c != ""))
    heads = members.groupBy("cluster_id").agg(F.max_by(F.struct("dimension", "sub_dimension", "phase"), F.struct("weight", -F.col("exp_id"))).alias("h"), F.max("max_turn").alias("max_turn"))
    told = fusion.calibrate(members).drop("n_sessions", "n_members", "key_layer")
    all_ = roll.join(said, "cluster_id").join(heads, "cluster_id").join(told, "cluster_id").join(fusion.outcome_majority(members), "cluster_id")
    name = fusion.cluster_name(F.col("key_layer"), F.col("key_service"), F.col("key_sub"), F.col("version"), F.col("cves"))
    rows = merge.record(all_.withColumns({"cluster": F.col("cluster_id"), "cluster_id": name, "layer": F.col("key_layer"), "service": F.col("key_service")})).withColumnRenamed("exp_id", "name")
    made = rows.select(
        F.xxhash64("cluster_id", "cluster").alias("exp_id"), "name", F.col("cluster_id").alias("cluster_name"), F.col("cluster").alias("cluster_id"), "layer", "service", "version", "cves", "session_id", "tags", "text", "content",
        F.round("p_fused", 4).alias("confidence"), "p_fused", F.col("majority").alias("outcome"), F.col("maturity_after").alias("maturity"), "lifecycle", F.lit(0).alias("age_days"), "max_turn",
        "h.dimension", "h.sub_dimension", "h.phase", F.lit(False).alias("refluxed"), "should_reflux", "n_members", "n_sessions", "contradiction",
    )
    return materialise(made, "merged"), members.select("cluster_id", "exp_id")


def fold_in(registry: DataFrame, made: DataFrame, members: DataFrame) -> DataFrame:
    """The registry with the consolidated rows that are new, and their sources suspended and pointing at them.

    Columns stay as they are but for `merged_into`, which is added if missing; what a consolidated row lacks is null.
    """
    rows = registry if "merged_into" in registry.columns else registry.withColumn("merged_into", F.lit(None).cast("long"))
    new = made.join(registry.select("exp_id"), "exp_id", "left_anti")
    target = members.join(new.select("cluster_id", F.col("exp_id").alias("__to")), "cluster_id").groupBy("exp_id").agg(F.min("__to").alias("__to"))
    after = rows.join(target, "exp_id", "left").withColumns({"merged_into": F.coalesce("merged_into", "__to"), "lifecycle": F.when(F.col("__to").isNotNull() & (F.col("lifecycle") == "active"), "suspended").otherwise(F.col("lifecycle"))})
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in new.columns and f.name != "merged_into" else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
    return after.select(*rows.columns).unionByName(new.select(*fields))


def pending(registry: DataFrame) -> DataFrame:
    """Rows that fusion takes: active and not yet consolidated."""
    return registry.filter("lifecycle = 'active' AND maturity IN ('raw', 'validated')")


def consolidate(registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The registry after fusing what is pending, and the consolidated rows."""
    made, members = merged(fusion.weigh(fusion.clusters(pending(registry))))
    return fold_in(registry, made, members), made


def lineage(registry: DataFrame) -> DataFrame:
    """exp_id, source_id, place: the sources of each consolidated row, a row each (how many there are has no bound)."""
    place = F.row_number().over(Window.partitionBy("merged_into").orderBy("exp_id"))
    return registry.filter("merged_into IS NOT NULL").select(F.col("merged_into").alias("exp_id"), F.col("exp_id").alias("source_id"), place.alias("place"))


#: Type of each column that a registry of consolidated rows may have besides those of its sources.
EXTRA = {"name": "string", "cluster_name": "string", "tags": "array<string>", "content": "string", "p_fused": "double", "n_sessions": "long", "n_members": "long", "merged_into": "long", "refluxed": "boolean"}


def widened(registry: DataFrame) -> DataFrame:
    """registry with the columns that tell what its consolidated rows are made of, null where they are missing."""
    return registry.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in EXTRA.items() if name not in registry.columns])
