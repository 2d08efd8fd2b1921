"""Objects of STIX bundles in full: one projection per kind, parents, tactics of techniques, counts by domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_REFERENCE = "array<struct<source_name:string,external_id:string,url:string>>"
_TEXTS = ["type", "id", "name", "description", "created", "modified", "source_ref", "target_ref", "relationship_type", "x_mitre_shortname", "x_mitre_parent_technique_ref", "x_mitre_deprecated_parent_technique_ref", "x_mitre_version", "first_seen", "last_seen"]
_LISTS = ["aliases", "x_mitre_aliases", "x_mitre_platforms", "x_mitre_permissions_required", "x_mitre_defense_bypassed", "labels"]
OBJECT = ",".join([f"{n}:string" for n in _TEXTS] + [f"{n}:array<string>" for n in _LISTS] + ["x_mitre_is_subtechnique:boolean", f"external_references:{_REFERENCE}", "kill_chain_phases:array<struct<kill_chain_name:string,phase_name:string>>"])

# Kinds of objects, and what is read of each beyond the common columns.
KINDS = {
    "tactics": ["x-mitre-tactic"],
    "techniques": ["attack-pattern"],
    "groups": ["intrusion-set"],
    "software": ["malware", "tool"],
    "campaigns": ["campaign"],
    "mitigations": ["course-of-action"],
    "datasources": ["x-mitre-data-source"],
}
EXTRA = {
    "tactics": {"short_name": "x_mitre_shortname"},
    "techniques": {"platforms": "x_mitre_platforms", "permissions_required": "x_mitre_permissions_required", "defense_bypassed": "x_mitre_defense_bypassed", "is_subtechnique": "x_mitre_is_subtechnique", "parent_ref": "parent_ref", "tactic_names": "tactic_names"},
    "groups": {"aliases": "aliases"},
    "software": {"aliases": "x_mitre_aliases", "platforms": "x_mitre_platforms", "software_type": "type"},
    "campaigns": {"aliases": "aliases", "first_seen": "first_seen", "last_seen": "last_seen"},
    "mitigations": {},
    "datasources": {"platforms": "x_mitre_platforms"},
}


def objects(bundles: DataFrame, column: str = "value") -> DataFrame:
    """domain, raw and typed columns of every object of the bundles (domain, JSON text), with external id and url of the first mitre-attack reference."""
    raw = bundles.select("domain", F.explode(F.from_json(column, "struct<objects:array<string>>")["objects"]).alias("raw"))
    o = raw.select("domain", "raw", F.from_json("raw", f"struct<{OBJECT}>").alias("o")).select("domain", "raw", "o.*")
    own = F.get(F.filter("external_references", lambda r: r["source_name"] == "mitre-attack"), F.lit(0))
    chain = F.transform(F.filter("kill_chain_phases", lambda p: p["kill_chain_name"].contains("mitre")), lambda p: p["phase_name"])
    parent = F.when(F.col("x_mitre_is_subtechnique"), F.coalesce("x_mitre_deprecated_parent_technique_ref", "x_mitre_parent_technique_ref"))
    return o.withColumns({"external_id": own["external_id"], "url": own["url"], "tactic_names": chain, "parent_ref": parent})


def of_kind(found: DataFrame, kind: str) -> DataFrame:
    """Rows of one kind that have an external id: the common columns and the kind's own."""
    common = {"id": "external_id", "stix_id": "id", "domain": "domain", "name": "name", "description": "description", "url": "url"}
    rows = found.filter(F.col("type").isin(KINDS[kind]) & F.col("external_id").isNotNull())
    times = [F.try_to_timestamp(F.col(c)).alias(c) for c in ("created", "modified")]
    return rows.select(*[F.col(c).alias(n) for n, c in (common | EXTRA[kind]).items()], *times)


def with_parents(techniques: DataFrame) -> DataFrame:
    """Techniques with parent_id, the external id of the parent they refer to in their domain; null without one."""
    parents = techniques.select("domain", F.col("stix_id").alias("parent_ref"), F.col("id").alias("parent_id"))
    return techniques.join(parents, ["domain", "parent_ref"], "left").drop("parent_ref")


def technique_tactics(techniques: DataFrame, tactics: DataFrame) -> DataFrame:
    """technique id, tactic id by the kill-chain phases of a technique."""
    phases = techniques.select("domain", F.col("id").alias("technique_id"), F.explode("tactic_names").alias("short_name"))
    return phases.join(tactics.select("domain", "short_name", F.col("id").alias("tactic_id")), ["domain", "short_name"]).select("domain", "technique_id", "tactic_id")


def summary(found: DataFrame) -> DataFrame:
    """domain, type, n: objects by domain and type, with a total per domain and of all (nulls)."""
    return found.rollup("domain", "type").agg(F.count(F.lit(1)).alias("n"))


def versions(found: DataFrame) -> DataFrame:
    """domain, version of the bundle's collection."""
    return found.filter("type = 'x-mitre-collection'").groupBy("domain").agg(F.max("x_mitre_version").alias("version"))


def mentioning(found: DataFrame, word: Column) -> DataFrame:
    """Objects whose JSON holds the word, in any case."""
    return found.filter(F.lower("raw").contains(F.lower(word)))
