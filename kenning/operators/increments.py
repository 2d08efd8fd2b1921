"""Clusters kept up to date session by session, without looking at what a session doesn't touch.

The state is a table in versions that only grows. Its rows are of three kinds:

* `label`: a signature and the root (least signature) of its component when it came;
* `term`: a CVE or none and a family or none within a hard key, and a signature that stands for its members;
* `root`: a former root and the root of its component since a batch (the newest row counts).

A batch brings signatures. Those that are new are joined to their terms, and a new term to the terms it is compatible
with, as in fusion.component_edges(): by stars, never by pairs. The ends of these edges are replaced by their present
roots, so components of what is already joined are nodes, and only roots that change are written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kenning.operators import fusion, registry
from kenning.operators.graph import connected_components
from kenning.plans.store import materialise, small

KEY = ["key_layer", "key_service", "key_sub"]
STATE = "kind string, key_layer string, key_service string, key_sub string, cve string, family string, signature long, root long, batch long"


def _rows(df: DataFrame, kind: str, batch: int) -> DataFrame:
    have = {"kind": F.lit(kind), "batch": F.lit(batch).cast("long")}
    names = [f.split() for f in STATE.split(", ")]
    return df.select(*[(have[n] if n in have else F.col(n) if n in df.columns else F.lit(None).cast(t)).cast(t).alias(n) for n, t in names])


def present(state: DataFrame, signatures: DataFrame) -> DataFrame:
    """signature, root of those of the signatures that the state has, by their present roots."""
    labels = state.filter("kind = 'label'").select("signature", "root").join(small(signatures), "signature", "left_semi")
    moved = state.filter("kind = 'root'").groupBy(F.col("signature").alias("root")).agg(F.max_by("root", "batch").alias("now"))
    return labels.join(small(moved), "root", "left").select("signature", F.coalesce("now", "root").alias("root"))


def _edges(terms: DataFrame, known: DataFrame) -> DataFrame:
    """a, b: stars of new signatures and links of new terms. terms: KEY, cve, family, signature of the new signatures;
    known: KEY, cve, family, root of the terms under the hard keys of these."""
    term = [*KEY, "cve", "family"]
    least = terms.groupBy(*term).agg(F.min("signature").alias("least"))
    at = materialise(least.join(known, term, "left").select(*term, F.coalesce("root", "least").alias("root"), F.col("root").isNull().alias("new")), "terms")
    stars = terms.join(at, term).select(F.col("signature").alias("a"), F.col("root").alias("b"))
    fresh, old = at.filter("new").select(*term, "root"), known.select(*term, "root")

    def link(left: Column, right: Column, on: list[str]) -> DataFrame:
        """New members of left with one of right, and all of left with one of a right that has had none."""
        both = fresh.filter(right).unionByName(old.filter(right)).groupBy(*on).agg(F.min("root").alias("b"))
        first = fresh.filter(right).groupBy(*on).agg(F.min("root").alias("b")).join(old.filter(right).select(*on).distinct(), on, "left_anti")
        return fresh.filter(left).join(both, on).select(F.col("root").alias("a"), "b").union(old.filter(left).join(first, on).select(F.col("root").alias("a"), "b"))

    some, none, any_family = F.col("cve") != "", F.col("cve") == "", F.col("family") == ""
    parts = [
        link(some, some & any_family, [*KEY, "cve"]),
        link(none, none & any_family, KEY),
        link(some, none, [*KEY, "family"]),
        link(some, none & any_family, KEY),
        link(none, some & any_family, KEY),
        link(some & any_family, none, KEY),
    ]
    for part in parts:
        stars = stars.union(part)
    return stars.filter("a <> b").distinct()


def changes(state: DataFrame, nodes: DataFrame, batch: int) -> DataFrame:
    """The rows that a batch of signatures (KEY, family, cves, signature) adds to the state."""
    new = materialise(nodes.join(state.filter("kind = 'label'").select("signature"), "signature", "left_anti"), "new")
    if not new.limit(1).count():
        return new.sparkSession.createDataFrame([], STATE)
    terms = new.select(*KEY, "family", "signature", F.explode(F.when(F.size("cves") > 0, F.col("cves")).otherwise(F.array(F.lit("")))).alias("cve"))
    mine = state.filter("kind = 'term'").select(*KEY, "cve", "family", "root")
    known = materialise(mine.join(small(new.select(*KEY).distinct()), KEY, "left_semi"), "known")
    edges = materialise(_edges(terms, known), "edges")
    ends = edges.select(F.col("a").alias("signature")).union(edges.select("b")).distinct()
    now = materialise(present(state, ends), "ends")
    to = lambda side: small(now.select(F.col("signature").alias(side), F.col("root").alias(f"r{side}")))
    lifted = edges.join(to("a"), "a", "left").join(to("b"), "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    joined = materialise(connected_components(lifted), "joined")
    found = joined.select(F.col("node").alias("signature"), F.col("root").alias("up"))
    labels = new.select("signature").join(found, "signature", "left").select("signature", F.coalesce("up", "signature").alias("root"))
    changed = materialise(now.select(F.col("root").alias("signature")).distinct().join(found, "signature").filter("up <> signature"), "changed")
    # What pointed at a root that moves is moved with it.
    pointing = state.filter("kind = 'root'").groupBy("signature").agg(F.max_by("root", "batch").alias("was"))
    follow = pointing.join(small(changed.select(F.col("signature").alias("was"), "up")), "was").select("signature", F.col("up").alias("root"))
    moved = changed.select("signature", F.col("up").alias("root")).unionByName(follow)
    made = terms.groupBy(*KEY, "cve", "family").agg(F.min("signature").alias("root")).join(known.drop("root"), [*KEY, "cve", "family"], "left_anti")
    return materialise(_rows(labels, "label", batch).unionByName(_rows(moved, "root", batch)).unionByName(_rows(made, "term", batch)), "changes")


def keyed(experiences: DataFrame) -> DataFrame:
    """experiences with their hard key and signature."""
    rows = fusion.hard_key(experiences).withColumn("cve_key", F.array_join(F.array_sort("cves"), ","))
    return rows.withColumn("signature", F.xxhash64(*KEY, "family", "cve_key"))


def extend(spark: SparkSession, path: str, experiences: DataFrame) -> int:
    """Take the signatures of these rows into the state below path; its version. Rows that are known change nothing."""
    nodes = materialise(fusion.signatures(keyed(experiences)), "signatures")
    if not registry.versions(spark, path):
        try:
            registry.commit(spark.createDataFrame([], STATE), path, 0)
        except registry.Conflict:
            pass  # another writer has begun
    return registry.update(spark, path, lambda state: changes(state, nodes, registry.versions(spark, path)[-1] + 1), append=True)


def clusters(spark: SparkSession, path: str, experiences: DataFrame) -> DataFrame:
    """experiences (all of which the state knows) with their hard key, signature and cluster_id."""
    rows = keyed(experiences)
    state = registry.current(spark, path)
    roots = present(state, rows.select("signature").distinct())
    return rows.join(roots.withColumnRenamed("root", "cluster_id"), "signature")


def touched(spark: SparkSession, path: str, rows: DataFrame, fresh: DataFrame) -> DataFrame:
    """Of rows, with hard key, signature and cluster_id, those whose component holds a row of fresh."""
    roots = clusters(spark, path, fresh).select("cluster_id").distinct()
    return clusters(spark, path, rows).join(small(materialise(roots, "touched")), "cluster_id", "left_semi")
