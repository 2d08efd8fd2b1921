"""Cross-session fusion: hard keys, similarity components, weights, votes, calibration and lifecycle.

The input is a frame of experiences (exp_id, layer, service, cves, version, session_id, confidence, outcome, maturity,
age_days, lifecycle, max_turn, dimension, sub_dimension, phase). Every step is a relation over it: clusters are rows of
(cluster_id, exp_id), never collected lists, so a hot service costs a larger shuffle partition at most where AQE can't
split it, and similarity is decided between signatures, of which a key has few however many rows it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kenning.functions import text as tx
from kenning.functions.text import neg_bucket, service_name, version_family
from kenning.operators.graph import connected_components
from kenning.plans.store import materialise

# Factors, rates and thresholds.
MATURITY_FACTOR = {"raw": 0.4, "validated": 0.7, "consolidated": 1.0}
OUTCOME_FACTOR = {"success": 1.5, "partial_success": 1.0, "possible_success": 1.0, "failure": 0.6, "unknown": 0.8}
DECAY = {"PROCEDURAL_NEG": 0.005, "PROCEDURAL_POS": 0.005, "FACTUAL": 0.003, "METACOGNITIVE": 0.001, "CONCEPTUAL": 0.001}
ENV_DECAY, FLOOR, LONE_WEIGHT, SUSPEND_BELOW, MOST_CVES = 0.010, 0.3, 0.65, 0.10, 5
RECON_PHASES = ["RECON_WEAPONIZATION", "ENV_PREPARATION"]


def lookup(column: Column, table: dict[str, float], default: float) -> Column:
    out = F
    for key, value in table.items():
        out = out.when(column == key, F.lit(value))
    return out.otherwise(F.lit(default))


def hard_key(df: DataFrame) -> DataFrame:
    """df with key_layer, key_service, key_sub and family: what members of a cluster must share. Facts that a model wrote
    (extraction_source, has_cve_context) and kinds of insight (pattern_type) stay apart if df has these columns."""
    has = lambda c, default: F.coalesce(F.col(c), F.lit(default)) if c in df.columns else F.lit(default)
    model = (F.lower(has("extraction_source", "")) == "llm") | has("has_cve_context", False)
    tier = F.when(F.upper(F.coalesce("phase", F.lit(""))).isin(RECON_PHASES), "RECON").otherwise("ACTION")
    sub = (
        F.when(F.col("layer") == "PROCEDURAL_NEG", F.concat(neg_bucket(F.col("sub_dimension"), F.col("dimension")), F.lit("::"), tier))
        .when(F.col("layer").startswith("FACTUAL"), F.when(model, "FACTUAL::LLM").otherwise("FACTUAL::RULE"))
        .when(F.col("layer") == "CONCEPTUAL", has("pattern_type", ""))
        .otherwise("")
    )
    return df.withColumns({"key_layer": F.when(F.col("layer").startswith("FACTUAL_"), "FACTUAL").otherwise(F.col("layer")), "key_service": service_name(F.col("service")), "key_sub": sub, "family": version_family(F.col("version"))})


def signatures(keyed: DataFrame) -> DataFrame:
    """Distinct (key, version family, CVE set) with an id: the nodes of the similarity graph."""
    cve_key = F.array_join(F.array_sort("cves"), ",")
    return keyed.select("key_layer", "key_service", "key_sub", "family", "cves", cve_key.alias("cve_key")).distinct().withColumn("signature", F.xxhash64("key_layer", "key_service", "key_sub", "family", "cve_key"))


def similarity_edges(nodes: DataFrame) -> DataFrame:
    """All pairs a, b of signatures that are compatible: versions equal or one unknown, CVE sets that meet or one empty.

    Candidates come from equi-joins only: pairs that share a CVE, and pairs with a member that has none. Where only the
    components matter, component_edges() has them without pairs.
    """
    key = ["key_layer", "key_service", "key_sub"]
    left = nodes.select(*key, F.col("family").alias("fa"), F.col("signature").alias("a"), F.col("cves").alias("ca"))
    right = nodes.select(*key, F.col("family").alias("fb"), F.col("signature").alias("b"), F.col("cves").alias("cb"))
    versions = (F.col("fa") == F.col("fb")) | (F.col("fa") == "") | (F.col("fb") == "")
    shared = left.withColumn("cve", F.explode("ca")).join(right.withColumn("cve", F.explode("cb")), [*key, "cve"]).filter(versions & (F.col("a") < F.col("b")))
    blank = left.filter(F.size("ca") == 0).join(right, key).filter(versions & (F.col("a") != F.col("b")))
    return shared.select("a", "b").union(blank.select(F.least("a", "b"), F.greatest("a", "b"))).distinct()


def component_edges(nodes: DataFrame) -> DataFrame:
    """a, b of signatures whose components are those of compatible ones: versions equal or one unknown, CVE sets that meet
    or one empty, within a key.

    Signatures are compatible through terms: a CVE or none, a family or none. Members of a term are joined by a star at
    its least signature, so there are as many edges as memberships and no pair of a group is ever built:

    * the same CVE (or none) and the same family: all compatible with each other;
    * of one CVE, those without a family are compatible with every family's: the least of each is joined to one of them;
    * those without CVEs are compatible with every CVE of their family, and without a family with all.
    """
    key = ["key_layer", "key_service", "key_sub"]
    terms = nodes.select(*key, "family", "signature", F.explode(F.when(F.size("cves") > 0, F.col("cves")).otherwise(F.array(F.lit("")))).alias("cve"))
    least = terms.groupBy(*key, "cve", "family").agg(F.min("signature").alias("root"))
    stars = terms.join(least, [*key, "cve", "family"]).select(F.col("signature").alias("a"), F.col("root").alias("b"))

    def link(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        """Each row of left with the least of right that agrees on `on`."""
        to = right.groupBy(*on).agg(F.min("root").alias("b"))
        return left.join(to, on).select(F.col("root").alias("a"), "b")

    some, none = least.filter("cve <> ''"), least.filter("cve = ''")
    parts = [
        link(some, some.filter("family = ''"), [*key, "cve"]),
        link(none, none.filter("family = ''"), key),
        link(some, none, [*key, "family"]),
        link(some, none.filter("family = ''"), key),
        link(none, some.filter("family = ''"), key),
        link(some.filter("family = ''"), none, key),
    ]
    for part in parts:
        stars = stars.union(part)
    return stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()


def clusters(experiences: DataFrame) -> DataFrame:
    """exp_id with its hard key and cluster_id (hash of the component's least signature); lifecycle active or empty only."""
    keyed = hard_key(experiences.filter("lifecycle is null or lifecycle in ('active', '')")).withColumn("cve_key", F.array_join(F.array_sort("cves"), ","))
    keyed = keyed.withColumn("signature", F.xxhash64("key_layer", "key_service", "key_sub", "family", "cve_key"))
    nodes = materialise(signatures(keyed), "signatures")
    roots = connected_components(component_edges(nodes))
    return keyed.join(roots, keyed["signature"] == roots["node"], "left").withColumn("cluster_id", F.coalesce("root", "signature")).drop("node", "root")


def cluster_name(layer: Column, service: Column, sub: Column, family: Column, cves: Column) -> Column:
    """A readable cluster id: slugs of its terms and eight digits of the MD5 of them as canonical JSON."""
    empty = F.lit("")

    def slug(text: Column, most: int, otherwise: str) -> Column:
        bare = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, empty)), "[^a-z0-9]+", "_"), "^_+|_+$", "")
        return F.when(bare == "", otherwise).otherwise(F.substring(bare, 1, most))

    listed = F.array_sort(F.array_distinct(F.transform(F.filter(cves, lambda c: F.trim(c) != ""), F.upper)))
    quoted = lambda text: F.concat(F.lit('"'), F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    low = lambda text: quoted(F.lower(F.trim(F.coalesce(text, empty))))
    canonical = F.concat(F.lit('{"cve_ids":['), F.array_join(F.transform(listed, quoted), ","), F.lit('],"layer":'), quoted(F.upper(layer)), F.lit(',"service":'), low(service), F.lit(',"sub_dim":'), low(sub), F.lit(',"version_family":'), low(family), F.lit("}"))
    first = F.coalesce(F.get(listed, F.lit(0)), F.lit("nocve"))
    return F.concat_ws("_", F.lit("SEC"), slug(layer, 20, "unknown"), slug(service, 24, "anysvc"), slug(sub, 24, "any"), slug(family, 18, "anyver"), slug(first, 20, "nocve"), F.substring(F.md5(canonical.cast("binary")), 1, 8))


def trigger_levels(keyed: DataFrame, edges: DataFrame) -> DataFrame:
    """key_layer, key_service, key_sub, level: L1+L2 where any two members of the key are linked by their CVEs, else L1.

    keyed: hard_key() rows with `signature`; edges: a, b of signatures. Two rows of one signature link as well.
    """
    key = ["key_layer", "key_service", "key_sub"]
    rows = keyed.groupBy(*key, "signature").agg(F.count(F.lit(1)).alias("n"))
    ends = edges.select(F.col("a").alias("signature")).distinct().withColumn("linked", F.lit(True))
    tagged = rows.join(ends, "signature", "left").groupBy(*key).agg(F.bool_or((F.col("n") > 1) | F.coalesce("linked", F.lit(False))).alias("linked"))
    return tagged.select(*key, F.when(F.col("linked"), "L1+L2").otherwise("L1").alias("level"))


def threshold(layer: Column) -> Column:
    """Members a cluster needs before it is fused."""
    return F.when(layer == "CONCEPTUAL", 2).otherwise(3)


def rollup(clustered: DataFrame) -> DataFrame:
    """Per cluster: size, sessions, CVE union, its version if there is only one, and whether it may be fused.

    CVEs are made distinct as rows before they are gathered.
    """
    key = ["cluster_id", "key_layer", "key_service", "key_sub"]
    union = clustered.select("cluster_id", F.explode("cves").alias("cve")).distinct().groupBy("cluster_id").agg(F.array_join(F.array_sort(F.collect_list("cve")), ",").alias("cve_union"))
    per = clustered.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_members"),
        F.count_distinct("session_id").alias("n_sessions"),
        F.when(F.count_distinct(F.nullif("family", F.lit(""))) == 1, F.max(F.nullif("family", F.lit("")))).otherwise("").alias("version"),
        (F.count(F.lit(1)) >= F.max(threshold(F.col("key_layer")))).alias("fusable"),
    )
    return per.join(union, "cluster_id", "left").withColumn("cve_union", F.coalesce("cve_union", F.lit(""))).select(*key, "n_members", "n_sessions", "cve_union", "version", "fusable")


def raw_weight() -> Column:
    """Quality x maturity x outcome x CVE coverage, at least 0.001, plus a ten-thousandth per turn."""
    coverage = F.least(F.size("cves"), F.lit(MOST_CVES)) / MOST_CVES * 0.3 + 0.7
    product = F.coalesce("confidence", F.lit(0.5)) * lookup(F.col("maturity"), MATURITY_FACTOR, 0.4) * lookup(F.col("outcome"), OUTCOME_FACTOR, 0.8) * coverage
    return F.greatest(product, F.lit(0.001)) + F.coalesce("max_turn", F.lit(0)) * 0.0001


def decay(layer: Column = None) -> Column:
    """exp(-rate x age in days); environment failures fade twice as fast; without an age 1."""
    layer = F.col("layer") if layer is None else layer
    rate = F.when((layer == "PROCEDURAL_NEG") & (F.col("dimension") == "ENV"), ENV_DECAY).otherwise(lookup(layer, DECAY, 0.003))
    return F.coalesce(F.exp(-rate * F.greatest(F.col("age_days"), F.lit(0))), F.lit(1.0))


def weigh(clustered: DataFrame) -> DataFrame:
    """clustered with w_raw, w_norm (min-max to FLOOR..1 in the cluster; LONE_WEIGHT if constant) and weight.

    The range of a cluster is an aggregate with partial sums, joined back, so a hot cluster never is one task's window.
    """
    raw = clustered.withColumn("w_raw", F.round(raw_weight(), 6))
    span = raw.groupBy("cluster_id").agg(F.min("w_raw").alias("__low"), F.max("w_raw").alias("__high"))
    low, high = F.col("__low"), F.col("__high")
    norm = F.when(high - low < 1e-9, LONE_WEIGHT).otherwise(FLOOR + (1 - FLOOR) * (F.col("w_raw") - low) / (high - low))
    out = raw.join(span, "cluster_id").withColumn("w_norm", norm)
    return out.withColumn("weight", F.greatest(F.round(F.col("w_norm") * decay(), 4), F.lit(FLOOR))).drop("__low", "__high")


def heaviest() -> Column:
    """What a cluster's first member has most of: weight; on a tie the least id."""
    return F.struct("weight", -F.col("exp_id"))


def scored() -> Column:
    """The same as one number, weight x 1e9 less the id: ids 100,000 apart make up for the last place of a weight."""
    return F.struct((F.col("weight") * 1e9 - F.col("exp_id")).alias("score"), (-F.col("exp_id")).alias("least"))


def dominant(weighted: DataFrame, by: Column | None = None) -> DataFrame:
    """Per cluster: total weight and the heaviest member (or the one with most of `by`)."""
    by = heaviest() if by is None else by
    return weighted.groupBy("cluster_id").agg(F.sum("weight").alias("total_weight"), F.max_by("exp_id", by).alias("dominant_id"), F.count(F.lit(1)).alias("n"))


def vote_shares(items: DataFrame, group: str = "cluster_id", item: str = "item") -> DataFrame:
    """group, item, share of the group's weight (each member counted once, whatever it proposes), rank by share."""
    votes = items.groupBy(group, item).agg(F.sum("weight").alias("votes"), F.min("exp_id").alias("first"))
    total = items.select(group, "exp_id", "weight").distinct().groupBy(group).agg(F.sum("weight").alias("total"))
    shares = votes.join(total, group).withColumn("share", F.when(F.col("total") > 1e-9, F.col("votes") / F.col("total")).otherwise(0.0))
    order = Window.partitionBy(group).orderBy(F.round("share", 9).desc(), "first", item)
    return shares.withColumn("rank", F.row_number().over(order)).select(group, item, "share", "rank")


def weighted_vote(items: DataFrame, theta: float, **names) -> DataFrame:
    """Items with wins: share of at least theta."""
    return vote_shares(items, **names).withColumn("wins", F.round("share", 9) >= theta)


def weighted_union(items: DataFrame, least: float = 0.03, top: int = 8, **names) -> DataFrame:
    """Items with kept: share of at least `least` and among the `top` heaviest."""
    return vote_shares(items, **names).withColumn("kept", (F.round("share", 9) >= least) & (F.col("rank") <= top))


def status_fold(status: Column) -> Column:
    s = F.lower(status)
    return F.when(s.contains("patched"), "patched").when(s.contains("fail"), "failure").when(s.contains("partial"), "partial").when(s.contains("success"), "success").otherwise(status)


def status_vote(rows: DataFrame) -> DataFrame:
    """Per (cluster_id, cve): the heaviest folded status, its share, and the heaviest original label in it."""
    labels = rows.withColumn("folded", status_fold(F.col("status"))).groupBy("cluster_id", "cve", "folded", "status").agg(F.sum("weight").alias("w"), F.count(F.lit(1)).alias("n"))
    folded = labels.groupBy("cluster_id", "cve", "folded").agg(F.sum("w").alias("w"), F.sum("n").alias("n"), F.max_by("status", F.struct(F.round("w", 9), "status")).alias("label"))
    return folded.groupBy("cluster_id", "cve").agg(
        F.max_by("folded", F.struct(F.round("w", 9), "folded")).alias("winner"),
        F.max_by("label", F.struct(F.round("w", 9), "folded")).alias("label"),
        (F.max("w") / F.sum("w")).alias("share"),
        F.sum("n").alias("evidence"),
    )


def noisy_or(p: Column, w: Column) -> Column:
    """1 - product(1 - p w) as an aggregate, in log space, clamped to 0..1."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.exp(F.sum(F.log(F.greatest(1 - p * w, F.lit(1e-9)))))))


def calibrate(weighted: DataFrame, by: Column | None = None) -> DataFrame:
    """Per cluster: p_fused (per-session best p and w when sessions repeat), n_sessions, dominant maturity and outcome,
    strong counterexamples, and the maturity after two passes of the ladder. by: as in dominant()."""
    by = heaviest() if by is None else by
    sessions = weighted.groupBy("cluster_id", "session_id").agg(F.max("confidence").alias("p"), F.max("weight").alias("w"), F.count(F.lit(1)).alias("n"))
    fused = sessions.groupBy("cluster_id").agg(F.round(noisy_or(F.col("p"), F.col("w")), 6).alias("p_fused"), F.count(F.lit(1)).alias("n_sessions"), F.sum("n").alias("n_members"))
    first = weighted.groupBy("cluster_id").agg(F.max_by(F.struct("maturity", "outcome"), by).alias("d"), F.first("key_layer").alias("key_layer"))
    against = weighted.join(first.select("cluster_id", F.col("d.outcome").alias("lead")), "cluster_id").groupBy("cluster_id").agg(F.sum(((F.col("outcome") != F.col("lead")) & (F.col("weight") > 0.70)).cast("int")).alias("n_counter"))
    out = fused.join(first.select("cluster_id", "key_layer", F.col("d.maturity").alias("maturity_before")), "cluster_id").join(against, "cluster_id").withColumn("contradiction", F.lit(0.0))
    out = out.withColumn("pass1", next_maturity(F.col("maturity_before"))).withColumn("maturity_after", next_maturity(F.col("pass1")))
    limit = F.when(F.col("key_layer").isin("METACOGNITIVE", "CONCEPTUAL"), 0.30).otherwise(0.60)
    status = F.when((F.col("contradiction") > limit) & (F.col("maturity_after") != "consolidated"), "conflicted").otherwise("active")
    return out.withColumn("lifecycle", status).withColumn("should_reflux", (F.col("maturity_after") == "consolidated") & (status == "active")).drop("pass1")


def next_maturity(now: Column) -> Column:
    """One step of the ladder over p_fused, n_sessions, n_counter, contradiction and key_layer."""
    limit = F.when(F.col("key_layer").isin("METACOGNITIVE", "CONCEPTUAL"), 0.30).otherwise(0.60)
    enough = F.when(F.col("n_sessions") >= 3, 0.75).otherwise(0.80)
    return (
        F.when((now == "consolidated") & (F.col("n_counter") >= 2), "validated")
        .when((now == "raw") & (F.col("p_fused") >= 0.60) & (F.col("n_sessions") >= 2), "validated")
        .when((now == "validated") & (F.col("p_fused") >= enough) & (F.col("n_sessions") >= 3) & (F.col("contradiction") <= limit), "consolidated")
        .otherwise(now)
    )


def temporal_weight() -> Column:
    """Confidence x maturity factor x decay by layer (age at least 0)."""
    rate = lookup(F.col("layer"), DECAY, 0.003)
    return F.round(F.coalesce("confidence", F.lit(0.5)) * lookup(F.col("maturity"), MATURITY_FACTOR, 0.4) * F.exp(-rate * F.greatest(F.coalesce("age_days", F.lit(0)), F.lit(0))), 6)


def suspend(experiences: DataFrame) -> DataFrame:
    """experiences with w_temporal and the lifecycle after suspending faded active rows."""
    out = experiences.withColumn("w_temporal", temporal_weight())
    return out.withColumn("lifecycle_after", F.when((F.col("lifecycle") == "active") & (F.col("w_temporal") < SUSPEND_BELOW), "suspended").otherwise(F.col("lifecycle")))


def archive_sources(experiences: DataFrame, members: DataFrame, mode: str = "archived") -> DataFrame:
    """experiences with lifecycle_after and merged_into: sources of a consolidated cluster leave the active set."""
    target = members.groupBy("exp_id").agg(F.min("cluster_id").alias("merged_into"))
    joined = experiences.join(target, "exp_id", "left")
    return joined.withColumn("lifecycle_after", F.when(F.col("merged_into").isNotNull() & (F.col("lifecycle") == "active"), mode).otherwise(F.col("lifecycle")))


def backfill_services(experiences: DataFrame) -> DataFrame:
    """Empty services filled by the confidence-weighted vote of the session (first in order wins a tie)."""
    known = experiences.filter("service <> ''").groupBy("session_id", "service").agg(F.sum("confidence").alias("w"), F.min("exp_id").alias("first"))
    best = known.groupBy("session_id").agg(F.max_by("service", F.struct(F.round("w", 9), -F.col("first"))).alias("voted"))
    return experiences.join(best, "session_id", "left").withColumn("service", F.coalesce(F.nullif("service", F.lit("")), "voted", F.lit(""))).drop("voted")


def outcome_majority(weighted: DataFrame) -> DataFrame:
    """Per cluster: success, failure or mixed by weight."""
    good = F.sum(F.when(F.col("outcome") == "success", F.col("weight")).otherwise(0.0))
    bad = F.sum(F.when(F.col("outcome") == "failure", F.col("weight")).otherwise(0.0))
    return weighted.groupBy("cluster_id").agg(F.when(F.round(good - bad, 9) > 0, "success").when(F.round(good - bad, 9) < 0, "failure").otherwise("mixed").alias("majority"))


def beta_update(p: Column, n: Column) -> Column:
    """Posterior mean of Beta(1, 1) after n sessions at rate p; kept only if it rises by over 1e-4."""
    new = (1 + p * n) / (2 + n)
    return F.when(new > p + 1e-4, new).otherwise(p)


def covered_dedupe(actions: Column) -> Column:
    """Ordered actions without those whose CVEs heavier ones already cover; actions without CVEs stay."""
    start = F.struct(F.array().cast("array<string>").alias("seen"), F.array().cast("array<string>").alias("kept"))

    def step(acc: Column, action: Column) -> Column:
        own = tx.cves(action)
        drop = (F.size(own) > 0) & (F.size(F.array_except(own, acc["seen"])) == 0)
        return F.struct(F.when(drop, acc["seen"]).otherwise(F.array_union(acc["seen"], own)).alias("seen"), F.when(drop, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(action))).alias("kept"))

    return F.aggregate(actions, start, step, lambda a: a["kept"])
