"""Merging the members of a cluster into one row, by layer.

Inputs are long frames (cluster_id, exp_id, weight, item): a list of proposals is rows, not an array, so a cluster of
any size is merged by aggregation with partial sums; what is gathered into an array has a fixed most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kenning.functions.text import cves
from kenning.operators.fusion import covered_dedupe, heaviest, vote_shares

# What actions mean the same, first match wins.
INTENTS = [
    ("PORT_SCAN", ["nmap", "端口扫描", "port scan", "port-scan"]),
    ("PATH_ENUM", ["/console", "/wls-wsat", "/bea_wls", "/wls9", "路径枚举", "endpoint", "端点枚举", "枚举路径"]),
    ("HTTP_FINGERPRINT", ["server header", "http 头", "http header", "版本探测", "-i http"]),
]
# Fingerprints of lessons that say the same.
SAME_LESSON = {
    "VALIDATE_RECON": "RECON_BEFORE_EXPLOIT",
    "VERSION_DETECT_FIRST": "RECON_BEFORE_EXPLOIT",
    "VERSION_CHECK_FIRST": "RECON_BEFORE_EXPLOIT",
    "VALIDATE_TOOL": "TOOL_VALIDATION",
    "CHECK_TOOL_OUTPUT": "TOOL_VALIDATION",
    "VERIFY_TOOL_RESULT": "TOOL_VALIDATION",
    "AVOID_BLIND_EXECUTION": "BLIND_EXECUTION_GUARD",
    "NO_BLINDEXEC": "BLIND_EXECUTION_GUARD",
    "TOPO_NETCHECK": "LOOPBACK_NETWORK_TEST",
    "FAILURE_BREAKER": "FAILURE_PIVOT_STRATEGY",
    "FAILURE_PIVOT": "FAILURE_PIVOT_STRATEGY",
    "PIVOT_ON_DEFENSE": "FAILURE_PIVOT_STRATEGY",
    "PATH_SWITCH": "PATH_SWITCH_ON_FAILURE",
    "COMMAND_PLANNING": "PATH_SWITCH_ON_FAILURE",
}
SEPARATORS, LABEL, LESSON_CHARS = ["：", ":"], r"^(?=.*\p{L})[\p{L}_-]{3,50}$", 40
MOST_MISTAKES, MOST_ALTERNATIVES, MOST_SUPPLEMENTS = 5, 3, 5


def _listed(shares: DataFrame, keep: Column, out: str) -> DataFrame:
    rows = shares.filter(keep).groupBy("cluster_id").agg(F.sort_array(F.collect_list(F.struct("rank", "item"))).alias("__x"))
    return rows.select("cluster_id", F.array_join(F.transform("__x", lambda x: x["item"]), " | ").alias(out))


def ranked_union(items: DataFrame, least: float, top: int, fallback: int, out: str) -> DataFrame:
    """Items with a share of at least `least`, the `top` heaviest; if none has it, the `fallback` heaviest."""
    shares = vote_shares(items)
    enough = F.round("share", 9) >= least
    some = shares.groupBy("cluster_id").agg(F.bool_or(enough).alias("__some"))
    joined = shares.join(some, "cluster_id")
    return _listed(joined, F.when(F.col("__some"), enough & (F.col("rank") <= top)).otherwise(F.col("rank") <= fallback), out)


def dominant(members: DataFrame, fields: list[str], by: Column | None = None) -> DataFrame:
    """cluster_id and the fields of its heaviest member (the least exp_id on a tie), or of the one with most of `by`."""
    by = heaviest() if by is None else by
    top = members.groupBy("cluster_id").agg(F.max_by(F.struct(*fields), by).alias("__d"))
    return top.select("cluster_id", *[F.col(f"__d.{f}").alias(f) for f in fields])


def positive(preconditions: DataFrame, indicators: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """cluster_id, preconditions (15 %, top 10, else best 3), indicators (5 %, top 5), and of members (if given: +
    template, tool_name, phase) what the heaviest has."""
    merged = ranked_union(preconditions, 0.15, 10, 3, "preconditions").join(ranked_union(indicators, 0.05, 5, 0, "indicators"), "cluster_id", "full")
    return merged if members is None else dominant(members, ["template", "tool_name", "phase"]).join(merged, "cluster_id", "left")


def intent(said: Column) -> Column:
    """What an action means, null if nothing known or if it names a CVE."""
    out, low = F.when(F.size(cves(said)) > 0, None), F.lower(said)
    for name, words in INTENTS:
        out = out.when(low.rlike("|".join(words)), name)
    return out


def intent_dedupe(actions: Column) -> Column:
    """Ordered actions with the longest of each intent at the place of its first; actions without an intent stay."""
    known = F.transform(actions, lambda a, i: F.struct(a.alias("said"), i.alias("at"), intent(a).alias("intent")))

    def best(x: Column) -> Column:
        same = F.filter(known, lambda y: y["intent"].eqNullSafe(x["intent"]))
        return F.aggregate(same, F.lit(""), lambda top, y: F.when(F.length(y["said"]) > F.length(top), y["said"]).otherwise(top))

    first = F.filter(known, lambda x: x["intent"].isNull() | ~F.exists(known, lambda y: y["intent"].eqNullSafe(x["intent"]) & (y["at"] < x["at"])))
    return F.transform(first, lambda x: F.when(x["intent"].isNull(), x["said"]).otherwise(best(x)))


def negative(then: DataFrame, avoid: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """cluster_id, then_actions (3 %, top 8, less those whose CVEs are covered, one per intent), avoid (20 %, else the
    best), and of members (if given: + if_text, next_actions, source, dimension, sub_dimension) the heaviest one's terms,
    how many rules come from which source, and up to three other next_actions."""
    shares = vote_shares(then).filter((F.round("share", 9) >= 0.03) & (F.col("rank") <= 8))
    listed = shares.groupBy("cluster_id").agg(F.sort_array(F.collect_list(F.struct("rank", "item"))).alias("__x"))
    listed = listed.select("cluster_id", F.transform("__x", lambda x: x["item"]).alias("__then"))
    listed = listed.withColumn("__then", covered_dedupe(F.col("__then"))).select("cluster_id", F.array_join(intent_dedupe(F.col("__then")), " | ").alias("then_actions"))
    merged = listed.join(ranked_union(avoid, 0.20, 99, 1, "avoid"), "cluster_id", "full")
    if members is None:
        return merged
    heads = dominant(members, ["if_text", "next_actions", "dimension", "sub_dimension"])
    sources = members.groupBy("cluster_id", "source").agg(F.count(F.lit(1)).alias("n")).groupBy("cluster_id").agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws("=", "source", "n"))), ",").alias("sources"))
    other = members.join(heads.select("cluster_id", F.col("next_actions").alias("__own")), "cluster_id").filter("next_actions <> '' and next_actions <> __own")
    w = Window.partitionBy("cluster_id").orderBy(F.desc("weight"), "exp_id")
    rest = other.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= MOST_ALTERNATIVES).groupBy("cluster_id").agg(F.sort_array(F.collect_list(F.struct("__n", "next_actions"))).alias("__a"))
    rest = rest.select("cluster_id", F.array_join(F.transform("__a", lambda x: x["next_actions"]), " | ").alias("alternatives"))
    return heads.join(merged, "cluster_id", "left").join(sources, "cluster_id").join(rest, "cluster_id", "left")


def factual(facts: DataFrame) -> DataFrame:
    """Per (cluster_id, key, value): how many members have it, its weight, the first of them; heavier facts first by rank. facts: + key, value."""
    grouped = facts.groupBy("cluster_id", "key", "value").agg(F.count_distinct("exp_id").alias("n"), F.round(F.sum(F.round("weight", 4)), 4).alias("support"), F.min("exp_id").alias("first_id"))
    w = Window.partitionBy("cluster_id").orderBy(F.desc("support"), "key", "value")
    return grouped.withColumn("rank", F.row_number().over(w))


def cve_sets(rows: DataFrame) -> DataFrame:
    """cluster_id, kind, item, n, support, rank: what a cluster's members say of CVEs and ways in, as sets.

    rows: cluster_id, exp_id, weight, kind (attempted, unexplored or vector), item. Attempted CVEs are a union with how
    many members attempted them; unexplored ones a union less what any member attempted; vectors (ways that didn't work)
    a union with how many members tried them. One aggregation by item gives all three; heavier items first.
    """
    of = lambda kind: F.col("kind") == kind
    told = rows.filter(F.coalesce("item", F.lit("")) != "").groupBy("cluster_id", of("vector").alias("is_vector"), "item")
    sums = told.agg(
        F.count_if(of("attempted")).alias("attempted"), F.count_if(of("unexplored")).alias("unexplored"), F.count_if(of("vector")).alias("vector"), F.round(F.sum(F.round("weight", 4)), 4).alias("support")
    )
    kind = F.when(F.col("is_vector"), "vector").when(F.col("attempted") > 0, "attempted").otherwise("unexplored")
    found = sums.withColumn("kind", kind).withColumn("n", F.when(F.col("kind") == "vector", F.col("vector")).when(F.col("kind") == "attempted", F.col("attempted")).otherwise(F.col("unexplored")))
    order = Window.partitionBy("cluster_id", "kind").orderBy(F.desc("support"), "item")
    return found.select("cluster_id", "kind", "item", "n", "support", F.row_number().over(order).alias("rank"))


def vote_breakdown(results: DataFrame) -> DataFrame:
    """cluster_id, cve, status, share: how much of the weight each status of a CVE has, as it was told."""
    per = results.groupBy("cluster_id", "cve", "status").agg(F.sum("weight").alias("w"))
    total = per.groupBy("cluster_id", "cve").agg(F.sum("w").alias("total"))
    return per.join(total, ["cluster_id", "cve"]).select("cluster_id", "cve", "status", F.round(F.col("w") / F.col("total"), 4).alias("share"))


def fingerprint(lesson: Column) -> Column:
    """What two lessons must share to be one: the label before a colon, else the first characters, folded by SAME_LESSON."""
    labels = [F.trim(F.substring_index(lesson, mark, 1)) for mark in SEPARATORS]
    said = [F.when(lesson.contains(mark) & x.rlike(LABEL) & (x == F.upper(x)), x) for mark, x in zip(SEPARATORS, labels, strict=True)]
    key = F.trim(F.upper(F.coalesce(*said, F.substring(lesson, 1, LESSON_CHARS))))
    table = F.create_map(*[F.lit(x) for pair in SAME_LESSON.items() for x in pair])
    return F.coalesce(F.try_element_at(table, key), key)


def metacognitive(lessons: DataFrame, by: Column | None = None) -> DataFrame:
    """Per cluster its lessons: one per fingerprint (the heaviest, or that with most of `by`), how many had it, ranked by count x weight."""
    by = heaviest() if by is None else by
    told = lessons.filter(F.coalesce("item", F.lit("")) != "")
    per = told.groupBy("cluster_id", fingerprint(F.col("item")).alias("fingerprint")).agg(F.count(F.lit(1)).alias("n"), F.round(F.max("weight"), 4).alias("weight"), F.max_by("item", by).alias("lesson"))
    w = Window.partitionBy("cluster_id").orderBy(F.round(F.col("n") * F.col("weight"), 9).desc(), "fingerprint")
    return per.withColumn("rank", F.row_number().over(w))


def mistakes(made: DataFrame) -> DataFrame:
    """cluster_id, fingerprint, item, vote_weight, vote_count, rank: the heaviest MOST_MISTAKES mistakes. made: + fingerprint."""
    key = F.coalesce(F.nullif("fingerprint", F.lit("")), F.substring("item", 1, 20))
    per = made.groupBy("cluster_id", key.alias("fingerprint")).agg(F.min_by("item", "exp_id").alias("item"), F.round(F.sum("weight"), 4).alias("vote_weight"), F.count(F.lit(1)).alias("vote_count"))
    w = Window.partitionBy("cluster_id").orderBy(F.desc("vote_weight"), "fingerprint")
    return per.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= MOST_MISTAKES)


def first_seen(items: DataFrame) -> DataFrame:
    """cluster_id, item, rank: the union of what the members say, heaviest members first."""
    per = items.filter(F.coalesce("item", F.lit("")) != "").groupBy("cluster_id", "item").agg(F.min(F.struct(-F.col("weight"), "exp_id")).alias("at"))
    return per.select("cluster_id", "item", F.row_number().over(Window.partitionBy("cluster_id").orderBy("at", "item")).alias("rank"))


def conceptual(insights: DataFrame, conditions: DataFrame, supplements: int = MOST_SUPPLEMENTS, by: Column | None = None) -> DataFrame:
    """cluster_id, insight (heaviest, or that with most of `by`), supplements (next ones that say something else), conditions (30 % of the weight)."""
    top = dominant(insights, ["item"], by).withColumnRenamed("item", "insight")
    w = Window.partitionBy("cluster_id").orderBy(F.desc("weight"), "exp_id")
    ranked = insights.join(top, "cluster_id").filter("item <> '' and item <> insight").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= supplements)
    rest = ranked.groupBy("cluster_id").agg(F.sort_array(F.collect_list(F.struct("rank", "item"))).alias("__x")).select("cluster_id", F.array_join(F.transform("__x", lambda x: x["item"]), " | ").alias("supplements"))
    named = top.join(rest, "cluster_id", "left").select("cluster_id", "insight", F.coalesce("supplements", F.lit("")).alias("supplements"))
    return named.join(ranked_union(conditions, 0.30, 99, 0, "conditions"), "cluster_id", "left")


#: Layer -> merge function over its proposal frames.
MERGES = {"PROCEDURAL_POS": positive, "PROCEDURAL_NEG": negative, "FACTUAL": factual, "METACOGNITIVE": metacognitive, "CONCEPTUAL": conceptual}


def route(layer: Column, sub: Column, content: Column) -> Column:
    """Which merge a row goes to: FACTUAL rows by their sub-key, else by what their content (JSON) holds."""
    model = (sub == "FACTUAL::LLM") | ((sub != "FACTUAL::RULE") & content.rlike(r'"(?:cve_context|cve_exploitation_map)"\s*:'))
    return F.when(layer != "FACTUAL", layer).when(F.coalesce(model, F.lit(False)), "FACTUAL::LLM").otherwise("FACTUAL::RULE")


def record(merged: DataFrame) -> DataFrame:
    """merged (cluster_id, layer, service, version, cves, n_members, majority) with exp_id and tags of the consolidated row."""
    short = F.substring(F.replace(F.lower("service"), F.lit(" "), F.lit("_")), 1, 20)
    tags = F.array(F.lit("consolidated"), F.lower("layer"), F.concat(F.lit("n_src="), F.col("n_members").cast("string")), F.nullif(short, F.lit("")))
    named = F.concat(F.lit("exp_consolidated_"), F.substring(F.md5(F.col("cluster_id").cast("string").cast("binary")), 1, 10))
    return merged.withColumns({"exp_id": named, "session_id": F.lit("consolidated"), "tags": F.array_compact(F.concat(tags, F.transform(F.slice("cves", 1, 2), F.lower)))})
