"""Rows as they are stored and shown: tolerant payloads, defaults, small rules of retrieval, crawling and sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kenning.functions import text as tx

# Dimensions of causes, what an experience defaults to, and keys that a retrieval text leaves out.
DIMENSIONS = ["ENV", "INV", "DEF", "INT", "EFF"]
DEFAULTS = {"knowledge_layer": "FACTUAL", "maturity": "raw", "confidence": 0.7, "extraction_source": "rule", "session_outcome": "unknown", "extractor_version": "1.0.0"}
TRACING_KEYS = ["source_event_ids", "source_turn_indices"]
# Which failures outside documents can help with.
CRAWL_WORTHY = {
    "INCOMPLETE_RECON": True,
    "MISSING_CONTEXT": True,
    "WRONG_ASSUMPTION": True,
    "PATCHED": True,
    "WRONG_ARGS": True,
    "WRONG_SYNTAX": True,
    "BINARY_MISSING": False,
    "PERMISSION": False,
    "TIMEOUT": False,
    "DEPENDENCY_MISSING": False,
    "AUTHENTICATION": False,
    "ACTIVE_BLOCKING": False,
    "BLIND_EXECUTION": False,
    "AUTHORIZATION": False,
}
# List keys of search answers, and words that count results, by reader.
RESULT_KEYS = {"generic": ["results", "items", "data", "chunks", "documents"], "run_steps": ["results", "items", "data", "chunks"], "callbacks": []}
RESULT_WORDS = {"generic": r"(?i)\bdocument\s*\d+\b|\bchunk\s*\d+\b", "run_steps": r"(?i)\bdocument\s+\d+\b|\bchunk\s+\d+\b", "callbacks": r"(?i)\bdocument\b|\bdoc\s+\d+\b"}
CAUSE = "struct<dimension:string,sub_dimension:string,evidence:string,source:string,remediation_hint:string,reasoning:string,search_queries:string>"


def cause_payload(raw: Column) -> Column:
    """A failure cause from JSON or the repr of a Python dict; null without a dimension.

    Texts are trimmed, the source is `rule` by default, and queries are an array whatever they were.
    """
    literal = F.regexp_replace(F.regexp_replace(raw, r"(?<=[:,\[]\s?)None(?=\s*[,\]}])", "null"), r"(?<=[:,\[]\s?)(?:True|False)(?=\s*[,\]}])", "true")
    read = F.from_json(F.when(tx.strip(raw).startswith("{"), literal), CAUSE, {"allowSingleQuotes": "true"})
    said = lambda name: tx.strip(F.coalesce(read[name], F.lit("")))
    asked = F.coalesce(read["search_queries"], F.lit(""))
    listed = F.when(asked == "", F.array().cast("array<string>")).when(asked.startswith("["), F.filter(F.from_json(asked, "array<string>"), lambda q: tx.strip(q) != "")).otherwise(F.array(asked))
    made = F.struct(
        said("dimension").alias("dimension"), said("sub_dimension").alias("sub_dimension"), said("evidence").alias("evidence"), F.coalesce(F.nullif(said("source"), F.lit("")), F.lit("rule")).alias("source"),
        read["remediation_hint"].alias("remediation_hint"), read["reasoning"].alias("reasoning"), listed.alias("search_queries"),
    )
    return F.when(said("dimension") != "", made)


def known_cause(cause: Column) -> Column:
    """The cause if its dimension, in any case, is a known one; else null."""
    return F.when(F.upper(cause["dimension"]).isin(DIMENSIONS), cause.withField("dimension", F.upper(cause["dimension"])))


def date_or_epoch(text: Column) -> Column:
    return F.coalesce(tx.timestamp(text), F.lit("1970-01-01 00:00:00").cast("timestamp"))


def with_defaults(rows: DataFrame) -> DataFrame:
    """rows with the default where a column of DEFAULTS is null or missing."""
    return rows.withColumns({name: F.coalesce(F.col(name), F.lit(value)) if name in rows.columns else F.lit(value) for name, value in DEFAULTS.items()})


def settled_outcome(label: Column) -> dict[str, Column]:
    """outcome_label, is_success and goal_achieved that agree with each other, whatever a model said of the latter two."""
    known = F.when(label.isin("success", "partial_success", "failure"), label).otherwise("failure")
    return {"outcome_label": known, "is_success": known == "success", "goal_achieved": known != "failure"}


def whole_records(rows: DataFrame, columns: list[str], required: list[str]) -> DataFrame:
    """Only the known columns, null where a file lacks one, and only rows that have the required ones."""
    have = [F.col(f"`{c}`") if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns]
    return rows.select(*have).dropna(subset=required)


def without_empty(constraints: Column) -> Column:
    """The map, or null if it is empty."""
    return F.when(F.size(constraints) > 0, constraints)


def merged_constraints(service: Column, version: Column, cves: Column, told: dict[str, Column]) -> dict[str, Column]:
    """Service and version of a row, from another source where it has none, and the upper-cased union of both CVE lists."""
    own = lambda a, b: F.coalesce(F.nullif(tx.strip(a), F.lit("")), F.nullif(tx.strip(b), F.lit("")), F.lit(""))
    upper = lambda c: F.transform(F.coalesce(c, F.array().cast("array<string>")), F.upper)
    return {"service": own(service, told["service"]), "version": own(version, told["version"]), "cves": F.array_union(upper(cves), upper(told["cves"]))}


def retrieval_text(exp_id: Column, layer: Column, content: Column, metadata: Column, confidence: Column) -> Column:
    """JSON of a row for the index, its metadata (a map) without what only traces it."""
    kept = F.map_filter(metadata, lambda k, _: ~k.isin(TRACING_KEYS))
    return F.to_json(F.struct(exp_id.alias("exp_id"), layer.alias("knowledge_layer"), content.alias("content"), kept.alias("metadata"), confidence.alias("confidence")))


def searchable(content: Column, tags: Column) -> Column:
    """What conflicts are searched by: patterns, commands, rules, lessons and insights of a row's JSON content, each cut, and ten tags."""
    got = lambda path, most: F.nullif(F.substring(F.get_json_object(content, path), 1, most), F.lit(""))
    listed = lambda path: F.slice(F.coalesce(F.from_json(F.get_json_object(content, path), "array<string>"), F.array().cast("array<string>")), 1, 5)
    cut = lambda items: F.array_join(F.transform(items, lambda x: F.substring(x, 1, 100)), " ")
    parts = [got(f"$.{k}", 200) for k in ("avoid_pattern", "failed_command", "failure_sub_dimension")] + [got("$.decision_rule.IF", 150), F.nullif(cut(listed("$.decision_rule.THEN")), F.lit("")), got("$.command_template", 200)]
    parts += [F.nullif(cut(listed("$.key_lessons")), F.lit("")), got("$.core_insight", 200), F.nullif(F.array_join(F.slice(tags, 1, 10), " "), F.lit(""))]
    return F.concat_ws(" ", *parts)


def crawl_worthy(sub_dimension: Column) -> Column:
    """Whether outside documents can help with a failure; unknown kinds can't."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in CRAWL_WORTHY.items() for x in pair]), F.upper(tx.strip(sub_dimension))), F.lit(False))


def result_count(output: Column, reader: str = "generic") -> Column:
    """How many documents a knowledge search gave: a JSON list's length, else separators and one, else numbered words, else -1; 0 for nothing."""
    bare = tx.strip(F.coalesce(output, F.lit("")))
    whole = F.when(bare.startswith("["), F.json_array_length(bare)) if RESULT_KEYS[reader] else F.lit(None).cast("int")
    keyed = [F.when(bare.startswith("{"), F.json_array_length(F.get_json_object(bare, f"$.{k}"))) for k in RESULT_KEYS[reader]]
    marks, words = F.regexp_count(bare, F.lit("---")), F.regexp_count(bare, F.lit(RESULT_WORDS[reader]))
    cut, named = F.when(marks > 0, marks + 1), F.when(words > 0, words)
    order = [named, cut] if reader == "callbacks" else [cut, named]
    return F.when(bare == "", 0).otherwise(F.coalesce(whole, *keyed, *order, F.lit(-1)))


def reasoning(log: Column) -> Column:
    """What an agent thought, without the lines that only name the call; null if nothing is left."""
    lines = F.filter(F.split(log, r"\r?\n"), lambda x: ~x.rlike(r"(?i)^\s*Invoking\s*:"))
    return F.nullif(tx.strip(F.array_join(lines, "\n")), F.lit(""))


def category(own: Column, is_search: Column) -> Column:
    """A call's category; a call with knowledge-search results is one whatever its name."""
    return F.when(is_search, "RAG_QUERY").otherwise(own)


def account_name(name: Column, banned: list[str] | None = None) -> Column:
    """Whether a string found in a text may be an account's name."""
    bare = F.length(name).between(2, 25) & ~name.rlike(r"^\d+$") & ~name.rlike(r"^[，,。！!？?、\-—.0-9]") & ~name.rlike(r"(?i)http|www\.") & ~name.rlike(r"[\])）]$")
    return bare & ~name.isin(banned) if banned else bare


def candidate_name(name: Column, banned: list[str] | None = None) -> Column:
    """Whether a listed name may be a candidate."""
    bare = tx.strip(name)
    good = F.length(bare).between(2, 35) & ~bare.rlike(r"(?i)http|www\.|github\.com")
    return good & ~bare.isin(banned) if banned else good


def exploited(catalogue: DataFrame) -> DataFrame:
    """cve: the ids of a catalogue of exploited vulnerabilities (value: its JSON text), distinct."""
    listed = F.from_json(F.get_json_object("value", "$.vulnerabilities"), "array<struct<cveID:string>>")
    return catalogue.select(F.explode(listed).alias("v")).select(F.col("v.cveID").alias("cve")).filter("cve <> ''").distinct()


def collect(spark: SparkSession, sources: dict[str, Callable[[], DataFrame]], schema: str) -> tuple[DataFrame, DataFrame]:
    """Rows of all sources with their `source`, and source, status, n, message of each; one that fails counts as empty."""
    rows, told = spark.createDataFrame([], f"source string, {schema}"), []
    for name, read in sources.items():
        try:
            found = read().withColumn("source", F.lit(name)).select(*rows.columns)
            n = found.count()
            rows = rows.unionByName(found)
            told.append((name, "ok", n, ""))
        except Exception as error:  # one source must not stop the others; its failure is what the table tells
            told.append((name, "failed", 0, str(error)[:500]))
    return rows, spark.createDataFrame(told, "source string, status string, n long, message string")


def file_report(lines: DataFrame, events: DataFrame) -> DataFrame:
    """source_file, status, n_lines, n_bad, n_events, n_code_writes of each file; ERROR if no line of it could be read.

    lines: source_file, raw (every non-blank line); events: source_file, category.
    """
    bad = ~tx.is_object(F.col("raw"))
    read = lines.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(bad).alias("n_bad"))
    made = events.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_events"), F.count_if(F.col("category") == "CODE_WRITE").alias("n_code_writes"))
    both = read.join(made, "source_file", "left").na.fill(0, ["n_events", "n_code_writes"])
    return both.select("source_file", F.when(F.col("n_bad") < F.col("n_lines"), "OK").otherwise("ERROR").alias("status"), "n_lines", "n_bad", "n_events", "n_code_writes")
