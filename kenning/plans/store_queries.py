"""Queries over store texts and records, model gates, crawling helpers and row history."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kenning.operators import crawl, fusion, gates, history, project
from kenning.plans.event_queries import EVENTS
from kenning.plans.experience_queries import ROWS
from kenning.plans.registry import query
from kenning.plans.views import events, experiences, pick, table

CONTENTS = {
    "FACTUAL": {"discovered_facts": [{"key": "open_port", "value": "80"}, {"key": "open_port", "value": "443", "service": "https"}, {"key": "product", "value": "nginx"}, {"key": "http_status", "value": "200"}]},
    "PROCEDURAL_POS": {"preconditions": ["port open", " "], "command_template": "curl {HOST}", "success_indicators": ["uid=0", "root"], "tool_name": "shell"},
    "PROCEDURAL_NEG": {"decision_rule": {"IF": "401", "THEN": ["a", "b"], "NOT": ["c"]}, "failure_dimension": "ENV"},
    "METACOGNITIVE": {"session_goal": "own it", "key_lessons": ["x", "y", "x"], "key_lessons_structured": [{"rule": "y"}, {"lesson": "z"}], "decision_mistakes": [{"mistake": "m", "rule": "r"}, {"mistake": "n"}], "failure_pattern": "None"},
    "CONCEPTUAL": {"core_insight": "i", "applicable_conditions": {"positive": ["p", "q"], "retrieval_triggers": []}},
}
BODIES = {
    "FACTUAL": "open_port: 443 | service=https\nproduct: nginx",
    "PROCEDURAL_POS": "Context: port open\nCommand: curl {HOST}\nExpected: uid=0; root",
    "PROCEDURAL_NEG": "IF 401\nTHEN a; b\nNOT c",
    "METACOGNITIVE": "Session goal: own it\nKey lessons: x; y; z\nDecision mistakes: m => r",
    "CONCEPTUAL": "Insight: i\nApplies when: p; q",
}
CONTENT = "CASE layer " + " ".join(f"WHEN '{layer}' THEN '{json.dumps(c)}'" for layer, c in CONTENTS.items()) + " END"
BODY = "CASE layer " + " ".join(f"WHEN '{layer}' THEN '{b}'" for layer, b in BODIES.items()) + " END"


def _with_content(spark, sf_dir) -> DataFrame:
    return experiences(spark, sf_dir).withColumn("content", F.expr(CONTENT)).withColumn("n_sessions", (F.col("exp_id") % 4).cast("int"))


@query(
    ROWS
    + f""", b AS (SELECT *, {BODY} AS body FROM vx)
SELECT exp_id, layer, '[' || CASE maturity WHEN 'consolidated' THEN '★★★ consolidated' WHEN 'validated' THEN '★★☆ validated' ELSE '★☆☆ raw' END || ' | ' || (exp_id % 4) || ' sessions | p=' || printf('%.2f', confidence) || ']' || chr(10)
 || layer || ' | ' || exp_id || chr(10) || 'knowledge_layer: ' || layer || chr(10) || 'target_service: ' || service || chr(10) || 'confidence: ' || printf('%.4f', confidence)
 || CASE WHEN len(cves) > 0 THEN chr(10) || 'cve_ids: ' || array_to_string(cves, ', ') ELSE '' END || chr(10) || chr(10) || body || chr(10) || chr(10) || 'QUERY_HINTS:' || chr(10) || '- ' || layer || chr(10) || '- ' || service
 || CASE WHEN len(cves) > 0 THEN chr(10) || '- ' || array_to_string(cves, chr(10) || '- ') ELSE '' END AS chunk FROM b"""
)
def store_chunks(spark, sf_dir) -> DataFrame:
    return project.chunks(_with_content(spark, sf_dir))


RECORDS = """CASE layer
 WHEN 'FACTUAL' THEN '{"target_service":"' || service || '"' || CASE WHEN version <> '' THEN ',"target_version":"' || version || '"' ELSE '' END || CASE WHEN len(cves) > 0 THEN ',"cve_ids":["' || array_to_string(cves, '","') || '"]' ELSE '' END || ',"discovered_facts":[{"key":"open_port","value":"80"},{"key":"open_port","value":"443","service":"https"},{"key":"product","value":"nginx"},{"key":"http_status","value":"200"}]}'
 WHEN 'PROCEDURAL_POS' THEN '{"command_template":"curl {HOST}","tool_name":"shell","preconditions":["port open"],"success_indicators":["uid=0","root"]' || CASE WHEN len(cves) > 0 THEN ',"cve_ids":["' || array_to_string(cves, '","') || '"]' ELSE '' END || ',"target_service":"' || service || '"}'
 WHEN 'PROCEDURAL_NEG' THEN '{"failure_dimension":"ENV","decision_rule":{"IF":"401","THEN":["a","b"],"NOT":["c"]},"target_service":"' || service || '"}'
 WHEN 'METACOGNITIVE' THEN '{"session_goal":"own it","key_lessons":["x","y","x"]}'
 ELSE '{"core_insight":"i","positive_conditions":["p","q"]}' END"""
FILTERS = """CASE layer WHEN 'FACTUAL' THEN '"factual_source":"rule","session_outcome":"' || outcome || '","target_service":"' || service || '"'
 WHEN 'PROCEDURAL_POS' THEN '"session_outcome":"' || outcome || '","target_service":"' || service || '"' || CASE WHEN len(cves) > 0 THEN ',"cve_ids":["' || array_to_string(cves, '","') || '"]' ELSE '' END
 WHEN 'PROCEDURAL_NEG' THEN '"failure_dimension":"ENV","target_service":"' || service || '"' WHEN 'METACOGNITIVE' THEN '"session_outcome":"' || outcome || '","target_service":"' || service || '"' END"""


@query(ROWS + f"""SELECT exp_id, layer, {RECORDS} AS content, '{{"confidence":' || confidence || ',"maturity":"' || maturity || '"' || coalesce(',' || {FILTERS}, '') || '}}' AS filters FROM vx""")
def upload_records(spark, sf_dir) -> DataFrame:
    return project.records(_with_content(spark, sf_dir))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN 0 ELSE 1 END AS n, CASE WHEN doc_id % 3 = 2 THEN NULL ELSE substr(md5('never' || source), 1, 12) END AS fingerprint FROM documents""")
def validated_mistakes(spark, sf_dir) -> DataFrame:
    empty = F.lit(None).cast("string")
    fault = F.struct(F.when(F.col("doc_id") % 3 == 2, empty).otherwise("wrong port").alias("mistake"), empty.alias("consequence"), F.concat(F.lit("Never, "), F.upper("source"), F.lit("!")).alias("rule"))
    d = table(spark, sf_dir, "documents").select("doc_id", gates.mistakes(F.array(fault, F.struct(F.lit("no rule").alias("mistake"), empty.alias("consequence"), empty.alias("rule")))).alias("m"))
    return d.select("doc_id", F.size("m").alias("n"), F.get("m", F.lit(0))["rule_fingerprint"].alias("fingerprint"))


@query("SELECT doc_id, doc_id % 4 IN (0, 2) AS passes FROM documents")
def factual_row_gate(spark, sf_dir) -> DataFrame:
    i = F.col("doc_id") % 4
    cves = F.when(i == 0, F.array(F.lit("CVE-2021-1"))).otherwise(F.array(F.lit(" ")))
    return table(spark, sf_dir, "documents").select("doc_id", gates.factual_gate(F.when(i == 3, " ").otherwise("web"), F.when(i >= 2, "2.0").otherwise("Unknown"), cves).alias("passes"))


@query("""SELECT doc_id, doc_id % 2 AS n_triggers, CASE doc_id % 3 WHEN 0 THEN 'success' WHEN 1 THEN 'partial' ELSE 'unknown' END AS status FROM documents""")
def condition_shapes(spark, sf_dir) -> DataFrame:
    text, none = F.array().cast("array<string>"), F.lit(None).cast("string")
    trigger = F.when(F.col("doc_id") % 2 == 1, "log4j").otherwise("关键词1")
    shaped = F.struct(F.array(F.lit("p")).alias("positive"), text.alias("negative"), text.alias("priority_over"), F.array(trigger).alias("retrieval_triggers"))
    made = F.when(F.col("doc_id") % 3 == 0, "Success").otherwise(none)
    guess = F.when(F.col("doc_id") % 3 == 1, "partial").otherwise(none)
    status = gates.merged_status(F.array(F.lit("cve-1")), F.create_map(F.lit("CVE-1"), made), F.create_map(F.lit("CVE-1"), guess))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(gates.conditions(shaped, text)["retrieval_triggers"]).alias("n_triggers"), F.element_at(status, "CVE-1").alias("status"))


@query(EVENTS + "SELECT count(DISTINCT session_id) AS n_sessions, count(DISTINCT session_id) AS n_calls, count(DISTINCT CASE WHEN user_id % 2 = 0 THEN session_id END) AS n_answered, count(*) FILTER (tool_name = 'error') AS n_causes, count(*) FILTER (tool_name = 'error') AS n_fallback, 'only_fallback_causes' AS reason, false AS passed FROM va")
def annotation_batch_gate(spark, sf_dir) -> DataFrame:
    e = events(spark, sf_dir)
    sessions = e.groupBy("session_id").agg(F.lit(True).alias("model_called"), (F.max("user_id") % 2 == 0).alias("model_answered"))
    return gates.annotation_gate(sessions, e.select(F.when(F.col("tool_name") == "error", "fallback").alias("cause_source")))


@query(ROWS + "SELECT count(*) AS n_rows, count(*) FILTER (exp_id % 2 = 0) AS n_model, count(*) FILTER (layer = 'PROCEDURAL_NEG') AS n_negative, count(*) FILTER (layer = 'PROCEDURAL_NEG' AND exp_id % 3 = 0) AS n_fallback, NULL::VARCHAR AS reason, true AS passed FROM vx")
def extraction_batch_gate(spark, sf_dir) -> DataFrame:
    rows = experiences(spark, sf_dir).withColumn("extraction_source", F.when(F.col("exp_id") % 2 == 0, "llm").otherwise("rule")).withColumn("rule_source", F.when(F.col("exp_id") % 3 == 0, "fallback").otherwise("llm"))
    return gates.extraction_gate(rows)


NAMES = ["main.py", "docs/a.py", "src/x.go", "go.mod", "src/pom.xml", "notes.txt", "src/b.rs", "logo.png", "lib/c.c", "d.ts"]


@query(f"""WITH f AS (SELECT source AS repo, concat({pick("doc_id % 10", [""] * 10)}, n) AS path FROM (SELECT source, doc_id, CASE WHEN strpos(m, '/') > 0 THEN replace(m, '/', '/d' || doc_id || '/') WHEN doc_id % 10 = 3 THEN m ELSE 'd' || doc_id || m END AS n FROM (SELECT *, {pick("doc_id % 10", NAMES)} AS m FROM documents))),
 s AS (SELECT *, CASE WHEN contains(path, '/') THEN 0 ELSE 10 END + CASE WHEN regexp_matches(path, '(^|/)(go\\.mod|pom\\.xml)$') THEN 5 ELSE 0 END AS priority FROM f WHERE NOT contains(path, 'docs/') AND NOT regexp_matches(path, '(txt|png)$'))
 SELECT repo, path, priority, row_number() OVER (PARTITION BY repo ORDER BY priority DESC, path) AS place FROM s QUALIFY place <= 8""")
def repository_core_files(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents").withColumn("m", F.expr(pick("doc_id % 10", NAMES)))
    n = F.expr("CASE WHEN contains(m, '/') THEN replace(m, '/', '/d' || doc_id || '/') WHEN doc_id % 10 = 3 THEN m ELSE 'd' || doc_id || m END")
    files = d.select(F.col("source").alias("repo"), n.alias("path"), F.lit(10).alias("size"), "doc_id")
    return crawl.core_files(files).select("repo", "path", "priority", "place")


@query("""WITH RECURSIVE r AS (SELECT doc_id, -1 AS place, '' AS piece, coalesce(text, '') AS rest FROM documents UNION ALL
 SELECT doc_id, place + 1, left(rest, cut), substr(rest, cut + 1) FROM (SELECT *, CASE WHEN length(rest) <= 3000 THEN length(rest) WHEN p > 1500 THEN p ELSE 3000 END AS cut
   FROM (SELECT *, CAST(length(regexp_extract(left(rest, 3000), '(?s)^(.*)\\n', 1)) AS BIGINT) AS p FROM r WHERE length(rest) > 0 OR place = -1)))
 SELECT doc_id, place, length(piece) AS chars, md5(piece) AS digest FROM r WHERE place >= 0""")
def text_pieces(spark, sf_dir) -> DataFrame:
    pieces = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(crawl.split_text(F.col("text"))).alias("place", "piece"))
    return pieces.select("doc_id", "place", F.length("piece").alias("chars"), F.md5(F.col("piece").cast("binary")).alias("digest"))


@query("SELECT doc_id, ['Red Lab', source, 'x y'] AS names FROM documents")
def answer_line_names(spark, sf_dir) -> DataFrame:
    text = F.concat(F.lit("1. Red Lab\n- `"), F.col("source"), F.lit("`\n无\n\n* x y\n2、Red Lab\nsee http://h\nz"))
    return table(spark, sf_dir, "documents").select("doc_id", crawl.answer_names(text).alias("names"))


@query("""SELECT doc_id AS gap_id, 0 AS place, CASE doc_id % 4 WHEN 0 THEN 'q ' || source WHEN 1 THEN substr(trim(text), 1, 120) ELSE 'CVE-1 exploit PoC' END AS query FROM documents WHERE doc_id % 4 <> 3 AND (doc_id % 4 <> 1 OR coalesce(trim(text), '') <> '')
 UNION ALL SELECT doc_id, 1, 'CVE-2 exploit PoC' FROM documents WHERE doc_id % 4 = 2""")
def gap_query_choice(spark, sf_dir) -> DataFrame:
    i, none = F.col("doc_id") % 4, F.array().cast("array<string>")
    queries, cves = F.when(i == 0, F.array(F.concat(F.lit("q "), F.col("source")))).otherwise(none), F.when(i == 2, F.array(F.lit("CVE-1"), F.lit("CVE-2"), F.lit("CVE-3"))).otherwise(none)
    return crawl.gap_queries(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("gap_id"), queries.alias("queries"), F.when(i == 1, F.col("text")).otherwise("").alias("description"), cves.alias("cves")))


@query("""WITH s AS (SELECT event_type AS source, max(event_id) AS last_seen, count(*) AS n_seen FROM events WHERE event_id % 2 = 0 AND event_type <> 'click' GROUP BY 1), b AS (SELECT event_type AS source, event_id AS seen FROM events WHERE event_id % 3 = 0)
 SELECT source, max(last_seen) AS last_seen, sum(n_seen) AS n_seen, sum(n_runs) AS n_runs FROM (SELECT *, 1 AS n_runs FROM s UNION ALL SELECT source, max(seen), count(*), 1 FROM b GROUP BY 1) GROUP BY 1""")
def crawl_state_upsert(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumnRenamed("event_type", "source")
    state = e.filter("event_id % 2 = 0 AND source <> 'click'").groupBy("source").agg(F.max("event_id").alias("last_seen"), F.count(F.lit(1)).alias("n_seen"), F.lit(1).cast("long").alias("n_runs"))
    return crawl.next_offsets(state, e.filter("event_id % 3 = 0").select("source", F.col("event_id").alias("seen")))


@query("""SELECT event_id FROM events e WHERE event_type = 'click' OR event_id > (SELECT max(event_id) FROM events s WHERE s.event_type = e.event_type AND s.event_id % 7 = 0 AND s.event_id < 500)""")
def crawl_fresh_entries(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.col("event_id").alias("seen"), "event_id")
    state = e.filter("event_id % 7 = 0 AND event_id < 500 AND source <> 'click'").groupBy("source").agg(F.max("seen").alias("last_seen"))
    return crawl.fresh_entries(e, state).select("event_id")


#: Consolidated rows: one a group of 20 documents, which points to its own and to the next group's first.
INTO = """co AS (SELECT g AS into_id, g AS ord, CASE g % 3 WHEN 1 THEN 'conflicted' ELSE 'active' END AS lc, CASE WHEN g % 3 = 2 THEN 'validated' ELSE 'consolidated' END AS mt, exp_id AS src FROM vx
  UNION ALL SELECT g - 1, g - 1, CASE (g - 1) % 3 WHEN 1 THEN 'conflicted' ELSE 'active' END, CASE WHEN (g - 1) % 3 = 2 THEN 'validated' ELSE 'consolidated' END, min(exp_id) FROM vx WHERE g > 0 GROUP BY g)"""


def _consolidated(rows: DataFrame) -> DataFrame:
    own = rows.select("g", "exp_id")
    after = rows.filter("g > 0").groupBy("g").agg(F.min("exp_id").alias("exp_id")).select((F.col("g") - 1).alias("g"), "exp_id")
    c = own.unionByName(after).groupBy("g").agg(F.collect_set("exp_id").alias("source_ids"))
    state, maturity = F.when(F.col("g") % 3 == 1, "conflicted").otherwise("active"), F.when(F.col("g") % 3 == 2, "validated").otherwise("consolidated")
    return c.select(F.col("g").alias("exp_id"), "source_ids", F.col("g").alias("ord"), state.alias("lifecycle"), maturity.alias("maturity"))


def _registry(rows: DataFrame) -> DataFrame:
    return rows.select("exp_id", "lifecycle", F.when(F.col("exp_id") % 5 == 0, F.lit(-1).cast("long")).alias("merged_into"))


@query(
    ROWS
    + f""", {INTO}, ac AS (SELECT *, CASE WHEN lc = 'active' AND mt = 'consolidated' THEN 'archived' WHEN lc = 'conflicted' THEN 'conflicted' END AS act FROM co),
 pe AS (SELECT src, arg_min(act, ord) AS first_act, arg_max(into_id, ord) FILTER (act = 'archived') AS last_into FROM ac WHERE act IS NOT NULL GROUP BY src),
 nw AS (SELECT exp_id, CASE WHEN exp_id % 5 = 0 THEN -1 END AS m, CASE WHEN lifecycle = 'active' AND first_act IS NOT NULL THEN first_act ELSE lifecycle END AS lifecycle, last_into FROM vx LEFT JOIN pe ON src = exp_id)
 SELECT exp_id, lifecycle, CASE WHEN lifecycle = 'archived' AND last_into IS NOT NULL THEN last_into ELSE m END AS merged_into FROM nw"""
)
def source_marks(spark, sf_dir) -> DataFrame:
    rows = experiences(spark, sf_dir)
    return history.mark_sources(_registry(rows), _consolidated(rows))


@query(ROWS + f", {INTO}, pe AS (SELECT src, arg_min(into_id, ord) AS first_into FROM co GROUP BY src) SELECT exp_id, lifecycle, CASE WHEN exp_id % 5 = 0 THEN -1 WHEN lifecycle IN ('suspended', 'archived') THEN first_into END AS merged_into FROM vx LEFT JOIN pe ON src = exp_id")
def merged_into_backfill(spark, sf_dir) -> DataFrame:
    rows = experiences(spark, sf_dir)
    return history.fill_merged_into(_registry(rows), _consolidated(rows))


@query("""WITH a AS (SELECT 'LOG' || (event_id % 50) || '.JSONL' AS f, event_id % 3 AS n_events, ts AS started, event_id AS ord, event_type AS label FROM events)
 SELECT user_id, '/x/log' || (user_id % 60) || '.jsonl' AS path, n_events, label FROM (SELECT DISTINCT user_id FROM events) LEFT JOIN (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY f ORDER BY n_events DESC, started DESC, ord DESC) = 1) ON lower(f) = 'log' || (user_id % 60) || '.jsonl'""")
def log_annotation_choice(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    name = F.concat(F.lit("C:\\logs\\LOG"), (F.col("event_id") % 50).cast("string"), F.lit(".JSONL"))
    a = e.select(name.alias("source_file"), (F.col("event_id") % 3).alias("n_events"), F.col("ts").alias("started"), F.col("event_id").alias("ord"), F.col("event_type").alias("label"))
    logs = e.select("user_id").distinct().select("user_id", F.concat(F.lit("/x/log"), (F.col("user_id") % 60).cast("string"), F.lit(".jsonl")).alias("path"))
    return history.annotate_logs(logs, a).select("user_id", "path", "n_events", "label")


TOLD = "'try CVE-2021-' || (1000 + k % 37) || ' and cve-2020-' || (2000 + k % 5)"


@query(EVENTS + f""", c AS (SELECT session_id, turn_index, 0 AS p, 'CVE-2021-' || (1000 + k % 37) AS cve FROM va WHERE k % 2 = 0 UNION ALL SELECT session_id, turn_index, 1, 'CVE-2020-' || (2000 + k % 5) FROM va WHERE k % 2 = 0),
 f AS (SELECT session_id, cve, min(turn_index * 2 + p) AS spot FROM c GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY spot) AS rn FROM f)
 SELECT session_id, string_agg(cve, ',' ORDER BY rn) AS cves FROM r WHERE rn <= 10 GROUP BY 1""")
def attempted_cve_list(spark, sf_dir) -> DataFrame:
    rows = events(spark, sf_dir).select("session_id", "turn_index", F.when(F.col("k") % 2 == 0, "EXPLOITATION").otherwise("RECON_WEAPONIZATION").alias("phase"), F.expr(TOLD).alias("text"))
    return history.attempted_cves(rows).select("session_id", F.array_join("cves", ",").alias("cves"))


@query(EVENTS + """SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY (k % 4 = 0) DESC, turn_index) AS place, '[' || tool_name || '] ' || CASE WHEN k % 4 = 0 THEN 'CVE-2021-1234' ELSE 'plain' END AS line FROM va WHERE k % 2 = 0 QUALIFY place <= 12""")
def phase_summaries(spark, sf_dir) -> DataFrame:
    text = F.when(F.col("k") % 4 == 0, "CVE-2021-1234").otherwise("plain")
    rows = events(spark, sf_dir).select("session_id", "turn_index", "tool_name", F.when(F.col("k") % 2 == 0, "EXPLOITATION").otherwise("OTHER").alias("phase"), text.alias("text"))
    return history.summaries(rows, history.EXPLOITING, 12, True)


_TOOLS = sorted(history.INSTALL)
_ENDS = ["", *history.ACTION_WORDS]
_HINTS = " ".join(f"WHEN '{name}' THEN '{hint}'" for name, hint in history.INSTALL.items())


@query(f"""WITH t AS (SELECT doc_id, {pick(f"doc_id % {len(_TOOLS)}", _TOOLS)} AS known, {pick(f"doc_id % {len(_ENDS)}", _ENDS)} AS ending FROM documents)
SELECT doc_id, CASE WHEN doc_id % 5 < 4 THEN CASE known {_HINTS} END END AS hint, CASE doc_id % 4 WHEN 0 THEN 'Apache' WHEN 1 THEN 'Nginx/PHP' WHEN 2 THEN 'mongo-express' ELSE 'Log4j' END AS family, CASE doc_id % 4 WHEN 0 THEN 7 + doc_id % 9 WHEN 1 THEN 3 END AS run FROM t""")
def remedies_and_families(spark, sf_dir) -> DataFrame:
    """Every tool of the table with every ending, by its own name, or by a name that the evidence quotes, or neither."""
    v = lambda *values: F.expr(pick("doc_id % 4", list(values)))
    known, ending = F.expr(pick(f"doc_id % {len(_TOOLS)}", _TOOLS)), F.expr(pick(f"doc_id % {len(_ENDS)}", _ENDS))
    way = F.col("doc_id") % 5
    tool = F.when(way < 3, F.initcap(F.concat(known, ending))).otherwise("odd tool")
    evidence = F.when(way == 3, F.concat(F.lit('no "'), known, F.lit('" here'))).otherwise("nothing 'Other' named")
    file = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("a_Run"), (7 + F.col("doc_id") % 9).cast("string"), F.lit(".jsonl"))).otherwise("b.jsonl")
    d = table(spark, sf_dir, "documents").select("doc_id", tool.alias("tool"), evidence.alias("evidence"), v("Apache Struts", "nginx 1.2", "Mongo-Express", "Log4j Core").alias("service"), file.alias("file"), v("第 1 / 3 次", "第 3 / 5 次", "", "").alias("told"))
    return d.select("doc_id", history.install_hint(F.col("tool"), F.col("evidence")).alias("hint"), history.service_family(F.col("service")).alias("family"), history.run_id(F.col("file"), F.col("told")).alias("run"))


@query(ROWS + ", tp AS (SELECT cluster, arg_max(exp_id, weight * 1e9 - exp_id) AS exp_id FROM wt WHERE layer = 'PROCEDURAL_NEG' GROUP BY 1), x AS (SELECT DISTINCT unnest(w.cves) AS cve, 'run ' || (w.exp_id % 3) AS command FROM wt w JOIN tp USING (exp_id)) SELECT cve, string_agg(command, ',' ORDER BY command) AS commands FROM x GROUP BY 1")
def cve_command_map(spark, sf_dir) -> DataFrame:
    rows = fusion.weigh(fusion.clusters(experiences(spark, sf_dir))).withColumn("command", F.concat(F.lit("run "), (F.col("exp_id") % 3).cast("string")))
    return history.cve_commands(rows, fusion.scored()).select("cve", F.array_join("commands", ",").alias("commands"))


@query("""SELECT account, greatest(0.0, 100.0 - since * 2) * 0.6 + least(recent * 10.0, 100.0) * 0.4 AS activity FROM (SELECT source AS account, min(doc_id % 90) AS since, count(*) FILTER (doc_id % 90 <= 30) AS recent FROM documents GROUP BY 1)""")
def account_recency(spark, sf_dir) -> DataFrame:
    day = F.date_sub(F.lit("2024-06-30").cast("date"), (F.col("doc_id") % 90).cast("int"))
    return history.activity(table(spark, sf_dir, "documents").select(F.col("source").alias("account"), day.alias("published")), F.lit("2024-06-30").cast("date"))
