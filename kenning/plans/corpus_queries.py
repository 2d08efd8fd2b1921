"""Queries over STIX objects, run costs, candidates and code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kenning.functions import text as tx
from kenning.operators import attack, corpus, runs
from kenning.plans.registry import query
from kenning.plans.views import pick, table

_TECHNIQUE = """concat('{"type":"', CASE WHEN s_suppkey % 7 = 0 THEN 'malware' ELSE 'attack-pattern' END, '","id":"t', CAST(s_suppkey AS VARCHAR(20)), '","name":"', s_name, '","x_mitre_is_subtechnique":', CASE WHEN s_suppkey % 3 = 1 THEN 'true' ELSE 'false' END,
 ',"x_mitre_parent_technique_ref":"t', CAST(s_suppkey - 1 AS VARCHAR(20)), '","kill_chain_phases":[{"kill_chain_name":"mitre-attack","phase_name":"p', CAST(s_suppkey % 4 AS VARCHAR(20)), '"},{"kill_chain_name":"other","phase_name":"p0"}],"external_references":[{"source_name":"x","external_id":"no"}',
 CASE WHEN s_suppkey % 5 = 4 THEN '' ELSE concat(',{"source_name":"mitre-attack","external_id":"T', CAST(s_suppkey AS VARCHAR(20)), '","url":"u"}') END, ']}')"""


def _bundles(spark, sf_dir) -> DataFrame:
    """A bundle per two nations: suppliers as techniques and malware, four tactics, a collection."""
    s = table(spark, sf_dir, "supplier").select((F.col("s_nationkey") % 2).alias("k"), F.expr(_TECHNIQUE.replace("VARCHAR(20)", "STRING")).alias("o"))
    tactics = F.array(*[F.lit(f'{{"type":"x-mitre-tactic","id":"x{i}","name":"tactic {i}","x_mitre_shortname":"p{i}","external_references":[{{"source_name":"mitre-attack","external_id":"TA{i}"}}]}}') for i in range(4)])
    collection = F.array(F.lit('{"type":"x-mitre-collection","id":"c","x_mitre_version":"14.1"}'))
    bundle = s.groupBy("k").agg(F.concat(F.collect_list("o"), tactics, collection).alias("all"))
    return bundle.select(F.concat(F.lit("d"), F.col("k").cast("string")).alias("domain"), F.concat(F.lit('{"objects":['), F.array_join("all", ","), F.lit("]}")).alias("value"))


TECHNIQUES = """WITH t AS (SELECT 'd' || (s_nationkey % 2) AS domain, 'T' || s_suppkey AS id, s_suppkey, s_name AS name, s_suppkey % 3 = 1 AS is_subtechnique FROM supplier WHERE s_suppkey % 7 <> 0 AND s_suppkey % 5 <> 4)"""


@query(TECHNIQUES + " SELECT a.domain, a.id, a.name, a.is_subtechnique, CASE WHEN a.is_subtechnique THEN b.id END AS parent_id FROM t a LEFT JOIN t b ON a.domain = b.domain AND b.s_suppkey = a.s_suppkey - 1")
def technique_parents(spark, sf_dir) -> DataFrame:
    return attack.with_parents(attack.of_kind(attack.objects(_bundles(spark, sf_dir)), "techniques")).select("domain", "id", "name", "is_subtechnique", "parent_id")


@query(TECHNIQUES + " SELECT domain, id AS technique_id, 'TA' || (s_suppkey % 4) AS tactic_id FROM t")
def technique_tactics(spark, sf_dir) -> DataFrame:
    found = attack.objects(_bundles(spark, sf_dir))
    return attack.technique_tactics(attack.of_kind(found, "techniques"), attack.of_kind(found, "tactics"))


@query("""WITH o AS (SELECT 'd' || (s_nationkey % 2) AS domain, CASE WHEN s_suppkey % 7 = 0 THEN 'malware' ELSE 'attack-pattern' END AS type FROM supplier), d AS (SELECT DISTINCT domain FROM o),
 a AS (SELECT * FROM o UNION ALL SELECT domain, 'x-mitre-tactic' FROM d, range(4) UNION ALL SELECT domain, 'x-mitre-collection' FROM d) SELECT domain, type, count(*) AS n FROM a GROUP BY ROLLUP (domain, type)""")
def bundle_summary(spark, sf_dir) -> DataFrame:
    return attack.summary(attack.objects(_bundles(spark, sf_dir)))


@query("SELECT DISTINCT 'd' || (s_nationkey % 2) AS domain, '14.1' AS version FROM supplier")
def bundle_versions(spark, sf_dir) -> DataFrame:
    return attack.versions(attack.objects(_bundles(spark, sf_dir)))


@query("SELECT 'd' || (s_nationkey % 2) AS domain, 't' || s_suppkey AS id FROM supplier WHERE s_suppkey % 7 = 0")
def objects_by_keyword(spark, sf_dir) -> DataFrame:
    return attack.mentioning(attack.objects(_bundles(spark, sf_dir)), F.lit("MALWARE")).select("domain", "id")


RAW = """CASE WHEN event_type = 'error' THEN concat('{"event":"session_end","cost":{"total_cost":', CAST(event_id % 9 AS VARCHAR(20)), '}}') WHEN event_type = 'view' THEN '{"event":"user_message"}'
 ELSE concat('{"object":"chat.completion","created":', CAST(event_id AS VARCHAR(20)), ',"cost":{"total_cost":', CASE WHEN user_id % 2 = 0 THEN '0' ELSE CAST(event_id % 7 AS VARCHAR(20)) END, ',"interaction_cost":1},"choices":[{"message":{"content":"', CASE WHEN event_id % 5 = 0 THEN ' ' ELSE concat('c', CAST(event_id AS VARCHAR(20))) END, '"}}]}') END"""


@query("""WITH e AS (SELECT *, event_type NOT IN ('error', 'view') AS done FROM events WHERE user_id % 3 > 0 OR event_type <> 'error'),
 p AS (SELECT 'u' || user_id AS source_file, count(*) FILTER (done) AS completions, CASE WHEN count(*) FILTER (done) >= 2 THEN CAST(max(event_id) FILTER (done) - min(event_id) FILTER (done) AS DOUBLE) END AS seconds,
   CAST(arg_max(event_id % 9, event_id) FILTER (event_type = 'error') AS DOUBLE) AS closed, CAST(max(CASE WHEN user_id % 2 = 0 THEN 0 ELSE event_id % 7 END) FILTER (done) AS DOUBLE) AS top, CAST(count(*) FILTER (done) AS DOUBLE) AS single,
   coalesce(arg_max('c' || event_id, event_id) FILTER (done AND event_id % 5 <> 0), '') AS final_text FROM e GROUP BY user_id)
 SELECT source_file, completions, seconds, coalesce(closed, CASE WHEN top = 0 AND single > 0 THEN single ELSE coalesce(top, single) END) AS total_cost, final_text FROM p""")
def run_costs(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events").filter("user_id % 3 > 0 OR event_type <> 'error'")
    return runs.log_costs(e.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("source_file"), F.col("event_id").alias("line_no"), F.expr(RAW.replace("VARCHAR(20)", "STRING")).alias("raw")))


@query("SELECT doc_id, CAST(CASE doc_id % 4 WHEN 0 THEN 38 WHEN 1 THEN 15 WHEN 2 THEN 26 ELSE 5 END AS DOUBLE) AS score FROM documents")
def candidate_quick_score(spark, sf_dir) -> DataFrame:
    v = lambda *values: F.expr(pick("doc_id % 4", list(values)))
    d = table(spark, sf_dir, "documents").select("doc_id", v("Security lab", "cert desk", "CTF x", "plain").alias("name"), v("community_regex", "citation_biz", "community_regex", "rumour").alias("source"), v("long enough to count here", "", "", "long enough to count here").alias("about"))
    return d.select("doc_id", corpus.quick_score(F.col("name"), F.col("source"), F.col("about")).alias("score"))


@query(f"""WITH c AS (SELECT doc_id AS ord, CASE WHEN doc_id % 3 = 0 THEN 'b' || (doc_id % 11) ELSE '' END AS biz, 'n' || (doc_id % 17) AS name, {pick("doc_id % 4", ["community", "citation", "sogou", "else"])} AS channel FROM documents)
 SELECT ord, biz, name, channel FROM c QUALIFY row_number() OVER (PARTITION BY CASE WHEN biz = '' THEN name ELSE biz END ORDER BY CASE channel WHEN 'sogou' THEN 1 WHEN 'citation' THEN 2 WHEN 'community' THEN 3 ELSE 4 END, ord) = 1""")
def channel_union(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents").selectExpr("doc_id AS ord", "CASE WHEN doc_id % 3 = 0 THEN concat('b', doc_id % 11) ELSE '' END AS biz", "concat('n', doc_id % 17) AS name", f"{pick('doc_id % 4', ['community', 'citation', 'sogou', 'else'])} AS channel")
    return corpus.first_channel(d).select("ord", "biz", "name", "channel")


@query(f"SELECT doc_id, {pick('doc_id % 5', ['nmap', 'my tool', 'x.exe', '', 'ls'])} AS word FROM documents")
def command_first_word(spark, sf_dir) -> DataFrame:
    command = F.expr(pick("doc_id % 5", ["/usr/bin/Nmap -sV", ' "/opt/My Tool" -x', "C:\\\\bin\\\\X.exe /q", "  ", "ls"]))
    return table(spark, sf_dir, "documents").select("doc_id", tx.first_word(command).alias("word"))


@query("""SELECT doc_id, CASE WHEN length(c) <= 2000 THEN c ELSE 'import os' || chr(10) || '  port = 80' || chr(10) || '# CVE-2021-1 ' || repeat('z', 100) END AS summary
 FROM (SELECT doc_id, 'import os' || chr(10) || repeat('x', CAST(n_chars % 3000 AS INT)) || chr(10) || '  port = 80' || chr(10) || '# CVE-2021-1 ' || repeat('z', 100) AS c FROM documents)""")
def long_code_summary(spark, sf_dir) -> DataFrame:
    code = F.concat(F.lit("import os\n"), F.expr("repeat('x', CAST(n_chars % 3000 AS INT))"), F.lit("\n  port = 80\n# CVE-2021-1 " + "z" * 100))
    return table(spark, sf_dir, "documents").select("doc_id", tx.code_summary(code).alias("summary"))
