"""Queries over service resolution, reflux, per-CVE status, script links, relevance and names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kenning.operators import corpus, evaluate, reflux, services
from kenning.plans.event_queries import EVENTS
from kenning.plans.experience_queries import ROWS
from kenning.plans.registry import query
from kenning.plans.views import events, experiences, pick, table
from kenning.sources import turns

RESOLVE = pick("doc_id % 4", ["nginx", "weblogic", "log4j", "apache tomcat"])


@query(f"SELECT doc_id AS id, {RESOLVE} AS resolved FROM documents")
def service_resolution(spark, sf_dir) -> DataFrame:
    i = F.col("doc_id") % 4
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.when(i == 0, "nginx/1.18.0").otherwise("unknown").alias("service"), F.when(i == 1, "http://h:7001/x").otherwise("http://h/").alias("url"),
        F.when(i == 3, "old Apache Tomcat and nginx here").otherwise("nothing").alias("text"), F.when(i == 2, F.array(F.lit("CVE-0"), F.lit("CVE-2021-44228"))).otherwise(F.array().cast("array<string>")).alias("cves"),
    )
    hints = spark.createDataFrame([("CVE-2021-44228", "log4j")], "cve string, service string")
    aliases = spark.createDataFrame([("Apache Tomcat", "apache tomcat"), ("nginx", "nginx"), (None, "x"), ("y", None)], "alias string, service string")
    return services.resolve(rows, hints, aliases).select("id", "resolved")


@query(ROWS + "SELECT exp_id, CASE layer WHEN 'FACTUAL' THEN 'facts' WHEN 'METACOGNITIVE' THEN 'lessons' WHEN 'CONCEPTUAL' THEN 'concepts' ELSE 'procedures' END AS dataset FROM vx WHERE lifecycle = 'active' AND maturity = 'consolidated' AND exp_id % 3 <> 0")
def reflux_candidates(spark, sf_dir) -> DataFrame:
    rows = experiences(spark, sf_dir).withColumn("refluxed", F.col("exp_id") % 3 == 0)
    return reflux.candidates(rows).select("exp_id", reflux.dataset(F.col("layer")).alias("dataset"))


@query(ROWS + "SELECT exp_id FROM vx WHERE lifecycle <> 'conflicted'")
def remove_conflicted(spark, sf_dir) -> DataFrame:
    rows = experiences(spark, sf_dir)
    return reflux.remove_conflicted(rows.select("exp_id"), rows)[0]


GIVEN = """concat('{"command": "run ', CAST(event_id AS VARCHAR(20)), '", "k": ', {k}, ', "steps": [{"payload": ["a", {"b": 1}], "commands": "kept"}], "note": "the command"}')"""


@query("WITH e AS (SELECT event_id, json_extract_string(props, '$.k') AS k FROM events) SELECT event_id, " + GIVEN.replace("{k}", "k") + """ AS given, '{"command": "[REDACTED]", "k": ' || k || ', "steps": [{"payload": "[REDACTED]", "commands": "kept"}], "note": "the command"}' AS safe FROM e""")
def sensitive_keys(spark, sf_dir) -> DataFrame:
    """Keys at any depth, with values of any kind; keys that only contain a sensitive word stay."""
    given = F.expr(GIVEN.replace("{k}", "get_json_object(props, '$.k')"))
    return table(spark, sf_dir, "events").select("event_id", given.alias("given"), reflux.strip_sensitive(given).alias("safe"))


@query("""SELECT event_id, replace(props, '"k"', '"cmd"') AS given, '{"cmd": "[REDACTED]"}' AS safe FROM events""")
def sensitive_keys_whole(spark, sf_dir) -> DataFrame:
    """sensitive_keys over the properties of all events."""
    given = F.replace("props", F.lit('"k"'), F.lit('"cmd"'))
    return table(spark, sf_dir, "events").select("event_id", given.alias("given"), reflux.strip_sensitive(given).alias("safe"))


STATUS = pick("k % 5", ["failure", "patched", "success", "partial", "unknown"])


@query(EVENTS + f", st AS (SELECT session_id, 'CVE-' || (k % 3) AS cve, {STATUS} AS status FROM va) SELECT session_id, cve, CASE WHEN bool_or(status = 'patched') THEN 'patched' WHEN bool_or(status = 'success') THEN 'success' WHEN bool_or(status = 'partial') THEN 'partial' WHEN bool_or(status = 'failure') THEN 'failure' ELSE 'unknown' END AS status, count(*) AS n FROM st GROUP BY ALL")
def cve_status_fold(spark, sf_dir) -> DataFrame:
    rows = events(spark, sf_dir).select("session_id", F.concat(F.lit("CVE-"), (F.col("k") % 3).cast("string")).alias("cve"), F.expr(STATUS).alias("status"))
    return evaluate.cve_status(rows)


@query(EVENTS + ", w AS (SELECT session_id, event_id, turn_index, '/tmp/f' || (k % 4) || '.py' AS filename FROM va WHERE category = 'CODE_WRITE'), r AS (SELECT session_id, event_id, turn_index, 'python3 ./f' || (k % 4) || '.py --x' AS command FROM va WHERE category <> 'CODE_WRITE') SELECT r.session_id, r.event_id, CAST(arg_max(w.event_id, w.turn_index) AS BIGINT) AS write_id FROM r JOIN w ON r.session_id = w.session_id AND contains(r.command, split_part(w.filename, '/', 3)) AND w.turn_index <= r.turn_index GROUP BY ALL")
def script_links(spark, sf_dir) -> DataFrame:
    e = events(spark, sf_dir)
    name = F.concat(F.lit("f"), (F.col("k") % 4).cast("string"), F.lit(".py"))
    write = F.col("category") == "CODE_WRITE"
    e = e.withColumn("filename", F.when(write, F.concat(F.lit("/tmp/"), name)).otherwise("")).withColumn("command", F.when(~write, F.concat(F.lit("python3 ./"), name, F.lit(" --x"))).otherwise(""))
    return turns.script_links(e)


_HEADS = pick("doc_id % 8", ["notes", "notes on SSRF", "峰会 招聘", "峰会", "x", "x", "x", "Apt C2"])
_BODIES = pick("doc_id % 8", ["CVE-2021-44228 nmap burp ", "", "exploit nmap ", "exploit nmap burp sqlmap ", "合作伙伴 市场拓展 nmap ", "nmap burp sqlmap mimikatz metasploit ctf ", "nmap burp ", "payload "])
_ALL = lambda of, words: "(" + " + ".join(f"CASE WHEN {of.format(w)} THEN 1 ELSE 0 END" for w in words) + ")"
_PLAIN = "regexp_replace(regexp_replace(lower({0}), '\\s+', '', 'g'), '[·•,，.。:：;；_/|()（）{{}}<>《》【】\"“”‘’`~!！?？''\\[\\]\\\\-]', '', 'g')"


@query(f"""WITH d AS (SELECT doc_id, {_HEADS} AS h, {_BODIES} || text AS b FROM documents), p AS (SELECT *, {_PLAIN.format("h")} AS ph, {_PLAIN.format("b")} AS pb, lower(h || chr(10) || b) AS w FROM d),
n AS (SELECT *, {_ALL("regexp_matches(w, '{}')", corpus.STRONG)} AS strong, {_ALL("regexp_matches(lower(h), '{}')", corpus.STRONG)} AS headed, {_ALL("contains(ph, '{0}') OR contains(pb, '{0}')", corpus.HINTS)} AS hints,
  {_ALL("contains(ph, '{}')", corpus.NOISE_TITLE)} AS advert, {_ALL("contains(b, '{}')", corpus.NOISE_TEXT)} AS trade FROM p)
SELECT doc_id, CASE WHEN length(b) < 260 THEN false WHEN advert > 0 AND headed = 0 AND hints < 3 THEN false WHEN trade >= 2 AND strong = 0 AND hints < 4 THEN false WHEN headed >= 1 THEN true WHEN strong >= 1 AND hints >= 2 THEN true ELSE hints >= 6 END AS relevant FROM n""")
def article_relevance(spark, sf_dir) -> DataFrame:
    """Whole texts under titles, and behind words, of every branch."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.expr(_HEADS).alias("title"), F.concat(F.expr(_BODIES), F.col("text")).alias("body"))
    return d.select("doc_id", corpus.relevant(F.col("title"), F.col("body")).alias("relevant"))


_FIRST = "split_part(text, ' ', 1)"
_SECOND = "CASE doc_id % 6 WHEN 0 THEN '【' || split_part(text, ' ', 1) || '】 实验室' WHEN 1 THEN 'The ' || split_part(text, ' ', 1) WHEN 2 THEN split_part(text, ' ', 2) WHEN 3 THEN '' WHEN 4 THEN split_part(text, ' ', 1) || '.' ELSE source END"
_CORE = "regexp_replace({0}, '(官方公众号|公众号|官方|研究院|研究中心|实验室|安全实验室|安全研究院)$', '')"


@query(f"""WITH d AS (SELECT doc_id, {_PLAIN.format(_SECOND)} AS x, {_PLAIN.format(_FIRST)} AS y FROM documents), c AS (SELECT *, {_CORE.format("x")} AS a, {_CORE.format("y")} AS b FROM d)
SELECT doc_id, x = '' OR x = y OR (a <> '' AND a = b) OR (least(length(a), length(b)) >= 3 AND (contains(a, b) OR contains(b, a))) AS same FROM c""")
def fuzzy_names(spark, sf_dir) -> DataFrame:
    """First words of the texts as names that were looked for, against spellings of them, other words and sources."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.expr(_SECOND).alias("a"), F.expr(_FIRST).alias("b"))
    return d.select("doc_id", corpus.same_name(F.col("a"), F.col("b")).alias("same"))


@query("SELECT page_id, '2024-0' || (1 + page_id % 9) || '-05' AS published FROM pages")
def page_publish_time(spark, sf_dir) -> DataFrame:
    day = F.concat(F.lit("2024-0"), (1 + F.col("page_id") % 9).cast("string"), F.lit("-05"))
    html = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit('<time class="x" datetime="'), day, F.lit('">'), "html")).otherwise(F.concat(F.lit('<meta property="article:published_time" content="'), day, F.lit('">'), "html"))
    return table(spark, sf_dir, "pages").select("page_id", corpus.publish_time(html).alias("published"))


_ENDS = pick("doc_id % 9", ["uid=0 via WebLogic ", "flag{x} by CVE-2018-7600 ", "reverse shell and root on solr ", "permission denied on weblogic ", "meterpreter ", "root but exploit failed ", "", "CVE_2017_10271 command executed, webshell ", "log4j root webshell "])
_AIM = pick("doc_id % 2", ["CVE-2017-10271", "CVE-2018-7600"])


@query(f"""WITH d AS (SELECT doc_id, {_AIM} AS t, lower({_ENDS} || text) AS e FROM documents),
n AS (SELECT *, {_ALL("contains(e, '{}')", evaluate.SUCCESS_SIGNS)} AS good, {_ALL("contains(e, '{}')", evaluate.FAILURE_SIGNS)} AS bad,
  CASE t WHEN 'CVE-2017-10271' THEN contains(e, 'weblogic') OR contains(e, 'wls-wsat') OR contains(e, 'coordinatorporttype') OR contains(e, 'cve-2017-10271') OR contains(e, 'cve_2017_10271') ELSE contains(e, 'drupal') OR contains(e, 'user/register') OR contains(e, 'cve-2018-7600') OR contains(e, 'cve_2018_7600') END AS mine,
  regexp_matches(e, 'solr|velocity|params.resource.loader.enabled|shiro|rememberme|druid|sampler|javascript|log4j|jndi|ldap|spring|class.module.classloader|gitlab|confluence|activemq|openwire') OR CASE t WHEN 'CVE-2017-10271' THEN regexp_matches(e, 'drupal|user/register|cve[-_]2018[-_]7600') ELSE regexp_matches(e, 'weblogic|wls-wsat|coordinatorporttype|cve[-_]2017[-_]10271') END AS others FROM d),
c AS (SELECT *, good >= 2 OR contains(e, 'uid=0') OR contains(e, 'flag{{') AS strong FROM n)
SELECT doc_id, CASE WHEN strong AND mine THEN 'success' WHEN strong AND others THEN 'failure' WHEN good > 0 AND bad = 0 THEN 'possible_success' WHEN bad > 0 AND good = 0 THEN 'failure' ELSE 'possible_success' END AS status,
 CAST(CASE WHEN strong AND mine THEN 0.8 WHEN strong AND others THEN 0.75 WHEN good > 0 AND bad = 0 THEN 0.55 WHEN bad > 0 AND good = 0 THEN 0.7 ELSE 0.4 END AS DOUBLE) AS confidence, strong AND others AND NOT mine AS off_target_success, mine AS matched_target FROM c""")
def heuristic_verdicts(spark, sf_dir) -> DataFrame:
    """Whole texts behind evidence of every case, against two targets in turn."""
    d = table(spark, sf_dir, "documents").select("doc_id", evaluate.judge(F.concat(F.expr(_ENDS), F.col("text")), F.expr(_AIM)).alias("j"))
    return d.select("doc_id", "j.status", "j.confidence", "j.off_target_success", "j.matched_target")
