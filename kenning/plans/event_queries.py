"""Queries over tool-call events: rules, verdicts, causes, session rollups, windows, evaluation, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kenning.functions import text as tx
from kenning.operators import annotate, evaluate
from kenning.plans.registry import query
from kenning.plans.views import ORACLE_EVENT, events, pick, table
from kenning.sources import turns
from kenning.streaming import windows

PROGRAMS = pick("k % 6", ["nmap", "curl", "python3", "sqlmap", "hydra", "ls"])
#: The event view and its annotation, written independently of the operators.
EVENTS = f"""WITH ve AS (SELECT *, CASE WHEN tool_name = 'error' THEN err_text ELSE out_text END AS txt, return_code = 0 AS success FROM ({ORACLE_EVENT})),
vs AS (SELECT *,
    regexp_matches(txt, '(?i)uid\\s*=\\s*0|root@|flag\\s*\\{{|access\\s+granted|authentication\\s+successful') AS good,
    regexp_matches(txt, '(?i)\\btime(d)?\\s*out\\b') AS late,
    regexp_matches(txt, '(?i)permission denied|not found|401 unauthorized|http/1\\.1 500|http/1\\.1 403|status code: 40|traceback|already patched|\\b(401|403|404|500)\\b')
      OR regexp_matches(regexp_replace(txt, '(?i)no\\s(errors?|failed|failure)\\b', ' ', 'g'), '(?i)\\b(errors?|failed|failure)\\b') AS bad,
    CASE WHEN NOT has_result THEN NULL WHEN return_code = 127 THEN 'RC-127' WHEN return_code = 126 THEN 'RC-126'
         WHEN return_code = 124 THEN 'RC-124' WHEN return_code = 130 THEN 'RC-130' WHEN return_code = 137 THEN 'RC-137'
         WHEN return_code = 143 THEN 'RC-143' WHEN timed_out THEN 'TOUT' END AS rule_name,
    {PROGRAMS} AS program FROM ve),
vo AS (SELECT *, CASE WHEN NOT has_result THEN 'uncertain' WHEN timed_out OR late THEN 'timeout' WHEN good THEN 'partial_success' WHEN bad THEN 'failure'
         WHEN coalesce(return_code = 0, false) THEN 'success' WHEN coalesce(return_code <> 0, false) THEN 'failure' ELSE 'uncertain' END AS outcome_label,
    CASE category WHEN 'RAG_QUERY' THEN 'RECON_WEAPONIZATION'
         WHEN 'CODE_WRITE' THEN CASE WHEN k % 3 IN (0, 2) THEN 'EXPLOITATION' ELSE 'RECON_WEAPONIZATION' END
         WHEN 'GENERIC_COMMAND_CALL' THEN CASE WHEN program IN ('nmap', 'curl') THEN 'RECON_WEAPONIZATION' WHEN program IN ('python3', 'sqlmap', 'hydra') THEN 'EXPLOITATION' ELSE 'ENV_PREPARATION' END
         ELSE 'ENV_PREPARATION' END AS phase FROM vs),
va AS (SELECT *, CASE WHEN NOT has_result THEN NULL WHEN timed_out OR late THEN 'ENV/TIMEOUT' WHEN txt ILIKE '%401 unauthorized%' THEN 'DEF/AUTHENTICATION'
         WHEN txt ILIKE '%http/1.1 403%' THEN 'DEF/AUTHORIZATION' WHEN txt ILIKE '%status code: 404%' THEN 'INT/TARGET_NOT_FOUND'
         WHEN txt ILIKE '%http/1.1 500%' OR txt ILIKE '%already patched%' THEN 'DEF/PATCHED_OR_HARDENED' WHEN txt ILIKE '%permission denied%' THEN 'ENV/PERMISSION'
         WHEN txt ILIKE '%traceback%' THEN 'INV/EXECUTION_ERROR' WHEN coalesce(return_code <> 0, false) THEN 'INV/WRONG_ARGS' ELSE 'EFF/OUTPUT_LOST' END AS fallback,
    has_result AND rule_name IS NULL AND (coalesce(return_code <> 0, false) OR (outcome_label = 'failure' AND (return_code IS NULL OR return_code = 0))) AS needs_cause FROM vo)
"""


@query(EVENTS + """SELECT event_id, rule_name, CASE WHEN rule_name = 'TOUT' THEN 'timed_out=true' ELSE 'return_code=' || return_code || ' (' || CASE WHEN return_code = 127 AND err_text LIKE '%: not found%' THEN 'binary=' || split_part(err_text, ':', 1) || ', ' ELSE '' END || 'tool=' || tool_name || ')' END AS evidence,
 CASE rule_name WHEN 'RC-127' THEN 'BINARY_MISSING' WHEN 'RC-126' THEN 'EXECUTE_PERMISSION_DENIED' WHEN 'RC-130' THEN 'INTERRUPTED' WHEN 'RC-137' THEN 'SIGKILL' WHEN 'RC-143' THEN 'SIGTERM' ELSE 'TIMEOUT' END AS sub_dimension FROM va WHERE rule_name IS NOT NULL""")
def rule_first_match(spark, sf_dir) -> DataFrame:
    hit = annotate.rule_hit()
    return events(spark, sf_dir).withColumn("r", hit).filter("r is not null").select("event_id", F.col("r.rule").alias("rule_name"), F.col("r.evidence").alias("evidence"), F.col("r.sub_dimension").alias("sub_dimension"))


@query(EVENTS + "SELECT tool_name, count(*) AS n_events, count(rule_name) AS n_rule, CAST(sum(CASE WHEN needs_cause THEN 1 ELSE 0 END) AS BIGINT) AS n_pending FROM va GROUP BY tool_name")
def rule_hit_counters(spark, sf_dir) -> DataFrame:
    a = annotate.annotate(events(spark, sf_dir))
    return a.groupBy("tool_name").agg(F.count(F.lit(1)).alias("n_events"), F.count("rule").alias("n_rule"), F.sum(F.col("needs_cause").cast("int")).alias("n_pending"))


@query(EVENTS + "SELECT event_id FROM va WHERE needs_cause")
def pending_cause_predicate(spark, sf_dir) -> DataFrame:
    return events(spark, sf_dir).filter(annotate.pending_cause()).select("event_id")


@query(EVENTS + "SELECT event_id, outcome_label, phase FROM va")
def outcome_classifier(spark, sf_dir) -> DataFrame:
    return annotate.annotate(events(spark, sf_dir)).select("event_id", "outcome_label", "phase")


@query(EVENTS + "SELECT event_id, fallback FROM va WHERE fallback IS NOT NULL")
def fallback_root_cause(spark, sf_dir) -> DataFrame:
    return events(spark, sf_dir).withColumn("c", annotate.fallback_cause()).filter("c is not null").select("event_id", F.concat_ws("/", "c.dimension", "c.sub_dimension").alias("fallback"))


@query(EVENTS + """SELECT session_id, CASE WHEN bool_or(has_result AND good) THEN 'success' WHEN bool_or(outcome_label IN ('success','partial_success')) THEN 'partial_success' ELSE 'failure' END AS session_outcome,
 count(*) AS n_events, CAST(sum(CASE WHEN outcome_label IN ('success','partial_success') THEN 1 ELSE 0 END) AS BIGINT) AS n_good, CAST(sum(CASE WHEN outcome_label = 'failure' THEN 1 ELSE 0 END) AS BIGINT) AS n_failure FROM va GROUP BY session_id""")
def session_outcome_rollup(spark, sf_dir) -> DataFrame:
    return annotate.session_outcome(annotate.annotate(events(spark, sf_dir))).select("session_id", "session_outcome", "n_events", "n_good", "n_failure")


@query(EVENTS + "SELECT tool_name, outcome_label, count(*) AS n, round(count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY tool_name), 6) AS share FROM va GROUP BY tool_name, outcome_label")
def outcome_by_tool(spark, sf_dir) -> DataFrame:
    counted = annotate.annotate(events(spark, sf_dir)).groupBy("tool_name", "outcome_label").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("tool_name")), 6))


@query(EVENTS + """SELECT e.event_id, max(q.turn_index) AS query_turn, arg_max(q.event_id, q.turn_index) AS query_id FROM va e JOIN va q ON q.session_id = e.session_id AND q.category = 'RAG_QUERY' AND q.turn_index BETWEEN e.turn_index - 3 AND e.turn_index - 1 GROUP BY e.event_id""")
def rag_lookback3(spark, sf_dir) -> DataFrame:
    return turns.lookback(events(spark, sf_dir), 3).filter("query_id is not null").select("event_id", "query_turn", "query_id")


@query(EVENTS + """SELECT e.event_id, max(q.turn_index) AS query_turn FROM va e JOIN va q ON q.session_id = e.session_id AND q.category = 'RAG_QUERY' AND q.turn_index < e.turn_index GROUP BY e.event_id""")
def nearest_prior_query(spark, sf_dir) -> DataFrame:
    return turns.lookback(events(spark, sf_dir), None).filter("query_id is not null").select("event_id", "query_turn")


@query("""WITH t AS (SELECT *, sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) - 1 AS turn_index FROM conversations)
SELECT conv_id, CAST(turn_index AS BIGINT) AS turn_index, count(*) AS n_rows, min(turn) AS first_turn, max(turn) AS last_turn FROM t WHERE turn_index >= 0 GROUP BY conv_id, turn_index""")
def turn_rebuild(spark, sf_dir) -> DataFrame:
    numbered = turns.number(table(spark, sf_dir, "conversations"), "conv_id", ["turn"], F.col("role") == "assistant")
    return numbered.filter("turn_index >= 0").groupBy("conv_id", "turn_index").agg(F.count(F.lit(1)).alias("n_rows"), F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"))


@query("""SELECT conv_id, turn, CAST(i AS BIGINT) AS slot, word FROM (SELECT conv_id, turn, unnest(string_split(text, ' ')[1:3]) AS word, generate_subscripts(string_split(text, ' ')[1:3], 1) - 1 AS i FROM conversations)""")
def slot_explode(spark, sf_dir) -> DataFrame:
    words = F.slice(F.split("text", " "), 1, 3)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(words).alias("slot", "word"))


@query(EVENTS + "SELECT session_id, CAST(k AS BIGINT) AS k, max(turn_index) AS turn_index, arg_max(outcome_label, turn_index) AS outcome_label FROM va GROUP BY session_id, k")
def last_result_wins(spark, sf_dir) -> DataFrame:
    return turns.last_wins(annotate.annotate(events(spark, sf_dir)), ["session_id", "k"], ["turn_index"], ["turn_index", "outcome_label"])


@query(EVENTS + """SELECT session_id, count(*) AS n_events, count(DISTINCT tool_name) AS n_tools, CAST(sum(CASE WHEN category='RAG_QUERY' THEN 1 ELSE 0 END) AS BIGINT) AS n_rag, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ended, arg_min(tool_name, turn_index) AS first_tool FROM va GROUP BY session_id""")
def session_metadata_rollup(spark, sf_dir) -> DataFrame:
    fmt = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return events(spark, sf_dir).groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_distinct("tool_name").alias("n_tools"), F.sum((F.col("category") == "RAG_QUERY").cast("int")).alias("n_rag"),
        fmt(F.min("ts")).alias("started"), fmt(F.max("ts")).alias("ended"), F.min_by("tool_name", "turn_index").alias("first_tool"),
    )


@query(EVENTS + "SELECT event_id, program FROM va")
def program_name(spark, sf_dir) -> DataFrame:
    return events(spark, sf_dir).select("event_id", tx.program_name(F.col("command")).alias("program"))


@query(EVENTS + "SELECT event_id, CASE WHEN code LIKE '%CVE%' THEN 'CVE-2021-44228' ELSE '' END AS cves FROM va WHERE category = 'CODE_WRITE'")
def cve_extract(spark, sf_dir) -> DataFrame:
    return events(spark, sf_dir).filter("category = 'CODE_WRITE'").select("event_id", F.array_join(tx.cves(F.col("code")), ",").alias("cves"))


@query(EVENTS + "SELECT event_id, regexp_replace(command, '\\b[0-9]{1,3}(\\.[0-9]{1,3}){3}\\b', '<IP>', 'g') AS command, CASE WHEN k % 6 IN (0,1,2,4) THEN 'private' ELSE 'none' END AS topology FROM va")
def ip_sanitise(spark, sf_dir) -> DataFrame:
    return events(spark, sf_dir).select("event_id", tx.sanitise_ip(F.col("command")).alias("command"), tx.ip_topology(F.col("command")).alias("topology"))


@query(EVENTS + f"""SELECT event_id, {pick("k % 6", ["nmap -sV {TARGET_IP} -p 8080", "sudo timeout 30 curl http://{TARGET_IP}:{PORT}/x", "python3 exploit.py --target {TARGET_IP}", "FOO=1 env sqlmap -u http://h/?id=1", "/usr/bin/hydra -l root ssh://{TARGET_IP}", "ls -la"])} AS template FROM va""")
def command_template(spark, sf_dir) -> DataFrame:
    return events(spark, sf_dir).select("event_id", tx.parameterise(F.col("command")).alias("template"))


@query(EVENTS + "SELECT session_id, count(DISTINCT phase) AS n_touched, count(DISTINCT CASE WHEN outcome_label IN ('success','partial_success','uncertain') THEN phase END) AS n_covered, round(count(DISTINCT CASE WHEN outcome_label IN ('success','partial_success','uncertain') THEN phase END) / 7.0, 6) AS coverage FROM va GROUP BY session_id")
def stage_coverage(spark, sf_dir) -> DataFrame:
    return evaluate.stage_coverage(annotate.annotate(events(spark, sf_dir)))


@query(EVENTS + """SELECT session_id, coalesce(min(CASE WHEN phase = 'EXPLOITATION' AND outcome_label IN ('success','partial_success') THEN turn_index + 1 END), min(CASE WHEN phase = 'EXPLOITATION' AND outcome_label <> 'failure' THEN turn_index + 1 END)) AS first_step FROM va GROUP BY session_id""")
def first_success_step(spark, sf_dir) -> DataFrame:
    return evaluate.first_success_step(annotate.annotate(events(spark, sf_dir)))


SESSIONS = EVENTS + """, so AS (SELECT session_id, CASE WHEN min(user_id) % 2 = 0 THEN 'raw' ELSE 'treated' END AS grp, 'C' || (min(user_id) % 5) AS cve, CASE WHEN bool_or(has_result AND good) THEN 'success' WHEN bool_or(outcome_label IN ('success','partial_success')) THEN 'partial_success' ELSE 'failure' END AS session_outcome, count(*) AS n_events FROM va GROUP BY session_id),
sc AS (SELECT *, CASE session_outcome WHEN 'success' THEN 1.0 WHEN 'partial_success' THEN 0.5 ELSE 0.0 END AS score FROM so)
"""


def _sessions(spark, sf_dir) -> DataFrame:
    a = annotate.annotate(events(spark, sf_dir))
    users = a.groupBy("session_id").agg(F.min("user_id").alias("u"))
    named = users.select("session_id", F.when(F.col("u") % 2 == 0, "raw").otherwise("treated").alias("grp"), F.concat(F.lit("C"), (F.col("u") % 5).cast("string")).alias("cve"))
    return annotate.session_outcome(a).join(named, "session_id")


@query(SESSIONS + "SELECT grp, cve, count(*) AS n_sessions, round(avg(score), 6) AS weighted_rate, round(avg(CASE WHEN session_outcome = 'success' THEN 1.0 ELSE 0.0 END), 6) AS strict_rate, CAST(sum(n_events) AS BIGINT) AS n_events, round(sum(n_events) / nullif(sum(score), 0), 6) AS events_per_success FROM sc GROUP BY ROLLUP (grp, cve)")
def group_cve_rollup(spark, sf_dir) -> DataFrame:
    return evaluate.group_rollup(_sessions(spark, sf_dir), "grp", "cve")


@query(SESSIONS + """, a AS (SELECT cve, round(avg(n_events), 6) AS n_events_raw FROM sc WHERE grp = 'raw' GROUP BY cve), b AS (SELECT cve, round(avg(n_events), 6) AS n_events_treated FROM sc WHERE grp = 'treated' GROUP BY cve)
SELECT coalesce(a.cve, b.cve) AS cve, n_events_raw, n_events_treated, round(n_events_treated - n_events_raw, 6) AS delta FROM a FULL JOIN b ON a.cve = b.cve""")
def group_comparison_full_outer(spark, sf_dir) -> DataFrame:
    return evaluate.compare_groups(_sessions(spark, sf_dir), "cve", "n_events", "raw", "treated")


@query(EVENTS + """, l AS (SELECT *, lag(txt) OVER (PARTITION BY session_id ORDER BY turn_index) AS prev FROM va), m AS (SELECT session_id, txt AS line, turn_index, row_number() OVER (PARTITION BY session_id ORDER BY turn_index) AS nth FROM l WHERE prev IS DISTINCT FROM txt) SELECT session_id, line, nth FROM m WHERE nth <= 5""")
def evidence_run_dedupe(spark, sf_dir) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("txt", F.concat("stdout", "stderr"))
    return evaluate.evidence_lines(rows, "session_id", ["turn_index"], "txt").select("session_id", "line", "nth")


@query(EVENTS + ", n AS (SELECT event_id, session_id, turn_index, count(*) OVER (PARTITION BY session_id) AS c FROM va) SELECT event_id FROM n WHERE turn_index < 3 OR turn_index >= c - 2")
def head_tail_sample(spark, sf_dir) -> DataFrame:
    return evaluate.head_tail(events(spark, sf_dir), "session_id", ["turn_index"], 3, 2).select("event_id")


@query(EVENTS + "SELECT session_id, arg_max(phase, c * 10000 - o) AS stuck_phase, CAST(max(c) AS BIGINT) AS n FROM (SELECT session_id, phase, count(*) AS c, CASE phase WHEN 'ENV_PREPARATION' THEN 1 WHEN 'EXPLOITATION' THEN 2 ELSE 3 END AS o FROM va GROUP BY session_id, phase) GROUP BY session_id")
def stuck_phase(spark, sf_dir) -> DataFrame:
    counted = annotate.annotate(events(spark, sf_dir)).groupBy("session_id", "phase").agg(F.count(F.lit(1)).alias("c"))
    order = F.when(F.col("phase") == "ENV_PREPARATION", 1).when(F.col("phase") == "EXPLOITATION", 2).otherwise(3)
    return counted.groupBy("session_id").agg(F.max_by("phase", F.col("c") * 10000 - order).alias("stuck_phase"), F.max("c").alias("n"))


@query(EVENTS + "SELECT fallback AS cause, count(*) AS n FROM va WHERE needs_cause GROUP BY fallback")
def cause_histogram(spark, sf_dir) -> DataFrame:
    a = annotate.annotate(events(spark, sf_dir)).filter("needs_cause")
    return a.groupBy(F.concat_ws("/", "cause.dimension", "cause.sub_dimension").alias("cause")).agg(F.count(F.lit(1)).alias("n"))


@query(EVENTS + "SELECT session_id FROM va GROUP BY session_id HAVING sum(CASE WHEN phase = 'EXPLOITATION' AND outcome_label IN ('success','partial_success') THEN 1 ELSE 0 END) >= 2 OR sum(CASE WHEN rule_name IS NOT NULL OR needs_cause THEN 1 ELSE 0 END) >= 3")
def conceptual_trigger(spark, sf_dir) -> DataFrame:
    a = annotate.annotate(events(spark, sf_dir))
    good = F.sum(((F.col("phase").isin("EXPLOITATION", "ESCALATION")) & F.col("outcome_label").isin("success", "partial_success")).cast("int"))
    failed = F.sum(F.col("cause").isNotNull().cast("int"))
    return a.groupBy("session_id").agg(good.alias("g"), failed.alias("f")).filter("g >= 2 OR f >= 3").select("session_id")


@query("SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def tumbling_counts(spark, sf_dir) -> DataFrame:
    out = windows.tumbling(table(spark, sf_dir, "events"))
    return out.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm"))


@query("SELECT strftime(b - INTERVAL 1 HOUR * o, '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS b, event_type FROM events), (SELECT unnest([0, 1]) AS o) GROUP BY ALL")
def sliding_counts(spark, sf_dir) -> DataFrame:
    out = windows.sliding(table(spark, sf_dir, "events"))
    return out.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm"))


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
r AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM r GROUP BY user_id, run""")
def session_windows(spark, sf_dir) -> DataFrame:
    out = windows.sessions(table(spark, sf_dir, "events"))
    return out.select("user_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query("SELECT user_id, event_type, count(*) AS n FROM (SELECT DISTINCT user_id, event_type, props FROM events) GROUP BY ALL")
def stream_dedupe(spark, sf_dir) -> DataFrame:
    return windows.dedupe(table(spark, sf_dir, "events"), ["user_id", "event_type", "props"]).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT c.c_custkey, n.n_name, r.r_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""")
def relationship_two_hop(spark, sf_dir) -> DataFrame:
    from kenning.operators.corpus import related

    c, n, r = (table(spark, sf_dir, x) for x in ("customer", "nation", "region"))
    key = lambda p, k: F.concat(F.lit(p), F.col(k).cast("string"))
    objects = c.select(key("c", "c_custkey").alias("id"), F.col("c_custkey").cast("string").alias("name"), F.lit("customer").alias("type"))
    objects = objects.union(n.select(key("n", "n_nationkey"), "n_name", F.lit("nation"))).union(r.select(key("r", "r_regionkey"), "r_name", F.lit("region")))
    edges = c.select(key("c", "c_custkey").alias("source_ref"), key("n", "c_nationkey").alias("target_ref"), F.lit("lives-in").alias("relationship_type"))
    edges = edges.union(n.select(key("n", "n_nationkey"), key("r", "n_regionkey"), F.lit("part-of")))
    one, two = related(edges, objects, "lives-in"), related(edges, objects, "part-of")
    return one.join(two.select(F.col("source_ref").alias("target_ref"), F.col("target_name").alias("r_name")), "target_ref").select(F.col("source_name").cast("long").alias("c_custkey"), F.col("target_name").alias("n_name"), "r_name")
