"""Deterministic views of the fixture tables that stand in for agent logs.

Each view is one SELECT in the dialect that Spark and DuckDB share, so that a query and its oracle start from the same
rows; what differs (JSON access, concat, which passes over nulls in DuckDB only) is filled in per engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def pick(index: str, values: list[str]) -> str:
    """CASE over 0, 1, ... giving string literals."""
    return f"CASE {index} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


STDERR = ["tool3: not found", "permission denied", "operation timed out", "HTTP 401 unauthorized", "HTTP/1.1 403", "status code: 404", "HTTP/1.1 500", "already patched", "Traceback: error in line", "plain text"]
STDOUT = ["uid=0(root)", "HTTP/1.1 200 OK", "done", "root@host", "access granted", "no errors found", "read timeout"]
COMMANDS = ["nmap -sV 10.0.0.5 -p 8080", "sudo timeout 30 curl http://10.1.2.3:8443/x", "python3 exploit.py --target 192.168.1.9", "FOO=1 env sqlmap -u http://h/?id=1", "/usr/bin/hydra -l root ssh://172.16.0.2", "ls -la"]
CODES = ["import requests # CVE-2021-44228 exploit", "print(1)", "payload = 1"]
LAYERS = ["FACTUAL", "PROCEDURAL_POS", "PROCEDURAL_NEG", "METACOGNITIVE", "CONCEPTUAL"]

EVENT = f"""
SELECT *, {pick("k % 10", STDERR)} AS err_text, {pick("k % 7", STDOUT)} AS out_text,
       row_number() OVER (PARTITION BY session_id ORDER BY ts, event_id) - 1 AS turn_index,
       CASE WHEN tool_name = 'error' THEN CASE k % 7 WHEN 0 THEN 127 WHEN 1 THEN 126 WHEN 2 THEN 124 WHEN 3 THEN 130
                                          WHEN 4 THEN 137 WHEN 5 THEN 143 ELSE 1 END
            WHEN k % 11 = 0 THEN NULL ELSE 0 END AS return_code,
       tool_name = 'error' AND k % 13 = 0 AS timed_out,
       k % 19 <> 0 AS has_result,
       CASE tool_name WHEN 'view' THEN 'RAG_QUERY' WHEN 'click' THEN 'GENERIC_COMMAND_CALL'
                      WHEN 'signup' THEN 'CODE_WRITE' ELSE 'STRUCTURED_TOOL_CALL' END AS category,
       {pick("k % 6", COMMANDS)} AS command,
       CASE WHEN tool_name = 'signup' THEN {pick("k % 3", CODES)} ELSE '' END AS code
FROM (SELECT event_id, ts, user_id, event_type AS tool_name, CAST({{json}} AS INT) AS k,
             {{concat}}'u', CAST(user_id AS VARCHAR(20)), '_w', CAST(CAST(floor((day(ts) - 1) / 7) AS INT) AS VARCHAR(20))) AS session_id
      FROM {{events}}) e
"""

EXP = f"""
SELECT d.doc_id AS exp_id, d.text, d.n_chars, d.source AS service, d.g,
       {pick("d.doc_id % 5", LAYERS)} AS layer,
       CASE WHEN d.g % 4 = 0 THEN NULL ELSE concat('CVE-2021-', CAST(1000 + d.g % 7 AS VARCHAR(20))) END AS cve1,
       CASE WHEN d.g % 4 <> 0 AND d.h % 3 = 0 THEN concat('CVE-2021-', CAST(1003 + d.g % 7 AS VARCHAR(20))) END AS cve2,
       CASE WHEN d.g % 5 = 0 THEN '' ELSE {pick("d.g % 3", ["1.2.3", "2.0", "2.0.7"])} END AS version,
       concat('s', CAST(d.doc_id % 33 AS VARCHAR(20))) AS session_id,
       CAST(30 + 5 * (d.n_chars % 13) AS DOUBLE) / 100 AS confidence,
       CASE WHEN l.quality = 1 THEN 'success' WHEN l.quality = 0 THEN 'failure' ELSE 'unknown' END AS outcome,
       {pick("d.g % 3", ["raw", "validated", "consolidated"])} AS maturity,
       CAST(d.doc_id % 400 AS INT) AS age_days,
       CASE WHEN d.doc_id % 11 = 0 THEN 'archived' WHEN d.doc_id % 11 = 1 THEN 'suspended'
            WHEN d.doc_id % 11 = 2 THEN 'conflicted' ELSE 'active' END AS lifecycle,
       CAST(d.doc_id % 9 AS INT) AS max_turn,
       {pick("d.doc_id % 5", ["ENV", "INV", "DEF", "INT", "EFF"])} AS dimension,
       {pick("d.g % 6", ["AUTHENTICATION_401", "binary_missing", "WAF_BLOCK", "INPUT_FORMAT", "ODDITY", ""])} AS sub_dimension,
       {pick("d.g % 4", ["RECON_WEAPONIZATION", "EXPLOITATION", "ENV_PREPARATION", "ESCALATION"])} AS phase
FROM (SELECT *, CAST(floor(doc_id / 20) AS BIGINT) AS g, CAST(floor(doc_id / 40) AS BIGINT) AS h FROM {{documents}}) d
LEFT JOIN {{labels}} l ON d.doc_id = l.doc_id
"""

#: What the oracle starts with; queries append their own SELECT.
ORACLE_EVENT = EVENT.format(json="json_extract_string(props, '$.k')", events="events", concat="concat(")
ORACLE_EXP = EXP.format(documents="documents", labels="labels")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool-call events: session = user and week, turn = position in it, outcome columns derived from type and k."""
    df = spark.sql(EVENT.format(json="get_json_object(props, '$.k')", events="{events}", concat="concat_ws('', "), events=table(spark, sf_dir, "events"))
    is_error = "tool_name = 'error'"
    return df.selectExpr("*", f"CASE WHEN {is_error} THEN err_text ELSE '' END AS stderr", f"CASE WHEN {is_error} THEN '' ELSE out_text END AS stdout", "return_code = 0 AS success").drop("err_text", "out_text")


def experiences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experience rows, one per document, with the CVE set as a sorted array."""
    df = spark.sql(EXP, documents=table(spark, sf_dir, "documents"), labels=table(spark, sf_dir, "labels"))
    return df.selectExpr("*", "array_sort(array_compact(array(cve1, cve2))) AS cves").drop("cve1", "cve2")


def strict(experiences: DataFrame) -> DataFrame:
    """Without rows that bridge everything: those without a CVE or a version."""
    return experiences.filter("size(cves) > 0 AND version <> ''")
