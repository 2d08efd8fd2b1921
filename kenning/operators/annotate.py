"""Event annotation: first-match rules, outcome verdicts, phases, failure causes and session outcomes.

Everything is a Column over an event frame with has_result, return_code, timed_out, success, stdout, stderr, category,
command and code, so a session of any length is annotated in the scan, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kenning.functions.text import program_name

# Signal phrases, hints and exit codes that decide labels.
SUCCESS_SIGNAL = r"(?i)uid\s*=\s*0|root@|flag\s*\{|successfully\s+read\s+/etc/passwd|access\s+granted|authentication\s+successful"
TIMEOUT_SIGNAL = r"(?i)\btime(?:d)?\s*out\b|read\s+timeout|connection\s+timeout|deadline\s+exceeded"
FAILURE_PHRASES = [
    "connection refused", "permission denied", "access denied", "command not found", "no such file", "not found",
    "authentication failed", "401 unauthorized", "403 forbidden", "status code: 500", "status code: 403",
    "status code: 401", "http/1.1 500", "http/1.1 403", "traceback", "exception", "not vulnerable", "already patched",
    "errors occurred",
]
FAILURE_SIGNAL = "(?i)" + "|".join(x.replace(".", r"\.") for x in FAILURE_PHRASES) + r"|\b(?:401|403|404|500)\b|(?<!no\s)\b(?:error|errors|failed|failure)\b"
RECON_PROGRAMS = ["nmap", "whatweb", "nikto", "gobuster", "dirb", "ffuf", "wfuzz", "masscan", "enum4linux", "netdiscover", "curl", "wget"]
EXPLOIT_PROGRAMS = ["sqlmap", "msfconsole", "hydra", "john", "hashcat", "python", "python3", "perl"]
EXIT_RULES = [
    (127, "RC-127", "BINARY_MISSING", None),
    (126, "RC-126", "EXECUTE_PERMISSION_DENIED", "检查文件权限（chmod +x），或以适当权限运行"),
    (124, "RC-124", "TIMEOUT", "timeout 命令设定的时限已到期，建议增大 timeout 参数或将任务拆分为更小批次"),
    (130, "RC-130", "INTERRUPTED", "前台进程被 SIGINT 中断（Ctrl+C / kill -2），如为误操作请重新运行；如为预期行为则可忽略"),
    (137, "RC-137", "SIGKILL", "进程被 SIGKILL 强制终止（exit 137 = 128+9）。优先排查：① OOM Killer（dmesg | grep -i oom）；② 手动 kill -9；③ 系统关机/重启。内存密集型工具（如 hashcat）请限制内存用量或减小任务规模"),
    (143, "RC-143", "SIGTERM", "进程收到 SIGTERM 被正常终止，通常由编排层在超时后主动清理发出；可检查超时配置或编排策略"),
]
LATE_RULE = ("TOUT", "TIMEOUT", "timed_out=true", "增大 timeout 参数，或分批次执行")
# Packages of missing programs, and where those without a package are had.
PACKAGES = {
    "msfconsole": "metasploit-framework", "dirb": "dirb", "nmap": "nmap", "nikto": "nikto", "gobuster": "gobuster", "hydra": "hydra", "sqlmap": "sqlmap", "wfuzz": "wfuzz",
    "ffuf": "ffuf", "john": "john", "hashcat": "hashcat", "netcat": "netcat", "nc": "netcat", "curl": "curl", "wget": "wget",
}
RELEASES = {
    "fscan": ("https://github.com/shadow1ng/fscan/releases", "Go 单体二进制，无 apt 包，需从 GitHub Releases 手动下载"),
    "nuclei": ("https://github.com/projectdiscovery/nuclei/releases", "Go 单体二进制，无 apt 包，需从 GitHub Releases 下载（或 go install github.com/projectdiscovery/nuclei/v3/cmd/nuclei@latest）"),
    "subfinder": ("https://github.com/projectdiscovery/subfinder/releases", "Go 单体二进制，需从 GitHub Releases 手动下载"),
    "httpx": ("https://github.com/projectdiscovery/httpx/releases", "Go 单体二进制，需从 GitHub Releases 手动下载"),
}
CAUSES = [
    ("DEF", "AUTHENTICATION", r"401 unauthorized|authentication failed|login failed|\bstatus\s+code\s*[:=]?\s*401\b|\bhttp/\d(?:\.\d)?\s+401\b"),
    ("DEF", "AUTHORIZATION", r"403 forbidden|authorization|access denied|\bstatus\s+code\s*[:=]?\s*403\b|\bhttp/\d(?:\.\d)?\s+403\b"),
    ("INT", "TARGET_NOT_FOUND", r"404 not found|\bstatus\s+code\s*[:=]?\s*404\b|\bhttp/\d(?:\.\d)?\s+404\b"),
    ("DEF", "PATCHED_OR_HARDENED", r"500 internal server error|\bstatus\s+code\s*[:=]?\s*500\b|\bhttp/\d(?:\.\d)?\s+500\b|not vulnerable|already patched"),
    ("ENV", "PERMISSION", r"permission denied"),
    ("ENV", "BINARY_MISSING", r"command not found|no such file"),
    ("INV", "EXECUTION_ERROR", r"traceback|exception|errors occurred|(?<!no\s)\b(?:error|errors|failed|failure)\b"),
]
PHASES = ["RECON_WEAPONIZATION", "EXPLOITATION", "ESCALATION", "LATERAL_MOVEMENT", "EXFILTRATION", "COMMAND_CONTROL", "ENV_PREPARATION"]


def result_text() -> Column:
    return F.concat_ws("\n", F.nullif(F.col("stdout"), F.lit("")), F.nullif(F.col("stderr"), F.lit("")))


def install_hint(binary: Column, tool: Column) -> Column:
    """How a missing program is had: by its package (its own name if unknown), or from its releases."""
    needs = F.when(tool != "", F.concat(F.lit("（工具 "), tool, F.lit(" 依赖此二进制）"))).otherwise("")
    package = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in PACKAGES.items() for x in pair]), binary), binary)
    out = F
    for name, (url, note) in RELEASES.items():
        out = out.when(binary == name, F.concat(binary, F.lit(" 未安装"), needs, F.lit(f"，{note}，请手动下载安装：{url}")))
    return out.otherwise(F.concat(binary, F.lit(" 未安装"), needs, F.lit("，请通过 apt install "), package, F.lit(" 安装")))


def _exit(code: int, hint: str | None, binary: Column, tool: Column) -> tuple[Column, Column]:
    """Evidence and hint of an exit code; a missing program is named by what the shell said, else by the tool."""
    mine = F.concat(F.lit("tool="), tool)
    if hint is not None:
        return F.when(tool != "", F.concat(F.lit(f"return_code={code} ("), mine, F.lit(")"))).otherwise(f"return_code={code}"), F.lit(hint)
    named = F.array_join(F.array_compact(F.array(F.when(binary != "", F.concat(F.lit("binary="), binary)), F.when(tool != "", mine))), ", ")
    evidence = F.when(named != "", F.concat(F.lit(f"return_code={code} ("), named, F.lit(")"))).otherwise(f"return_code={code}")
    unknown = F.when(tool != "", F.concat(tool, F.lit(" 依赖的二进制未安装，请检查工具安装情况（无法从 stderr 确定具体二进制名）"))).otherwise("确认目标环境中已安装该工具，或使用绝对路径调用")
    return evidence, F.when(binary != "", install_hint(binary, tool)).otherwise(unknown)


def rule_hit() -> Column:
    """First matching rule as struct(rule, dimension, sub_dimension, evidence, hint); null without one."""
    binary, tool = F.coalesce(F.regexp_extract("stderr", r"(\w+):\s*not found", 1), F.lit("")), F.coalesce("tool_name", F.lit(""))

    def hit(rule: str, sub: str, evidence: Column, hint: Column) -> Column:
        return F.struct(F.lit(rule).alias("rule"), F.lit("ENV").alias("dimension"), F.lit(sub).alias("sub_dimension"), evidence.alias("evidence"), hint.alias("hint"))

    out = F
    for code, rule, sub, hint in EXIT_RULES:
        out = out.when(F.col("has_result") & (F.col("return_code") == code), hit(rule, sub, *_exit(code, hint, binary, tool)))
    rule, sub, evidence, hint = LATE_RULE
    return out.when(F.col("has_result") & F.col("timed_out"), hit(rule, sub, F.lit(evidence), F.lit(hint)))


def _verdict(good: Column, bad: Column, late: Column) -> Column:
    return (
        F.when(~F.col("has_result"), "uncertain")
        .when(F.col("timed_out") | late, "timeout")
        .when(good, "partial_success")
        .when(bad, "failure")
        .when(F.coalesce(F.col("success") | (F.col("return_code") == 0), F.lit(False)), "success")
        .when(F.coalesce(~F.col("success") | (F.col("return_code") != 0), F.lit(False)), "failure")
        .otherwise("uncertain")
    )


def _signals() -> list[Column]:
    text = result_text()
    return [text.rlike(SUCCESS_SIGNAL), text.rlike(FAILURE_SIGNAL), text.rlike(TIMEOUT_SIGNAL)]


def outcome() -> Column:
    """Verdict from signals first, then flags; without a result uncertain."""
    return _verdict(*_signals())


def merged_outcome(model: Column) -> Column:
    """The rules' verdict unless uncertain; then a model's label if it is one of the known ones."""
    own = outcome()
    return F.when(own != "uncertain", own).when(model.isin("success", "partial_success", "failure", "timeout"), model).otherwise("uncertain")


def phase() -> Column:
    """Phase from category, code and program."""
    program = F.lower(program_name(F.col("command")))
    return (
        F.when(F.col("category") == "RAG_QUERY", "RECON_WEAPONIZATION")
        .when((F.col("category") == "CODE_WRITE") & F.col("code").rlike(r"(?i)\b(cve-\d{4}-\d+|exploit|payload|reverse\s*shell|rce)\b"), "EXPLOITATION")
        .when(F.col("category") == "CODE_WRITE", "RECON_WEAPONIZATION")
        .when((F.col("category") == "GENERIC_COMMAND_CALL") & program.isin(RECON_PROGRAMS), "RECON_WEAPONIZATION")
        .when((F.col("category") == "GENERIC_COMMAND_CALL") & program.isin(EXPLOIT_PROGRAMS), "EXPLOITATION")
        .otherwise("ENV_PREPARATION")
    )


def fallback_cause() -> Column:
    """struct(dimension, sub_dimension) by ordered text rules; null without a result."""
    text = F.lower(result_text())
    pair = lambda d, s: F.struct(F.lit(d).alias("dimension"), F.lit(s).alias("sub_dimension"))
    out = F.when(~F.col("has_result"), None).when(F.col("timed_out") | text.rlike(TIMEOUT_SIGNAL), pair("ENV", "TIMEOUT"))
    for dimension, sub, pattern in CAUSES:
        out = out.when(text.rlike(pattern), pair(dimension, sub))
    return out.when(F.coalesce(F.col("return_code") != 0, F.lit(False)), pair("INV", "WRONG_ARGS")).otherwise(pair("EFF", "OUTPUT_LOST"))


def _pending(rule: Column, verdict: Column) -> Column:
    sign = F.coalesce(F.col("return_code") != 0, F.lit(False)) | F.coalesce(~F.col("success"), F.lit(False))
    quiet = F.coalesce(F.col("return_code") == 0, F.lit(False)) | (F.col("return_code").isNull() & F.col("success").isNull())
    return F.col("has_result") & rule.isNull() & (sign | ((verdict == "failure") & quiet))


def pending_cause() -> Column:
    """A result, no rule, and a sign of failure: exit code, success flag or verdict."""
    return _pending(rule_hit(), outcome())


def annotate(events: DataFrame) -> DataFrame:
    """events with rule, outcome_label, phase, cause and needs_cause; each signal is matched once a row."""
    good, bad, late = _signals()
    matched = events.withColumns({"__good": good, "__bad": bad, "__late": late, "rule": rule_hit(), "phase": phase()})
    labelled = matched.withColumn("outcome_label", _verdict(F.col("__good"), F.col("__bad"), F.col("__late")))
    pending = labelled.withColumn("needs_cause", _pending(F.col("rule"), F.col("outcome_label")))
    ruled = F.when(F.col("rule").isNotNull(), F.struct(F.col("rule.dimension").alias("dimension"), F.col("rule.sub_dimension").alias("sub_dimension")))
    return pending.withColumn("cause", F.coalesce(ruled, F.when(F.col("needs_cause"), fallback_cause()))).drop("__good", "__bad", "__late")


def session_outcome(annotated: DataFrame) -> DataFrame:
    """Per session: success on a strong signal, partial_success on any good verdict, else failure; counts; key signals.

    Signals are made distinct by their words before they are gathered, so what a session gathers is as small as the list
    of phrases that SUCCESS_SIGNAL can match.
    """
    strong = F.col("has_result") & result_text().rlike(SUCCESS_SIGNAL)
    word = F.when(strong, F.regexp_replace(F.lower(F.regexp_extract(result_text(), f"({SUCCESS_SIGNAL})", 1)), r"\s+", " "))
    good = F.col("outcome_label").isin("success", "partial_success")
    slim = annotated.select("session_id", "turn_index", "outcome_label", F.col("cause.dimension").alias("dimension"), strong.alias("strong"), good.alias("good"), word.alias("signal"))
    per = slim.groupBy("session_id", "signal").agg(
        F.min("turn_index").alias("first"),
        F.bool_or("strong").alias("strong"),
        F.bool_or("good").alias("any_good"),
        F.count(F.lit(1)).alias("n"),
        F.count_if("good").alias("n_good"),
        F.count_if(F.col("outcome_label") == "failure").alias("n_failure"),
        F.count_if(F.col("dimension") == "ENV").alias("n_env"),
    )
    listed = F.sort_array(F.collect_list(F.when(F.col("signal").isNotNull(), F.struct("first", "signal"))))
    return per.groupBy("session_id").agg(
        F.when(F.bool_or("strong"), "success").when(F.bool_or("any_good"), "partial_success").otherwise("failure").alias("session_outcome"),
        F.sum("n").alias("n_events"),
        F.sum("n_good").alias("n_good"),
        F.sum("n_failure").alias("n_failure"),
        F.sum("n_env").alias("n_env"),
        F.array_join(F.transform(listed, lambda x: x["signal"]), ",").alias("key_signals"),
    )
