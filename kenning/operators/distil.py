"""From annotated events to experiences: what worked, what failed and why, in which terms it is found again.

Input: annotate.annotate() frames. Extraction is columns of the scan, so one pass over the events gives all rows; only
de-duplication within a session shuffles. Facts are in kenning.operators.facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kenning.functions import text as tx
from kenning.operators.facts import action, event_facts, found, low_value, prune, session_facts, target_service, told

__all__ = ["clean_queries", "decision_rule", "event_facts", "found", "indicators", "low_value", "negatives", "number_experiences", "pattern_type", "positives", "preconditions", "prune", "session_facts", "tags"]

# Signs of success in what a tool printed, and those that weigh more.
SUCCESS_SIGNS = [
    r"uid=0\(root\)",
    r"root@[a-zA-Z0-9_\-]+",
    r"flag\{[^}]+\}",
    r"(?:^|\n)root\s*$",
    r"(?:^|\n)\$\s+\w",
    r"\bshell\b.*\broot\b",
    r"command execution successful",
    r"exploit\s+successful",
    r"access granted",
    r"authentication successful",
    r"login successful",
    r"(?:^|\n)#\s+(?:id|whoami|cat |ls |pwd|uname)\b",
    r"root:x:0:0:",
    r"root:[*$!][^:]*:\d+:\d+:",
    r"[a-zA-Z_][a-zA-Z0-9_\-]*:[^:]+:[0-9]+:[0-9]+:[^:]*:[/~]",
    r"(?:daemon|nobody|www-data|sync|bin|sys|man|lp|mail|news)@[a-zA-Z0-9_\-]+",
    r"\"(?:status|code)\"\s*:\s*(?:200|0|\"ok\"|\"success\"|\"SUCCESS\")",
    r"(?:200 OK|HTTP/[12](?:\.\d)?\s+200)",
    r"(?:Total disk|disk usage).*(?:MB|GB|KB)",
]
STRONG_SIGNS, SIGN_CHARS, MOST_SIGNS = ["uid=0", "root@", "flag{"], 80, 5
RAW_FIELD = r'(?s)"raw"\s*:\s*"((?:[^"\\]|\\.)*)"'

# Commands that only manage sessions; sizes below which a command needs a sign, service or CVE.
SESSION_COMMANDS = [r"session\s+output", r"session\s+terminate", r"async\s+session", r"check\s+session", r"started\s+async", r"^sessions\s+(?:-l|-i|-v|-k|-u|\d+)"]
TINY, SHORT, LONG = 10, 50, 100

# Confidence of what worked, by the session's outcome, without signs, and for each strong sign.
SIGNED, UNSIGNED_SHORT, UNSIGNED, STRONG_BONUS, MOST_CONFIDENCE = {"success": 0.78, "partial_success": 0.72}, 0.35, 0.50, 0.05, 0.95
SIGNED_ELSE = 0.60

# What must hold before a command can work.
PROTOCOL_NEEDS = [
    (r"https?://|curl\b|wget\b|http_request|nikto|gobuster|dirsearch|ferox|wfuzz|ffuf", "目标 HTTP/HTTPS 服务可访问"),
    (r"\bssh\b|sshpass|paramiko|evil-winrm", "SSH 服务可访问（凭据或密钥已知）"),
    (r"\bftp\b|ftplib|vsftpd", "FTP 服务可访问"),
    (r"\bsmb\b|samba|smbclient|enum4linux|rpcclient|crackmapexec", "SMB 服务可访问"),
    (r"redis-cli|\bredis\b", "Redis 服务可访问（无认证或密码已知）"),
    (r"\bmongo\b|pymongo", "MongoDB 服务可访问"),
    (r"\bmysql\b|pymysql|mariadb", "MySQL/MariaDB 数据库可访问"),
    (r"psql|postgresql|asyncpg", "PostgreSQL 数据库可访问"),
    (r"sqlmap|union select|\bsqli\b|sql injection", "目标存在 SQL 注入漏洞点"),
    (r"msfconsole|msfvenom|use exploit", "Metasploit Framework 已配置可用"),
    (r"execute_code|python3?\s.*\.py\b", "Python 脚本执行环境可用"),
    (r"payload|reverse.?shell|bind.?shell|meterpreter", "目标存在代码执行或命令注入入口"),
    (r"\bldap\b|ldapsearch", "LDAP 服务可访问"),
    (r"snmpwalk|snmpget", "SNMP 服务可访问（community string 已知）"),
    (r"t3://|iiop://|weblogic", "WebLogic T3/IIOP 服务可访问"),
    (r"jndi:|log4shell|log4j", "JNDI 注入入口可达（Log4Shell/JNDIExploit）"),
    (r"winrm|evil-winrm|Enter-PSSession", "WinRM 服务可访问"),
    (r"druid|actuator|/api/index\.json|spring.boot", "Java 应用管理接口可访问（Druid/Actuator）"),
    (r"jenkins|/jenkins(?:/|$)|jenkins.script", "Jenkins CI 服务可访问"),
    (r"gitea|gitlab|\.git(?:/api|/info)|/api/v4/", "Git 服务平台 API 可访问（Gitea/GitLab）"),
]
EXECUTION_WORDS = r"exploit|payload|\brce\b|code.?exec|command.?inject"
EXECUTION_NEED, CONTEXT_NEED, ANY_NEED = "目标存在可利用的远程代码执行/命令注入漏洞", "已通过 RAG 知识检索获取相关利用信息", "目标服务正常运行且可访问"

# What to do after a failure, by its dimension, and what always holds.
AFTER = {
    "ENV": "先验证工具/依赖/权限与网络连通性，再重试。",
    "INV": "先校验参数与调用语法，必要时最小化参数集重跑。",
    "DEF": "先确认认证/授权与防护策略，再选择绕过或替代路径。",
    "INT": "先补充版本/端口/路径侦察，再调整漏洞假设。",
    "EFF": "先验证执行效果与回显链路，再切换 payload 或验证方式。",
}
AFTER_ELSE, BEFORE_RETRY = "先补充前置验证，再迭代调整命令。", "重试前执行参数化预检，确认失败信号消失后再继续利用链。"
NEXT_SIGNALS, VALIDATE = ["执行链路可达且不再出现原失败特征", "前置条件清单确认完成"], 'echo "validate prerequisites before retry"'
MOST_EVIDENCE, MOST_REMEDY = 140, 220

# Kinds of conceptual insight by the first group of words that occurs.
PATTERN_TYPES = [
    ("defense_bypass", ["waf", "bypass", "defense", "防御", "绕过", "过滤"]),
    ("recon_pattern", ["recon", "侦察", "枚举", "discovery"]),
    ("privilege_escalation", ["privilege", "提权", "escalation"]),
    ("lateral_movement", ["lateral", "横向"]),
    ("credential_attack", ["credential", "凭据", "密码", "口令"]),
    ("post_exploitation", ["post-exploitation", "post exploitation", "后渗透"]),
    ("vulnerability_pattern", ["vulnerability", "漏洞", "cve"]),
]
PATTERN_ELSE = "attack_strategy"

# Names that tags are made of.
TAG_PRODUCT = r"([A-Za-z][A-Za-z0-9_\-]{2,30})/(\d+[\.\d]*\b)"
TAG_SERVICE = r"(?i)\d+/(?:tcp|udp)\s+open\s+(\S+)(?:\s+(.+))?"
TAG_HEADER = r"(?im)^(?:Server|X-Powered-By|X-Generator|X-AspNet-Version):\s*(.+)"
TAG_TOOLS = [
    "nmap", "sqlmap", "metasploit", "msfconsole", "hydra", "hashcat", "nikto", "gobuster", "dirsearch", "feroxbuster", "wpscan", "enum4linux", "smbclient",
    "rpcclient", "crackmapexec", "impacket", "evil-winrm", "kerbrute", "bloodhound", "burpsuite", "zaproxy", "ffuf", "wfuzz", "nuclei", "curl", "wget",
    "netcat", "nc", "socat", "python", "perl", "ruby",
]
MOST_TAGS, MOST_TAG_PORTS = 20, 3


def indicators(text: Column) -> Column:
    """The signs of success found in a result, or in the first `raw` string of a JSON answer in it; distinct, cut to SIGN_CHARS."""
    inner = F.replace(F.replace(F.regexp_extract(text, RAW_FIELD, 1), F.lit("\\n"), F.lit("\n")), F.lit("\\t"), F.lit("\t"))

    def signs(where: Column) -> list[Column]:
        return [F.when(where.rlike(f"(?i){p}"), F.substring(F.regexp_extract(where, f"(?i)({p})", 1), 1, SIGN_CHARS)) for p in SUCCESS_SIGNS]

    return F.array_distinct(F.array_compact(F.array(*signs(text), *signs(inner))))


def preconditions(tool: Column, command: Column, cves: Column, context: Column) -> Column:
    """What must hold for a command: its first CVE, else execution at all, then its protocols; context: had knowledge been retrieved."""
    words = F.concat_ws(" ", tool, command)
    first = F.when(F.size(cves) > 0, F.concat(F.lit("目标存在可利用漏洞（"), F.get(cves, F.lit(0)), F.lit("）"))).when(words.rlike(f"(?i){EXECUTION_WORDS}"), EXECUTION_NEED)
    needs = [F.when(words.rlike(f"(?i){p}"), said) for p, said in PROTOCOL_NEEDS]
    listed = F.array_distinct(F.array_compact(F.array(first, *needs, F.when(context, CONTEXT_NEED))))
    return F.when(F.size(listed) > 0, listed).otherwise(F.array(F.lit(ANY_NEED)))


def worthy(command: Column, signs: Column, service: Column, outcome: Column, cves: Column) -> Column:
    """A command worth remembering: no session management; if short, with a sign, a service, a CVE or a partial success."""
    size, signed = F.length(tx.strip(command)), F.size(signs) > 0
    managing = F.lit(False)
    for p in SESSION_COMMANDS:
        managing = managing | command.rlike(f"(?i){p}")
    known = (F.coalesce(service, F.lit("")) != "") | signed | (outcome == "partial_success") | (F.size(cves) > 0)
    return ~managing & (signed | (size >= TINY)) & ((size > LONG) | known)


def positive_confidence(signs: Column, command: Column, session_outcome: Column) -> Column:
    """By the session's outcome if there are signs, more for strong ones; else low, lower for short commands."""
    strong = F.size(F.filter(signs, lambda s: s.rlike("|".join(x.replace("{", r"\{") for x in STRONG_SIGNS))))
    signed = F
    for outcome, share in SIGNED.items():
        signed = signed.when(session_outcome == outcome, F.lit(share))
    base = F.when(F.size(signs) > 0, signed.otherwise(F.lit(SIGNED_ELSE))).when(F.length(tx.strip(command)) <= SHORT, F.lit(UNSIGNED_SHORT)).otherwise(F.lit(UNSIGNED))
    return F.least(F.lit(MOST_CONFIDENCE), base + STRONG_BONUS * strong)


def positives(annotated: DataFrame, sessions: DataFrame) -> DataFrame:
    """What worked, once per session, tool, phase and the start of its template. sessions: session_id, session_outcome."""
    good = annotated.filter(F.col("outcome_label").isin("success", "partial_success") & (tx.strip(action()) != ""))
    context = F.col("has_rag_context") if "has_rag_context" in annotated.columns else F.lit(False)
    read = good.withColumns({"__command": action(), "__told": told(), "__context": context}).withColumns({"cves": tx.cves(F.concat_ws(" ", "__command", "__told")), "indicators": indicators(F.col("__told"))})
    read = read.withColumn("target_service", target_service(F.col("__told"), F.col("cves")))
    kept = read.filter(worthy(F.col("__command"), F.col("indicators"), F.col("target_service"), F.col("outcome_label"), F.col("cves")))
    told_by = kept.join(sessions.select("session_id", "session_outcome"), "session_id", "left")
    rows = told_by.select(
        "session_id", "turn_index", "event_id", "tool_name", "phase", tx.parameterise(F.col("__command")).alias("template"),
        positive_confidence(F.col("indicators"), F.col("__command"), F.col("session_outcome")).alias("confidence"),
        preconditions(F.col("tool_name"), F.col("__command"), F.col("cves"), F.col("__context")).alias("preconditions"),
        F.slice("indicators", 1, MOST_SIGNS).alias("indicators"), "cves", "target_service",
    )
    w = Window.partitionBy("session_id", "tool_name", "phase", "short").orderBy("turn_index", "event_id")
    return rows.withColumn("short", F.substring("template", 1, 80)).withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n", "short")


def decision_rule(tool: Column, phase: Column, dimension: Column, sub: Column, evidence: Column, remedy: Column, template: Column) -> Column:
    """struct(if, then, not, next_actions) of a failure that no model has explained."""
    empty = F.lit("")
    told_so = tx.soft_truncate(F.coalesce(evidence, empty), MOST_EVIDENCE)
    when = F.concat(F.lit("当 `"), tool, F.lit("` 在 "), phase, F.lit(" 阶段出现 "), dimension, F.lit("/"), sub, F.lit(" 失败"))
    after = F
    for name, said in AFTER.items():
        after = after.when(dimension == name, F.lit(said))
    then = F.array_distinct(F.array_compact(F.array(F.nullif(tx.soft_truncate(F.coalesce(remedy, empty), MOST_REMEDY), empty), after.otherwise(F.lit(AFTER_ELSE)), F.lit(BEFORE_RETRY))))
    step = lambda n, who, what, signal: F.struct(F.lit(n).alias("step"), who.alias("tool"), what.alias("command"), F.lit(signal).alias("expected_signal"))
    return F.struct(
        F.when(told_so != "", F.concat(when, F.lit("，并出现证据："), told_so)).otherwise(when).alias("if"),
        F.slice(then, 1, 3).alias("then"),
        F.concat(F.lit("未验证前置条件时直接重复执行原始命令 `"), tool, F.lit("`。")).alias("not"),
        F.array(step(1, F.substring(tool, 1, 50), F.substring(template, 1, 300), NEXT_SIGNALS[0]), step(2, F.lit("generic_linux_command"), F.lit(VALIDATE), NEXT_SIGNALS[1])).alias("next_actions"),
    )


def negatives(annotated: DataFrame) -> DataFrame:
    """What failed and why, once per session, dimension, tool and command start; needs a cause and a command or code."""
    failed = F.coalesce(F.nullif("command", F.lit("")), F.nullif("code", F.lit("")))
    bad = annotated.filter(F.col("cause").isNotNull() & failed.isNotNull())
    rule = decision_rule(F.col("tool_name"), F.col("phase"), F.col("cause.dimension"), F.col("cause.sub_dimension"), F.col("rule.evidence"), F.col("rule.hint"), tx.parameterise(failed))
    rows = bad.select("session_id", "turn_index", "event_id", "tool_name", "phase", failed.alias("failed_command"), F.col("cause.dimension").alias("dimension"), F.col("cause.sub_dimension").alias("sub_dimension"), F.when(F.col("rule").isNotNull(), 0.78).otherwise(0.72).alias("confidence"), rule.alias("rule"))
    w = Window.partitionBy("session_id", "dimension", "tool_name", "short").orderBy("turn_index", "event_id")
    return rows.withColumn("short", F.substring("failed_command", 1, 50)).withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n", "short")


def tech_names(text: Column) -> Column:
    """Lower-case names of products, scanned services and their versions' words, header values and tools, in this order."""
    every = lambda p, i=0: F.regexp_extract_all(text, F.lit(p), F.lit(i))
    products = every(TAG_PRODUCT, 1)

    def scanned(row: Column) -> Column:
        words = F.split(tx.strip(F.regexp_extract(row, TAG_SERVICE, 2)), r"\s+")
        telling = F.filter(words, lambda w: (F.length(w) >= 4) & (w.rlike(r"^(?!\d)[\p{L}\p{N}]+$") | w.contains("-")))
        return F.concat(F.array(tx.strip(F.regexp_extract(row, TAG_SERVICE, 1))), F.slice(telling, 1, 4))

    headed = F.filter(F.transform(every(TAG_HEADER, 1), lambda v: F.get(F.split(tx.strip(v), r"[/\s]"), F.lit(0))), lambda v: F.length(v) >= 3)
    named = F.concat(products, F.flatten(F.transform(every(TAG_SERVICE), scanned)), headed, every(r"(?i)\b(" + "|".join(TAG_TOOLS) + r")\b", 1))
    return F.array_distinct(F.filter(F.transform(named, F.lower), lambda n: n != ""))


def tags() -> Column:
    """CVEs, tool, phase, technologies and uncommon ports of an event, distinct, at most MOST_TAGS."""
    text = F.concat_ws(" ", action(), told())
    ported = F.transform(F.slice(tx.target_ports(text), 1, MOST_TAG_PORTS), lambda p: F.concat(F.lit("port:"), p))
    return F.slice(F.array_distinct(F.array_compact(F.concat(tx.cves(text), F.array(F.lower("tool_name"), F.lower("phase")), tech_names(text), ported))), 1, MOST_TAGS)


def number_experiences(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with exp_id: session, layer and running number."""
    w = Window.partitionBy("session_id").orderBy(*order)
    return rows.withColumn("exp_id", F.concat_ws("_", "session_id", F.lpad(F.row_number().over(w).cast("string"), 4, "0")))


def pattern_type(text: Column) -> Column:
    """Kind of a conceptual insight by the first group of words one of which occurs."""
    out, low = F, F.lower(F.coalesce(text, F.lit("")))
    for name, words in PATTERN_TYPES:
        out = out.when(low.rlike("|".join(words)), name)
    return out.otherwise(PATTERN_ELSE)


def clean_queries(queries: Column) -> Column:
    """Up to four trimmed queries of over eight characters without CJK."""
    return F.slice(F.filter(F.transform(queries, lambda q: tx.strip(q)), lambda q: (F.length(q) > 8) & ~q.rlike(r"[一-鿿]")), 1, 4)
