"""Conflicts between what failed and what is recommended, gap queue, retrieval documents, content quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kenning.operators.similar import top_pairs
from kenning.plans.store import small

# Bands, source domains, patterns.
SKIP_BELOW, CONFLICT_FROM, NEIGHBOURS, MOST_WORDS = 0.20, 0.50, 20, 300
DOMAINS = ["github.com", "exploit-db.com", "nvd.nist.gov", "cve.mitre.org", "packetstormsecurity.com", "vulhub.org", "portswigger.net", "attackerkb.com", "seebug.org"]
# Marks of code that can be run: plain strings, and patterns with a string that every match holds.
POC_STRINGS = ["msfconsole", "msfvenom", "msf>", "use exploit/", "exec(", "eval(", "os.system("]
POC_PATTERNS = [
    ("```", r"```(?:python|bash|sh|ruby|java|perl|go)[\s\S]{30,}?```"), ("import", r"import\s+(?:requests|socket|struct|subprocess|base64)"), ("subprocess.", r"subprocess\.(?:run|popen|call)\("),
    ("curl", r"curl\s+-[a-z]"), ("wget", r"wget\s+http"), ("nc", r"nc\s+-[enlvp]"), ("<?xml", r"<\?xml[\s\S]{20,}?xmldecoder"), ("<beans", r"<beans[\s\S]{20,}?class="), ("shell", r"(?:reverse|bind)\s+shell"),
    ("payload", r"payload\s*="), ("shellcode", r"shellcode\s*="), ("exploit", r"exploit\s*="),
]
_TOOLS = r"\s+(?:nmap|gobuster|curl|wget|hydra|sqlmap|msfconsole|nuclei|ffuf|feroxbuster|dirb|wfuzz|nikto|nc\b|netcat|john|hashcat)"
COMMANDS = [("```", r"```(?:bash|sh|shell|console|terminal)[^`]{20,}```"), ("$", r"(?m)^\$" + _TOOLS), ("#", r"(?m)^#" + _TOOLS), ("msf", r"msf[56]?>\s*(?:use|set|run|exploit)"), ("python", r"python3?\s+\w+exploit\w*\.py|python3?\s+poc\.py")]
RECOMMEND = ["推荐", "建议", "可以", "should", "recommend", "try", "exploit", "尝试", "使用", "执行", "攻击", "利用"]


def constraint_gate(service_a: Column, service_b: Column, cves_a: Column, cves_b: Column) -> Column:
    """False if both services are known and differ, or both CVE sets are known and don't meet."""
    services = (F.coalesce(service_a, F.lit("")) != "") & (F.coalesce(service_b, F.lit("")) != "") & (F.lower(service_a) != F.lower(service_b))
    ids = (F.size(cves_a) > 0) & (F.size(cves_b) > 0) & ~F.arrays_overlap(cves_a, cves_b)
    return ~services & ~ids


def band(score: Column) -> Column:
    return F.when(score < SKIP_BELOW, "skip").when(score < CONFLICT_FROM, "judge").otherwise("conflict")


def conflicts(negatives: DataFrame, positives: DataFrame, top: int = NEIGHBOURS) -> DataFrame:
    """Similar pairs that pass the constraint gate, with their band. Rows: id, text, service, cves."""
    pairs = top_pairs(negatives, positives, top)
    n = negatives.select(F.col("id").alias("a"), F.col("service").alias("sa"), F.col("cves").alias("ca"))
    p = positives.select(F.col("id").alias("b"), F.col("service").alias("sb"), F.col("cves").alias("cb"), F.col("text").alias("tb"))
    joined = pairs.join(n, "a").join(p, "b").filter(constraint_gate(F.col("sa"), F.col("sb"), F.col("ca"), F.col("cb")))
    signal = F.col("tb").rlike("|".join(RECOMMEND))
    return joined.select("a", "b", "score", "rank", band(F.col("score")).alias("band"), signal.alias("recommends"))


def patched(experiences: DataFrame, patched_cves: DataFrame) -> DataFrame:
    """Rows one of whose CVEs is in the patched list, with the sorted matches."""
    hit = experiences.select("exp_id", F.explode("cves").alias("cve")).join(patched_cves.select("cve").distinct(), "cve")
    return hit.groupBy("exp_id").agg(F.array_join(F.sort_array(F.collect_set("cve")), ",").alias("matched"))


# The gap queue: rows of gap_id, session_id, service, sub_dimension, priority, status, retry_count, arrival.


def push_if_new(queue: DataFrame, gaps: DataFrame) -> DataFrame:
    """Gaps whose id, session and sub-dimension, and service and sub-dimension are all new, first of a batch only."""
    new = gaps
    for keys in (["gap_id"], ["session_id", "sub_dimension"], ["service", "sub_dimension"]):
        first = Window.partitionBy(*keys).orderBy("arrival", "gap_id")
        new = new.join(queue.select(*keys).distinct(), keys, "left_anti").withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n")
    return queue.unionByName(new.select(*queue.columns))


def dequeue(queue: DataFrame, priority: str, limit: int) -> DataFrame:
    """The queue with the first `limit` pending gaps of a priority set to processing."""
    pending = (F.col("status") == "pending") & (F.col("priority") == priority)
    taken = queue.filter(pending).orderBy("arrival", "gap_id").limit(limit).select("gap_id", F.lit(True).alias("__taken"))
    return queue.join(small(taken), "gap_id", "left").withColumn("status", F.when(F.col("__taken"), "processing").otherwise(F.col("status"))).drop("__taken")


def settle(queue: DataFrame, results: DataFrame, most_retries: int = 3) -> DataFrame:
    """Apply results (gap_id, ok): done, or pending again with one more retry, or failed after the last."""
    joined = queue.join(results.select("gap_id", "ok"), "gap_id", "left")
    tries = F.col("retry_count") + F.when(~F.col("ok"), 1).otherwise(0)
    status = F.when(F.col("ok"), "done").when(~F.col("ok") & (tries >= most_retries), "failed").when(~F.col("ok"), "pending").otherwise(F.col("status"))
    return joined.withColumn("status", status).withColumn("retry_count", F.coalesce(tries, "retry_count")).drop("ok")


def reset_stale(queue: DataFrame, now: Column, minutes: int = 60) -> DataFrame:
    """Gaps that have been processing (since `started`) for too long are pending again."""
    stale = (F.col("status") == "processing") & (F.col("started") < now - F.expr(f"INTERVAL {int(minutes)} MINUTES"))
    return queue.withColumn("status", F.when(F.coalesce(stale, F.lit(False)), "pending").otherwise(F.col("status")))


def queue_stats(queue: DataFrame) -> DataFrame:
    return queue.groupBy(F.concat_ws("/", "priority", "status").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def upsert(registry: DataFrame, deltas: DataFrame, key: str = "exp_id") -> DataFrame:
    """registry with the non-null fields of deltas by key, and the delta rows that are new."""
    d = deltas.select(F.col(key), *[F.col(c).alias(f"__{c}") for c in deltas.columns if c != key], F.lit(True).alias("__hit"))
    joined = registry.join(d, key, "full")
    return joined.select(*[F.col(key) if c == key else F.coalesce(f"__{c}", c).alias(c) if c in deltas.columns else F.col(c) for c in registry.columns])


def insert_if_absent(registry: DataFrame, rows: DataFrame, key: str = "exp_id") -> DataFrame:
    return registry.unionByName(rows.join(registry.select(key), key, "left_anti"), allowMissingColumns=True)


def with_quality(df: DataFrame, text_col: str = "text", url_col: str = "url", out: str = "quality") -> DataFrame:
    """df with struct(score, has_poc, has_commands, has_cve, reason) of a crawled text.

    Patterns run on the lower-cased text, each only where its literal occurs, and each once a row.
    """
    low, url = F.col("__low"), F.coalesce(F.col(url_col), F.lit(""))
    hit = lambda literal, pattern: F.when(low.contains(literal), low.rlike(pattern)).otherwise(F.lit(False))
    poc = F.lit(False)
    for literal in POC_STRINGS:
        poc = poc | low.contains(literal)
    for literal, pattern in POC_PATTERNS:
        poc = poc | hit(literal, pattern)
    flags = {"__poc": poc, "__cve": F.when(F.col(text_col).contains("CVE-"), F.col(text_col).rlike(r"CVE-\d{4}-\d{4,}")).otherwise(F.lit(False))}
    flags |= {f"__c{i}": hit(*c) for i, c in enumerate(COMMANDS)}
    marked = df.withColumn("__low", F.lower(F.coalesce(F.col(text_col), F.lit("")))).withColumns(flags)
    commands = (sum((F.col(f"__c{i}").cast("int") for i in range(len(COMMANDS))), F.lit(0)) >= 2) | F.col("__c0")
    host = F.regexp_replace(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")), r"^www\.", "")
    known = F.when(host.rlike("|".join(d.replace(".", r"\.") for d in DOMAINS)), 0.3).otherwise(0.0)
    talk = url.contains("github.com") & url.rlike("/(issues|pull|discussions)/")
    code = url.contains("github.com") & ~talk & url.rlike("/(blob|raw|releases)/")
    bonus = F.when(talk, F.greatest(known - 0.2, F.lit(0.0))).when(code, F.least(known + 0.1, F.lit(0.4))).otherwise(known)
    full = F.least(F.when(F.col("__poc"), 0.5).otherwise(0.0) + F.when(commands, 0.3).otherwise(0.0) + F.when(F.col("__cve"), 0.2).otherwise(0.0) + bonus, F.lit(1.0))
    short = F.length("__low") < 200
    reason = F.when(short, "too_short").when(F.round(full, 9) < 0.3, "low_quality_no_actionable_content").when(talk & ~F.col("__poc") & ~commands, "github_issue_no_poc").otherwise("")
    result = F.struct(F.when(short, 0.0).otherwise(full).alias("score"), (F.col("__poc") & ~short).alias("has_poc"), (commands & ~short).alias("has_commands"), (F.col("__cve") & ~short).alias("has_cve"), reason.alias("reason"))
    return marked.withColumn(out, result).drop("__low", *flags)


def retrieval_document(experiences: DataFrame) -> DataFrame:
    """experiences with doc_text: header lines, summary and query hints."""
    hints = F.slice(F.array_compact(F.array_distinct(F.concat(F.array("service"), F.col("cves"), F.array("layer", "sub_dimension")))), 1, 12)
    lines = F.concat_ws(
        "\n",
        F.concat(F.lit("[KNOWLEDGE] "), F.col("layer"), F.lit(" | "), F.col("exp_id").cast("string")),
        F.concat(F.lit("knowledge_layer: "), F.col("layer")),
        F.concat(F.lit("target_service: "), F.col("service")),
        F.concat(F.lit("maturity: "), F.col("maturity")),
        F.concat(F.lit("cve_ids: "), F.array_join("cves", ", ")),
        F.substring("text", 1, 1500),
        F.concat(F.lit("QUERY_HINTS: "), F.array_join(hints, " | ")),
    )
    return experiences.withColumn("doc_text", lines)


def document_issues() -> Column:
    """Array of issue kinds of doc_text."""
    low = F.lower("doc_text")
    lines = F.filter(F.transform(F.split("doc_text", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    head = F.lower(F.array_join(F.slice(lines, 1, 5), "\n"))
    missing = F.filter("cves", lambda c: ~low.contains(F.lower(c)))
    words = F.size(F.filter(F.split("doc_text", r"\s+"), lambda x: x != ""))
    return F.array_compact(
        F.array(
            F.when(~head.contains("[knowledge]"), "missing_header_mark"),
            F.when(~head.contains(F.lower("layer")), "missing_header_layer"),
            F.when((F.col("service") != "") & (F.col("service") != "unknown") & ~head.contains(F.lower("service")), "missing_header_target_service"),
            F.when(~F.col("doc_text").contains("QUERY_HINTS:"), "missing_query_hints"),
            F.when(F.size(missing) > 0, F.concat(F.lit("missing_cve_ids:"), F.array_join(F.slice(missing, 1, 6), ","))),
            F.when(words > MOST_WORDS, F.concat(F.lit("too_long_words:"), words.cast("string"))),
            F.when(F.col("doc_text").contains("```") | (F.regexp_count("doc_text", F.lit(r"\b(import|def)\b")) > 2), "code_like_content"),
        )
    )


def route(issues: Column) -> Column:
    return F.when(F.size(issues) > 0, "secondary").otherwise("primary")


def byte_budget(documents: DataFrame, group: str, order: list[str], most_rows: int = 5, most_bytes: int = 100_000) -> DataFrame:
    """Rows of each group in order, up to the first that would exceed the row or byte budget."""
    w = Window.partitionBy(group).orderBy(*order)
    sized = documents.withColumn("__bytes", F.sum(F.octet_length("text")).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("__n", F.row_number().over(w))
    return sized.filter((F.col("__n") <= most_rows) & (F.col("__bytes") <= most_bytes)).drop("__n").withColumnRenamed("__bytes", "running_bytes")
