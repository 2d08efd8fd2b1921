"""String and regular-expression column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wrappers that aren't the program themselves, and ports that stay literal.
WRAPPERS = ["sudo", "env", "time", "nice", "ionice", "strace", "ltrace", "timeout", "nohup"]
NUMERIC_WRAPPERS = ["timeout", "nice", "ionice"]
PRIVATE_IP = r"\b(?:10(?:\.\d{1,3}){3}|192\.168(?:\.\d{1,3}){2}|172\.(?:1[6-9]|2\d|3[01])(?:\.\d{1,3}){2})\b"
COMMON_PORTS = ["21", "22", "23", "25", "53", "80", "110", "139", "143", "443", "445", "3306", "3389", "5432", "6379", "8080"]


def strip(text: Column) -> Column:
    """Without white space at either end (trim() takes spaces only)."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


#: Characters of a string that Spark's JSON parser takes at most.
JSON_CHARS = 20_000_000


def bare(text: Column) -> Column:
    """Without JSON's white space at either end."""
    return F.trim(text, F.lit(" \t\r\n"))


def is_object(text: Column) -> Column:
    """Whether a text is one JSON object and nothing after it; keys may be repeated, which try_parse_json doesn't take."""
    ends = bare(text).startswith("{") & bare(text).endswith("}") & (F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1)
    return F.coalesce(ends & (~text.rlike(r"[\x00-\x1f]|^ *\{ *'") | F.try_parse_json(text).isNotNull()), F.lit(False))


def parseable(text: Column) -> Column:
    """text; an error if it can't be parsed and is so large that this needn't be its fault."""
    lost = (F.octet_length(text) > JSON_CHARS) & F.try_parse_json(text).isNull()
    return F.when(lost, F.raise_error(F.concat(F.lit("too large to parse: "), F.substring(text, 1, 80)))).otherwise(text)


def cves(text: Column) -> Column:
    """Strict CVE ids, upper-cased, in order of first appearance."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"(?i)\bCVE-\d{4}-\d{4,7}\b"), F.lit(0)), F.upper))


def cves_loose(text: Column) -> Column:
    """CVE ids with any of the usual separators, canonical and sorted."""
    found = F.regexp_extract_all(F.upper(text), F.lit(r"CVE[-_\s]?\d{4}[-_\s]?\d{4,7}"), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: F.regexp_replace(x, r"^CVE[-_\s]?(\d{4})[-_\s]?(\d+)$", "CVE-$1-$2"))))


def version_family(version: Column) -> Column:
    """a.b.x of a.b, a.b.c, ...; empty if it isn't a version."""
    v = F.trim(version)
    return F.when(v.rlike(r"^\d+\.\d+"), F.concat(F.regexp_extract(v, r"^(\d+\.\d+)", 1), F.lit(".x"))).otherwise("")


def program_name(command: Column) -> Column:
    """Program of a command line: past wrappers (and their numeric argument), flags and NAME= assignments."""
    tokens = F.filter(F.split(F.trim(command), r"\s+"), lambda x: x != "")
    bases = F.transform(tokens, lambda x: F.element_at(F.split(x, "/"), -1))
    start = F.struct(F.lit(None).cast("string").alias("found"), F.lit(False).alias("number"))

    def step(acc: Column, base: Column) -> Column:
        skip = (acc["number"] & base.rlike(r"^\d+(\.\d+)?$")) | base.isin(WRAPPERS) | base.rlike("^-|^[A-Z_]+=")
        return F.struct(F.coalesce(acc["found"], F.when(~skip, base)).alias("found"), base.isin(NUMERIC_WRAPPERS).alias("number"))

    first = F.aggregate(bases, start, step, lambda a: a["found"])
    return F.when(F.size(tokens) > 0, F.coalesce(first, F.get(bases, F.lit(0))))


def parameterise(command: Column) -> Column:
    """Command with listener, target and port values as placeholders."""
    out = F.regexp_replace(command, r"(?i)\bLHOST=\S+", "LHOST={LHOST}")
    out = F.regexp_replace(out, r"(?i)\bLPORT=\d+", "LPORT={LPORT}")
    out = F.regexp_replace(out, PRIVATE_IP, "{TARGET_IP}")
    rare = r"(?:(?<=:)|(?<=-p ))(?!(?:" + "|".join(COMMON_PORTS) + r")\b)\d{2,5}\b"
    return F.regexp_replace(out, rare, "{PORT}")


# How a target's port is written, and ports that are too common to tell anything.
PORT_FLAG, PORT_IN_URL = r"(?:-p\s+|--port[=\s]+)(\d{2,5})\b", r"https?://[^\s/:]+:(\d{2,5})(?:/|\s|$)"
TOLD_PORTS = [20, 21, 22, 23, 25, 53, 80, 110, 143, 389, 443, 445, 587, 993, 995, 1433, 1521, 3000, 3306, 3389, 4369, 5432, 5900, 6379, 8080, 8443, 8888, 27017]


def target_ports(text: Column) -> Column:
    """Uncommon ports that a command names by a flag, then in URLs; distinct, without leading zeros."""
    named = F.concat(*[F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in (PORT_FLAG, PORT_IN_URL)])
    return F.array_distinct(F.filter(F.transform(named, lambda x: x.cast("int").cast("string")), lambda x: ~x.isin([str(p) for p in TOLD_PORTS])))


def sanitise_ip(text: Column) -> Column:
    return F.regexp_replace(text, r"\b\d{1,3}(?:\.\d{1,3}){3}\b", "<IP>")


def ip_topology(text: Column) -> Column:
    """Kind of the first address in the text."""
    return F.when(text.rlike(r"\b127(?:\.\d{1,3}){3}\b"), "loopback").when(text.rlike(PRIVATE_IP), "private").when(text.rlike(r"\b\d{1,3}(?:\.\d{1,3}){3}\b"), "public").otherwise("none")


# Where a text may end, in the order they are tried.
SENTENCE_ENDS = ["。", "！", "？", ".", "!", "?"]


def soft_truncate(text: Column, limit: int) -> Column:
    """At most limit characters, cut after the last of the first kind of sentence end that has one in the second half."""
    head = F.substring(text, 1, limit)
    last = lambda mark: F.when(F.locate(mark, F.reverse(head)) > 0, F.length(head) - F.locate(mark, F.reverse(head)) + 1)
    cuts = [F.when(last(mark) - 1 > limit // 2, F.substr(head, F.lit(1), last(mark))) for mark in SENTENCE_ENDS]
    return F.when(F.length(text) <= limit, text).otherwise(F.coalesce(*cuts, head))


def tokens(text: Column) -> Column:
    """Distinct lower-case words of two characters or more."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}_]+"), lambda x: F.length(x) >= 2))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def strip_html(html: Column) -> Column:
    """Text of a page: scripts and styles go first, then tags; entities of the basic set are resolved."""
    out = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    out = F.regexp_replace(out, r"(?s)<!--.*?-->|<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


# Words that aren't service names.
PLACEHOLDERS = ["none", "null", "unknown", "raw", "validated", "consolidated", "consolidates", "conflict", "conflicted", "active", "archived", "suspended", "deleted", "maturity", "anysvc", "service", "target", "http", "html", "trying"]


def service_name(raw: Column) -> Column:
    """Canonical service: lower case, without CVE ids, version tails and placeholder words; empty if nothing is left."""
    out = F.lower(F.trim(raw))
    out = F.regexp_replace(out, r"(?i)\bcve[-_\s]?\d{4}[-_\s]?\d{4,7}\b", " ")
    for _ in range(3):
        out = F.trim(F.regexp_replace(F.trim(out), r"[\s/_-]+v?\d+(?:\.[\dx]+)*$", ""))
    out = F.trim(F.regexp_replace(out, r"\s+", " "))
    return F.when(out.isin(PLACEHOLDERS) | out.rlike(r"^s\d{6,}$"), "").otherwise(out)


# Buckets of failure sub-dimensions, first match wins.
NEG_BUCKETS = [
    ("VERSION_MISMATCH|VERSION_MISJUDGMENT|ASSUMPTION_ERROR", "VERSION_OR_INTEL"),
    ("AUTHENTICATION|AUTHORIZATION|UNAUTHORIZED|FORBIDDEN|REDIRECT", "AUTH_OR_PERMISSION"),
    ("WAF|PATCH|DEFENSE|FILTER|VALIDATION", "DEFENSE_BLOCK"),
    ("PARAMETER|INPUT|SYNTAX|FORMAT|ARGUMENT", "INPUT_OR_USAGE"),
    ("TARGET_MISIDENTIFICATION|TARGET_MISJUDGMENT|PREMISE|INTEL", "TARGET_INTEL"),
    ("TOOL_MISSING|BINARY_MISSING|DEPENDENCY|ENV_", "TOOLING_ENV"),
    ("PARTIAL_SUCCESS_NO_EXPLOIT|NO_EXPLOIT|NO_EFFECT|INEFFECTIVE", "NO_EFFECT"),
]


def neg_bucket(sub_dimension: Column, dimension: Column) -> Column:
    """Stable bucket of a free-form failure sub-dimension."""
    text = F.upper(F.trim(F.coalesce(sub_dimension, F.lit(""))))
    out = F.when(text == "", F.coalesce(F.nullif(F.upper(F.trim(dimension)), F.lit("")), F.lit("UNKNOWN")))
    for pattern, bucket in NEG_BUCKETS:
        out = out.when(text.rlike(pattern), bucket)
    return out.otherwise(text)


def collapse(text: Column, limit: int = 257) -> Column:
    """Single spaces; longer texts end in an ellipsis."""
    flat = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(F.length(flat) > limit, F.concat(F.substring(flat, 1, limit), F.lit("..."))).otherwise(flat)


def timestamp(text: Column) -> Column:
    """Tolerant ISO parse: as it stands, else without the offset."""
    return F.coalesce(F.try_to_timestamp(text), F.try_to_timestamp(F.regexp_replace(text, r"([+-]\d\d:?\d\d|Z)$", "")))


def first_word(command: Column) -> Column:
    """Base name, in lower case, of the first word of a command; the word may be quoted."""
    quoted = F.coalesce(F.nullif(F.regexp_extract(command, r"^\s*\"([^\"]+)\"", 1), F.lit("")), F.nullif(F.regexp_extract(command, r"^\s*'([^']+)'", 1), F.lit("")))
    word = F.coalesce(quoted, F.regexp_extract(command, r"^\s*(\S*)", 1))
    return F.lower(F.regexp_extract(word, r"([^/\\]*)$", 1))


def code_summary(code: Column, limit: int = 2000) -> Column:
    """Code over the limit cut to what names things: imports, definitions, comments, CVEs, targets; its first 60 lines if that says little."""
    lines = F.split(code, r"\r?\n")
    telling = F.filter(lines, lambda v: v.rlike(r"^\s*(?:import |from |def |class |#|if __name__)|(?i)CVE-\d{4}-\d+|\b(?:host|target|port|payload|lhost|lport)\s*="))
    short = F.array_join(telling, "\n")
    chosen = F.when(F.length(short) < 100, F.array_join(F.slice(lines, 1, 60), "\n")).otherwise(short)
    return F.when(F.length(code) <= limit, code).otherwise(F.substr(chosen, F.lit(1), F.lit(limit)))
