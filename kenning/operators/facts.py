"""Facts in what tools print: ports, versions, paths, shares, headers, findings, signs of access, else a telling line.

All of it is arrays of structs built in the scan; only the de-duplication across a session shuffles, by fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kenning.functions import text as tx

# Phases, admitted verdicts, confidence, most characters of a result that are read.
RECON_PHASES = ["RECON_WEAPONIZATION", "ENV_PREPARATION"]
EXPLOIT_PHASES = ["EXPLOITATION", "ESCALATION", "LATERAL_MOVEMENT", "EXFILTRATION", "COMMAND_CONTROL"]
RECON_OUTCOMES, EXPLOIT_OUTCOMES = ["success", "partial_success", "uncertain"], ["success"]
CONFIDENCE = {"uncertain": 0.62, "partial_success": 0.72, "success": 0.75}
MOST_CHARS = 3000

# Facts that are kept only beside others.
PASSING = ["http_status", "open_port_evidence", "output_summary", "accessible_path", "url_found"]

# Lines that say nothing. Each must match at the start of the trimmed line.
NOISE = [
    r"\d{3}$",
    r"(?i)Starting Nmap",
    r"(?i)inet\d?\s+\S+",
    r"(?i)Started async session",
    r"\d+\.\d+\.\d+\.\d+:\d+",
    r"(?i)Nmap \d+\.\d+.*nmap\.org",
    r"(?i)lo\s+Link|(?i)eth\d+\s+Link|(?i)ens\d+",
    r"(?i)\[\*\]\s+(Starting|Loading|Initializ)",
    r"(?i)\[\*\]\s+(?:Creating|Building|Writing|Uploading|Compiling)",
    r"(?i)\[\*\]\s+Command to execute:",
    r"(?i)\d+ packets (transmitted|captured)",
    r"<!",
    r"(?i)</?[a-z][a-z0-9]*[\s>/]",
    r"(?i)</?[a-z][a-z0-9]*>$",
    r"(?i)Usage:\s+\w",
    r"(?i)/usr/share/",
    r"(?i)/usr/lib/",
    r"(?i)creating\s+wordlist\s+for",
    r"const\s+\w|var\s+\w|function\s*\(",
    r"//",
    r"\*\s+@\w",
    r"\.[a-zA-Z][\w-]*\s*[\{>]",
    r"(?i)[0-9a-f]{30,}$",
    r"(?i)(true|false|null|None|ok|yes|no|undefined)$",
    r"\./[\w./-]+$",
    r"-[a-zA-Z]\s",
    r"(?i)Trying\s+(password|credential|login)",
    r"[a-z][a-z0-9\-]*\s*\{",
    r"HTTP/\d+(?:\.\d+)?\s+\d{3}\b",
    r"if\s*\(",
    r"#[\w-]+\s*[\{,]",
    r"\*\s+\([Cc]\)",
    r"[a-z][\w-]+\s*:\s+\S+.*;\s*$",
    r"[A-Z]{3,}[-A-Z]*:\s+\S",
    r"(?i)~\s+Licensed",
    r"(?i)Date:\s+\w{3},\s+\d+\s+\w+\s+\d{4}",
    r"(?i)\[\*\].*\b(?:\d{1,3}\.){3}\d{1,3}\b.*:\d{3,5}",
    r"(?i)[~#]\s+(?:or more contributor|Licensed to)",
    r"(?i)X-Forwarded-For:\s+",
]
SUMMARY_NOISE = [
    r"Starting \w", r"Nmap scan report", r"Host is up", r"NSE:", r"PORT\s+STATE\s+SERVICE", r"Not shown:", r"Creating ", r"Checking (?:for|port)",
    r"Initializ", r"Setting up", r"Started ", r"Loading ", r"Waiting ", r"inet6? ", r"lo\s", r"eth\d", r"ens\d", r"wlan", r"docker", r"br-", r"virbr",
    r"\d+ packets trans", r"\d+ packets cap", r"\$\s*\{", r"const\s+\w", r"var\s+\w", r"function\s*\(", r"\[\*\]\s*(?:Starting|Initializ|Loading)",
]
LEAST_CHARS, MARKUP_CHARS, MARKUP_TAGS, SUMMARY_CHARS = 6, 50, 3, 200
LOOPBACK, INNER_ADDRESS = r"\b127\.0\.0\.1\b", r"\b(?:10|172\.(?:1[6-9]|2\d|3[01])|192\.168)\.\d+\.\d+\b"

# What facts look like.
PORT_LINE = r"(?i)(\d{1,5}/(?:tcp|udp))[^\S\n]+open[^\S\n]+(\S+)(?:[^\S\n]+([^\n]+))?"
STATUS_LINE, STATUSES = r"HTTP/\d+(?:\.\d+)?\s+(\d{3})\b", ["200", "301", "302", "401", "403", "404", "500"]
PATHS = [r"(?i)(?:Found|Status[:=]\s*200|200 OK)\s.*?(/[^\s\"']{2,})", r"(/[a-zA-Z0-9_\-./]{2,})\s+[\[\(](?:Status:\s*)?(?:200|301|302)"]
SHARE = r"(?i)(?:Disk|IPC|ADMIN)\$?\s+\|.*\|"
FINDING, FINDING_CHARS = r"(?m)^\+\s+(?!.*OSVDB)(.{20,120})", 2000
VERSION = r"\b([A-Za-z][A-Za-z0-9_\-]{2,25})/(\d+[\d.]{1,15})\b"
SYSTEMS = ["ubuntu", "debian", "centos", "fedora", "alpine", "windows", "macos", "kali", "arch", "mint"]
PROTOCOLS = ["HTTP", "HTTPS", "TCP", "UDP", "SSL", "TLS", "IP", "FTP", "SSH", "SMTP", "DNS", "RPC", "PORT", "SERVICE", "PROTO", "PROTOCOL"]
HEADERS = ["Server", "X-Powered-By", "X-Generator"]
OPEN_PORT = r"(?i)(?:open port|port\s+(\d{1,5})\s+(?:is\s+)?open|(\d{1,5})\s+open)"
CONFIRMING, AROUND = ["vulnerable", "confirmed", "detected", "affected", "exploitable", "exploited", "pwned", "popped", "漏洞确认", "已被利用"], 120
# Signs of access: pattern, key, value (None: from the match).
SIGNS = [
    (r"(?i)uid=0\(root\)", "privilege_root", "uid=0(root) — 已获取 root 权限"),
    (r"root@[a-zA-Z0-9_\-]+", "shell_root", "root shell 获取成功"),
    (r"flag\{([^}]{1,80})\}", "flag_captured", None),
    (r"(?i)(-\S{2}[sS]\S{6}\s+\d+\s+\S+\s+root\b[^\n]*)", "suid_binary", None),
    (r"(?i)/etc/shadow", "file_shadow", "/etc/shadow 可读"),
    (r"(?i)/etc/passwd", "file_passwd", "/etc/passwd 可读"),
    (r"root:x:0:0:", "file_read_passwd", None),
    (r"root:[*$!][^:]*:\d+:\d+:", "file_read_shadow", "成功读取 /etc/shadow — 含密码哈希（root 账户可发现）"),
    (r"(?i)(?:authentication|login)\s+successful", "auth_bypass", "认证绕过/登录成功"),
    (r"(?i)sudo.*NOPASSWD", "sudo_nopasswd", "sudo NOPASSWD 配置存在"),
]
ACCOUNT, PEOPLE_FROM, MOST_PEOPLE = r"(?m)^([a-zA-Z0-9_\-]+):x?:([0-9]+):[0-9]+:", 1000, 5
HTTP_PROGRAMS = ["curl", "httpx", "wget", "gobuster", "dirsearch", "feroxbuster", "nikto", "ffuf", "wfuzz", "wpscan"]

# Kinds of service by what the port table, a command or a well-known port says.
NAMED_SERVICES, DATABASE_WORDS = ["ssh", "ftp", "smtp", "smb", "ldap", "rdp", "vnc", "dns"], ["sql", "db", "oracle", "mysql", "postgres"]
SERVICE_WORDS = [
    ("http", ["http", "https", "curl", "wget", "web", "nikto", "gobuster", "dirsearch", "ferox", "burp", "wfuzz", "ffuf", "wpscan", "nuclei", "zaproxy"]),
    ("ssh", ["ssh", "scp", "sftp", "paramiko", "evil-winrm"]),
    ("smb", ["smb", "samba", "enum4linux", "smbclient", "rpcclient", "crackmapexec", "impacket"]),
    ("ftp", ["ftp", "vsftpd", "ftplib"]),
    ("database", ["sql", "mysql", "mariadb", "postgres", "psql", "mssql", "oracle", "sqlite", "sqlmap"]),
    ("nosql", ["redis", "memcached", "mongo", "elasticsearch", "couchdb", "cassandra"]),
    ("ldap", ["ldap", "ldapsearch", "kerberos", "kerbrute"]),
    ("rdp", ["rdp", "rdesktop", "xfreerdp", "remmina"]),
    ("network_scan", ["nmap"]),
]
SERVICE_PORTS = {
    "22": "ssh", "21": "ftp", "23": "telnet", "25": "smtp", "80": "http", "443": "http", "445": "smb", "3389": "rdp", "3306": "database", "5432": "database",
    "1433": "database", "6379": "nosql", "5984": "nosql", "27017": "nosql", "9200": "nosql", "389": "ldap", "636": "ldap",
}
TARGET_HEADERS = ["Server", "X-Powered-By", "X-Generator", "X-AspNet-Version"]
TARGET_VERSION, NOT_PRODUCTS = r"\b([A-Za-z][A-Za-z0-9_\-]{3,25})[/_ ](\d+\.\d[\d.]*)\b", ["version", "release", "revision", "edition", "spec", "patch"]

KIND = "array<struct<key:string,value:string,service:string,version:string>>"


def _fact(key, value: Column, service: Column | None = None, version: Column | None = None) -> Column:
    empty = F.lit("")
    return F.struct((F.lit(key) if isinstance(key, str) else key).alias("key"), value.alias("value"), (empty if service is None else service).alias("service"), (empty if version is None else version).alias("version"))


def _facts(key: str, values: Column) -> Column:
    return F.transform(values, lambda v: _fact(key, v))


def _all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _clear_lines(text: Column) -> Column:
    """Lines without a URL."""
    return F.filter(F.split(text, "\n"), lambda x: ~x.rlike("(?i)https?://"))


def told() -> Column:
    """What a tool printed, up to MOST_CHARS."""
    return F.substring(F.coalesce("stdout", F.lit("")), 1, MOST_CHARS)


def action() -> Column:
    """The command, else the code."""
    return F.coalesce(F.nullif("command", F.lit("")), "code", F.lit(""))


def low_value(line: Column) -> Column:
    """Too short, noise, or mostly markup."""
    bare = tx.strip(line)
    many = lambda mark: F.length(bare) - F.length(F.replace(bare, F.lit(mark), F.lit(""))) > MARKUP_TAGS
    return (F.length(bare) < LEAST_CHARS) | bare.rlike("^(?:" + "|".join(f"(?:{p})" for p in NOISE) + ")") | ((F.length(bare) > MARKUP_CHARS) & many("<") & many(">"))


def ports(text: Column) -> Column:
    part = lambda x, i: tx.strip(F.regexp_extract(x, PORT_LINE, i))
    return F.transform(_all(text, PORT_LINE), lambda x: _fact("open_port", part(x, 1), part(x, 2), F.substring(part(x, 3), 1, 100)))


def responses(text: Column) -> Column:
    """HTTP statuses and the paths that directory searches found."""
    statuses = F.filter(_all(text, STATUS_LINE, 1), lambda s: s.isin(STATUSES))
    found = F.concat(*[_all(text, p, 1) for p in PATHS])
    return F.concat(_facts("http_status", F.array_distinct(statuses)), _facts("accessible_path", F.array_distinct(F.transform(found, lambda p: F.substring(p, 1, 100)))))


def mentioned(text: Column) -> Column:
    """CVEs, as confirmed if a confirming word is near the first mention."""

    def one(cve: Column) -> Column:
        at = F.instr(F.upper(text), cve)
        begin = F.greatest(at - AROUND, F.lit(1))
        near = F.lower(F.substr(text, begin, at + F.length(cve) + AROUND - begin))
        return _fact(F.when(near.rlike("|".join(CONFIRMING)), "cve_confirmed").otherwise("cve_mentioned"), cve)

    return F.transform(tx.cves(text), one)


def versions(text: Column) -> Column:
    """Product/version strings outside URLs that name neither a system, a hash, a protocol nor a port."""

    def good(x: Column) -> Column:
        product, version = F.regexp_extract(x, VERSION, 1), F.regexp_extract(x, VERSION, 2)
        port = ~version.contains(".") & version.try_cast("long").between(1, 65535)
        return ~(F.lower(product).isin(SYSTEMS) | F.lower(product).rlike("^[0-9a-f]{6,}$") | F.upper(product).isin(PROTOCOLS) | port)

    found = F.flatten(F.transform(_clear_lines(text), lambda line: _all(line, VERSION)))
    return _facts("service_version", F.transform(F.filter(found, good), lambda x: F.substring(x, 1, 80)))


def headers(text: Column) -> Column:
    """The first value of each telling response header."""

    def one(name: str) -> Column:
        pattern = rf"(?im)^{name}:\s*(.+)"
        return F.when(text.rlike(pattern), _fact(f"http_header_{name.lower()}", F.substring(tx.strip(F.regexp_extract(text, pattern, 1)), 1, 100)))

    return F.array_compact(F.array(*[one(h) for h in HEADERS]))


def summary(text: Column, strict: bool = True) -> Column:
    """The first line that says something; strict: without colours and addresses, and no line of a tool's progress."""
    lines = F.transform(F.split(text, "\n"), lambda x: tx.strip(x))
    if strict:
        bare = F.transform(lines, lambda x: F.regexp_replace(x, r"\x1b\[[0-9;]*[mGKHF]", ""))
        lines = F.transform(bare, lambda x: F.regexp_replace(F.regexp_replace(x, LOOPBACK, "{LOOPBACK}"), INNER_ADDRESS, "{TARGET}"))
        lines = F.filter(lines, lambda x: ~x.rlike("(?i)^(?:" + "|".join(SUMMARY_NOISE) + ")"))
    return F.slice(_facts("output_summary", F.transform(F.filter(lines, lambda x: (x != "") & ~low_value(x)), lambda x: F.substring(x, 1, SUMMARY_CHARS))), 1, 1)


def generic(text: Column) -> Column:
    """Shares, CVEs, findings, versions, headers and open ports; without any the first telling line."""
    shares = F.transform(_all(text, SHARE), lambda x: F.substring(tx.strip(x), 1, 150))
    findings = F.transform(_all(F.substring(text, 1, FINDING_CHARS), FINDING, 1), lambda x: F.substring(tx.strip(x), 1, 150))
    opened = F.transform(_all(text, OPEN_PORT), lambda x: F.coalesce(F.nullif(F.regexp_extract(x, OPEN_PORT, 1), F.lit("")), F.regexp_extract(x, OPEN_PORT, 2)))
    found = F.concat(_facts("smb_share", shares), mentioned(text), _facts("nikto_finding", findings), versions(text), headers(text), _facts("open_port_evidence", F.filter(opened, lambda x: x != "")))
    return F.when(F.size(found) > 0, F.array_distinct(found)).otherwise(summary(text))


def people(text: Column) -> Column:
    """Whose accounts an account file holds: root, and people by their number."""
    rows = F.transform(_all(text, ACCOUNT), lambda x: F.struct(F.regexp_extract(x, ACCOUNT, 1).alias("name"), F.regexp_extract(x, ACCOUNT, 2).cast("decimal(38,0)").alias("uid")))
    names = F.slice(F.transform(F.filter(rows, lambda r: (r["uid"] >= PEOPLE_FROM) & (r["name"] != "nobody")), lambda r: r["name"]), 1, MOST_PEOPLE)
    root = F.when(F.exists(rows, lambda r: r["name"] == "root"), "root")
    told_people = F.when(F.size(names) > 0, F.concat(F.lit("普通用户: "), F.array_join(names, ", "))).otherwise("无普通用户")
    return F.when(F.size(rows) > 0, F.concat(F.lit("系统用户: "), F.array_join(F.array_compact(F.array(root, told_people)), ", "))).otherwise("成功读取 /etc/passwd 内容")


def access(text: Column) -> Column:
    """Signs that something was reached."""

    def shown(pattern: str, key: str, value: str | None, match: Column) -> Column:
        if key == "flag_captured":
            return F.concat(F.lit("flag{"), F.regexp_extract(match, pattern, 1), F.lit("}"))
        if key == "suid_binary":
            return F.substring(tx.strip(match), 1, 120)
        return people(text) if key == "file_read_passwd" else F.lit(value)

    def signs(pattern: str, key: str, value: str | None) -> Column:
        return F.transform(_all(text, pattern), lambda x: _fact(key, shown(pattern, key, value, x)))

    return F.array_distinct(F.concat(*[signs(*sign) for sign in SIGNS]))


def found(text: Column, tool: Column, command: Column, phase: Column) -> Column:
    """The facts of a result, read as the phase and the program ask for; without any the first telling line."""
    program = F.coalesce(F.nullif(tx.first_word(command), F.lit("")), F.lower(tool))
    scanned = F.lower(F.concat_ws(" ", tool, command)).contains("nmap")
    besides = F.filter(generic(text), lambda f: f["key"].isin("cve_confirmed", "cve_mentioned", "service_version"))
    facts = F.when(phase.isin(EXPLOIT_PHASES), F.concat(access(text), besides)).when(scanned, ports(text)).when(program.isin(HTTP_PROGRAMS), responses(text)).otherwise(generic(text))
    return F.when(F.size(facts) > 0, facts).otherwise(summary(text, strict=False))


def prune(facts: Column) -> Column:
    """Lasting facts and, only beside one of them, the first passing one."""
    passing = lambda f: f["key"].isin(PASSING)
    lasting = F.filter(facts, lambda f: ~passing(f))
    return F.when(F.size(lasting) > 0, F.concat(lasting, F.slice(F.filter(facts, passing), 1, 1))).otherwise(lasting)


def service_type(tool: Column, command: Column, text: Column) -> Column:
    """Kind of the service that a call meets: by its port table, its headers, the words of the call, the target's port."""
    listed = F.lower(F.regexp_extract(text, r"(?i)\d+/(?:tcp|udp)\s+open\s+(\S+)", 1))
    words = F.lower(F.concat_ws(" ", tool, command, F.substring(text, 1, 200)))
    out = F.when(listed.startswith("http"), "http").when(listed.isin(NAMED_SERVICES), listed).when(listed.rlike("|".join(DATABASE_WORDS)), "database")
    out = out.when(text.rlike(r"(?im)^(?:Server|X-Powered-By):\s*.+"), "http")
    for kind, marks in SERVICE_WORDS:
        out = out.when(words.rlike("|".join(marks)), kind)
    table = F.create_map(*[F.lit(x) for pair in SERVICE_PORTS.items() for x in pair])
    kinds = F.array_compact(F.transform(tx.target_ports(command), lambda p: F.try_element_at(table, p)))
    return out.otherwise(F.coalesce(F.get(kinds, F.lit(0)), F.lit("generic")))


def target_service(text: Column, cves: Column) -> Column:
    """What the output says the target runs: port table, response header, product and version, else the first CVE; null without."""
    row = r"(?i)\d+/(?:tcp|udp)\s+open\s+(\S+)(?:\s+(.+))?"
    listed = tx.strip(F.concat_ws(" ", F.regexp_extract(text, row, 1), F.substring(tx.strip(F.regexp_extract(text, row, 2)), 1, 80)))
    header = [F.substring(tx.strip(F.regexp_extract(text, rf"(?im)^{h}:\s*(.+)", 1)), 1, 80) for h in TARGET_HEADERS]
    product = F.filter(F.flatten(F.transform(_clear_lines(text), lambda line: _all(line, TARGET_VERSION))), lambda x: ~F.lower(F.regexp_extract(x, TARGET_VERSION, 1)).isin(NOT_PRODUCTS))
    said = [F.nullif(x, F.lit("")) for x in (listed, *header, F.substring(tx.strip(F.get(product, F.lit(0))), 1, 80))]
    return F.coalesce(*said, F.concat(F.lit("目标存在 "), F.get(cves, F.lit(0)), F.lit(" 漏洞的服务")))


def gate() -> Column:
    """Reconnaissance may be partial or uncertain, anything else must have succeeded; no knowledge search; something was printed."""
    recon = F.col("phase").isin(RECON_PHASES) & F.col("outcome_label").isin(RECON_OUTCOMES)
    beyond = F.col("phase").isin(EXPLOIT_PHASES) & F.col("outcome_label").isin(EXPLOIT_OUTCOMES)
    return (recon | beyond) & (F.col("category") != "RAG_QUERY") & (tx.strip(told()) != "")


def event_facts(annotated: DataFrame) -> DataFrame:
    """session_id, event_id, turn_index, service_type, confidence, facts: what an event was first to tell in its session, pruned."""
    share = F.create_map(*[x for k, v in CONFIDENCE.items() for x in (F.lit(k), F.lit(v))])
    own = ["session_id", "event_id", "turn_index"]
    read = annotated.filter(gate()).select(*own, "phase", share[F.col("outcome_label")].alias("confidence"), service_type(F.col("tool_name"), action(), told()).alias("service_type"), found(told(), F.col("tool_name"), action(), F.col("phase")).alias("facts"))
    each = read.select(*own, "phase", "confidence", "service_type", F.posexplode("facts").alias("pos", "f"))
    at = F.struct("turn_index", "event_id", "pos")
    first = each.groupBy("session_id", "f.key", "f.value").agg(F.min_by(F.struct(*each.columns), at).alias("x"), F.count(F.lit(1)).alias("n"))
    kept = first.select("x.*", "n").groupBy(*own, "phase", "confidence", "service_type").agg(F.sort_array(F.collect_list(F.struct("pos", "f", "n"))).alias("fs"))
    pruned = kept.withColumn("facts", prune(F.transform("fs", lambda x: F.struct(x["f"]["key"].alias("key"), x["f"]["value"].alias("value"), x["f"]["service"].alias("service"), x["f"]["version"].alias("version"), x["n"].alias("n")))))
    bare = F.forall("facts", lambda f: f["key"] == "output_summary") & F.col("phase").isin(RECON_PHASES) & (F.col("service_type") == "http")
    return pruned.filter((F.size("facts") > 0) & ~bare).select(*own, "service_type", "confidence", "facts")


def session_facts(annotated: DataFrame) -> DataFrame:
    """session_id, turn_index, key, value, service, version, n: each fact of a session once, where it was first told."""
    return event_facts(annotated).select("session_id", "turn_index", "event_id", F.explode("facts").alias("f")).select("session_id", "turn_index", "event_id", "f.key", "f.value", "f.service", "f.version", "f.n")
