"""Hand tables for rules, weights, calibration, conflicts, queue, quality, distillation, merges, corpus and streams."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from kenning.functions import text as tx
from kenning.operators import annotate, corpus, distil, evaluate, facts, fusion, govern, graph, merge, report, serve
from kenning.plans import batch, experience_queries, store
from kenning.sources import turns
from kenning.streaming import turns as stream_turns
from kenning.streaming import windows

EVENT = "session_id string, turn_index int, event_id long, tool_name string, category string, command string, code string, has_result boolean, return_code int, timed_out boolean, success boolean, stdout string, stderr string"


def event(i, **k):
    base = dict(session_id="s", turn_index=i, event_id=i, tool_name="shell", category="GENERIC_COMMAND_CALL", command="nmap h", code="", has_result=True, return_code=0, timed_out=False, success=True, stdout="", stderr="") | k
    return tuple(base[c.split()[0]] for c in EVENT.split(", "))


def one(spark, column, **cells):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cells.items()])
    return row.select(column.alias("x")).first().x


def test_rules_and_verdicts(spark):
    cases = [
        (dict(return_code=127, stderr="gobuster: not found", success=False), "RC-127", "failure"),
        (dict(return_code=126, success=False), "RC-126", "failure"),
        (dict(return_code=124, success=False), "RC-124", "failure"),
        (dict(return_code=1, timed_out=True, success=False), "TOUT", "timeout"),
        (dict(return_code=1, success=False), None, "failure"),
        (dict(stdout="uid=0(root) error"), None, "partial_success"),
        (dict(stdout="no errors at all"), None, "success"),
        (dict(stdout="saw 404 there"), None, "failure"),
        (dict(return_code=None, success=None), None, "uncertain"),
        (dict(has_result=False, return_code=None, success=None), None, "uncertain"),
        (dict(stdout="request timed out"), None, "timeout"),
    ]
    df = annotate.annotate(spark.createDataFrame([event(i, **c) for i, (c, _, _) in enumerate(cases)], EVENT))
    out = {r.event_id: r for r in df.collect()}
    for i, (_, rule, verdict) in enumerate(cases):
        assert ((out[i].rule or {"rule": None})["rule"], out[i].outcome_label) == (rule, verdict), i
    assert out[0].rule.evidence == "return_code=127 (binary=gobuster, tool=shell)" and out[3].rule.hint.startswith("增大") and out[4].cause.sub_dimension == "WRONG_ARGS" and out[4].needs_cause and not out[0].needs_cause
    assert out[7].needs_cause and out[9].cause is None


def test_program_names(spark):
    cases = {"sudo timeout 30 nmap x": "nmap", "FOO=1 env /usr/bin/curl -s u": "curl", "nice -n 10 ls": "10", "timeout 5s x": "5s", "": None, "sudo": "sudo", "/bin/ls": "ls"}
    rows = spark.createDataFrame([(k,) for k in cases], "c string").select("c", tx.program_name(F.col("c")).alias("p")).collect()
    assert {r.c: r.p for r in rows} == cases


def test_text_functions(spark):
    assert one(spark, tx.cves_loose(F.col("t")), t="cve_2021 44228, CVE-2017-5638 cve20215555") == ["CVE-2017-5638", "CVE-2021-44228", "CVE-2021-5555"]
    assert [one(spark, tx.version_family(F.col("t")), t=t) for t in ("10.3.6.0", "2.0", "7", "", " 1.2 ")] == ["10.3.x", "2.0.x", "", "", "1.2.x"]
    assert one(spark, tx.soft_truncate(F.col("t"), 10), t="abcdefg. hijk") == "abcdefg." and one(spark, tx.soft_truncate(F.col("t"), 10), t="a. cdefghijk") == "a. cdefghi"
    assert one(spark, tx.soft_truncate(F.col("t"), 10), t="一二三四五六七。a.b." * 2) == "一二三四五六七。" and one(spark, tx.soft_truncate(F.col("t"), 10), t="。bcdefg!?xyz") == "。bcdefg!"
    assert abs(one(spark, tx.jaccard(tx.tokens(F.col("a")), tx.tokens(F.col("b"))), a="run scan port", b="scan port host deep") - 0.4) < 1e-9
    assert one(spark, tx.strip_html(F.col("t")), t="<p>a&amp;b<script>x<y</script><!-- c --> d</p>") == "a&b d"
    assert one(spark, tx.collapse(F.col("t"), 5), t=" a  b\ncdefg") == "a b c..."
    assert one(spark, tx.timestamp(F.col("t")).isNull(), t="never") and not one(spark, tx.timestamp(F.col("t")).isNull(), t="2026-01-01T00:00:00+00:00")
    assert [one(spark, tx.neg_bucket(F.col("a"), F.col("b")), a=a, b="ENV") for a in ("", "waf block", "x")] == ["ENV", "DEFENSE_BLOCK", "X"]


EXP = "exp_id long, layer string, service string, cves array<string>, version string, session_id string, confidence double, outcome string, maturity string, age_days int, lifecycle string, max_turn int, dimension string, sub_dimension string, phase string"


def exp(i, cves=(), version="", **k):
    base = dict(exp_id=i, layer="PROCEDURAL_POS", service="x", cves=list(cves), version=version, session_id=f"s{i}", confidence=0.95, outcome="success", maturity="raw", age_days=0, lifecycle="active", max_turn=0, dimension="", sub_dimension="", phase="EXPLOITATION") | k
    return tuple(base[c.split()[0]] for c in EXP.split(", "))


def clusters(spark, rows):
    df = fusion.clusters(spark.createDataFrame(rows, EXP))
    by = {}
    for r in df.collect():
        by.setdefault(r.cluster_id, set()).add(r.exp_id)
    return sorted(map(sorted, by.values()))


def test_bridges(spark):
    assert clusters(spark, [exp(1, ["C1"]), exp(2, ["C2"]), exp(3)]) == [[1, 2, 3]]
    assert clusters(spark, [exp(1, ["C1"]), exp(2, ["C2"])]) == [[1], [2]]
    assert clusters(spark, [exp(1, version="1.0"), exp(2, version="2.0"), exp(3)]) == [[1, 2, 3]]
    assert clusters(spark, [exp(1, version="1.0"), exp(2, version="2.0"), exp(3, version="1.0.4")]) == [[1, 3], [2]]
    assert clusters(spark, [exp(1), exp(2, lifecycle="archived"), exp(3, service="y")]) == [[1], [3]]


def test_weights_and_calibration(spark):
    assert abs(one(spark, fusion.raw_weight(), confidence=0.95, maturity="raw", outcome="success", max_turn=0, cves=["c"]) - 0.4332) < 1e-9
    rows = [exp(1, confidence=0.2, maturity="consolidated", outcome="possible_success"), exp(2, confidence=0.5, maturity="consolidated", outcome="possible_success"), exp(3, confidence=0.8, maturity="consolidated", outcome="possible_success")]
    w = {r.exp_id: r.w_norm for r in fusion.weigh(fusion.clusters(spark.createDataFrame(rows, EXP))).collect()}
    assert [round(w[i], 6) for i in (1, 2, 3)] == [0.3, 0.65, 1.0]
    same = fusion.weigh(fusion.clusters(spark.createDataFrame([exp(i) for i in (1, 2, 3)], EXP)))
    c = fusion.calibrate(same).first()
    assert abs(c.p_fused - 0.944038) < 1e-6 and (c.maturity_before, c.maturity_after, c.should_reflux) == ("raw", "consolidated", True)
    old = fusion.calibrate(fusion.weigh(fusion.clusters(spark.createDataFrame([exp(i, age_days=300) for i in (1, 2, 3)], EXP)))).first()
    assert abs(old.p_fused - 0.634474) < 1e-6 and old.maturity_after == "validated"
    mixed = spark.createDataFrame([("A", 0.9, 0.65), ("B", 0.6, 0.5)], "s string, p double, w double").agg(fusion.noisy_or(F.col("p"), F.col("w")).alias("x")).first().x
    assert abs(mixed - 0.7095) < 1e-9
    assert [round(one(spark, fusion.beta_update(F.col("p"), F.col("n")), p=p, n=4), 4) for p in (0.4, 0.8)] == [0.4333, 0.8]
    suspended = fusion.suspend(spark.createDataFrame([exp(1, layer="CONCEPTUAL", confidence=0.3, age_days=183), exp(2, layer="CONCEPTUAL", confidence=0.3, age_days=182), exp(3, layer="PROCEDURAL_NEG", confidence=0.72, age_days=212)], EXP))
    assert {r.exp_id: r.lifecycle_after for r in suspended.collect()} == {1: "suspended", 2: "active", 3: "suspended"}


def test_votes(spark):
    items = spark.createDataFrame([(1, 1, 0.5, "a"), (1, 2, 0.3, "b"), (1, 2, 0.3, "a"), (1, 3, 0.2, "c")], "cluster_id long, exp_id long, weight double, item string")
    assert {r.item: (round(r.share, 6), r.wins) for r in fusion.weighted_vote(items, 0.4).collect()} == {"a": (0.8, True), "b": (0.3, False), "c": (0.2, False)}
    assert [r.item for r in fusion.weighted_union(items, 0.25, 8).filter("kept").orderBy("rank").collect()] == ["a", "b"]
    status = spark.createDataFrame([(1, "C", "patched-500", 0.3), (1, "C", "patched-auth", 0.4), (1, "C", "failed", 0.5)], "cluster_id long, cve string, status string, weight double")
    r = fusion.status_vote(status).first()
    assert (r.winner, r.label, r.evidence) == ("patched", "patched-auth", 3)
    actions = ["use CVE-2021-0001 and CVE-2021-0002", "then CVE-2021-0001", "scan", "scan again"]
    assert one(spark, fusion.covered_dedupe(F.col("a")), a=actions) == [actions[0], *actions[2:]]


def test_components_of_paths(spark):
    rng = random.Random(1)
    ids = list(range(300))
    rng.shuffle(ids)
    edges = [(ids[i], ids[i + 1]) for i in range(199)] + [(ids[i], ids[200]) for i in range(201, 300)] + [(5, 5)]
    out = {r.node: r.root for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {x: min(ids[:200]) if k < 200 else min(ids[200:]) for k, x in enumerate(ids)}
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_conflicts_and_gate(spark):
    neg = spark.createDataFrame([(1, "run scan port", "web", ["C1"]), (2, "alpha beta", "", [])], "id long, text string, service string, cves array<string>")
    pos = spark.createDataFrame([(10, "try scan port host deep run", "web", ["C1"]), (11, "run scan port", "db", []), (12, "run scan port", "", ["C2"]), (13, "alpha gamma delta epsilon zeta eta", "q", [])], "id long, text string, service string, cves array<string>")
    out = {(r.a, r.b): (round(r.score, 4), r.band, r.recommends) for r in govern.conflicts(neg, pos).collect()}
    assert out == {(1, 10): (0.5, "conflict", True), (2, 13): (0.1429, "skip", False)}


def test_queue(spark):
    columns = "gap_id long, session_id string, service string, sub_dimension string, priority string, status string, retry_count int, arrival long"
    q = spark.createDataFrame([(1, "s1", "a", "x", "P1", "pending", 0, 1), (2, "s2", "b", "x", "P1", "pending", 2, 2), (3, "s3", "c", "x", "P0", "pending", 0, 3)], columns)
    new = spark.createDataFrame([(1, "n", "n", "n", "P0", "pending", 0, 4), (4, "s1", "z", "x", "P0", "pending", 0, 5), (5, "s9", "a", "x", "P0", "pending", 0, 6), (6, "s9", "w", "y", "P0", "pending", 0, 7), (7, "s9", "v", "y", "P0", "pending", 0, 8)], columns)
    assert sorted(r.gap_id for r in govern.push_if_new(q, new).collect()) == [1, 2, 3, 6]
    assert {r.gap_id: r.status for r in govern.dequeue(q, "P1", 1).collect()} == {1: "processing", 2: "pending", 3: "pending"}
    results = spark.createDataFrame([(1, True), (2, False), (3, False)], "gap_id long, ok boolean")
    assert {r.gap_id: (r.status, r.retry_count) for r in govern.settle(q, results).collect()} == {1: ("done", 0), 2: ("failed", 3), 3: ("pending", 1)}
    up = govern.upsert(q, spark.createDataFrame([(1, "done"), (9, "pending")], "gap_id long, status string"), "gap_id")
    assert {r.gap_id: r.status for r in up.collect()} == {1: "done", 2: "pending", 3: "pending", 9: "pending"}
    assert govern.insert_if_absent(q, q.withColumn("gap_id", F.col("gap_id") + 2), "gap_id").count() == 5


def test_quality(spark):
    long = "x" * 200
    score = lambda t, u: govern.with_quality(spark.createDataFrame([(t, u)], "text string, url string")).first().quality
    assert score("short", "https://github.com/a").reason == "too_short"
    r = score(long + " payload = 1 CVE-2021-44228", "https://www.github.com/a/b/blob/x")
    assert round(r.score, 6) == 1.0 and r.has_poc and r.has_cve and not r.has_commands
    assert score(long, "https://example.com/").reason == "low_quality_no_actionable_content"
    assert round(score(long + "\n$ nmap h\nmsf> use exploit/y", "https://nvd.nist.gov/1").score, 6) == 1.0


def test_documents_and_budget(spark):
    row = spark.createDataFrame([(1, "FACTUAL", "web", "raw", ["CVE-2021-1"], "some text", "x"), (2, "FACTUAL", "web", "raw", [], "w " * 400 + "```", "x")], "exp_id long, layer string, service string, maturity string, cves array<string>, text string, sub_dimension string")
    out = {r.exp_id: r.i for r in govern.retrieval_document(row).withColumn("i", govern.document_issues()).collect()}
    assert out[1] == [] and [x.split(":")[0] for x in out[2]] == ["too_long_words", "code_like_content"]
    bare = row.withColumn("doc_text", F.lit("nothing")).withColumn("i", govern.document_issues()).filter("exp_id = 1").first().i
    assert bare == ["missing_header_mark", "missing_header_layer", "missing_header_target_service", "missing_query_hints", "missing_cve_ids:CVE-2021-1"]
    docs = spark.createDataFrame([("q", i, "x" * 40) for i in range(4)] + [("r", 0, "x" * 200)], "q string, i int, text string")
    assert [(r.q, r.i) for r in govern.byte_budget(docs, "q", ["i"], 5, 100).orderBy("q", "i").collect()] == [("q", 0), ("q", 1)]


def test_rule_evidence(spark):
    """What a missing program's rule says: named by the shell, by the tool, or not at all; by package and by releases."""
    cases = [("sh: 1: dirb: not found", "dirb_scan"), ("msfconsole: not found", "metasploit_run"), ("fscan: not found", "fscan"), ("odd: not found", ""), ("bash: x: command not found", "x_run"), ("", "")]
    rows = spark.createDataFrame([event(i, return_code=127, stderr=e, tool_name=t) for i, (e, t) in enumerate(cases)], EVENT).withColumn("r", annotate.rule_hit())
    out = [r.r for r in rows.orderBy("event_id").collect()]
    assert [r.evidence for r in out] == ["return_code=127 (binary=dirb, tool=dirb_scan)", "return_code=127 (binary=msfconsole, tool=metasploit_run)", "return_code=127 (binary=fscan, tool=fscan)", "return_code=127 (binary=odd)", "return_code=127 (tool=x_run)", "return_code=127"]
    assert "apt install dirb 安装" in out[0].hint and "apt install metasploit-framework" in out[1].hint and "releases" in out[2].hint and "apt install fscan" not in out[2].hint
    assert "apt install odd" in out[3].hint and out[4].hint.startswith("x_run 依赖") and "绝对路径" in out[5].hint
    codes = spark.createDataFrame([event(i, return_code=c, tool_name="t") for i, c in enumerate((126, 124, 130, 137, 143))], EVENT).withColumn("r", annotate.rule_hit())
    assert [r.r.sub_dimension for r in codes.orderBy("event_id").collect()] == ["EXECUTE_PERMISSION_DENIED", "TIMEOUT", "INTERRUPTED", "SIGKILL", "SIGTERM"]


def told(spark, text, tool="shell", command="x", phase="RECON_WEAPONIZATION"):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in dict(t=text, tool=tool, command=command, phase=phase).items()])
    return [(f.key, f.value) for f in row.select(facts.found(F.col("t"), F.col("tool"), F.col("command"), F.col("phase")).alias("f")).first().f]


def test_facts(spark):
    scan = "22/tcp open ssh OpenSSH 8.2\n80/tcp  open  http"
    assert told(spark, scan, "nmap_scan") == [("open_port", "22/tcp"), ("open_port", "80/tcp")]
    assert one(spark, facts.ports(F.col("t")), t=scan)[0].version == "OpenSSH 8.2"
    assert told(spark, "HTTP/1.1 200 fine\nHTTP/1.1 418 x", command="curl h") == [("http_status", "200")]
    assert told(spark, "/admin (Status: 301)\nFound x /login\n/admin [200", command="gobuster dir") == [("accessible_path", "/login"), ("accessible_path", "/admin")]
    text = "Disk$ | share | x |\nCVE-2021-44228 is exploitable\n" + "." * 300 + "\ncve-2017-5638 named\n+ /icons/: this is a finding of the scanner\n+ OSVDB-1: this is a reference and no finding\nnginx/1.18.0 Ubuntu/20.04 abcdef12/1.2 HTTP/1.1 tcp/8080 srv/8080\nsee http://h/lib/9.9\nserver: Apache\nX-Powered-By: PHP/7.4\nport 9000 is open"
    assert told(spark, text) == [("smb_share", "Disk$ | share | x |"), ("cve_confirmed", "CVE-2021-44228"), ("cve_mentioned", "CVE-2017-5638"), ("nikto_finding", "/icons/: this is a finding of the scanner"), ("service_version", "nginx/1.18.0"), ("service_version", "PHP/7.4"), ("http_header_server", "Apache"), ("http_header_x-powered-by", "PHP/7.4"), ("open_port_evidence", "9000")]
    assert told(spark, "Loading modules\n\x1b[31mReached 127.0.0.1 and 10.1.2.3 there\x1b[0m\nmore") == [("output_summary", "Reached {LOOPBACK} and {TARGET}.3 there")]
    won = "uid=0(root)\nroot@box\nflag{abc}\n-rwsr-xr-x 1 root root 1 su\n/etc/shadow /etc/passwd\nroot:x:0:0:root:/root:/bin/sh\nann:x:1000:1000::/home/ann:/bin/sh\nroot:$6$x:1:0:\nLogin successful\nsudo: NOPASSWD"
    got = dict(told(spark, won, phase="EXPLOITATION"))
    assert list(got) == ["privilege_root", "shell_root", "flag_captured", "suid_binary", "file_shadow", "file_passwd", "file_read_passwd", "file_read_shadow", "auth_bypass", "sudo_nopasswd"]
    assert got["flag_captured"] == "flag{abc}" and got["file_read_passwd"] == "系统用户: root, 普通用户: ann" and got["suid_binary"].startswith("-rwsr-xr-x")
    kept = lambda *keys: [f.key for f in one(spark, facts.prune(F.from_json("j", facts.KIND)), j=json.dumps([{"key": k, "value": "v"} for k in keys]))]
    assert kept("http_status", "output_summary") == [] and kept("http_status", "smb_share", "output_summary", "odd") == ["smb_share", "odd", "http_status"]


def test_low_value_lines(spark):
    noise = ["200", "Starting Nmap 7", "inet 10.0.0.1/8", "1.2.3.4:80 up now", "[*] Loading x", "[*] Compiling it", "12 packets captured", "<!DOCTYPE html>", "<p class=x>", "Usage: tool x", "/usr/share/words", "const x = 1;", "// comment here", ".cls-a { top", "0123456789abcdef0123456789abcdef", "undefined", "./lib/x.py", "-e admin", "Trying password x", "html {top:1}", "HTTP/1.1 404 Not Found", "if (top != self)", "#app { x", "color-x: red 1; ", "COLOR: white", "~ Licensed to", "Date: Mon, 01 Jan 2024", "X-Forwarded-For: 1", "short", "a<b><c><d><e> and so on for a line of over fifty characters>"]
    good = ["warning: flag{abc} found", "usage of the disk is high", "const", "admin panel found", "./exploit.py --target x", "root shell opened on host"]
    rows = spark.createDataFrame([(x,) for x in noise + good], "t string").select("t", facts.low_value(F.col("t")).alias("low")).collect()
    assert {r.t for r in rows if r.low} == {*noise, "const"}


def test_services_of_calls(spark):
    kind = lambda tool="t", command="", text="": one(spark, facts.service_type(F.col("a"), F.col("b"), F.col("c")), a=tool, b=command, c=text)
    assert [kind(text="80/tcp open http-proxy"), kind(text="22/tcp open ssh"), kind(text="3306/tcp open mysql"), kind(text="x\nServer: y"), kind("ldapsearch"), kind(command="redis-cli"), kind("nmap"), kind(command="x --port 9200"), kind(command="x -p 4444")] == ["http", "ssh", "database", "http", "ldap", "nosql", "network_scan", "nosql", "generic"]
    target = lambda text, cves=(): one(spark, facts.target_service(F.col("t"), F.from_json("c", "array<string>")), t=text, c=json.dumps(list(cves)))
    assert [target("80/tcp open http nginx 1.1"), target("x\nServer: Jetty"), target("version 1.2 of Struts 2.5.1 runs"), target("no", ["CVE-1"]), target("no")] == ["http nginx 1.1", "Jetty", "Struts 2.5.1", "目标存在 CVE-1 漏洞的服务", None]


def test_pattern_types(spark):
    cases = {"WAF bypass by encoding": "defense_bypass", "initial recon of hosts": "recon_pattern", "提权 by sudo": "privilege_escalation", "lateral move": "lateral_movement", "credential reuse": "credential_attack", "post-exploitation steps": "post_exploitation", "known vulnerability": "vulnerability_pattern", "plain": "attack_strategy", "": "attack_strategy", "Recon before bypass": "defense_bypass"}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", distil.pattern_type(F.col("t")).alias("p")).collect()
    assert {r.t: r.p for r in rows} == cases


def test_indicators_and_needs(spark):
    assert one(spark, distil.indicators(F.col("t")), t='{"code": 200, "raw": "x\\nroot@box"} 200 OK') == ["root@box", '"code": 200', "200 OK"]
    need = lambda tool, command, cves=(), context=False: one(spark, distil.preconditions(F.col("a"), F.col("b"), F.from_json("c", "array<string>"), F.col("d")), a=tool, b=command, c=json.dumps(list(cves)), d=context)
    assert need("shell", "ls") == [distil.ANY_NEED] and need("shell", "ssh u@h", ["CVE-1", "CVE-2"]) == ["目标存在可利用漏洞（CVE-1）", "SSH 服务可访问（凭据或密钥已知）"]
    assert need("shell", "run payload", (), True) == [distil.EXECUTION_NEED, "目标存在代码执行或命令注入入口", distil.CONTEXT_NEED]
    for pattern, said in distil.PROTOCOL_NEEDS:
        assert said  # each protocol is found by its first word
        word = {"https?://": "http://h"}.get(pattern.split("|")[0], pattern.split("|")[0].replace("\\b", "").replace("\\", ""))
        assert said in need("t", f"x {word} y"), pattern


def test_distil(spark):
    assert one(spark, distil.clean_queries(F.col("q")), q=[" short ", "a long query here", "中文 query long enough", "another one too", "third query ok", "fourth query ok", "fifth query ok"]) == ["a long query here", "another one too", "third query ok", "fourth query ok"]
    rows = [event(0, command="hydra -l root ssh://10.0.0.1", stdout="access granted"), event(1, command="hydra -l root ssh://10.0.0.2", stdout="access granted"), event(2, command="", return_code=127, success=False), event(3, command="nmap -p 80 h", return_code=1, success=False), event(4, command="nmap -p 80 h", return_code=1, success=False), event(5, command="sessions -l", stdout="uid=0(root)"), event(6, command="true", stdout="done")]
    a = annotate.annotate(spark.createDataFrame(rows, EVENT))
    pos, neg = distil.positives(a, annotate.session_outcome(a)).collect(), distil.negatives(a).collect()
    assert [(r.event_id, r.template, round(r.confidence, 2), r.indicators) for r in pos] == [(0, "hydra -l root ssh://{TARGET_IP}", 0.78, ["access granted"])]
    assert [(r.event_id, r.dimension, r["rule"]["then"][0]) for r in neg] == [(3, "INV", distil.AFTER["INV"])], "without a command there is no row; repeats count once"


def test_merges(spark):
    items = spark.createDataFrame([(1, 1, 0.9, "a"), (1, 2, 0.05, "b"), (1, 3, 0.05, "c")], "cluster_id long, exp_id long, weight double, item string")
    r = merge.positive(items, items).first()
    assert (r.preconditions, r.indicators) == ("a", "a | b | c")
    spread = spark.createDataFrame([(1, i, 0.1, f"i{i}") for i in range(10)], "cluster_id long, exp_id long, weight double, item string")
    assert merge.ranked_union(spread, 0.15, 10, 3, "x").first().x == "i0 | i1 | i2"
    lessons = spark.createDataFrame([(1, 1, 0.5, "VALIDATE_RECON: a"), (1, 2, 0.9, "RECON_BEFORE_EXPLOIT：b"), (1, 3, 0.6, "Other: c")], "cluster_id long, exp_id long, weight double, item string")
    assert [(x.fingerprint, x.n, x.lesson) for x in merge.metacognitive(lessons).orderBy("rank").collect()] == [("RECON_BEFORE_EXPLOIT", 2, "RECON_BEFORE_EXPLOIT：b"), ("OTHER: C", 1, "Other: c")]
    for name, same in merge.SAME_LESSON.items():
        assert one(spark, merge.fingerprint(F.col("t")), t=f"{name}: IF x THEN y") == same
    assert [one(spark, merge.fingerprint(F.col("t")), t=t) for t in ("A1: x", "AB: x", "ab_c: x", "NO COLON AT ALL")] == ["A1: X", "AB: X", "AB_C: X", "NO COLON AT ALL"]
    r = merge.conceptual(items, items).first()
    assert (r.insight, r.supplements, r.conditions) == ("a", "b | c", "a")
    actions = ["nmap host", "check /console", "use CVE-2020-1111", "nmap -sV -p 1-65535 host", "枚举路径 /a", "or CVE-2020-1111", "CVE-2020-1111 and CVE-2020-2222", "nmap for CVE-2020-3333", "rest"]
    left = one(spark, merge.intent_dedupe(fusion.covered_dedupe(F.col("a"))), a=actions)
    assert left == ["nmap -sV -p 1-65535 host", "check /console", "use CVE-2020-1111", "CVE-2020-1111 and CVE-2020-2222", "nmap for CVE-2020-3333", "rest"]
    members = spark.createDataFrame([(1, 1, 0.9, "if a", "n1", "rule", "ENV", "X"), (1, 2, 0.5, "if b", "n2", "llm", "ENV", "Y"), (1, 3, 0.4, "if c", "n1", "rule", "ENV", "Z")], "cluster_id long, exp_id long, weight double, if_text string, next_actions string, source string, dimension string, sub_dimension string")
    r = merge.negative(items, items, members).first()
    assert (r.if_text, r.next_actions, r.sources, r.alternatives, r.sub_dimension, r.then_actions) == ("if a", "n1", "llm=1,rule=2", "n2", "X", "a | b | c")
    made = spark.createDataFrame([(1, 1, 0.5, "m1", "f"), (1, 2, 0.4, "m2", "f"), (1, 3, 0.6, "m3", None)], "cluster_id long, exp_id long, weight double, item string, fingerprint string")
    assert [(x.fingerprint, x.item, x.vote_weight, x.vote_count) for x in merge.mistakes(made).orderBy("rank").collect()] == [("f", "m1", 0.9, 2), ("m3", "m3", 0.6, 1)]
    assert [x.item for x in merge.first_seen(lessons).orderBy("rank").collect()] == ["RECON_BEFORE_EXPLOIT：b", "Other: c", "VALIDATE_RECON: a"]
    ways = [("NEG", "", "{}"), ("FACTUAL", "FACTUAL::LLM", "{}"), ("FACTUAL", "FACTUAL::RULE", '{"cve_context": 1}'), ("FACTUAL", "", '{"cve_context": 1}'), ("FACTUAL", "", "{}")]
    assert [one(spark, merge.route(F.col("a"), F.col("b"), F.col("c")), a=a, b=b, c=c) for a, b, c in ways] == ["NEG", "FACTUAL::LLM", "FACTUAL::RULE", "FACTUAL::LLM", "FACTUAL::RULE"]
    row = spark.createDataFrame([("c1", "FACTUAL", "Apache Tomcat", ["CVE-1", "CVE-2", "CVE-3"], 4)], "cluster_id string, layer string, service string, cves array<string>, n_members int")
    r = merge.record(row).first()
    assert r.exp_id == "exp_consolidated_" + hashlib.md5(b"c1").hexdigest()[:10] and r.tags == ["consolidated", "factual", "n_src=4", "apache_tomcat", "cve-1", "cve-2"]


def test_keys_names_and_levels(spark):
    rows = spark.createDataFrame([(1, "FACTUAL_LLM", "a", "LLM", "", "p"), (2, "FACTUAL", "a", "rule", "", "p"), (3, "CONCEPTUAL", "a", "x", "recon_pattern", "p")], "exp_id long, layer string, service string, extraction_source string, pattern_type string, phase string").withColumns({"sub_dimension": F.lit(""), "dimension": F.lit(""), "version": F.lit("")})
    assert {r.exp_id: (r.key_layer, r.key_sub) for r in fusion.hard_key(rows).collect()} == {1: ("FACTUAL", "FACTUAL::LLM"), 2: ("FACTUAL", "FACTUAL::RULE"), 3: ("CONCEPTUAL", "recon_pattern")}
    canonical = json.dumps({"layer": "FACTUAL", "service": "apache tomcat", "sub_dim": "factual::rule", "version_family": "9.0.x", "cve_ids": ["CVE-2020-1", "CVE-2021-2"]}, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    got = one(spark, fusion.cluster_name(F.lit("FACTUAL"), F.lit("Apache Tomcat"), F.lit("FACTUAL::RULE"), F.lit("9.0.x"), F.from_json("c", "array<string>")), c='["cve-2021-2", "CVE-2020-1", "CVE-2020-1", " "]')
    assert got == f"SEC_factual_apache_tomcat_factual_rule_9_0_x_cve_2020_1_{hashlib.md5(canonical.encode()).hexdigest()[:8]}"
    assert one(spark, fusion.cluster_name(F.lit("X"), F.lit(""), F.lit(None), F.lit(""), F.from_json("c", "array<string>")), c="[]").startswith("SEC_x_anysvc_any_anyver_nocve_")
    keyed = spark.createDataFrame([("a", "s", "", 1), ("a", "s", "", 2), ("b", "s", "", 3), ("c", "s", "", 4), ("c", "s", "", 4)], "key_layer string, key_service string, key_sub string, signature long")
    edges = spark.createDataFrame([(1, 2)], "a long, b long")
    assert {r.key_layer: r.level for r in fusion.trigger_levels(keyed, edges).collect()} == {"a": "L1+L2", "b": "L1", "c": "L1+L2"}


def test_component_edges_join_what_pairs_join(spark):
    """Stars by term give the components of all compatible pairs."""
    rng = random.Random(4)
    rows = [(f"l{rng.randrange(3)}", f"s{rng.randrange(6)}", "", rng.choice(["", "1.x", "2.x", "3.x"]), sorted(rng.sample(["A", "B", "C", "D", "E"], rng.choice([0, 1, 1, 2])))) for _ in range(90)]
    nodes = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "key_layer string, key_service string, key_sub string, family string, cves array<string>, signature long")
    parts = []
    for edges in (fusion.similarity_edges(nodes), fusion.component_edges(nodes)):
        parts.append({r.node: r.root for r in graph.connected_components(edges).collect()})
    assert parts[0] == parts[1] and len(parts[0]) > 60


def test_evaluate(spark):
    rows = [("s", i, p, o) for i, (p, o) in enumerate([("EXPLOITATION", "uncertain"), ("EXPLOITATION", "failure"), ("ESCALATION", "partial_success")])] + [("t", 0, "EXPLOITATION", "timeout"), ("u", 0, "EXPLOITATION", "failure")]
    df = spark.createDataFrame(rows, "session_id string, turn_index int, phase string, outcome_label string")
    assert {r.session_id: r.first_step for r in evaluate.first_success_step(df).collect()} == {"s": 3, "t": 1, "u": None}
    assert {r.session_id: (r.n_touched, r.n_covered) for r in evaluate.stage_coverage(df).collect()} == {"s": (2, 2), "t": (1, 0), "u": (1, 0)}
    assert [one(spark, evaluate.heuristic_success(F.col("t")), t=t) for t in ("任务完成", "Exploit successful but failed", "hm")] == [True, False, None]


def test_corpus(spark):
    raw = spark.createDataFrame([("t", "u", None, "extra"), ("", "v", "s", "e")], "name string, url string, description string, other string")
    out = corpus.standardise(raw)
    assert out.columns == ["title", "link", "date", "summary", "type", "site", "scraped_time", "other"] and corpus.valid(out).count() == 0
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("", 3), (None, 4)], "k string, o int")
    assert sorted(r.o for r in corpus.first_by(rows, ["k"], ["o"]).collect()) == [1] and sorted(r.o for r in corpus.first_by(rows, ["k"], ["o"], True).collect()) == [1, 3, 4]
    assert one(spark, corpus.url_identity(F.col("u")), u="http://h/s?__biz=a&mid=1&idx=2&sn=z&x=9#f") == "a|1|2|z" and one(spark, corpus.url_identity(F.col("u")), u="http://h/s?mid=1#f") == "http://h/s"
    bundle = {"objects": [{"id": "t1", "type": "attack-pattern", "name": "T", "external_references": [{"source_name": "x"}, {"source_name": "mitre-attack", "external_id": "T1", "url": "u"}], "kill_chain_phases": [{"kill_chain_name": "k", "phase_name": "recon"}]}, {"id": "g1", "type": "intrusion-set", "name": "G"}, {"id": "r", "type": "relationship", "source_ref": "g1", "target_ref": "t1", "relationship_type": "uses"}]}
    objects = corpus.stix_objects(spark.createDataFrame([(json.dumps(bundle),)], "value string"))
    t = corpus.stix_type(objects, "attack-pattern").first()
    assert (t.external_id, t.external_url, t.tactics) == ("T1", "u", ["recon"]) and corpus.stix_type(objects, "intrusion-set").count() == 0
    r = corpus.related(objects.filter("type = 'relationship'"), objects, "uses").first()
    assert (r.source_name, r.target_name) == ("G", "T")
    assert graph.adjacency(objects.filter("type = 'relationship'")).first().targets == ["t1"]
    merged = corpus.merge_candidates(spark.createDataFrame([("n", "b", 2), ("n", "a", 1), ("n", "b", 3)], "name string, source string, ord int")).first()
    assert (merged.sources, merged.n) == ("a+b", 3)


def test_serving(spark):
    v = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)] + [(9, [0.0, 0.0])], "vec_id long, embedding array<double>")
    top = serve.cosine_top(v.filter("vec_id = 4"), v, 2).orderBy("rank").collect()
    assert [r.neighbour for r in top] == [3, 2]


def test_turn_algebra(spark):
    kinds = ["api_request", "assistant_message", "api_request", "completion", "api_request", "assistant_message", "assistant_message", "session_end", "x"]
    lines = spark.createDataFrame([("f", i, k) for i, k in enumerate(kinds)], "source_file string, line_no long, kind string")
    want = {(0, 3, True, "completion"), (1, 1, False, "next"), (2, 2, False, "session_end")}
    assert {tuple(r)[1:] for r in stream_turns.batch_turns(lines).collect()} == want
    e = spark.createDataFrame([("s", 0, 1, "RAG_QUERY"), ("s", 1, 2, "RAG_QUERY"), ("s", 4, 3, "X"), ("s", 5, 4, "X")], "session_id string, turn_index int, event_id long, category string")
    assert {r.event_id: r.query_id for r in turns.lookback(e, 3).collect()} == {1: None, 2: 1, 3: 2, 4: None}


def test_streams_equal_batches(spark, tmp_path):
    kinds = ["assistant_message", "api_request", "completion", "assistant_message", "session_end"]
    lines = spark.createDataFrame([(f, i, k) for f in ("f", "g") for i, k in enumerate(kinds)], "source_file string, line_no long, kind string")
    for n in range(5):
        lines.filter(f"line_no = {n}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = windows.read(spark, str(tmp_path / "in"), lines.schema)
    windows.drain(stream_turns.stream_turns(stream), str(tmp_path / "out"), str(tmp_path / "ck"))
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {tuple(r) for r in stream_turns.batch_turns(lines).collect()}
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.coalesce(1).write.parquet(str(tmp_path / "ev"))
    stream = windows.read(spark, str(tmp_path / "ev"), events.schema)
    name = "counts_test"
    q = windows.tumbling(stream).writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {tuple(r) for r in spark.table(name).collect()} == {tuple(r) for r in windows.tumbling(events).collect()}
    windows.drain(windows.dedupe(stream, ["user_id", "event_type"], "400 days"), str(tmp_path / "dd"), str(tmp_path / "ck2"))
    assert spark.read.parquet(str(tmp_path / "dd")).count() == events.select("user_id", "event_type").distinct().count()


def test_batch_plan(spark, tmp_path):
    from tests.test_sources import native_log

    for i in range(3):
        (tmp_path / f"log_{i}_x.jsonl").write_text(native_log().replace('"abc"', f'"abc{i}"'))
    tables, state = batch.run(spark, str(tmp_path))
    assert {r.status for r in state.collect()} == {"done"}, state.collect()
    assert tables["annotated"].count() == 12 and tables["experiences"].count() >= 3 and tables["consolidated"].count() >= 1
    assert all(r.ok for r in batch.gates(tables).filter("gate <> 'not_only_fallback'").collect())
    _, state = batch.run_stages(spark, [("a", lambda t: t["missing"]), ("b", lambda t: t["a"])], {})
    assert [(r.stage, r.status) for r in state.collect()] == [("a", "failed"), ("b", "skipped")]


def test_small_join_hint(spark):
    assert "broadcast" in store.small(spark.range(3))._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in store.small(spark.range(30), 10)._jdf.queryExecution().logical().toString().lower()


@pytest.mark.parametrize("name", ["outcome_classifier", "fact_extraction", "gap_score_top30"])
def test_plans_stay_in_the_jvm(spark, name):
    from kenning.plans.registry import QUERIES

    import __spark_entry__  # noqa: F401  registers

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan


def test_members_by_score(spark):
    """As one number the weight's last place is less than ids that are 200,000 apart."""
    rows = spark.createDataFrame([("k", i, w, str(i), "RECON_BEFORE_EXPLOIT: x", "L", "S", "B") for i, w in ((200_001, 0.5001), (1, 0.5))], "cluster_id string, exp_id long, weight double, item string, lesson string, key_layer string, key_service string, key_sub string")
    assert fusion.dominant(rows).first().dominant_id == 200_001 and fusion.dominant(rows, fusion.scored()).first().dominant_id == 1
    got = report.cluster_report(rows, fusion.scored()).first()
    assert got.dominant_id == 1 and [x.exp_id for x in got.weights] == [200_001, 1]
    assert merge.metacognitive(rows.withColumn("item", F.concat("lesson", "item")), fusion.scored()).first().lesson.endswith("x1")
    assert merge.conceptual(rows, rows, by=fusion.scored()).first().insight == "1"


def test_mentions_beside_letters_beyond_ascii(spark, tmp_path):
    """A word ends where ASCII letters, digits and underscores end."""
    spark.createDataFrame([(i, "éAbcdefghijk Klmnopqrstuß x_Yxwvutsrqpo Zyxwvutsrqp1 Ändern") for i in range(5)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert {(r.word, r.n) for r in experience_queries.mention_counts(spark, str(tmp_path)).collect()} == {("Abcdefghijk", 5), ("Klmnopqrstu", 5)}


def test_relevance_words_as_patterns(spark):
    """Words are searched and only the rest matched, with the outcome of the patterns."""
    texts = ["CVE-2021-44228 x", "cve-21-1", "an EXP here", "expand", "POC.", "pocket", "XSS", "远程代码执行", "漏洞", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(*[F.struct(F.col("t").rlike(f"(?i){p}"), corpus._says(F.lower("t"), p)).alias(f"c{i}") for i, p in enumerate(corpus.STRONG)])
    assert all(a == b for r in rows.collect() for a, b in r)
