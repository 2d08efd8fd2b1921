"""Reflux, finished sessions, services, settings."""

import json

import pytest
from pyspark.sql import functions as F

from kenning.operators import consolidate, corpus, evaluate, records, reflux, services
from kenning.operators import registry as table
from kenning.plans import maintenance, settings

REGISTRY = "exp_id long, layer string, service string, cves array<string>, version string, session_id string, confidence double, outcome string, maturity string, age_days int, lifecycle string, max_turn int, dimension string, sub_dimension string, phase string, text string, refluxed boolean"


def row(i, **k):
    base = dict(exp_id=i, layer="PROCEDURAL_POS", service="web", cves=[], version="", session_id=f"s{i}", confidence=0.95, outcome="success", maturity="validated", age_days=0, lifecycle="active", max_turn=0, dimension="", sub_dimension="", phase="EXPLOITATION", text=f"try the thing number {i}", refluxed=False) | k
    return tuple(base[c.split()[0]] for c in REGISTRY.split(", "))


def test_flush_marks_once(spark):
    rows = spark.createDataFrame([row(1, maturity="consolidated"), row(2), row(3, maturity="consolidated", lifecycle="conflicted"), row(4, maturity="consolidated", refluxed=True)], REGISTRY)
    taken = []
    docs, after = reflux.flush(rows, lambda d: taken.extend(r.exp_id for r in d.collect()))
    assert taken == [1] and docs.first().route == "primary" and docs.first().dataset == "procedures"
    assert {r.exp_id: r.refluxed for r in after.collect()} == {1: True, 2: False, 3: False, 4: True}
    assert reflux.flush(after)[0].count() == 0
    stay, gone = reflux.remove_conflicted(rows.select("exp_id"), rows)
    assert stay.count() == 3 and [r.exp_id for r in gone.collect()] == [3]


def test_on_session(spark):
    registry = spark.createDataFrame([row(1, text="scan port host"), row(2), row(9, service="db", text="you should try scan port now")], REGISTRY)
    fresh = spark.createDataFrame([row(3), row(1, text="known already"), row(7, layer="PROCEDURAL_NEG", service="db", dimension="ENV", sub_dimension="X", outcome="failure", text="try scan port now")], REGISTRY)
    after, pairs = reflux.on_session(registry, fresh)
    made = after.filter("maturity = 'consolidated'").collect()
    assert [(r.layer, r.service, r.session_id, r.lifecycle, r.refluxed, r.text) for r in made] == [("PROCEDURAL_POS", "web", "consolidated", "active", False, "scan port host")]
    out = {r.exp_id: r.lifecycle for r in after.filter("maturity <> 'consolidated'").collect()}
    assert out == {1: "suspended", 2: "suspended", 3: "suspended", 7: "active", 9: "conflicted"}
    assert [(r.a, r.b) for r in pairs.collect()] == [(7, 9)] and after.columns == registry.columns
    assert after.filter("exp_id = 1").first().text == "scan port host", "known rows stay as they are"


def test_redaction(spark):
    text = json.dumps({"a": {"cmd": "x\"y", "n": 1}, "payload": {"b": [1, {"c": 2}]}, "exec": [1, [2]], "commands": [{"exploit_code": None}], "ok": "cmd", "é": "ü"})
    safe = json.loads(spark.range(1).select(reflux.strip_sensitive(F.lit(text)).alias("x")).first().x)
    gone = "[REDACTED]"
    assert safe == {"a": {"cmd": gone, "n": 1}, "payload": gone, "exec": gone, "commands": [{"exploit_code": gone}], "ok": "cmd", "é": "ü"}
    assert [r.x for r in spark.createDataFrame([("no json",), (None,)], "t string").select(reflux.strip_sensitive(F.col("t")).alias("x")).collect()] == ["no json", None]


def test_services(spark):
    rows = spark.createDataFrame([(1, "Apache Tomcat 9 beside nginx"), (2, "nginxes")], "id long, text string")
    aliases = spark.createDataFrame([("tomcat", "tomcat"), ("apache tomcat", "tomcat"), ("NGINX", "nginx")], "alias string, service string")
    assert [tuple(r) for r in services.by_text(rows, aliases).collect()] == [(1, "tomcat", 19)]


def test_settings(tmp_path):
    p = tmp_path / "design.json"
    p.write_text(json.dumps({"fusion": {"least_members": 5}}))
    out = settings.load(str(p), str(tmp_path / "missing.json"), environ={"KENNING_FUSION__DECAY": "false", "KENNING_NAME": "x", "OTHER": "1"})
    assert out["fusion"] == {"least_members": 5, "decay": False} and out["name"] == "x" and settings.DEFAULTS["fusion"]["least_members"] == 3


def test_names_dates_citations(spark):
    text = "转载自【红队笔记】 来源：实验室甲，作者 | 小编 关注公众号「云安全」 首发于 甲乙丙 本文转自：某某团队。 版权归 某公司 所有 https://mp.weixin.qq.com/s?a=1&__biz=MzA5MDEwMjY1Mg== 来源:12345 来源:www.x 来源：自己"
    df = spark.createDataFrame([(1, text, "自己")], "id long, text string, author string")
    found = {(r.name, r.source) for r in corpus.citations(df, author_col="author").collect()}
    assert found == {(n, "citation") for n in ("红队笔记", "实验室甲", "云安全", "甲乙丙", "某某团队", "某公司")} | {("__biz:MzA5MDEwMjY1Mg==", "citation_biz")}
    today = F.lit("2026-03-01").cast("date")
    days = ["2026年1月2日", "2026/1/2 03:04", "never", "02-28", "3月5日", "on 2025.12.31 at night"]
    dates = spark.createDataFrame([(i, t) for i, t in enumerate(days)], "i int, t string").orderBy("i").select(corpus.article_date(F.col("t"), today).cast("string").alias("d")).collect()
    assert [r.d for r in dates] == ["2026-01-02 00:00:00", "2026-01-02 03:04:00", None, "2026-02-28 00:00:00", "2025-03-05 00:00:00", "2025-12-31 00:00:00"]
    cases = [("success", None, False, ""), ("uncertain", None, False, ""), (None, False, True, ""), (None, False, False, ""), (None, None, False, "已获取 shell"), (None, None, False, "")]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, o string, s boolean, near boolean, t string")
    got = rows.orderBy("i").select(evaluate.session_status(F.col("o"), F.col("s"), F.col("near"), F.col("t")).alias("x")).collect()
    assert [r.x for r in got] == ["success", "possible_success", "possible_success", "failure", "success", "unknown"]


def test_whole_events_are_redacted(spark):
    import __spark_entry__

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    out = __spark_entry__.queries()["sensitive_keys_whole"](spark, "/root/testdata/sf0.001")
    assert out.count() == events.count() and out.filter("safe not like '%[REDACTED]%'").count() == 0


def test_union_precedence_has_every_document(spark):
    import __spark_entry__

    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = __spark_entry__.queries()["union_precedence_whole"](spark, "/root/testdata/sf0.001")
    assert documents.join(out, "doc_id", "left_anti").count() == 0


QUEUE = [(1, "P1", "pending", 1, None), (2, "P1", "processing", 2, "2024-01-01 00:00:00"), (3, "P1", "processing", 3, "2024-01-01 23:30:00")]


def queue_of(spark):
    return spark.createDataFrame(QUEUE, "gap_id long, priority string, status string, arrival long, started string").withColumn("started", F.col("started").cast("timestamp"))


def test_daily_maintenance(spark, tmp_path):
    """Fused rows are in the committed registry, their sources suspended; a second day adds nothing."""
    rows = [row(i, text=f"text {i}", cves=["CVE-2021-1"], maturity="raw") for i in range(1, 5)] + [row(9, service="db", text="old", age_days=5000), row(10, service="db", maturity="consolidated", confidence=0.2, refluxed=True)]
    path, queue = f"file://{tmp_path}/registry", f"file://{tmp_path}/queue"
    table.commit(spark.createDataFrame(rows, REGISTRY), path, 0)
    table.commit(queue_of(spark), queue, 0)
    now, sent = F.lit("2024-01-02 00:00:00").cast("timestamp"), []
    state = maintenance.daily_at(spark, path, queue, now, 1, lambda d: sent.extend(d.collect()))
    assert {r.status for r in state.collect()} == {"done"}, state.collect()
    assert {r.gap_id: r.status for r in table.current(spark, queue).collect()} == {1: "processing", 2: "pending", 3: "processing"}
    after = {r.exp_id: r for r in table.current(spark, path).collect()}
    new = [r for i, r in after.items() if i not in {r[0] for r in rows}]
    assert len(new) == 1 and new[0].name.startswith("exp_consolidated_") and new[0].cves == ["CVE-2021-1"] and new[0].maturity == "consolidated" and new[0].n_members == 4
    assert new[0].tags == ["consolidated", "procedural_pos", "n_src=4", "web", "cve-2021-1"] and json.loads(new[0].content)["command_template"] == "text 1"
    assert [(after[i].lifecycle, after[i].merged_into) for i in range(1, 5)] == [("suspended", new[0].exp_id)] * 4 and after[9].lifecycle == "suspended" and after[9].merged_into is None
    assert round(after[10].confidence, 4) == 0.4 and after[10].maturity == "raw", "a risen confidence below 0.6 is raw, whatever it was"
    assert [r.exp_id for r in sent] == [new[0].exp_id] and new[0].refluxed
    assert sorted(tuple(r) for r in consolidate.lineage(table.current(spark, path)).collect()) == [(new[0].exp_id, i, i) for i in range(1, 5)]
    maintenance.daily_at(spark, path, queue, now, 1, lambda d: sent.extend(d.collect()))
    assert table.versions(spark, path) == [1, 2, 3] and table.current(spark, path).count() == 7 and len(sent) == 1


def test_daily_failure_commits_nothing(spark, tmp_path):
    path, queue = f"file://{tmp_path}/registry", f"file://{tmp_path}/queue"
    table.commit(spark.createDataFrame([row(1, maturity="consolidated")], REGISTRY), path, 0)
    table.commit(queue_of(spark), queue, 0)

    def down(_):
        raise OSError("store is down")

    with pytest.raises(RuntimeError, match="documents: store is down"):
        maintenance.daily_at(spark, path, queue, F.current_timestamp(), 1, down)
    assert table.versions(spark, path) == table.versions(spark, queue) == [1]


def test_two_writers(spark, tmp_path):
    """The slower writer finds its version taken and applies its change to the faster one's rows."""
    path = f"file://{tmp_path}/t"
    assert table.commit(spark.range(3), path, 0) == 1
    calls = []

    def slow(rows):
        calls.append(rows.count())
        if len(calls) == 1:
            table.update(spark, path, lambda r: r.filter("id <> 0"))
        return rows.union(spark.range(10, 11))

    assert table.update(spark, path, slow) == 3 and calls == [3, 2]
    assert sorted(r.id for r in table.current(spark, path).collect()) == [1, 2, 10]
    with pytest.raises(table.Conflict):
        table.commit(spark.range(9), path, 1)

    def always(rows):
        table.commit(rows, path, table.versions(spark, path)[-1])
        return rows

    with pytest.raises(table.Conflict):
        table.update(spark, path, always, tries=2)
    assert len(list((tmp_path / "t" / "data").iterdir())) == len(table.versions(spark, path)), "folders of lost claims are deleted"


def test_failed_writes_and_old_versions(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    table.commit(spark.range(1), path, 0)

    def broken(rows):
        return rows.select(F.raise_error(F.lit("no")).cast("long").alias("id"))

    with pytest.raises(Exception, match="no"):
        table.update(spark, path, broken)
    assert table.versions(spark, path) == [1] and table.current(spark, path).count() == 1
    for i in range(2, 6):
        table.update(spark, path, lambda r, i=i: r.union(spark.range(i, i + 1)))
    (tmp_path / "t" / "data" / "unnamed").mkdir()
    assert table.vacuum(spark, path, keep=2) == [1, 2, 3] and table.versions(spark, path) == [4, 5]
    assert (tmp_path / "t" / "data" / "unnamed").exists() and table.read(spark, path, 4)[1].count() == 4
    table.vacuum(spark, path, keep=2, unnamed_s=-1)
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2 and table.current(spark, path).count() == 5
    (tmp_path / "t" / "versions" / "000000000006").touch()
    table.WAIT, before = 0.1, table.WAIT
    with pytest.raises(RuntimeError, match="never named"):
        table.current(spark, path)
    table.WAIT = before
    with pytest.raises(ValueError):
        table.current(spark, f"file://{tmp_path}/none")


def test_merge_by_key(spark):
    rows = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, None, 3), (4, "d", 4)], "exp_id long, t string, n int")
    changes = spark.createDataFrame([(1, "delete", None), (2, "insert", "x"), (3, "update", "c"), (5, "update", "e"), (6, "insert", "f"), (7, "upsert", "g"), (4, "upsert", None), (8, "delete", "h")], "exp_id long, op string, t string")
    got = sorted(tuple(r) for r in table.merge(rows, changes).collect())
    assert got == [(2, "b", 2), (3, "c", 3), (4, "d", 4), (6, "f", None), (7, "g", None)]


def test_merged_by_layer(spark):
    """Each layer's rows say what its merge makes of their contents; clusters below their threshold stay as they are."""
    told = {
        "PROCEDURAL_NEG": {"decision_rule": {"IF": "when", "THEN": ["do a", "do b"], "NOT": "never c", "next": "n"}, "rule_source": "llm"},
        "FACTUAL": {"facts": [{"key": "port", "value": "80"}, {"key": "os", "value": "x"}]},
        "METACOGNITIVE": {"key_lessons": ["VALIDATE_RECON: scan first", "other lesson"]},
        "CONCEPTUAL": {"core_insight": "insight", "applicable_conditions": ["if x"]},
    }
    rows = [(*row(10 * k + i, layer=layer, dimension="ENV" if "NEG" in layer else "", sub_dimension="X" if "NEG" in layer else "", maturity="raw"), json.dumps(c)) for k, (layer, c) in enumerate(told.items()) for i in range(3)]
    rows += [(*row(90 + i, service="lone"), None) for i in range(2)] + [(*row(95 + i, service="bare", layer="PROCEDURAL_NEG", dimension="ENV", text="failed so"), "no json") for i in range(3)]
    told_of = lambda i: {"target_version": f"v{i}", "cve_context": {"attempted": ["CVE-1"] if i else [], "unexplored": ["CVE-1", "CVE-2"], "exploitation_results": {"CVE-1": ["patched-HTTP500", "patched-auth", "failure"][i]}, "known_ineffective_vectors": ["/a", f"/b{i}"]}}
    rows += [(*row(70 + i, layer="FACTUAL", service="model"), json.dumps(told_of(i))) for i in range(3)]
    shape = F.col("content").contains("cve_context").alias("has_cve_context")
    after, made = consolidate.consolidate(consolidate.widened(spark.createDataFrame(rows, REGISTRY + ", content string").select("*", shape)))
    got = {(r.layer, r.service): r for r in made.collect()}
    assert set(got) == {(layer, "web") for layer in told} | {("PROCEDURAL_NEG", "bare"), ("FACTUAL", "model")}
    model = json.loads(got["FACTUAL", "model"].content)
    assert model["cve_exploitation_map"]["CVE-1"] == {"consensus_status": "patched-auth", "consensus_category": "patched", "confidence": 0.6667, "vote_breakdown": {"failure": 0.3333, "patched-HTTP500": 0.3333, "patched-auth": 0.3333}, "evidence_count": 3}
    assert model["cve_context"] == {"attempted": ["CVE-1"], "n_attempted": 1, "unexplored": ["CVE-2"], "n_unexplored": 1} and model["known_ineffective_endpoints"][0]["path"] == "/a" and model["known_ineffective_endpoints"][0]["verified_count"] == 3
    neg = json.loads(got["PROCEDURAL_NEG", "web"].content)
    assert neg["then_actions"] == "do a | do b" and neg["avoid"] == "never c" and neg["if_text"] == "when" and neg["sources"] == "llm=3"
    assert got["PROCEDURAL_NEG", "bare"].text == "failed so"
    assert [(f["key"], f["value"], f["n"]) for f in json.loads(got["FACTUAL", "web"].content)["facts"]] == [("os", "x", 3), ("port", "80", 3)]
    assert sorted(x["lesson"] for x in json.loads(got["METACOGNITIVE", "web"].content)["lessons"]) == ["VALIDATE_RECON: scan first", "other lesson"]
    assert json.loads(got["CONCEPTUAL", "web"].content)["conditions"] == "if x"
    assert after.filter("lifecycle = 'suspended'").count() == 18 and after.filter("merged_into IS NULL AND lifecycle = 'active'").count() == 8


def test_stream_of_finished_sessions(spark, tmp_path):
    """Sessions one by one through the stream leave the registry that one call after the other leaves."""
    registry = spark.createDataFrame([row(1, text="scan port host"), row(2), row(9, service="db", text="you should try scan port now")], REGISTRY)
    fresh = spark.createDataFrame([row(3), row(7, layer="PROCEDURAL_NEG", service="db", dimension="ENV", sub_dimension="X", outcome="failure", text="try scan port now")], REGISTRY)
    path = f"file://{tmp_path}/registry"
    table.commit(registry, path, 0)
    fresh.coalesce(1).write.parquet(f"{tmp_path}/in")
    maintenance.on_sessions(spark.readStream.schema(fresh.schema).parquet(f"{tmp_path}/in"), path, f"{tmp_path}/ck", f"{tmp_path}/conflicts").awaitTermination()
    got = {r.exp_id: r.lifecycle for r in table.current(spark, path).collect()}
    assert got == {r.exp_id: r.lifecycle for r in reflux.on_session(registry, fresh)[0].collect()}
    assert spark.read.parquet(f"{tmp_path}/conflicts").count() == 1


def test_sources_fail_alone(spark):
    def broken():
        raise OSError("no route")

    rows, told = records.collect(spark, {"a": lambda: spark.createDataFrame([("x",)], "title string"), "b": broken}, "title string")
    assert [tuple(r) for r in rows.collect()] == [("a", "x")] and {(r.source, r.status, r.n) for r in told.collect()} == {("a", "ok", 1), ("b", "failed", 0)}


def test_records(spark):
    rows = spark.createDataFrame([("e1", None, 0.5), ("e2", "validated", None), (None, "raw", 0.1)], "exp_id string, maturity string, confidence double")
    out = {r.exp_id: (r.maturity, r.confidence, r.knowledge_layer, r.extraction_source) for r in records.with_defaults(rows).collect()}
    assert out["e1"] == ("raw", 0.5, "FACTUAL", "rule") and out["e2"] == ("validated", 0.7, "FACTUAL", "rule")
    kept = records.whole_records(rows, ["exp_id", "confidence", "provenance"], ["exp_id", "confidence"])
    assert [tuple(r) for r in kept.collect()] == [("e1", 0.5, None)]
    labels = spark.createDataFrame([("success",), ("partial_success",), ("odd",), (None,)], "l string")
    got = labels.select(*[c.alias(n) for n, c in records.settled_outcome(F.col("l")).items()]).collect()
    assert [tuple(r) for r in got] == [("success", True, True), ("partial_success", False, True), ("failure", False, False), ("failure", False, False)]
    text = spark.range(1).select(records.retrieval_text(F.lit("e"), F.lit("L"), F.lit("c"), F.create_map(F.lit("tags"), F.lit("t"), F.lit("source_event_ids"), F.lit("1")), F.lit(0.5)).alias("x")).first().x
    assert json.loads(text) == {"exp_id": "e", "knowledge_layer": "L", "content": "c", "metadata": {"tags": "t"}, "confidence": 0.5}
    dates = spark.createDataFrame([("2024-01-02T03:04:05",), ("never",), (None,)], "d string").select(records.date_or_epoch(F.col("d")).cast("string").alias("d")).collect()
    assert [r.d for r in dates] == ["2024-01-02 03:04:05", "1970-01-01 00:00:00", "1970-01-01 00:00:00"]
    assert [r.ok for r in spark.createDataFrame([("x",), ("ok name",), ("see github.com/x",)], "n string").select(records.candidate_name(F.col("n")).alias("ok")).collect()] == [False, True, False]


def test_rekeyed_names(spark):
    """Names of one account, found by their pieces, against all pairs."""
    import random

    rng = random.Random(2)
    roots = ["".join(rng.choice("abcdxyz") for _ in range(rng.randint(2, 6))) for _ in range(50)]
    names = sorted({f(r) for r in roots for f in rng.sample([str.upper, lambda r: f"{r} 实验室", lambda r: f"the-{r}", lambda r: f"【{r}】官方", str, lambda r: r + rng.choice(roots)], 3)} | {"官方", "公众号", "...", ""})
    rows = [(n, 1 + len(n) % 3) for n in names]
    pairs = spark.createDataFrame([(a, b) for a in names for b in names if a.strip(".") and b.strip(".")], "a string, b string")
    same = [(r.a, r.b) for r in pairs.filter(corpus.same_name(F.col("a"), F.col("b"))).collect()]
    root = {n: n for n in names}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in same:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.name: r.account for r in corpus.rekeyed(spark.createDataFrame(rows, "name string, n long")).collect()}
    weight = dict(rows)
    best = {}
    for n in got:
        best[find(n)] = min(best.get(find(n), n), n, key=lambda x: (-weight[x], len(x), x))
    assert set(got) == {n for n in names if n.strip(".")} and got == {n: best[find(n)] for n in got} and len(set(got.values())) > 5


def test_canonical_json(spark):
    """The forms of Python's json with sorted keys, whatever the spelling."""
    import hashlib

    from kenning.functions import canonical

    values = [{"b": [1, {"y": 2, "x": "a, \"b\": c\\"}], "a": {"é": "ü日", "B": None}, "": True}, {"k": "x:,y", "j": []}, [3, {"z": {}, "a": "\\"}], {"n": 12345678901, "f": 0.5}]
    rows = []
    for v in values:
        rows += [(json.dumps(v, ensure_ascii=False), v), (json.dumps(dict(reversed(v.items())) if isinstance(v, dict) else v, indent=3), v)]
    got = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "i int, t string").orderBy("i").select(canonical.spaced(F.col("t")).alias("s"), canonical.content_hash(F.col("t")).alias("h")).collect()
    for r, (_, v) in zip(got, rows, strict=True):
        told = json.dumps(v, sort_keys=True, ensure_ascii=False)
        assert r.s == told and r.h == hashlib.sha256(told.encode()).hexdigest()[:16]
    bad = spark.range(1).select(canonical.spaced(F.lit("{no")).alias("s"), canonical.content_hash(F.lit("{no")).alias("h"), canonical.search_text(F.lit("{No")).alias("t")).first()
    assert tuple(bad) == (None, hashlib.sha256(b"{no").hexdigest()[:16], "{no")


def test_pages(spark):
    from kenning.operators import serve

    rows = [row(i, session_id="consolidated", layer=["FACTUAL", "CONCEPTUAL"][i % 2], text=f"t{i}") for i in range(5)] + [row(9)]
    registry = consolidate.widened(spark.createDataFrame(rows, REGISTRY)).withColumn("p_fused", F.when(F.col("exp_id") != 3, F.col("exp_id") / 10.0))
    assert [r.exp_id for r in serve.consolidated_page(registry, size=3).collect()] == [4, 2, 1] and [r.exp_id for r in serve.consolidated_page(registry, page=2, size=3).collect()] == [0, 3]
    assert [r.exp_id for r in serve.consolidated_page(registry, ["CONCEPTUAL"]).collect()] == [1, 3]
    pairs = spark.createDataFrame([(0, 1, 0.2), (2, 9, 0.9), (4, 77, 0.5)], "a long, b long, score double")
    assert [(r.a, r.text_a, r.b, r.service_b) for r in serve.conflict_page(pairs, registry, size=2).collect()] == [(2, "t2", 9, "web"), (4, "t4", 77, None)]


def test_lookup_by_id(spark):
    from kenning.operators import serve

    rows = spark.createDataFrame([(1, "a"), (2, "b")], "exp_id long, text string")
    assert [r.text for r in serve.by_id(rows, 2).collect()] == ["b"] and serve.by_id(rows, 9).count() == 0
