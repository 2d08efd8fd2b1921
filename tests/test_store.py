"""Store texts, gates, crawling helpers and history on edge cases."""

import json

import pytest
from pyspark.sql import functions as F

from kenning.operators import crawl, gates, history, project

ROW = "exp_id long, layer string, content string, service string, version string, cves array<string>, maturity string, confidence double, outcome string, n_sessions int"


def rows(spark, *contents, layer="FACTUAL", service=None):
    return spark.createDataFrame([(i, layer, c, service, None, None, None, None, None, None) for i, c in enumerate(contents)], ROW)


def test_chunk_of_nothing(spark):
    got = [r.chunk for r in project.chunks(rows(spark, None, "not json", json.dumps({"cve_context": {"attempted": ["cve-1", "CVE-2"], "exploitation_results": {"CVE-1": "success"}}}))).orderBy("exp_id").collect()]
    assert got[0].startswith("[★☆☆ raw | 1 sessions | p=0.00]\nFACTUAL | 0\n") and "target_service: unknown" in got[0] and "(no stable facts)" in got[1]
    assert "\n\nCVE-1: success\nCVE-2: attempted\n\n" in got[2] and got[2].endswith("- FACTUAL\n- CVE-1\n- CVE-2")


@pytest.mark.parametrize("layer", [x for x in project.BODIES if x not in ("FACTUAL", "PROCEDURAL_NEG", "PROCEDURAL_POS")])
def test_empty_records_go(spark, layer):
    assert project.records(rows(spark, None, "{}", layer=layer)).count() == 0


def test_model_record(spark):
    content = {"cve_context": {"attempted": ["CVE-1"], "exploitation_results": {"CVE-1": "patched"}, "unexplored": []}, "target_version": "None", "applicable_constraints": {"known_ineffective_vectors": ["x"]}}
    r = project.records(rows(spark, json.dumps(content), service="web")).first()
    assert json.loads(r.content) == {"target_service": "web", "exploitation_status": "unknown", "cve_attempted": ["CVE-1"], "cve_results": {"CVE-1": "patched"}, "known_ineffective_vectors": ["x"]}
    assert json.loads(r.filters) == {"confidence": 0.0, "maturity": "raw", "factual_source": "llm", "exploitation_status": "unknown", "target_service": "web"}


def test_answer(spark):
    texts = ['```json\n{"a": 1}\n```', 'so: {"a": {"b": 2}} done', "none", "}{", None]
    got = [r.a for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(gates.answer(F.col("t")).alias("a")).collect()]
    assert got == ['{"a": 1}', '{"a": {"b": 2}}', "none", "}{", None]


def test_gates_name_their_fault(spark):
    s, e = "model_called boolean, model_answered boolean", "cause_source string"
    none = gates.annotation_gate(spark.createDataFrame([], s), spark.createDataFrame([], e)).first()
    assert (none.passed, none.reason, none.n_sessions) == (False, "no_session", 0)
    dead = gates.annotation_gate(spark.createDataFrame([(True, False)], s), spark.createDataFrame([("model",)], e)).first()
    assert dead.reason == "all_calls_failed"
    good = gates.annotation_gate(spark.createDataFrame([(True, True)], s), spark.createDataFrame([("model",), ("fallback",), (None,)], e)).first()
    assert good.passed and (good.n_causes, good.n_fallback) == (2, 1)
    x = "layer string, extraction_source string, rule_source string"
    assert gates.extraction_gate(spark.createDataFrame([], x)).first().reason == "no_rows"
    assert gates.extraction_gate(spark.createDataFrame([("FACTUAL", "rule", None)], x)).first().reason == "no_model_rows"
    assert gates.extraction_gate(spark.createDataFrame([("PROCEDURAL_NEG", "llm", "fallback")], x)).first().reason == "only_fallback_rules"


@pytest.mark.parametrize("size", [4, 10, 3000])
def test_split_text(spark, size):
    texts = ["", None, "a" * 25, "ab\ncd\nefghij\n\nk", "\n" * 30, "é😀\nü" * 9, "x" * size, "x" * size + "\n"]
    for t, got in ((r.t, r.p) for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", crawl.split_text(F.col("t"), size).alias("p")).collect()):
        want, rest = [], t or ""
        while len(rest) > size:
            cut = rest.rfind("\n", 0, size)
            cut = cut if cut > size // 2 else size
            want.append(rest[:cut])
            rest = rest[cut:]
        assert got == ([*want, rest] if rest or not want else want) and "".join(got) == (t or "")


def test_crawl(spark):
    poc = "#!/usr/bin/env python3\nimport requests\n" + "exploit payload CVE-2021-44228 curl http://x | nmap -sV\n" * 200
    kept = crawl.crawl_results(spark.createDataFrame([("a", poc, "https://github.com/x/y/blob/z"), ("b", "short", None), ("c", None, None)], "id string, text string, url string"), most_chars=50).collect()
    assert [r.id for r in kept] == ["a"] and len(kept[0].text) == 50 and kept[0].score >= 0.3
    d = spark.createDataFrame([("short", "full text"), ("short", " "), ("x" * 200, "full"), (None, None)], "s string, f string").select(crawl.feed_text(F.col("s"), F.col("f")).alias("t"))
    assert [r.t for r in d.collect()] == ["full text", "short", "x" * 200, None]
    m = spark.createDataFrame([("- [Red Lab](http://x)\n * **Blue**\ntext [no](y)\n- [Red Lab](z)",)], "t string").select(crawl.markdown_names(F.col("t")).alias("n"))
    assert m.first().n == ["Red Lab", "Blue"]
    state, batch = spark.createDataFrame([], "source string, last_seen long, n_seen long, n_runs long"), spark.createDataFrame([("a", 3), ("a", 5)], "source string, seen long")
    after = crawl.next_offsets(state, batch)
    assert after.collect() == [("a", 5, 2, 1)] and crawl.fresh_entries(batch.union(spark.createDataFrame([("a", 6), ("b", 1)], "source string, seen long")), after).count() == 2


def test_marks_and_ties(spark):
    registry = spark.createDataFrame([(1, "active", None), (2, "active", None), (3, "archived", None), (4, "suspended", 9), (5, "active", None)], "exp_id long, lifecycle string, merged_into long")
    into = spark.createDataFrame([(10, [1, 2, 3], 0, "active", "consolidated"), (11, [1, 2], 1, "conflicted", "raw"), (12, [1, 4], 2, "active", "consolidated"), (13, [5], 3, "active", "raw")], "exp_id long, source_ids array<long>, ord int, lifecycle string, maturity string")
    after = {r.exp_id: (r.lifecycle, r.merged_into) for r in history.mark_sources(registry, into).collect()}
    assert after == {1: ("archived", 12), 2: ("archived", 10), 3: ("archived", 10), 4: ("suspended", 9), 5: ("active", None)}
    assert {r.exp_id: r.merged_into for r in history.fill_merged_into(registry, into, last=True).collect()} == {1: None, 2: None, 3: 10, 4: 9, 5: None}
    notes = spark.createDataFrame([("x\\A.jsonl", 2, 1, 0, "first"), ("/y/a.JSONL", 2, 1, 1, "second"), ("a.jsonl", 1, 9, 2, "few")], "source_file string, n_events int, started int, ord int, label string")
    logs = spark.createDataFrame([("/z/a.jsonl",), ("b.jsonl",)], "path string")
    for tie, want in (("last", "second"), ("first", "first")):
        assert {r.path: r.label for r in history.annotate_logs(logs, notes, tie).collect()} == {"/z/a.jsonl": want, "b.jsonl": None}


def test_audit_and_stages(spark, tmp_path):
    from kenning.operators import report

    changes = spark.createDataFrame([("archive", 1), ("archive", 2), ("suspend", 3)], "action string, exp_id long")
    assert {tuple(r) for r in report.audit(changes, str(tmp_path), dry_run=True).collect()} == {("archive", 2), ("suspend", 1)} and not list(tmp_path.iterdir())
    for _ in range(2):
        report.audit(changes, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "trail")).count() == 6 and spark.read.parquet(str(tmp_path / "summary")).count() == 2
    stages, state = spark.createDataFrame([("a", 0), ("b", 1)], "stage string, place int"), spark.createDataFrame([("a", "done", "", 1.0)], "stage string, status string, message string, seconds double")
    assert [(r.stage, r.status) for r in report.stage_table(stages, state).collect()] == [("a", "done"), ("b", "pending")]
    d = spark.createDataFrame([(None, None, None), (["version"], ["1"], None), (["port"], ["1"], [" "]), (["port"], ["1"], ["CVE-1"])], "k array<string>, v array<string>, c array<string>")
    assert [r.h for r in d.select(report.hollow(F.col("k"), F.col("v"), F.col("c")).alias("h")).collect()] == [True, False, True, False]


def test_cut_points_are_deleted(spark):
    from pathlib import Path

    from kenning.plans import store

    a, b = store.materialise(spark.range(3), "one"), store.materialise(spark.range(4), "two")
    folder = lambda df: Path(df.inputFiles()[0].removeprefix("file://")).parent
    places = folder(a), folder(b)
    store.drop_cut(a)
    assert not places[0].exists() and places[1].exists() and b.count() == 4
    store.release(spark)
    assert not places[1].exists()
