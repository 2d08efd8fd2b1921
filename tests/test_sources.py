import gzip
import json

import pytest

from kenning.sources import arrays, files, logs


def result(rc, out="", err="", timed_out=False):
    return json.dumps({"type": "text", "text": json.dumps({"return_code": rc, "timed_out": timed_out, "success": rc == 0, "stdout": out, "stderr": err})})


def call(i, name, **args):
    return {"id": i, "type": "function", "function": {"name": name, "arguments": json.dumps(args)}}


def native_log():
    rows = [
        {"event": "session_start", "timestamp": "2026-01-01T00:00:00+00:00", "session_id": "abc"},
        {"event": "user_message", "timestamp": "2026-01-01T00:00:01", "content": "look at http://10.0.0.5/"},
        {"event": "assistant_message", "timestamp": "2026-01-01T00:00:02", "tool_calls": [call("r1", "rag_query", query="nmap use"), call("c1", "generic_linux_command", command="nmap h")]},
        {"event": "UNKNOWN", "object": "", "messages": [{"role": "tool", "tool_call_id": "c1", "content": result(1, err="first")}]},
        {"event": "UNKNOWN", "object": "chat.completion", "choices": [{"message": {"role": "assistant", "content": "x", "tool_calls": []}}]},
        {"event": "assistant_message", "timestamp": "2026-01-01T00:00:05"},
        {"event": "UNKNOWN", "object": "", "messages": [{"role": "tool", "tool_call_id": "c1", "content": result(0, "open")}, {"role": "tool", "tool_call_id": "d1", "content": "Command exited with code 127"}]},
        {"event": "UNKNOWN", "object": "chat.completion", "choices": [{"message": {"role": "assistant", "tool_calls": [call("d1", "execute_code", code="print(1)")]}}]},
        {"event": "assistant_message", "timestamp": "2026-01-01T00:00:09", "tool_calls": [call("d1", "shell", command="ls")]},
        {"event": "session_end", "timestamp": "2026-01-01T00:01:00", "session_id": "abc", "cost": {"total_cost": 0.05}},
    ]
    first, *rest = map(json.dumps, rows)
    return "\n".join([first, "", "not json", "[1]", *rest])


def test_native_log(spark, tmp_path):
    (tmp_path / "log_zzz_1.jsonl").write_text(native_log())
    rows = {(r.turn_index, r.slot): r for r in logs.read_native(spark, str(tmp_path)).collect()}
    assert sorted(rows) == [(0, 0), (0, 1), (1, 0), (2, 0)]
    assert rows[0, 0].category == "RAG_QUERY" and rows[0, 0].query == "nmap use" and not rows[0, 0].has_result
    assert rows[0, 1].return_code == 0 and rows[0, 1].stdout == "open", "the last result of a call wins"
    assert rows[1, 0].tool_name == "execute_code" and rows[1, 0].return_code == 127, "calls of the completion; code from plain text"
    assert not rows[2, 0].has_result, "a turn without a request has no results"
    assert {r.session_id for r in rows.values()} == {"abc"}
    s = logs.read_sessions(spark, str(tmp_path)).first()
    assert (s.n_turns, s.total_cost, s.end_type, s.target) == (3, 0.05, "normal", "look at http://10.0.0.5/")


def test_session_id_from_file_name_and_interruption(spark, tmp_path):
    (tmp_path / "log_zzz_1.jsonl").write_text(json.dumps({"event": "assistant_message", "tool_calls": [call("a", "shell", command="x")]}))
    assert logs.read_native(spark, str(tmp_path)).first().session_id == "zzz"
    assert logs.read_sessions(spark, str(tmp_path)).first().end_type == "interrupted"


def test_other_dialects_and_sniffing(spark, tmp_path):
    (tmp_path / "a_1.jsonl").write_text(native_log())
    cb = [{"type": "on_chain_start", "run_id": "0"}, {"type": "on_llm_end", "response": {"generations": [[{"text": "a", "message": {"content": " plan "}}]]}}, {"type": "on_tool_start", "run_id": "1", "name": "shell", "input": '{"command": "id"}'}, {"type": "on_llm_end", "response": {"generations": [[{"text": "too late"}]]}}, {"type": "on_tool_end", "run_id": "9", "output": "lost"}, {"type": "on_tool_end", "run_id": "1", "output": "uid=0", "run_metadata": {"return_code": 0}}]
    (tmp_path / "b.jsonl").write_text("\n".join(map(json.dumps, cb)))
    old = [{"type": "agent_action", "tool": "shell", "tool_input": "id", "log": "Invoking: `shell`\nwhy not"}, {"type": "tool_result", "output": "x"}, {"type": "agent_action", "tool": "search", "log": "Invoking: y"}, {"type": "llm_end", "response": {"generations": [[{"text": "said"}]]}}, {"type": "tool_result", "output": "a --- b"}, {"type": "tool_result", "output": "orphan"}]
    (tmp_path / "c.jsonl").write_text("\n".join(map(json.dumps, old)))
    steps = [{"id": "s2", "object": "thread.run.step", "created_at": 20, "thread_id": "t", "step_details": {"tool_calls": [{"id": "z", "type": "other"}, {"id": "y", "type": "file_search", "file_search": {"results": [{"id": "1", "text": "doc"}]}}]}}, {"id": "s1", "object": "thread.run.step", "created_at": 10, "thread_id": "t", "step_details": {"tool_calls": [{"id": "x", "type": "function", "function": {"name": "shell", "arguments": '{"command": "ls"}', "output": '{"return_code": 0, "stdout": "ok"}'}}]}}]
    (tmp_path / "d.json").write_text(json.dumps({"data": steps}))
    generic = [{"session": "g", "tool": "shell", "args": {"command": "w"}, "output": "o", "exit_code": "2"}, {"session": "g", "note": "no tool"}]
    (tmp_path / "e.jsonl").write_text("\n".join(map(json.dumps, generic)))
    found = {r.source_file.split("/")[-1]: r.dialect for r in logs.sniff(spark, str(tmp_path)).collect()}
    assert found == {"a_1.jsonl": "native", "b.jsonl": "callbacks", "c.jsonl": "callbacks", "d.json": "run_steps", "e.jsonl": "generic"}
    rows = logs.read(spark, str(tmp_path)).collect()
    by = lambda part: sorted((r for r in rows if part in r.source_file.split("/")[-1]), key=lambda r: (r.turn_index, r.slot))
    assert [(r.turn_index, r.slot, r.session_id, r.category, r.stdout) for r in by("a_1.jsonl")] == [(0, 0, "abc", "RAG_QUERY", ""), (0, 1, "abc", "GENERIC_COMMAND_CALL", "open"), (1, 0, "abc", "CODE_WRITE", "Command exited with code 127"), (2, 0, "abc", "GENERIC_COMMAND_CALL", "")]
    assert [(r.stdout, r.return_code, r.command, r.thought, r.n_results) for r in by("b.jsonl")] == [("uid=0", 0, "id", "plan", None)]
    assert [(r.stdout, r.command, r.category, r.thought, r.n_results) for r in by("c.jsonl")] == [("x", "id", "GENERIC_COMMAND_CALL", "why not", None), ("a --- b", None, "RAG_QUERY", "said", 2)]
    assert [(r.turn_index, r.slot, r.tool_name, r.stdout) for r in by("d.json")] == [(0, 0, "shell", "ok"), (1, 1, "search_knowledge", "doc")]
    assert [(r.session_id, r.return_code, r.success, r.command) for r in by("e.jsonl")] == [("g", 2, False, "w")]


def test_catalogue_and_sinks(spark, tmp_path):
    for p in ("raw/x/1.txt", "raw/x/2.txt", "raw/y/3.txt"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_text(p)
    stats = {r.source: r.n_files for r in files.source_stats(files.catalogue(spark, str(tmp_path / "raw"))).collect()}
    assert stats == {"x": 2, "y": 1}
    df = spark.createDataFrame([("a", 1), ("b", 2)], "session_id string, n int")
    files.write_sessions(df, str(tmp_path / "out"))
    files.write_sessions(df.filter("n = 1").withColumn("n", df.n + 5), str(tmp_path / "out"))
    assert sorted((r.session_id, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("a", 6), ("b", 2)]


def test_lines_of_split_files(spark, tmp_path):
    """A log in many splits gives the events of the same log in one."""
    rows = [{"event": "session_start", "session_id": "abc"}]
    for i in range(60):
        rows += [{"event": "assistant_message", "content": f"t{i}", "tool_calls": [call(f"c{i}", "shell", command=f"echo {i}")]}, {"event": "UNKNOWN", "object": "", "messages": [{"role": "tool", "tool_call_id": f"c{i}", "content": result(i % 3, f"é{i}")}]}]
    (tmp_path / "log_abc_1.jsonl").write_text("\n".join(["", *map(json.dumps, rows), "no json"]))
    (tmp_path / "log_other.jsonl").write_text(json.dumps({"tool": "w", "n": 1}))
    (tmp_path / "empty.jsonl").write_text("")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    seen = []
    try:
        for size in ("700b", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b")
            assert logs.lines(spark, str(tmp_path)).rdd.getNumPartitions() > 8 or size == "128m"
            seen.append(sorted((r.turn_index, r.session_id, r.command, r.return_code, r.stdout, r.thought) for r in logs.read_native(spark, str(tmp_path / "log_abc_1.jsonl")).collect()))
            assert {r.source_file.split("/")[-1]: r.dialect for r in logs.sniff(spark, str(tmp_path)).collect()} == {"log_abc_1.jsonl": "generic", "log_other.jsonl": "generic"}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert seen[0] == seen[1] == [(i, "abc", f"echo {i}", i % 3, f"é{i}", f"t{i}") for i in range(60)]


def test_marked_csv(spark, tmp_path):
    from kenning.sources import files

    files.write_csv(spark.createDataFrame([(1, "é")], "a int, b string"), str(tmp_path / "c"), mark=True)
    texts = [x.read_bytes() for x in (tmp_path / "c").glob("*.csv")]
    assert "﻿a,b\n1,é\n".encode() in texts and all(x.startswith("﻿a,b\n".encode()) for x in texts)
    files.write_json(spark.createDataFrame([("s1", 1), ("s2", 2)], "session_id string, n int"), str(tmp_path / "j"), "session_id")
    assert spark.read.json(str(tmp_path / "j")).count() == 2 and (tmp_path / "j" / "session_id=s1").is_dir()


def test_sniffing_of_broken_starts(spark, tmp_path):
    start, other = '{"event": "session_start", "session_id": "a"}', '{"event": "x"}'
    cases = {"first": start, "later": f"{other}\n{start}", "broken": f"{{cut\n{start}", "blank": f"\n{start}", "late": f"{other}\n" * 10 + start, "list": f"[1]\n{start}", "weak": '[{"object": {"kind": "thread.run.step"}, "step_details": {"x": "' + "y" * 200_000 + '"}}]', "whole": '{"thread.run.step": 1, "step_details": 2}'}
    for name, text in cases.items():
        (tmp_path / f"{name}.jsonl").write_text(text)
    found = {r.source_file.split("/")[-1][:-6]: r.dialect for r in logs.sniff(spark, str(tmp_path)).collect()}
    assert found == {"first": "native", "later": "native", "broken": "generic", "blank": "generic", "late": "generic", "list": "generic", "weak": "run_steps", "whole": "generic"}
    assert logs.registered() == ["native", "callbacks", "run_steps", "generic"]
    reader = logs.READERS["generic"]
    logs.register("mine", reader)
    logs.unregister("mine")
    assert "mine" not in logs.registered()


def test_run_steps_of_many_sessions_in_a_file(spark, tmp_path):
    step = lambda thread, at: {"object": "thread.run.step", "created_at": at, "thread_id": thread, "step_details": {"tool_calls": [call(f"{thread}{at}", "shell", command=str(at))]}}
    (tmp_path / "steps.json").write_text(json.dumps({"data": [step("a", 5), step("b", 1), step("a", 2), step("b", 9), None]}))
    rows = logs.read_run_steps(spark, str(tmp_path)).collect()
    assert sorted((r.session_id, r.turn_index, r.command) for r in rows) == [("a", 0, "2"), ("a", 1, "5"), ("b", 0, "1"), ("b", 1, "9")]


def test_running_values_over_many_chunks(spark, tmp_path, monkeypatch):
    """Chunks of two lines give what one chunk gives, in each reader of lines."""
    said = [{"type": "on_llm_end", "response": {"generations": [[{"text": "t1", "message": {"content": ""}}]]}}, {"type": "on_chain_end"}, {"type": "on_tool_start", "run_id": "r", "name": "shell", "input": "ls"}]
    old = [{"type": "agent_action", "tool": "shell", "tool_input": "a", "log": "x"}, {"type": "tool_result", "output": "o"}, {"type": "on_tool_end", "run_id": "r", "output": "p"}]
    (tmp_path / "n_a.jsonl").write_text(native_log() + "\n" + native_log().replace('"abc"', '"second"'))
    (tmp_path / "c.jsonl").write_text("\n".join(json.dumps(x) for x in said + old + said + old))
    (tmp_path / "g.jsonl").write_text("\n".join(json.dumps({"tool": "shell", "args": f"echo {i}"}) for i in range(9)))
    read = lambda: [sorted(map(str, reader(spark, str(tmp_path / file)).drop("source_file").collect())) for reader, file in ((logs.read_native, "n_a.jsonl"), (logs.read_callbacks, "c.jsonl"), (logs.read_generic, "g.jsonl"))]
    whole = read()
    monkeypatch.setattr(logs, "CHUNK_BITS", 1)
    assert read() == whole and [len(x) for x in whole][1:] == [4, 9]
    assert "second" in str(whole[0]) and {r.turn_index for r in logs.read_callbacks(spark, str(tmp_path / "c.jsonl")).collect()} == {0, 1, 2, 3}


def test_files_that_give_nothing_are_told(spark, tmp_path):
    """A file that can't be read, ends too early or is no log isn't taken for one without events."""
    line = lambda i: json.dumps({"session": "g", "tool": "shell", "args": f"echo {i}"})
    step = json.dumps({"object": "thread.run.step", "created_at": 1, "thread_id": "t", "step_details": {"tool_calls": [call("c", "shell", command="ls")]}})
    good = {"native.jsonl": native_log(), "a b#1%41.jsonl": line(1), "s*[1].jsonl": line(2), "sa1.jsonl": line(3), "late.jsonl": '{"note": "x"}\n' * 50 + line(4), "steps.json": f"[{step}]", "quiet.jsonl": '{"event": "session_start", "session_id": "q"}'}
    bad = {"broken.jsonl": "{cut\n" + native_log(), "text.jsonl": "some\nwords\n", "untold.jsonl": '{"note": "no tool"}', "cut.json": f'[{step}, {{"object": "thread.ru', "lines.json": f"{step}\n{step}\n"}
    for name, text in {**good, **bad, "none.jsonl": "", "blank.jsonl": " \n\n"}.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "steps.json.gz").write_bytes(gzip.compress(f'{{"data": [{step}]}}\n'.encode()))
    (tmp_path / "lost.jsonl.gz").write_bytes(b"\x1f\x8bnot gzip")
    (tmp_path / "cut.json.gz").write_bytes(gzip.compress(f'[{step}, {{"object": "thread.run.step'.encode()))
    told = {logs.unquote(r.source_file).split("/")[-1]: (r.dialect, r.status) for r in logs.survey(spark, str(tmp_path)).collect()}
    assert {k for k, v in told.items() if v[1] == "OK"} == {*good, "steps.json.gz"}
    assert {k: v for k, v in told.items() if v[1] != "OK"} == {
        "broken.jsonl": ("generic", "NO LOG"), "text.jsonl": ("generic", "NO LOG"), "untold.jsonl": ("generic", "NO LOG"), "lines.json": ("run_steps", "NO LOG"),
        "cut.json": ("run_steps", "TRUNCATED"), "cut.json.gz": ("run_steps", "TRUNCATED"), "lost.jsonl.gz": (None, "UNREADABLE"), "none.jsonl": (None, "EMPTY"), "blank.jsonl": ("generic", "EMPTY"),
    }
    with pytest.raises(ValueError, match=r"7 files .*broken\.jsonl \(NO LOG\).*lost\.jsonl\.gz \(UNREADABLE\)"):
        logs.read(spark, str(tmp_path))
    rows = logs.read(spark, str(tmp_path), skip_failed=True).collect()
    assert sorted((r.dialect, r.command) for r in rows if r.dialect != "native") == [*(("generic", f"echo {i}") for i in (1, 2, 3, 4)), ("run_steps", "ls"), ("run_steps", "ls")]
    assert sum(r.dialect == "native" for r in rows) == 4
    kept = logs.read(spark, str(tmp_path / "late.jsonl"), generic={"unnamed": True})
    assert kept.count() == 51 and kept.filter("tool_name IS NULL AND category = 'STRUCTURED_TOOL_CALL'").count() == 50
    for name in ("cut.json", "lost.jsonl.gz"):
        with pytest.raises(Exception, match="end too early|FAILED_READ_FILE"):
            logs.read_run_steps(spark, str(tmp_path / name)).collect()
    assert [json.loads(r.value)["thread_id"] for r in arrays.elements(spark, str(tmp_path / "cut.json.gz")).collect()] == ["t"], "no closing brace is made up"


@pytest.mark.parametrize("odd", ["event_type = NULL", "event_type = ''", "user_id = NULL", "ts = NULL", "all gone"])
def test_mixed_logs_of_odd_events(spark, tmp_path, odd):
    """Calls of one dialect are never counted as the other's, and none goes."""
    import duckdb

    import __spark_entry__ as entry

    column, _, value = odd.partition(" = ")
    rows = f"SELECT * REPLACE (CASE WHEN event_id % 5 = 0 THEN {value} ELSE {column} END AS {column}) FROM t" if value else "SELECT * FROM t WHERE false"
    db = duckdb.connect()
    db.sql(f"COPY (WITH t AS (FROM '/root/testdata/sf0.001/events.parquet') {rows}) TO '{tmp_path}/events.parquet'")
    db.sql(f"CREATE VIEW events AS FROM '{tmp_path}/events.parquet'")
    found = entry.queries()["read_mixed_logs"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == sorted(db.sql(entry.oracle_sql()["read_mixed_logs"]).fetchall())


def test_mixed_logs_told_wrong_are_an_error(spark, monkeypatch):
    """Native logs without a session start are taken for generic ones: no row of theirs is a result."""
    from kenning.plans import source_queries

    native = source_queries._native
    monkeypatch.setattr(source_queries, "_native", lambda rows: native(rows).filter("NOT contains(value, 'session_start')"))
    with pytest.raises(Exception, match="was read as generic"):
        source_queries.read_mixed_logs(spark, "/root/testdata/sf0.001").collect()


def test_lines_are_taken_whole_or_not(spark, tmp_path):
    """Repeated keys and white space lose no line, half a line is none, and one too large for Spark's parser is an error."""
    good = ['{"a": 1, "a": 2}', '\t{"a": {"b": [1, "}"]}} \t', "{}", '{"a": "x}"}']
    bad = ['{"a": 1}{"b": 2}', '{"a": 1} cut', '{"a": 1},', '{"a": 1}]', '{"a": 1}, {"b": 2}', '{"a": "x\ty"}', "{'a': 1}", '{"a": 1', "[1]", "", "{cut}"]
    (tmp_path / "x.jsonl").write_text("\n".join(good + bad))
    assert sorted(r.raw for r in logs.lines(spark, str(tmp_path)).collect()) == sorted(good)
    large = '{"tool": "shell", "output": "' + "x" * 20_000_001 + '"}'
    (tmp_path / "y.jsonl").write_text(large)
    with pytest.raises(Exception, match="too large to parse"):
        logs.read(spark, str(tmp_path / "y.jsonl")).count()
    (tmp_path / "z.json").write_text(f'[{{"object": "thread.run.step", "thread_id": "t"}}, {large}]')
    with pytest.raises(Exception, match="too large to parse"):
        logs.read_run_steps(spark, str(tmp_path / "z.json")).count()
