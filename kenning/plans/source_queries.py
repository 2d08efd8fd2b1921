"""Queries through the log readers: the event view is written as logs of each dialect to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kenning.operators import records
from kenning.plans.event_queries import EVENTS
from kenning.plans.registry import query
from kenning.plans.store import new_path
from kenning.plans.views import events, table
from kenning.sources import arrays, logs

#: Files that the events make at least, and events that a file holds on average at most.
FILES, ROWS_A_FILE = 16, 20_000
READ = EVENTS + "SELECT event_id, session_id, tool_name, command, @@ FROM ve"
ALL = "has_result, CASE WHEN has_result THEN return_code END AS return_code, has_result AND timed_out AS timed_out, CASE WHEN has_result THEN CASE WHEN tool_name = 'error' THEN '' ELSE out_text END ELSE '' END AS stdout"


def _files(spark, sf_dir) -> int:
    return max(FILES, -(-table(spark, sf_dir, "events").count() // ROWS_A_FILE))


def _written(rows: DataFrame, what: str, files: int = FILES) -> str:
    """Write rows (file, at: place in it, value) as text files, a folder each; the path."""
    path = new_path(rows.sparkSession, what)
    rows.repartition(files, "file").sortWithinPartitions("file", "at").select("file", "value").write.partitionBy("file").text(path)
    return path


def _event_rows(spark, sf_dir) -> DataFrame:
    """Events with their file, args and the JSON of their result; sessions are whole within a file."""
    args = F.to_json(F.struct("command", "event_id"))
    result = F.to_json(F.struct("return_code", "timed_out", "success", "stdout", "stderr"))
    return events(spark, sf_dir).withColumns({"file": F.pmod(F.xxhash64("session_id"), F.lit(_files(spark, sf_dir))), "args": args, "result": result})


def _seen(read: DataFrame, *columns: str) -> DataFrame:
    return read.select(F.get_json_object("args", "$.event_id").cast("long").alias("event_id"), "session_id", "tool_name", "command", *columns)


def _native(rows: DataFrame) -> DataFrame:
    """file, at, value: the lines of native logs."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    start = F.when(F.col("turn_index") == 0, F.to_json(F.struct(F.lit("session_start").alias("event"), stamp.alias("timestamp"), "session_id")))
    call = F.struct(F.concat(F.lit("c"), F.col("event_id").cast("string")).alias("id"), F.lit("function").alias("type"), F.struct(F.col("tool_name").alias("name"), F.col("args").alias("arguments")).alias("function"))
    said = F.to_json(F.struct(F.lit("assistant_message").alias("event"), stamp.alias("timestamp"), F.when(F.col("k") % 3 == 0, " ").otherwise(F.concat(F.lit(" next "), F.col("k").cast("string"))).alias("content"), F.array(call).alias("tool_calls")))
    content = F.to_json(F.struct(F.lit("text").alias("type"), F.col("result").alias("text")))
    message = F.struct(F.lit("tool").alias("role"), content.alias("content"), F.concat(F.lit("c"), F.col("event_id").cast("string")).alias("tool_call_id"))
    asked = F.when(F.col("has_result"), F.to_json(F.struct(F.lit("UNKNOWN").alias("event"), F.lit("").alias("object"), stamp.alias("timestamp"), F.array(message).alias("messages"))))
    lines = F.array_compact(F.array(start, said, F.lit("not json"), asked))
    placed = rows.select("file", F.struct("session_id", "turn_index").alias("place"), F.posexplode(lines).alias("pos", "value"))
    return placed.select("file", F.struct("place", "pos").alias("at"), "value")


#: What the tools of the view are called in the logs: names of the readers' own table, so that they give the category.
IN_LOGS = {"view": "search_knowledge", "click": "run_command", "signup": "execute_code"}


def _renamed(tool, names: dict[str, str]):
    out = F
    for a, b in names.items():
        out = out.when(tool == a, b)
    return out.otherwise(tool)


@query(READ.replace("@@", ALL + ", category, CASE WHEN k % 3 <> 0 THEN 'next ' || k END AS thought, CASE WHEN category = 'RAG_QUERY' THEN -1 END AS n_results"))
def read_native_logs(spark, sf_dir) -> DataFrame:
    """Category, thought and number of results are the reader's own."""
    path = _written(_native(_event_rows(spark, sf_dir).withColumn("tool_name", _renamed(F.col("tool_name"), IN_LOGS))), "native", _files(spark, sf_dir))
    seen = _seen(logs.read_native(spark, path), "has_result", "return_code", "timed_out", F.coalesce("stdout", F.lit("")).alias("stdout"), "category", "thought", "n_results")
    return seen.withColumn("tool_name", _renamed(F.col("tool_name"), {b: a for a, b in IN_LOGS.items()}))


@query(EVENTS + """, s AS (SELECT abs(hash(session_id)) AS h, session_id, count(*) AS n, CAST(sum(CASE WHEN has_result THEN 1 ELSE 0 END) AS BIGINT) AS n_results FROM ve GROUP BY session_id) SELECT session_id, n, n_results FROM s""")
def read_native_sessions(spark, sf_dir) -> DataFrame:
    """Sessions in force, by line: a file holds many."""
    read = logs.read_native(spark, _written(_native(_event_rows(spark, sf_dir)), "native", _files(spark, sf_dir)))
    return read.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("has_result").alias("n_results"))


@query(READ.replace("@@", """return_code, CASE WHEN tool_name = 'error' THEN err_text ELSE out_text END || CASE WHEN tool_name <> 'view' OR k % 3 = 0 THEN '' WHEN k % 3 = 1 THEN ' doc 1 Doc 22' ELSE ' --- x' END AS stdout, return_code = 0 AS success,
 CASE WHEN tool_name = 'view' THEN 'RAG_QUERY' ELSE 'STRUCTURED_TOOL_CALL' END AS category, CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN 'think ' || k ELSE 'say ' || k END AS thought, CASE WHEN tool_name = 'view' THEN CASE k % 3 WHEN 0 THEN -1 ELSE 2 END END AS n_results"""))
def read_callback_logs(spark, sf_dir) -> DataFrame:
    """All calls of a file start before the first one ends; what the model said before a start is that call's thought."""
    rows = _event_rows(spark, sf_dir)
    run, k = F.concat(F.lit("r"), F.col("event_id").cast("string")), F.col("k").cast("string")
    said = lambda x, content: F.struct(F.array(F.array(F.struct(x.alias("text"), F.struct(content.alias("content")).alias("message")))).alias("generations"))
    text = F.when(F.col("k") % 4 == 1, said(F.concat(F.lit("think "), k), F.lit(""))).when(F.col("k") % 4 > 1, said(F.lit("unused"), F.concat(F.lit(" say "), k, F.lit("\n"))))
    model = F.when(F.col("k") % 4 > 0, F.to_json(F.struct(F.lit("on_llm_end").alias("type"), text.alias("response"))))
    start = F.to_json(F.struct(F.lit("on_tool_start").alias("type"), run.alias("run_id"), "session_id", _renamed(F.col("tool_name"), {"view": "KB_search"}).alias("name"), F.col("args").alias("input")))
    answer = F.when((F.col("tool_name") != "view") | (F.col("k") % 3 == 0), "").when(F.col("k") % 3 == 1, " doc 1 Doc 22").otherwise(" --- x")
    end = F.to_json(F.struct(F.lit("on_tool_end").alias("type"), run.alias("run_id"), "session_id", F.concat("stdout", "stderr", answer).alias("output"), F.struct("return_code").alias("run_metadata")))
    chain = F.when(F.col("k") % 5 == 0, F.lit('{"type": "on_chain_end", "run_id": "x"}'))
    begin = rows.select("file", F.lit(0).alias("half"), F.col("event_id").alias("place"), F.posexplode(F.array(model, chain, start)).alias("pos", "value"))
    ends = rows.select("file", F.lit(1).alias("half"), F.col("event_id").alias("place"), F.lit(0).alias("pos"), end.alias("value"))
    lines = begin.unionByName(ends).filter("value IS NOT NULL").select("file", F.struct("half", "place", "pos").alias("at"), "value")
    seen = _seen(logs.read_callbacks(spark, _written(lines, "callbacks", _files(spark, sf_dir))), "return_code", "stdout", "success", "category", "thought", "n_results")
    return seen.withColumn("tool_name", _renamed(F.col("tool_name"), {"KB_search": "view"}))


@query(READ.replace("@@", "return_code, timed_out, CASE WHEN tool_name = 'error' THEN '' ELSE out_text END AS stdout, row_number() OVER (PARTITION BY session_id ORDER BY turn_index) - 1 AS place"))
def read_run_steps(spark, sf_dir) -> DataFrame:
    """An array a file, which holds many sessions; each step is on its line, a null closes the array."""
    n = _files(spark, sf_dir)
    call = F.struct(F.lit("c").alias("id"), F.lit("function").alias("type"), F.struct(F.col("tool_name").alias("name"), F.col("args").alias("arguments"), F.col("result").alias("output")).alias("function"))
    step = F.struct(F.col("turn_index").cast("long").alias("created_at"), F.lit("thread.run.step").alias("object"), F.col("session_id").alias("thread_id"), F.struct(F.array(call).alias("tool_calls")).alias("step_details"))
    at = lambda place, event: F.struct(F.lit(place).alias("place"), event.alias("event_id"))
    steps = _event_rows(spark, sf_dir).select("file", at(1, F.col("event_id")).alias("at"), F.concat(F.to_json(step), F.lit(",")).alias("value"))
    none = F.lit(None).cast("long")
    ends = spark.range(n).select(F.col("id").alias("file"), F.inline(F.array(F.struct(at(0, none).alias("at"), F.lit('{"data": [').alias("value")), F.struct(at(2, none).alias("at"), F.lit("null]}").alias("value")))))
    path = _written(steps.union(ends), "steps", n)
    read = logs.read_run_steps(spark, path)
    return _seen(read, "return_code", "timed_out", "stdout", F.col("turn_index").alias("place"))


@query("""SELECT CAST(event_id % 7 AS BIGINT) AS file, 'OK' AS status, count(*) AS n, sum(event_id) AS ids, sum(length(event_type)) AS chars FROM events GROUP BY ALL
UNION ALL SELECT 7, 'TRUNCATED', 1, 1, 4""")
def read_event_arrays(spark, sf_dir) -> DataFrame:
    """All events as JSON arrays, one a file and on one line, beside a cut-off one; what each file gives."""
    path = new_path(spark, "arrays")
    rows = table(spark, sf_dir, "events").select((F.col("event_id") % 7).cast("long").alias("file"), "event_id", F.to_json(F.struct("event_id", "event_type", "props")).alias("value"))
    opened = rows.select("file", F.struct(F.lit(1).alias("a"), "event_id").alias("at"), F.concat(F.lit(","), "value").alias("value"))
    ends = spark.range(7).select(F.col("id").alias("file"), F.explode(F.array(F.struct(F.struct(F.lit(0).alias("a"), F.lit(0).cast("long").alias("event_id")).alias("at"), F.lit('[{"note": "]}"}').alias("value")), F.struct(F.struct(F.lit(2).alias("a"), F.lit(0).cast("long").alias("event_id")).alias("at"), F.lit("]").alias("value")))).alias("x")).select("file", "x.at", "x.value")
    broken = spark.createDataFrame([(7, 0, 0, '[{"event_id": 1, "event_type": "view"}, {"event_id": 2')], "file long, a int, event_id long, value string").select("file", F.struct("a", "event_id").alias("at"), "value")
    lines = opened.unionByName(ends).unionByName(broken)
    lines.repartition("file").sortWithinPartitions("file", "at").select("file", "value").write.partitionBy("file").option("lineSep", " ").text(path)
    file = F.regexp_extract("source_file", r"file=(\d+)", 1).cast("long").alias("file")
    got = arrays.elements(spark, path).select(file, F.from_json("value", "event_id long, event_type string").alias("e"))
    per = got.groupBy("file").agg(F.count("e.event_id").alias("n"), F.sum("e.event_id").alias("ids"), F.sum(F.length("e.event_type")).alias("chars"))
    told = arrays.report(spark, path).select(file, "status")
    return told.join(per, "file", "left").na.fill(0, ["n"])


@query(READ.replace("@@", "turn_index, return_code, CASE WHEN tool_name = 'error' THEN '' ELSE out_text END AS stdout, timed_out"))
def read_generic_logs(spark, sf_dir) -> DataFrame:
    """Any JSONL, its fields under other names, one of them mapped by the caller."""
    rows = _event_rows(spark, sf_dir)
    line = F.to_json(F.struct(F.col("session_id").alias("conversation_id"), F.col("turn_index").alias("step"), F.col("tool_name").alias("tool"), F.col("args").alias("input"), F.col("stdout").alias("printed"), F.col("stderr").alias("error"), F.col("return_code").alias("rc"), F.col("timed_out").alias("timeout")))
    path = _written(rows.select("file", F.col("event_id").alias("at"), line.alias("value")), "generic", _files(spark, sf_dir))
    return _seen(logs.read_generic(spark, path, {"stdout": ["printed"]}), F.col("turn_index").cast("long").alias("turn_index"), "return_code", "stdout", "timed_out")


@query(EVENTS + """SELECT 'native' AS dialect, count(DISTINCT session_id) AS n_sessions, count(*) AS n FROM ve UNION ALL SELECT 'generic', count(DISTINCT session_id), count(*) FROM ve""")
def read_mixed_logs(spark, sf_dir) -> DataFrame:
    """A folder of two dialects: each file is sniffed and read by its own reader. A dialect is that of the reader, which must be the file's."""
    if table(spark, sf_dir, "events").isEmpty():
        return spark.createDataFrame([("native", 0, 0), ("generic", 0, 0)], "dialect string, n_sessions long, n long")  # no logs are written, and none are an error to read()
    rows, n = _event_rows(spark, sf_dir), _files(spark, sf_dir)
    native = _native(rows.withColumn("session_id", F.concat(F.lit("n-"), "session_id"))).withColumn("at", F.struct("at.place.session_id", "at.place.turn_index", "at.pos"))
    line = F.to_json(F.struct(F.concat(F.lit("g-"), F.col("session_id")).alias("session_id"), F.col("turn_index").alias("turn_index"), "tool_name", F.col("args").alias("tool_args"), "stdout"))
    generic = rows.select((F.col("file") + n).alias("file"), F.struct("session_id", "turn_index", F.lit(0).alias("pos")).alias("at"), line.alias("value"))
    read = logs.read(spark, _written(native.union(generic), "mixed", 2 * n), generic={"unnamed": True})
    written = F.when(F.regexp_extract("source_file", r"file=(\d+)", 1).cast("long") < n, "native").otherwise("generic")
    dialect = F.when(F.col("dialect") == written, written).otherwise(F.raise_error(F.concat("source_file", F.lit(" was read as "), "dialect")))
    return read.groupBy(dialect.alias("dialect")).agg(F.count_distinct("session_id").alias("n_sessions"), F.count(F.lit(1)).alias("n"))


@query(EVENTS + """, l AS (SELECT session_id, count(*) AS n, CAST(sum(CASE WHEN category = 'CODE_WRITE' THEN 1 ELSE 0 END) AS BIGINT) AS w, CAST(sum(CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS bad FROM ve GROUP BY 1)
SELECT session_id AS source_file, CASE WHEN bad < n THEN 'OK' ELSE 'ERROR' END AS status, n AS n_lines, bad AS n_bad, n AS n_events, w AS n_code_writes FROM l""")
def file_report(spark, sf_dir) -> DataFrame:
    e = events(spark, sf_dir).withColumn("source_file", F.col("session_id"))
    lines = e.select("source_file", F.when(F.col("event_id") % 10 == 0, F.lit('{"cut')).otherwise(F.to_json(F.struct("event_id"))).alias("raw"))
    return records.file_report(lines, e)


#: What a knowledge search prints: a list, an object with a list, separators, numbered words, nothing, or a text.
OUTPUT = """CASE doc_id % 6 WHEN 0 THEN concat('[', repeat('1,', CAST(doc_id % 7 AS INT)), '1]') WHEN 1 THEN concat('{"chunks": [', repeat('"a",', CAST(doc_id % 5 AS INT)), '"b"]}')
 WHEN 2 THEN concat('x', repeat(' --- y', CAST(doc_id % 4 AS INT))) WHEN 3 THEN concat('Document 1 ', repeat('chunk 7 ', CAST(doc_id % 3 AS INT))) WHEN 4 THEN '' ELSE text END"""


@query(f"""SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN doc_id % 7 + 1 WHEN 1 THEN doc_id % 5 + 1 WHEN 2 THEN CASE doc_id % 4 WHEN 0 THEN -1 ELSE doc_id % 4 + 1 END WHEN 3 THEN doc_id % 3 + 1 WHEN 4 THEN 0
 ELSE CASE WHEN trim(coalesce(text, '')) = '' THEN 0 WHEN contains(text, '---') THEN (length(text) - length(replace(text, '---', ''))) // 3 + 1 WHEN len(regexp_extract_all(text, '(?i)\\b(document|chunk) *[0-9]+\\b')) > 0 THEN len(regexp_extract_all(text, '(?i)\\b(document|chunk) *[0-9]+\\b')) ELSE -1 END END AS n FROM documents""")
def result_counts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", records.result_count(F.expr(OUTPUT)).cast("long").alias("n"))
