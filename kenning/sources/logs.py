"""Readers of agent logs: four dialects, one canonical frame.

Lines are read in the splits that Spark makes of files and keep their order by split and place, so a log of any size is
read in parallel. Bad lines are dropped. Each reader gives the columns of CANONICAL. Files that give nothing because
they can't be read, end too early or are no logs are told by survey(), and are an error to read().
"""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kenning.functions import text as tx
from kenning.operators import records
from kenning.plans.store import materialise
from kenning.sources import arrays

CANONICAL = ["source_file", "session_id", "turn_index", "slot", "ts", "tool_name", "args", "command", "code", "query", "has_result", "return_code", "timed_out", "success", "stdout", "stderr", "category", "thought", "n_results"]
# Tool names by category, and the event kinds that give a dialect away.
TOOLS = {"rag_query": "RAG_QUERY", "search_knowledge": "RAG_QUERY", "generic_linux_command": "GENERIC_COMMAND_CALL", "run_command": "GENERIC_COMMAND_CALL", "shell": "GENERIC_COMMAND_CALL", "execute_code": "CODE_WRITE", "write_file": "CODE_WRITE"}
SEARCHES = ["retrieval", "search", "kb_search", "rag_query", "retrieve", "vector_search", "knowledge_base_search", "similarity_search", "search_knowledge_base", "file_search"]
CALLBACK_KINDS = ["on_chain_start", "on_chain_end", "on_tool_start", "on_tool_end", "on_llm_end", "agent_action", "tool_result"]

_CALL = "array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>"
_MESSAGE = f"struct<role:string,content:string,tool_call_id:string,tool_calls:{_CALL}>"
NATIVE = f"struct<event:string,object:string,timestamp:string,session_id:string,content:string,tool_calls:{_CALL},messages:array<{_MESSAGE}>,choices:array<struct<message:{_MESSAGE}>>,timing_metrics:map<string,double>,cost:struct<total_cost:double>>"


def _text(spark: SparkSession, path: str | list[str], skip: bool = False) -> DataFrame:
    """source_file, line_no, value: every line, split like Spark splits files, so that a file of any size is read in parallel.

    line_no orders the lines of a file: the place of the line's split, then the line's place in the task that read it.
    skip: files that can't be read are passed over.
    """
    options = {"ignoreCorruptFiles": "true", "ignoreMissingFiles": "true"} if skip else {}
    raw = spark.read.options(**options).text(path).select(F.input_file_name().alias("source_file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), "value")
    return raw.select("source_file", F.struct("block", "row").alias("line_no"), "value")


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """source_file, line_no (in order within a file), raw: JSON object lines only."""
    begun = _text(spark, path).filter(tx.bare(F.col("value")).startswith("{")).select("source_file", "line_no", tx.parseable(F.col("value")).alias("raw"))
    return begun.filter(tx.is_object(F.col("raw")))


#: Lines that a running value is taken over at once, as a power of two.
CHUNK_BITS = 14


def running(rows: DataFrame, sums: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None) -> DataFrame:
    """rows (of lines()) with running values over each file up to and with a line: sums of integers, last values that aren't null.

    They are taken within chunks of a block, whose own sums and last values, one row a chunk, are chained by file; so no
    task sorts more of a file than a few chunks.
    """
    sums, lasts = sums or {}, lasts or {}
    chunk = F.struct(F.col("line_no.block").alias("block"), F.shiftright("line_no.row", CHUNK_BITS).alias("part"))
    held = rows.select("source_file", chunk.alias("chunk"), "line_no", *[c.alias(n) for n, c in (sums | lasts).items()])
    per = held.groupBy("source_file", "chunk").agg(
        *[F.sum(n).cast("long").alias(f"__{n}") for n in sums], *[F.max_by(n, F.when(F.col(n).isNotNull(), F.col("line_no"))).alias(f"__{n}") for n in lasts]
    )
    before = Window.partitionBy("source_file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chained = per.select("source_file", "chunk", *[F.sum(f"__{n}").over(before).alias(f"__{n}") for n in sums], *[F.last(f"__{n}", ignorenulls=True).over(before).alias(f"__{n}") for n in lasts])
    within = Window.partitionBy("source_file", "chunk").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.withColumn("chunk", chunk).join(chained, ["source_file", "chunk"])
    values = {n: F.coalesce(F.sum(c).over(within), F.lit(0)) + F.coalesce(f"__{n}", F.lit(0)) for n, c in sums.items()}
    values |= {n: F.coalesce(F.last(c, ignorenulls=True).over(within), F.col(f"__{n}")) for n, c in lasts.items()}
    return joined.withColumns(values).drop("chunk", *[f"__{n}" for n in values])


def kind(o: Column) -> Column:
    """What a native line is, by event name first, then by its keys."""
    event = F.coalesce(o["event"], F.lit(""))
    named = event.isin("session_start", "session_end", "user_message", "assistant_message")
    exchange = (event == "UNKNOWN") | ((event == "") & o["messages"].isNotNull())
    return (
        F.when(named, event)
        .when(exchange & (o["object"] == "chat.completion"), "completion")
        .when(exchange, "api_request")
        .when(o["messages"].isNotNull() & o["choices"].isNull(), "api_request")
        .when(o["choices"].isNotNull(), "completion")
        .otherwise("unknown")
    )


def native_kinds(spark: SparkSession, path: str) -> DataFrame:
    """source_file, line_no, o (typed), kind."""
    parsed = lines(spark, path).withColumn("o", F.from_json("raw", NATIVE)).drop("raw")
    return parsed.withColumn("kind", kind(F.col("o")))


def native_lines(spark: SparkSession, path: str) -> DataFrame:
    """source_file, line_no, kind, o (typed), turn_index (-1 before the first assistant message), session_id in force."""
    parsed = native_kinds(spark, path)
    stem = F.regexp_extract("source_file", r"([^/]+?)(?:\.[^./]*)?$", 1)
    default = F.coalesce(F.get(F.split(stem, "_"), F.lit(1)), stem)
    ran = running(parsed, {"turn_index": (F.col("kind") == "assistant_message").cast("int")}, {"session_id": F.when(F.col("kind") == "session_start", F.col("o.session_id"))})
    return ran.withColumns({"turn_index": (F.col("turn_index") - 1).cast("int"), "session_id": F.coalesce("session_id", default)})


def native_turns(native: DataFrame) -> DataFrame:
    """A row per turn: its assistant line, its completion (the first before anything that closes it), whether it has a request."""
    own = native.filter("turn_index >= 0")
    per = Window.partitionBy("source_file", "turn_index")
    close = F.min(F.when(F.col("kind").isin("completion", "session_end"), F.col("line_no"))).over(per)
    open_ = own.withColumn("close", close).filter(F.col("close").isNull() | (F.col("line_no") <= F.col("close")))
    return open_.groupBy("source_file", "turn_index").agg(
        F.min_by(F.struct("session_id", "o.timestamp", "o.content", F.col("o.tool_calls").alias("calls")), "line_no").alias("said"),
        F.first(F.when(F.col("kind") == "completion", F.get("o.choices", F.lit(0))["message"]["tool_calls"]), ignorenulls=True).alias("completed"),
        F.bool_or(F.col("kind") == "api_request").alias("has_request"),
    )


def native_results(native: DataFrame) -> DataFrame:
    """source_file, call_id, content: for each call the last tool message of any request of the file."""
    tools = native.filter("kind = 'api_request'").select("source_file", "line_no", F.posexplode("o.messages").alias("pos", "m")).filter("m.role = 'tool' AND m.tool_call_id <> ''")
    return tools.groupBy("source_file", F.col("m.tool_call_id").alias("call_id")).agg(F.max_by("m.content", F.struct("line_no", "pos")).alias("content"))


def decode_result(content: Column) -> dict[str, Column]:
    """Result fields of a tool message: JSON in JSON, plain JSON, or plain text."""
    inner = F.coalesce(F.get_json_object(content, "$.text"), content)
    known = F.get_json_object(inner, "$.stdout").isNotNull() | F.get_json_object(inner, "$.return_code").isNotNull() | F.get_json_object(inner, "$.stderr").isNotNull()
    told = F.nullif(F.regexp_extract(content, r"Command exited with code (-?\d+)", 1), F.lit(""))
    return {
        "return_code": F.coalesce(F.get_json_object(inner, "$.return_code"), told).try_cast("int"),
        "timed_out": F.coalesce(F.get_json_object(inner, "$.timed_out") == "true", F.lit(False)),
        "success": F.get_json_object(inner, "$.success") == "true",
        "stdout": F.when(known, F.coalesce(F.get_json_object(inner, "$.stdout"), F.lit(""))).otherwise(F.coalesce(inner, F.lit(""))),
        "stderr": F.coalesce(F.get_json_object(inner, "$.stderr"), F.lit("")),
    }


def category(tool: Column) -> Column:
    out = F
    for name, group in TOOLS.items():
        out = out.when(F.lower(tool) == name, group)
    return out.otherwise("STRUCTURED_TOOL_CALL")


def _finish(rows: DataFrame, reader: str = "generic", searches: list[str] | None = None) -> DataFrame:
    """Canonical columns from rows with source_file, session_id, turn_index, slot, ts, tool_name, args and a result.

    A call of one of the searches (tool names in lower case) is a search whatever its table of categories says; n_results
    is how many documents a search gave, by what its reader knows of answers (-1: unknown), and null for other calls.
    """
    own = category(F.col("tool_name"))
    is_search = F.lower("tool_name").isin(searches or SEARCHES) | (own == "RAG_QUERY")
    found = F.lit(-1) if reader == "native" else records.result_count(F.col("stdout"), reader)
    thought = F.nullif(tx.strip(F.col("thought")), F.lit("")) if "thought" in rows.columns else F.lit(None).cast("string")
    rows = rows.withColumns({"thought": thought, "n_results": F.when(is_search, found.cast("int")), "category": records.category(own, is_search)})
    arg = lambda *names: F.coalesce(*[F.get_json_object("args", f"$.{n}") for n in names])
    plain = F.when(~F.trim("args").startswith("{"), F.col("args"))
    full = rows.withColumns({"command": F.coalesce(arg("command", "cmd"), plain), "code": arg("code", "content"), "query": arg("query", "question")})
    return full.select(*CANONICAL)


def read_native(spark: SparkSession, path: str) -> DataFrame:
    """Events of session logs: calls of the assistant line (else of the completion), joined to their last result.

    A turn without a request has no results, whatever appears elsewhere.
    """
    native = native_lines(spark, path)
    calls = F.when(F.size("said.calls") > 0, F.col("said.calls")).otherwise(F.col("completed"))
    each = native_turns(native).select("source_file", "turn_index", "has_request", F.col("said.session_id").alias("session_id"), F.col("said.timestamp").alias("ts"), said_text(F.col("said.content")).alias("content"), F.posexplode(calls).alias("slot", "c"))
    named = each.withColumnRenamed("content", "thought").select("*", F.col("c.id").alias("call_id"), F.col("c.function.name").alias("tool_name"), F.col("c.function.arguments").alias("args"))
    joined = named.join(native_results(native_kinds(spark, path)), ["source_file", "call_id"], "left").withColumn("content", F.when(F.col("has_request"), F.col("content")))
    return _finish(joined.withColumns(decode_result(F.col("content"))).withColumn("has_result", F.col("content").isNotNull()), "native")


def said_text(content: Column) -> Column:
    """A message's text: its string, or the texts of its parts."""
    parts = F.from_json(F.when(F.trim(content).startswith("["), content), "array<struct<type:string,text:string>>")
    return F.coalesce(F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), " "), content)


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Per file: session id, start and end, cost, target and how it ended."""
    n = native_lines(spark, path)
    users = Window.partitionBy("source_file").orderBy("line_no")
    said = n.filter("kind = 'user_message'").withColumn("nth", F.row_number().over(users)).filter("nth <= 10")
    text = F.col("o.content")
    target = said.filter(text.rlike(r"(?i)https?://|\b\d{1,3}(\.\d{1,3}){3}\b|\b(target|host|url)\b") & ~text.startswith("--")).groupBy("source_file").agg(F.min_by("o.content", "line_no").alias("target"))
    rolled = n.groupBy("source_file").agg(
        F.max_by("session_id", "line_no").alias("session_id"),
        F.min("o.timestamp").alias("start_time"),
        F.max("o.timestamp").alias("end_time"),
        F.max_by(F.when(F.col("kind") == "session_end", F.col("o.cost.total_cost")), F.when(F.col("kind") == "session_end", F.col("line_no"))).alias("total_cost"),
        F.when(F.bool_or(F.col("kind") == "session_end"), "normal").otherwise("interrupted").alias("end_type"),
        F.greatest(F.max("turn_index") + 1, F.lit(0)).alias("n_turns"),
    )
    return rolled.join(target, "source_file", "left")


def read_callbacks(spark: SparkSession, path: str) -> DataFrame:
    """Callback logs: each tool end with the latest start of its run before it; turns count the ends."""
    schema = "struct<type:string,run_id:string,timestamp:string,name:string,input:string,output:string,session_id:string,tool:string,tool_input:string,log:string,run_metadata:struct<return_code:int>,response:struct<generations:array<array<struct<text:string,message:struct<content:string>>>>>>"
    rows = lines(spark, path).withColumn("o", F.from_json("raw", schema)).select("source_file", "line_no", "o.*")
    # What a model said last counts for the next start (or, in old logs, the next result) and for no other.
    said = F.get(F.get("response.generations", F.lit(0)), F.lit(0))
    text = F.nullif(tx.strip(F.coalesce(F.nullif(said["message"]["content"], F.lit("")), said["text"])), F.lit(""))
    ended = F.when(F.col("type").isin("on_llm_end", "llm_end"), F.struct(text.alias("text")))
    rows = rows.withColumns({"ended": ended, "takes": F.coalesce(F.col("type").isin("on_tool_start", "on_agent_action", "tool_result"), F.lit(False)).cast("int"), "reset": F.coalesce(F.col("type") == "tool_result", F.lit(False)).cast("int")}).drop("response")
    # Sums up to the line before: those with the line less its own.
    ran = running(rows, {"__taken": F.col("takes"), "g": F.col("reset")}).withColumns({"__taken": F.col("__taken") - F.col("takes"), "g": F.col("g") - F.col("reset")})
    since = Window.partitionBy("source_file", "__taken").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = ran.withColumn("said", F.last("ended", ignorenulls=True).over(since)["text"]).drop("__taken", "ended", "takes", "reset")
    # A result is paired with the latest start of its run, in old logs with the latest action since the result before.
    kept = rows.filter("type IN ('on_tool_start', 'on_tool_end', 'agent_action', 'tool_result')").withColumn("old", F.col("type").isin("agent_action", "tool_result"))
    of = Window.partitionBy("source_file", "old", F.when(F.col("old"), F.col("g")).otherwise(0), F.when(~F.col("old"), F.col("run_id"))).orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    begun = F.when(F.col("type") == "on_tool_start", F.struct("name", "input", "timestamp", F.col("said").alias("thought"))).when(
        F.col("type") == "agent_action", F.struct(F.coalesce("tool", "name").alias("name"), F.coalesce("tool_input", "input").alias("input"), "timestamp", records.reasoning(F.col("log")).alias("thought"))
    )
    both = kept.withColumn("s", F.last(begun, ignorenulls=True).over(of)).filter("type IN ('on_tool_end', 'tool_result') AND s IS NOT NULL")
    both = both.withColumn("s", F.col("s").withField("thought", F.when(F.col("old"), F.coalesce("said", "s.thought")).otherwise(F.col("s.thought"))))
    order = Window.partitionBy("source_file").orderBy("line_no")
    stem = F.regexp_extract("source_file", r"([^/]+?)(?:\.[^./]*)?$", 1)
    code = F.coalesce(F.col("run_metadata.return_code"), F.regexp_extract("output", r"Command exited with code (-?\d+)", 1).try_cast("int"))
    return _finish(
        both.select(
            "source_file", F.coalesce("session_id", stem).alias("session_id"), (F.row_number().over(order) - 1).alias("turn_index"), F.lit(0).alias("slot"),
            F.col("s.timestamp").alias("ts"), F.col("s.name").alias("tool_name"), F.col("s.input").alias("args"), F.lit(True).alias("has_result"),
            code.alias("return_code"), F.lit(False).alias("timed_out"), (code == 0).alias("success"), F.coalesce("output", F.lit("")).alias("stdout"), F.lit("").alias("stderr"), F.col("s.thought").alias("thought"),
        ),
        "callbacks",
    )


def read_run_steps(spark: SparkSession, path: str) -> DataFrame:
    """Run-step files: an array, or an object with `data`, of any size; turns are the steps of a session by
    creation time, slots keep their place. A file may hold many sessions; one that can't be read or ends too early is an error."""
    call = "struct<id:string,type:string,function:struct<name:string,arguments:string,output:string>,code_interpreter:struct<input:string,outputs:string>,file_search:struct<results:array<struct<id:string,text:string>>>>"
    step = f"struct<id:string,object:string,type:string,created_at:bigint,completed_at:bigint,run_id:string,thread_id:string,step_details:struct<tool_calls:array<{call}>>>"
    steps = arrays.elements(spark, path, strict=True).select("source_file", F.col("place").alias("pos"), F.from_json(tx.parseable(F.col("value")), step).alias("s"))
    session = F.coalesce("s.thread_id", "s.run_id")
    order = Window.partitionBy("source_file", session).orderBy(F.col("s.created_at").asc_nulls_last(), "pos")
    calls = steps.withColumn("turn_index", F.row_number().over(order) - 1).select("source_file", "turn_index", "s", F.posexplode("s.step_details.tool_calls").alias("slot", "c")).filter("c.type IN ('function', 'file_search', 'code_interpreter')")
    is_function, is_search = F.col("c.type") == "function", F.col("c.type") == "file_search"
    output = F.when(is_function, F.col("c.function.output")).when(is_search, F.array_join(F.transform("c.file_search.results", lambda r: r["text"]), "\n---\n")).otherwise(F.col("c.code_interpreter.outputs"))
    rows = calls.select(
        "source_file", session.alias("session_id"), "turn_index", "slot", F.date_format(F.timestamp_seconds("s.created_at"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"),
        F.when(is_function, F.col("c.function.name")).when(is_search, "search_knowledge").otherwise("execute_code").alias("tool_name"),
        F.coalesce("c.function.arguments", F.to_json(F.struct(F.col("c.code_interpreter.input").alias("code"))), F.lit("{}")).alias("args"), output.alias("content"),
    )
    return _finish(rows.withColumns(decode_result(F.col("content"))).withColumn("has_result", F.col("content").isNotNull()), "run_steps")


FIELD_MAP = {
    "session_id": ["session_id", "session", "conversation_id", "meta.session_id"], "turn_index": ["turn_index", "turn", "step"], "ts": ["timestamp", "ts", "time", "created_at"],
    "tool_name": ["tool_name", "tool", "name", "action.tool"], "args": ["tool_args", "args", "arguments", "input", "action.input"], "stdout": ["stdout", "output", "result", "response.output"],
    "stderr": ["stderr", "error"], "return_code": ["return_code", "exit_code", "rc"], "success": ["success", "ok"], "timed_out": ["timed_out", "timeout"],
    "thought": ["reasoning", "thought", "observation_prefix", "log", "thinking"],
}


def read_generic(spark: SparkSession, path: str, fields: dict[str, list[str]] | None = None, unnamed: bool = False) -> DataFrame:
    """Any JSONL: each logical field is the first of its candidate paths that is there; custom paths go first.

    Lines that name no tool are no calls, unless unnamed.
    """
    rows = lines(spark, path)
    paths = {k: [*(fields or {}).get(k, []), *v] for k, v in FIELD_MAP.items()}
    get = {k: F.coalesce(*[F.get_json_object("raw", f"$.{p}") for p in v]) for k, v in paths.items()}
    found = running(rows.select("source_file", "line_no", *[c.alias(k) for k, c in get.items()]).filter("true" if unnamed else "tool_name <> ''"), {"nth": F.lit(1)})
    stem = F.regexp_extract("source_file", r"([^/]+?)(?:\.[^./]*)?$", 1)
    code = F.col("return_code").try_cast("int")
    truth = F.lower("success").isin("true", "1", "yes", "ok")
    return _finish(
        found.select(
            "source_file", F.coalesce("session_id", stem).alias("session_id"), F.coalesce(F.col("turn_index").try_cast("int"), (F.col("nth") - 1).cast("int")).alias("turn_index"), F.lit(0).alias("slot"),
            "ts", "tool_name", F.coalesce("args", F.lit("{}")).alias("args"), F.lit(True).alias("has_result"), code.alias("return_code"), F.coalesce(F.lower("timed_out") == "true", F.lit(False)).alias("timed_out"),
            "thought", F.coalesce(truth, code == 0).alias("success"), F.coalesce("stdout", F.lit("")).alias("stdout"), F.coalesce("stderr", F.lit("")).alias("stderr"),
        )
    )


READERS: dict[str, Callable[..., DataFrame]] = {"native": read_native, "callbacks": read_callbacks, "run_steps": read_run_steps, "generic": read_generic}


def register(name: str, reader: Callable[..., DataFrame]) -> None:
    """Add or replace a dialect."""
    READERS[name] = reader


def registered() -> list[str]:
    """Names of the dialects, in the order they were added."""
    return list(READERS)


def unregister(name: str | None = None) -> None:
    """Take away a dialect, or all of them."""
    READERS.clear() if name is None else READERS.pop(name, None)


#: Lines and characters at the beginning of a file by which its dialect is told.
HEAD_LINES, HEAD_CHARS = 40, 131072


def _heads(spark: SparkSession, path: str | list[str], skip: bool = False) -> DataFrame:
    """source_file, dialect, objects, tools: whether the first lines hold an object, and one that names a tool. Empty files have no row."""
    order = Window.partitionBy("source_file").orderBy("line_no")
    head = _text(spark, path, skip).filter("line_no.block = 0").withColumn("n", F.row_number().over(order)).filter(F.col("n") <= HEAD_LINES)
    line, first = F.col("value"), order.rowsBetween(Window.unboundedPreceding, 0)
    # Of the first ten lines the first that is a session start or no object decides: an early broken line rejects.
    is_object = tx.is_object(line)
    tell = F.when(~is_object, -1).when(F.get_json_object(line, "$.event") == "session_start", 1)
    call = F.get_json_object(line, "$.type").isin(CALLBACK_KINDS) & (F.sum((F.trim(line) != "").cast("int")).over(first) <= 15)
    names = is_object & (F.coalesce(*[F.get_json_object(line, f"$.{p}") for p in FIELD_MAP["tool_name"]], F.lit("")) != "")
    told = head.select("source_file", "n", tell.alias("tell"), F.coalesce(call, F.lit(False)).alias("call"), is_object.alias("is_object"), names.alias("names"), F.substring(line, 1, HEAD_CHARS).alias("part"))
    per = told.groupBy("source_file").agg(
        F.min_by("tell", F.when((F.col("n") <= 10) & F.col("tell").isNotNull(), F.col("n"))).alias("tell"), F.bool_or("call").alias("calls"), F.array_sort(F.collect_list(F.struct("n", "part"))).alias("parts"),
        F.bool_or("is_object").alias("objects"), F.bool_or("names").alias("tools"),
    )
    chunk = F.substring(F.array_join(F.transform("parts", lambda p: p["part"]), "\n"), 1, HEAD_CHARS)
    weak = chunk.contains("thread.run.step") & chunk.contains('"step_details"') & F.try_parse_json(chunk).isNull()  # a cut-off file
    steps = chunk.rlike(r'"object"\s*:\s*"thread\.run\.step') | weak
    dialect = F.when(F.coalesce(F.col("tell") == 1, F.lit(False)), "native").when(F.col("calls"), "callbacks").when(steps, "run_steps").otherwise("generic")
    return per.select("source_file", dialect.alias("dialect"), "objects", "tools")


def sniff(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """source_file, dialect: the first of native, callbacks, run_steps that fits, else generic. Empty files have no row."""
    return _heads(spark, path).select("source_file", "dialect")


def _path(name: str) -> str:
    """The path that reads just the file of this source_file: names are given as URIs, and Spark takes paths for patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(name))


def survey(spark: SparkSession, path: str | list[str], **options: dict) -> DataFrame:
    """source_file, dialect, status of every file, with the options of read().

    OK; EMPTY (blanks at most); UNREADABLE (also a compressed file of nothing); TRUNCATED (a run-step file that ends too
    early); NO LOG: nothing in it is what its reader takes. So a log that is told wrong shows, as one whose first line is broken.
    """
    uri = F.regexp_replace("source_file", "^file:/+", "file:///").alias("source_file")
    takes = "objects" if options.get("generic", {}).get("unnamed") else "tools"
    plain = F.when(F.col("dialect") == "generic", F.col(takes)).otherwise(F.col("dialect") != "run_steps")
    heads = materialise(_heads(spark, path, skip=True).select(uri, "dialect", plain.alias("plain")), "heads")
    doubtful: dict[str, list[str]] = {"generic": [], "run_steps": []}
    for row in heads.filter("NOT plain").toLocalIterator():  # their first lines don't show it: the files are read
        doubtful[row["dialect"]].append(_path(row["source_file"]))
    found = heads.filter("plain").select("source_file", F.lit("OK").alias("status"))
    if steps := doubtful["run_steps"]:
        nothing = (F.col("status") == "OK") & (F.col("n_elements") == F.col("n_bad"))
        found = found.union(arrays.report(spark, steps).select(uri, F.when(nothing, "NO LOG").otherwise(F.col("status"))))
    if files := doubtful["generic"]:
        held = READERS["generic"](spark, files, **options.get("generic", {}))
        said = _text(spark, files).groupBy(uri).agg(F.bool_or(F.trim("value") != "").alias("any"))
        each = said.join(held.select(uri, F.lit(True).alias("held")).distinct(), "source_file", "left")
        found = found.union(each.select("source_file", F.when(F.col("held"), "OK").when(F.col("any"), "NO LOG").otherwise("EMPTY")))
    every = spark.createDataFrame([(f,) for f in spark.read.text(path).inputFiles()], "source_file string").select(uri)
    for side in (arrays.listed(spark, path).select(uri, "length"), heads.select("source_file", "dialect"), found):  # Spark reads no file without bytes
        every = every.join(side, "source_file", "left")
    return every.select("source_file", "dialect", F.coalesce("status", F.when(F.col("length").isNull(), "EMPTY").otherwise("UNREADABLE")).alias("status"))


def read(spark: SparkSession, path: str | list[str], skip_failed: bool = False, **options: dict) -> DataFrame:
    """Events of a folder of mixed logs, and their dialect: each file by the reader of its own.

    A file that survey() finds neither OK nor EMPTY is an error, unless skip_failed. options: arguments of a dialect's
    reader, by its name. File names, not contents, reach the driver.
    """
    by: dict[str, list[str]] = {}
    failed = []
    for row in survey(spark, path, **options).filter("status <> 'EMPTY'").toLocalIterator():
        if row["status"] == "OK":
            by.setdefault(row["dialect"], []).append(_path(row["source_file"]))
        else:
            failed.append(f"{row['source_file']} ({row['status']})")
    if failed and not skip_failed:
        raise ValueError(f"{len(failed)} files can't be read as logs: {', '.join(sorted(failed)[:20])}")
    out = None
    for dialect, files in sorted(by.items()):
        events = READERS[dialect](spark, files, **options.get(dialect, {})).withColumn("dialect", F.lit(dialect))
        out = events if out is None else out.unionByName(events)
    if out is None:
        raise ValueError(f"no log files below {path}")
    return out
