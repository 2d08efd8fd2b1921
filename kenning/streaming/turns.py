"""Turns from a stream of log lines: state per file, closed turns are emitted once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "source_file string, turn_index int, n_lines int, has_request boolean, closed_by string"
STATE = "turn_index int, n_lines int, has_request boolean, is_open boolean"


def build(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Lines (line_no, kind) of one file, in order of line_no within and across micro-batches."""
    turn, n, asked, is_open = state.get if state.exists else (-1, 0, False, False)
    if state.hasTimedOut:
        state.remove()
        if is_open:
            yield pd.DataFrame([(key[0], turn, n, asked, "timeout")], columns=[x.split()[0] for x in OUTPUT.split(", ")])
        return
    done = []
    for row in pd.concat(list(batches)).sort_values("line_no").itertuples():
        if row.kind == "assistant_message":
            if is_open:
                done.append((key[0], turn, n, asked, "next"))
            turn, n, asked, is_open = turn + 1, 1, False, True
        elif is_open:
            n += 1
            asked = asked or row.kind == "api_request"
            if row.kind in ("completion", "session_end"):
                done.append((key[0], turn, n, asked, row.kind))
                is_open = False
    state.update((turn, n, asked, is_open))
    yield pd.DataFrame(done, columns=[x.split()[0] for x in OUTPUT.split(", ")])


def stream_turns(lines: DataFrame, quiet_ms: int = 0) -> DataFrame:
    """Closed turns of a stream with source_file, line_no, kind.

    With quiet_ms a file that stays silent that long closes its open turn and its state goes: what a stream without end
    asks for. Such a query never runs out of batches, so it doesn't go with a trigger that ends when the input does;
    without quiet_ms state stays as long as the query, a few numbers a file.
    """

    def timed(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        yield from build(key, batches, state)
        if quiet_ms and state.exists:
            state.setTimeoutDuration(quiet_ms)

    timeout = GroupStateTimeout.ProcessingTimeTimeout if quiet_ms else GroupStateTimeout.NoTimeout
    return lines.groupBy("source_file").applyInPandasWithState(timed, OUTPUT, STATE, "append", timeout)


def batch_turns(lines: DataFrame) -> DataFrame:
    """The same turns of a finished table, by window functions; a turn that is open at the end is closed by `timeout`."""
    running = Window.partitionBy("source_file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    numbered = lines.withColumn("turn_index", F.sum((F.col("kind") == "assistant_message").cast("int")).over(running) - 1).filter("turn_index >= 0")
    per = Window.partitionBy("source_file", "turn_index")
    last = F.max("turn_index").over(Window.partitionBy("source_file"))
    cut = numbered.withColumn("end", F.min(F.when(F.col("kind").isin("completion", "session_end"), F.struct("line_no", "kind"))).over(per)).withColumn("last", last)
    inside = cut.filter(F.col("end").isNull() | (F.col("line_no") <= F.col("end.line_no")))
    return inside.groupBy("source_file", "turn_index").agg(
        F.count(F.lit(1)).cast("int").alias("n_lines"), F.bool_or(F.col("kind") == "api_request").alias("has_request"),
        F.coalesce(F.first("end.kind"), F.when(F.col("turn_index") == F.first("last"), "timeout").otherwise("next")).alias("closed_by"),
    )
