"""Turn algebra: numbering, look-back and last-wins over ordered rows, as window functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number(rows: DataFrame, group: str, order: list[str], opens: Column) -> DataFrame:
    """rows with turn_index: how many rows up to here open a turn, less one (-1 before the first)."""
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("turn_index", F.sum(opens.cast("int")).over(w) - 1)


def lookback(events: DataFrame, turns: int | None, is_query: Column | None = None) -> DataFrame:
    """events with query_turn and query_id: the last retrieval query of the latest of the `turns` turns before.

    turns None looks back to the start of the session. A range frame over the turn index, so one sort per session.
    """
    own = F.col("category") == "RAG_QUERY" if is_query is None else is_query
    start = Window.unboundedPreceding if turns is None else -turns
    w = Window.partitionBy("session_id").orderBy("turn_index").rangeBetween(start, -1)
    found = F.max(F.when(own, F.struct("turn_index", "event_id"))).over(w)
    return events.withColumn("__q", found).withColumns({"query_turn": F.col("__q.turn_index"), "query_id": F.col("__q.event_id")}).drop("__q")


def last_wins(rows: DataFrame, keys: list[str], order: list[str], keep: list[str]) -> DataFrame:
    """Per key the kept columns of the row that comes last; an aggregate, so it combines before the shuffle."""
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*keep), F.struct(*order)).alias("__last"))
    return best.select(*keys, *[F.col(f"__last.{c}").alias(c) for c in keep])


def script_links(events: DataFrame) -> DataFrame:
    """session_id, event_id, write_id: commands that name a file written in the session before or in the same turn.

    Commands are split into words and joined by the file's base name, so a session's pairs are never enumerated; of
    several writes of the file the latest counts.
    """
    base = lambda c: F.element_at(F.split(c, "/"), -1)
    writes = events.filter("category = 'CODE_WRITE' AND filename <> ''").select("session_id", base(F.col("filename")).alias("file"), F.col("turn_index").alias("wt"), F.col("event_id").alias("write_id"))
    words = F.array_distinct(F.transform(F.split("command", r"[\s;|&<>()'\"]+"), base))
    runs = events.filter("command <> ''").select("session_id", "event_id", "turn_index", F.explode(words).alias("file"))
    pairs = runs.join(writes, ["session_id", "file"]).filter("wt <= turn_index AND write_id <> event_id")
    return pairs.groupBy("session_id", "event_id").agg(F.max_by("write_id", F.struct("wt", "write_id")).alias("write_id"))
