"""Queries through Structured Streaming: the fixture is written in parts, replayed as a stream and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kenning.plans.event_queries import EVENTS
from kenning.plans.registry import query
from kenning.plans.store import drop_cut, materialise, new_path
from kenning.plans.views import events, table
from kenning.streaming import state, windows


def _replayed(rows: DataFrame, part: Column, parts: int, operator, **options) -> DataFrame:
    """What the operator makes of a stream that gets the rows part by part, each in one micro-batch.

    The rows are made once, and parts written by as many tasks as they take; the stream stops and goes on with the next.
    """
    spark = rows.sparkSession
    source, out, progress = (new_path(spark, what) for what in ("stream", "streamed", "progress"))
    marked = materialise(rows.withColumn("__part", part))
    for i in range(parts):
        marked.filter(F.col("__part") == i).drop("__part").write.mode("append").parquet(source)
        stream = operator(windows.read(spark, source, rows.schema, files=None), **options)
        windows.drain(stream, out, progress)
    drop_cut(marked)
    return spark.read.schema(stream.schema).parquet(out)


@query(EVENTS + """SELECT e.event_id, max(q.turn_index) AS query_turn, arg_max(q.event_id, q.turn_index) AS query_id FROM va e JOIN va q ON q.session_id = e.session_id AND q.category = 'RAG_QUERY' AND q.turn_index BETWEEN e.turn_index - 3 AND e.turn_index - 1 GROUP BY e.event_id""")
def stream_lookback3(spark, sf_dir) -> DataFrame:
    """Calls that come in three parts of their sessions, each with its nearest search of three turns."""
    rows = events(spark, sf_dir).select("session_id", F.col("event_id").cast("long"), F.col("turn_index").cast("long"), (F.col("category") == "RAG_QUERY").alias("is_search"))
    found = _replayed(rows, F.least(F.floor(F.col("turn_index") / 4), F.lit(2)), 3, state.lookback)
    return found.filter("query_id IS NOT NULL").select("event_id", "query_turn", "query_id")


@query("""WITH RECURSIVE r AS (SELECT DISTINCT event_type AS feed, CAST(day(ts) // 3 * 30 AS BIGINT) AS fetched, 'u' || user_id AS entry_id, CAST(day(ts) // 3 * 30 - user_id % 45 AS BIGINT) AS published FROM events),
g AS (SELECT feed, fetched, dense_rank() OVER (PARTITION BY feed ORDER BY fetched) AS step, list({'id': entry_id, 'at': published} ORDER BY published DESC, entry_id) AS all_ids FROM r GROUP BY feed, fetched),
s AS (SELECT DISTINCT feed, CAST(0 AS BIGINT) AS step, CAST([] AS VARCHAR[]) AS ids, CAST(NULL AS BIGINT) AS last, CAST([] AS VARCHAR[]) AS taken, CAST(0 AS BIGINT) AS fetched FROM g
  UNION ALL SELECT feed, step, list_concat(ids, new)[-40:], CASE WHEN len(new) > 0 THEN fetched ELSE last END, new, fetched FROM (
    SELECT s.feed, g.step, s.ids, s.last, g.fetched, list_transform(list_filter(g.all_ids, lambda x: NOT list_contains(s.ids, x.id) AND (s.last IS NULL OR x.at > s.last)), lambda x: x.id)[1:30] AS new
    FROM s JOIN g ON g.feed = s.feed AND g.step = s.step + 1))
SELECT feed, fetched, unnest(taken) AS entry_id FROM s WHERE step > 0""")
def stream_new_entries(spark, sf_dir) -> DataFrame:
    """Users as entries of feeds that are fetched every three days: 30 at most a fetch, 40 remembered, none from before the last fetch."""
    fetched, user = (F.floor(F.dayofmonth("ts") / 3) * 30).cast("long"), F.col("user_id").cast("long")
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("feed"), fetched.alias("fetched"), F.concat(F.lit("u"), user.cast("string")).alias("entry_id"), (fetched - user % 45).alias("published")).distinct()
    found = _replayed(rows, F.floor(F.col("fetched") / 120), 3, state.new_entries, most_ids=40, most_entries=30)
    return found.select("feed", "fetched", "entry_id")
