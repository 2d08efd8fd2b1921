"""Cost, time and closing words of runs, from the lines of their logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kenning.functions import text as tx

LINE = "event string, object string, created double, timestamp_iso string, cost struct<total_cost:double,interaction_cost:double>, choices array<struct<message:struct<content:string>>>"


def log_costs(lines: DataFrame) -> DataFrame:
    """source_file, completions, seconds, total_cost, final_text, from lines (source_file, line_no, raw JSON).

    Seconds: the span of `created` of completions, else of their ISO times; null with fewer than two. Cost: that of the
    last closing line, else the greatest total of completions, else (or if that is zero) the sum of their single costs.
    """
    line = lines.select("source_file", "line_no", F.from_json("raw", LINE).alias("o"))
    done = F.col("o.object") == "chat.completion"
    closing = F.lower("o.event").isin("session_end", "session_summary") & F.col("o.cost.total_cost").isNotNull()
    created, iso = F.when(done, F.col("o.created")), F.when(done, F.unix_micros(tx.timestamp(F.col("o.timestamp_iso"))) / 1e6)
    said = F.when(done, F.element_at("o.choices", -1)["message"]["content"])
    said = F.when(F.trim(said) != "", said)
    span = lambda v: F.when(F.count(v) >= 2, F.max(v) - F.min(v))
    per = line.groupBy("source_file").agg(
        F.count(F.when(done, 1)).alias("completions"),
        F.coalesce(span(created), span(iso)).alias("seconds"),
        F.max_by(F.when(closing, F.col("o.cost.total_cost")), F.when(closing, F.col("line_no"))).alias("closed"),
        F.max(F.when(done, F.col("o.cost.total_cost"))).alias("top"),
        F.coalesce(F.sum(F.when(done, F.col("o.cost.interaction_cost"))), F.lit(0.0)).alias("single"),
        F.max_by(said, F.when(said.isNotNull(), F.col("line_no"))).alias("final_text"),
    )
    top = F.when((F.col("top") == 0) & (F.col("single") > 0), F.col("single")).otherwise(F.coalesce("top", "single"))
    return per.select("source_file", "completions", "seconds", F.coalesce("closed", top).alias("total_cost"), F.coalesce("final_text", F.lit("")).alias("final_text"))
