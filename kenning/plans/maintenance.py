"""What runs without a user: daily maintenance of the registry, and a stream of finished sessions against it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kenning.operators import consolidate, fusion, govern, reflux, registry
from kenning.plans.batch import run_stages

#: Confidence from which a recalibrated row counts as consolidated, and as validated.
CONSOLIDATED_FROM, VALIDATED_FROM = 0.8, 0.6


def recalibrated(rows: DataFrame) -> DataFrame:
    """Rows with the confidence that their sessions support where it rises, and then the maturity that goes with it.

    Only validated and consolidated rows are looked at; a row without p_fused or n_sessions counts its confidence, once.
    """
    has = lambda name, other: F.coalesce(name, other) if name in rows.columns else other
    p, n = has("p_fused", F.coalesce("confidence", F.lit(0.0))), has("n_sessions", F.lit(1))
    new = fusion.beta_update(p, n)
    rises = F.col("maturity").isin("validated", "consolidated") & (new > p)
    grade = F.when(new >= CONSOLIDATED_FROM, "consolidated").when(new >= VALIDATED_FROM, "validated").otherwise("raw")
    changed = {"maturity": F.when(rises, grade).otherwise(F.col("maturity")), "confidence": F.when(rises, new).otherwise(F.col("confidence"))}
    if "p_fused" in rows.columns:
        changed["p_fused"] = F.when(rises, new).otherwise(F.col("p_fused"))
    return rows.withColumns(changed)


def daily(spark: SparkSession, rows: DataFrame, queue: DataFrame, now: Column, limit: int = 10, sink: Callable[[DataFrame], None] | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Suspend what has faded, fuse what is pending and put it in, raise confidences, send what is ready, free stale gaps
    and take the next daily ones.

    Tables by stage (`registry_after` and `queue_after` are the results), and the state of the stages; after a failure
    the rest is skipped.
    """
    wide = consolidate.widened(rows)
    stages = [
        ("suspended", lambda t: fusion.suspend(wide).withColumn("lifecycle", F.col("lifecycle_after")).select(*wide.columns)),
        ("members", lambda t: fusion.weigh(fusion.clusters(consolidate.pending(t["suspended"])))),
        ("consolidated", lambda t: consolidate.merged(t["members"])[0]),
        ("fused", lambda t: consolidate.fold_in(t["suspended"], t["consolidated"], t["members"])),
        ("recalibrated", lambda t: recalibrated(t["fused"])),
        ("documents", lambda t: reflux.flush(t["recalibrated"], sink)[0]),
        ("registry_after", lambda t: reflux.marked(t["recalibrated"], t["documents"])),
        ("queue_after", lambda t: govern.dequeue(govern.reset_stale(t["queue"], now), "P1", limit)),
    ]
    return run_stages(spark, stages, {"registry": rows, "queue": queue})


def daily_at(spark: SparkSession, registry_path: str, queue_path: str, now: Column, limit: int = 10, sink: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """daily() over the newest versions of both tables, and its results committed; the state of the stages.

    A registry that another writer has changed meanwhile is maintained anew; sink then gets the documents again, under
    the same ids. A failed stage commits nothing and is raised.
    """
    told: dict[str, DataFrame] = {}

    def change(rows: DataFrame) -> DataFrame:
        tables, state = daily(spark, rows, registry.current(spark, queue_path), now, limit, sink)
        failed = state.filter("status = 'failed'").first()
        if failed:
            raise RuntimeError(f"{failed['stage']}: {failed['message']}")
        told["state"] = state
        return tables["registry_after"]

    registry.update(spark, registry_path, change)
    registry.update(spark, queue_path, lambda q: govern.dequeue(govern.reset_stale(q, now), "P1", limit))
    return told["state"]


def on_sessions(finished: DataFrame, registry_path: str, checkpoint: str, conflicts_path: str) -> StreamingQuery:
    """Start a stream that puts each batch of finished sessions' rows through reflux.on_session against the registry's
    newest version. The new version is whole before it counts, and is made anew if another writer commits first; a batch
    that is repeated finds its rows there already."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not batch.limit(1).count():
            return

        def change(rows: DataFrame) -> DataFrame:
            after, pairs = reflux.on_session(rows, batch)
            pairs.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{conflicts_path}/batch={batch_id}")
            return after

        registry.update(spark, registry_path, change)

    return finished.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
