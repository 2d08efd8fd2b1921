"""What the training-data operators share: table access, columns of any name; cut points and size checks as elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kenning.plans.store import checked_broadcast, drop_cut, materialise, new_path, release, shared_dir

__all__ = ["checked_broadcast", "columns", "dealt", "drop_cut", "materialise", "new_path", "or_empty", "plain", "release", "shared_dir", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame, *names: str) -> tuple:
    """df under the column names c0, c1, ... and the new names of `names` (None for one that df lacks).

    Extra columns may then have any names, dotted or clashing; toDF(*df.columns) gives them back.
    """
    old = df.columns
    found = [old.index(n) if n in old else next((i for i, o in enumerate(old) if o.lower() == n.lower()), None) for n in names]
    return df.toDF(*[f"c{i}" for i in range(len(old))]), *[None if i is None else f"c{i}" for i in found]


def columns(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns of df, under new names: columns(df, doc_id="id", text="body")."""
    safe, *found = plain(df, *names.values())
    if None in found:
        raise ValueError(f"no column {list(names.values())[found.index(None)]!r}")
    return safe.select(*[F.col(c).alias(n) for n, c in zip(names, found, strict=True)])


def or_empty(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def dealt(names: DataFrame, a_task: int = 4) -> DataFrame:
    """A written list of file names over tasks of a few files each, at least two a core as far as there are files.

    The rows are small and what they stand for is not, so the count is stated and adaptive execution doesn't merge tasks.
    """
    n = names.count()
    cores = names.sparkSession.sparkContext.defaultParallelism
    return names.repartition(max(1, min(n, max(2 * cores, -(-n // a_task)))))
