"""Written cut points in the folder that driver and executors share, and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most bytes (estimated from the values) of a table that may be broadcast; beyond it the join shuffles.
BROADCAST_BYTES = 32 << 20
#: Cut points written and not yet released, by application.
_written: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; in a local session without one (tests) a new local folder, kept for the session's life."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = spark.conf.get("kenning.local.dir", None) or "file://" + tempfile.mkdtemp(prefix="kenning-")
        spark.conf.set("kenning.local.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    """A fresh path in the shared folder, deleted by release()."""
    path = f"{shared_dir(spark)}/kenning/{what}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialise(df: DataFrame, what: str = "cut") -> DataFrame:
    """df written to the shared folder and read back: lineage is cut, and a lost executor costs a task, not the plan."""
    spark = df.sparkSession
    path = new_path(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a path of any file system that Spark knows."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def drop_cut(df: DataFrame) -> None:
    """Delete the files of a frame that materialise() gave, when nothing will read it again."""
    spark = df.sparkSession
    mine = _written.get(spark.sparkContext.applicationId, [])
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        for path in [p for p in mine if p.rsplit("/", 1)[-1] == folder.rsplit("/", 1)[-1]]:
            mine.remove(path)
            delete(spark, path)


def release(spark: SparkSession) -> None:
    """Delete all cut points of the application: call it when the results that were read from them are written."""
    for path in _written.pop(spark.sparkContext.applicationId, []):
        delete(spark, path)


def value_bytes(kind: T.DataType, value: Column) -> Column:
    """About how many bytes a value takes in memory."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return 24 + F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, T.ArrayType):
        return 24 + F.coalesce(F.aggregate(value, F.lit(0).cast("long"), lambda n, x: n + value_bytes(kind.elementType, x)), F.lit(0))
    if isinstance(kind, T.StructType):
        return sum((value_bytes(f.dataType, value[f.name]) for f in kind.fields), F.lit(16).cast("long"))
    return F.lit(16).cast("long")


def checked_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if its values take `limit` bytes at most, else with a merge hint (the join then shuffles).

    The frame is read once more for the count: hand in what is materialised or cheap.
    """
    size = sum((value_bytes(f.dataType, F.col(f"`{f.name}`")) for f in df.schema.fields), F.lit(16).cast("long"))
    total = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if total <= limit else df.hint("merge")


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if its values take `limit` bytes at most, else as it is."""
    size = sum((value_bytes(f.dataType, F.col(f"`{f.name}`")) for f in df.schema.fields), F.lit(16).cast("long"))
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= limit else df
