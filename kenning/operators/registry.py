"""A table in versions: rewrites and appends with an optimistic commit, and merges by key.

Below the table's path, `data` holds a folder of Parquet files for each write and `versions` a small file for each
version, named by its number, that says which folders it has: one after a rewrite, one more after each append. A writer writes its folder first and then claims the next
number by creating that file, which a store allows once. So a version follows the one it was made from or isn't made:
of two writers the second finds the number taken, reads the first one's rows and applies its change to them. A write that
fails leaves a folder that nothing names. An empty version file is a claim in progress: readers wait for it.

The store must create files exclusively (HDFS does, a local file system practically).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kenning.plans.store import delete

#: Seconds that a reader waits for a claimed version to be named.
WAIT = 30.0


class Conflict(RuntimeError):
    """Another writer made the version that this one was to be."""


def _store(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions, in order."""
    store, where = _store(spark, f"{path}/versions")
    return sorted(int(f.getPath().getName()) for f in store.listStatus(where) if f.getPath().getName().isdigit()) if store.exists(where) else []


def _named(spark: SparkSession, path: str, version: int) -> dict:
    """What the file of a version says."""
    store, where = _store(spark, f"{path}/versions/{version:012d}")
    until = time.monotonic() + WAIT
    while not (size := store.getFileStatus(where).getLen()):
        if time.monotonic() > until:
            raise RuntimeError(f"version {version} of {path} was claimed and never named: delete its file")
        time.sleep(0.2)
    stream = store.open(where)
    try:
        return json.loads(bytes(stream.readNBytes(size)))
    finally:
        stream.close()


def read(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, DataFrame]:
    """A version (the newest, if not told) and its rows."""
    if version is None:
        known = versions(spark, path)
        if not known:
            raise ValueError(f"no version below {path}")
        version = known[-1]
    return version, spark.read.parquet(*[f"{path}/data/{f}" for f in _named(spark, path, version)["folders"]])


def current(spark: SparkSession, path: str) -> DataFrame:
    return read(spark, path)[1]


def commit(df: DataFrame, path: str, parent: int, append: bool = False) -> int:
    """Write df as the version after `parent` (0: the first), or with append the rows of parent and df; its number.
    Conflict if that version is there already."""
    spark, folder = df.sparkSession, uuid.uuid4().hex
    before = _named(spark, path, parent)["folders"] if append and parent else []
    df.write.parquet(f"{path}/data/{folder}")
    store, where = _store(spark, f"{path}/versions/{parent + 1:012d}")
    known = versions(spark, path)
    try:
        if known and known[-1] != parent:
            raise Conflict(f"{path} is at version {known[-1]}, not {parent}")
        try:
            out = store.create(where, False)
        except Exception as error:  # the store's own kind of "exists already"
            if store.exists(where):
                raise Conflict(f"version {parent + 1} of {path} is taken") from error
            raise
    except Conflict:
        delete(spark, f"{path}/data/{folder}")
        raise
    out.write(bytearray(json.dumps({"folders": [*before, folder], "parent": parent, "at": int(time.time())}).encode()))
    out.close()
    return parent + 1


def update(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame], tries: int = 5, append: bool = False) -> int:
    """Commit change(rows of the newest version), or with append those rows and change(); made anew from the newer rows
    as long as others commit first.

    change must depend on nothing but its argument and what doesn't change.
    """
    for left in reversed(range(tries)):
        version, rows = read(spark, path)
        try:
            return commit(change(rows), path, version, append)
        except Conflict:
            if not left:
                raise
        except PySparkException:  # its version may have been removed meanwhile
            if not left or versions(spark, path)[-1] == version:
                raise
    raise ValueError("tries must be positive")


def vacuum(spark: SparkSession, path: str, keep: int = 5, unnamed_s: float = 86_400.0) -> list[int]:
    """Delete all but the last `keep` versions, and folders without a version that are older than unnamed_s seconds (a
    writer may be at work on younger ones); the numbers that are gone."""
    known = versions(spark, path)
    gone, stay = known[: -max(1, keep)], {f for v in known[-max(1, keep) :] for f in _named(spark, path, v)["folders"]}
    old = {f for v in gone for f in _named(spark, path, v)["folders"]} - stay
    for v in gone:
        delete(spark, f"{path}/versions/{v:012d}")
    store, where = _store(spark, f"{path}/data")
    for f in store.listStatus(where):
        name = f.getPath().getName()
        if name in old or (name not in stay and f.getModificationTime() / 1000 < time.time() - unnamed_s):
            delete(spark, f"{path}/data/{name}")
    return gone


def merge(rows: DataFrame, changes: DataFrame, key: str = "exp_id") -> DataFrame:
    """rows after changes (key, `op` and any of the columns): 'delete' removes, 'insert' adds if the key is new, 'update'
    sets the non-null fields where the key is known, 'upsert' does whichever fits. One change a key."""
    fields = [c for c in rows.columns if c in changes.columns and c != key]
    d = changes.select(F.col(key), F.col("op").alias("__op"), *[F.col(c).alias(f"__{c}") for c in fields])
    both = rows.withColumn("__known", F.lit(True)).join(d, key, "full")
    known, op = F.coalesce("__known", F.lit(False)), F.coalesce("__op", F.lit("keep"))
    sets = ~known | op.isin("update", "upsert")
    stays = F.when(known, op != "delete").otherwise(op.isin("insert", "upsert"))
    return both.filter(stays).select(*[F.when(sets, F.coalesce(f"__{c}", c)).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in rows.columns])
