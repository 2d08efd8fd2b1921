"""File catalogue, articles, and partitioned sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def catalogue(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """path, source (first folder below the root), bytes, modified and, if asked, sha256 of every file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    root = path.rstrip("/").split("/")[-1]
    source = F.regexp_extract("path", rf"/{root}/([^/]+)/", 1)
    columns = ["path", source.alias("source"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")]
    return files.select(*columns, *([F.sha2("content", 256).alias("sha256")] if digest else []))


def source_stats(files: DataFrame) -> DataFrame:
    return files.groupBy("source").agg(F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("bytes"), F.max("modified").alias("newest"))


def same_groups(a: DataFrame, b: DataFrame) -> DataFrame:
    """Names whose contents differ or that only one side has (name, sha256 on both)."""
    joined = a.select("name", F.col("sha256").alias("sa")).join(b.select("name", F.col("sha256").alias("sb")), "name", "full")
    return joined.filter(~F.col("sa").eqNullSafe(F.col("sb")))


def articles(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object a file, newest file first."""
    rows = spark.read.json(path, multiLine=True)
    return rows.withColumn("modified", F.col("_metadata.file_modification_time")).orderBy(F.desc("modified"))


def write_sessions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet by session; overwriting replaces only the sessions that df holds."""
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("session_id").parquet(path)


def write_csv(df: DataFrame, path: str, mark: bool = False) -> None:
    """CSV with a header in every file; mark: the header starts with a byte order mark, which spreadsheets ask for."""
    marked = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0]) if mark else df
    marked.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str, key: str) -> None:
    """A JSON file for each value of key, in a folder of its own, each row an object on one line."""
    df.repartition(key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).json(path)
