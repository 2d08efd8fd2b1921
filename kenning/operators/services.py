"""Which service a row is about: given name, CVE hints, URL port, aliases in the text, in this order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kenning.functions.text import service_name
from kenning.plans.store import small

# Default ports.
PORTS = {"21": "ftp", "22": "ssh", "445": "samba", "3306": "mysql", "5432": "postgresql", "6379": "redis", "7001": "weblogic", "8080": "tomcat", "8983": "solr", "9200": "elasticsearch"}


def by_port(url: Column) -> Column:
    """Service of a URL's port; null if it has none that tells."""
    port = F.regexp_extract(url, r"^[a-z]+://[^/:]+:(\d+)", 1)
    out = F
    for number, name in PORTS.items():
        out = out.when(port == number, name)
    return out


def normalise_aliases(aliases: DataFrame) -> DataFrame:
    """alias (lower case, distinct), service: rows with a null on either side are skipped."""
    return aliases.select(F.lower(F.trim("alias")).alias("alias"), "service").filter("alias <> '' AND service IS NOT NULL").dropDuplicates(["alias"])


def by_text(rows: DataFrame, aliases: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """id, service, score: per row the service whose aliases in the text are longest together.

    The alias list is small and checked; each row is tested against it by words, joined by equality: aliases of several
    words are found through their first word.
    """
    named = normalise_aliases(aliases).withColumn("head", F.regexp_extract("alias", r"^([\p{L}\p{N}_]+)", 1))
    words = rows.select(F.col(id_col).alias("id"), F.lower(F.col(text_col)).alias("t")).withColumn("head", F.explode(F.array_distinct(F.split("t", r"[^\p{L}\p{N}_]+"))))
    hits = words.join(small(named), "head").filter(F.concat(F.lit(" "), F.regexp_replace("t", r"[^\p{L}\p{N}_.]+", " "), F.lit(" ")).contains(F.concat(F.lit(" "), F.col("alias"), F.lit(" "))))
    scores = hits.groupBy("id", "service").agg(F.sum(F.greatest(F.lit(1), F.length("alias"))).alias("score"))
    best = scores.groupBy("id").agg(F.max(F.struct("score", "service")).alias("b"))
    return best.select("id", F.col("b.service").alias("service"), F.col("b.score").alias("score"))


def by_cves(rows: DataFrame, hints: DataFrame, id_col: str = "id") -> DataFrame:
    """id, service: that of the first CVE (in order) with a hint."""
    each = rows.select(F.col(id_col).alias("id"), F.posexplode("cves").alias("pos", "cve")).join(small(hints.select("cve", "service")), "cve")
    return each.groupBy("id").agg(F.min_by("service", "pos").alias("service"))


def resolve(rows: DataFrame, hints: DataFrame, aliases: DataFrame) -> DataFrame:
    """rows (id, service, url, text, cves) with resolved: the first source that gives a name, else empty."""
    a = by_cves(rows, hints).withColumnRenamed("service", "__cve")
    b = by_text(rows, aliases).select("id", F.col("service").alias("__text"))
    joined = rows.join(a, "id", "left").join(b, "id", "left")
    return joined.withColumn("resolved", F.coalesce(F.nullif(service_name(F.col("service")), F.lit("")), "__cve", by_port(F.col("url")), "__text", F.lit(""))).drop("__cve", "__text")
