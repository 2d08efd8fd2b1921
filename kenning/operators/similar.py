"""Exact top-k similarity join by Jaccard over distinct words, through a prefix index ordered by frequency.

The words of a left row are ordered by how many right rows hold them, rare ones first.

  1. A lower bound. Each left row meets the right rows of its rarest words, about SEEN of them (of a frequent word only as
     many as are still needed), and the k-th best of these scores is its threshold t: nothing below t is in its result.
  2. Candidates. A pair with a score of t or more shares at least a = ceil(t / (1 + t) * (m + n)) of its m and n words, and
     n lies between t * m and m / t. So of the first m - a + LEAST words at least min(LEAST, a) are shared, and the word in
     place i is joined only to rows of a size for which it lies in that prefix. Sizes are cut into classes, four to a
     doubling, which are a key of the join: a word that every text holds stands last and meets only the few sizes for
     which it could matter.
  3. The candidates' scores, from the whole word lists, and a rank for each left row.

The left side is handed to the tasks if its size allows it, so that the right side isn't shuffled before candidates are
counted; else the same joins shuffle. Word lists of the right side are written once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kenning.functions.text import tokens
from kenning.plans.store import materialise, small

#: Right rows that a left row meets for its lower bound, as a multiple of k; shared words asked of a candidate.
SEEN, LEAST = 20, 3
_SLACK = 1e-9


def size_class(n: Column) -> Column:
    return F.floor(F.log2(n) * 4).cast("int")


def overlap_bound(t: Column, m: Column, n: Column) -> Column:
    """Least shared words of two rows of m and n words with a score of t or more."""
    return F.greatest(F.ceil(t / (1 + t) * (m + n) - _SLACK), F.lit(1))


def scored(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """a, b, shared, score of distinct pairs (a, b); left (a, ws, na) and right (b, wb, nb) have the word lists."""
    whole = pairs.join(right, "b").join(small(left), "a").withColumn("shared", F.size(F.array_intersect("ws", "wb")).cast("long"))
    return whole.filter("shared > 0").select("a", "b", "shared", (F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))).alias("score"))


def thresholds(placed: DataFrame, left: DataFrame, right: DataFrame, top: int) -> DataFrame:
    """a, t: the top-th best score among right rows of the rarest words of a, where there are so many.

    placed: a, na, word, i (place), df.
    """
    seen = SEEN * top
    before = F.coalesce(F.sum("df").over(Window.partitionBy("a").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rare = placed.filter("df > 0").withColumn("before", before).filter(F.col("before") < seen)
    # One posting in `every` is enough of a word that holds more than are needed.
    rare = rare.select("a", "word", F.greatest(F.floor(F.col("df") / (seen - F.col("before"))), F.lit(1)).alias("every"))
    posts = right.select("b", F.explode("wb").alias("word"))
    met = posts.join(small(rare), "word").filter(F.pmod(F.xxhash64("b", "word"), F.col("every")) == 0)
    best = scored(met.select("a", "b").distinct(), left, right)
    order = Window.partitionBy("a").orderBy(F.col("score").desc(), "b")
    return best.withColumn("r", F.row_number().over(order)).filter(F.col("r") == top).select("a", F.col("score").alias("t"))


def prefix_hits(placed: DataFrame, bounds: DataFrame, right: DataFrame) -> DataFrame:
    """a, b, na, nb, t: a row for each word of a prefix and right row that it meets."""
    t, m, size = F.col("t"), F.col("na"), F.col("nb")
    far = F.when(t > 0, F.least(m / t, (m - F.col("i") + (LEAST - 1)) * (1 + t) / t - m) + 1e-6).otherwise(F.lit(2147483647.0))
    own = placed.filter("df > 0").join(small(bounds), "a", "left").withColumn("t", F.coalesce("t", F.lit(0.0)))
    own = own.withColumns({"low": F.greatest(F.ceil(t * m - _SLACK), F.lit(1)), "high": F.floor(far)}).filter("low <= high")
    own = own.select("a", "na", "t", "word", "low", "high", F.explode(F.sequence(size_class(F.col("low")), size_class(F.col("high")))).alias("class"))
    posts = right.select("b", "nb", size_class(size).alias("class"), F.explode("wb").alias("word"))
    return posts.join(small(own), ["word", "class"]).filter((size >= F.col("low")) & (size <= F.col("high"))).select("a", "b", "na", "nb", "t")


def candidates(hits: DataFrame) -> DataFrame:
    """a, b: pairs that share as many prefix words as a pair with a score of t must."""
    counted = hits.groupBy("a", "b", "na", "nb", "t").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= F.least(F.lit(LEAST), overlap_bound(F.col("t"), F.col("na"), F.col("nb")))).select("a", "b")


def spread(rows: DataFrame) -> DataFrame:
    """rows over twice as many tasks as there are cores, if they come in fewer: a small table in one file."""
    wanted = 2 * rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(wanted) if rows.rdd.getNumPartitions() < wanted else rows


def _prepared(left: DataFrame, right: DataFrame, top: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    lists = left.select(F.col("id").alias("a"), tokens(F.col("text")).alias("ws")).withColumn("na", F.size("ws")).filter("na > 0")
    texts = materialise(spread(right.select(F.col("id").alias("b"), "text")).select("b", tokens(F.col("text")).alias("wb")).withColumn("nb", F.size("wb")).filter("nb > 0"), "words")
    words = lists.select("a", "na", F.explode("ws").alias("word"))
    df = texts.select(F.explode("wb").alias("word")).join(small(words.select("word").distinct()), "word").groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    place = F.row_number().over(Window.partitionBy("a").orderBy("df", "word")) - 1
    placed = materialise(words.join(small(materialise(df, "frequencies")), "word", "left").withColumn("df", F.coalesce("df", F.lit(0))).withColumn("i", place), "placed")
    return lists, texts, placed, materialise(thresholds(placed, lists, texts, top), "thresholds")


def top_pairs(left: DataFrame, right: DataFrame, top: int) -> DataFrame:
    """a, b, shared, score, rank: per left row (id, text) the `top` right rows that share a word, by Jaccard over distinct words.

    Equal scores are ranked by b. Ids name their rows. Rows without words, or null texts, have no pairs.
    """
    lists, texts, placed, bounds = _prepared(left, right, top)
    found = scored(candidates(prefix_hits(placed, bounds, texts)), lists, texts)
    order = Window.partitionBy("a").orderBy(F.col("score").desc(), "b")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def joined_rows(left: DataFrame, right: DataFrame, top: int) -> dict[str, int]:
    """How many rows top_pairs() joins: those of the prefixes, the candidates, and those of a plain inverted index."""
    _, texts, placed, bounds = _prepared(left, right, top)
    hits = prefix_hits(placed, bounds, texts)
    return {"prefix": hits.count(), "candidates": candidates(hits).count(), "plain": int(placed.agg(F.sum("df")).first()[0] or 0)}
