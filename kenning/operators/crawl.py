"""What comes back from crawling: choosing files and queries, cutting pages, names out of answers, state by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kenning.operators import govern

# Folders without code of interest, the code that is, and set-up files.
SKIPPED = [".git/", "vendor/", "node_modules/", "test/", "docs/", "images/"]
LANGUAGES = ["py", "sh", "go", "rb", "pl", "js", "ts", "java", "c", "cpp", "rs", "php", "lua", "yaml", "yml"]
SETUP = ["requirements.txt", "go.mod", "pom.xml", "package.json", "Dockerfile"]
BLANK_ANSWERS = ["", "无", "N/A", "-", "*"]


def core_files(files: DataFrame, repo: str = "repo", top: int = 8, most_bytes: int = 102_400) -> DataFrame:
    """The `top` files (path, size) of each repository: those at its root first (+10), then set-up files (+5)."""
    path, name = F.col("path"), F.substring_index("path", "/", -1)
    setup = name.isin(SETUP)
    wanted = setup | F.lower(F.regexp_extract(name, r"\.([A-Za-z]+)$", 1)).isin(LANGUAGES)
    skipped = F.lit(False)
    for part in SKIPPED:
        skipped = skipped | path.contains(part)
    kept = files.filter(wanted & ~skipped & (F.coalesce("size", F.lit(0)) <= most_bytes))
    scored = kept.withColumn("priority", F.when(path.contains("/"), 0).otherwise(10) + F.when(setup, 5).otherwise(0))
    place = F.row_number().over(Window.partitionBy(repo).orderBy(F.desc("priority"), "path"))
    return scored.withColumn("place", place).filter(F.col("place") <= top)


def split_text(text: Column, size: int = 3000) -> Column:
    """The text in pieces of at most `size` characters that join to it again, cut before the last newline of a piece if
    that lies past its half. Null and empty text: one empty piece."""
    text = F.coalesce(text, F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, _: Column) -> Column:
        piece = F.substr(text, acc["at"] + 1, F.lit(size))
        newline = F.when(piece.contains("\n"), F.length(piece) - F.length(F.substring_index(piece, "\n", -1)) - 1).otherwise(0)
        cut = F.when((F.length(text) - acc["at"] > size) & (newline > size // 2), newline).otherwise(F.length(piece))
        grown = F.struct((acc["at"] + cut).alias("at"), F.concat(acc["out"], F.array(F.substr(piece, F.lit(1), cut))).alias("out"))
        return F.when(cut > 0, grown).otherwise(acc)

    steps = F.sequence(F.lit(1), F.ceil(F.length(text) / (size // 2)).cast("int") + 1)
    return F.when(F.length(text) > size, F.aggregate(steps, start, step, lambda a: a["out"])).otherwise(F.array(text))


def answer_names(text: Column) -> Column:
    """Names in a listing answer, one a line: bullets, numbers and quotes off, 2 to 30 characters, no addresses."""
    bare = F.transform(F.split(F.coalesce(text, F.lit("")), r"\r?\n"), lambda v: F.trim(v))
    kept = F.filter(bare, lambda v: ~v.isin(BLANK_ANSWERS))
    clean = F.transform(kept, lambda v: F.regexp_replace(F.trim(F.regexp_replace(F.regexp_replace(v, r"^\d+[.、]\s*", ""), r"^[-*·]\s*", "")), r"^[`\"'）】]+|[`\"'）】]+$", ""))
    return F.array_distinct(F.filter(clean, lambda v: F.length(v).between(2, 30) & ~F.lower(v).contains("http")))


def markdown_names(text: Column) -> Column:
    """Names that a Markdown list gives: link texts and bold texts of its items, 2 to 30 characters."""
    links = F.regexp_extract_all(text, F.lit(r"(?m)^[ \t]*[-*+][ \t]+\[([^\]\n]{2,30})\]\("), F.lit(1))
    bold = F.regexp_extract_all(text, F.lit(r"(?m)^[ \t]*[-*+][ \t]+\*\*([^*\n]{2,30})\*\*"), F.lit(1))
    return F.array_distinct(F.transform(F.concat(links, bold), lambda v: F.trim(v)))


def gap_queries(gaps: DataFrame) -> DataFrame:
    """gap_id, place, query: the gap's own queries, else its description, else two of its CVEs; none gives no row."""
    own = F.filter("queries", lambda q: F.trim(q) != "")
    described = F.nullif(F.substr(F.trim("description"), F.lit(1), F.lit(120)), F.lit(""))
    by_cve = F.transform(F.slice("cves", 1, 2), lambda v: F.concat(v, F.lit(" exploit PoC")))
    chosen = F.coalesce(F.when(F.size(own) > 0, own), F.when(described.isNotNull(), F.array(described)), F.when(F.size(by_cve) > 0, by_cve))
    return gaps.select("gap_id", F.posexplode(chosen).alias("place", "query"))


def crawl_results(items: DataFrame, least: float = 0.3, most_chars: int = 8000) -> DataFrame:
    """Items (text, url) whose quality is high enough, with their score; texts are cut after scoring."""
    scored = govern.with_quality(items)
    return scored.withColumn("score", F.col("quality.score")).filter(F.col("score") >= least).drop("quality").withColumn("text", F.substr("text", F.lit(1), F.lit(most_chars)))


def feed_text(summary: Column, full: Column, least: int = 200) -> Column:
    """The summary, or the full text if the summary is short and there is one."""
    return F.when(F.length(F.coalesce(summary, F.lit(""))) < least, F.coalesce(F.nullif(F.trim(full), F.lit("")), summary)).otherwise(summary)


def next_offsets(state: DataFrame, batch: DataFrame) -> DataFrame:
    """State by source (source, last_seen, n_seen, n_runs) after a batch of (source, seen): an upsert as one aggregate."""
    news = batch.groupBy("source").agg(F.max("seen").alias("last_seen"), F.count(F.lit(1)).alias("n_seen"), F.lit(1).cast("long").alias("n_runs"))
    return state.select("source", "last_seen", "n_seen", "n_runs").unionByName(news).groupBy("source").agg(F.max("last_seen").alias("last_seen"), F.sum("n_seen").alias("n_seen"), F.sum("n_runs").alias("n_runs"))


def fresh_entries(batch: DataFrame, state: DataFrame) -> DataFrame:
    """Rows of the batch (source, seen) past their source's mark; sources without a mark are all fresh."""
    marks = state.select("source", F.col("last_seen").alias("__mark"))
    return batch.join(marks, "source", "left").filter("__mark IS NULL OR seen > __mark").drop("__mark")
