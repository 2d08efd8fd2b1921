"""Quality rules with cross-document line frequency.

Normalised lines are hashed; for each host the number of different documents that hold a line is counted; lines held
by more than MIN_DOCS documents are removed, however many documents the host has, and documents that lose over half of
their words are rejected.
Exact copies of a document count once, so that copies don't make each other's lines look like boilerplate.

Up to LISTED frequent lines are handed to the tasks as hashes by host. Beyond that they are joined by (host, hash) with
the lines of the documents, salted as a line may be in very many, and each document gets the list of its own lines.

Defined results: a null text has no words and fails the base rules; a null host is a host of its own; lines without a
word are neither counted nor removed; repeated rows get equal results; very long texts and lines are read whole, in time
and memory in proportion to their length; an empty table gives an empty result; extra columns are ignored by score() and
kept by keep_good(), whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kenning.llm.common import columns, materialise, plain

MIN_WORDS = 50
MIN_DOCS = 10
#: Most frequent lines that are handed to the tasks as a whole; salts of the join beyond that.
LISTED, SALTS = 200_000, 16
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

STATS = [
    ("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"), ("n_dup_lines", "bigint"),
    ("n_repeat_words", "bigint"), ("base_failed", "boolean"), ("kept", "boolean"), ("n_removed_lines", "bigint"),
    ("n_left_words", "bigint"),
]


def line_key(line: bytes) -> int:
    """Signed 64-bit hash of the line, lower-cased (A-Z) and with single spaces; 0 stands for a line without a word."""
    words = line.split()
    if not words:
        return 0
    h = xxhash.xxh64_intdigest(b" ".join(words).lower())
    return (h - (1 << 64) if h >> 63 else h) or 1


def repeat_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that occurs twice or more in the text, first occurrences included."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)
    m = len(seen)
    if m == n:
        return 0
    pairs = ids[:-1] * m + ids[1:]
    if m > 2_000_000:  # three ids don't fit in 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    keys = pairs[:-1] * m + ids[2:]
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    inside = np.zeros(n, dtype=bool)
    for k in range(3):
        inside[k : n - 2 + k] |= again
    return int(inside.sum())


def base_stats(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    bare = text.translate(None, SPACES)
    chars = len(bare) if bare.isascii() else len(bare.decode("utf-8"))
    symbols = len(bare) - len(bare.translate(None, SYMBOLS))
    earlier: set[bytes] = set()
    dup = 0
    for line in text.split(b"\n"):
        if line in earlier:
            dup += 1
        elif line and not line.isspace():
            earlier.add(line)
    return len(words), chars, symbols, dup, repeat_words(words)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, keys, texts = [], [], []
        for host, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            copy = xxhash.xxh64_intdigest(text or b"")
            copy -= (copy >> 63) << 64
            found = {line_key(x) for x in (text or b"").split(b"\n")}
            found.discard(0)
            hosts += [host] * len(found)
            keys += found
            texts += [copy] * len(found)
        yield pa.record_batch([pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), pa.array(texts, pa.int64())], names=["host", "line", "copy"])


def document_lines(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """host, line, copy: the hashes of the lines with a word of each different text of the host."""
    slim = docs.select(F.col(host_col).cast("string").alias("host"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(_lines, "host string, line long, copy long").groupBy("host", "line", "copy").agg(F.lit(1).alias("one")).drop("one")


def frequent_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """host, line: lines that over min_docs different documents of the host hold."""
    return materialise(lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > min_docs).select("host", "line"), "lines")


def own_lines(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """__host, __copy, __lines: the frequent lines of each text that holds any."""
    salted = lines.withColumn("salt", F.pmod("copy", F.lit(SALTS)).cast("int"))
    over = frequent.select(F.col("host").alias("__host"), F.col("line").alias("__line"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))
    held = salted.join(over.hint("merge"), F.col("host").eqNullSafe(F.col("__host")) & (F.col("line") == F.col("__line")) & (F.col("salt") == F.col("__salt")))
    return held.groupBy(F.col("host").alias("__host"), F.col("copy").alias("__copy")).agg(F.collect_list("line").alias("__lines"))


def _with_copy(docs: DataFrame, text_col: str) -> DataFrame:
    """docs with __copy, the hash of the text that document_lines() has."""
    at, names = docs.columns.index(text_col), [*docs.columns, "__copy"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([xxhash.xxh64_intdigest(t or b"") for t in batch.column(at).cast(pa.binary()).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], names=names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("__copy", T.LongType())]))


def _judge(docs: DataFrame, text_col: str, host_col: str, min_docs: int, lost: float) -> DataFrame:
    """docs (of plain names) with the struct `__quality`: the columns of STATS and clean_text."""
    fields = ", ".join(f"{n} {t}" for n, t in STATS) + ", clean_text string"
    lines = document_lines(docs, text_col, host_col)
    frequent = frequent_lines(lines, min_docs)
    by_host: dict[str | None, list[int]] = {}
    listed = frequent.limit(LISTED + 1).count() <= LISTED
    if listed:
        for host, line in frequent.toLocalIterator():
            by_host.setdefault(host, []).append(line)
        joined = docs.withColumn("__lines", F.lit(None).cast("array<bigint>"))
    else:
        marked = _with_copy(docs, text_col)
        own = own_lines(lines, frequent).hint("merge")
        joined = marked.join(own.withColumnRenamed("__copy", "__own"), F.col(host_col).cast("string").eqNullSafe(F.col("__host")) & (F.col("__copy") == F.col("__own")), "left")
    joined = joined.withColumn("__named", F.col(host_col).cast("string"))
    shared = docs.sparkSession.sparkContext.broadcast({h: np.array(v, dtype=np.int64) for h, v in by_host.items()})
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("__quality", T._parse_datatype_string(fields))])
    at = names.index(text_col)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = dict(bigint=pa.int64(), boolean=pa.bool_())
        known: dict[str | None, frozenset] = {}
        for batch in batches:
            own, hosts = batch.column(len(names)), batch.column(len(names) + 1).to_pylist()
            out: list[list] = [[] for _ in range(len(STATS) + 1)]
            for k, raw in enumerate(batch.column(at).cast(pa.string()).cast(pa.binary()).to_pylist()):
                text = raw or b""
                if listed:
                    host = hosts[k]
                    if host not in known:
                        known[host] = frozenset(shared.value[host].tolist()) if host in shared.value else frozenset()
                    over = known[host]
                else:
                    over = frozenset(own[k].as_py() or ())
                n, chars, symbols, dup, repeats = base_stats(text)
                failed = n < MIN_WORDS or 100 * repeats > 50 * n
                clean, removed, left = text, 0, n
                if over:
                    lines = text.split(b"\n")
                    stay = [x for x in lines if line_key(x) not in over]
                    if removed := len(lines) - len(stay):
                        clean = b"\n".join(stay)
                        left = len(clean.split())
                kept = not failed and left >= (1 - lost) * n
                for column, value in zip(out, (n, chars, symbols, dup, repeats, failed, kept, removed, left, None if raw is None else clean), strict=True):
                    column.append(value)
            arrays = [pa.array(v, kinds[t]) for v, (_, t) in zip(out, STATS, strict=False)] + [pa.array(out[-1], pa.binary()).cast(pa.string())]
            verdict = pa.StructArray.from_arrays(arrays, names=[n for n, _ in STATS] + ["clean_text"])
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(names))] + [verdict], names=[*names, "__quality"])

    return joined.select(*names, "__lines", "__named").mapInArrow(judge, schema)


def score(docs: DataFrame, min_docs: int = MIN_DOCS, lost: float = 0.5) -> DataFrame:
    """One row per row of docs: doc_id, the counts, base_failed, kept, and what the line rule did."""
    slim = columns(docs, doc_id="doc_id", text="text", source="source")
    return _judge(slim, "text", "source", min_docs, lost).select("doc_id", *[F.col(f"__quality.{n}").alias(n) for n, _ in STATS])


def keep_good(docs: DataFrame, min_docs: int = MIN_DOCS, lost: float = 0.5) -> DataFrame:
    """The kept rows with frequent lines removed from the text; n_chars, if there is one, follows the text."""
    safe, text, host, chars = plain(docs, "text", "source", "n_chars")
    judged = _judge(safe, text, host, min_docs, lost).filter("__quality.kept")
    changed = {text: F.col("__quality.clean_text")}
    if chars:
        changed[chars] = F.when(F.col("__quality.n_removed_lines") > 0, F.length("__quality.clean_text")).otherwise(F.col(chars)).cast(safe.schema[chars].dataType)
    return judged.withColumns(changed).select(*safe.columns).toDF(*docs.columns)
