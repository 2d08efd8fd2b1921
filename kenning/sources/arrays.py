"""Top-level JSON arrays of any size, read in parallel and in bounded memory: one row per element.

A file is read as the pieces between closing braces, which Spark's text source splits wherever it likes, so neither a
file nor a line is ever one string. What a piece means depends on what stands before it: whether it begins inside a
string, and how deep. So the blocks of a file are scanned twice:

  1. Each block is summed up for both cases, inside a string and outside: the case it ends in and how much deeper. These
     sums, one row a block, are chained by file.
  2. With its beginning known, each block gives the elements that lie in it, and the fragments of those that cross its
     ends. Fragments of one element, in the order of blocks, are put together.

Elements are objects in a top-level array, or in an array of a top-level object (`{"data": [...]}`); what else is there
is passed over. A file that ends too early, or can't be read, has a row that says so in report() and gives the elements
before that; to a strict reader it is an error. (An object that isn't in an array and fills a block of its own is taken
for an element.)
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kenning.functions import text as tx
from kenning.plans.store import materialise, small

#: A string up to its end or the piece's, or a bracket.
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*("|\\?$)|[\[\]{}]', re.DOTALL)
_REST = re.compile(r'(?:[^"\\]|\\.)*("|\\?$)', re.DOTALL)


def pieces(spark: SparkSession, path: str | list[str], strict: bool = False) -> DataFrame:
    """source_file, block (where its split begins), value; the brace that ended the piece is left out. strict: a file that can't be read is an error."""
    skip = str(not strict).lower()
    raw = spark.read.option("lineSep", "}").option("ignoreCorruptFiles", skip).option("ignoreMissingFiles", skip).text(path)
    return raw.select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"), "value")


def scan(text: str, inside: bool) -> Iterator[tuple[int, str]]:
    """Position and kind of each bracket outside strings; at last the length and `"` if the text ends in a string, else ''."""
    at = 0
    if inside:
        m = _REST.match(text)
        if m.group(1) != '"':
            yield len(text), '"'
            return
        at = m.end()
    for m in _TOKEN.finditer(text, at):
        if m.group(0)[0] != '"':
            yield m.start(), m.group(0)
        elif m.group(1) != '"':
            yield len(text), '"'
            return
    yield len(text), ""


def _step(text: str, inside: bool, closed: bool) -> tuple[bool, int]:
    """Whether a text ends in a string, and how much deeper it ends. closed: a brace follows it."""
    depth, end = 0, ""
    for _, kind in scan(text, inside):
        if kind in ("{", "["):
            depth += 1
        elif kind in ("}", "]"):
            depth -= 1
        else:
            end = kind
    return end == '"', depth - (closed and end != '"')


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block: first sign, pieces, bytes, and for both beginnings the end, the depth, and both before the last piece."""
    now, first, n, size, states, before, last = None, "", 0, 0, [], [], ""
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.string()]
    names = ["source_file", "block", "first", "n", "size", "open", "closed", "last"]

    def row() -> pa.RecordBatch:
        # Without a brace after the last piece, and with one: end in a string (0, 1) and depth, for both beginnings.
        open_ = [x for s, d in before for e, k in [_step(last, s, False)] for x in (int(e), d + k)]
        closed = [x for s, d in states for x in (int(s), d)]
        return pa.record_batch([pa.array([v], k) for v, k in zip((*now, first, n, size, open_, closed, last.rstrip()[-1:]), kinds, strict=True)], names=names)

    for batch in batches:
        for file, block, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if (file, block) != now:
                if now:
                    yield row()
                now, first, n, size, states = (file, block), "", 0, 0, [(False, 0), (True, 0)]
            first = first or text.lstrip("\ufeff \t\r\n")[:1]
            n, size, before, last = n + 1, size + len(text.encode()), states, text
            stepped = {s: _step(text, s, True) for s in {s for s, _ in states}}
            states = [(stepped[s][0], d + stepped[s][1]) for s, d in states]
    if now:
        yield row()


def _chain(blocks: pd.DataFrame) -> pd.DataFrame:
    """Where each block of a file begins: inside a string or not, and how deep; whether a brace follows its last piece."""
    blocks = blocks.sort_values("block")
    braces, n = int(blocks["length"].iloc[0] - blocks["size"].sum()), int(blocks["n"].sum())
    # As many braces as pieces: the last piece has one. Of a compressed file the sizes tell nothing: it has one if that alone ends the file.
    ended = braces == n if braces in (n - 1, n) else None
    inside, depth, out = 0, 0, []
    for i, b in enumerate(blocks.itertuples()):
        if ended is None and i == len(blocks) - 1:
            ends = [(end[2 * inside], depth + end[2 * inside + 1]) for end in (b.open, b.closed)]
            ended = ends[0] != (0, 0) and ends[1] == (0, 0)
        closed = i < len(blocks) - 1 or ended
        end = b.closed if closed else b.open
        out.append((b.source_file, b.block, bool(inside), depth, closed, blocks["first"].iloc[0]))
        inside, depth = int(end[2 * inside]), depth + int(end[2 * inside + 1])
    whole = not inside and depth == 0
    return pd.DataFrame([(*r, whole, False) for r in out], columns=["source_file", "block", "inside", "depth", "closed", "first", "whole", "alone"])


_BEGINNING = "source_file string, block long, inside boolean, depth long, closed boolean, first string, whole boolean, alone boolean"


def _lone(blocks: DataFrame) -> DataFrame:
    """What _chain says of files that are one block."""
    braces = F.col("length") - F.col("size")
    whole_by = lambda end: (F.get(end, F.lit(0)) == 0) & (F.get(end, F.lit(1)) == 0)
    closed = F.when((braces == F.col("n") - 1) | (braces == F.col("n")), braces == F.col("n")).otherwise(~whole_by(F.col("open")) & whole_by(F.col("closed")))
    whole = whole_by(F.when(closed, F.col("closed")).otherwise(F.col("open")))
    return blocks.select("source_file", "block", F.lit(False).alias("inside"), F.lit(0).cast("long").alias("depth"), closed.alias("closed"), "first", whole.alias("whole"), F.lit(True).alias("alone"))


def blocks(spark: SparkSession, path: str | list[str], strict: bool = False) -> DataFrame:
    """A row per block with its beginning (written). strict: a file that can't be read or ends too early is an error."""
    summed = pieces(spark, path, strict).mapInArrow(_sums, "source_file string, block long, first string, n long, size long, open array<long>, closed array<long>, last string")
    sized = materialise(summed, "sums").join(small(listed(spark, path)), "source_file").withColumn("alone", F.count(F.lit(1)).over(Window.partitionBy("source_file")) == 1)
    chained = sized.filter("NOT alone").groupBy("source_file").applyInPandas(_chain, _BEGINNING)
    found = materialise(_lone(sized.filter("alone")).union(chained), "blocks")
    if strict and (cut := found.filter("NOT whole").select("source_file").distinct().limit(5).collect()):
        raise ValueError("files end too early: " + ", ".join(r["source_file"] for r in cut))
    return found


def listed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """source_file, length of every file below path; no content is read."""
    return spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("source_file"), "length")


class _Block:
    """The elements of one block; take() gets its pieces in order."""

    def __init__(self, key: tuple, inside: bool, depth: int, first: str):
        self.key, self.state, self.deep, self.base = key, inside, depth, 1 if first == "[" else 2
        self.k, self.held, self.begun, self.within, self.listed = 0, [], False, depth > self.base, True
        self.out: list[tuple] = []

    def take(self, text: str) -> None:
        at = 0
        for i, kind in scan(text, self.state):
            if kind in ("{", "["):
                self.deep += 1
                if self.deep == self.base:
                    self.listed = kind == "["
                elif kind == "{" and self.deep == self.base + 1 and self.listed and not self.within:
                    self.begun, self.within, at = True, True, i
            elif kind in ("}", "]"):
                self.deep -= 1
                if self.within and self.deep == self.base:
                    self.held.append(text[at : i + 1])
                    self.give("whole" if self.begun else "end")
                    self.within = False
            else:
                self.state = kind == '"'
        if self.within:
            self.held.append(text[at:])

    def give(self, part: str) -> None:
        self.out.append((*self.key, self.k, part, "".join(self.held)))
        self.k, self.held, self.begun = self.k + 1, [], False

    def finish(self, last: str, closed: bool) -> list[tuple]:
        self.take(last + "}" if closed else last)
        if self.held:
            self.give("start" if self.begun else "middle")
        return self.out


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """source_file, block, k, part, value: part is whole, or what a block has of an element: start, middle or end."""
    block, last, closed = None, "", True
    for batch in batches:
        for file, start, text, inside, depth, ended, first in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
            if block and block.key == (file, start):
                block.take(last + "}")
            else:
                if block and (out := block.finish(last, closed)):
                    yield _rows(out)
                block = _Block((file, start), inside, depth, first)
            last, closed = text, ended
        if block and block.out:
            out, block.out = block.out, []
            yield _rows(out)
    if block and (out := block.finish(last, closed)):
        yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.record_batch([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=["source_file", "block", "k", "part", "value"])


def _parts(spark: SparkSession, path: str | list[str], starts: DataFrame, strict: bool = False) -> DataFrame:
    """source_file, block, k, part, value of the blocks in starts."""
    known = small(starts)
    rows = pieces(spark, path, strict).withColumn("id", F.monotonically_increasing_id()).join(known, ["source_file", "block"])
    if known is starts:  # too many blocks to hand out: the join shuffles, and a block's pieces are sorted again
        rows = rows.repartition("source_file", "block").sortWithinPartitions("source_file", "block", "id")
    return rows.select("source_file", "block", "value", "inside", "depth", "closed", "first").mapInArrow(_found, "source_file string, block long, k long, part string, value string")


def elements(spark: SparkSession, path: str | list[str], starts: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """source_file, place (struct, in order within the file), value: the JSON text of each whole element.

    strict: a file that can't be read or ends too early is an error.
    """
    starts = blocks(spark, path, strict) if starts is None else starts
    whole = _parts(spark, path, starts, strict).filter("part = 'whole'").select("source_file", F.struct("block", "k").alias("place"), "value")
    order = Window.partitionBy("source_file").orderBy("block", "k")
    # Only elements of files of several blocks come in parts.
    parts = _parts(spark, path, starts.filter("NOT alone"), strict).filter("part <> 'whole'").withColumn("n", F.sum((F.col("part") == "start").cast("int")).over(order))
    joined = parts.groupBy("source_file", "n").agg(F.min(F.struct("block", "k")).alias("place"), F.array_sort(F.collect_list(F.struct("block", "k", "value"))).alias("x"), (F.bool_or(F.col("part") == "end") & F.bool_or(F.col("part") == "start")).alias("ended"))
    return whole.unionByName(joined.filter("ended").select("source_file", "place", F.array_join(F.transform("x", lambda p: p["value"]), "").alias("value")))


def report(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """source_file, status (OK, TRUNCATED or UNREADABLE), n_elements, n_bad (elements that aren't JSON) of each file that isn't empty."""
    starts = blocks(spark, path)
    bad = ~tx.is_object(F.col("value"))
    per = elements(spark, path, starts).groupBy("source_file").agg(F.count(F.lit(1)).alias("n_elements"), F.count_if(bad).alias("n_bad"))
    ends = starts.groupBy("source_file").agg(F.bool_and("whole").alias("whole"))
    all_ = listed(spark, path).join(ends, "source_file", "left").join(per, "source_file", "left").na.fill(0, ["n_elements", "n_bad"])
    status = F.when(F.col("whole").isNull(), "UNREADABLE").when(F.col("whole"), "OK").otherwise("TRUNCATED")
    return all_.select("source_file", status.alias("status"), "n_elements", "n_bad")
