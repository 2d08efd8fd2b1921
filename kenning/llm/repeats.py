"""Periodic runs of words by Crochemore's partition refinement.

Positions of a text are classed by the factor of l words that begins there, l = 1, 2, ... From l to l + 1 a class is split
by the classes of the next positions; only those next classes are looked at that were small parts of the last split (all
parts but the largest), which is enough, and bounds the moves by n log n. A mark behind the last word ends all factors.

Neighbouring members of a class at a distance of l are a square of period l, and its root is primitive as no member lies
between. Squares of a period at consecutive positions are one run: a stretch of words with that smallest period that no
neighbouring word extends.

Texts are taken together until they have BATCH_WORDS words: their words have numbers of their own, so they never share a
class. While small parts hold many positions, all of them are moved at once in arrays; when few are left, one by one in
linked lists. Both apply the same rule, each position moves about as often as the repeats it lies in are long.

Defined results: a null or empty text has no words, no runs and an empty collapsed text; repeated rows have equal results;
texts of any length are read whole, in memory in proportion to their words; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kenning.llm.common import columns

#: Words of a batch; least words of a run, and least whole repeats of its period.
BATCH_WORDS, LENGTH, EXPONENT = 200_000, 6, 4
#: Small parts are moved one by one when they hold less than this share of all positions.
FEW = 1 / 64


class Classes:
    """Classes of positions by factor; split() goes on to factors that are one longer."""

    def __init__(self, ids: np.ndarray):
        self.length, self.cls = 1, ids.astype(np.int64)
        self.sizes = np.bincount(self.cls)
        self.small = np.flatnonzero(self.cls != int(np.argmax(self.sizes)))

    def active(self) -> np.ndarray:
        return np.flatnonzero(self.sizes[self.cls] > 1)

    def split(self) -> None:
        at = self.small[self.small > 0] - 1
        at = at[self.sizes[self.cls[at]] > 1]
        self.length += 1
        if not len(at):
            self.small = at
            return
        own, after = self.cls[at], self.cls[at + 1]
        order = np.lexsort((after, own))
        at, own, after = at[order], own[order], after[order]
        begins = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (after[1:] != after[:-1])]))
        counts = np.diff(np.append(begins, len(at)))
        group_of = own[begins]
        first = np.flatnonzero(np.concatenate([[True], group_of[1:] != group_of[:-1]]))  # first group of each class
        moved = np.add.reduceat(counts, first)
        parents = group_of[first]
        rest = self.sizes[parents] - moved
        groups = np.diff(np.append(first, len(begins)))
        parent = np.repeat(np.arange(len(first)), groups)
        # The largest part of each class: the rest, or else its largest group, which then keeps the class's number.
        largest = np.lexsort((-counts, parent))[first]
        keeps = np.where(rest == 0, largest, -1)
        stays_big = (rest == 0) | (counts[largest] > rest)
        number = np.arange(len(begins)) + len(self.sizes)
        number[keeps[keeps >= 0]] = parents[keeps >= 0]
        self.sizes = np.concatenate([self.sizes, counts])
        self.sizes[parents] = np.where(rest == 0, counts[largest], rest)
        self.sizes[len(self.sizes) - len(counts) + keeps[keeps >= 0]] = 0
        self.cls[at] = np.repeat(number, counts)
        small = np.ones(len(begins), dtype=bool)
        small[largest[stays_big]] = False
        parts = [at[np.repeat(small, counts)]]
        if (few := parents[(rest > 0) & stays_big]).size:  # the rest is a small part itself
            mask = np.zeros(len(self.sizes), dtype=bool)
            mask[few] = True
            parts.append(np.flatnonzero(mask[self.cls]))
        self.small = np.concatenate(parts)

    def squares(self) -> np.ndarray:
        """Where a square begins whose root has the present length."""
        at = self.active()
        at = at[np.argsort(self.cls[at], kind="stable")]
        near = (self.cls[at[1:]] == self.cls[at[:-1]]) & (np.diff(at) == self.length)
        return np.sort(at[:-1][near])


class Lists:
    """The same classes as linked lists of positions, for steps that move few."""

    def __init__(self, classes: Classes, limit: int):
        self.length, self.limit, self.cls = classes.length, limit, classes.cls.tolist()
        self.small = classes.small.tolist()
        self.members: dict[int, set[int]] = defaultdict(set)
        self.after, self.before, self.near = {}, {}, defaultdict(list)
        self.next = len(classes.sizes)
        at = classes.active()
        last: dict[int, int] = {}
        for i in at.tolist():
            c = self.cls[i]
            self.members[c].add(i)
            if c in last:
                self.link(last[c], i)
            last[c] = i

    def link(self, a: int, b: int) -> None:
        self.after[a], self.before[b] = b, a
        if self.length < b - a <= self.limit:
            self.near[b - a].append(a)

    def unlink(self, x: int) -> None:
        a, b = self.before.pop(x, None), self.after.pop(x, None)
        if a is not None and b is not None:
            self.link(a, b)
        elif a is not None:
            del self.after[a]
        elif b is not None:
            del self.before[b]

    def split(self) -> None:
        cls, members = self.cls, self.members
        parts: dict[int, dict[int, list[int]]] = {}
        for i in self.small:
            if i and len(members.get(own := cls[i - 1], ())) > 1:
                parts.setdefault(own, {}).setdefault(cls[i], []).append(i - 1)
        small: list[int] = []
        for own, groups in parts.items():
            whole = members[own]
            rest = len(whole) - sum(map(len, groups.values()))
            found = sorted(groups.values(), key=len)
            if rest:
                small_rest = len(found[-1]) > rest
            else:
                found, largest, small_rest = found[:-1], found[-1], False
            for k, group in enumerate(found):
                for x in group:
                    self.unlink(x)
                    cls[x] = self.next
                whole.difference_update(group)
                group.sort()
                for a, b in zip(group, group[1:], strict=False):
                    self.link(a, b)
                if len(group) > 1:
                    members[self.next] = set(group)
                self.next += 1
                if not (rest and k == len(found) - 1 and small_rest):
                    small += group
            if small_rest:
                small += whole
        self.length += 1
        self.small = small

    def squares(self) -> list[int]:
        d = self.length
        return sorted({i for i in self.near.pop(d, ()) if self.after.get(i) == i + d})


def runs(ids: np.ndarray, limit: int, length: int = LENGTH, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of numbered words with at least these lengths, of periods up to limit."""
    out: list[tuple[int, int, int]] = []

    def add(starts, q: int) -> None:
        if len(starts) > max(length, exponent * q) - 2 * q:
            found = np.asarray(starts)
            ends = np.flatnonzero(np.append(np.diff(found) != 1, True))
            firsts = np.concatenate([[0], ends[:-1] + 1])
            for a, b in zip(found[firsts].tolist(), found[ends].tolist(), strict=True):
                if (n := b - a + 2 * q) >= max(length, exponent * q):
                    out.append((a, n, q))

    if limit < 1 or not len(ids):
        return out
    classes = Classes(ids)
    add(classes.squares(), 1)
    while classes.length < limit and len(classes.small) > FEW * len(ids):
        classes.split()
        add(classes.squares(), classes.length)
    if classes.length < limit and len(classes.small):
        lists = Lists(classes, limit)
        while lists.length < limit and lists.small:
            lists.split()
            add(lists.squares(), lists.length)
    return sorted(out, key=lambda r: (r[0], r[2]))


def _batch(texts: list[list[bytes]], length: int, exponent: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, its words numbered from 0."""
    numbers, starts, size, most = [], [], 0, 0
    for words in texts:
        known: dict[bytes, int] = {}
        numbers.append(np.array([known.setdefault(w, len(known)) for w in words] + [len(known)], dtype=np.int64) + most)
        most += len(known) + 1
        starts.append(size)
        size += len(words) + 1
    limit = max((len(w) // exponent for w in texts if len(w) >= length), default=0)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, n, q in runs(np.concatenate(numbers), limit, length, exponent):
        k = int(np.searchsorted(starts, a, side="right")) - 1
        out[k].append((a - starts[k], n, q))
    return out


def detect(docs: DataFrame, length: int = LENGTH, exponent: int = EXPONENT, batch_words: int = BATCH_WORDS) -> DataFrame:
    """doc_id, n_words, runs (start, length, period, in this order) and the text without repeats, its words joined by one space.

    A run has at least `length` words and `exponent` (2 or more) periods. Of a run only the first period's words stay.
    """
    if exponent < 2:
        raise ValueError("a run has two periods at least")
    slim = columns(docs, doc_id="doc_id", text="text").select("doc_id", F.col("text").cast("string").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    fields = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size, id_type = [], [], 0, None

        def done() -> pa.RecordBatch:
            found, collapsed = _batch(texts, length, exponent), []
            for words, own in zip(texts, found, strict=True):
                if own:
                    gone = np.zeros(len(words) + 1, dtype=np.int64)
                    for a, n, q in own:
                        gone[a + q] += 1
                        gone[a + n] -= 1
                    words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
                collapsed.append(b" ".join(words))
            rows = pa.array([[dict(start=a, length=n, period=q) for a, n, q in own] for own in found], fields)
            return pa.record_batch([pa.array(ids, id_type), pa.array([len(w) for w in texts], pa.int64()), rows, pa.array(collapsed, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                ids.append(i)
                texts.append((text or b"").split())
                size += len(texts[-1]) + 1
                if size >= batch_words:
                    yield done()
                    ids, texts, size = [], [], 0
        if ids:
            yield done()

    return slim.mapInArrow(run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
