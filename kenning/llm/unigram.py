"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie of pieces with log scores.

A model file is read on the driver (its wire format is parsed here) and its arrays, a few MB whatever the corpus, are
broadcast. Segments of a text that no piece can straddle are encoded once and kept in a bounded table; all segments
that are new in a batch are matched against the trie and decoded together, position by position, as array operations.

Segments of over LONG_SEGMENT bytes are decoded BLOCK bytes at a time; a place keeps the length and number of its last
piece (6 bytes) and no more, so that a text without spaces takes memory in proportion to its length, and they aren't
kept in the table.

Scores: those of a Unigram model are used as they stand. A user-defined piece scores its characters times the best normal
score or 0, whichever is more, less 0.1, as the public library has it, so that it is always taken. Other kinds store merge ranks, which aren't log scores; they
become log probabilities by Zipf's law, -log(rank + 2) less the log of the sum.

Ties: of equally good ways to reach a position, the one with the shorter last piece wins.

White space: a space is the marker; one is put before the text and taken off again by decoding. A literal U+2581 and
characters without a piece are written as bytes, so decoding gives the text back exactly.

Defined results: null text gives null ids and decodes to null; empty text gives no ids; ids out of range decode to
nothing, malformed byte runs to U+FFFD; repeated rows give equal rows; an empty table gives an empty result; texts of any
length are encoded whole; extra columns are ignored by encode_decode() and kept by the others, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kenning.llm.common import columns, plain

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
NORMAL, USER_DEFINED, BYTE, UNIGRAM = 1, 4, 6, 1
#: How much worse than the worst piece an unknown character is.
UNKNOWN_PENALTY = 10.0
CACHE_SEGMENTS, CHUNK_BYTES, LONG_SEGMENT, BLOCK = 100_000, 1 << 16, 192, 1 << 14


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field number and value of each field of a protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = data[at]
            value |= (b & 127) << shift
            at, shift = at + 1, shift + 7
            if b < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            n, at = varint(at)
            value, at = data[at : at + n], at + n
        else:
            n = 4 if kind == 5 else 8
            value, at = struct.unpack("<f" if n == 4 else "<d", data[at : at + n])[0], at + n
        yield tag >> 3, value


def read_model(path: str) -> tuple[list[tuple[str, float, int]], int]:
    """(piece, score, type) by id, and the kind of model."""
    with open(path, "rb") as f:
        data = f.read()
    pieces, kind = [], UNIGRAM
    for number, value in _fields(data):
        if number == 1:
            x = dict(_fields(value))
            pieces.append((x.get(1, b"").decode("utf-8"), x.get(2, 0.0), x.get(3, NORMAL)))
        elif number == 2:
            kind = dict(_fields(value)).get(3, UNIGRAM)
    return pieces, kind


def double_array(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check and value of a double-array trie over bytes; value is the key's index or -1. keys: sorted, distinct."""
    size = 1 << 16
    base, check, value = [0] * size, [-1] * size, [-1] * size
    used = bytearray(size)
    used[0] = 1
    free_from, top = 257, 257
    todo = [(0, 0, len(keys), 0)]
    while todo:
        state, lo, hi, depth = todo.pop()
        if lo < hi and len(keys[lo]) == depth:
            value[state] = lo
            lo += 1
        if lo >= hi:
            continue
        groups, k = [], lo
        while k < hi:
            c, first = keys[k][depth], k
            while k < hi and keys[k][depth] == c:
                k += 1
            groups.append((c, first, k))
        labels = [g[0] for g in groups]
        while used[free_from]:
            free_from += 1
        # Nodes with one child fill the gaps; others search near the end, where there is room.
        b = max(1, (free_from if len(labels) == 1 else max(free_from, top - 2048)) - labels[0])
        while True:
            if b + 512 > size:
                base += [0] * size
                check += [-1] * size
                value += [-1] * size
                used += bytearray(size)
                size *= 2
            if not any(used[b + c] for c in labels):
                break
            b += 1
        base[state] = b
        top = max(top, b + labels[-1])
        for c, first, last in groups:
            used[b + c] = 1
            check[b + c] = state
            todo.append((b + c, first, last, depth + 1))
    return tuple(np.array(x[: top + 512], dtype=np.int32) for x in (base, check, value))


class Unigram:
    """A model ready for use on executors; pickles as a handful of arrays."""

    def __init__(self, pieces: list[tuple[str, float, int]], kind: int = UNIGRAM):
        marked = [(p.replace("▁", " ").encode("utf-8"), i, s) for i, (p, s, t) in enumerate(pieces) if t in (NORMAL, USER_DEFINED) and p]
        if kind != UNIGRAM:
            ranks = np.array([max(0.0, -s) for _, _, s in marked]) + 2.0
            logs = -np.log(ranks) - np.log(np.sum(1.0 / ranks))
            marked = [(p, i, float(s)) for (p, i, _), s in zip(marked, logs, strict=True)]
        own = {i for i, (_, _, t) in enumerate(pieces) if t == USER_DEFINED}
        normal = [s for _, i, s in marked if i not in own]
        if own:
            marked = [(p, i, len(p.decode("utf-8")) * max([0.0, *normal]) - 0.1 if i in own else s) for p, i, s in marked]
        marked.sort()
        self.base, self.check, self.value = double_array([p for p, _, _ in marked])
        self.ids = np.array([i for _, i, _ in marked], dtype=np.int32)
        self.scores = np.array([s for _, _, s in marked], dtype=np.float64)
        self.longest = max((len(p) for p, _, _ in marked), default=1)
        self.unknown = float(min(normal, default=0.0)) - UNKNOWN_PENALTY
        self.byte_ids = np.full(256, -1, dtype=np.int32)
        self.spell = [b""] * len(pieces)
        for p, i, _ in marked:
            self.spell[i] = p
        for i, (p, _, t) in enumerate(pieces):
            if t == BYTE:
                self.byte_ids[int(p[1:-1], 16)] = i
                self.spell[i] = bytes([int(p[1:-1], 16)])
        self.fallback = bool((self.byte_ids >= 0).all())
        self.unknown_id = next((i for i, (_, _, t) in enumerate(pieces) if t == 2), 0)
        if any(re.search(rb"[^ ] ", p) for p, _, _ in marked):
            self.cut = rb"(?s).+"
        else:
            joined = {c for p, _, _ in marked if len(p) > 1 for c in p}
            alone = bytes(c for c in b"\t\n\r" if c not in joined)
            own = b"".join(b"\\x%02x" % c for c in alone)
            self.cut = b" *[^ " + own + b"]+|" + (b"[" + own + b"]|" if own else b"") + b" +"
        self.known: dict[bytes, bytes] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}}

    def _edges(self, flat: np.ndarray, ends: np.ndarray, begins: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(length, start positions, key indices) of all pieces found in flat that begin in its first `begins` places; ends: for each place its segment's end."""
        at = np.arange(begins, dtype=np.int64)
        state = np.zeros(begins, dtype=np.int64)
        found = []
        for depth in range(1, self.longest + 1):
            inside = at + depth <= ends[at]
            at, state = at[inside], state[inside]
            step = self.base[state] + flat[at + depth - 1]
            on = self.check[step] == state
            at, state = at[on], step[on].astype(np.int64)
            if not len(at):
                break
            key = self.value[state]
            if (hit := key >= 0).any():
                found.append((depth, at[hit], key[hit]))
        return found

    def _with_unknown(self, flat: np.ndarray, found: list, begins: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """found with edges of key -1 for characters that aren't pieces."""
        flat = flat[:begins]
        width = np.select([flat < 0x80, flat < 0xC0, flat < 0xE0, flat < 0xF0], [1, 0, 2, 3], 4)
        by = {d: (p, k) for d, p, k in found}
        for w in (1, 2, 3, 4):
            lead = width == w
            if w in by:
                lead[by[w][0]] = False
            if len(extra := np.flatnonzero(lead)):
                p, k = by.get(w, (np.zeros(0, np.int64), np.zeros(0, np.int32)))
                by[w] = (np.concatenate([p, extra]), np.concatenate([k, np.full(len(extra), -1, np.int32)]))
        return [(d, *by[d]) for d in sorted(by)]

    def _long(self, segment: bytes) -> bytes:
        """Ids of a segment of any length, BLOCK bytes at a time."""
        flat, size = np.frombuffer(segment, dtype=np.uint8), len(segment)
        length, key = np.zeros(size + 1, dtype=np.uint16 if self.longest < 1 << 16 else np.int32), np.zeros(size + 1, dtype=np.int32)
        best, last, what = [0.0], [0], [0]  # of the places from `begin` on, as far as they are reached
        for begin in range(0, size, BLOCK):
            own = min(BLOCK, size - begin)
            part = flat[begin : begin + own + self.longest + 4]
            found = self._with_unknown(part, self._edges(part, np.full(len(part), len(part), dtype=np.int64), own), own)
            none = [np.zeros(0, dtype=np.int64)]  # a block may lie within a character
            start = np.concatenate([*none, *(p for _, p, _ in found)])
            step = np.concatenate([*none, *(np.full(len(p), d) for d, p, _ in found)])
            keys = np.concatenate([*none, *(k for _, _, k in found)])
            score = np.where(keys >= 0, self.scores[keys], self.unknown)
            order = np.lexsort((step, start))
            more = len(part) + 1 - len(best)
            best += [-np.inf] * more
            last += [0] * more
            what += [0] * more
            for s, n, k, v in zip(start[order].tolist(), step[order].tolist(), keys[order].tolist(), score[order].tolist(), strict=True):
                if best[s] + v >= best[s + n]:
                    best[s + n], last[s + n], what[s + n] = best[s] + v, n, k
            length[begin : begin + own + 1], key[begin : begin + own + 1] = last[: own + 1], what[: own + 1]
            best, last, what = best[own:], last[own:], what[own:]
        out, at = array("i"), size
        while at > 0:
            n, k = int(length[at]), int(key[at])
            if k >= 0:
                out.append(int(self.ids[k]))
            elif self.fallback:
                out.extend(self.byte_ids[list(segment[at - n : at][::-1])].tolist())
            else:
                out.append(self.unknown_id)
            at -= n
        return np.array(out[::-1], dtype=np.int32).tobytes()

    def _chunk(self, segments: list[bytes]) -> None:
        """Encode short segments together. segments: longest first."""
        lengths = np.array([len(s) for s in segments], dtype=np.int64)
        flat = np.frombuffer(b"".join(segments), dtype=np.uint8)
        starts = np.cumsum(lengths) - lengths
        found = self._with_unknown(flat, self._edges(flat, np.repeat(starts + lengths, lengths), len(flat)), len(flat))
        top, n = int(lengths[0]), len(segments)
        gain, keys = {}, {}
        for d, p, k in found:
            gain[d] = np.full(len(flat), -np.inf)
            gain[d][p] = np.where(k >= 0, self.scores[k], self.unknown)
            keys[d] = np.full(len(flat), -1, dtype=np.int32)
            keys[d][p] = k
        best = np.full((top + 1, n), -np.inf)
        best[0] = 0.0
        last = np.zeros((top + 1, n), dtype=np.int64)
        for j in range(1, top + 1):
            live = int(np.searchsorted(-lengths, -j, side="right"))
            now, by = best[j, :live], last[j, :live]
            for d in gain:
                if d > j:
                    break
                way = best[j - d, :live] + gain[d][starts[:live] + (j - d)]
                better = way > now
                now[better] = way[better]
                by[better] = d
        at, columns = lengths.copy(), np.arange(n)
        paths: list[list[int]] = [[] for _ in range(n)]
        odd = set()
        while len(columns):
            d = last[at[columns], columns]
            start = at[columns] - d
            key = np.empty(len(columns), dtype=np.int32)
            for x in np.unique(d):
                same = d == x
                key[same] = keys[int(x)][(starts[columns] + start)[same]]
            for c, k, i in zip(columns.tolist(), key.tolist(), self.ids[key].tolist(), strict=True):
                paths[c].append(i)
                if k < 0:
                    odd.add(c)
            at[columns] = start
            columns = columns[start > 0]
        for c, (segment, path) in enumerate(zip(segments, paths, strict=True)):
            self.known[segment] = self._long(segment) if c in odd else struct.pack(f"<{len(path)}i", *reversed(path))

    def learn(self, segments: set[bytes]) -> None:
        """Put the ids of new segments into the table."""
        short = []
        for s in segments:
            try:
                s.isascii() or s.decode("utf-8")
            except UnicodeDecodeError:
                self.known[s] = self.byte_ids[list(s)].tobytes() if self.fallback else b""
                continue
            if len(s) <= LONG_SEGMENT:
                short.append(s)
            else:
                self.known[s] = self._long(s)
        short.sort(key=len, reverse=True)
        at = 0
        while at < len(short):
            size, end = 0, at
            while end < len(short) and size < CHUNK_BYTES:
                size += len(short[end])
                end += 1
            self._chunk(short[at:end])
            at = end

    def encode_bytes(self, texts: list[bytes | None]) -> list[bytes | None]:
        """Little-endian 32-bit ids of each text."""
        if len(self.known) > CACHE_SEGMENTS:
            self.known.clear()
        find = re.compile(self.cut).findall
        out: list[bytes | None] = []
        group: list[list[bytes] | None] = []
        size = 0

        def flush() -> None:
            new = {s for g in group if g for s in g if s not in self.known}
            if new:
                self.learn(new)
            get = self.known.__getitem__
            out.extend(None if g is None else b"".join(map(get, g)) for g in group)
            group.clear()
            for s in new:
                if len(s) > LONG_SEGMENT:
                    del self.known[s]

        for text in texts:
            group.append(None if text is None else find(b" " + text) if text else [])
            size += len(text or b"")
            if size > 4_000_000:
                flush()
                size = 0
                if len(self.known) > CACHE_SEGMENTS:
                    self.known.clear()
        flush()
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes([text.encode("utf-8")])[0], dtype=np.int32).tolist()

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        spell = self.spell
        n = len(spell)
        try:
            joined = b"".join(map(spell.__getitem__, ids.tolist())) if not len(ids) or ids.min() >= 0 else b"".join(spell[i] for i in ids.tolist() if 0 <= i < n)
        except IndexError:
            joined = b"".join(spell[i] for i in ids.tolist() if 0 <= i < n)
        return joined[1:] if joined[:1] == b" " else joined

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(np.array(ids, dtype=np.int64)).decode("utf-8", "replace")


def load(path: str = MODEL) -> Unigram:
    return Unigram(*read_model(path))


def _list_array(rows: list[bytes | None]) -> pa.Array:
    sizes = np.array([0 if r is None else len(r) // 4 for r in rows], dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(r for r in rows if r), dtype=np.int32))
    valid = pa.array([r is None for r in rows], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=valid)


def _appended(df: DataFrame, read_col: str, added: list[T.StructField], make) -> DataFrame:
    """df with columns appended (those of their names are replaced); make: the read column of a batch -> arrays."""
    safe, at = plain(df, read_col)
    again = {f.name.lower() for f in added}
    kept = [i for i, c in enumerate(df.columns) if c.lower() not in again]
    place, names = int(at[1:]), [f"n{i}" for i in range(len(kept) + len(added))]
    fields = [safe.schema.fields[i].dataType for i in kept] + [f.dataType for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *make(batch.column(place))], names=names)

    out = safe.mapInArrow(run, T.StructType([T.StructField(n, f) for n, f in zip(names, fields, strict=True)]))
    return out.toDF(*[df.columns[i] for i in kept], *[f.name for f in added])


def _texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.string()).cast(pa.binary()).to_pylist()


def encode(df: DataFrame, model: Unigram, text_col: str = "text", out: str = "piece_ids") -> DataFrame:
    """df with the ids of text_col as array<int> (a column of that name is replaced)."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    field = T.StructField(out, T.ArrayType(T.IntegerType()))
    return _appended(df, text_col, [field], lambda column: [_list_array(shared.value.encode_bytes(_texts(column)))])


def decode(df: DataFrame, model: Unigram, ids_col: str = "piece_ids", out: str = "decoded") -> DataFrame:
    """df with the text of ids_col."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make(column: pa.Array) -> list[pa.Array]:
        texts = [None if not x.is_valid else shared.value.decode_bytes(x.values.to_numpy(zero_copy_only=False)).decode("utf-8", "replace") for x in column]
        return [pa.array(texts, pa.string())]

    return _appended(df, ids_col, [T.StructField(out, T.StringType())], make)


def encode_decode(docs: DataFrame, model: Unigram, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ids, their counts, and whether decoding them gives the text back; text is read once.

    doc_id, n_pieces, n_byte_pieces, round_trip (null for a null text), decoded_sha256, piece_ids.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    slim = columns(docs, doc_id=id_col, text=text_col)
    schema = f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, n_pieces long, n_byte_pieces long, round_trip boolean, decoded_sha256 string, piece_ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        is_byte = np.zeros(len(m.spell) + 1, dtype=bool)
        is_byte[m.byte_ids] = True
        is_byte[-1] = False
        for batch in batches:
            texts = _texts(batch.column(1))
            rows = m.encode_bytes(texts)
            pieces, raw, same, digests = [], [], [], []
            for text, row in zip(texts, rows, strict=True):
                ids = np.frombuffer(row or b"", dtype=np.int32)
                pieces.append(len(ids))
                raw.append(int(is_byte[ids].sum()))
                back = None if row is None else m.decode_bytes(ids)
                same.append(None if row is None else back == text)
                digests.append(None if row is None else hashlib.sha256(back).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pieces, pa.int64()), pa.array(raw, pa.int64()), pa.array(same, pa.bool_()), pa.array(digests, pa.string()), _list_array(rows)], names=["doc_id", "n_pieces", "n_byte_pieces", "round_trip", "decoded_sha256", "piece_ids"])

    return slim.mapInArrow(run, schema).withColumnRenamed("doc_id", id_col)


def with_pieces(docs: DataFrame, model: Unigram, text_col: str = "text") -> DataFrame:
    """docs with piece_ids, n_pieces and round_trip (whether decoding gives the text back; null for a null text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(column: pa.Array) -> list[pa.Array]:
        m, texts = shared.value, _texts(column)
        rows = m.encode_bytes(texts)
        same = [None if r is None else m.decode_bytes(np.frombuffer(r, dtype=np.int32)) == t for t, r in zip(texts, rows, strict=True)]
        return [_list_array(rows), pa.array([len(r or b"") // 4 for r in rows], pa.int64()), pa.array(same, pa.bool_())]

    added = [T.StructField("piece_ids", T.ArrayType(T.IntegerType())), T.StructField("n_pieces", T.LongType()), T.StructField("round_trip", T.BooleanType())]
    return _appended(docs, text_col, added, make)
