"""Lexical search, periodic runs and vector search against brute force, and their edges."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from kenning.llm import lexical, queries, repeats, vectors

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_ranking(docs, items, k):
    """docs and items: (id, text) rows. (item_id, rank, doc_id, score) rows."""
    split = [(i, WORD.findall((t or "").translate(UPPER))) for i, t in docs]
    counted = [(i, len(w), collections.Counter(w)) for i, w in split if w]
    n_docs, n_terms = len(counted), sum(n for _, n, _ in counted)
    df = collections.Counter(t for _, _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, n, c in counted:
            m = 10 + (90 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(WORD.findall((text or "").translate(UPPER))) if t in c)
            scores.append((-s, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(x for x in scores if x[0] < 0)[:k], 1)]
    return sorted(out, key=str)


def ranked(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


def corpus(rng, n):
    pool = ["w%d" % (i * i // 40) for i in range(200)] + ["Été", "NAÏVE", "日本"]
    texts = [" ".join(rng.choice(pool) for _ in range(int(rng.expovariate(1 / 30)))) for _ in range(n)]
    return texts + [texts[3]] * 12 + [None, "", "...", "\x00!", "w1 " * 5000]


@pytest.mark.parametrize("segment", [1, 700, 10**6])
def test_lexical_search(spark, segment):
    rng = random.Random(segment)
    docs = [(i, t) for i, t in enumerate(corpus(rng, 300))] + [(7, "w1 w2 été"), (None, "w1 w2 été"), (None, "w3")]
    items = [(i, " ".join(rng.sample(t.split(), min(12, len(t.split()))))) for i, (_, t) in enumerate(docs[:30])] + [(90, None), (91, "zz yy"), (92, "W1-w1 été"), (92, "W1-w1 été"), (None, "日本")]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, `item.id` string, rank int").repartition(3)
    index = lexical.build(frame, segment_terms=segment)
    for k, block in ((10, 10**6), (1, 150), (400, 10**6)):
        found = lexical.search(index, spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, score int"), k=k, block_terms=block, first=4)
        assert ranked(found) == plain_ranking(docs, items, k)


def test_lexical_bounds_leave_postings_unread():
    """With a floor, a segment stops early, or is left at once, and its answer is still exact."""
    rng = random.Random(5)
    docs = [[b"t%d" % min(int(rng.expovariate(0.1)), 60) for _ in range(rng.randint(5, 60))] for _ in range(500)]
    known = {}
    held = [np.array([known.setdefault(t, len(known)) for t in d]) for d in docs]
    row = lexical._segment(list(range(500)), held, known, __import__("pyarrow").int64()).to_pylist()[0]
    asked = {t: i for i, t in enumerate(sorted(known))}
    part = lexical.Segment(row, asked, 500, sum(map(len, docs)))
    weights = np.array([lexical.weight(500, sum(t in d for d in docs)) for t in sorted(known)])
    completed = []
    whole = part.complete
    part.complete = lambda d, w: completed.append(len(d)) or whole(d, w)
    for _ in range(60):
        own = np.array(sorted(rng.sample(range(len(asked)), 8)))
        mask = np.zeros(len(asked), dtype=np.int64)
        mask[own] = weights[own]
        scores = whole(np.arange(500), mask)
        want = sorted((-s, i) for i, s in enumerate(scores.tolist()) if s > 0)[:10]
        for floor in (0, -want[-1][0], -want[0][0], -want[0][0] + 1):
            at, got = part.best(own, mask, 10, floor)
            assert [(-s, i) for i, s in zip(at.tolist(), got.tolist(), strict=True)] == [x for x in want if -x[0] >= floor]
    assert completed and max(completed) < 500


def test_lexical_search_empty(spark):
    none = spark.createDataFrame([], "doc_id string, text string")
    some = spark.createDataFrame([("b", "x y"), ("a", "x y")], "doc_id string, text string")
    items = spark.createDataFrame([("i", "x")], "item_id string, text string")
    assert lexical.search(lexical.build(none), items).collect() == []
    assert lexical.search(lexical.build(some), items.limit(0)).collect() == []
    assert [r["doc_id"] for r in lexical.search(lexical.build(some), items).orderBy("rank").collect()] == ["a", "b"]


def plain_runs(words, length=6, exponent=4):
    n, out = len(words), set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(length, exponent * q):
                smallest = next(p for p in range(1, q + 1) if all(words[x] == words[x + p] for x in range(i, i + size - p)))
                if smallest == q:
                    out.add((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic(rng, n):
    words = []
    while len(words) < n:
        root = [rng.choice("abc") for _ in range(rng.randint(1, 6))]
        words += (root * rng.randint(1, 9))[: rng.randint(1, 50)]
        words += [rng.choice("abcdefgh") for _ in range(rng.randint(0, 4))]
    return words[:n]


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


@pytest.mark.parametrize("few", [0, 1 / 64, 10])
def test_runs(few, monkeypatch):
    monkeypatch.setattr(repeats, "FEW", few)
    rng = random.Random(3)
    texts = [periodic(rng, rng.randint(0, 150)) for _ in range(120)] + [fibonacci(300), list("a" * 100), list("ab" * 60), list("aabaab" * 20 + "aab"), [], ["a"] * 5, ["a"] * 6]
    coded = [[w.encode() for w in t] for t in texts]
    for length, exponent in ((6, 4), (2, 2), (9, 3)):
        want = [plain_runs(t, length, exponent) for t in texts]
        assert repeats._batch(coded, length, exponent) == want
        assert [repeats._batch([t], length, exponent)[0] for t in coded] == want


def test_moves_are_bounded():
    """A text of one word, and one of a long period, go through all their lengths in a few moves each."""
    for text in (["a"] * 40_000, [str(i % 4_000) for i in range(40_000)]):
        words = [w.encode() for w in text]
        assert repeats._batch([words], 6, 4)[0] == [(0, 40_000, len(set(text)))]


def plain_op12(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    gone = {i for a, m, q in found for i in range(a + q, a + m)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    digests = [hashlib.sha256(s.encode()).hexdigest() for s in ("".join(f"{a},{m},{q}\n" for a, m, q in found), " ".join(w for i, w in enumerate(words) if i not in gone))]
    return (doc_id, len(found), *top, 1000 * top[1] // top[2] if found else None, *digests)


def test_periodic_runs_query(spark, tmp_path):
    rng = random.Random(8)
    texts = [" ".join(periodic(rng, rng.randint(0, 90))) for _ in range(150)] + [None, "", " \n", "x", "é ü é ü é ü é ü\té ü", "a  a\na a a a a a"] * 10
    rows = [(i, t, "z", 1) for i, t in enumerate(texts)] + [(3, texts[3], "z", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, n_runs string, runs int").repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    found = queries.op12_periodic_runs(spark, str(tmp_path))
    assert dict(found.dtypes) | {n: "bigint" for n in names[:6]} == dict(found.dtypes)
    got = sorted((tuple(r[n] for n in names) for r in found.collect()), key=str)
    assert got == sorted((plain_op12(i, t) for i, t, *_ in rows), key=str)
    assert sum(r[1] > 0 for r in got) > 50
    whole = repeats.detect(spark.createDataFrame([(None, "a " * 7), (2, None)], "doc_id long, text string"), batch_words=1).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in whole] == [(None, 7, [(0, 7, 1)], "a"), (2, 0, [], "")]
    assert repeats.detect(spark.createDataFrame([], "doc_id string, text string")).collect() == []


def plain_top(rows, k):
    fine = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) and abs(x) < 7e305 for x in v)]
    out = []
    for q, a in fine:
        if q is not None and q % 50 == 0:
            scores = [(-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b)))), i is None, i) for i, b in fine if i != q]
            out += [(q, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found_top(df):
    return sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("shard,block", [(1, 10**9), (70, 600), (4096, 10**9)])
def test_vector_search(spark, shard, block):
    rng = np.random.default_rng(shard)
    base = rng.normal(size=(6, 12))
    rows = [(i, (base[i % 6] + 0.3 * rng.normal(size=12)).tolist()) for i in range(320)]
    rows += [(400 + i, rows[50][1]) for i in range(9)] + [(50, rows[50][1]), (None, rows[50][1]), (None, rows[50][1]), (450, None), (500, [1.0, None]), (550, [math.nan]), (600, [math.inf]), (650, []), (700, [1.0]), (750, [-0.001] * 12), (-50, [0.5] * 15)]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, score int, `vec.id` int").repartition(3)
    from pyspark.sql import functions as F

    for k in (5, 1000):
        assert found_top(vectors.search(frame, F.col("vec_id") % 50 == 0, k, block, shard, first=4)) == plain_top(rows, k)


def test_vector_search_kinds_and_edges(spark):
    from pyspark.sql import functions as F

    schema = "vec_id long, embedding array<double>"
    for big in (1e3, 1e6, 1e9, 1e12, 1e40, 1e300):
        rows = [(i, [big * ((i * 7 + j) % 11 - 5) for j in range(4)]) for i in range(120)]
        assert found_top(vectors.search(spark.createDataFrame(rows, schema), F.col("vec_id") % 50 == 0)) == plain_top(rows, 5)
    none = spark.createDataFrame([], schema)
    assert vectors.search(none, F.col("vec_id") % 50 == 0).collect() == []
    alone = vectors.search(spark.createDataFrame([(0, [1.0])], schema), F.col("vec_id") % 50 == 0)
    assert alone.collect() == [] and alone.columns == ["query_id", "rank", "vec_id", "score"]


def test_maxscore_reads_less():
    """With a threshold, non-essential terms are read only for the rows that can still win."""
    rng = np.random.default_rng(2)
    scale = np.array([200.0] * 8 + [4.0] * 56)
    rows = np.floor(rng.normal(size=(2000, 64)) * scale).astype(np.int64)
    query = rows[0]
    shard, none = vectors.Shard(rows, [int(abs(x)) for x in query]), np.zeros(2000, dtype=bool)
    exact = rows @ query
    worst = int(np.sort(exact)[-5])
    found, scores, read = shard.best(query, 5, worst, none)
    assert scores == exact[found].tolist() and set(np.flatnonzero(exact >= worst)) == set(found.tolist())
    assert read < 0.4 * rows.size
