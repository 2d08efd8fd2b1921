"""Exact top-k similarity join against brute force; how many rows it joins."""

import random
import re

import pytest

from kenning.operators import similar


def plain_pairs(left, right, top):
    split = lambda t: {w for w in re.split(r"[^\w]+", (t or "").lower()) if len(w) >= 2}
    out = []
    sets = [(i, split(t)) for i, t in right]
    for a, text in left:
        own = split(text)
        found = sorted((-len(own & s) / len(own | s), b, len(own & s)) for b, s in sets if own & s)
        out += [(a, b, n, -score, r) for r, (score, b, n) in enumerate(found[:top], 1)]
    return sorted(out)


def rows_of(df):
    return sorted((r["a"], r["b"], r["shared"], r["score"], r["rank"]) for r in df.collect())


def texts(rng, n, words=400, size=30):
    pool = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    return [" ".join(["common", *rng.choices(pool, weights, k=max(1, int(rng.expovariate(1 / size))))]) for _ in range(n)]


@pytest.mark.parametrize("top", [1, 5, 300])
def test_top_pairs(spark, top):
    rng = random.Random(top)
    right = list(enumerate(texts(rng, 250) + [None, "", "?!", "common", "common w1"] + ["w3 w5 w9 w11"] * 9))
    left = [(i, t) for i, (_, t) in enumerate(right[:12] + right[-12:])] + [(90, "rareword"), (91, "w3 w5 w9 w11 " + " ".join(f"x{i}" for i in range(60)))]
    frame = lambda rows: spark.createDataFrame(rows, "id long, text string")
    assert rows_of(similar.top_pairs(frame(left), frame(right), top)) == plain_pairs(left, right, top)
    assert similar.top_pairs(frame(left), frame([]), top).collect() == [] and similar.top_pairs(frame([]), frame(right), top).collect() == []


def test_joined_rows_grow_with_the_right_side(spark):
    """Prefixes join a small part of what an inverted index joins, and a word of every text adds none of them."""
    rng = random.Random(1)
    left = spark.createDataFrame(list(enumerate(texts(rng, 40, 2000))), "id long, text string")
    both = texts(rng, 6000, 2000)
    counts = [similar.joined_rows(left, spark.createDataFrame(list(enumerate(both[:n])), "id long, text string"), 5) for n in (1500, 6000)]
    assert counts[1]["prefix"] < 0.25 * counts[1]["plain"] and counts[1]["prefix"] < 4.4 * counts[0]["prefix"], counts
    assert counts[1]["candidates"] < 0.1 * counts[1]["plain"], counts
    every = [f"{t} thing" for t in both[:1500]]
    more = spark.createDataFrame([(r["id"], r["text"] + " thing") for r in left.collect()], "id long, text string")
    hot = similar.joined_rows(more, spark.createDataFrame(list(enumerate(every)), "id long, text string"), 5)
    assert hot["plain"] == counts[0]["plain"] + 40 * 1500 and hot["prefix"] < 1.3 * counts[0]["prefix"], (hot, counts)
