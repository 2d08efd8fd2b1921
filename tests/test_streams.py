"""Stateful streams against plain folds, however their rows are cut into batches."""

import random

import pandas as pd
from pyspark.sql import functions as F

from kenning.plans import stream_queries
from kenning.streaming import state, windows


def plain_feed(rows, most_ids, most_entries):
    """rows: (fetched, entry_id, published) of one feed."""
    seen, last, out = [], None, []
    for fetch in sorted({r[0] for r in rows}):
        fresh = []
        for _, i, p in sorted((r for r in rows if r[0] == fetch), key=lambda r: (r[2] is not None, -(r[2] or 0), r[1])):
            if i not in seen and i not in [x[1] for x in fresh] and not (last is not None and p is not None and p <= last):
                fresh.append((fetch, i, p))
        fresh = fresh[:most_entries]
        if fresh:
            out += fresh
            seen = (seen + [x[1] for x in fresh])[-most_ids:]
            last = fetch
    return out


def test_take_new():
    rng = random.Random(6)
    for most_ids, most_entries in ((5, 3), (2000, 50), (1, 1)):
        rows = [(f, f"e{rng.randrange(30)}", rng.choice([None, f - rng.randrange(40)])) for f in range(10, 200, 10) for _ in range(rng.randrange(9))]
        want = plain_feed(rows, most_ids, most_entries)
        for cuts in ([], [100], list(range(0, 200, 10))):
            ids, last, got = [], None, []
            for a, b in zip([0, *cuts], [*cuts, 999], strict=True):
                part = [r for r in rows if a <= r[0] < b]
                frame = pd.DataFrame(part, columns=["fetched", "entry_id", "published"]).astype({"published": "float64"})
                taken, ids, last = state.take_new(frame, ids, last, most_ids, most_entries)
                got += [(int(r.fetched), r.entry_id, None if pd.isna(r.published) else int(r.published)) for r in taken.itertuples()]
            assert got == want and len(ids) <= most_ids


def replay(spark, tmp_path, parts, schema, operator):
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = windows.read(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema)
    windows.drain(operator(stream), f"{tmp_path}/out", f"{tmp_path}/ck")
    return spark.read.parquet(f"{tmp_path}/out").collect()


def test_new_entries_stream(spark, tmp_path):
    rng = random.Random(7)
    rows = [(feed, f, f"e{rng.randrange(25)}", rng.choice([None, f - rng.randrange(30)])) for feed in "ab" for f in range(10, 80, 10) for _ in range(6)]
    parts = [[r for r in rows if r[1] <= 30], [r for r in rows if 30 < r[1] <= 60], [r for r in rows if r[1] > 60]]
    schema = "feed string, fetched long, entry_id string, published long"
    got = replay(spark, tmp_path, parts, schema, lambda s: state.new_entries(s, 8, 4))
    want = [(feed, *x) for feed in "ab" for x in plain_feed([r[1:] for r in rows if r[0] == feed], 8, 4)]
    assert sorted(((r.feed, r.fetched, r.entry_id, r.published) for r in got), key=str) == sorted(want, key=str)


def test_lookback_stream(spark, tmp_path):
    """Late calls are joined within late_turns; the ring stays short."""
    rng = random.Random(8)
    rows = [(s, 100 * k + t, t, rng.random() < 0.3) for k, s in enumerate(("x", "y")) for t in range(40)]
    late = {(s, t) for s, _, t, asked in rows if not asked and t % 7 == 3}
    batch = lambda r: r[2] // 10 + ((r[0], r[2]) in late and r[2] % 10 > 7)
    parts = [[r for r in rows if batch(r) == i] for i in range(5)]
    parts = [p for p in parts if p]
    got = replay(spark, tmp_path, parts, "session_id string, event_id long, turn_index long, is_search boolean", lambda s: state.lookback(s, 3, late_turns=10))
    want = {}
    for s, i, t, _ in rows:
        found = [(u, j) for s2, j, u, asked in rows if s2 == s and asked and t - 3 <= u < t]
        want[s, i] = max(found) if found else (None, None)
    assert {(r.session_id, r.event_id): (r.query_turn, r.query_id) for r in got} == want


def calls(rows):
    return pd.DataFrame(rows, columns=["session_id", "event_id", "turn_index", "is_search"]).astype({"event_id": "int64", "turn_index": "int64"}).assign(has_id=True, has_turn=True)


def test_find_near():
    """Many sessions at once, equal turns and sessions without a name among them, as each by itself."""
    rng = random.Random(9)
    rows = [(rng.choice(["x", "y", "z", None]), 2**60 + i, i // 12, rng.random() < 0.2) for i in range(400)]
    want = {}
    for s, i, t, _ in rows:
        found = [(u, j) for s2, j, u, asked in rows if s2 == s and asked and t - 3 <= u < t]
        want[i] = max(found) if found else (None, None)
    for step in (400, 12, 60):
        held, got = ([], [], [], [], [], []), {}
        for at in range(0, 400, step):
            out, held = state.find_near(calls(rows[at : at + step]), held, 3)
            got |= {int(r.event_id): (None, None) if pd.isna(r.query_id) else (int(r.query_turn), int(r.query_id)) for r in out.itertuples()}
        assert got == want
        assert len(held[0]) == 4 and min(held[4], default=33) > 30
    none = ([], [], [], [], [], [])
    first = state.find_near(calls([("x", 1, 0, True), ("y", 2, 0, True)]), none, 3, 0, 1000, 500)[1]
    out, held = state.find_near(calls([("y", 3, 1, False)]), first, 3, 0, 1600, 500)
    assert held == (["y"], [1], [1600], [0], [0], [2]) and out["query_id"].tolist() == [2]  # x went, y had rows
    out, held = state.find_near(calls([("x", 4, 1, False)]), held, 3, 0, 1700, 500)
    assert out["query_id"].isna().all() and held[0] == ["y", "x"]


def test_lookback_groups(spark, tmp_path):
    """State and calls into Python are by bucket, not by session; ids keep all their digits, a row without one passes."""
    rows = [(f"s{k}", 2**60 + 100 * k + t, t, t == 1) for k in range(60) for t in range(4)]
    odd = [("s0", None, 2, True), (None, 7, 0, True), (None, 8, 1, False), ("s1", 9, None, True)]
    got = replay(spark, tmp_path, [[r for r in rows if r[2] < 2], [r for r in rows if r[2] >= 2] + odd], "session_id string, event_id long, turn_index long, is_search boolean", lambda s: state.lookback(s, 3, buckets=5))
    found = {r.event_id: r.query_id for r in got}
    assert len(got) == 244 and spark.read.format("statestore").load(f"{tmp_path}/ck").count() <= 5
    assert {i: q for i, q in found.items() if q} == {i: i - t + 1 for _, i, t, _ in rows if t > 1} | {8: 7, None: 2**60 + 1}
    assert {7, 9} <= found.keys()


def test_replay_rows_once(spark):
    """Parts are made from rows that are computed once, each written by several tasks and still in one micro-batch."""
    made = spark.sparkContext.accumulator(0)

    def count(x):
        made.add(1)
        return x

    rows = spark.range(0, 800, 1, 4).select(F.udf(count, "long")("id").alias("x"))
    got = stream_queries._replayed(rows, F.col("x") % 2, 2, lambda s: s.withColumn("file", F.input_file_name())).collect()
    assert sorted(r.x for r in got) == list(range(800)) and made.value == 800
    assert len({r.file for r in got}) > 2
