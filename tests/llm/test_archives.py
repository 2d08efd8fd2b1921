"""WARC bundles, chat formatting, the pipeline and the registered queries."""

import collections
import hashlib
import random

import pytest

from kenning.llm import chat, queries, warc
from kenning.llm.common import new_path


def plain_warc(rows):
    groups, out = collections.defaultdict(list), []
    for page_id, _, html in rows:
        groups[html or ""].append(page_id)
    for html, ids in groups.items():
        top, done = max((x for x in ids if x is not None), default=None), False
        for x in ids:
            head = (x, len(html.encode()), warc.digest(html.encode()))
            if top is None or (x == top and not done):
                done = done or x == top
                out.append((*head, "response", None))
            else:
                out.append((*head, "revisit", top))
    return sorted(out, key=str)


def test_warc(spark):
    rows = [(1, "u", "a"), (2, "u", "a"), (2, "v", "a"), (2, "u\n2", "a"), (3, None, None), (4, "x", ""), (None, "z", "q"), (None, "z", "q"), (None, "k", ""), (9, "é", "ü" * 200_000), (9, "é", "other")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, frame int")
    assert sorted([tuple(r) for r in warc.archive(df).collect()], key=str) == plain_warc(rows)
    assert warc.archive(df.limit(0)).count() == 0


def test_warc_lookup_and_limit(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i % 5}</p>" * 2000) for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = new_path(spark, "w")
    index = warc.write(warc.plan(df), folder).collect()
    assert len(index) == 60 and max(r.frame for r in index) >= 0
    for r in random.Random(1).sample(index, 12):
        page, size, _, kind, refers, payload = warc.lookup(folder, r.bundle, r.frame, r.frame_offset)
        assert page == r.page_id and size == len(rows[page][2]) and (kind == "response") == (page >= 55)
        assert payload.decode() == rows[page][2] if kind == "response" else refers == 55 + page % 5
    assert {r.record_type for r in warc.archive(df, least_bytes=10**6).collect()} == {"response"}


def plain_chat(rows):
    by = collections.defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t, role or "", text or ""))
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        yield c, (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat(spark):
    rng, bits = random.Random(2), ["<|im_start|>", "<|im_end|>", "⁠", "<s>", "[INST]", "\n", "a", "\\", "<", "|im_end|>", "=", "🙂", "<<SYS>>"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "odd role\n<s>", None]), rng.choice([None, "".join(rng.choice(bits) for _ in range(rng.randrange(12)))])) for c in range(60) for t in range(rng.randint(1, 7))]
    rows += [(None, 0, "assistant", "x"), (70, 1, "user", "b"), (70, 1, "user", "b"), (70, 1, "assistant", "a")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, example string")
    examples = chat.expand(df)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digest(examples).collect()}
    assert got == dict(plain_chat(rows))
    e = examples.collect()
    assert all(r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == r.example for r in e), "controls inside texts are escaped"
    assert chat.digest(chat.expand(df.limit(0))).count() == 0
    plan = chat.digest(examples)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_registered(spark, name):
    assert queries.queries()[name](spark, "/root/testdata/sf0.001").count() > 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "benchmark_decontamination", "redact_pii", "sentencepiece"]
    rng = random.Random(3)
    text = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 6))) for _ in range(n))
    item, clean = text(50), [text(120) for _ in range(5)]
    rows = [*clean, clean[0], clean[1] + " end", "too short", f"{text(80)} {item}", f"{text(80)} me@x.org"]
    docs = [(i, t, "en", "s", len(t)) for i, t in enumerate(rows)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert sorted(out) == [0, 1, 2, 3, 4, 9] and all(r.round_trip for r in out.values())
    assert out[9].text.endswith("[EMAIL]") and all(out[i].text == clean[i] for i in range(5))
    empty = tmp_path / "none"
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(empty / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(empty / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
