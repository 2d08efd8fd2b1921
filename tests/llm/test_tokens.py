"""SentencePiece Unigram, packing: against brute force, the public library and exact round trips."""

import random

import numpy as np
import pytest

from kenning.llm import packing, unigram

ODD = ["", " ", "  a  b ", "▁x▁ y", "日本語 テキスト\n\n\t x", "é" * 300, "🙂🙂 ok", "a" * 1500 + " b", "x\u0000y", "<s> </s> <0x41>", "\n", "tab\tand\r\nlines"]


@pytest.fixture(scope="module")
def model():
    return unigram.load()


def toy():
    pieces = [("<unk>", 0.0, 2)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    return pieces + [(p, s, 1) for p, s in (("▁", -3.0), ("a", -2.0), ("b", -2.5), ("ab", -3.0), ("aba", -3.2), ("▁a", -2.2), ("▁ab", -4.5), ("ba", -3.9), ("é", -4.0))]


def brute(pieces, text):
    """Best score of segmenting the marked text, by trying every split."""
    marked = "▁" + text.replace(" ", "▁") if text else ""
    known = {p: s for p, s, t in pieces if t == 1}
    worst = min(known.values()) - unigram.UNKNOWN_PENALTY
    best = [0.0] + [float("-inf")] * len(marked)
    for j in range(1, len(marked) + 1):
        for i in range(j):
            piece = marked[i:j]
            score = known.get(piece, worst if len(piece) == 1 else float("-inf"))
            best[j] = max(best[j], best[i] + score)
    return best[-1]


def score(m, pieces, ids):
    total, worst, skip = 0.0, m.unknown, 0
    for i in ids:
        if pieces[i][2] == 6:  # bytes of one unknown character
            if skip == 0:
                b = int(pieces[i][0][3:5], 16)
                skip = 0 if b < 0x80 else 1 if b < 0xE0 else 2 if b < 0xF0 else 3
                total += worst
            else:
                skip -= 1
        else:
            total += pieces[i][1]
    return total


def test_viterbi_is_optimal():
    pieces, rng = toy(), random.Random(1)
    m = unigram.Unigram(pieces)
    for _ in range(300):
        text = "".join(rng.choice("ab éz") for _ in range(rng.randrange(1, 14)))
        ids = m.encode(text)
        assert m.decode(ids) == text
        assert abs(score(m, pieces, ids) - brute(pieces, text)) < 1e-9, text


def test_long_segments_take_the_same_path():
    m, rng = unigram.Unigram(toy()), random.Random(2)
    for n in (150, 191, 192, 193, 400):
        text = "".join(rng.choice("abé") for _ in range(n))
        m.known.clear()
        m._chunk([text.encode()])
        short = m.known[text.encode()]
        assert short == m._long(text.encode())


def test_round_trip_and_library(model):
    for text in ODD:
        assert model.decode(model.encode(text)) == text
    sentencepiece = pytest.importorskip("sentencepiece")
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(open(unigram.MODEL, "rb").read())
    proto.trainer_spec.model_type = 1
    scores = dict(zip(model.ids.tolist(), model.scores.tolist(), strict=True))
    for i, p in enumerate(proto.pieces):
        p.score = scores.get(i, p.score)
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    for text in ["The quick brown fox jumps over the lazy dog.", "Einheit über die Straße", "l'été déjà vu, naïve", "x = foo(bar)[3] + 17"]:
        ours, theirs = model.encode(text), library.encode(text)
        assert abs(sum(scores.get(i, 0) for i in ours) - sum(scores.get(i, 0) for i in theirs)) < 1e-3


def test_frames(spark, model):
    rows = [(i, t, "clash", 7) for i, t in enumerate([*ODD, None, ODD[2], ODD[2]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece_ids string, n_pieces int")
    out = {(r.doc_id): r for r in unigram.encode_decode(df, model).collect()}
    assert all(out[i].round_trip for i, t in enumerate(ODD)) and out[len(ODD)].round_trip is None and out[len(ODD)].piece_ids is None
    assert out[0].n_pieces == 0
    kept = unigram.with_pieces(df, model)
    assert kept.count() == len(rows) and set(kept.columns) == {"doc_id", "text", "piece_ids", "n_pieces", "round_trip"}
    back = unigram.decode(unigram.encode(df, model), model).collect()
    assert all(r.decoded == r.text for r in back)
    assert unigram.encode_decode(df.limit(0), model).count() == 0
    assert model.decode([-5, 10**6]) == ""


def test_best_fit_decreasing():
    rng = random.Random(3)
    for _ in range(40):
        cap = rng.choice([1, 7, 64])
        sizes = [rng.randint(1, cap) for _ in range(rng.randrange(60))]
        places, rows = packing.best_fit_decreasing(sizes, cap)
        free, order = [], sorted(range(len(sizes)), key=lambda k: -sizes[k])
        for k in order:  # plain best fit decreasing
            fits = [r for r in range(len(free)) if free[r] >= sizes[k]]
            least = min((free[r] for r in fits), default=None)
            if least is None:
                free.append(cap - sizes[k])
            else:
                free[next(r for r in fits if free[r] == least)] -= sizes[k]
        assert rows == len(free)
        used = {}
        for k, (row, start) in enumerate(places):
            used.setdefault(row, []).append((start, start + sizes[k]))
        for spans in used.values():
            spans.sort()
            assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False)) and spans[0][0] == 0 and spans[-1][1] <= cap


def test_packing_round_trip(spark):
    tokens = packing.load()
    texts = ["hello world  \n\n x", "", None, "word " * 700, "don't stop 123 é🙂 \x1c y　z", "word " * 700, "a"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(6, "a", "again")], "doc_id long, text string, bundle string")
    folder = packing.new_path(spark, "t")
    index = packing.write(df.coalesce(2), tokens, folder, 64, 300)
    out = packing.read(spark, folder, index, "bigint", 64).collect()
    assert sorted(r.doc_id for r in out) == [0, 1, 2, 3, 4, 5, 6, 6]
    tokens.encode("")
    for r in out:
        want = tokens.coder.encode_ordinary(texts[r.doc_id] or "")
        base = folder.removeprefix("file://") + f"/{r.bundle}/ids.bin"
        flat = np.fromfile(base, dtype="<u2")
        got = np.concatenate([flat[p.row * 64 + p.start :][: p.length] for p in r.placements]) if r.placements else np.zeros(0)
        assert got.tolist() == want and r.n_tokens == len(want)
        assert tokens.decode(got.astype(int)) == (texts[r.doc_id] or "")
    assert packing.pack(df.limit(0), tokens).count() == 0
