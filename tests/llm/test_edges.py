"""Odd inputs for every training-data operator: clashing and dotted names, string ids, very long and periodic texts; and brute force where tests elsewhere have none."""

import collections
import math
import random
import zlib

import numpy as np
import pytest

from kenning.llm import chat, decontam, langid, packing, pii, quality, sharding, simhash, unigram, warc
from kenning.llm.common import new_path

CLASH = "`a.b` string, __id string, __t string, __text string, __lines string, __quality string, __copy string, c0 string, band string, node string, fp string, spans string, n long"


@pytest.fixture(scope="module")
def model():
    return unigram.load()


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def wide(spark, texts, ids=None):
    """Rows with extra columns whose names clash with what operators use inside."""
    schema = f"{CLASH}, doc_id {'string' if ids and isinstance(ids[0], str) else 'long'}, text string, lang string, source string, n_chars long"
    own = ["x"] * 12 + [7]
    rows = [(*own, i if ids is None else ids[i], t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, schema)


def test_extra_columns_may_have_any_name(spark, model):
    rng = random.Random(1)
    texts = [words(rng, 80), None, "", words(rng, 70) + " me@x.org", words(rng, 60)]
    texts.append(texts[0])
    df = wide(spark, texts)
    bench = spark.createDataFrame([("q1", texts[4], "e"), (None, None, "e")], "item_id string, text string, items string")
    for out in (quality.keep_good(df), simhash.drop_near_copies(df), decontam.drop_contaminated(df, bench), pii.redact(df)):
        assert out.columns == df.columns and out.count() > 0
    assert pii.redact(df).filter("text like '%[EMAIL]'").count() == 1
    assert unigram.with_pieces(df, model).columns == [*df.columns, "piece_ids", "n_pieces", "round_trip"]
    coded = unigram.encode(df, model)
    back = unigram.decode(coded, model)
    assert back.columns == [*df.columns, "piece_ids", "decoded"] and back.filter("NOT decoded <=> text").count() == 0
    assert unigram.encode_decode(df, model).filter("round_trip").count() == 5
    assert pii.find(df).count() == quality.score(df).count() == sharding.shard(df).count() == simhash.near_duplicates(df).count() == packing.pack(df, packing.load()).count() == 6
    assert langid.predict(df, langid.train(df)).count() == 6
    found = {r.doc_id: (list(r.item_ids), r.least_edits) for r in decontam.find(df, bench).collect()}
    assert found == {**{i: ([], None) for i in range(6)}, 4: (["q1"], 0)}


def test_ids_of_other_types(spark):
    rng = random.Random(2)
    texts = [words(rng, 60), "b", None, words(rng, 60)]
    df = wide(spark, texts, ["x", "y", "", "z"])
    assert {r.doc_id for r in simhash.near_duplicates(df).collect()} == {"x", "y", "", "z"}
    assert sorted(r.doc_id for r in sharding.shard(df).collect()) == ["", "x", "y", "z"]
    assert sorted(r.doc_id for r in packing.pack(df, packing.load()).collect()) == ["", "x", "y", "z"]
    assert sorted(r.doc_id for r in simhash.drop_near_copies(df).collect()) == ["", "x", "y", "z"]
    pages = spark.createDataFrame([("a:b/1", "u", "p"), ("Z", "u", "p"), ("", "u", "q"), (None, "u", "q"), ("%", None, None)], "page_id string, url string, html string")
    out = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in warc.archive(pages).collect()}
    assert out == {"a:b/1": ("response", None, 1), "Z": ("revisit", "a:b/1", 1), "": ("response", None, 1), None: ("revisit", "", 1), "%": ("response", None, 0)}


def test_very_long_and_periodic_texts(spark, model):
    rng = random.Random(3)
    long_word, periodic, many = "a" * 300_000, "ab c " * 60_000, words(rng, 60_000)
    noisy = " ".join(f"user{i}@mail.com 10.0.{i % 256}.7 AB-{1000 + i}" for i in range(3000))
    texts = [long_word, periodic, many, noisy, "é" * 50_000, "\n".join(["same line here"] * 20_000)]
    df = wide(spark, texts)
    assert {r.doc_id: r.round_trip for r in unigram.encode_decode(df, model).collect()} == dict.fromkeys(range(6), True)
    spans = {r.doc_id: r for r in pii.find(df).collect()}
    assert spans[3].n_email == 3000 and spans[3].n_ip == 3000 and not spans[0].spans
    stats = {r.doc_id: r for r in quality.score(df).collect()}
    assert (stats[0].n_words, stats[1].n_words, stats[1].n_repeat_words, stats[2].n_words, stats[5].n_dup_lines) == (1, 120_000, 120_000, 60_000, 19_999)
    assert {r.lang_pred for r in langid.predict(df, langid.train(df)).collect()} == {"en"}
    assert simhash.near_duplicates(df).count() == 6 and simhash.drop_near_copies(df).count() == 6
    bench = spark.createDataFrame([(1, many[1000:1200]), (2, "a" * 240), (3, "xyz " * 40)], "item_id long, text string")
    assert {r.doc_id: list(r.item_ids) for r in decontam.find(df, bench).collect()} == {0: [2], 1: [], 2: [1], 3: [], 4: [], 5: []}
    sizes = {r.doc_id: r.n_tokens for r in packing.pack(df, packing.load()).collect()}
    assert all(sizes[i] > 2048 for i in range(6))
    turns = spark.createDataFrame([(1, 0, "user", many), (1, 1, "assistant", periodic)], "conv_id long, turn long, role string, text string")
    assert chat.digest(chat.expand(turns)).first().loss_chars == len(periodic)
    pages = spark.createDataFrame([(1, "u", many), (2, "u", many), (3, "u", long_word)], "page_id long, url string, html string")
    assert sorted(r.payload_bytes for r in warc.archive(pages).collect()) == sorted([len(many), len(many), 300_000])


def test_archives_are_read_by_many_tasks(spark):
    df = spark.createDataFrame([(i, "u", f"page {i} " * 50) for i in range(400)], "page_id long, url string, html string").repartition(40)
    folder = new_path(spark, "w")
    index = warc.write(warc.plan(df), folder)
    bundles = index.select("bundle").distinct().count()
    read = warc.read(spark, folder, index)
    assert bundles == 40 and read.rdd.getNumPartitions() >= 8 and read.count() == 400
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "doc_id long, text string").repartition(30)
    folder = new_path(spark, "p")
    packs = packing.write(docs, packing.load(), folder)
    out = packing.read(spark, folder, packs)
    assert packs.count() == 30 and out.rdd.getNumPartitions() >= 8 and out.count() == 200


def test_user_defined_pieces_are_always_taken():
    sentencepiece = pytest.importorskip("sentencepiece")
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(unigram.MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for k, p in enumerate(proto.pieces):
        if p.type == 1:
            p.score = -math.log(k + 2)
    for text in ("qzx", "hello wor"):
        proto.pieces.add(piece=text.replace(" ", "▁"), score=0.0, type=4)
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    own = unigram.Unigram([(p.piece, p.score, p.type) for p in proto.pieces])
    for text in ("say qzx now", "hello world", "aqzxqzxb"):
        ids = own.encode(text)
        assert own.decode(ids) == text
        pieces = [proto.pieces[i].piece for i in ids]
        assert [p for p in pieces if p in ("qzx", "hello▁wor")] == [p for p in library.encode(text, out_type=str) if p in ("qzx", "hello▁wor")] != []


def test_blocks_of_a_long_segment_don_t_matter(monkeypatch):
    pieces = [("<unk>", 0.0, 2)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] + [(p, s, 1) for p, s in (("▁", -3.0), ("a", -2.0), ("ab", -2.4), ("aba", -3.1), ("bab", -3.3), ("b", -2.2), ("é", -4.0))]
    m, rng = unigram.Unigram(pieces), random.Random(4)
    for n in (1, 7, 60, 400):
        text = "".join(rng.choice("abéz") for _ in range(n)).encode()
        whole = m._long(text)
        for block in (1, 2, 3, 16):
            monkeypatch.setattr(unigram, "BLOCK", block)
            assert m._long(text) == whole
        monkeypatch.undo()


@pytest.mark.parametrize("listed", [pii.LISTED, 0])
def test_pii_context_of_any_form(spark, monkeypatch, listed):
    """Long words before a value, and values in brackets and quotes, are found; tokens of a machine's form alone are not."""
    monkeypatch.setattr(pii, "LISTED", listed)  # patterns in a filter, and joined
    long_word = "x" * 400
    texts = [f"the {long_word} id [u{i}@mail.com] here" for i in range(8)] + [f"a {long_word} id [AB-1234{i}] there" for i in range(3)]
    texts += [f"set token = '{'%040x' % (i * 7919 + 5)}' now" for i in range(8)] + ["token = 'ab12345' too", "commit 0123456789abcdef0123456789abcdef01234567 alone", "TOKEN = 'XY99999'"]
    out = {r.doc_id: r for r in pii.find(wide(spark, texts)).collect()}
    assert all(out[i].n_discovered == 0 and out[i].n_email == 1 for i in range(8))
    for i in (*range(8, 19), 19, 21):
        start = texts[i].index("[") if i < 11 else texts[i].index("'")
        end = texts[i].index("]") if i < 11 else texts[i].rindex("'")
        assert out[i].spans == f"id:{start + 1}:{end}", texts[i][-60:]
    assert out[20].n_discovered == 0
    again = pii.find(wide(spark, texts * 2, [*range(44)])).collect()
    assert {r.doc_id % 22: r.spans for r in again} == {i: r.spans for i, r in out.items()}


def test_places_of_many_matches(spark):
    """More matches than are summed up at a time: as a loop finds them."""
    import re

    text = " ".join(f"a{i}@b.co x" for i in range(3 * pii.RUN + 5))
    want = ",".join(f"email:{m.start()}:{m.end()}" for m in re.finditer(r"a\d+@b\.co", text))
    assert pii.find(wide(spark, [text])).first().spans == want


def test_language_id_against_a_second_implementation(spark):
    """Counts, weights and decoding written again in plain loops give the same labels and scores."""
    rng = random.Random(5)
    alphabet = {"en": "theandofing", "fr": "éelaoustç", "de": "schungdüß"}
    rows = [(i, " ".join("".join(rng.choice(alphabet[g]) for _ in range(rng.randint(2, 6))) for _ in range(rng.choice([3, 40]))), g) for i, g in enumerate(list(alphabet) * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")

    def grams(text):
        raw = b" " + b" ".join(bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in text.lower().encode()).split()) + b" "
        out = collections.Counter()
        for k, n in enumerate(langid.ORDERS):
            for at in range(len(raw) - n + 1):
                value = int.from_bytes(raw[at : at + n], "big")
                out[k, (value * 2654435761 % (1 << 32)) >> 19] += 1
        return out

    langs = sorted(alphabet)
    counts = {g: collections.Counter() for g in langs}
    for i, text, g in rows:
        if zlib.crc32(str(i).encode()) % 4 != 2:
            own = grams(text)
            total = sum(own.values())
            for key, n in own.items():
                counts[g][key] += int(np.rint(n * (1000.0 / math.sqrt(total))))
    share = {g: {k: sum(n for (o, _), n in counts[g].items() if o == k) + 0.5 * langid.BUCKETS for k in range(4)} for g in langs}
    part = lambda g, key: (counts[g][key] + 0.5) / share[g][key[0]]
    code = langid.codewords(3)
    want = {}
    for i, text, _ in rows:
        own = grams(text)
        total = sum(own.values())
        loss = np.zeros(3)
        for column in code.T:
            one = [g for g, c in zip(langs, column, strict=True) if c > 0]
            other = [g for g, c in zip(langs, column, strict=True) if c < 0]
            if not one or not other:
                margin = 0.0
            else:
                margin = sum(n * (math.log(sum(part(g, key) for g in one) / len(one)) - math.log(sum(part(g, key) for g in other) / len(other))) for key, n in own.items()) / total * min(total / 4, langid.SATURATION)
            loss += [math.log1p(math.exp(-c * max(-30, min(30, margin)))) for c in column]
        near = np.exp(-(loss - loss.min()) / code.shape[1] * 4)
        want[i] = (langs[int(loss.argmin())], near.max() / near.sum())
    for r in langid.predict(df, langid.train(df)).collect():
        assert r.lang_pred == want[r.doc_id][0] and abs(r.score - want[r.doc_id][1]) < 1e-6


def test_codewords_of_many_languages_are_apart():
    for n in (8, 61, 90, 150):
        code = langid.codewords(n)
        assert len({tuple(c) for c in code.tolist()}) == n
        apart = (code.shape[1] - code @ code.T) // 2
        assert apart[~np.eye(n, dtype=bool)].min() >= code.shape[1] // 6


def test_line_rule_against_brute_force(spark):
    rng = random.Random(6)
    shared = [words(rng, 8) for _ in range(30)]
    texts, hosts = [], []
    for i in range(160):
        lines = [words(rng, 20) for _ in range(3)] + rng.sample(shared, rng.randint(0, 8))
        rng.shuffle(lines)
        texts.append("\n".join(x.upper() if rng.random() < 0.3 else f" {x} " for x in lines))
        hosts.append(rng.choice(["a", "b", None]))
    texts[7], texts[8], hosts[7], hosts[8] = texts[9], texts[9], hosts[9], hosts[9]  # copies count once
    key = lambda line: " ".join(line.lower().split())
    holders = collections.defaultdict(set)
    for t, h in zip(texts, hosts, strict=True):
        for line in t.split("\n"):
            if key(line):
                holders[h, key(line)].add(t)
    rows = [(i, t, h) for i, (t, h) in enumerate(zip(texts, hosts, strict=True))]
    out = {r.doc_id: r for r in quality.score(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    removed = 0
    for i, t, h in rows:
        over = [x for x in t.split("\n") if len(holders[h, key(x)]) > quality.MIN_DOCS]
        n, gone = len(t.split()), sum(len(x.split()) for x in over)
        assert (out[i].n_removed_lines, out[i].n_left_words) == (len(over), n - gone)
        assert out[i].kept == (not out[i].base_failed and n - gone >= 0.5 * n)
        removed += len(over)
    assert removed > 100
