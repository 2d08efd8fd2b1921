"""Near-dedup, quality, decontamination, PII, language ID, sharding against brute force and edge cases."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import xxhash

from kenning.llm import decontam, graph, langid, pii, quality, sharding, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, component_id int"


def frame(spark, texts, ids=None, lang="en", source="s"):
    rows = [(i if ids is None else ids[i], t, lang, source, len(t or ""), "clash", 3) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def plain_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    shingles = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [b" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_bit_planes():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 256, (20, 8), dtype=np.uint8)
    rows = []
    for b in base:
        for _ in range(9):
            bits = np.unpackbits(b)
            bits[rng.integers(0, 64, rng.integers(0, 6))] ^= 1
            rows.append(np.packbits(bits))
    prints, groups = np.array(rows), np.sort(rng.integers(0, 7, len(rows)))
    planes, bits = simhash.Planes(prints, groups), simhash._bits(prints)
    for radius, s in itertools.product((1, 3, 4, 9), (1, 2, 63, 64, 65, 130)):
        want = {i for i in range(len(rows) - s) if groups[i] == groups[i + s] and (bits[i] != bits[i + s]).sum() <= radius}
        assert set(planes.close(s, radius).tolist()) == want


def test_exact_bands_miss_nothing():
    bands, rng = simhash.exact_bands(4), random.Random(0)
    for _ in range(300):
        flipped = set(rng.sample(range(64), rng.randint(0, 4)))
        assert any(not flipped & set(b.tolist()) for b in bands)


def test_near_duplicates(spark, monkeypatch):
    rng = random.Random(5)
    texts = ["", None, " \n", "one two", "One  two", "x y z w"]
    for _ in range(12):
        w = words(rng, 90).split()
        for _ in range(6):
            v = list(w)
            v[rng.randrange(90)] = "changed"
            texts.append(" ".join(v))
        texts.append(" ".join(w).upper())
    ids = list(range(500, 500 + len(texts)))
    prints = {i: plain_fingerprint(t) for i, t in zip(ids, texts, strict=True)}
    want = components(ids, [(a, b) for a, b in itertools.combinations(ids, 2) if (prints[a] ^ prints[b]).bit_count() <= 4])
    for hot in (4096, 3):  # also with every band cut into chunks
        monkeypatch.setattr(simhash, "HOT", hot)
        out = simhash.near_duplicates(frame(spark, texts, ids)).collect()
        assert {r.doc_id: int(r.fingerprint, 16) for r in out} == prints
        assert {r.doc_id: r.component_id for r in out} == want
    assert simhash.near_duplicates(frame(spark, texts).limit(0)).count() == 0


def test_hot_bands_are_cut_evenly(spark, monkeypatch):
    """Fingerprints that agree in their low bits, as those of a band do, still spread over the chunks."""
    monkeypatch.setattr(simhash, "HOT", 64)
    rows = spark.createDataFrame([(1, i << 22, b"x" * 8) for i in range(512)] + [(2, i, b"y" * 8) for i in range(3)], "band long, node long, fp binary")
    dealt = simhash.deal(rows).collect()
    sizes = collections.Counter((r.band, r.pair) for r in dealt)
    assert sizes.pop((2, 0)) == 3 and max(sizes.values()) <= 3 * 64
    together = collections.defaultdict(set)
    for r in dealt:
        together[r.band, r.pair].add(r.node)
    met = {pair for group in together.values() for pair in itertools.combinations(sorted(group), 2)}
    assert len(met) >= 512 * 511 // 2, "every two rows of the band meet"


def test_drop_near_copies(spark):
    rng = random.Random(6)
    base = [words(rng, 200) for _ in range(6)]
    near = [b + " tail" for b in base[:3]]
    texts = [*base, *near, base[0], base[5], None, None]
    ids = [*range(len(texts) - 2), 40, 40]
    out = simhash.drop_near_copies(frame(spark, texts, ids))
    assert out.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert sorted(r.doc_id for r in out.collect()) == [0, 1, 2, 3, 4, 5, 40]
    assert simhash.drop_near_copies(frame(spark, texts).limit(0)).count() == 0


def test_near_copies_against_brute_force(spark, monkeypatch):
    """Pairs just above and just below 0.8, and short texts: as brute force over the shingle sets joins them, no more and no less."""
    rng = random.Random(16)
    texts = []
    for n in [6, 9, 12, 30, 60, 120, 500] * 12:
        w = words(rng, n).split()
        texts.append(" ".join(w))
        # Of m shingles a share x is common to texts that differ in their ends: m (1 - x) / (1 + x) words of each.
        for x in (0.86, 0.81, 0.78, 0.7, 0.6):
            k = round((n - 4) * (1 - x) / (1 + x))
            texts.append(" ".join(w[: n - k] + words(rng, k).split()))
    middle = words(rng, 150).split()
    texts += [" ".join(words(rng, 14).split() + middle + words(rng, 14).split()) for _ in range(40)]  # a template: about 0.68
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.lower().split() for t in texts)]
    pairs = [(i, j, len(a & b) / len(a | b)) for (i, a), (j, b) in itertools.combinations(enumerate(sets), 2) if a & b]
    want = set(components(range(len(texts)), [(i, j) for i, j, x in pairs if x >= 0.8]).values())
    assert sum(0.8 <= x < 0.84 for *_, x in pairs) > 50 and sum(0.5 < x < 0.8 for *_, x in pairs) > 500
    for rows, block, hot in ((1024, 1024, 4096), (2, 3, 16)):  # also with every group taken as a large one and bands joined as a whole
        monkeypatch.setattr(simhash, "GROUP_ROWS", rows)
        monkeypatch.setattr(simhash, "BLOCK_ROWS", block)
        monkeypatch.setattr(simhash, "HOT", hot)
        got = {r.doc_id for r in simhash.drop_near_copies(frame(spark, texts)).collect()}
        assert got == want, (len(want - got), len(got - want))


def test_components_of_a_path(spark):
    n = 60
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101), (7, 7)], "a long, b long")
    out = {r.node: r.root for r in graph.connected_components(edges).collect()}
    assert out == {**{i: 0 for i in range(n + 1)}, 100: 100, 101: 100}


def plain_quality(text):
    ws = "[^\x20\x09-\x0d]+"
    w = re.findall(ws, text or "")
    lines = (text or "").split("\n")
    dup = sum(1 for i, x in enumerate(lines) if re.search(ws, x) and x in lines[:i])
    grams = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    inside = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text or "")), dup, len(inside), failed


def test_quality_base(spark):
    rng = random.Random(7)
    texts = [None, "", "a b c\x1cd", "é ü\n\n#|<x>\né ü\n é ü", " ".join("abc"[rng.randrange(3)] for _ in range(80)), words(rng, 70), "x y z " * 30, "a b c\n" * 3]
    out = {r.doc_id: r for r in quality.score(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        r = out[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_quality(t), t
        assert r.kept == (not r.base_failed)
    assert quality.score(frame(spark, texts).limit(0)).count() == 0


def test_quality_frequent_lines(spark):
    rng = random.Random(8)
    footer = "All rights  reserved on this site"
    own = [words(rng, 60) for _ in range(40)]
    texts = [f"{t}\n{footer.upper() if i % 2 else footer}" for i, t in enumerate(own)]
    poor = [words(rng, 10) + "\n" + "\n".join(f"menu entry number {k} of the long navigation list" for k in range(9)) + f"\n{words(rng, 3)}" for _ in range(12)]
    copies = [words(rng, 80)] * 30
    df = frame(spark, [*texts, *poor, *copies, None])
    out = {r.doc_id: r for r in quality.score(df).collect()}
    assert all(out[i].kept and out[i].n_removed_lines == 1 for i in range(40)), "the footer goes, the documents stay"
    assert not any(out[i].kept for i in range(40, 52)), "documents of frequent lines only are depleted"
    assert all(out[i].kept and not out[i].n_removed_lines for i in range(52, 82)), "exact copies count once"
    kept = {r.doc_id: r for r in quality.keep_good(df).collect()}
    assert kept[0].text == own[0] and kept[0].n_chars == len(own[0]) and kept[60].text == copies[0]
    other = quality.score(df.withColumn("source", df.doc_id.cast("string"))).filter("n_removed_lines > 0")
    assert other.count() == 0, "hosts are counted apart"


def test_quality_lines_of_a_large_host(spark, monkeypatch):
    """A line in 11 of 300 documents goes, one in 10 stays; by lists and by the salted join alike."""
    rng = random.Random(18)
    texts = [words(rng, 60) + ("\nshare this page with friends" if i < 11 else "\nanother line of its own" if i < 21 else "") for i in range(300)]
    df = frame(spark, [*texts, texts[0], None])
    df = df.union(df.filter("doc_id < 10").selectExpr("doc_id", "text", "lang", "'small' source", "n_chars", "fingerprint", "component_id"))  # a small host
    df = df.union(df.filter("doc_id < 12 and source = 's'").selectExpr("doc_id", "text", "lang", "cast(null as string) source", "n_chars", "fingerprint", "component_id"))
    want = None
    for listed in (quality.LISTED, 0):
        monkeypatch.setattr(quality, "LISTED", listed)
        out = sorted((r.source or "-", r.doc_id, r.text) for r in quality.keep_good(df).collect())
        assert {(s, i) for s, i, t in out if t.endswith("friends")} == {("small", i) for i in range(10)}
        assert sum(t.endswith("its own") for *_, t in out) == 11 and len(out) == 301 + 10 + 12
        assert want in (None, out)
        want = out


def plain_distance(p, t):
    prev = [0] * (len(t) + 1)
    for i in range(1, len(p) + 1):
        cur = [i]
        for j in range(1, len(t) + 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (p[i - 1] != t[j - 1])))
        prev = cur
    return min(prev)


def test_banded_alignment():
    rng = random.Random(9)
    for _ in range(200):
        p = bytes(rng.choice(b"abc") for _ in range(rng.randint(5, 30)))
        q = bytearray(p)
        for _ in range(rng.randint(0, 5)):
            q[rng.randrange(len(q))] = rng.choice(b"abc")
        t = b"ca" + bytes(q) + b"b"
        want, got = plain_distance(p, t), decontam.edit_distance_within(np.frombuffer(p, np.uint8), np.frombuffer(t, np.uint8), 6)
        assert got[0] == want if want <= 6 else got[0] > 6
        if want <= 6:
            assert plain_distance(p, t[got[1] : got[2]]) == want


def test_decontamination(spark):
    rng = random.Random(10)
    items = [words(rng, 40), words(rng, 140), "tiny one", None, ""]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    edited = items[0].split()
    edited[5] = "zz"
    texts = [f"{words(rng, 30)} {items[0].upper()} {words(rng, 5)}", f"x {' '.join(edited)} y", words(rng, 300), None, "", "a tiny  one here", "tiny ones", f"{words(rng, 9)} {items[1][100:800]}", items[0]]
    df = frame(spark, texts)
    want = {0: [0], 1: [0], 2: [], 3: [], 4: [], 5: [2], 6: [], 7: [1], 8: [0]}
    for limit in (decontam.BLOCK_CHARS, 300):  # one block, many blocks
        out = {r.doc_id: list(r.item_ids) for r in decontam.find(df.union(df.filter("doc_id = 8")), bench, limit=limit).collect()}
        assert out == want
        assert decontam.find(df.union(df.filter("doc_id = 8")), bench, limit=limit).count() == 10
    assert sorted(r.doc_id for r in decontam.drop_contaminated(df, bench).collect()) == [2, 3, 4, 6]
    assert decontam.find(df, bench.limit(0)).filter("contaminated").count() == 0
    assert decontam.find(df.limit(0), bench).count() == 0


def test_every_quote_of_the_stated_length_is_found():
    rng = random.Random(20)
    items = [words(rng, n) for n in (16, 25, 40, 60, 140)]
    block = decontam.Block([(i, p) for i, t in enumerate(items) for p in decontam.passages(t)])
    least = decontam.QUOTE + decontam.STRIDE - 1
    for i, t in enumerate(items):
        for at in range(0, len(t) - least + 1):
            text = f"{words(rng, 8)} {t[at : at + least]} zz {words(rng, 8)}"
            assert {x for x, _ in block.search(text.encode())} == {i}, (i, at)
    assert not list(block.search(words(rng, 2000).encode()))


def test_stated_edit_rate_holds_at_every_length():
    """Edits of characters, of one byte or several, spread as evenly as can be: the worst case for grams."""
    rng = random.Random(21)
    for alphabet in ("abcdefghijklmnop", "aàâeéèêiîoôuûçœß"):
        for m in [*range(12, 140), 200, 240]:
            item = "".join(rng.choice(alphabet) for _ in range(m))
            block, k = decontam.Block([(7, item)]), int(m * 0.07)
            for _ in range(4):
                copy = list(item)
                for j in range(k):
                    copy[(2 * j + 1) * m // (2 * k)] = rng.choice("xyzž日")
                found = list(block.search(f"some words {''.join(copy)} and more".encode()))
                assert found and found[0][0] == 7 and found[0][1] <= k, (m, k)


def test_found_passages_against_brute_force():
    """Every passage within its budget of some region, with its least distance, and no other."""
    rng = random.Random(22)
    items = [" ".join("".join(rng.choice("abcé") for _ in range(rng.randint(2, 5))) for _ in range(rng.randint(4, 14))) for _ in range(12)]
    block = decontam.Block(list(enumerate(items)))
    hits = 0
    for _ in range(60):
        copy = list(rng.choice(items))
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(copy))
            copy[at : at + rng.randint(0, 1)] = rng.choice(["", "z", "bé"])
        text = " ".join(f"{words(rng, 4)} {''.join(copy)} {words(rng, 3)}".split())
        want = {}
        for i, t in enumerate(items):
            if len(t) >= decontam.Q and (d := plain_distance(t, text)) <= decontam.edits_allowed(len(t)):
                want[i] = d
        got = {}
        for i, d in block.search(text.encode()):
            got[i] = min(d, got.get(i, 99))
        assert {i: d for i, d in got.items() if len(items[i]) >= decontam.Q} == want
        hits += len(want)
    assert hits > 20


def test_long_and_periodic_texts_are_searched_in_bounded_memory(monkeypatch):
    monkeypatch.setattr(decontam, "SLICE", 5000)
    monkeypatch.setattr(decontam, "REGION", 2000)
    rng = random.Random(23)
    block = decontam.Block([(1, "a" * 240), (2, "ab cd " * 20 + "x"), (3, "no such passage at all here")])
    assert {i for i, _ in block.search(b"a" * 20_000)} == {1}
    assert {i for i, _ in block.search(b"ab cd " * 3000 + b"ab cd x")} == {2}
    assert {i for i, _ in block.search(b"ab cd " * 3000)} <= {2}
    text = f"{words(rng, 30_000)} {'a' * 240} {words(rng, 30_000)}"
    assert {i for i, _ in block.search(text.encode())} == {1}


def plain_pii(t):
    out = []
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    for n, (kind, p) in enumerate(patterns.items()):
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and (not 14 <= len(d) <= 19 or sum((2 * x - 9 if 2 * x > 9 else 2 * x) if i % 2 else x for i, x in enumerate(map(int, reversed(d)))) % 10):
                continue
            if kind == "phone" and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), n, m.end()))
    return ",".join(f"{pii.KINDS[n]}:{a}:{b}" for a, n, b in sorted(out))


def test_pii_base(spark):
    rng = random.Random(11)
    texts = ["a@b.c%x@d.e.f", "+1 (652) 555-5229 x 4111 1111 1111 1111 and 1.2.3.4.5.6.7.8 300.1.1.1 a.b@c", "é🙂 x@y.zz é +12345678901234 4111-1111-1111-1111,4111111111111112", "a" * 3000 + "@" + "b" * 3000 + ".c", "1 " * 4000, "", None, "1.2.3.4@x.y 00012.1.1.1", "x@y.z@w.v a--@-.-", "10.0.0.7 0.0.0.0 192.168.0.255 1.256.0.1 00.000.010.0255 1.2.3.0300"]
    texts += [".".join(str(rng.choice([0, 1, 9, 10, 99, 100, 199, 200, 249, 250, 255, 256, 300, "00", "007"])) for _ in range(rng.randint(3, 9))) for _ in range(100)]
    texts += ["".join(rng.choice("01 -.@+ab(){}\n") for _ in range(200)) for _ in range(150)]
    out = {r.doc_id: r for r in pii.find(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        assert out[i].base_sha256 == hashlib.sha256(plain_pii(t).encode()).hexdigest(), t
        assert out[i].spans == plain_pii(t) and out[i].n_discovered == 0
    assert pii.find(frame(spark, texts).limit(0)).count() == 0


def test_pii_bootstrapping(spark):
    texts = [f"hello there member number: u{i}@mail.com today" for i in range(12)] + [f"my member number: AB-1234{i} ok" for i in range(3)] + ["a member number: nothing at all", "count 123456 apples", None]
    df = frame(spark, texts)
    out = {r.doc_id: r for r in pii.find(df).collect()}
    assert [out[i].spans for i in (12, 13, 14)] == ["id:18:26"] * 3 and not out[15].spans and not out[16].spans
    safe = {r.doc_id: r for r in pii.redact(df).collect()}
    assert safe[12].text == "my member number: [ID] ok" and safe[12].n_chars == 25
    assert safe[0].text == "hello there member number: [EMAIL] today" and safe[16].text == texts[16] and safe[17].text is None
    assert set(safe[0].asDict()) == {c.split()[0] for c in SCHEMA.split(", ")}


def test_pii_runs_no_python(spark):
    plan = pii.redact(frame(spark, ["a@b.cd"]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_language_id(spark):
    rng = random.Random(12)
    parts = {"en": ["the", "and", "th", "ing", "wh"], "fr": ["é", "eau", "les", "oi", "ç"], "de": ["sch", "ung", "ü", "der", "ß"], "xx": ["q", "zz", "kv", "w"]}
    rows = [(i, " ".join("".join(rng.choice(parts[g]) for _ in range(3)) for _ in range(rng.choice([5, 60]))), g) for i, g in enumerate(list(parts) * 60)]
    rows += [(1000, None, "en"), (1001, "123 ??", "en"), (1002, "²½", "fr"), (1003, "ü", None), (None, "the and", "en"), (3, rows[3][1], "xx")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df)
    assert model.languages == sorted(parts)
    out = langid.predict(df, model).collect()
    told = dict((i, g) for i, _, g in rows[:240])
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 240]
    assert len(held) > 30 and sum(r.lang_pred == told[r.doc_id] for r in held) / len(held) > 0.95
    odd = {r.doc_id: r for r in out}
    assert all(odd[i].lang_pred == "und" and odd[i].score == 0 for i in (1000, 1001, 1002)) and odd[1003].lang_pred in parts
    assert not odd[None].held_out and all(0 <= r.score <= 1 for r in out) and len(out) == len(rows)
    none = langid.train(df.limit(0))
    assert {r.lang_pred for r in langid.predict(df, none).collect()} == {"und"} and langid.predict(df.limit(0), model).count() == 0
    for n in (1, 2, 5, 9, 30):
        code = langid.codewords(n)
        assert len(code) == n and len({tuple(c) for c in code.tolist()}) == n


def plain_jump(key, n):
    key, b, j = key & (1 << 64) - 1, -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & (1 << 64) - 1
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_sharding(spark):
    texts = [f"té{i % 7}" for i in range(800)] + [None, None]
    ids = [*range(-50, 750), 5, None]
    out = sharding.shard(frame(spark, texts, ids).repartition(5), 40).collect()
    assert len(out) == 802
    for r in out:
        assert (r.shard, r.grown_shard) == (plain_jump(r.doc_id or 0, 40), plain_jump(r.doc_id or 0, 41)) and r.grown_shard in (r.shard, 40)
    slots = collections.defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert {r.size for r in out if r.doc_id is None} == {16} and {r.size for r in out if r.doc_id == -50} == {20}
    assert sharding.shard(frame(spark, texts, ids).limit(0), 40).count() == 0
