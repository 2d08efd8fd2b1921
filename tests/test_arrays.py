"""Elements of JSON arrays that are split anywhere."""

import json
import random

from kenning.sources import arrays


def odd(rng):
    pool = ['"', "\\", "{", "}", "[", "]", ",", "é", "日", "\n", "a", " ", "}}", '\\"']
    text = lambda: "".join(rng.choice(pool) for _ in range(rng.randint(0, 30)))
    return {text(): text(), "id": rng.randint(0, 9), "deep": [{"x": [text(), {"y": {}}]}, [], {}]}


def elements(spark, path):
    rows = arrays.elements(spark, str(path)).orderBy("source_file", "place").collect()
    out = {}
    for r in rows:
        out.setdefault(r.source_file.split("/")[-1], []).append(json.loads(r.value))
    return out


def test_split_anywhere(spark, tmp_path):
    rng = random.Random(4)
    lists = {f"{i}.json": [odd(rng) for _ in range(rng.choice([1, 2, 12]))] for i in range(5)}
    for i, (name, items) in enumerate(lists.items()):
        whole = {"object": "list", "first": {"a": {"b": 1}}, "data": items, "after": {"x": "]"}} if i % 3 == 0 else items
        (tmp_path / name).write_text(json.dumps(whole, ensure_ascii=i % 2 == 0, indent=2 if i % 4 == 0 else None) + "\n" * (i % 2), encoding="utf-8")
    (tmp_path / "none.json").write_text("[]")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("150b", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b")
            assert elements(spark, tmp_path) == lists, size
            assert {r.status for r in arrays.report(spark, str(tmp_path)).collect()} == {"OK"}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_broken_files_beside_good_ones(spark, tmp_path):
    cases = {
        "good.json": '[{"a": 1}, 7, "x", [1, {"no": 2}], {"a": 2}]', "cut.json": '[{"a": 3}, {"a": "}', "brace.json": '[{"a": 4}, {"a": 5', "open.json": '[{"a": 6}', "empty.json": "",
        "bad.json": '[{"a": 7}, {"a" 8}]', "closed.json": '{"data": [{"a": 9}]}', "bare.json": '{"a": {"b": {"c": 1}}}',
    }
    for name, text in cases.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "broken.json.gz").write_bytes(b"\x1f\x8bnot gzip")
    told = {r.source_file.split("/")[-1]: (r.status, r.n_elements, r.n_bad) for r in arrays.report(spark, str(tmp_path)).collect()}
    assert told == {
        "good.json": ("OK", 2, 0), "cut.json": ("TRUNCATED", 1, 0), "brace.json": ("TRUNCATED", 1, 0), "open.json": ("TRUNCATED", 1, 0),
        "bad.json": ("OK", 2, 1), "closed.json": ("OK", 1, 0), "bare.json": ("OK", 0, 0), "broken.json.gz": ("UNREADABLE", 0, 0),
    }


def test_large_array_on_one_line(spark, tmp_path):
    """200 MB on one line: tasks hold a piece and an element at a time, whatever the line's length."""
    import resource

    item = json.dumps({"id": 1, "text": ("x} " + "x" * 1000) * 9}) + ", "
    n = 200_000_000 // len(item)
    with open(tmp_path / "large.json", "w") as f:
        f.write("[")
        for _ in range(n):
            f.write(item)
        f.write('{"id": 2}]')
    before = resource.getrusage(resource.RUSAGE_CHILDREN).ru_maxrss
    found = arrays.elements(spark, str(tmp_path))
    assert found.selectExpr("count(*) AS n", "sum(length(value)) AS m").first().asDict() == {"n": n + 1, "m": n * (len(item) - 2) + 9}
    assert resource.getrusage(resource.RUSAGE_CHILDREN).ru_maxrss - before < 300_000, "KB of the largest worker that has ended"
