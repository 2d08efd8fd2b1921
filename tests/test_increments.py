"""Clusters that grow by sessions against clustering all of them anew."""

import random

from kenning.operators import fusion, increments, reflux, registry
from tests.test_knowledge import REGISTRY, row

SHAPE = "exp_id long, layer string, service string, cves array<string>, version string, phase string, dimension string, sub_dimension string, lifecycle string"


def plain_components(rows):
    """rows: (exp_id, layer, service, cves, version). Least exp_id of each one's component."""
    family = {"": "", "1.2.3": "1.2.x", "2.0": "2.0.x", "3.1": "3.1.x"}
    root = {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in rows:
        for b in rows:
            fa, fb, ca, cb = family[a[4]], family[b[4]], set(a[3]), set(b[3])
            if a[1:3] == b[1:3] and (fa == fb or not fa or not fb) and (not ca or not cb or ca & cb):
                x, y = find(a[0]), find(b[0])
                root[max(x, y)] = min(x, y)
    return {r[0]: find(r[0]) for r in rows}


def test_every_prefix_of_sessions(spark, tmp_path):
    rng = random.Random(11)
    rows = []
    for i in range(90):
        # Few rows lack a CVE or a version, so that components form late and merge.
        cves = [] if rng.random() < 0.04 else rng.sample([f"CVE-2020-{k}" for k in range(12)], rng.choice([1, 1, 2]))
        rows.append((i, rng.choice(["PROCEDURAL_POS", "CONCEPTUAL"]), rng.choice(["web", "db"]), cves, "" if rng.random() < 0.06 else rng.choice(["1.2.3", "2.0", "3.1"])))
    path, done = f"file://{tmp_path}/clusters", []
    sizes = []
    for start in (0, 40, 60, 90):
        batch = rows[len(done) : start]
        frame = lambda part: spark.createDataFrame([(*r, "", "", "", "active") for r in part], SHAPE)
        increments.extend(spark, path, frame(batch))
        done += batch
        if not done:
            continue
        found = increments.clusters(spark, path, frame(done)).select("exp_id", "cluster_id").collect()
        least = {}
        for r in found:
            least[r.cluster_id] = min(least.get(r.cluster_id, r.exp_id), r.exp_id)
        assert {r.exp_id: least[r.cluster_id] for r in found} == plain_components(done), start
        sizes.append(len(least))
    whole = {r.exp_id: r.cluster_id for r in fusion.clusters(frame(done)).select("exp_id", "cluster_id").collect()}
    assert {r.exp_id: r.cluster_id for r in found} == whole, "the same ids as clustering anew"
    assert any(a > b for a, b in zip(sizes, sizes[1:], strict=False)), f"components have merged: {sizes}"
    before = registry.current(spark, path).count()
    increments.extend(spark, path, spark.createDataFrame([(*r, "", "", "", "active") for r in rows], SHAPE))
    assert registry.current(spark, path).count() == before, "a repeated batch adds nothing"


def test_a_batch_writes_only_what_it_touches(spark, tmp_path):
    rows = [(i, "PROCEDURAL_POS", f"s{i % 40}", [f"CVE-2020-{i}"], "1.2.3") for i in range(400)]
    frame = lambda part: spark.createDataFrame([(*r, "", "", "", "active") for r in part], SHAPE)
    path = f"file://{tmp_path}/clusters"
    increments.extend(spark, path, frame(rows))
    state = registry.current(spark, path)
    joining = [(900, "PROCEDURAL_POS", "s7", ["CVE-2020-7", "CVE-2020-47"], "1.2.3")]
    added = increments.changes(state, fusion.signatures(increments.keyed(frame(joining))), 2)
    assert {r.kind: r["count"] for r in added.groupBy("kind").count().collect()}.get("root", 0) <= 2 and added.count() <= 4
    increments.extend(spark, path, frame(joining))
    near = increments.touched(spark, path, frame(rows), frame(joining))
    assert sorted(r.exp_id for r in near.collect()) == [7, 47]


def test_sessions_with_kept_clusters(spark, tmp_path):
    registry_rows = spark.createDataFrame([row(1, text="scan port host"), row(2), row(9, service="db", text="you should try scan port now")], REGISTRY)
    fresh = spark.createDataFrame([row(3), row(7, layer="PROCEDURAL_NEG", service="db", dimension="ENV", sub_dimension="X", outcome="failure", text="try scan port now")], REGISTRY)
    kept = reflux.on_session(registry_rows, fresh, f"file://{tmp_path}/c")[0].collect()
    assert {r.exp_id: r.lifecycle for r in kept if r.maturity != "consolidated"} == {1: "suspended", 2: "suspended", 3: "suspended", 7: "active", 9: "conflicted"}
    assert [(r.layer, r.service, r.lifecycle) for r in kept if r.maturity == "consolidated"] == [("PROCEDURAL_POS", "web", "active")]
