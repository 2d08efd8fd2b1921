"""Every registered query of the core against its SQL oracle on the smallest fixture."""

import decimal
import math

import pytest

import __spark_entry__
from kenning.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def flat(v):
    if v is None or isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        return "nan" if math.isnan(v) else f"{float(v):.6g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted(tuple(flat(r[c]) for c in columns) for r in df.collect())
    assert name in ORACLES
    out = duck.execute(ORACLES[name])
    names = [d[0] for d in out.description]
    assert sorted(names) == columns
    theirs = sorted(tuple(flat(r[names.index(c)]) for c in columns) for r in out.fetchall())
    assert ours == theirs


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and df.columns == ["tool_name", "outcome_label", "n", "share"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
