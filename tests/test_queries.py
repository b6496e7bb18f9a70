"""Every registered query beside its SQL on DuckDB, and the entry."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    return v


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_sql(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    found = duck.execute(entry.oracle_sql()[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in found.fetchall()), key=repr)
    assert got == want


def test_entry_has_rows(spark):
    assert entry.entry(spark).columns == ["domain", "n"]


def test_stream_gives_what_the_replay_gives(spark, sf):
    q = entry.queries()
    key = lambda r: (r["provider"], r["event_id"])
    for stream, replay in (("rate_limit_stream", "rate_limit_replay"), ("circuit_breaker_stream", "circuit_breaker_replay")):
        assert sorted(q[stream](spark, sf).collect(), key=key) == sorted(q[replay](spark, sf).collect(), key=key)


def test_retry_stream_ends_as_the_batch_does(spark, sf):
    q = entry.queries()
    dead = {r["message"] for r in q["retry_stream"](spark, sf).where("state = 'dead'").collect()}
    assert dead == {r["message"] for r in q["retry_dead_letter"](spark, sf).where("dead").collect()}
