"""Places and windows of keys that are larger than a block, beside a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from epistola.operators import ordinals

SCHEMA = "k long, t long, ok boolean"


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    out = [(7 if i % 3 else r.choice([1, 2, None]), i, None if r.random() < 0.02 else r.random() < 0.7) for i in range(900)]
    out += [(9, 10_000 + i, True) for i in range(60)]  # one run over several blocks
    r.shuffle(out)
    return out


def plain(rows, frame):
    want, keys = {}, {}
    for k, t, ok in sorted(rows, key=lambda x: x[1]):
        keys.setdefault(k, []).append((t, ok))
    for k, seen in keys.items():
        streak = 0
        for i, (t, ok) in enumerate(seen):
            streak = streak + 1 if i and seen[i - 1][1] == ok else 1
            known = [x for _, x in seen[max(0, i - frame + 1) : i + 1] if x is not None]
            want[t] = (k, i + 1, streak, sum(known) / len(known) if known else None)
    return want


@pytest.mark.parametrize("block", [16, 1 << 20])
def test_blocks_give_what_a_loop_gives(spark, rows, block):
    df, want = spark.createDataFrame(rows, SCHEMA), plain(rows, 10)
    n = {r["t"]: (r["k"], r["n"]) for r in ordinals.numbered(df, "k", "t", block=block).collect()}
    assert n == {t: x[:2] for t, x in want.items()}
    streaks = {r["t"]: r["s"] for r in ordinals.run_places(df, "k", ("t",), "s", "ok", block=block).collect()}
    assert streaks == {t: x[2] for t, x in want.items()}
    rates = {r["t"]: r["rate"] for r in ordinals.over_last(df, "k", ("t",), "rate", F.avg(F.col("ok").cast("double")), 10, block=block).collect()}
    assert rates.keys() == want.keys() and all(rates[t] == pytest.approx(x[3]) for t, x in want.items())


@pytest.mark.parametrize("block", [0, 16])
def test_empty_tables_and_frames_that_are_too_large(spark, block):
    empty = spark.createDataFrame([], SCHEMA)
    assert ordinals.numbered(empty, "k", "t", block=block).columns == ["k", "t", "ok", "n"] and not ordinals.placed(empty, "k", "t").collect()
    with pytest.raises(ValueError):
        ordinals.over_last(spark.createDataFrame([(1, i, True) for i in range(40)], SCHEMA), "k", ("t",), "x", F.count("t"), 30, block=16)
