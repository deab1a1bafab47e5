"""W1, A1, A2 and A5 with many overlaps: blocks and gaps against the direct form."""

import random
from datetime import timedelta

import pytest
from conftest import ts
from pyspark.sql import functions as F

from eventlens.operators.overlaps import window_changes
from eventlens.operators.windows import choose_method, window_agg, window_distinct

AGGS = {"cnt": "count", "n": ("count", "v"), "total": ("sum", "v"), "low": ("min", "v"), "high": ("max", "v")}


def _events(spark, seed=1, n=220, spread=4000):
    rng = random.Random(seed)
    rows = [(ts(rng.choice([0, 977]) + rng.randrange(spread) + rng.choice([0, 0, 0.25])), rng.choice(["a", "a", "b", None]),
             rng.choice([None, 1, 2, 3, 40]), rng.choice([None, *range(12)])) for _ in range(n)]
    rows += [(None, "a", 5, 1), (ts(20000), "b", None, None), (ts(0), "a", 2, 3)]
    return spark.createDataFrame(rows, "t timestamp_ntz, k string, v int, u int")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("size,slide", [("600 seconds", "5 seconds"), ("70 seconds", "15 seconds"), ("60 seconds", "60 seconds"), ("100 seconds", "7 seconds")])
def test_blocks_equal_the_direct_form(spark, size, slide):
    ev = _events(spark)
    for keys in (["k"], []):
        direct = window_agg(ev, "t", size, slide, keys, AGGS, method="direct")
        assert _rows(window_agg(ev, "t", size, slide, keys, AGGS, method="blocks")) == _rows(direct)


@pytest.mark.parametrize("size,slide", [("600 seconds", "5 seconds"), ("70 seconds", "15 seconds"), ("100 seconds", "7 seconds")])
def test_gaps_equal_the_direct_form(spark, size, slide):
    ev = _events(spark, 2)
    for keys in (["k"], []):
        direct = window_distinct(ev, "t", size, slide, "u", keys, method="direct")
        assert _rows(window_distinct(ev, "t", size, slide, "u", keys, method="gaps")) == _rows(direct)


def test_stretches_are_longest_and_spell_the_windows(spark):
    ev = _events(spark, 3)
    got = window_changes(ev, "t", "600 seconds", "5 seconds", ["k"], AGGS).collect()
    each = []
    for r in got:
        w = r.first_start
        while w <= r.last_start:
            each.append((w, w + timedelta(seconds=600), *r[4:]))
            w += timedelta(seconds=5)
    assert sorted(each, key=repr) == _rows(window_agg(ev, "t", "600 seconds", "5 seconds", ["k"], AGGS, method="direct"))
    ends = {(r.k, r.last_start): r[5:] for r in got}
    for r in got:  # the stretch before, if it touches this one, has other values
        assert ends.get((r.k, r.first_start - timedelta(seconds=5))) != r[5:]


def test_a_steady_key_is_one_stretch_over_many_blocks(spark):
    ev = spark.createDataFrame([(ts(10 * i), "a") for i in range(300)], "t timestamp_ntz, k string")
    got = {r.cnt: r for r in window_changes(ev, "t", "100 seconds", "10 seconds", ["k"]).collect()}
    assert sorted(got) == list(range(1, 11)) and got[10].first_start == ts(0) and got[10].last_start == ts(2900)


def test_rows_shuffled_do_not_grow_with_the_overlaps(spark):
    assert [choose_method("1 hour", s) for s in ("5 minutes", "1 minute", "5 seconds")] == ["panes", "panes", "blocks"]
    ev = _events(spark, 4, 400, 40_000).where("t is not null")
    panes = ev.groupBy(F.floor(F.unix_seconds(F.col("t").cast("timestamp")) / 5), "k").count().count()
    plan = window_agg(ev, "t", "1 hour", "5 seconds", ["k"], method="blocks")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") <= 3 and "Generate explode(sequence" in text
    # two rows per pane and a first one per block reach the second exchange, not 720
    from eventlens.operators import overlaps, windows
    p, kinds = windows.block_panes(ev, "t", 3_600_000_000, 5_000_000, ["k"], None)
    assert p.count() == panes
    assert overlaps.pane_stretches(p, 3_600_000_000, 5_000_000, ["k"], kinds, "_rows").count() <= 4 * panes


def test_empty(spark):
    ev = _events(spark).limit(0)
    assert window_agg(ev, "t", "1 hour", "5 seconds", ["k"]).count() == 0
    assert window_distinct(ev, "t", "1 hour", "5 seconds", "u").count() == 0
    assert window_changes(ev, "t", "1 hour", "5 seconds").count() == 0
