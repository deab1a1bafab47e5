"""Streams with many keys: keys share the state of their group, and results stay those of single keys."""

import os
from datetime import timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import ts
from eventlens.operators import click_cap
from eventlens.session import STORES, scratch_path
from eventlens.sources.outputs import start_outputs
from eventlens.streaming import (
    stream_capped_window_counts, stream_click_cap, stream_consecutive_pairs, stream_fail_bursts, stream_followed_by, stream_match_outcomes)
from eventlens.streaming import machines as M
from eventlens.streaming.groups import GROUPS, Logic, _decode, packer
from eventlens.streaming.joins import stream_reconcile
from eventlens.streaming.runner import run_once, run_to_parquet
from eventlens.streaming.stateful import MachineRows

KEYS = 8 * GROUPS


def _is(what: str):
    return F.col("what") == what


#: One query of each operator; its findings are named in the commits.
FORMS = {
    "click_cap": lambda s: stream_click_cap(s, ["k"], cap=1),
    "reconcile": lambda s: stream_reconcile(
        s.where(_is("a")).select("k", F.col("ts").alias("l_ts")), s.where(_is("b")).select(F.col("k").alias("r"), F.col("ts").alias("r_ts")),
        "k", "r", "l_ts", "r_ts", "1 hour"),
    "cap_outputs": lambda s: stream_click_cap(s, ["k", "what"], cap=1, carry=[]),
    "fail_bursts": lambda s: stream_fail_bursts(s, ["k"], _is("a"), "1 day", 2),
    "followed_by": lambda s: stream_followed_by(s, ["k"], _is("a"), _is("b"), "1 day"),
    "capped_counts": lambda s: stream_capped_window_counts(s, ["k"], ["what"], "1 hour", cap=1),
    "pairs_2s": lambda s: stream_consecutive_pairs(s, ["k"], _is("a"), "1 day", delay="2 seconds"),
    "pairs": lambda s: stream_consecutive_pairs(s, ["k"], _is("a"), "1 day", delay="1 hour"),
    "click_cap_slices": lambda s: stream_click_cap(s, ["k"], cap=1, slices=4),
    "match_outcomes": lambda s: stream_match_outcomes(s, ["k"], _is("a"), _is("b"), "1 day", "1 day"),
}


def _stream(spark, *batches):
    """Rows (k, what, seconds, seq), a file per micro-batch."""
    path = scratch_path(spark, "groups-in")
    schema = "k long, what string, ts timestamp, seq long"
    for rows in batches:
        rows.write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("form", FORMS)
def test_state_follows_groups_not_keys(spark, form):
    rows = spark.range(KEYS).select(F.col("id").alias("k"), F.lit("a").alias("what"), F.timestamp_seconds(F.lit(1000)).alias("ts"), F.col("id").alias("seq"))
    stream = FORMS[form](_stream(spark, rows.coalesce(1)))
    q = (stream.writeStream.format("noop").option("checkpointLocation", scratch_path(spark, "groups-ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    held = [max(op["numRowsTotal"] for op in p["stateOperators"]) for p in q.recentProgress if p["stateOperators"]]
    assert 0 < max(held) <= 4 * GROUPS  # a buffer, a value and a timer (held twice) each


def test_late_rows_null_and_float_keys(spark):
    """The row at 10 s comes when the watermark stands at 95 s; all others count, also under a null or -0.0 / NaN key."""
    def rows(*r):
        return spark.createDataFrame([(k, "a", ts(s), i) for i, (k, s) in enumerate(r)], "k long, what string, ts timestamp, seq long").coalesce(1)
    end = (-1, 10_000)
    s = _stream(spark, rows((1, 50), (None, 60), (None, 61), (2, 100)), rows((1, 10), (1, 95), (2, 101)), rows(end))
    got = {(r.k, r.first_ts, r.last_ts) for r in run_once(stream_consecutive_pairs(s, ["k"], _is("a"), "1 hour", delay="5 seconds"), "groups-late").collect()}
    assert got == {(1, ts(50), ts(95)), (None, ts(60), ts(61)), (2, ts(100), ts(101))}
    odd = F.when(F.col("k").isNull(), F.lit(float("nan"))).when(F.col("k") == 2, F.when(F.col("seq") == 3, F.lit(-0.0)).otherwise(F.lit(0.0))).otherwise(F.col("k"))
    s = _stream(spark, rows((1, 50), (None, 60), (None, 61), (2, 100)), rows((1, 10), (1, 95), (2, 101)), rows(end)).withColumn("f", odd)
    got = run_once(stream_consecutive_pairs(s, ["f"], _is("a"), "1 hour", delay="5 seconds"), "groups-float").collect()
    assert sorted((r.last_ts - r.first_ts) // timedelta(seconds=1) for r in got) == [1, 1, 45]


def test_late_rows_of_a_group_leave_other_groups_alone(spark):
    """In the fourth micro-batch the even keys' rows are in time and the odd keys' rows late; a task packs both."""
    def rows(*r):
        return spark.createDataFrame([(k, "a", ts(s), i) for i, (k, s) in enumerate(r)], "k long, what string, ts timestamp, seq long").coalesce(1)
    mixed = rows(*((k, s) for k in range(40) for s in ((1500, 1501) if k % 2 == 0 else (10, 11))))
    s = _stream(spark, rows((-1, 1000)), rows((-3, 1001)), rows((-4, 1002)), mixed, rows((-2, 100_000)))
    got = run_once(stream_consecutive_pairs(s, ["k"], _is("a"), "1 hour", delay="5 seconds"), "groups-mixed").collect()
    assert sorted(r.k for r in got) == list(range(0, 40, 2))


def test_packed_rows_bear_a_time_of_their_own():
    b = pa.record_batch([pa.array([1, 2, 3]), pa.array([100, 5, 200]), pa.array([0, 1, 2], pa.int32())], names=["c0", "us", "evl_group"])
    out = pa.Table.from_batches(packer(1)(iter([b])))
    assert list(zip(*(out.column(c).to_pylist() for c in ("evl_group", "us")))) == [(0, 100), (1, 5), (2, 200)]


#: Forms whose state stores are counted, and whether they run into typed outputs; findings are named in the commits.
STORED = {
    "cap_outputs": True,
    "fail_bursts": False,
    "followed_by": True,
    "capped_counts": False,
    "pairs_2s": False,
    "pairs": False,
    "click_cap_slices": False,
    "match_outcomes": False,
}


@pytest.mark.parametrize("form", STORED)
def test_state_stores_follow_slots_not_shuffle_partitions(spark, form):
    """Each store costs a task per micro-batch; shuffle partitions grow with the input."""
    rows = spark.range(20).select(F.col("id").alias("k"), F.lit("a").alias("what"), F.timestamp_seconds(F.col("id")).alias("ts"), F.col("id").alias("seq"))
    stream = FORMS[form](_stream(spark, rows.coalesce(1)))
    ckpt, out = scratch_path(spark, "stores-ckpt"), scratch_path(spark, "stores-out")
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "48")
    try:
        if STORED[form]:
            start_outputs(stream, {"all": (F.lit(True), [F.col("k")])}, out, ckpt).awaitTermination()
        else:
            run_to_parquet(stream, f"stores-{form}", out, ckpt)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "48"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    stores = [len([s for s in os.listdir(f"{ckpt}/state/{op}") if s.isdigit()]) for op in os.listdir(f"{ckpt}/state")]
    assert stores and set(stores) == {STORES * spark.sparkContext.defaultParallelism}


def test_state_of_both_cap_operators_follows_groups(spark):
    """The rows that slices forward meet in groups of keys, too."""
    def at(s, k):
        return spark.range(k).select(F.col("id").alias("k"), F.lit("a").alias("what"), F.timestamp_seconds(F.lit(s)).alias("ts"), F.col("id").alias("seq")).coalesce(1)
    stream = FORMS["click_cap_slices"](_stream(spark, at(1000, KEYS), at(5000, 1), at(9000, 1)))
    q = stream.writeStream.format("noop").option("checkpointLocation", scratch_path(spark, "groups-ckpt")).trigger(availableNow=True).start()
    q.awaitTermination()
    for op in (0, 1):
        held = [p["stateOperators"][op]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
        assert 0 < max(held) <= 4 * GROUPS


def test_cap_in_slices_equals_the_cap(spark):
    """Over days and micro-batches, with null keys, ties of time, null carried values, and rows a fraction of a millisecond apart."""
    rng = np.random.default_rng(3)
    day = 86_400_000_000
    us = np.sort(np.where(rng.random(900) < 0.5, rng.integers(0, 3 * day, 900), day + rng.integers(0, 5_000, 900)))
    rows = [(None if x == 0 else f"k{x}", int(t), i, None if i % 7 == 0 else 2**60 + i) for i, (t, x) in enumerate(zip(us, rng.integers(0, 3, 900)))]
    df = spark.createDataFrame(rows, "k string, us long, seq long, v long").select("k", F.timestamp_micros("us").alias("ts"), "seq", "v")
    path = scratch_path(spark, "slices-in")
    for lo in (0, 300, 600):
        df.where(f"seq >= {lo} AND seq < {lo + 300}").coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([("end", 10 * day, -1, 0)], "k string, us long, seq long, v long").select("k", F.timestamp_micros("us").alias("ts"), "seq", "v").coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = run_once(stream_click_cap(stream, ["k"], cap=20, delay="1 hour", carry=["v"], slices=4), "slices").collect()
    passed, warned = (x.collect() for x in click_cap(df, ["k"], cap=20))
    assert sorted((r.seq, r.k, r.ts, r.v) for r in got if r.tag == "passed") == sorted((r.seq, r.k, r.ts, r.v) for r in passed)
    assert len({r.k for r in got if r.tag == "warning"}) == len({r.k for r in warned}) == 3
    assert len([r for r in got if r.tag == "warning"]) == len(warned)


def _flags(n: int):
    """Columns of true, false and sometimes null."""
    return lambda rng, ts: [pa.array([None if x > 0.95 else bool(x < 0.45) for x in rng.random(len(ts))], pa.bool_()) for _ in range(n)]


def _day(rng, ts):
    return [pa.array(ts // 16 * 16), pa.array([str(x) for x in rng.integers(0, 9, len(ts))])]


def _short(cap: M.Cap) -> M.Cap:
    cap.DAY = 16
    return cap


#: Machines that take a group's rows as columns; findings are named in the commits.
COLUMNS = {
    "followed_by": (M.FollowedBy(15), _flags(2)),
    "capped_counts": (_short(M.Cap(2, ["v"])), _day),
    "pairs_2s": (M.Pairs(2), _flags(1)),
    "pairs": (M.Pairs(15), _flags(1)),
    "click_cap_slices": (_short(M.Cap(1, ["v"])), _day),
    "match_outcomes": (M.MatchOutcomes(10, 8), _flags(1)),
    "match_outcomes_no_grace": (M.MatchOutcomes(10, 0), _flags(1)),
    "match_outcomes_open": (M.MatchOutcomes(10, None), _flags(1)),
}


@pytest.mark.parametrize("form", COLUMNS)
def test_columns_equal_steps(form):
    """The same results and carries as row by row, over micro-batches, with ties and null keys and flags."""
    machine, payload = COLUMNS[form]
    assert M.of_step(machine, "columns") is not None
    logic, found = MachineRows(machine), 0
    schema = pa.schema([("k", pa.string()), ("j", pa.int64()), *((n, pa.int64() if t == "long" else pa.string()) for n, t in machine.out_fields)])

    def bag(t):
        return sorted(t.to_pylist(), key=lambda r: [(v is not None, v) for v in r.values()])

    def live(carries):
        return {k: {n: v for n, v in c.items() if v not in (None, [])} for k, c in carries.items()}
    for seed in range(40):
        rng, whole, single = np.random.default_rng(seed), {}, {}
        for lo in range(0, 240, 40):
            ts_us = rng.integers(lo, lo + 40, int(rng.integers(1, 60)))
            cols = [pa.array(rng.choice(["x", "y", None], len(ts_us))), pa.array(rng.choice([1, 2], len(ts_us))), pa.array(ts_us), pa.array(np.arange(len(ts_us)))]
            cols += payload(rng, ts_us)
            rows = pa.table(cols, names=[f"c{i}" for i in range(len(cols))])
            got = logic.run(whole, rows, 2, 2, schema)
            assert bag(got) == bag(Logic.run(logic, single, rows, 2, 2, schema))
            assert live(whole) == live(single)
            found += got.num_rows
            for carries in (whole, single):
                for k in list(carries):
                    machine.advance(carries[k], lo + 40)
                    if machine.idle(carries[k]):
                        del carries[k]
    assert found


def test_own_step_is_taken_row_by_row():
    class Louder(M.Pairs):
        def step(self, c, r):
            return [{"first_ts": r["ts"], "last_ts": r["ts"]}]
    assert M.of_step(Louder(1), "columns") is None
    rows = pa.table([pa.array([7, 7]), pa.array([1, 2]), pa.array([0, 0]), pa.array([False, False])], names=["k", "ts", "seq", "m"])
    got = MachineRows(Louder(1)).run({}, rows, 1, 2, pa.schema([(n, pa.int64()) for n in ("k", "first_ts", "last_ts")]))
    assert got.to_pylist() == [{"k": 7, "first_ts": t, "last_ts": t} for t in (1, 2)]


def test_rows_that_no_step_reads_only_move_the_time():
    """Of rows (key, time, flag, needed, group), the needed ones are packed; the newest time is that of all."""
    def packed(need):
        b = pa.record_batch([pa.array([1, 2, 3]), pa.array([10, 20, 30]), pa.array(need), pa.array(need), pa.array([0, 1, 0], pa.int32())], names=["c0", "c1", "c2", "c3", "evl_group"])
        out = pa.Table.from_batches(packer(1, 3)(iter([b])))
        return sorted(r["c0"] for x in out.column("rows") for r in _decode(x.as_py()).to_pylist()), max(out.column("us").to_pylist())
    assert packed([True, None, False]) == ([1], 30)
    assert packed([False, None, False]) == ([], 30)


def test_commits_write_changes_not_snapshots(spark):
    rows = spark.range(20).select(F.col("id").alias("k"), F.lit("a").alias("what"), F.timestamp_seconds(F.col("id")).alias("ts"), F.col("id").alias("seq"))
    ckpt, key = scratch_path(spark, "log-ckpt"), "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    was = spark.conf.get(key, None)
    run_to_parquet(FORMS["pairs"](_stream(spark, rows.coalesce(1))), "log", scratch_path(spark, "log-out"), ckpt)
    assert spark.conf.get(key, None) == was
    assert any(f.endswith(".changelog") for f in os.listdir(f"{ckpt}/state/0/0"))
