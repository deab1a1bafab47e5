"""Process functions in batch, timers, connected streams, typed outputs, staging and numbered lines."""

import random
import sys

import pytest
from conftest import ts
from pyspark import cloudpickle
from pyspark.sql import functions as F

from eventlens.operators.process import process
from eventlens.session import scratch_path
from eventlens.sources.outputs import committed, read_output, write_outputs
from eventlens.sources.parsers import parse_logins
from eventlens.sources.sinks import console_sink
from eventlens.sources.text import read_lines_stream, read_numbered_lines
from eventlens.streaming import machines as M
from eventlens.streaming.bounded import stage, staged_stream
from eventlens.streaming.connect import CoMachine, connect
from eventlens.streaming.runner import run_once

US = 1_000_000

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import a test


class Log(M.Timers):
    """Two timers a row; the log shows the order in which things happen."""

    fields = ("v",)
    out_fields = (("what", "string"), ("at_ts", "long"))

    def on_row(self, c, r):
        self.register(c, "b", r["ts"] + 5 * US)
        self.register(c, "a", r["ts"] + 5 * US)
        if r["v"] == 0:
            self.delete(c, "b")
        return [{"what": f"row {r['v']}", "at_ts": r["ts"]}]

    def on_timer(self, c, name, at):
        if name == "a":
            self.register(c, "again", at + 2 * US)
        return [{"what": name, "at_ts": at}]


def test_timers_fire_in_order_and_after_rows_of_their_instant(spark):
    df = spark.createDataFrame([("k", ts(0), 1, 1), ("k", ts(5), 2, 0), ("k", ts(20), 3, 4), (None, ts(1), 1, 9)], "k string, t timestamp, s long, v int")
    got = [(r.k, r.what, r.at_ts) for r in process(df, ["k"], "t", "s", Log(), {"v": F.col("v")}).collect()]
    assert [x[1:] for x in got if x[0] == "k"] == [("row 1", ts(0)), ("row 0", ts(5)), ("a", ts(10)), ("again", ts(12)), ("row 4", ts(20)),
                                                    ("a", ts(25)), ("b", ts(25)), ("again", ts(27))]
    assert [x[1] for x in got if x[0] is None] == ["row 9", "a", "b", "again"]


@pytest.mark.parametrize("split", [40, 7])
def test_hot_keys_in_slices_give_the_same_rows(spark, split):
    rng = random.Random(split)
    rows = [(rng.choice(["hot", "hot", "hot", None, "x"]), ts(rng.randrange(400)), i, rng.randrange(3)) for i in range(260)]
    df = spark.createDataFrame(rows, "k string, t timestamp, s long, v int").repartition(3)
    for machine, payload in ((Log(), {"v": F.col("v")}), (M.MatchOutcomes(20 * US, 10 * US), {"cr": F.col("v") == 0})):
        whole = process(df, ["k"], "t", "s", machine, payload)
        cut = process(df, ["k"], "t", "s", machine, payload, split_rows=split)
        assert sorted(map(repr, cut.collect())) == sorted(map(repr, whole.collect()))
    assert process(df.limit(0), ["k"], "t", "s", Log(), {"v": F.col("v")}).count() == 0


def _source(spark, name, batches, schema):
    path = scratch_path(spark, name)
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{i:03d}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)


class Balance(CoMachine):
    """Orders raise, payments lower; an account that is unpaid for ten seconds is told once."""

    out = (("what", "string"), ("amount", "long"))

    def on_left(self, c, row, ts, home):
        c["open"] = c.get("open", 0) + row["price"]
        c.setdefault("since", ts)
        return []

    def on_right(self, c, row, ts, home):
        c["open"] = c.get("open", 0) - row["paid"]
        out = [{"what": "paid", "amount": row["paid"]}]
        if c["open"] <= 0:
            c.clear()
        return out

    def advance(self, c, wm):
        if c.get("since") is not None and c["since"] + 10 * US < wm:
            c["since"] = None
            return [{"what": "unpaid", "amount": c["open"]}]
        return []

    def deadline(self, c):
        return c["since"] + 10 * US + 1 if c.get("since") is not None else None


def test_two_streams_share_a_state_with_timers(spark):
    orders = _source(spark, "orders", [[("a", ts(1), 5), (None, ts(2), 7)], [("b", ts(30), 1)], [("end", ts(9000), 0)]], "account string, o_ts timestamp, price long")
    pays = _source(spark, "pays", [[("a", ts(4), 5)], [(None, ts(40), 7)], [("end", ts(9000), 0)]], "payer string, p_ts timestamp, paid long")
    s = connect(orders, pays, ["account"], ["payer"], "o_ts", "p_ts", Balance(), "0 seconds")
    got = sorted((repr(r.account), r.what, r.amount) for r in run_once(s, "balance").collect() if r.account != "end")
    assert got == sorted([("'a'", "paid", 5), ("None", "unpaid", 7), ("None", "paid", 7), ("'b'", "unpaid", 1)])


def test_a_hot_key_is_spread_over_time(spark):
    from eventlens.operators.joins import reconcile
    from eventlens.streaming.joins import stream_reconcile
    rng = random.Random(3)
    left = [(rng.choice(["hot", "hot", "k", None]), ts(rng.randrange(600)), i) for i in range(120)]
    right = [(rng.choice(["hot", "hot", "k", None]), ts(rng.randrange(600)), i) for i in range(120)]
    ls, rs = "lk string, lt timestamp, li long", "rk string, rt timestamp, ri long"
    end = [[("end", ts(10**6), -1)]]
    s = stream_reconcile(_source(spark, "l", [left, *end], ls), _source(spark, "r", [right, *end], rs), "lk", "rk", "lt", "rt", "20 seconds")
    want = reconcile(spark.createDataFrame(left, ls), spark.createDataFrame(right, rs), "lk", "rk", "lt", "rt", tolerance="20 seconds")
    got = [r for r in run_once(s, "hot-pairs").collect() if r.key != "end"]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, want.collect())))


def test_half_a_batch_is_not_read_and_a_retry_does_not_duplicate(spark):
    root = scratch_path(spark, "typed")
    batch = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x")], "n long, s string")
    outputs = {"big": (F.col("n") > 1, [F.col("n")]), "named": (F.col("s") == "x", [F.col("s"), (F.col("n") * 2).cast("double").alias("twice")]), "never": (F.lit(False), [F.col("n")])}
    write_outputs(batch, 0, outputs, root)
    spark.createDataFrame([("big", (99,))], "output string, big struct<n:long>").write.partitionBy("output").parquet(f"{root}/data/batch=1")  # no commit record
    write_outputs(batch, 0, outputs, root)
    assert committed(spark, root) == [0]
    assert sorted(r.n for r in read_output(spark, root, "big", "n long").collect()) == [2, 3]
    assert sorted(map(tuple, read_output(spark, root, "named", "s string, twice double").collect())) == [("x", 2.0), ("x", 6.0)]
    assert read_output(spark, root, "never", "n long").count() == 0
    write_outputs(batch, 1, outputs, root)  # the retry overwrites what the lost run left
    assert sorted(r.n for r in read_output(spark, root, "big", "n long").collect()) == [2, 2, 3, 3]


def test_folders_are_staged_by_many_tasks_and_read_in_order(spark, monkeypatch):
    from eventlens.streaming import bounded
    monkeypatch.setattr(bounded, "FILE_ROWS", 40)
    rows = [(i, ts(i)) for i in range(600)] + [(1000, None)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp").repartition(3)
    path = scratch_path(spark, "staged")
    parts = stage(df, "ts", path, [{"event_id": -1}])
    assert parts == 5
    seen = []
    stream = staged_stream(spark, df.schema, path, parts)
    stream.writeStream.foreachBatch(lambda b, i: seen.append(sorted(r.event_id for r in b.collect()))).trigger(availableNow=True).option(
        "checkpointLocation", scratch_path(spark, "staged-ckpt")).start().awaitTermination()
    assert [len(x) for x in seen] == [201, 200, 200, 1] and seen[0][:200] == list(range(200)) and seen[3] == [-1]


def test_line_numbers_do_not_depend_on_the_split_size(spark):
    path = scratch_path(spark, "lines")
    lines = [f"{i % 7},10.0.0.1,{'fail' if i % 3 else 'success'},{1558430842 + i // 4}" for i in range(4000)]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{path}/a")
    spark.createDataFrame([(x,) for x in lines[:50]], "value string").coalesce(1).write.text(f"{path}/b")
    sizes = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(sizes)
    try:
        for size in ("128m", "9000b", "70000b"):
            spark.conf.set(sizes, size)
            got = read_numbered_lines(spark, [f"{path}/a", f"{path}/b"])
            by_file = {}
            for r in got.collect():
                by_file.setdefault(r.file, []).append((r.line, r.value))
            assert sorted(len(x) for x in by_file.values()) == [50, 4000]
            for x in by_file.values():
                assert sorted(x) == list(enumerate(lines[:len(x)]))
            stream = read_lines_stream(spark, f"{path}/a", numbered=True)
            rows = sorted((r.seq, r.value) for r in run_once(stream, "numbered").collect())
            assert [v for _, v in rows] == lines or size == "9000b"  # blocks of under 64 KB share a number
    finally:
        spark.conf.set(sizes, before)


def test_a_line_is_split_once(spark):
    df = spark.createDataFrame([("1,2.2.2.2,fail,1558430842", 0), ("short", 1), (None, 2)], "value string, seq long")
    out = parse_logins(df, on_error="drop")
    assert out.collect()[0].user_id == 1 and out.count() == 1
    assert out._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    with pytest.raises(Exception, match="malformed line"):
        parse_logins(df).collect()


def test_console_shows_a_labelled_table(spark, capfd):
    df = spark.range(5)
    console_sink(df, "five rows")
    out = capfd.readouterr().out
    assert "== five rows ==" in out and "|4" in out.replace(" ", "")
    console_sink(df, "few", n=2)
    assert "== few: only the first 2 rows are shown ==" in capfd.readouterr().out
