"""Driver-table queries of process functions, connected streams, typed outputs and text files."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlens.operators.joins import reconcile
from eventlens.operators.limits import click_cap
from eventlens.operators.patterns import consecutive_pairs
from eventlens.operators.process import process
from eventlens.plans.catalog import (
    CAP, DISORDER, ORACLE, RECONCILE_TOLERANCE_SQL, _SECOND_SQL, _clicks_and_buys, _event_stream, _lines, _markers, _run, _seconds, _to_ntz, events, query)
from eventlens.streaming import machines as M

_HOUR = 3_600_000_000
_DAY = 24 * _HOUR


# ---- batch process functions -------------------------------------------------------------


@query("process_pay_match", ORACLE["pay_match_outcomes"])
def process_pay_match(spark, sf_dir):
    """D4 as a keyed process function in batch: the machine that streams run, hot users cut by time."""
    ev = events(spark, sf_dir).filter(F.col("event_type").isin("signup", "purchase"))
    out = process(ev, ["user_id"], "ts", "seq", M.MatchOutcomes(_DAY, _DAY), {"cr": F.col("event_type") == "signup"}, split_rows=50_000)
    return out.select("user_id", "outcome", "create_ts", "pay_ts")


_REMINDERS_SQL = """
WITH x AS (
  SELECT user_id, ts, event_type, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nts
  FROM events WHERE event_type IN ('signup', 'purchase'))
SELECT user_id, 'remind' AS what, ts AS open_ts, ts + INTERVAL 6 HOUR AS at_ts FROM x
WHERE event_type = 'signup' AND (nts IS NULL OR nts > ts + INTERVAL 6 HOUR)
UNION ALL
SELECT user_id, 'expire' AS what, ts AS open_ts, ts + INTERVAL 1 DAY AS at_ts FROM x
WHERE event_type = 'signup' AND (nts IS NULL OR nts > ts + INTERVAL 1 DAY)"""


def _cases(ev):
    return ev.filter(F.col("event_type").isin("signup", "purchase")), {
        "opens": F.col("event_type") == "signup", "closes": F.col("event_type") == "purchase"}


@query("timed_reminders", _REMINDERS_SQL)
def timed_reminders(spark, sf_dir):
    """T5 with two named timers a key, replayed in batch."""
    ev, payload = _cases(events(spark, sf_dir))
    return process(ev, ["user_id"], "ts", "seq", M.Reminders(6 * _HOUR, _DAY), payload)


def _staged_twice(spark, sf_dir, name: str, run):
    """``run(stream, root)`` over the first folder and, after a restart, over all others; the root folder."""
    from eventlens.session import scratch_path
    from eventlens.streaming.bounded import stage, staged_stream
    ev = events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    root = scratch_path(spark, name)
    for part in (range(1), range(1, 4)):
        parts = stage(ev, "ts", f"{root}/in", _markers(spark, sf_dir), disorder=DISORDER, only=part)
        run(staged_stream(spark, ev.schema, f"{root}/in", parts), root)
    return root


@query("stream_timed_reminders", _REMINDERS_SQL)
def stream_timed_reminders(spark, sf_dir):
    """T5 on a stream that stops after the first folder and starts again: both timers go on."""
    from eventlens.streaming.runner import run_to_parquet
    from eventlens.streaming.stateful import replay
    found = []

    def run(stream, root):
        ev, payload = _cases(stream)
        out = replay(ev, ["user_id"], "ts", "seq", DISORDER, M.Reminders(6 * _HOUR, _DAY), payload)
        found.append(run_to_parquet(out, "stream_timed_reminders", f"{root}/out", f"{root}/checkpoint"))
    _staged_twice(spark, sf_dir, "stream_timed_reminders", run)
    return _to_ntz(found[-1])


# ---- two connected streams -----------------------------------------------------------------
_NULLS_SQL = RECONCILE_TOLERANCE_SQL.replace(
    "SELECT user_id, event_id AS click_id, ts AS click_ts FROM",
    "SELECT CASE WHEN event_id % 11 <> 0 THEN user_id END AS user_id, event_id AS click_id, ts AS click_ts FROM").replace(
    "SELECT user_id AS p_user_id, event_id AS purchase_id, ts AS purchase_ts FROM",
    "SELECT CASE WHEN event_id % 7 <> 0 THEN user_id END AS p_user_id, event_id AS purchase_id, "
    "CASE WHEN event_id % 13 <> 0 THEN ts END AS purchase_ts FROM")


def _with_nulls(ev):
    clicks, buys = _clicks_and_buys(ev)
    return (clicks.withColumn("user_id", F.when(F.col("click_id") % 11 != 0, F.col("user_id"))),
            buys.withColumns({"p_user_id": F.when(F.col("purchase_id") % 7 != 0, F.col("p_user_id")),
                              "purchase_ts": F.when(F.col("purchase_id") % 13 != 0, F.col("purchase_ts"))}))


@query("reconcile_nulls", _NULLS_SQL)
def reconcile_nulls(spark, sf_dir):
    """J2 with null keys and times on both sides."""
    clicks, buys = _with_nulls(events(spark, sf_dir))
    return reconcile(clicks, buys, "user_id", "p_user_id", "click_ts", "purchase_ts", tolerance="6 hours")


@query("stream_reconcile_nulls", _NULLS_SQL)
def stream_reconcile_nulls(spark, sf_dir):
    """J2 on two connected streams, with null keys and times on both sides."""
    from eventlens.streaming.joins import stream_reconcile
    clicks, buys = _with_nulls(_event_stream(spark, sf_dir))
    return _run(stream_reconcile(clicks, buys, "user_id", "p_user_id", "click_ts", "purchase_ts", "6 hours", DISORDER, DISORDER), "stream_reconcile_nulls")


# ---- typed outputs of one run (S6) -----------------------------------------------------------


@query("stream_cap_outputs", f"""
SELECT 'passed' AS output, event_id, user_id, event_type, ts, value, CAST(NULL AS VARCHAR) AS msg FROM ({ORACLE["click_cap_passed"]})
UNION ALL
SELECT 'warning' AS output, NULL AS event_id, user_id, event_type, ts, NULL AS value, msg FROM ({ORACLE["click_cap_warnings"]})""")
def stream_cap_outputs(spark, sf_dir):
    """D1 with its side output: one run, stopped and restarted, read back as two tables of different types."""
    from eventlens.sources.outputs import read_output, start_outputs
    from eventlens.streaming.stateful import stream_click_cap

    def run(stream, root):
        s = stream_click_cap(stream, ["user_id", "event_type"], cap=CAP, delay=DISORDER, carry=["event_id", "value"])
        start_outputs(s, {
            "passed": (F.col("tag") == "passed", [F.col(c) for c in ("event_id", "user_id", "event_type", "ts", "value")]),
            "warning": (F.col("tag") == "warning", [F.col("user_id"), F.col("event_type"), F.col("ts"), F.lit(f"click over {CAP} times").alias("msg")]),
        }, f"{root}/out").awaitTermination()
    root = _staged_twice(spark, sf_dir, "stream_cap_outputs", run)
    passed = read_output(spark, f"{root}/out", "passed", "event_id long, user_id long, event_type string, ts timestamp, value double")
    warned = read_output(spark, f"{root}/out", "warning", "user_id long, event_type string, ts timestamp, msg string")
    both = passed.withColumn("output", F.lit("passed")).unionByName(warned.withColumn("output", F.lit("warning")), allowMissingColumns=True)
    return _to_ntz(both.select("output", "event_id", "user_id", "event_type", "ts", "value", "msg"))


@query("stream_pattern_outputs", f"""
SELECT 'matched' AS output, user_id, first_ts, then_ts, CAST(NULL AS VARCHAR) AS reason FROM ({ORACLE["followed_within"]}) WHERE outcome = 'matched'
UNION ALL
SELECT 'timeout' AS output, user_id, first_ts, NULL AS then_ts, 'no purchase within a day' AS reason FROM ({ORACLE["followed_within"]}) WHERE outcome = 'timeout'""")
def stream_pattern_outputs(spark, sf_dir):
    """C2 with its timed-out matches as the second output, restart included."""
    from eventlens.sources.outputs import read_output, start_outputs
    from eventlens.streaming.stateful import stream_followed_by

    def run(stream, root):
        s = stream_followed_by(stream, ["user_id"], F.col("event_type") == "signup", F.col("event_type") == "purchase", "1 day", delay=DISORDER)
        start_outputs(s, {
            "matched": (F.col("outcome") == "matched", [F.col("user_id"), F.col("first_ts"), F.col("then_ts")]),
            "timeout": (F.col("outcome") == "timeout", [F.col("user_id"), F.col("first_ts"), F.lit("no purchase within a day").alias("reason")]),
        }, f"{root}/out").awaitTermination()
    root = _staged_twice(spark, sf_dir, "stream_pattern_outputs", run)
    matched = read_output(spark, f"{root}/out", "matched", "user_id long, first_ts timestamp, then_ts timestamp")
    over = read_output(spark, f"{root}/out", "timeout", "user_id long, first_ts timestamp, reason string")
    both = matched.withColumn("output", F.lit("matched")).unionByName(over.withColumn("output", F.lit("timeout")), allowMissingColumns=True)
    return _to_ntz(both.select("output", "user_id", "first_ts", "then_ts", "reason"))


# ---- a hot key of the click cap ----------------------------------------------------------------
_HOT_CAP = 20
_HOT_SQL = f"""
SELECT event_id, ts, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, date_trunc('day', ts) ORDER BY ts, event_id) AS rn FROM events) WHERE rn <= {_HOT_CAP}"""


@query("click_cap_hot", _HOT_SQL)
def click_cap_hot(spark, sf_dir):
    """D1 where a key holds a fifth of all rows."""
    return click_cap(events(spark, sf_dir), ["event_type"], cap=_HOT_CAP)[0].select("event_id", "ts", "event_type")


@query("stream_click_cap_hot", _HOT_SQL)
def stream_click_cap_hot(spark, sf_dir):
    """The same on a stream: slices of a key forward cap + 1 rows a day, and only those meet in it."""
    from eventlens.streaming.stateful import stream_click_cap
    s = stream_click_cap(_event_stream(spark, sf_dir).select("ts", "seq", "event_id", "event_type"), ["event_type"], cap=_HOT_CAP, delay=DISORDER,
                         carry=["event_id"], slices=16)
    return _run(s.filter(F.col("tag") == "passed").select("event_id", "ts", "event_type"), "stream_click_cap_hot")


@query("stream_page_views_ascending", ORACLE["page_views_hourly"])
def stream_page_views_ascending(spark, sf_dir):
    """Rows in ascending order of time between the micro-batches, no delay."""
    from eventlens.streaming.windows import stream_window_counts
    s = stream_window_counts(_event_stream(spark, sf_dir, "0 seconds").filter(F.col("event_type") == "view"), "ts", "1 hour", delay="0 seconds", name="pv")
    return _run(s, "stream_page_views_ascending")


# ---- text files with line order (S1) -------------------------------------------------------------


@query("text_consecutive_errors", f"""
SELECT user_id, pts AS first_ts, ts AS last_ts FROM (
  SELECT user_id, ts, event_type, lag(event_type) OVER w AS pt, lag(ts) OVER w AS pts
  FROM (SELECT user_id, event_id, event_type, {_SECOND_SQL.format('ts')} AS ts FROM events WHERE event_id % 50 <> 0)
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE event_type = 'error' AND pt = 'error' AND ts < pts + INTERVAL 1 DAY""")
def text_consecutive_errors(spark, sf_dir):
    """S1 R4 D3 over real text files: whole seconds tie, and the line number breaks the ties."""
    from eventlens.session import scratch_path
    from eventlens.sources.parsers import parse_logins
    from eventlens.sources.text import read_numbered_lines
    path = scratch_path(spark, "login-lines")
    ev = events(spark, sf_dir).withColumn("second", _seconds("ts"))
    # a second's rows share a file, in the order of their ids
    placed = ev.repartitionByRange(8, "second").sortWithinPartitions("second", "event_id")
    _lines(placed, ",", "event_id", F.col("user_id"), F.lit("10.0.0.1"), F.col("event_type"), F.col("second")).write.text(path)
    rows = parse_logins(read_numbered_lines(spark, path).withColumn("seq", F.col("line")), on_error="drop")
    out = consecutive_pairs(rows, ["user_id"], F.col("event_type") == "error", "1 day", bucket="1 day")
    return _to_ntz(out)
