"""Driver-table queries of user-written aggregates, refined rankings and windows with many overlaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlens.operators.aggregates import Aggregate, aggregate_windows
from eventlens.operators.overlaps import window_changes
from eventlens.operators.windows import window_counts, window_distinct, window_sum
from eventlens.plans.catalog import (
    DISORDER, ORACLE, _K_SQL, _LATE_SQL, _event_stream, _late, _long_k, _run, _to_ntz, events, query, sql_topn, sql_window_count,
    sql_window_rows)


class Spread(Aggregate):
    """Largest less smallest value; null where all are."""

    def create(self):
        return None

    def add(self, state, v):
        return state if v is None else (v, v) if state is None else (min(state[0], v), max(state[1], v))

    def merge(self, state, other):
        return state if other is None else other if state is None else (min(state[0], other[0]), max(state[1], other[1]))

    def result(self, state):
        return None if state is None else state[1] - state[0]


class Count(Aggregate):
    """Rows, as the reference's incremental count."""

    def create(self):
        return 0

    def add(self, state, *values):
        return state + 1

    def merge(self, state, other):
        return state + other


class CountAndSum(Aggregate):
    """Two results of one state: ``n`` values, their sum, and the number of nulls."""

    returns = "struct<n:long,total:long,nulls:long>"

    def create(self):
        return [0, 0, 0]

    def add(self, state, v):
        if v is None:
            state[2] += 1
        else:
            state[0] += 1
            state[1] += v
        return state

    def merge(self, state, other):
        return [a + b for a, b in zip(state, other)]

    def result(self, state):
        return dict(zip(("n", "total", "nulls"), state))


# every seventh k is null
_NULL_K = f"CASE WHEN event_id % 7 = 0 THEN NULL ELSE {_K_SQL} END"


def _with_k(ev):
    return ev.withColumn("k", F.when(F.col("event_id") % 7 != 0, _long_k()))


def _spread_sql(size: str, slide: str | None = None) -> str:
    return (f"SELECT window_start, window_end, event_type, max(k) - min(k) AS spread FROM ("
            f"{sql_window_rows(f'event_type, {_NULL_K} AS k', 'true', size, slide)}) GROUP BY window_start, window_end, event_type")


@query("custom_aggregate_daily", f"""
SELECT window_start, window_end, event_type, max(k) - min(k) AS spread FROM (
  {sql_window_rows(f'event_type, {_K_SQL} AS k', 'true', '1 day')}) GROUP BY window_start, window_end, event_type""")
def custom_aggregate_daily(spark, sf_dir):
    """A1 by a user's own aggregate that merges: spread of k per type and day."""
    return aggregate_windows(events(spark, sf_dir).withColumn("k", _long_k()), "ts", "1 day", None, ["event_type"], ["k"], Spread(), "spread")


@query("custom_aggregate_sliding", _spread_sql("1 hour", "1 minute"))
def custom_aggregate_sliding(spark, sf_dir):
    """The same over 60 overlaps, nulls included: states are merged by blocks, not per window."""
    return aggregate_windows(_with_k(events(spark, sf_dir)), "ts", "1 hour", "1 minute", ["event_type"], ["k"], Spread(), "spread")


@query("custom_aggregate_struct", f"""
SELECT window_start, window_end, count(k) AS n, CAST(coalesce(sum(k), 0) AS BIGINT) AS total, count(*) - count(k) AS nulls FROM (
  {sql_window_rows(f'{_NULL_K} AS k', 'true', '1 day', '6 hours')}) GROUP BY window_start, window_end""")
def custom_aggregate_struct(spark, sf_dir):
    """A2 under one global key with a result of three values."""
    out = aggregate_windows(_with_k(events(spark, sf_dir)), "ts", "1 day", "6 hours", [], ["k"], CountAndSum(), "r")
    return out.select("window_start", "window_end", "r.*")


@query("stream_custom_aggregate", _spread_sql("6 hours", "1 hour"))
def stream_custom_aggregate(spark, sf_dir):
    """The user's aggregate on a stream: states per task and pane, merged in keyed state."""
    from eventlens.streaming.aggregates import stream_aggregate
    s = stream_aggregate(_with_k(_event_stream(spark, sf_dir)), "ts", "6 hours", "1 hour", ["event_type"], ["k"], Spread(), DISORDER, name="spread")
    return _run(s.drop("refined"), "stream_custom_aggregate")


# ---- N2 with T4: early rankings and refinements ------------------------------------------
LATENESS = "60 days"
_PATHS = (_K_SQL, "k")


_RUNS: dict = {}


def _refined(spark, sf_dir) -> str:
    """A run over a stream whose late rows all come with the last folder; where its rankings are.

    Both queries read the one run of a session."""
    from eventlens.session import scratch_path
    from eventlens.streaming.aggregates import start_refined_topn, stream_aggregate
    run = (spark.sparkContext.applicationId, sf_dir)
    if run in _RUNS:
        return _RUNS[run]
    ev = _event_stream(spark, sf_dir, late=_late(spark, sf_dir)).withColumn("k", _long_k())
    counts = stream_aggregate(ev, "ts", "6 hours", "1 hour", ["k"], [], Count(), DISORDER, LATENESS, "cnt")
    out = scratch_path(spark, "hot-paths-refined")
    start_refined_topn(counts.drop("refined"), "k", 5, out, LATENESS).awaitTermination()
    _RUNS[run] = out
    return out


@query("stream_hot_paths_refined", ORACLE["hot_paths_topn"])
def stream_hot_paths_refined(spark, sf_dir):
    """N2 with T4: windows are ranked early and again after late rows; the newest ranking is the whole answer."""
    from eventlens.streaming.aggregates import newest_rankings
    return _to_ntz(newest_rankings(spark, _refined(spark, sf_dir)))


_EARLY = sql_topn(sql_window_count(*_PATHS, f"NOT ({_LATE_SQL})", "6 hours", "1 hour"), "k", 5)
_LATE_WINDOWS = f"SELECT DISTINCT window_end FROM ({sql_window_rows('1 AS one', _LATE_SQL, '6 hours', '1 hour')})"
_EARLY_WINDOWS = f"SELECT DISTINCT window_end FROM ({sql_window_rows('1 AS one', f'NOT ({_LATE_SQL})', '6 hours', '1 hour')})"


@query("stream_hot_paths_versions", f"""
SELECT 1 AS version, * FROM ({_EARLY})
UNION ALL
SELECT CASE WHEN window_end IN ({_EARLY_WINDOWS}) THEN 2 ELSE 1 END AS version, *
FROM ({ORACLE["hot_paths_topn"]}) WHERE window_end IN ({_LATE_WINDOWS})""")
def stream_hot_paths_versions(spark, sf_dir):
    """The change log of the same run: each window's first ranking, and its refinement where late rows came."""
    from eventlens.streaming.aggregates import ranking_log
    log = ranking_log(spark, _refined(spark, sf_dir))
    order = log.select("window_end", "batch").distinct().groupBy("window_end").agg(F.sort_array(F.collect_list("batch")).alias("all")).hint("shuffle_merge")
    return _to_ntz(log.join(order, "window_end").withColumn("version", F.array_position("all", F.col("batch")).cast("int")).drop("batch", "all"))


# ---- W1 and A5 at the reference's own overlaps -------------------------------------------


def _changes_sql(key: str, where: str, size: str, slide_s: int) -> str:
    """Stretches of equal counts, from every window counted one by one."""
    keys = f"{key}, " if key else ""
    of = f"PARTITION BY {key} " if key else ""
    rows = sql_window_rows(f"{key}" if key else "1 AS one", where, size, f"{slide_s} seconds")
    return f"""
WITH each AS (SELECT {keys}window_start AS s, window_end AS e, count(*) AS cnt FROM ({rows}) GROUP BY ALL),
step AS (SELECT *, CASE WHEN lag(s) OVER w = s - INTERVAL {slide_s} SECOND AND lag(cnt) OVER w = cnt THEN 0 ELSE 1 END AS new
         FROM each WINDOW w AS ({of}ORDER BY s)),
run AS (SELECT *, sum(new) OVER ({of}ORDER BY s) AS r FROM step)
SELECT min(s) AS first_start, max(s) AS last_start, min(e) AS first_end, max(e) AS last_end, {keys}cnt FROM run GROUP BY {keys}r, cnt"""


@query("region_changes_720", _changes_sql("event_type", "true", "1 hour", 5))
def region_changes_720(spark, sf_dir):
    """W1 A1 with the reference's 720 overlaps (1 h / 5 s) per key, as stretches of windows with one count."""
    return window_changes(events(spark, sf_dir), "ts", "1 hour", "5 seconds", ["event_type"], {"cnt": "count"})


@query("path_changes_120", _changes_sql("event_type", "event_type <> 'error'", "10 minutes", 5))
def path_changes_120(spark, sf_dir):
    """W1 A1 with 120 overlaps (10 min / 5 s)."""
    ev = events(spark, sf_dir).filter(F.col("event_type") != "error")
    return window_changes(ev, "ts", "10 minutes", "5 seconds", ["event_type"], {"cnt": "count"})


@query("total_counts_360", f"""
SELECT window_start, window_end, count(*) AS cnt, 'all' AS channel, 'all' AS behavior FROM (
  {sql_window_rows('1 AS one', "event_type <> 'error'", '1 hour', '10 seconds')}) GROUP BY window_start, window_end""")
def total_counts_360(spark, sf_dir):
    """A2 M4 with 360 overlaps (1 h / 10 s), one row per window."""
    ev = events(spark, sf_dir).filter(F.col("event_type") != "error")
    return window_sum(ev, "ts", "1 hour", "10 seconds", name="cnt", labels={"channel": "all", "behavior": "all"})


@query("region_counts_blocks", ORACLE["region_counts_sliding"])
def region_counts_blocks(spark, sf_dir):
    """``region_counts_sliding`` in the block form, row by row."""
    return window_counts(events(spark, sf_dir), "ts", "1 hour", "1 minute", ["event_type"], method="blocks")


@query("unique_users_by_gaps", f"""
SELECT window_start, window_end, count(DISTINCT user_id) AS uv FROM (
  {sql_window_rows('user_id', "event_type = 'view'", '1 hour', '1 minute')}) GROUP BY window_start, window_end""")
def unique_users_by_gaps(spark, sf_dir):
    """A5 over 60 overlaps: distinct users by the gaps between their panes."""
    ev = events(spark, sf_dir).filter(F.col("event_type") == "view")
    return window_distinct(ev, "ts", "1 hour", "1 minute", distinct_col="user_id", name="uv", method="gaps")
