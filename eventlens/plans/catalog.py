"""Driver-table queries and their DuckDB oracle SQL.

Each query reads whole driver tables from ``sf_dir``.  The oracle SQL is
an independent brute-force formulation (windows by epoch arithmetic and
``range``, patterns by window functions over the whole key) used only to
check results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.functions.time import duration_us
from eventlens.operators.joins import interval_join, reconcile
from eventlens.operators.limits import click_cap
from eventlens.operators.patterns import consecutive_pairs, fail_bursts, followed_by, match_outcomes
from eventlens.operators.topn import hot_keys, window_report
from eventlens.operators.windows import window_agg, window_counts, window_distinct, window_sum
from eventlens.sources.tables import load_table

QUERIES: dict = {}
ORACLE: dict = {}


def query(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``seq`` = event_id (the tiebreak for equal ts)."""
    return load_table(spark, sf_dir, "events").withColumn("seq", F.col("event_id"))


# --------------------------------------------------------------- SQL helpers
def _us(d) -> int:
    return duration_us(d)


def sql_window_rows(select_cols: str, where: str, size, slide=None, table: str = "events",
                    ts: str = "ts") -> str:
    """Rows of ``table`` expanded to every window [start, start+size) holding them."""
    size_us = _us(size)
    slide_us = _us(slide) if slide else size_us
    k = size_us // slide_us
    start = f"(epoch_us({ts}) // {slide_us}) * {slide_us} - j * {slide_us}"
    return (f"SELECT make_timestamp({start}) AS window_start, "
            f"make_timestamp({start} + {size_us}) AS window_end, {select_cols} "
            f"FROM {table}, range(0, {k}) AS r(j) WHERE {where}")


def sql_window_count(key_sql: str, key_name: str, where: str, size, slide=None, cnt="cnt") -> str:
    keys = f", {key_name}" if key_name else ""
    sel = f"{key_sql} AS {key_name}" if key_name else "1 AS _one"
    return (f"SELECT window_start, window_end{keys}, count(*) AS {cnt} FROM ("
            f"{sql_window_rows(sel, where, size, slide)}) GROUP BY window_start, window_end{keys}")


def sql_topn(counts_sql: str, key: str, n: int) -> str:
    return (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_start, window_end "
            f"ORDER BY cnt DESC, {key} ASC) AS rank FROM ({counts_sql})) WHERE rank <= {n}")


# ------------------------------------------------------------ windows, top-n
HOT_KEYS_SQL = sql_topn(sql_window_count("user_id", "user_id", "event_type = 'view'", "1 day", "6 hours"),
                        "user_id", 3)


@query("hot_keys_topn", HOT_KEYS_SQL)
def hot_keys_topn(spark, sf_dir):
    """Views, per user, 1 day sliding by 6 h, top 3 per window."""
    ev = events(spark, sf_dir).filter(F.col("event_type") == "view")
    return hot_keys(ev, "ts", "user_id", "1 day", "6 hours", 3)


@query("hot_paths_topn", sql_topn(sql_window_count(
        "CAST(json_extract_string(props, '$.k') AS BIGINT)", "k", "true", "6 hours", "1 hour"), "k", 5))
def hot_paths_topn(spark, sf_dir):
    """All events keyed by props.k, 6 h sliding by 1 h, top 5 per window."""
    ev = events(spark, sf_dir).withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    return hot_keys(ev, "ts", "k", "6 hours", "1 hour", 5)


@query("hot_keys_report", f"""
SELECT window_end,
       'time: ' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || chr(10) ||
       string_agg('No.' || rank || ': key=' || user_id || ' count=' || cnt, chr(10) ORDER BY rank)
       || chr(10) AS report
FROM ({HOT_KEYS_SQL}) GROUP BY window_end""")
def hot_keys_report(spark, sf_dir):
    """M5: the ranked text report per window of ``hot_keys_topn``."""
    return window_report(hot_keys_topn(spark, sf_dir), "user_id")


@query("page_views_hourly", sql_window_count("", "", "event_type = 'view'", "1 hour", cnt="pv"))
def page_views_hourly(spark, sf_dir):
    """Hourly page views."""
    ev = events(spark, sf_dir).filter(F.col("event_type") == "view")
    return window_counts(ev, "ts", "1 hour", name="pv")


@query("unique_users_hourly", f"""
SELECT window_start, window_end, count(DISTINCT user_id) AS uv FROM (
  {sql_window_rows('user_id', "event_type = 'view'", '1 hour')}) GROUP BY window_start, window_end""")
def unique_users_hourly(spark, sf_dir):
    """Exact distinct users per hour (no key; two-level aggregate)."""
    ev = events(spark, sf_dir).filter(F.col("event_type") == "view")
    return window_distinct(ev, "ts", "1 hour", distinct_col="user_id", name="uv")


@query("unique_users_sliding", f"""
SELECT window_start, window_end, count(DISTINCT user_id) AS uv FROM (
  {sql_window_rows('user_id', "event_type = 'view'", '1 hour', '5 minutes')}) GROUP BY window_start, window_end""")
def unique_users_sliding(spark, sf_dir):
    """A5 with 12 overlaps: (pane, user) de-duplicated before expansion."""
    ev = events(spark, sf_dir).filter(F.col("event_type") == "view")
    return window_distinct(ev, "ts", "1 hour", "5 minutes", distinct_col="user_id", name="uv")


@query("region_counts_sliding", sql_window_count("event_type", "event_type", "true", "1 hour", "1 minute"))
def region_counts_sliding(spark, sf_dir):
    """W1 A1 with 60 overlaps (pane rollup)."""
    return window_counts(events(spark, sf_dir), "ts", "1 hour", "1 minute", ["event_type"])


@query("channel_counts_sliding", f"""
SELECT window_start, window_end, event_type, k, count(*) AS cnt FROM (
  {sql_window_rows("event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k",
                   "event_type <> 'error'", '1 day', '6 hours')})
GROUP BY window_start, window_end, event_type, k""")
def channel_counts_sliding(spark, sf_dir):
    """F2 M2 A4: per (behavior, channel) = (event_type, k), 1 day sliding by 6 h."""
    ev = (events(spark, sf_dir).filter(F.col("event_type") != "error")
          .withColumn("k", F.get_json_object("props", "$.k").cast("long")))
    return window_counts(ev, "ts", "1 day", "6 hours", ["event_type", "k"])


@query("total_counts_sliding", f"""
SELECT window_start, window_end, count(*) AS cnt, 'all' AS channel, 'all' AS behavior FROM (
  {sql_window_rows('1 AS one', "event_type <> 'error'", '1 hour', '10 minutes')})
GROUP BY window_start, window_end""")
def total_counts_sliding(spark, sf_dir):
    """F2 M1 M4 A2: one global key, 1 h sliding by 10 min, labels 'all'."""
    ev = events(spark, sf_dir).filter(F.col("event_type") != "error")
    return window_sum(ev, "ts", "1 hour", "10 minutes", name="cnt",
                      labels={"channel": "all", "behavior": "all"})


@query("value_stats_sliding", f"""
SELECT window_start, window_end, event_type, count(*) AS cnt, min(value) AS min_value,
       max(value) AS max_value FROM (
  {sql_window_rows('event_type, value', 'true', '1 hour', '5 minutes')})
GROUP BY window_start, window_end, event_type""")
def value_stats_sliding(spark, sf_dir):
    """Pane rollup of count/min/max (exact merges), 1 h sliding by 5 min."""
    return window_agg(events(spark, sf_dir), "ts", "1 hour", "5 minutes", ["event_type"],
                      {"cnt": "count", "min_value": ("min", "value"), "max_value": ("max", "value")})


# ------------------------------------------------------------- click cap
CAP = 3
_RANKED_SQL = ("SELECT *, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, row_number() OVER ("
               "PARTITION BY user_id, event_type, date_trunc('day', ts) ORDER BY ts, event_id) AS rn FROM events")


def _capped(spark, sf_dir):
    return click_cap(events(spark, sf_dir), ["user_id", "event_type"], cap=CAP)


@query("click_cap_warnings", f"""
SELECT user_id, event_type, day, ts, 'click over {CAP} times' AS msg FROM ({_RANKED_SQL}) WHERE rn = {CAP + 1}""")
def click_cap_warnings(spark, sf_dir):
    """One warning per (user, type, day) above the cap, at its first dropped row."""
    return _capped(spark, sf_dir)[1]


@query("click_cap_passed", f"""
SELECT event_id, ts, user_id, event_type, value, props FROM ({_RANKED_SQL}) WHERE rn <= {CAP}""")
def click_cap_passed(spark, sf_dir):
    """The rows that pass a cap of 3 per (user, type, UTC day)."""
    return _capped(spark, sf_dir)[0].drop("seq")


@query("capped_region_counts", sql_window_count(
    "event_type", "event_type", "true", "1 hour", "1 minute").replace(
    "FROM events,", f"FROM (SELECT * FROM ({_RANKED_SQL}) WHERE rn <= {CAP}) AS passed,"))
def capped_region_counts(spark, sf_dir):
    """Capped rows, then 1 h sliding by 1 min per event_type."""
    return window_counts(_capped(spark, sf_dir)[0], "ts", "1 hour", "1 minute", ["event_type"])


# --------------------------------------------------------------- patterns
@query("consecutive_errors", """
SELECT user_id, pts AS first_ts, ts AS last_ts FROM (
  SELECT user_id, ts, event_type, lag(event_type) OVER w AS pt, lag(ts) OVER w AS pts
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE event_type = 'error' AND pt = 'error' AND ts < pts + INTERVAL 1 DAY""")
def consecutive_errors(spark, sf_dir):
    """Error immediately followed by error less than 1 day later."""
    return consecutive_pairs(events(spark, sf_dir), ["user_id"], F.col("event_type") == "error", "1 day",
                             bucket="1 day")


@query("error_burst", """
WITH o AS (
  SELECT user_id, ts, event_id, event_type = 'error' AS f,
         lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pt
  FROM events),
starts AS (SELECT user_id, ts AS t0, event_id AS e0 FROM o WHERE f AND (pt IS NULL OR pt <> 'error')),
brk AS (
  SELECT s.user_id, s.t0, s.e0,
         (SELECT min(b.ts) FROM o b WHERE b.user_id = s.user_id AND NOT b.f
            AND (b.ts > s.t0 OR (b.ts = s.t0 AND b.event_id > s.e0))) AS bk_ts,
         (SELECT min(b.event_id) FROM o b WHERE b.user_id = s.user_id AND NOT b.f
            AND (b.ts > s.t0 OR (b.ts = s.t0 AND b.event_id > s.e0))) AS bk_id
  FROM starts s),
cnt AS (
  SELECT k.user_id, k.t0, k.bk_ts, count(*) AS n_fails, max(x.ts) AS last_ts
  FROM brk k JOIN o x ON x.user_id = k.user_id AND x.f
   AND (x.ts > k.t0 OR (x.ts = k.t0 AND x.event_id >= k.e0))
   AND (k.bk_id IS NULL OR x.ts < k.bk_ts OR (x.ts = k.bk_ts AND x.event_id < k.bk_id))
   AND x.ts <= k.t0 + INTERVAL 1 DAY
  GROUP BY k.user_id, k.t0, k.bk_ts)
SELECT user_id, t0 AS first_ts, last_ts, n_fails FROM cnt
WHERE n_fails >= 2 AND (bk_ts IS NULL OR bk_ts > t0 + INTERVAL 1 DAY)""")
def error_burst(spark, sf_dir):
    """At least 2 errors of one run within 1 day of the run's start."""
    return fail_bursts(events(spark, sf_dir), ["user_id"], F.col("event_type") == "error", "1 day", 2,
                       bucket="1 day")


@query("followed_within", """
SELECT user_id, first_ts, CASE WHEN nts < first_ts + INTERVAL 1 DAY THEN nts END AS then_ts,
       CASE WHEN nts < first_ts + INTERVAL 1 DAY THEN 'matched' ELSE 'timeout' END AS outcome
FROM (
  SELECT s.user_id, s.ts AS first_ts,
         (SELECT min(p.ts) FROM events p WHERE p.event_type = 'purchase' AND p.user_id = s.user_id
            AND (p.ts > s.ts OR (p.ts = s.ts AND p.event_id > s.event_id))) AS nts
  FROM events s WHERE s.event_type = 'signup')""")
def followed_within(spark, sf_dir):
    """Signup followed by a purchase within 1 day, else timeout."""
    ev = events(spark, sf_dir)
    return followed_by(ev, ["user_id"], F.col("event_type") == "signup", F.col("event_type") == "purchase",
                       "1 day", bucket="1 day")


@query("pay_match_outcomes", """
WITH x AS (SELECT user_id, ts, event_id, event_type = 'signup' AS cr FROM events
           WHERE event_type IN ('signup', 'purchase')),
o AS (SELECT *, lead(cr) OVER w AS ncr, lead(ts) OVER w AS nts, lag(cr) OVER w AS pcr, lag(ts) OVER w AS pts
      FROM x WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id,
       CASE WHEN ncr = false AND nts < ts + INTERVAL 1 DAY THEN 'paid'
            WHEN ncr = false AND nts < ts + INTERVAL 2 DAY THEN 'paid_late' ELSE 'timeout' END AS outcome,
       ts AS create_ts,
       CASE WHEN ncr = false AND nts < ts + INTERVAL 2 DAY THEN nts END AS pay_ts
FROM o WHERE cr
UNION ALL
SELECT user_id, 'pay_without_create' AS outcome, CAST(NULL AS TIMESTAMP) AS create_ts, ts AS pay_ts
FROM o WHERE NOT cr AND NOT (pcr IS NOT NULL AND pcr AND ts < pts + INTERVAL 2 DAY)""")
def pay_match_outcomes(spark, sf_dir):
    """signup/purchase state machine, bound 1 day, grace 1 day."""
    ev = events(spark, sf_dir)
    return match_outcomes(ev, ["user_id"], F.col("event_type") == "signup", F.col("event_type") == "purchase",
                          "1 day", "1 day", bucket="1 day")


# ------------------------------------------------------------------- joins
@query("interval_join", """
SELECT c.user_id, c.event_id AS click_id, c.ts AS click_ts, p.event_id AS purchase_id, p.ts AS purchase_ts
FROM events c JOIN events p ON c.user_id = p.user_id
 AND p.ts BETWEEN c.ts - INTERVAL 6 HOUR AND c.ts + INTERVAL 6 HOUR
WHERE c.event_type = 'click' AND p.event_type = 'purchase'""")
def interval_join_events(spark, sf_dir):
    """Click x purchase of the same user within +-6 h (inclusive)."""
    ev = events(spark, sf_dir)
    clicks = ev.filter(F.col("event_type") == "click").select(
        "user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts"))
    buys = ev.filter(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("p_user_id"), F.col("event_id").alias("purchase_id"),
        F.col("ts").alias("purchase_ts"))
    j = interval_join(clicks, buys, [("user_id", "p_user_id")], "click_ts", "purchase_ts", "-6 hours", "6 hours")
    return j.select("user_id", "click_id", "click_ts", "purchase_id", "purchase_ts")


@query("interval_join_orders", """
SELECT o.o_orderkey, o.o_orderdate, l.l_linenumber, l.l_shipdate
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
 AND l.l_shipdate BETWEEN o.o_orderdate - INTERVAL 5 DAY AND o.o_orderdate + INTERVAL 5 DAY""")
def interval_join_orders(spark, sf_dir):
    """Orders x lineitem on order key, ship date within +-5 days of order date."""
    o = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    li = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    j = interval_join(o, li, [("o_orderkey", "l_orderkey")], "o_orderdate", "l_shipdate", "-5 days", "5 days")
    return j.select("o_orderkey", "o_orderdate", "l_linenumber", "l_shipdate")


@query("reconcile", """
SELECT CASE WHEN l.o_orderkey IS NULL THEN 'right_only' WHEN r.l_orderkey IS NULL THEN 'left_only'
            ELSE 'matched' END AS outcome,
       coalesce(l.o_orderkey, r.l_orderkey) AS orderkey,
       l.o_orderkey, l.o_orderdate, l.o_totalprice, r.l_orderkey, r.l_shipdate, r.l_quantity
FROM (SELECT * FROM orders WHERE o_orderstatus = 'O') l
FULL OUTER JOIN (SELECT * FROM lineitem WHERE l_linenumber = 1) r ON l.o_orderkey = r.l_orderkey""")
def reconcile_orders(spark, sf_dir):
    """Open orders against first lines: matched / left_only / right_only."""
    o = (load_table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "O")
         .select("o_orderkey", "o_orderdate", "o_totalprice"))
    li = (load_table(spark, sf_dir, "lineitem").filter(F.col("l_linenumber") == 1)
          .select("l_orderkey", "l_shipdate", "l_quantity"))
    return reconcile(o, li, "o_orderkey", "l_orderkey", "o_orderdate", "l_shipdate", key_name="orderkey")


RECONCILE_TOLERANCE_SQL = """
WITH c AS (SELECT user_id, event_id AS click_id, ts AS click_ts FROM events WHERE event_type = 'click'),
p AS (SELECT user_id AS p_user_id, event_id AS purchase_id, ts AS purchase_ts FROM events WHERE event_type = 'purchase')
SELECT CASE WHEN click_id IS NULL THEN 'right_only' WHEN purchase_id IS NULL THEN 'left_only' ELSE 'matched' END AS outcome,
       coalesce(user_id, p_user_id) AS key, user_id, click_id, click_ts, p_user_id, purchase_id, purchase_ts
FROM c FULL OUTER JOIN p ON c.user_id = p.p_user_id
 AND p.purchase_ts BETWEEN c.click_ts - INTERVAL 6 HOUR AND c.click_ts + INTERVAL 6 HOUR"""


def _clicks_and_buys(ev: DataFrame) -> tuple[DataFrame, DataFrame]:
    clicks = ev.filter(F.col("event_type") == "click").select(
        "user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts"))
    buys = ev.filter(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("p_user_id"), F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts"))
    return clicks, buys


@query("reconcile_tolerance", RECONCILE_TOLERANCE_SQL)
def reconcile_tolerance(spark, sf_dir):
    """J2 with a tolerance: clicks against purchases of the user within +-6 h."""
    clicks, buys = _clicks_and_buys(events(spark, sf_dir))
    return reconcile(clicks, buys, "user_id", "p_user_id", "click_ts", "purchase_ts", tolerance="6 hours")


def _to_ntz(df: DataFrame) -> DataFrame:
    """Stream outputs are TIMESTAMP; report them like the batch forms (UTC wall clock)."""
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c)
                       for c, t in df.dtypes])


# --------------------------------------------------- text records
# Rows of the tables rendered in the reference's line layouts, every 50th cut
# short, and parsed back: split, trim, numbers, epoch seconds, date text.
_K_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_SECOND_SQL = "make_timestamp((epoch_us({0}) // 1000000) * 1000000)"


def _long_k():
    return F.get_json_object("props", "$.k").cast("long")


def _lines(df: DataFrame, sep: str, key: str, *fields) -> DataFrame:
    """One ``value`` per row; fields padded with a blank, which parsing trims."""
    line = F.concat_ws(sep, *[F.coalesce(f.cast("string"), F.lit("")) for f in fields])
    return df.select(F.when(F.col(key) % 50 == 0, F.substring(line, 1, 3)).otherwise(line).alias("value"))


def _seconds(c: str):
    return F.floor(F.unix_micros(F.col(c).cast("timestamp")) / 1_000_000)


def _orders_text(spark, sf_dir) -> DataFrame:
    """R5 lines: an order's transaction id is its key, empty for every third."""
    o = load_table(spark, sf_dir, "orders")
    tx = F.when(F.col("o_orderkey") % 3 == 0, F.lit("")).otherwise(F.col("o_orderkey").cast("string"))
    return _lines(o, " ,", "o_orderkey", F.col("o_orderkey"), F.col("o_orderstatus"), tx, _seconds("o_orderdate"))


def _receipts_text(spark, sf_dir) -> DataFrame:
    """R6 lines from first lines of orders."""
    li = load_table(spark, sf_dir, "lineitem").filter("l_linenumber = 1")
    return _lines(li, ",", "l_orderkey", F.col("l_orderkey"), F.col("l_returnflag"), _seconds("l_shipdate"))


@query("parse_user_behavior", f"""
SELECT user_id, event_id AS item_id, {_K_SQL} AS category_id, event_type AS behavior, {_SECOND_SQL.format('ts')} AS ts
FROM events WHERE event_id % 50 <> 0""")
def parse_user_behavior_events(spark, sf_dir):
    """User, item, category, behaviour, epoch seconds."""
    from eventlens.sources.parsers import parse_user_behavior
    lines = _lines(events(spark, sf_dir), ", ", "event_id", F.col("user_id"), F.col("event_id"), _long_k(),
                   F.col("event_type"), _seconds("ts"))
    return _to_ntz(parse_user_behavior(lines, on_error="drop"))


@query("parse_web_log", f"""
SELECT '10.0.0.' || (user_id % 256) AS ip, CAST(user_id AS VARCHAR) AS user_id, {_SECOND_SQL.format('ts')} AS ts,
       upper(event_type) AS method, '/' || event_type || '/' || event_id AS url
FROM events WHERE event_id % 50 <> 0""")
def parse_web_log_events(spark, sf_dir):
    """R2: log lines with a date in text."""
    from eventlens.sources.parsers import parse_web_log
    lines = _lines(events(spark, sf_dir), " ", "event_id", F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")),
                   F.col("user_id"), F.lit("-"), F.date_format(F.col("ts").cast("timestamp"), "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"),
                   F.upper("event_type"), F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), F.col("event_id").cast("string")))
    return _to_ntz(parse_web_log(lines, on_error="drop"))


@query("parse_ad_clicks", f"""
SELECT user_id, event_id AS ad_id, event_type AS province, CAST({_K_SQL} AS VARCHAR) AS city, {_SECOND_SQL.format('ts')} AS ts
FROM events WHERE event_id % 50 <> 0""")
def parse_ad_clicks_events(spark, sf_dir):
    """User, ad, province, city, epoch seconds."""
    from eventlens.sources.parsers import parse_ad_clicks
    lines = _lines(events(spark, sf_dir), ",", "event_id", F.col("user_id"), F.col("event_id"), F.col("event_type"), _long_k(), _seconds("ts"))
    return _to_ntz(parse_ad_clicks(lines, on_error="drop"))


@query("parse_logins", f"""
SELECT user_id, '10.0.0.' || (user_id % 256) AS ip, event_type, {_SECOND_SQL.format('ts')} AS ts
FROM events WHERE event_id % 50 <> 0""")
def parse_logins_events(spark, sf_dir):
    """User, ip, event type, epoch seconds."""
    from eventlens.sources.parsers import parse_logins
    lines = _lines(events(spark, sf_dir), ",", "event_id", F.col("user_id"), F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")),
                   F.col("event_type"), _seconds("ts"))
    return _to_ntz(parse_logins(lines, on_error="drop"))


_ORDER_ROWS_SQL = f"""
SELECT o_orderkey AS order_id, o_orderstatus AS event_type,
       CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS tx_id,
       {_SECOND_SQL.format('CAST(o_orderdate AS TIMESTAMP)')} AS ts
FROM orders WHERE o_orderkey % 50 <> 0"""
_RECEIPT_ROWS_SQL = f"""
SELECT CAST(l_orderkey AS VARCHAR) AS tx_id, l_returnflag AS pay_channel, {_SECOND_SQL.format('CAST(l_shipdate AS TIMESTAMP)')} AS ts
FROM lineitem WHERE l_linenumber = 1 AND l_orderkey % 50 <> 0"""


@query("parse_orders", _ORDER_ROWS_SQL)
def parse_orders_lines(spark, sf_dir):
    """Order, event type, transaction id (may be empty), epoch seconds."""
    from eventlens.sources.parsers import parse_orders
    return _to_ntz(parse_orders(_orders_text(spark, sf_dir), on_error="drop"))


@query("parse_receipts", _RECEIPT_ROWS_SQL)
def parse_receipts_lines(spark, sf_dir):
    """Transaction id, channel, epoch seconds."""
    from eventlens.sources.parsers import parse_receipts
    return _to_ntz(parse_receipts(_receipts_text(spark, sf_dir), on_error="drop"))


@query("tx_match_text", f"""
SELECT o.order_id, o.event_type, o.tx_id, o.ts AS o_ts, r.pay_channel, r.ts AS r_ts
FROM ({_ORDER_ROWS_SQL}) o JOIN ({_RECEIPT_ROWS_SQL}) r ON o.tx_id = r.tx_id
 AND r.ts BETWEEN o.ts - INTERVAL 10 DAY AND o.ts + INTERVAL 10 DAY WHERE o.tx_id <> ''""")
def tx_match_text(spark, sf_dir):
    """F3 J1 from text to result: orders with a transaction id and their receipts."""
    from eventlens.plans.jobs import tx_match_interval
    from eventlens.sources.parsers import parse_orders, parse_receipts
    return _to_ntz(tx_match_interval(parse_orders(_orders_text(spark, sf_dir), on_error="drop"),
                                     parse_receipts(_receipts_text(spark, sf_dir), on_error="drop"), "-10 days", "10 days"))


@query("total_value_sliding", f"""
SELECT window_start, window_end, CAST(sum(k) AS BIGINT) AS total FROM (
  {sql_window_rows(f'{_K_SQL} AS k', 'true', '1 hour', '10 minutes')}) GROUP BY window_start, window_end""")
def total_value_sliding(spark, sf_dir):
    """A2 as the sum of a value: props.k over all events, 1 h sliding by 10 min."""
    return window_sum(events(spark, sf_dir).withColumn("k", _long_k()), "ts", "1 hour", "10 minutes", value="k")


# ------------------------------------------------------------ streaming forms
# Each runs a Structured Streaming query over the ``events`` table, staged
# under the session's checkpoint folder as several files in event-time order
# (rows up to DISORDER out of order) with end markers (streaming/bounded.py),
# one file per micro-batch, into a parquet sink there, and returns the sink
# read back.  The result is the whole batch answer.
DISORDER = "1 hour"
_STAGED: dict = {}


def _markers(spark, sf_dir) -> list[dict]:
    """One end marker per event type, each under a user of its own."""
    types = [r.event_type for r in load_table(spark, sf_dir, "events").select("event_type").distinct().collect()]
    return [{"event_id": -i, "user_id": -i, "event_type": t, "value": 0, "props": "{}", "seq": -i}
            for i, t in enumerate(sorted(x for x in types if x is not None), 1)]


def _event_stream(spark, sf_dir, disorder=DISORDER, late=None):
    """``events`` as a bounded stream with ``seq`` = event_id."""
    from eventlens.session import scratch_path
    from eventlens.streaming.bounded import stage, staged_stream
    ev = events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    key = (spark.sparkContext.applicationId, sf_dir, disorder, late is not None)
    if key not in _STAGED:   # once per session: the streams only read it
        path = scratch_path(spark, "events-staged")
        _STAGED[key] = path, stage(ev, "ts", path, _markers(spark, sf_dir), disorder=disorder, late=late)
    return staged_stream(spark, ev.schema, *_STAGED[key])


def _run(stream: DataFrame, name: str) -> DataFrame:
    from eventlens.streaming.runner import run_once
    return _to_ntz(run_once(stream, name))


@query("stream_hot_keys_topn", HOT_KEYS_SQL)
def stream_hot_keys_topn(spark, sf_dir):
    """Streaming N1: windowed counts in append mode, ranked per micro-batch."""
    from eventlens.session import scratch_path
    from eventlens.streaming.windows import start_stream_topn, stream_window_counts
    counts = stream_window_counts(_event_stream(spark, sf_dir).filter(F.col("event_type") == "view"),
                                  "ts", "1 day", "6 hours", ["user_id"], delay=DISORDER)
    out = scratch_path(spark, "stream_hot_keys_topn")
    start_stream_topn(counts, "user_id", 3, out).awaitTermination()
    return _to_ntz(spark.read.parquet(out).drop("batch"))


@query("stream_unique_users_hourly", ORACLE["unique_users_hourly"])
def stream_unique_users_hourly(spark, sf_dir):
    """Streaming A5: chained aggregations (window, user) then (window)."""
    from eventlens.streaming.windows import stream_window_distinct
    s = stream_window_distinct(_event_stream(spark, sf_dir).filter(F.col("event_type") == "view"),
                               "ts", "1 hour", distinct_col="user_id", delay=DISORDER)
    return _run(s, "stream_unique_users_hourly")


@query("stream_region_counts_sliding", ORACLE["region_counts_sliding"])
def stream_region_counts_sliding(spark, sf_dir):
    """Streaming W1 A1 with 60 overlaps: pane counts, then the sliding window over panes."""
    from eventlens.streaming.windows import stream_window_counts
    s = stream_window_counts(_event_stream(spark, sf_dir), "ts", "1 hour", "1 minute", ["event_type"], delay=DISORDER)
    return _run(s, "stream_region_counts_sliding")


@query("stream_consecutive_errors", ORACLE["consecutive_errors"])
def stream_consecutive_errors(spark, sf_dir):
    """Streaming D3 / C1 (transformWithState, replay in event-time order)."""
    from eventlens.streaming.stateful import stream_consecutive_pairs
    s = stream_consecutive_pairs(_event_stream(spark, sf_dir), ["user_id"], F.col("event_type") == "error", "1 day",
                                 delay=DISORDER)
    return _run(s, "stream_consecutive_errors")


@query("stream_error_burst", ORACLE["error_burst"])
def stream_error_burst(spark, sf_dir):
    """Streaming D2: decided when the watermark passes t0 + span."""
    from eventlens.streaming.stateful import stream_fail_bursts
    s = stream_fail_bursts(_event_stream(spark, sf_dir), ["user_id"], F.col("event_type") == "error", "1 day", 2,
                           delay=DISORDER)
    return _run(s, "stream_error_burst")


@query("stream_followed_within", ORACLE["followed_within"])
def stream_followed_within(spark, sf_dir):
    """Streaming C2: timeouts come out when the watermark passes first + 1 day."""
    from eventlens.streaming.stateful import stream_followed_by
    ev = _event_stream(spark, sf_dir)
    s = stream_followed_by(ev, ["user_id"], F.col("event_type") == "signup", F.col("event_type") == "purchase",
                           "1 day", delay=DISORDER)
    return _run(s, "stream_followed_within")


@query("stream_pay_match_outcomes", ORACLE["pay_match_outcomes"])
def stream_pay_match_outcomes(spark, sf_dir):
    """Streaming D4 with deadline timers (bound 1 day, grace 1 day)."""
    from eventlens.streaming.stateful import stream_match_outcomes
    ev = _event_stream(spark, sf_dir)
    s = stream_match_outcomes(ev, ["user_id"], F.col("event_type") == "signup", F.col("event_type") == "purchase",
                              "1 day", "1 day", delay=DISORDER)
    return _run(s, "stream_pay_match_outcomes")


@query("stream_click_cap_passed", ORACLE["click_cap_passed"])
def stream_click_cap_passed(spark, sf_dir):
    """Streaming D1: the passed side output of the cap."""
    from eventlens.streaming.stateful import stream_click_cap
    s = stream_click_cap(_event_stream(spark, sf_dir), ["user_id", "event_type"], cap=CAP, delay=DISORDER,
                         carry=["event_id", "value", "props"])
    s = s.filter(F.col("tag") == "passed").select("event_id", "ts", "user_id", "event_type", "value", "props")
    return _run(s, "stream_click_cap_passed")


@query("stream_interval_join", ORACLE["interval_join"])
def stream_interval_join(spark, sf_dir):
    """Streaming J1: stream-stream interval join with watermarks on both sides."""
    from eventlens.streaming.joins import stream_interval_join as sij
    clicks, buys = _clicks_and_buys(_event_stream(spark, sf_dir))
    j = sij(clicks, buys, [("user_id", "p_user_id")], "click_ts", "purchase_ts", "-6 hours", "6 hours",
            DISORDER, DISORDER)
    return _run(j.select("user_id", "click_id", "click_ts", "purchase_id", "purchase_ts"), "stream_interval_join")


@query("stream_capped_region_counts", ORACLE["capped_region_counts"])
def stream_capped_region_counts(spark, sf_dir):
    """Streaming D1b in one query: the cap's passed rows carry event time into
    a 1 h / 1 min window count (pane rollup over the capped stream)."""
    from eventlens.streaming.stateful import stream_capped_window_counts
    s = stream_capped_window_counts(_event_stream(spark, sf_dir), ["user_id", "event_type"], ["event_type"],
                                    "1 hour", "1 minute", cap=CAP, delay=DISORDER)
    return _run(s, "stream_capped_region_counts")


@query("stream_reconcile", RECONCILE_TOLERANCE_SQL)
def stream_reconcile_events(spark, sf_dir):
    """Streaming J2: clicks vs purchases per user within +-6 h, on connected
    streams; an unmatched row comes out once the (min of both sides')
    watermark passes its ts + 6 h."""
    from eventlens.streaming.joins import stream_reconcile
    clicks, buys = _clicks_and_buys(_event_stream(spark, sf_dir))
    return _run(stream_reconcile(clicks, buys, "user_id", "p_user_id", "click_ts", "purchase_ts", "6 hours",
                                 DISORDER, DISORDER), "stream_reconcile")


@query("stream_click_cap_warnings", ORACLE["click_cap_warnings"])
def stream_click_cap_warnings(spark, sf_dir):
    """Streaming D1: the warning side output of the cap."""
    from eventlens.streaming.stateful import stream_click_cap
    s = stream_click_cap(_event_stream(spark, sf_dir), ["user_id", "event_type"], cap=CAP, delay=DISORDER)
    s = s.filter(F.col("tag") == "warning").select("user_id", "event_type", "day", "ts",
                                                   F.lit(f"click over {CAP} times").alias("msg"))
    return _run(s, "stream_click_cap_warnings")


@query("stream_page_views_5s", ORACLE["page_views_hourly"])
def stream_page_views_5s(spark, sf_dir):
    """Hourly page views, rows up to 5 s out of order."""
    from eventlens.streaming.windows import stream_window_counts
    s = stream_window_counts(_event_stream(spark, sf_dir, "5 seconds").filter(F.col("event_type") == "view"),
                             "ts", "1 hour", delay="5 seconds", name="pv")
    return _run(s, "stream_page_views_5s")


@query("stream_consecutive_errors_2s", ORACLE["consecutive_errors"])
def stream_consecutive_errors_2s(spark, sf_dir):
    """T2' with D3: rows up to 2 s out of order."""
    from eventlens.streaming.stateful import stream_consecutive_pairs
    s = stream_consecutive_pairs(_event_stream(spark, sf_dir, "2 seconds"), ["user_id"],
                                 F.col("event_type") == "error", "1 day", delay="2 seconds")
    return _run(s, "stream_consecutive_errors_2s")


@query("stream_hot_paths_lateness", ORACLE["hot_paths_topn"])
def stream_hot_paths_lateness(spark, sf_dir):
    """N2 with T4: 2 s out of order and an hour of allowed lateness, each
    window's final ranking once."""
    from eventlens.session import scratch_path
    from eventlens.streaming.windows import lateness_delay, start_stream_topn, stream_window_counts
    ev = _event_stream(spark, sf_dir).withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    counts = stream_window_counts(ev, "ts", "6 hours", "1 hour", ["k"], delay=lateness_delay("2 seconds", DISORDER))
    out = scratch_path(spark, "stream_hot_paths_lateness")
    start_stream_topn(counts, "k", 5, out).awaitTermination()
    return _to_ntz(spark.read.parquet(out).drop("batch"))


_LATE_SQL = ("event_id % 20 = 0 AND epoch_us(ts) < (SELECT min(epoch_us(ts)) + (max(epoch_us(ts)) - min(epoch_us(ts))) // 3 "
             "- 86400000000 FROM events)")


def _late(spark, sf_dir):
    """Every 20th row of the first third (less a day) arrives with the last file."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    lo, hi = load_table(spark, sf_dir, "events").agg(F.min(us), F.max(us)).first()
    return (F.col("event_id") % 20 == 0) & (us < F.lit(lo + (hi - lo) // 3 - 86_400_000_000))


@query("stream_late_views_dropped", sql_window_count("", "", f"event_type = 'view' AND NOT ({_LATE_SQL})", "1 hour", cnt="pv"))
def stream_late_views_dropped(spark, sf_dir):
    """Rows later than the delay are dropped, all others counted."""
    from eventlens.streaming.windows import stream_window_counts
    ev = _event_stream(spark, sf_dir, late=_late(spark, sf_dir))
    s = stream_window_counts(ev.filter(F.col("event_type") == "view"), "ts", "1 hour", delay=DISORDER, name="pv")
    return _run(s, "stream_late_views_dropped")


@query("stream_late_errors_dropped", f"""
SELECT user_id, pts AS first_ts, ts AS last_ts FROM (
  SELECT user_id, ts, event_type, lag(event_type) OVER w AS pt, lag(ts) OVER w AS pts
  FROM events WHERE NOT ({_LATE_SQL}) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE event_type = 'error' AND pt = 'error' AND ts < pts + INTERVAL 1 DAY""")
def stream_late_errors_dropped(spark, sf_dir):
    """T6 in a keyed process function: late rows are as if never sent."""
    from eventlens.streaming.stateful import stream_consecutive_pairs
    ev = _event_stream(spark, sf_dir, late=_late(spark, sf_dir))
    s = stream_consecutive_pairs(ev, ["user_id"], F.col("event_type") == "error", "1 day", delay=DISORDER)
    return _run(s, "stream_late_errors_dropped")


@query("stream_restart", ORACLE["consecutive_errors"])
def stream_restart(spark, sf_dir):
    """D3 stopped after the first file and started again: buffers, timers and
    the sink go on from the checkpoint."""
    from eventlens.session import scratch_path
    from eventlens.streaming.bounded import stage, staged_stream
    from eventlens.streaming.runner import run_to_parquet
    from eventlens.streaming.stateful import stream_consecutive_pairs
    ev = events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    root = scratch_path(spark, "stream_restart")
    for part in (range(1), range(1, 4)):
        parts = stage(ev, "ts", f"{root}/in", _markers(spark, sf_dir), disorder=DISORDER, only=part)
        s = stream_consecutive_pairs(staged_stream(spark, ev.schema, f"{root}/in", parts), ["user_id"],
                                     F.col("event_type") == "error", "1 day", delay=DISORDER)
        out = run_to_parquet(s, "stream_restart", f"{root}/out", f"{root}/checkpoint")
    return _to_ntz(out)
