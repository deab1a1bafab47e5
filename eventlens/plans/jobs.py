"""The reference's jobs, one function each, over parsed record DataFrames.

Batch forms; the streaming forms are in ``eventlens.streaming.jobs``.
Each takes DataFrames shaped like ``eventlens.schemas`` (plus an optional
``seq`` tiebreak) and returns DataFrames; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.functions.text import warning_text
from eventlens.operators.joins import interval_join, reconcile
from eventlens.operators.limits import click_cap
from eventlens.operators.patterns import consecutive_pairs, fail_bursts, followed_by, match_outcomes
from eventlens.operators.topn import hot_keys, window_report
from eventlens.operators.windows import window_counts, window_distinct, window_sum

# ---------------------------------------------------------------------------
# Literals and parameters of the reference's jobs, kept equal
# so results match (event-type words, window sizes, bounds, caps, sizes n).
PAGE_VIEW = "pv"                          # behaviour counted as a page view
UNINSTALL = "UNINSTALL"                   # marketing behaviour left out
LOGIN_FAIL = "fail"                       # login event type that fails
ORDER_CREATE = "create"                   # order event types
ORDER_PAY = "pay"
HOT_ITEMS_WINDOW = ("2 minutes", "1 minute")
HOT_ITEMS_N = 3
HOT_URLS_WINDOW = ("10 minutes", "5 seconds")
HOT_URLS_N = 5
HOURLY = "1 hour"
AD_WINDOW = ("1 hour", "5 seconds")
CLICK_CAP = 100
MARKETING_WINDOW = ("1 hour", "10 seconds")
LOGIN_SPAN = "2 seconds"
LOGIN_MIN_FAILS = 2
ORDER_BOUND = "15 minutes"
TX_BOUNDS = ("-5 seconds", "5 seconds")
OUT_OF_ORDER = {"hot_items": "5 seconds", "hot_urls": "5 seconds", "logins": "2 seconds", "others": "0 seconds"}
URL_LATENESS = "60 seconds"
# ---------------------------------------------------------------------------


def hot_items(behavior: DataFrame, n: int = HOT_ITEMS_N, size=HOT_ITEMS_WINDOW[0], slide=HOT_ITEMS_WINDOW[1]) -> DataFrame:
    """Top-n items by page views per sliding window."""
    pv = behavior.filter(F.col("behavior") == PAGE_VIEW)
    return hot_keys(pv, "ts", "item_id", size, slide, n)


def hot_items_report(behavior: DataFrame, n: int = HOT_ITEMS_N) -> DataFrame:
    """M5: the text form of :func:`hot_items`."""
    return window_report(hot_items(behavior, n), "item_id")


def hot_urls(web_log: DataFrame, n: int = HOT_URLS_N, size=HOT_URLS_WINDOW[0], slide=HOT_URLS_WINDOW[1]) -> DataFrame:
    """Top-n urls per 10 min window sliding by 5 s (120 panes)."""
    return hot_keys(web_log, "ts", "url", size, slide, n)


def page_views(behavior: DataFrame, size=HOURLY) -> DataFrame:
    """Page views per hour."""
    return window_counts(behavior.filter(F.col("behavior") == PAGE_VIEW), "ts", size, name="pv")


def unique_visitors(behavior: DataFrame, size=HOURLY) -> DataFrame:
    """Exact distinct users per hour."""
    return window_distinct(behavior.filter(F.col("behavior") == PAGE_VIEW), "ts", size,
                           distinct_col="user_id", name="uv")


def ad_clicks_by_province(clicks: DataFrame, size=AD_WINDOW[0], slide=AD_WINDOW[1]) -> DataFrame:
    """Clicks per province, 1 h sliding by 5 s (720 panes)."""
    return window_counts(clicks, "ts", size, slide, ["province"])


def ad_clicks_with_blacklist(clicks: DataFrame, cap: int = CLICK_CAP, size=AD_WINDOW[0], slide=AD_WINDOW[1]):
    """D1 + D1b: cap clicks per (user, ad, day); count passed clicks per
    province.  Returns (province counts, blacklist warnings)."""
    passed, warnings = click_cap(clicks, ["user_id", "ad_id"], cap)
    return window_counts(passed, "ts", size, slide, ["province"]), warnings


def marketing_totals(mkt: DataFrame, size=MARKETING_WINDOW[0], slide=MARKETING_WINDOW[1]) -> DataFrame:
    """F2 M1 M4 A2: all non-uninstall behaviour under one key, labels 'all'."""
    kept = mkt.filter(F.col("behavior") != UNINSTALL)
    return window_sum(kept, "ts", size, slide, name="cnt", labels={"channel": "all", "behavior": "all"})


def marketing_by_channel(mkt: DataFrame, size=MARKETING_WINDOW[0], slide=MARKETING_WINDOW[1]) -> DataFrame:
    """F2 M2 A4: counts per (channel, behavior)."""
    kept = mkt.filter(F.col("behavior") != UNINSTALL)
    return window_counts(kept, "ts", size, slide, ["channel", "behavior"])


def login_fail_bursts(logins: DataFrame, min_fails: int = LOGIN_MIN_FAILS, span=LOGIN_SPAN) -> DataFrame:
    """At least ``min_fails`` fails of one run within ``span`` of its start, with the warning's text."""
    return (fail_bursts(logins, ["user_id"], F.col("event_type") == LOGIN_FAIL, span, min_fails)
            .withColumn("msg", warning_text("login failed ", F.col("n_fails"), " times")))


def login_fail_pairs(logins: DataFrame, within=LOGIN_SPAN) -> DataFrame:
    """Fail directly followed by fail less than ``within`` later, with the warning's text."""
    return (consecutive_pairs(logins, ["user_id"], F.col("event_type") == LOGIN_FAIL, within)
            .withColumn("msg", warning_text("login failed twice in a row")))


def order_timeouts(orders: DataFrame, within=ORDER_BOUND) -> DataFrame:
    """Create followed by pay within 15 min -> matched, else timeout."""
    return followed_by(orders, ["order_id"], F.col("event_type") == ORDER_CREATE, F.col("event_type") == ORDER_PAY,
                       within).withColumnRenamed("first_ts", "create_ts").withColumnRenamed("then_ts", "pay_ts")


def order_pay_outcomes(orders: DataFrame, bound=ORDER_BOUND, grace=None) -> DataFrame:
    """Paid / paid_late / timeout / pay_without_create."""
    return match_outcomes(orders, ["order_id"], F.col("event_type") == ORDER_CREATE, F.col("event_type") == ORDER_PAY,
                          bound, grace)


def _order_side(orders: DataFrame) -> DataFrame:
    cols = ["order_id", "event_type", F.col("tx_id").alias("o_tx_id"), F.col("ts").alias("o_ts")]
    if "seq" in orders.columns:
        cols.append(F.col("seq").alias("o_seq"))
    return orders.filter(F.col("tx_id") != "").select(*cols)


def _receipt_side(receipts: DataFrame) -> DataFrame:
    cols = [F.col("tx_id").alias("r_tx_id"), "pay_channel", F.col("ts").alias("r_ts")]
    if "seq" in receipts.columns:
        cols.append(F.col("seq").alias("r_seq"))
    return receipts.filter(F.col("tx_id") != "").select(*cols)


def tx_match_interval(orders: DataFrame, receipts: DataFrame, lower=TX_BOUNDS[0], upper=TX_BOUNDS[1]) -> DataFrame:
    """Order rows with a tx id x receipts, receipt within [-5 s, +5 s]."""
    j = interval_join(_order_side(orders), _receipt_side(receipts), [("o_tx_id", "r_tx_id")],
                      "o_ts", "r_ts", lower, upper)
    return j.select("order_id", "event_type", F.col("o_tx_id").alias("tx_id"), "o_ts", "pay_channel", "r_ts")


def tx_reconcile(orders: DataFrame, receipts: DataFrame, tolerance=None) -> DataFrame:
    """Matched / left_only (order, no receipt) / right_only (receipt, no order)."""
    o = _order_side(orders).filter(F.col("event_type") == ORDER_PAY)
    r = _receipt_side(receipts)
    return reconcile(o, r, "o_tx_id", "r_tx_id", "o_ts", "r_ts", tolerance=tolerance, key_name="tx_id")
