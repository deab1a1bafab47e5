"""The reference's jobs as Structured Streaming queries (the batch forms
are in :mod:`eventlens.plans.jobs`, with the same fixed values).

Each function takes streaming DataFrames of parsed records and returns a
streaming DataFrame (append mode) -- except the top-n jobs, which start
their query (ranking runs per micro-batch in ``foreachBatch``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.functions.text import warning_text
from eventlens.plans.jobs import (
    AD_WINDOW, CLICK_CAP, HOT_ITEMS_N, HOT_ITEMS_WINDOW, HOT_URLS_N, HOT_URLS_WINDOW, HOURLY, LOGIN_FAIL,
    LOGIN_MIN_FAILS, LOGIN_SPAN, MARKETING_WINDOW, ORDER_BOUND, ORDER_CREATE, ORDER_PAY, OUT_OF_ORDER,
    PAGE_VIEW, TX_BOUNDS, UNINSTALL, URL_LATENESS,
)
from eventlens.streaming.joins import stream_interval_join, stream_reconcile
from eventlens.streaming.stateful import (
    stream_capped_window_counts, stream_click_cap, stream_consecutive_pairs, stream_fail_bursts,
    stream_followed_by, stream_match_outcomes,
)
from eventlens.streaming.windows import (
    lateness_delay, start_stream_topn, stream_window_counts, stream_window_distinct,
)

_NONE = OUT_OF_ORDER["others"]


def start_hot_items(behavior: DataFrame, out_path: str, n: int = HOT_ITEMS_N, checkpoint=None, trigger=None):
    """Top-n items per 2 min / 1 min window; watermark 5 s."""
    counts = stream_window_counts(behavior.filter(F.col("behavior") == PAGE_VIEW), "ts", *HOT_ITEMS_WINDOW,
                                  ["item_id"], delay=OUT_OF_ORDER["hot_items"])
    return start_stream_topn(counts, "item_id", n, out_path, checkpoint, trigger)


def start_hot_urls(web_log: DataFrame, out_path: str, n: int = HOT_URLS_N, checkpoint=None, trigger=None):
    """N2 with allowed lateness (T4): each window's final ranking once, after
    out-of-orderness 5 s + lateness 60 s."""
    counts = stream_window_counts(web_log, "ts", *HOT_URLS_WINDOW, ["url"],
                                  delay=lateness_delay(OUT_OF_ORDER["hot_urls"], URL_LATENESS))
    return start_stream_topn(counts, "url", n, out_path, checkpoint, trigger)


def page_views(behavior: DataFrame) -> DataFrame:
    return stream_window_counts(behavior.filter(F.col("behavior") == PAGE_VIEW), "ts", HOURLY, delay=_NONE,
                                name="pv")


def unique_visitors(behavior: DataFrame) -> DataFrame:
    return stream_window_distinct(behavior.filter(F.col("behavior") == PAGE_VIEW), "ts", HOURLY,
                                  distinct_col="user_id", delay=_NONE)


def ad_clicks_by_province(clicks: DataFrame) -> DataFrame:
    return stream_window_counts(clicks, "ts", *AD_WINDOW, ["province"], delay=_NONE)


def ad_clicks_with_blacklist(clicks: DataFrame, cap: int = CLICK_CAP):
    """(capped province counts, blacklist warnings) as two streams."""
    counts = stream_capped_window_counts(clicks, ["user_id", "ad_id"], ["province"], *AD_WINDOW, cap=cap,
                                         delay=_NONE)
    warnings = (stream_click_cap(clicks, ["user_id", "ad_id"], cap, delay=_NONE)
                .filter(F.col("tag") == "warning")
                .select("user_id", "ad_id", "day", "ts",
                        F.lit(f"click over {cap} times").alias("msg")))
    return counts, warnings


def marketing_totals(mkt: DataFrame) -> DataFrame:
    kept = mkt.filter(F.col("behavior") != UNINSTALL)
    return (stream_window_counts(kept, "ts", *MARKETING_WINDOW, delay=_NONE)
            .withColumn("channel", F.lit("all")).withColumn("behavior", F.lit("all")))


def marketing_by_channel(mkt: DataFrame) -> DataFrame:
    kept = mkt.filter(F.col("behavior") != UNINSTALL)
    return stream_window_counts(kept, "ts", *MARKETING_WINDOW, ["channel", "behavior"], delay=_NONE)


def login_fail_bursts(logins: DataFrame) -> DataFrame:
    return (stream_fail_bursts(logins, ["user_id"], F.col("event_type") == LOGIN_FAIL, LOGIN_SPAN,
                               LOGIN_MIN_FAILS, delay=OUT_OF_ORDER["logins"])
            .withColumn("msg", warning_text("login failed ", F.col("n_fails"), " times")))


def login_fail_pairs(logins: DataFrame) -> DataFrame:
    return (stream_consecutive_pairs(logins, ["user_id"], F.col("event_type") == LOGIN_FAIL, LOGIN_SPAN,
                                     delay=OUT_OF_ORDER["logins"])
            .withColumn("msg", warning_text("login failed twice in a row")))


def order_timeouts(orders: DataFrame) -> DataFrame:
    return stream_followed_by(orders, ["order_id"], F.col("event_type") == ORDER_CREATE,
                              F.col("event_type") == ORDER_PAY, ORDER_BOUND, delay=_NONE)


def order_pay_outcomes(orders: DataFrame, grace="0 seconds") -> DataFrame:
    """D4 on a stream; a finite grace lets open creates time out."""
    return stream_match_outcomes(orders, ["order_id"], F.col("event_type") == ORDER_CREATE,
                                 F.col("event_type") == ORDER_PAY, ORDER_BOUND, grace, delay=_NONE)


def _sides(orders, receipts):
    o = orders.filter(F.col("tx_id") != "").select("order_id", "event_type", F.col("tx_id").alias("o_tx_id"),
                                                   F.col("ts").alias("o_ts"))
    r = receipts.filter(F.col("tx_id") != "").select(F.col("tx_id").alias("r_tx_id"), "pay_channel",
                                                     F.col("ts").alias("r_ts"))
    return o, r


def tx_match_interval(orders: DataFrame, receipts: DataFrame) -> DataFrame:
    o, r = _sides(orders, receipts)
    return stream_interval_join(o, r, [("o_tx_id", "r_tx_id")], "o_ts", "r_ts", *TX_BOUNDS, _NONE, _NONE)


def tx_reconcile(orders: DataFrame, receipts: DataFrame, tolerance=TX_BOUNDS[1]) -> DataFrame:
    """J2 on streams: the tolerance bounds how long either side waits."""
    o, r = _sides(orders.filter(F.col("event_type") == ORDER_PAY), receipts)
    return stream_reconcile(o, r, "o_tx_id", "r_tx_id", "o_ts", "r_ts", tolerance, _NONE, _NONE, key_name="tx_id")
