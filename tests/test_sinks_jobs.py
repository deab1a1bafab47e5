"""S6 side outputs, the tagged stream sink, stream reconciliation, and a
smoke run of every reference job in ``plans.jobs`` on hand-written rows."""

from pyspark.sql import functions as F

from conftest import lines_df, ts
from eventlens.plans import jobs
from eventlens.session import scratch_path
from eventlens.sources import parsers as P
from eventlens.sources.sinks import split_by_tag, start_tagged_stream
from eventlens.streaming import jobs as sjobs
from eventlens.streaming import run_to_memory, stream_reconcile

T = 1511658000


def test_split_by_tag(spark):
    df = spark.createDataFrame([("passed", 1), ("warning", 2), ("passed", 3)], "tag string, v long")
    parts = split_by_tag(df, "tag", ["passed", "warning"])
    assert parts["passed"].count() == 2 and parts["warning"].count() == 1


def test_tagged_stream_sink(spark):
    root = scratch_path(spark, "tagged-in")
    spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "tag string, v long").write.parquet(root)
    src = spark.readStream.schema("tag string, v long").parquet(root)
    out = scratch_path(spark, "tagged-out")
    start_tagged_stream(src, "tag", out, trigger={"availableNow": True}).awaitTermination()
    got = spark.read.parquet(out)
    assert sorted((r.tag, r.v) for r in got.collect()) == [("a", 1), ("a", 3), ("b", 2)]


def test_stream_reconcile_with_tolerance(spark):
    root_o, root_r = scratch_path(spark, "rec-o"), scratch_path(spark, "rec-r")
    o = spark.createDataFrame([("a", ts(T)), ("b", ts(T + 10)), ("c", ts(T + 20)), ("z", ts(T + 9000))],
                              "o_tx string, o_ts timestamp")
    r = spark.createDataFrame([("a", ts(T + 3)), ("c", ts(T + 40)), ("d", ts(T + 5)), ("z", ts(T + 9000))],
                              "r_tx string, r_ts timestamp")
    o.write.parquet(root_o)
    r.write.parquet(root_r)
    so = spark.readStream.schema(o.schema).parquet(root_o)
    sr = spark.readStream.schema(r.schema).parquet(root_r)
    s = stream_reconcile(so, sr, "o_tx", "r_tx", "o_ts", "r_ts", "5 seconds", key_name="tx")
    got = sorted((x.outcome, x.tx) for x in run_to_memory(s, "rec" + str(abs(hash(root_o)) % 10**8)).collect())
    # 'z' (the far-future pair) only closes the others; it is still open itself
    assert got == [("left_only", "b"), ("left_only", "c"), ("matched", "a"), ("matched", "z"),
                   ("right_only", "c"), ("right_only", "d")]


def _behavior(spark):
    lines = [f"{u},{item},7,{b},{T + s}" for u, item, b, s in [
        (1, 100, "pv", 0), (2, 100, "pv", 10), (3, 200, "pv", 20), (1, 300, "buy", 30), (4, 100, "pv", 70),
        (2, 200, "pv", 3700)]]
    return P.parse_user_behavior(lines_df(spark, lines))


def test_behavior_jobs(spark):
    b = _behavior(spark)
    top = jobs.hot_items(b, n=2).filter(F.col("window_end") == ts(T + 60)).orderBy("rank").collect()
    assert [(r.item_id, r.cnt) for r in top] == [(100, 2), (200, 1)]
    rep = jobs.hot_items_report(b, n=1).orderBy("window_end").first().report
    assert "No.1: key=100 count=2" in rep
    pv = {r.window_start: r.pv for r in jobs.page_views(b).collect()}
    assert pv == {ts(T): 4, ts(T + 3600): 1}
    uv = {r.window_start: r.uv for r in jobs.unique_visitors(b).collect()}
    assert uv == {ts(T): 4, ts(T + 3600): 1}


def test_web_log_job(spark):
    lines = [f"1.1.1.{i} - - 26/11/2017:01:00:{i:02d} +0000 GET /u{i % 2}" for i in range(10)]
    logs = P.parse_web_log(lines_df(spark, lines))
    top = jobs.hot_urls(logs, n=1).filter(F.col("window_end") == ts(T + 600)).collect()
    assert [(r.url, r.cnt) for r in top] == [("/u0", 5)]


def test_ad_and_marketing_jobs(spark):
    clicks = P.parse_ad_clicks(lines_df(spark, [f"{u},9,{p},c,{T + i}" for i, (u, p) in enumerate(
        [(1, "beijing"), (1, "beijing"), (2, "henan"), (1, "beijing")])]))
    by_p = {r.province: r.cnt for r in jobs.ad_clicks_by_province(clicks)
            .filter(F.col("window_end") == ts(T + 5)).collect()}
    assert by_p == {"beijing": 3, "henan": 1}
    capped, warn = jobs.ad_clicks_with_blacklist(clicks, cap=2)
    assert {r.province: r.cnt for r in capped.filter(F.col("window_end") == ts(T + 5)).collect()} == \
        {"beijing": 2, "henan": 1}
    assert [(r.user_id, r.ts) for r in warn.collect()] == [(1, ts(T + 3))]
    mkt = P.parse_marketing(lines_df(spark, [f"u{i},{b},{c},{(T + i) * 1000}" for i, (b, c) in enumerate(
        [("CLICK", "wechat"), ("INSTALL", "wechat"), ("UNINSTALL", "weibo"), ("CLICK", "appstore")])]))
    tot = jobs.marketing_totals(mkt).filter(F.col("window_end") == ts(T + 10)).collect()
    assert [(r.cnt, r.channel, r.behavior) for r in tot] == [(3, "all", "all")]
    ch = {(r.channel, r.behavior): r.cnt for r in jobs.marketing_by_channel(mkt)
          .filter(F.col("window_end") == ts(T + 10)).collect()}
    assert ch == {("wechat", "CLICK"): 1, ("wechat", "INSTALL"): 1, ("appstore", "CLICK"): 1}


def test_streaming_jobs_match_batch(spark):
    """Streaming forms of the login and order jobs equal the batch forms."""
    from eventlens.streaming import jobs as sjobs
    from eventlens.streaming import run_to_memory
    root = scratch_path(spark, "jobs-in")
    login_lines = [f"1035,1.1.1.1,fail,{1558430840 + d}" for d in (2, 4, 3, 5, 6, 1)] + \
        ["1035,1.1.1.1,success,1558430870", "7,1.1.1.1,success,1558430843", "9,1.1.1.1,success,1558439999"]
    logins = P.parse_logins(lines_df(spark, login_lines))
    logins.write.parquet(f"{root}/logins")
    s = spark.readStream.schema(logins.schema).parquet(f"{root}/logins")
    got = run_to_memory(sjobs.login_fail_pairs(s), "jobs_pairs").collect()
    exp = jobs.login_fail_pairs(logins).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, exp)) and len(got) == 5
    order_lines = ["1,create,,100", "1,pay,t1,500", "2,create,,100", "2,pay,t2,1200", "3,create,,200",
                   "4,pay,t4,300", "99,create,,99999"]
    orders = P.parse_orders(lines_df(spark, order_lines))
    orders.write.parquet(f"{root}/orders")
    s = spark.readStream.schema(orders.schema).parquet(f"{root}/orders")
    got = sorted((r.order_id, r.outcome) for r in run_to_memory(sjobs.order_pay_outcomes(s), "jobs_d4").collect())
    exp = sorted((r.order_id, r.outcome) for r in jobs.order_pay_outcomes(orders, grace="0 seconds").collect()
                 if r.order_id != 99)
    assert got == exp


def test_streaming_jobs_build(spark):
    """Every streaming job form analyses on streaming input; hot items runs."""
    from eventlens.streaming import jobs as sjobs
    import os
    root = scratch_path(spark, "jobs-build")
    for d in ("none-c", "none-m", "none-o", "none-r"):
        os.makedirs(f"{root}/{d}", exist_ok=True)      # empty stream sources (local test folder)
    b = _behavior(spark)
    b.write.parquet(f"{root}/b")
    sb = spark.readStream.schema(b.schema).parquet(f"{root}/b")
    clicks = spark.readStream.schema("user_id long, ad_id long, province string, city string, ts timestamp, "
                                     "seq long").parquet(f"{root}/none-c")
    mkt = spark.readStream.schema("user_id string, behavior string, channel string, ts timestamp").parquet(f"{root}/none-m")
    orders = spark.readStream.schema("order_id long, event_type string, tx_id string, ts timestamp, seq long") \
        .parquet(f"{root}/none-o")
    receipts = spark.readStream.schema("tx_id string, pay_channel string, ts timestamp, seq long").parquet(f"{root}/none-r")
    built = [sjobs.page_views(sb), sjobs.unique_visitors(sb), sjobs.ad_clicks_by_province(clicks),
             *sjobs.ad_clicks_with_blacklist(clicks), sjobs.marketing_totals(mkt), sjobs.marketing_by_channel(mkt),
             sjobs.order_timeouts(orders), sjobs.tx_match_interval(orders, receipts),
             sjobs.tx_reconcile(orders, receipts)]
    assert all(d.isStreaming for d in built)
    out = scratch_path(spark, "jobs-hot")
    sjobs.start_hot_items(sb, out, n=2, trigger={"availableNow": True}).awaitTermination()
    # the last rows stay inside the 5 s watermark delay; closed windows are ranked
    got = spark.read.parquet(out).filter(F.col("window_end") == ts(T + 60)).orderBy("rank").collect()
    assert [(r.item_id, r.cnt) for r in got] == [(100, 2), (200, 1)]


def test_numbered_text_stream_keeps_lines_of_one_instant_in_order(spark):
    """Create and pay of one order in the same second: the line position decides."""
    from eventlens.sources.parsers import parse_orders
    from eventlens.sources.text import read_lines_stream
    root = scratch_path(spark, "numbered-in")
    lines = ["34747,create,,1558430844", "34747,pay,a1,1558430844", "1,pay,b,1558430845", "1,create,,1558430845", "9,create,,1559999999"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(root)
    s = sjobs.order_pay_outcomes(parse_orders(read_lines_stream(spark, root, numbered=True)))
    got = sorted((r.order_id, r.outcome) for r in run_to_memory(s, "numbered_orders").collect())
    assert got == [(1, "pay_without_create"), (1, "timeout"), (34747, "paid")]
