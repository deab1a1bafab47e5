"""D2, D3, C1, C2, D4 and the ordered-scan primitive, with hand-made
boundary rows (FIXTURES.md 'Boundary rows to write by hand')."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import ts
from eventlens.operators.sequence import ordered_context
from eventlens.plans import jobs

LOGIN = "user_id long, ip string, event_type string, ts timestamp, seq long"
ORDER = "order_id long, event_type string, tx_id string, ts timestamp, seq long"


def logins(spark, rows):
    return spark.createDataFrame([(u, "1.1.1.1", e, ts(t), i) for i, (u, e, t) in enumerate(rows)], LOGIN)


def orders(spark, rows):
    return spark.createDataFrame([(o, e, tx, ts(t), i) for i, (o, e, tx, t) in enumerate(rows)], ORDER)


# user 1035: six fails 1558430841..846 arriving out of order; other users succeed
T = 1558430840
SIX = [(1035, "fail", T + d) for d in (2, 4, 3, 5, 6, 1)] + [(1035, "success", T + 30), (7, "success", T + 3)]


def test_fail_pairs_event_time_order(spark):
    out = sorted((r.first_ts, r.last_ts) for r in jobs.login_fail_pairs(logins(spark, SIX)).collect())
    assert out == [(ts(T + d), ts(T + d + 1)) for d in range(1, 6)]


def test_fail_pairs_boundaries(spark):
    rows = [(1, "fail", 100), (1, "fail", 101),            # 1 s -> pair
            (2, "fail", 100), (2, "fail", 102),            # 2 s -> no pair (strict)
            (3, "fail", 100), (3, "success", 100.5), (3, "fail", 101),   # success between
            (4, "fail", 100), (4, "view", 100.5), (4, "fail", 101)]      # other type between
    out = [r.user_id for r in jobs.login_fail_pairs(logins(spark, rows)).collect()]
    assert out == [1]


def test_fail_burst_sample_shape(spark):
    out = [(r.user_id, r.first_ts, r.last_ts, r.n_fails) for r in jobs.login_fail_bursts(logins(spark, SIX)).collect()]
    assert out == [(1035, ts(T + 1), ts(T + 3), 3)]


def test_fail_burst_cleared_by_success_and_needs_n(spark):
    rows = [(1, "fail", 100), (1, "fail", 101), (1, "success", 101.5),   # cleared before t0+2
            (2, "fail", 100), (2, "fail", 103),                         # second fail too late
            (3, "fail", 100), (3, "fail", 102), (3, "success", 102.5)]  # fail at exactly t0+2 counts
    out = [(r.user_id, r.n_fails) for r in jobs.login_fail_bursts(logins(spark, rows)).collect()]
    assert out == [(3, 2)]


C = 1558430000
ORDER_ROWS = [
    (1, "create", "", C), (1, "pay", "t1", C + 899),                       # paid
    (2, "create", "", C), (2, "pay", "t2", C + 900),                       # at bound
    (3, "create", "", C), (3, "pay", "t3", C + 901),                       # past bound
    (4, "create", "", C), (4, "create", "", C + 10), (4, "pay", "t4", C + 20),   # two creates, one pay
    (5, "create", "", C), (5, "pay", "t5", C + 5), (5, "pay", "t5b", C + 6),     # one create, two pays
    (6, "pay", "t6", C),                                                   # pay first
    (7, "create", "", C), (7, "modify", "x", C + 1), (7, "pay", "t7", C + 2),    # modify between
    (8, "create", "", C),                                                  # never paid
]


def test_followed_by_boundaries(spark):
    out = {(r.order_id, r.create_ts): (r.outcome, r.pay_ts) for r in jobs.order_timeouts(orders(spark, ORDER_ROWS)).collect()}
    assert out[(1, ts(C))] == ("matched", ts(C + 899))
    assert out[(2, ts(C))][0] == "timeout" and out[(3, ts(C))] == ("timeout", None)
    assert out[(4, ts(C))] == ("matched", ts(C + 20)) and out[(4, ts(C + 10))] == ("matched", ts(C + 20))
    assert out[(5, ts(C))] == ("matched", ts(C + 5))
    assert out[(7, ts(C))] == ("matched", ts(C + 2))
    assert out[(8, ts(C))] == ("timeout", None)
    assert not any(k[0] == 6 for k in out)
    assert len(out) == 8


def _outcomes(df):
    return sorted((r.order_id, r.outcome) for r in df.collect())


def test_match_outcomes_unlimited_grace(spark):
    out = _outcomes(jobs.order_pay_outcomes(orders(spark, ORDER_ROWS)))
    assert out == sorted([(1, "paid"), (2, "paid_late"), (3, "paid_late"), (4, "timeout"), (4, "paid"),
                          (5, "paid"), (5, "pay_without_create"), (6, "pay_without_create"), (7, "paid"),
                          (8, "timeout")])


def test_match_outcomes_zero_grace(spark):
    out = _outcomes(jobs.order_pay_outcomes(orders(spark, ORDER_ROWS), grace="0 seconds"))
    assert (2, "timeout") in out and (2, "pay_without_create") in out
    assert (3, "timeout") in out and (3, "pay_without_create") in out
    assert (1, "paid") in out


def test_ordered_context_matches_plain_window(spark):
    """Any bucket width gives the same answer as one window over the whole key."""
    rnd = random.Random(11)
    rows = []
    for i in range(600):
        k = rnd.choice(["a", "a", "a", "b", "c", None])   # a hot key and a null key
        rows.append((k, ts(C + rnd.randint(0, 20000)), rnd.random() < 0.4, i))
    df = spark.createDataFrame(rows, "k string, ts timestamp, f boolean, seq long")
    w = Window.partitionBy("k").orderBy("ts", "seq")
    ref = (df.withColumn("prev_seq", F.lag("seq").over(w)).withColumn("next_seq", F.lead("seq").over(w))
             .withColumn("rank", F.row_number().over(w).cast("long"))
             .withColumn("n_f", F.sum(F.col("f").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
             .withColumn("nf_seq", F.first(F.when(F.col("f"), F.col("seq")), ignorenulls=True)
                         .over(w.rowsBetween(1, Window.unboundedFollowing))))
    cols = ["seq", "prev_seq", "next_seq", "rank", "n_f", "nf_seq"]
    expect = sorted(tuple(r) for r in ref.select(*cols).collect())
    for bucket, seq, split in [("1 minute", "seq", None), ("17 minutes", "seq", None), ("100 days", "seq", None),
                               ("5 minutes", ["seq"], None), ("100 days", "seq", 7), ("1 hour", ["seq"], 3)]:
        got = ordered_context(df, ["k"], "ts", seq, bucket, prev=["seq"], next=["seq"],
                              first_next_where={"nf": (F.col("f"), ["seq"])}, running_count={"n_f": F.col("f")},
                              rank=True, split_rows=split)
        got = sorted(tuple(r) for r in got.select(*cols).collect())
        assert got == expect, (bucket, split)


def test_null_predicate_ends_a_run_and_null_keys_stay(spark):
    from eventlens.operators.patterns import consecutive_pairs, fail_bursts
    rows = [(1, ts(0), 0, True), (1, ts(1), 1, None), (1, ts(2), 2, True),
            (None, ts(0), 3, True), (None, ts(1), 4, True)]
    df = spark.createDataFrame(rows, "k long, ts timestamp, seq long, bad boolean")
    assert [(r.k, r.n_fails) for r in fail_bursts(df, ["k"], "bad", "10 seconds", 2).collect()] == [(None, 2)]
    assert [r.k for r in consecutive_pairs(df, ["k"], "bad", "10 seconds").collect()] == [None]
