"""Per-key event patterns in batch: D2, D3, C1, C2, D4.

Everything is in event-time order within a key, ties broken by a caller
``seq`` column, so results do not depend on arrival order.  All of them
run on :func:`eventlens.operators.sequence.ordered_context`, which never
sends a whole key to one task.  No Python runs per row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.functions.time import add_duration, duration_us, to_micros
from eventlens.operators.sequence import DEFAULT_BUCKET, ordered_context


def _p(c) -> Column:
    """A predicate as written: what a filter can push to the scan (null drops the row)."""
    return F.expr(c) if isinstance(c, str) else c


def _c(c) -> Column:
    """A predicate as a flag: null counts as false."""
    return F.coalesce(_p(c), F.lit(False))


def consecutive_pairs(df: DataFrame, keys, is_event, within, ts: str = "ts", seq: str | None = "seq",
                      bucket=DEFAULT_BUCKET, carry=()) -> DataFrame:
    """An event immediately followed (strict contiguity, any other
    row breaks it) by another such event less than ``within`` later.

    Pairs overlap: three events in a row give two pairs.  Returns
    ``*keys, first_ts, last_ts`` (+ ``first_<c>``, ``last_<c>`` for carry).
    """
    keys, carry = list(keys), list(carry)
    x = df.withColumn("_m", _c(is_event))
    ctx = ordered_context(x, keys, ts, seq, bucket, prev=["_m", ts, *carry])
    hit = (F.col("_m") & F.col("prev__m")
           & (F.col(ts) < add_duration(F.col(f"prev_{ts}"), within)))
    return ctx.filter(hit).select(
        *keys, F.col(f"prev_{ts}").alias("first_ts"), F.col(ts).alias("last_ts"),
        *[F.col(f"prev_{c}").alias(f"first_{c}") for c in carry],
        *[F.col(c).alias(f"last_{c}") for c in carry])


def followed_by(df: DataFrame, keys, first, then, within, ts: str = "ts", seq: str | None = "seq",
                bucket=DEFAULT_BUCKET) -> DataFrame:
    """Each ``first`` event takes the first *later* ``then`` event of its
    key (relaxed contiguity: other rows are skipped; several firsts may
    share a then).  Gap < ``within`` -> ``matched``; otherwise ``timeout``
    (then_ts is null on timeouts, as the timeout side output carries only
    the partial match).  A ``then`` with no ``first`` is ignored.
    """
    keys = list(keys)
    # other rows take no part: they are dropped at the scan
    x = df.filter(_p(first) | _p(then)).withColumn("_a", _c(first))
    ctx = ordered_context(x, keys, ts, seq, bucket, first_next_where={"_nx": (_c(then), [ts])})
    nxt = F.col(f"_nx_{ts}")
    ok = nxt.isNotNull() & (nxt < add_duration(F.col(ts), within))
    return (ctx.filter("_a").select(
        *keys, F.col(ts).alias("first_ts"),
        F.when(ok, nxt).alias("then_ts"),
        F.when(ok, F.lit("matched")).otherwise(F.lit("timeout")).alias("outcome")))


def match_outcomes(df: DataFrame, keys, is_create, is_pay, bound, grace=None, ts: str = "ts",
                   seq: str | None = "seq", bucket=DEFAULT_BUCKET) -> DataFrame:
    """order/pay state machine with four outcomes.

    Only create/pay rows count.  A create followed next by a pay: gap <
    bound -> ``paid``; bound <= gap < bound + grace -> ``paid_late``;
    beyond -> ``timeout`` for the create and ``pay_without_create`` for the
    pay.  A create followed next by a create, or by nothing -> ``timeout``.
    A pay preceded by a pay or by nothing -> ``pay_without_create``.
    ``grace=None`` means unlimited.  Returns ``*keys, outcome, create_ts, pay_ts``.
    """
    keys = list(keys)
    x = (df.filter(_p(is_create) | _p(is_pay))
           .withColumn("_cr", _c(is_create)))
    ctx = ordered_context(x, keys, ts, seq, bucket, prev=["_cr", ts], next=["_cr", ts])

    def consumed(create_ts, pay_ts):
        if grace is None:
            return F.lit(True)
        return pay_ts < add_duration(add_duration(create_ts, bound), grace)

    t, nts, pts = F.col(ts), F.col(f"next_{ts}"), F.col(f"prev_{ts}")
    next_is_pay = F.col("next__cr").isNotNull() & ~F.col("next__cr")
    create_outcome = (F.when(next_is_pay & (nts < add_duration(t, bound)), F.lit("paid"))
                       .when(next_is_pay & consumed(t, nts), F.lit("paid_late"))
                       .otherwise(F.lit("timeout")))
    prev_is_create = F.col("prev__cr").isNotNull() & F.col("prev__cr")
    pay_consumed = prev_is_create & consumed(pts, t)
    # One pass: every create gives a row; a pay gives one unless consumed.
    is_cr = F.col("_cr")
    return (ctx.filter(is_cr | ~pay_consumed).select(
        *keys,
        F.when(is_cr, create_outcome).otherwise(F.lit("pay_without_create")).alias("outcome"),
        F.when(is_cr, t).alias("create_ts"),
        F.when(is_cr, F.when(create_outcome != F.lit("timeout"), nts)).otherwise(t).alias("pay_ts")))


def fail_bursts(df: DataFrame, keys, is_fail, span, min_count: int = 2, ts: str = "ts",
                seq: str | None = "seq", bucket=DEFAULT_BUCKET) -> DataFrame:
    """A run is a maximal stretch of fails (any other row ends it).
    With t0 the run's first fail: warn once when no breaking row has
    ts <= t0 + span and at least ``min_count`` fails of the run have
    ts <= t0 + span.  Returns ``*keys, first_ts, last_ts, n_fails``.

    The run id is a running count of non-fail rows; runs are aggregated
    with partial aggregates, and the count inside t0 + span joins on
    (key, run, time bucket), so a long run is never one task's list.
    """
    keys = list(keys)
    x = df.withColumn("_f", _c(is_fail))
    ctx = ordered_context(x, keys, ts, seq, bucket, running_count={"_run": ~F.col("_f")})
    dtype = dict(x.dtypes)[ts]
    span_us = duration_us(span)
    width = max(span_us, 1_000_000)
    us = to_micros(ts, dtype)
    # One aggregation gives each run its first fail (t0) and its breaker: the
    # breaker of run r is the non-fail row whose running count is r + 1.
    grp = F.when(F.col("_f"), F.col("_run")).otherwise(F.col("_run") - 1)
    runs = (ctx.groupBy(*keys, grp.alias("_run"))
               .agg(F.min(F.when(F.col("_f"), F.col(ts))).alias("_t0"),
                    F.min(F.when(~F.col("_f"), F.col(ts))).alias("_bk"))
               .filter(F.col("_t0").isNotNull()))
    fails = ctx.filter("_f").select(*keys, "_run", ts, F.floor(us / width).cast("long").alias("_jb"))
    # Only fails with ts <= t0 + span count; they lie in the (at most two)
    # event-time buckets from t0 to t0 + span.  Joining on the bucket too
    # keeps a very long run from landing in one task.
    t0us = to_micros("_t0", dtype)
    runs_x = runs.select(*keys, "_run", "_t0", "_bk", F.explode(F.sequence(
        F.floor(t0us / width).cast("long"), F.floor((t0us + F.lit(span_us)) / width).cast("long"))).alias("_jb"))
    limit = add_duration(F.col("_t0"), span)
    # null keys are keys too; every other join column is never null
    runs_x = runs_x.select(*[F.col(k).alias(f"_rk{i}") for i, k in enumerate(keys)], F.col("_run").alias("_rr"), "_t0", "_bk",
                           F.col("_jb").alias("_rj"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_rk{i}")) for i, k in enumerate(keys)],
                  (F.col("_run") == F.col("_rr")) & (F.col("_jb") == F.col("_rj")))
    res = (fails.join(runs_x, same)
                .filter(F.col(ts) <= limit)
                .groupBy(*keys, "_run", "_t0", "_bk")
                .agg(F.count(F.lit(1)).alias("n_fails"), F.max(ts).alias("last_ts")))
    ok = (F.col("n_fails") >= min_count) & (F.col("_bk").isNull() | (F.col("_bk") > limit))
    return res.filter(ok).select(*keys, F.col("_t0").alias("first_ts"), "last_ts",
                                 F.col("n_fails").cast("long").alias("n_fails"))
