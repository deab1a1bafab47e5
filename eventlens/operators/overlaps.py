"""Sliding windows with many overlaps (W1, A1, A2, A5), by blocks of one window's length.

A window of ``size`` that slides by ``slide`` spans the end of one block
and the beginning of the next, when blocks are as long as the window.  So
its aggregate is a suffix of the first block merged with a prefix of the
second.  Every pane aggregate (see ``windows``) is sent to two blocks:
its own, where it counts until windows begin behind it, and the one
before, where it counts from the first window that reaches it.  Between
those two kinds of change points the result is constant, so a block
holds at most two rows per pane, whatever size / slide is, and the result
comes out as stretches of equal windows.  Nothing is subtracted: sums of
doubles stay sums, and minimum and maximum work alike.

A (key, block) group is bounded by the panes of two blocks, so a hot key
is spread over time.

Distinct values are counted by gaps: of a value's panes, each counts in
the windows that hold it but not the value's pane before.  Those windows
are one stretch, so a pane adds one at its first and takes one away
behind its last, and a running sum over these changes gives the count.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.functions.time import duration_us, floor_to, from_micros, to_micros


def _next_start(us: Column, slide_us: int) -> Column:
    """The first window start behind ``us``."""
    return floor_to(us, slide_us) + F.lit(slide_us)


def _first_start(us: Column, slide_us: int) -> Column:
    """The first window start not before ``us``."""
    return floor_to(us + F.lit(slide_us - 1), slide_us)


def _merged(kind: str, a: Column, b: Column) -> Column:
    if kind in ("min", "max"):  # both skip nulls
        return (F.least if kind == "min" else F.greatest)(a, b)
    return F.coalesce(a + b, a, b)


_AGAIN = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def _stretches(out: DataFrame, size_us: int, dtype: str, keys, names) -> DataFrame:
    return out.select(from_micros("_s", dtype).alias("first_start"), from_micros("_last", dtype).alias("last_start"),
                      from_micros(F.col("_s") + F.lit(size_us), dtype).alias("first_end"),
                      from_micros(F.col("_last") + F.lit(size_us), dtype).alias("last_end"), *keys, *names)


def pane_stretches(panes: DataFrame, size_us: int, slide_us: int, keys: list[str], kinds: dict[str, str], rows: str) -> DataFrame:
    """Stretches of windows from pane aggregates.

    ``panes``: ``_p`` (start in epoch µs), ``keys``, one column for each of
    ``kinds`` (count, sum, min or max) and ``rows``, the pane's number of
    rows, which tells windows without any.  Returns ``_s`` and ``_last`` (first
    and last window start), ``keys`` and the aggregates."""
    names = [*kinds, rows]
    kinds = {**kinds, rows: "count"}
    own = F.floor(F.col("_p") / size_us).cast("long")
    types = dict(panes.dtypes)

    def role(own_block: bool) -> Column:
        at = F.col("_p") if own_block else F.col("_p") - F.lit(size_us)
        return F.struct((own if own_block else own - 1).alias("_b"), _next_start(at, slide_us).alias("_s"),
                        *(F.when(F.lit(own_block), F.col(n)).alias(f"_a{i}") for i, n in enumerate(names)),
                        *(F.when(F.lit(not own_block), F.col(n)).alias(f"_z{i}") for i, n in enumerate(names)))
    begin = F.struct(F.col("x._b").alias("_b"), _first_start(F.col("x._b") * size_us, slide_us).alias("_s"),
                     *(F.lit(None).cast(types[n]).alias(f"_{k}{i}") for k in "az" for i, n in enumerate(names)))
    both = panes.select(*keys, F.explode(F.array(role(True), role(False))).alias("x"))
    # each block also has a change at its first window; no later exchange is needed: a block lies in one place
    placed = both.select(*keys, F.explode(F.array(F.col("x"), begin)).alias("x")).select(*keys, "x.*").repartition(*keys, "_b")
    end = _first_start((F.col("_b") + 1) * size_us, slide_us)
    changes = (placed.withColumn("_s", F.least("_s", end)).groupBy(*keys, "_b", "_s")
               .agg(*(_AGAIN[kinds[n]](f"_{k}{i}").alias(f"_{k}{i}") for k in "az" for i, n in enumerate(names))))
    block = Window.partitionBy(*keys, "_b")
    # both frames grow by one row at a time
    prefix = block.orderBy("_s").rowsBetween(Window.unboundedPreceding, 0)
    suffix = block.orderBy(F.col("_s").desc()).rowsBetween(Window.unboundedPreceding, -1)
    steps = changes.select(
        *keys, "_b", "_s", F.lead("_s").over(block.orderBy("_s")).alias("_next"),
        *(_AGAIN[kinds[n]](f"_z{i}").over(prefix).alias(f"_z{i}") for i, n in enumerate(names)),
        *(_AGAIN[kinds[n]](f"_a{i}").over(suffix).alias(f"_a{i}") for i, n in enumerate(names)))
    out = steps.select(*keys, "_s", (F.coalesce("_next", end) - F.lit(slide_us)).alias("_last"),
                       *(_merged(kinds[n], F.col(f"_a{i}"), F.col(f"_z{i}")).cast("long" if kinds[n] == "count" else types[n]).alias(n)
                         for i, n in enumerate(names)))
    return out.where((F.col(rows) > 0) & (F.col("_last") >= F.col("_s")))


def value_stretches(df: DataFrame, ts: str, size_us: int, slide_us: int, keys: list[str], value: str, name: str) -> DataFrame:
    """Stretches of windows with the number of distinct values (null is none, but its rows make a window)."""
    dtype = dict(df.dtypes)[ts]
    pane = floor_to(to_micros(ts, dtype), gcd(size_us, slide_us))
    panes = df.where(F.col(ts).isNotNull()).select(pane.alias("_p"), *keys, F.col(value).alias("_v")).distinct()
    # a value's panes of one block, with those of the block before: no value is held whole
    own = F.floor(F.col("_p") / size_us).cast("long")
    seen = panes.select("*", F.explode(F.array(F.struct(own.alias("_b"), F.lit(True).alias("_own")), F.struct((own + 1).alias("_b"), F.lit(False).alias("_own")))).alias("x"))
    before = F.lag("_p").over(Window.partitionBy(*keys, "_v", "x._b").orderBy("_p"))
    first = _next_start(F.greatest(F.col("_p") - F.lit(size_us), F.col("_before")), slide_us)
    new = (seen.withColumn("_before", before).where("x._own")
           .select(*keys, "_v", first.alias("_s"), floor_to(F.col("_p"), slide_us).alias("_last")).where("_s <= _last"))
    # changes, cut at the blocks of window starts
    b = F.explode(F.sequence(F.floor(F.col("_s") / size_us).cast("long"), F.floor(F.col("_last") / size_us).cast("long"))).alias("_b")
    cut = new.select(*keys, "_v", "_s", "_last", b)
    one = F.col("_v").isNotNull().cast("long")
    at = F.explode(F.array(
        F.struct(F.greatest("_s", _first_start(F.col("_b") * size_us, slide_us)).alias("_s"), one.alias("_d"), F.lit(1).cast("long").alias("_n")),
        F.struct((F.col("_last") + F.lit(slide_us)).alias("_s"), (-one).alias("_d"), F.lit(-1).cast("long").alias("_n")))).alias("x")
    end = _first_start((F.col("_b") + 1) * size_us, slide_us)
    changes = (cut.select(*keys, "_b", at).select(*keys, "_b", "x.*").where(F.col("_s") < end)
               .groupBy(*keys, "_b", "_s").agg(F.sum("_d").alias("_d"), F.sum("_n").alias("_n")))
    block = Window.partitionBy(*keys, "_b").orderBy("_s")
    steps = changes.select(*keys, "_s", (F.coalesce(F.lead("_s").over(block), end) - F.lit(slide_us)).alias("_last"),
                           F.sum("_d").over(block).alias(name), F.sum("_n").over(block).alias("_n"))
    return steps.where("_n > 0 and _last >= _s").select(*keys, "_s", "_last", name)


def expanded(stretches: DataFrame, size_us: int, slide_us: int, dtype: str, keys, names) -> DataFrame:
    """One row per window of each stretch."""
    each = stretches.select(*keys, *names, F.explode(F.sequence("_s", "_last", F.lit(slide_us))).alias("_w"))
    return each.select(from_micros("_w", dtype).alias("window_start"), from_micros(F.col("_w") + F.lit(size_us), dtype).alias("window_end"), *keys, *names)


def window_changes(df: DataFrame, ts: str, size, slide, keys=(), aggs=None) -> DataFrame:
    """The windowed aggregates of :func:`windows.window_agg` as stretches.

    Returns ``first_start, last_start, first_end, last_end, *keys, <aggs>``: all
    windows from the first to the last start, ``slide`` apart, have these
    values.  Neighbouring stretches with equal values are one."""
    from eventlens.operators.windows import block_panes
    keys = list(keys)
    size_us, slide_us = duration_us(size), duration_us(slide)
    dtype = dict(df.dtypes)[ts]
    panes, kinds = block_panes(df, ts, size_us, slide_us, keys, aggs)
    return _stretches(_fused(pane_stretches(panes, size_us, slide_us, keys, kinds, "_rows"), slide_us, size_us, keys, list(kinds)),
                      size_us, dtype, keys, list(kinds))


def _fused(s: DataFrame, slide_us: int, size_us: int, keys, names) -> DataFrame:
    """Neighbouring stretches of equal values as one; a chain may run over any number of blocks.

    Inside a block chains are numbered by a running sum.  What touches the
    blocks' edges is one row per block, and only those meet per key."""
    value = F.struct(*(F.col(n) for n in names))
    block = F.floor(F.col("_s") / size_us)
    x = s.withColumn("_b", block).withColumn("_value", value)
    order = Window.partitionBy(*keys, "_b").orderBy("_s")
    follows = (F.lag("_last").over(order) + F.lit(slide_us)).eqNullSafe(F.col("_s")) & F.lag("_value").over(order).eqNullSafe(F.col("_value"))
    x = x.withColumn("_new", (~follows).cast("long")).withColumn("_c", F.sum("_new").over(order))
    inside = x.groupBy(*keys, "_b", "_c").agg(F.min("_s").alias("_s"), F.max("_last").alias("_last"), F.first("_value").alias("_value"))
    edge_lo = F.col("_s") == _first_start(F.col("_b") * size_us, slide_us)
    edge_hi = F.col("_last") + F.lit(slide_us) == _first_start((F.col("_b") + 1) * size_us, slide_us)
    done = inside.where(~(edge_lo | edge_hi)).select(*keys, "_s", "_last", "_value")
    rim = inside.where(edge_lo | edge_hi)
    by_key = Window.partitionBy(*keys).orderBy("_s")
    joins = (F.lag("_last").over(by_key) + F.lit(slide_us)).eqNullSafe(F.col("_s")) & F.lag("_value").over(by_key).eqNullSafe(F.col("_value"))
    rim = rim.withColumn("_new", (~joins).cast("long")).withColumn("_c", F.sum("_new").over(by_key))
    rim = rim.groupBy(*keys, "_c").agg(F.min("_s").alias("_s"), F.max("_last").alias("_last"), F.first("_value").alias("_value"))
    return done.unionByName(rim.select(*keys, "_s", "_last", "_value")).select(*keys, "_s", "_last", *(F.col("_value")[n].alias(n) for n in names))
