"""Windowed aggregations: W1 sliding, W2 tumbling, W3 keyless tumbling,
A1 count per key, A2 sum under one global key, A3 hourly positional sum,
A4 buffered count per (behavior, channel), A5 exact distinct count.

Two physical forms for a sliding window of ``size``/``slide``:

* ``direct`` -- ``F.window(ts, size, slide)``: Spark expands every input
  row into size/slide copies before the partial aggregate.  One shuffle.
  Best for few overlaps.
* ``panes`` -- aggregate per slide-wide tumbling pane first (no
  expansion, map-side partial aggregate), then expand each *pane
  aggregate* into the size/slide windows that contain it and merge.  Two
  shuffles, but the expanded set is pane aggregates, not rows; the second
  grouping key is (window, key) so a hot key spreads over its windows.
  Exact for count/sum/min/max; distinct counts de-duplicate per pane
  first and stay exact.

* ``blocks`` -- pane aggregates again, but no expansion before a shuffle:
  two rows per pane, whatever size/slide is (see ``overlaps``); windows are
  written out at the very end.

``method="auto"`` picks panes when size/slide > 8 (SURVEY §4.3) and blocks
when it is above 64.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.functions.time import duration_us, floor_to, from_micros, to_micros
from eventlens.operators import overlaps

PANE_THRESHOLD = 8
BLOCK_THRESHOLD = 64

# aggregation kinds that can be merged across panes: kind -> (partial, merge)
_MERGE = {
    "count": (lambda c: F.count(F.lit(1)) if c is None else F.count(c), F.sum),
    "sum": (F.sum, F.sum),
    "min": (F.min, F.min),
    "max": (F.max, F.max),
}


def _as_col(c):
    return F.col(c) if isinstance(c, str) else c


def _norm_aggs(aggs) -> list[tuple[str, str, Column | None]]:
    """{'cnt': 'count', 'total': ('sum', 'value'), 'p50': <aggregate Column>}
    -> [(name, kind, col)].  A Column is any aggregate expression, e.g. a
    grouped-agg pandas_udf (the UDAF surface); it cannot be merged across
    panes, so it forces the direct form.  Spark evaluates pandas aggregates
    in their own aggregation, so don't mix them with built-ins in one call."""
    out = []
    for name, spec in (aggs or {"cnt": "count"}).items():
        if isinstance(spec, Column):
            out.append((name, "custom", spec))
            continue
        if isinstance(spec, str):
            kind, col = spec, None
        else:
            kind, col = spec
        if kind not in _MERGE:
            raise ValueError(f"unsupported windowed aggregate {kind!r}")
        if kind != "count" and col is None:
            raise ValueError(f"{kind} needs a column")
        out.append((name, kind, None if col is None else _as_col(col)))
    return out


def _partial(kind: str, c):
    return c if kind == "custom" else _MERGE[kind][0](c)


def _final_cast(kind: str, c: Column, dtype: str | None = None) -> Column:
    """``dtype``: the type of the direct aggregate, which a merged one takes
    (a sum of decimal sums would be wider)."""
    return c.cast("long") if kind == "count" else c.cast(dtype) if dtype else c


def choose_method(size, slide) -> str:
    if slide is None:
        return "tumbling"
    k = duration_us(size) / duration_us(slide)
    return "blocks" if k > BLOCK_THRESHOLD else "panes" if k > PANE_THRESHOLD else "direct"


def window_agg(df: DataFrame, ts: str, size, slide=None, keys=(), aggs=None,
               method: str = "auto") -> DataFrame:
    """Aggregate per (window, *keys).

    Returns ``window_start, window_end, *keys, <aggs>``; windows are
    half-open ``[start, end)`` and epoch-aligned, like ``F.window``.
    """
    keys = list(keys)
    specs = _norm_aggs(aggs)
    if slide is not None and duration_us(slide) == duration_us(size):
        slide = None
    if method == "auto":
        method = choose_method(size, slide)
    if method in ("panes", "blocks") and any(k == "custom" for _, k, _ in specs):
        method = "direct"   # a custom aggregate cannot be merged across panes
    if slide is None or method == "tumbling":
        w = F.window(ts, f"{duration_us(size)} microseconds")
        return _agg_on_window(df, w, keys, specs)
    if method == "direct":
        w = F.window(ts, f"{duration_us(size)} microseconds", f"{duration_us(slide)} microseconds")
        return _agg_on_window(df, w, keys, specs)
    if method == "panes":
        return _pane_rollup(df, ts, size, slide, keys, specs)
    if method == "blocks":
        size_us, slide_us, dtype = duration_us(size), duration_us(slide), dict(df.dtypes)[ts]
        panes, kinds = block_panes(df, ts, size_us, slide_us, keys, aggs)
        return overlaps.expanded(overlaps.pane_stretches(panes, size_us, slide_us, keys, kinds, "_rows"), size_us, slide_us, dtype, keys, list(kinds))
    raise ValueError(method)


def _agg_on_window(df, w, keys, specs):
    parts = [_final_cast(k, _partial(k, c)).alias(n) for n, k, c in specs]
    return (df.groupBy(w.alias("_w"), *keys).agg(*parts)
              .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                      *keys, *[n for n, _, _ in specs]))


def _expand_panes(panes: DataFrame, size_us: int, slide_us: int, carry: list[str], dtype: str) -> DataFrame:
    """Pane rows (``_p`` = pane start, epoch µs) -> one row per window holding
    the pane, keyed by window end (µs).  Windows start at multiples of
    ``slide``; a pane [p, p + g) lies in [s, s + size) iff
    p + g - size <= s <= p, so its windows are a contiguous range of starts."""
    g = gcd(size_us, slide_us)
    p = F.col("_p")
    first = floor_to(p + F.lit(g - size_us) + F.lit(slide_us - 1), slide_us)   # ceil to a slide multiple
    last = floor_to(p, slide_us)
    ends = F.explode(F.sequence(first + F.lit(size_us), last + F.lit(size_us), F.lit(slide_us))).alias("_e")
    return panes.select(*carry, ends)


def block_panes(df: DataFrame, ts: str, size_us: int, slide_us: int, keys: list[str], aggs) -> tuple[DataFrame, dict[str, str]]:
    """Pane aggregates with their rows counted in ``_rows``, and the kind of each aggregate."""
    specs = _norm_aggs(aggs)
    pane = floor_to(to_micros(ts, dict(df.dtypes)[ts]), gcd(size_us, slide_us))
    panes = df.where(F.col(ts).isNotNull()).groupBy(pane.alias("_p"), *keys).agg(
        *(_MERGE[k][0](c).alias(n) for n, k, c in specs), F.count(F.lit(1)).alias("_rows"))
    return panes, {n: k for n, k, _ in specs}


def _finish(df: DataFrame, size_us: int, dtype: str, keys, names) -> DataFrame:
    return df.select(from_micros(F.col("_e") - F.lit(size_us), dtype).alias("window_start"),
                     from_micros("_e", dtype).alias("window_end"), *keys, *names)


def _pane_rollup(df, ts, size, slide, keys, specs):
    size_us, slide_us = duration_us(size), duration_us(slide)
    dtype = dict(df.dtypes)[ts]
    pane_us = gcd(size_us, slide_us)
    partial = [_MERGE[k][0](c).alias(n) for n, k, c in specs]
    panes = df.groupBy(floor_to(to_micros(ts, dtype), pane_us).alias("_p"), *keys).agg(*partial)
    names = [n for n, _, _ in specs]
    x = _expand_panes(panes, size_us, slide_us, keys + names, dtype)
    types = dict(panes.dtypes)
    merged = [_final_cast(k, _MERGE[k][1](F.col(n)), types[n]).alias(n) for n, k, _ in specs]
    return _finish(x.groupBy("_e", *keys).agg(*merged), size_us, dtype, keys, names)


def window_counts(df: DataFrame, ts: str, size, slide=None, keys=(), method: str = "auto",
                  name: str = "cnt") -> DataFrame:
    """A1/A3/A4: row count per (window, *keys)."""
    return window_agg(df, ts, size, slide, keys, {name: "count"}, method)


def window_sum(df: DataFrame, ts: str, size, slide=None, value: str | None = None, keys=(),
               method: str = "auto", name: str = "total", labels: dict | None = None) -> DataFrame:
    """A2: sum of ``value`` (or of 1 per row) under one global key.

    ``labels`` adds constant columns (M4: ``{"channel": "all", "behavior": "all"}``).
    """
    spec = {name: ("sum", F.col(value))} if value else {name: "count"}
    out = window_agg(df, ts, size, slide, keys, spec, method)
    for c, v in (labels or {}).items():
        out = out.withColumn(c, F.lit(v))
    return out


def window_distinct(df: DataFrame, ts: str, size, slide=None, distinct_col: str = "user_id",
                    keys=(), method: str = "auto", name: str = "uv", approx: bool = False,
                    rsd: float = 0.05) -> DataFrame:
    """A5: exact distinct ``distinct_col`` per (window, *keys).

    Spark plans one distinct as a two-level aggregate (first by
    (window, key, value), then count), so no window is ever held as one
    set in one task.  With many overlaps the (pane, value) pairs are
    de-duplicated before the expansion; ``method="gaps"`` (auto above 64
    overlaps) does not expand them at all.  ``approx=True`` uses HLL++.
    """
    keys = list(keys)
    if approx:
        agg = F.approx_count_distinct(distinct_col, rsd).cast("long").alias(name)
    else:
        agg = F.count_distinct(F.col(distinct_col)).cast("long").alias(name)
    if slide is not None and duration_us(slide) == duration_us(size):
        slide = None
    if method == "auto":
        method = choose_method(size, slide)
    if approx and method in ("blocks", "gaps"):
        method = "panes"
    if slide is None or method in ("tumbling", "direct"):
        w = (F.window(ts, f"{duration_us(size)} microseconds") if slide is None else
             F.window(ts, f"{duration_us(size)} microseconds", f"{duration_us(slide)} microseconds"))
        return (df.groupBy(w.alias("_w"), *keys).agg(agg)
                  .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *keys, name))
    size_us, slide_us = duration_us(size), duration_us(slide)
    dtype = dict(df.dtypes)[ts]
    if method in ("gaps", "blocks"):
        out = overlaps.value_stretches(df, ts, size_us, slide_us, keys, distinct_col, name)
        return overlaps.expanded(out, size_us, slide_us, dtype, keys, [name])
    pane = floor_to(to_micros(ts, dtype), gcd(size_us, slide_us))
    panes = df.select(pane.alias("_p"), *keys, distinct_col).distinct()
    x = _expand_panes(panes, size_us, slide_us, keys + [distinct_col], dtype)
    return _finish(x.groupBy("_e", *keys).agg(agg), size_us, dtype, keys, [name])
