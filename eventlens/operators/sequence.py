"""Ordered context within a key, without sending a hot key to one task.

Per-key detectors need, for every row in (ts, seq) order within its key:
the previous row, the next row, the first later row matching a
condition, a running count, or the row's position.  Ordinary keys get a
plain window: one shuffle of the data on the key.  A key holding a third
of all rows would stall that task, so hot keys are spread further:

1. a partial aggregate counts rows per key; the (at most ``MAX_HOT``)
   largest keys above ``split_rows`` are hot, a bounded table;
2. every row gets its place: ordinary keys have one place, a hot key one
   per event-time bucket of width ``bucket``; a bucket that is itself hot
   is cut at measured quantiles of ``ts``, and rows that share an instant
   at measured quantiles of the tiebreak;
3. the window functions run inside (key, place) -- the only shuffle of
   the data;
4. hot rows alone are summarised to one row per (key, place), aggregated
   map-side, and a window over that summary carries values across places;
5. the summary is joined back on the columns the data is partitioned by.

Whether any key is hot is looked up when the plan is built (a row count,
and only above the limit a count per key, which is written and used
again); without one the plan is the plain window alone.  Results equal the single-window form exactly,
whatever the bucket width or limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.functions.time import bucket_of
from eventlens.session import scratch_path

DEFAULT_BUCKET = "1 hour"
DEFAULT_SPLIT_ROWS = 4_000_000   # a key, or a place of a hot key, above this is split
MAX_HOT = 50_000                 # hot keys, the largest first; any other has fewer than rows / MAX_HOT rows
MAX_CUT = 4_000                  # places cut at quantiles, the largest first
QUANTILES = 256
_INTEGRAL = ("bigint", "int", "smallint", "tinyint")
_NUMERIC = (*_INTEGRAL, "float", "double")
_EARLIEST = -(10 ** 17)          # micros before any timestamp: a null ts sorts first
_PLACE = ["_b", "_s", "_t"]


def _key_columns(df: DataFrame, keys: list) -> tuple[DataFrame, list]:
    """Plain non-null columns that identify a key, so that joins and windows
    on them share one partitioning."""
    types = dict(df.dtypes)
    names = []
    for i, k in enumerate(keys):
        c = F.col(f"`{k}`")
        plain = F.lit(0).cast(types[k]) if types[k] in _INTEGRAL else F.lit("")
        c = c if types[k] in _INTEGRAL else c.cast("string")
        df = df.withColumns({f"_kc{i}": F.coalesce(c, plain), f"_kn{i}": F.col(f"`{k}`").isNull()})
        names += [f"_kc{i}", f"_kn{i}"]
    return df, names


def _cut(x: DataFrame, kc: list, at: list, value: Column, name: str, split_rows: int) -> DataFrame:
    """Column ``name``: the quantile range of ``value`` a row lies in, for
    (key, place) groups of hot keys above ``split_rows`` rows, else 0."""
    share = F.array(*[F.lit(i / QUANTILES) for i in range(1, QUANTILES)])
    cuts = (x.where("_hot").withColumn("_v", value).groupBy(*kc, *at)
            .agg(F.count(F.lit(1)).alias("_hn"), F.array_distinct(F.percentile_approx("_v", share, F.lit(4096))).alias("_cuts"))
            .where(F.col("_hn") > int(split_rows)).orderBy(F.col("_hn").desc(), *kc, *at).limit(MAX_CUT).drop("_hn"))
    j = x.withColumn("_v", value).join(F.broadcast(cuts), [*kc, *at], "left")
    return j.withColumn(name, F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col("_v"))), F.lit(0))).drop("_v", "_cuts")


def _hot_keys(x: DataFrame, kc: list, split_rows: int) -> DataFrame | None:
    """The keys above ``split_rows``, counted once and written, or None without any."""
    if x.count() <= split_rows:
        return None
    counts = x.groupBy(*kc).agg(F.count(F.lit(1)).alias("_hn")).where(F.col("_hn") > int(split_rows))
    path = scratch_path(x.sparkSession, "hot-keys")
    counts.orderBy(F.col("_hn").desc(), *kc).limit(MAX_HOT).write.parquet(path)
    hot = x.sparkSession.read.schema(counts.schema).parquet(path)
    return None if hot.isEmpty() else hot


def _placed(df: DataFrame, keys: list, ts: str, seqs: list, bucket, split_rows) -> tuple[DataFrame, list]:
    """Rows with their key columns, ``_hot`` and place."""
    x, kc = _key_columns(df, keys)
    one = {"_b": F.lit(0).cast("long"), "_s": F.lit(0), "_t": F.lit(0)}
    counted = _hot_keys(x, kc, split_rows) if split_rows else None
    if counted is None:
        return x.withColumns({"_hot": F.lit(False), **one}), kc
    # the limit is that of the written table, said again for the broadcast
    hot = counted.limit(MAX_HOT).select(*kc, F.lit(True).alias("_hot"))
    x = x.join(F.broadcast(hot), kc, "left").withColumn("_hot", F.coalesce("_hot", F.lit(False)))
    x = x.withColumn("_b", F.when(F.col("_hot"), F.coalesce(bucket_of(ts, bucket), F.lit(-(1 << 62)))).otherwise(one["_b"]))
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    x = _cut(x, kc, ["_b"], F.coalesce(us, F.lit(_EARLIEST)), "_s", split_rows)
    tie = seqs[0] if seqs and dict(df.dtypes)[seqs[0]] in _NUMERIC else None
    if tie is None:
        return x.withColumn("_t", one["_t"]), kc
    # quantile ranges of ts end at an instant, so a range above the limit is mostly one instant;
    # rows are cut by the tiebreak only where the range holds a single one
    x = x.withColumn("_us", F.coalesce(us, F.lit(_EARLIEST)))
    same = (x.where("_hot").groupBy(*kc, "_b", "_s").agg(F.count(F.lit(1)).alias("_hn"), F.max("_us").alias("_top"))
            .where(F.col("_hn") > int(split_rows)).orderBy(F.col("_hn").desc(), *kc, "_b", "_s").limit(MAX_CUT).drop("_hn"))
    x = x.join(F.broadcast(same), [*kc, "_b", "_s"], "left")
    # the instant at the range's end, and what lies before it, are ranges of their own
    x = x.withColumn("_s", F.when(F.col("_top").isNull(), 2 * F.col("_s"))
                     .otherwise(2 * F.col("_s") + (F.col("_us") == F.col("_top")).cast("int")))
    x = x.withColumn("_end", F.coalesce(F.col("_us") == F.col("_top"), F.lit(False))).drop("_top", "_us")
    v = F.when(F.col("_end"), F.coalesce(F.col(tie).cast("double"), F.lit(float("-inf"))))
    return _cut(x, kc, ["_b", "_s"], v, "_t", split_rows).drop("_end"), kc


def _packed_order(df: DataFrame, ts: str, seqs: list) -> Column | None:
    """(ts, seq) as one DECIMAL(38,0) preserving their order, or None."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    if not seqs:
        return F.coalesce(micros, F.lit(_EARLIEST)).cast("decimal(38,0)")
    if len(seqs) > 1 or dict(df.dtypes)[seqs[0]] not in _INTEGRAL:
        return None
    shift = F.expr("CAST('9223372036854775808' AS DECIMAL(38,0))")
    scale = F.expr("CAST('100000000000000000000' AS DECIMAL(38,0))")
    tie = F.coalesce(F.col(seqs[0]).cast("decimal(38,0)"), -shift)   # null first, as the windows sort
    return F.coalesce(micros, F.lit(_EARLIEST)).cast("decimal(38,0)") * scale + (tie + shift)


def _cond(c) -> Column:
    return F.expr(c) if isinstance(c, str) else c


def ordered_context(df: DataFrame, keys, ts: str = "ts", seq="seq",
                    bucket=DEFAULT_BUCKET, prev=(), next=(), first_next_where=None,
                    running_count=None, rank: bool = False, split_rows="default") -> DataFrame:
    """Add context columns in (ts, seq) order within ``keys``.

    ``seq`` is a tiebreak column name or a list of them; null sorts first.
    A key holding more than ``split_rows`` rows is spread over event-time
    buckets and measured quantile ranges (``None`` turns that off).

    * ``prev=[c..]`` -> ``prev_<c>`` from the previous row (null on the first)
    * ``next=[c..]`` -> ``next_<c>`` from the next row (null on the last)
    * ``first_next_where={name: (cond, [c..])}`` -> ``<name>_<c>`` from the
      first *later* row satisfying ``cond`` (null if none)
    * ``running_count={name: cond}`` -> ``<name>``: rows satisfying ``cond``
      at or before this row
    * ``rank=True`` -> ``rank``: 1-based position of the row in its key
    """
    keys = list(keys)
    seqs = [seq] if isinstance(seq, str) else list(seq or [])
    missing = [c for c in seqs if c not in df.columns]
    if missing:
        raise ValueError(f"no tiebreak column {', '.join(missing)}")
    order_names = [ts] + [c for c in seqs if c != ts]
    order = [F.col(c) for c in order_names]
    fnw = dict(first_next_where or {})
    rcs = dict(running_count or {})
    prev, next = list(prev), list(next)

    if split_rows == "default":
        split_rows = DEFAULT_SPLIT_ROWS
    x, kc = _placed(df, keys, ts, order_names[1:], bucket, split_rows)
    for n, (c, _) in fnw.items():
        x = x.withColumn(f"_fc_{n}", _cond(c))
    for n, c in rcs.items():
        x = x.withColumn(f"_rc_{n}", F.when(_cond(c), 1).otherwise(0).cast("long"))

    at = [*kc, *_PLACE]
    w = Window.partitionBy(*at).orderBy(*order)
    after = w.rowsBetween(1, Window.unboundedFollowing)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    y = x
    if prev:
        y = y.withColumn("_pv", F.lag(F.struct(*prev)).over(w))
    if next:
        y = y.withColumn("_nx", F.lead(F.struct(*next)).over(w))
    if prev or rank:
        y = y.withColumn("_rib", F.row_number().over(w))
    for n, (_, cols) in fnw.items():
        y = y.withColumn(f"_ff_{n}", F.first(F.when(F.col(f"_fc_{n}"), F.struct(*cols)), ignorenulls=True).over(after))
    for n in rcs:
        y = y.withColumn(f"_rcv_{n}", F.sum(f"_rc_{n}").over(upto))

    # Summary of the places of hot keys, aggregated map-side before its own (small) shuffle.
    # With a single integral tiebreak, (ts, seq) is packed into one
    # fixed-width DECIMAL(38,0) so max_by/min_by stay in a HashAggregate;
    # otherwise fall back to struct min/max (sort-based aggregate).
    x = x.where("_hot")
    ok = _packed_order(x, ts, order_names[1:])
    aggs = [F.count(F.lit(1)).alias("_n")]
    if ok is not None:
        x = x.withColumn("_ord", ok)
        for c in prev:
            aggs.append(F.max_by(c, "_ord").alias(f"_last_{c}"))
        for c in next:
            aggs.append(F.min_by(c, "_ord").alias(f"_first_{c}"))
        for n, (_, cols) in fnw.items():
            o = F.when(F.col(f"_fc_{n}"), F.col("_ord"))
            aggs.append(F.min(o).alias(f"_ffx_{n}"))
            aggs += [F.min_by(c, o).alias(f"_ffb_{n}_{c}") for c in cols]
        last = lambda c: F.col(f"_last_{c}")
        first = lambda c: F.col(f"_first_{c}")
        ffb = lambda n, cols: F.when(F.col(f"_ffx_{n}").isNotNull(),
                                     F.struct(*[F.col(f"_ffb_{n}_{c}").alias(c) for c in cols]))
    else:
        if prev:
            aggs.append(F.max(F.struct(*order, F.struct(*prev).alias("v"))).alias("_last"))
        if next:
            aggs.append(F.min(F.struct(*order, F.struct(*next).alias("v"))).alias("_first"))
        for n, (_, cols) in fnw.items():
            aggs.append(F.min(F.when(F.col(f"_fc_{n}"), F.struct(*order, F.struct(*cols).alias("v"))))
                        .alias(f"_ffb_{n}"))
        last = lambda c: F.col(f"_last.v.{c}")
        first = lambda c: F.col(f"_first.v.{c}")
        ffb = lambda n, cols: F.col(f"_ffb_{n}.v")
    for n in rcs:
        aggs.append(F.sum(f"_rc_{n}").alias(f"_rcb_{n}"))
    s = x.groupBy(*at).agg(*aggs)

    sw = Window.partitionBy(*kc).orderBy(*_PLACE)
    before = sw.rowsBetween(Window.unboundedPreceding, -1)
    later = sw.rowsBetween(1, Window.unboundedFollowing)
    sel = [F.col(c) for c in at]
    if prev:
        sel.append(F.struct(*[F.lag(last(c)).over(sw).alias(c) for c in prev]).alias("_pl"))
    if next:
        sel.append(F.struct(*[F.lead(first(c)).over(sw).alias(c) for c in next]).alias("_nf"))
    if rank:
        sel.append(F.sum("_n").over(before).alias("_off"))
    for n, (_, cols) in fnw.items():
        sel.append(F.first(ffb(n, cols), ignorenulls=True).over(later).alias(f"_ffn_{n}"))
    for n in rcs:
        sel.append(F.coalesce(F.sum(f"_rcb_{n}").over(before), F.lit(0)).alias(f"_rco_{n}"))
    s2 = s.select(*sel)

    j = y.join(s2, at, "left")

    out = j
    for c in prev:
        out = out.withColumn(f"prev_{c}", F.when(F.col("_rib") == 1, F.col(f"_pl.{c}")).otherwise(F.col(f"_pv.{c}")))
    for c in next:
        out = out.withColumn(f"next_{c}", F.when(F.col("_nx").isNull(), F.col(f"_nf.{c}")).otherwise(F.col(f"_nx.{c}")))
    for n, (_, cols) in fnw.items():
        for c in cols:
            out = out.withColumn(f"{n}_{c}", F.when(F.col(f"_ff_{n}").isNull(), F.col(f"_ffn_{n}.{c}"))
                                 .otherwise(F.col(f"_ff_{n}.{c}")))
    for n in rcs:
        out = out.withColumn(n, F.coalesce(F.col(f"_rco_{n}"), F.lit(0)) + F.col(f"_rcv_{n}"))
    if rank:
        out = out.withColumn("rank", (F.coalesce("_off", F.lit(0)) + F.col("_rib")).cast("long"))
    produced = {f"prev_{c}" for c in prev} | {f"next_{c}" for c in next} | set(rcs) | {"rank"}
    produced |= {f"{n}_{c}" for n, (_, cols) in fnw.items() for c in cols}
    drop = [c for c in out.columns if c.startswith("_") and c not in df.columns and c not in produced]
    return out.drop(*drop)
