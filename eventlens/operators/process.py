"""Keyed process functions in batch: a user's machine replayed over sorted rows.

``process`` runs any :class:`eventlens.streaming.machines.Machine`, the
form streams use, over a bounded table: rows are placed by key and
sorted by (key, ts, seq), and one pass carries the machine from row to
row across Arrow batches, so no key is ever held.  At a key's end the
watermark passes everything, which fires the timers left.

A key with more than ``split_rows`` rows is cut at quantiles of its time
into slices of about that many rows, and the slices are replayed in turn:
each step runs one slice of every hot key, all keys in parallel, and
writes the carries that the next step starts from.  So a task's work is
bounded, though a hot key's slices follow each other, as its state asks.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.functions.time import epoch_micros
from eventlens.session import scratch_path, ship_package
from eventlens.streaming.machines import Machine

SPLIT_ROWS = 1_000_000
#: Hot keys cut at most, the largest first: the table of cuts is bounded.
MAX_HOT = 10_000
END = 1 << 62


def _replay(machine: Machine, n_keys: int, fields: list[str], last: bool):
    """mapInArrow over sorted rows (keys, us, seq, fields, carry): outputs, or at a slice's end the carry.

    A row without a time carries a machine over from the slice before."""
    names = [n for n, _ in machine.out_fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        schema = None
        key: tuple | None = None
        c = machine.init()

        def finish() -> None:
            nonlocal c
            if key is not None:
                if last:
                    held.extend((*key, *(o.get(n) for n in names), None) for o in machine.advance(c, END))
                else:
                    held.append((*key, *([None] * len(names)), pickle.dumps(c)))
            c = machine.init()

        def pack() -> pa.RecordBatch:
            cols = list(zip(*held))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(cols, schema)], names=[f.name for f in schema])
        for b in batches:
            if schema is None:
                schema = [pa.field(f"k{i}", b.schema.field(i).type) for i in range(n_keys)]
                schema += [pa.field(f"o{i}", {"long": pa.int64(), "string": pa.string()}[t]) for i, (_, t) in enumerate(machine.out_fields)]
                schema.append(pa.field("carry", pa.binary()))
            for row in zip(*(x.to_pylist() for x in b.columns)):
                if row[:n_keys] != key:
                    finish()
                    key = row[:n_keys]
                us, seq, carry = row[n_keys], row[n_keys + 1], row[-1]
                if us is None:
                    c = pickle.loads(carry)
                    continue
                r = {"ts": us, "seq": seq, **dict(zip(fields, row[n_keys + 2:-1]))}
                out = machine.advance(c, us) + machine.step(c, r)
                held.extend((*key, *(o.get(n) for n in names), None) for o in out)
                if len(held) >= 4096:
                    yield pack()
        finish()
        if held:
            yield pack()
    return run


def process(df: DataFrame, keys, ts: str, seq: str | None, machine: Machine, payload: dict, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Key columns and the machine's outputs (``*_ts`` longs as timestamps), as ``streaming.replay`` gives them.

    ``payload`` names the machine's fields as Columns.  Rows without a time are
    left out; a null key is a key."""
    spark = df.sparkSession
    ship_package(spark)
    keys = list(keys)
    kn = [f"k{i}" for i in range(len(keys))]
    seq_col = F.coalesce(F.col(seq).cast("long"), F.lit(-(1 << 63))) if seq else F.lit(0).cast("long")
    rows = df.where(F.col(ts).isNotNull()).select(*(F.col(k).alias(a) for k, a in zip(keys, kn)), epoch_micros(ts).alias("us"),
                                                  seq_col.alias("seq"), *(payload[f].alias(f"f{i}") for i, f in enumerate(machine.fields)),
                                                  F.lit(None).cast("binary").alias("carry"))
    out = T.StructType([*(T.StructField(a, rows.schema[a].dataType) for a in kn),
                        *(T.StructField(f"o{i}", T._parse_datatype_string(t)) for i, (_, t) in enumerate(machine.out_fields)),
                        T.StructField("carry", T.BinaryType())])

    def replayed(some: DataFrame, last: bool) -> DataFrame:
        placed = some.repartition(*kn).sortWithinPartitions(*kn, F.col("us").asc_nulls_first(), "seq")
        return placed.mapInArrow(_replay(machine, len(kn), list(machine.fields), last), out)
    counts = rows.groupBy(*kn).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > split_rows)
    hot = counts.orderBy(F.col("_n").desc(), *kn).limit(MAX_HOT).collect()
    if not hot:
        got = replayed(rows, True)
    else:
        root = scratch_path(spark, "process")
        table = spark.createDataFrame(hot, counts.schema)
        same = [F.col(a).eqNullSafe(F.col(f"h_{a}")) for a in kn]
        marked = rows.join(F.broadcast(table.toDF(*(f"h_{a}" for a in kn), "_n")), [*same], "left")
        cold = marked.where("_n is null").select(rows.columns)
        hot_rows = marked.where("_n is not null").select(*rows.columns, "_n")
        steps = max(math.ceil(r._n / split_rows) for r in hot)
        # cuts at measured quantiles; rows of one instant stay together
        share = [i / steps for i in range(1, steps)]
        cuts = hot_rows.groupBy(*kn).agg(F.percentile_approx("us", share, 10_000).alias("_cuts") if share else F.array().cast("array<long>").alias("_cuts"))
        cuts = spark.createDataFrame(cuts.collect(), cuts.schema).toDF(*(f"h_{a}" for a in kn), "_cuts")
        cut = hot_rows.join(F.broadcast(cuts), [*same]).withColumn("_slice", F.size(F.filter("_cuts", lambda x: x < F.col("us"))))
        cut.select(*rows.columns, "_slice").repartition("_slice", *kn).write.partitionBy("_slice").parquet(f"{root}/rows")
        sliced = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("_slice", T.IntegerType())])).parquet(f"{root}/rows")
        got, carry = replayed(cold, True), None
        for i in range(steps):
            part = sliced.where(F.col("_slice") == i).select(rows.columns)
            part = part if carry is None else part.unionByName(carry)
            replayed(part, i == steps - 1).write.parquet(f"{root}/step-{i}")
            done = spark.read.schema(out).parquet(f"{root}/step-{i}")
            got = got.unionByName(done.where("carry is null"))
            empty = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns if c not in (*kn, "carry")]
            carry = done.where("carry is not null").select(*kn, *empty, "carry").select(rows.columns)
    types = dict(df.dtypes)[ts]
    cols = []
    for i, (n, t) in enumerate(machine.out_fields):
        c = F.col(f"o{i}")
        cols.append((F.timestamp_micros(c).cast(types) if t == "long" and n.endswith("_ts") else c).alias(n))
    return got.select(*(F.col(a).alias(k) for a, k in zip(kn, keys)), *cols)
