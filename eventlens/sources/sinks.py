"""S5 console sink and S6 side outputs.

A side output is one DataFrame with a tag column; ``split_by_tag`` gives
one filtered DataFrame per tag (Catalyst pushes each filter down), and
``start_tagged_stream`` writes every micro-batch partitioned by tag
through ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.session import stable_path


def split_by_tag(df: DataFrame, tag_col: str, tags) -> dict[str, DataFrame]:
    return {t: df.filter(F.col(tag_col) == F.lit(t)) for t in tags}


def console_sink(df: DataFrame, label: str, output_mode: str = "append", n: int = 1000, **opts):
    """Labelled print of at most ``n`` rows (per micro-batch on a stream); a
    batch print says when rows are left out."""
    if df.isStreaming:
        return (df.writeStream.format("console").queryName(label)
                .outputMode(output_mode).option("truncate", "false")
                .option("numRows", n)
                .option("checkpointLocation", opts.get("checkpoint") or
                        stable_path(df.sparkSession, f"console-{label}"))
                .start())
    print(f"== {label} ==")
    df.show(n, truncate=False)
    if len(df.limit(n + 1).take(n + 1)) > n:
        print(f"== {label}: only the first {n} rows are shown ==")
    return None


def start_tagged_stream(df: DataFrame, tag_col: str, out_root: str, fmt: str = "parquet",
                        checkpoint: str | None = None, trigger: dict | None = None,
                        output_mode: str = "append"):
    """Stream sink writing ``{out_root}/batch=<id>/<tag_col>=<tag>/``.

    Idempotent per batch: a re-run batch (after a failure) overwrites the
    same ``batch=<id>`` sub-folder instead of appending twice.
    """
    def write_batch(batch: DataFrame, batch_id: int):
        (batch.write.mode("overwrite").format(fmt).partitionBy(tag_col)
              .save(f"{out_root}/batch={batch_id}"))

    w = (df.writeStream.foreachBatch(write_batch).outputMode(output_mode)
         .option("checkpointLocation", checkpoint or f"{out_root.rstrip('/')}-checkpoint"))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
