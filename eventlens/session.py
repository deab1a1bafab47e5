"""Session helpers.

The library itself never creates a session: every operator takes and
returns DataFrames.  These helpers are for tests, the bench and scripts.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every eventlens job relies on.  UTC keeps epoch arithmetic and
# wall-clock windows identical; AQE re-plans joins and coalesces/splits
# shuffle partitions at run time (including skewed join partitions).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make eventlens code usable in Python workers without installing it.

    Stateful processors and foreachBatch functions are pickled; registering
    the package with cloudpickle's ``register_pickle_by_value`` sends its
    classes and functions by value, so executors need nothing installed."""
    del spark  # the registration is per driver process
    if _SHIPPED:
        return
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules["eventlens"])
    _SHIPPED.add(True)


WAVES = 8  # shuffle tasks per slot at most


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int,
               target_partition_bytes: int = 256 << 20) -> dict:
    """Settings sized for the input volume (e.g. 100 TB on 1000 executors).

    Shuffle partitions start at input / target, between 2 and ``WAVES``
    times the task slots; AQE coalesces small ones and splits skewed join
    partitions at run time.  A streaming operator keeps one state store per
    partition, so streams should set a small multiple of the slots.
    File splits match the same size, so scan tasks and shuffle tasks are
    alike.
    """
    slots = executors * cores_per_executor
    # a shuffle has map tasks x partitions blocks, so partitions are capped at a few
    # waves of tasks; AQE splits the skewed ones
    parts = max(2 * slots, min(-(-input_bytes // target_partition_bytes), WAVES * slots))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        # broadcast only what the optimizer/AQE measures as small
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


STORES = 1  # state stores per slot and stateful operator at most


@contextmanager
def state_stores(spark: SparkSession):
    """Queries started inside keep ``STORES`` state stores a task slot, or the session's shuffle partitions if they are fewer.

    A store costs a task, a Python worker's turn and a commit per micro-batch, even
    if it is empty, while shuffle partitions follow the input: without this
    a bounded stream's time grows with them.  A query notes its number
    in its checkpoint, so a restart on other slots finds its stores.  A commit writes
    what the batch changed, not a snapshot of the store; snapshots follow in the background."""
    key, log = "spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    was, logged = spark.conf.get(key), spark.conf.get(log, None)
    spark.conf.set(key, str(min(int(was), STORES * max(spark.sparkContext.defaultParallelism, 4))))
    spark.conf.set(log, "true")
    try:
        yield
    finally:
        spark.conf.set(key, was)
        spark.conf.unset(log) if logged is None else spark.conf.set(log, logged)


def build_session(master: str = "local[*]", app: str = "eventlens",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local/test session with the eventlens defaults."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder the cluster names.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir) from
    the session.  When neither is set, ``fallback`` is installed; without
    one a local master gets a temporary folder, and any other master is
    an error -- a machine-local folder would be lost with its machine.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir() or fallback
    if not d:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="eventlens-checkpoints-")
    if not spark.conf.get("spark.checkpoint.dir", None):
        sc.setCheckpointDir(d)
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def stable_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder named after a query, so
    that a restarted driver finds what it left."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/eventlens/{name}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder, for one-shot runs."""
    return f"{stable_path(spark, name)}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of a finished one-shot run."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
