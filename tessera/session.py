"""Session helpers: a sensible local/test session and checkpoint-dir handling."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Settings every session we build gets. AQE re-plans joins at runtime (broadcast
# when the measured side is small, skew-join splitting, partition coalescing).
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tessera",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with ``BASE_CONF``.

    ``master`` and ``shuffle_partitions`` are only set when given, so a
    cluster submit keeps its own values.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it up if needed.

    Order: an already-set SparkContext checkpoint dir; else the session's
    ``spark.checkpoint.dir`` (the shared folder a cluster names); else, for
    a ``local`` master only (tests, benches), a fresh private folder. On a
    cluster without the setting we refuse rather than checkpoint to a
    machine-local folder that executors cannot share.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if sc.master.startswith("local"):
        base = os.environ.get("TMPDIR", "/tmp")
        path = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=base)
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir() or path
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a shared folder "
        "(HDFS/S3/...) that every executor can read")


def default_parallelism(spark: SparkSession) -> int:
    """Number of partitions to use for explicit repartitioning."""
    try:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # pragma: no cover - conf always present in practice
        n = 200
    return max(1, n)


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder for intermediate tables under the checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera-{tag}-{uuid.uuid4().hex}"


def write_read(df: DataFrame, path: str, observation: Observation | None = None,
               metrics: list | None = None) -> DataFrame:
    """Materialise ``df`` as parquet at ``path`` and return a fresh scan of it.

    A written table in the shared checkpoint folder cuts lineage durably
    (survives executor loss) and is computed once. Unlike
    ``Dataset.checkpoint`` it hands the optimizer a plain scan with no
    inherited plan constraints, so iterative plans do not grow. With an
    ``observation``, the aggregate ``metrics`` are collected during the same
    write (no extra job).
    """
    if observation is not None:
        df = df.observe(observation, *metrics)
    df.write.mode("overwrite").parquet(path)
    # the schema is known: skip footer-based inference on the way back in
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, n: int, keys: list[str], tag: str) -> DataFrame:
    """Write ``df`` in ``n`` buckets by ``keys`` under the checkpoint folder; joins on them need no exchange.

    The catalog only names the table: its files lie in the shared folder.
    """
    name = f"tessera_{tag}_{uuid.uuid4().hex}"
    df.write.bucketBy(n, *keys).option("path", scratch_path(df.sparkSession, tag)).saveAsTable(name)
    return df.sparkSession.table(name)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _users, _before = threading.RLock(), {}, {}


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within this, Spark removes a job's shuffle files when its result is written, not when the driver collects garbage.

    A written table needs none of them. Blocks of a cached table that are lost
    later are worked out again from written tables, their exchange included.
    """
    with _lock:     # may be entered from several threads of one session
        if not _users.get(spark):
            _before[spark] = spark.conf.get(_CLEANUP, "false")
            spark.conf.set(_CLEANUP, "true")
        _users[spark] = _users.get(spark, 0) + 1
    try:
        yield
    finally:
        with _lock:
            _users[spark] -= 1
            if not _users[spark]:
                spark.conf.set(_CLEANUP, _before.pop(spark))
                del _users[spark]


def remove_table(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table of ``write_read`` that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
