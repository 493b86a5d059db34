"""Session defaults and the shared scratch location.

Results must not depend on the machine's time zone, so the session zone is pinned to UTC.
ANSI mode stays on (Spark 4 default): every parse goes through a ``try_*`` function.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # files of a checkpoint go when nothing refers to it any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "tessera",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the library defaults.

    On a cluster ``master`` is left to spark-submit; ``shuffle_partitions`` should then be
    sized so one partition holds ~128-256 MB of shuffle data at the target scale.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    pin_utc(spark)
    ensure_checkpoint_dir(spark)
    return spark


def size_for(spark: SparkSession, input_bytes: int, cores: int,
             target_bytes: int = 256 << 20) -> dict[str, str]:
    """Size partitions for a run over ``input_bytes`` on ``cores`` executor cores: scan
    splits and shuffle partitions of about ``target_bytes`` (at least two per core), the
    same size as AQE's advisory partition size, and skew handling for partitions several
    times larger. Returns the settings applied (e.g. 100 TB on 8,000 cores: ~400k shuffle
    partitions of 256 MB)."""
    parts = max(2 * cores, -(-input_bytes // target_bytes))
    conf = {
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_bytes),
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def pin_utc(spark: SparkSession) -> None:
    """Date parts, hours and date keys are computed in UTC whatever the machine zone."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (None if unset)."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return (spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
            or spark.conf.get("spark.checkpoint.dir", None))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's checkpoint folder; only when none is configured (local tests) set one.

    A machine-local folder is only acceptable in local mode, where driver and executors
    share one file system.
    """
    active = spark.sparkContext.getCheckpointDir()
    if active:
        return active
    d = checkpoint_dir(spark)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for files a job writes and reads back."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go at the end of the query that wrote them. Otherwise they stay until the
    driver collects its garbage, and the disk holds those of every step of a long run. (A DataFrame
    that is executed again computes its shuffles anew.)"""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme (for tests that inspect written files)."""
    return uri[5:] if uri.startswith("file:") else uri


__all__ = ["get_session", "size_for", "pin_utc", "checkpoint_dir", "ensure_checkpoint_dir", "scratch_path",
           "shuffles_removed", "local_path", "DEFAULTS"]
