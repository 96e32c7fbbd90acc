"""Session construction and the shared working folder."""

from __future__ import annotations

import contextlib
import getpass
import os
import tempfile
import threading

from pyspark.sql import SparkSession

# Settings that matter at scale; on a cluster the launcher's values win for
# everything it sets (builder .config only fills what is not yet set when a
# session already exists).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "vitalmart") -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_lock = threading.Lock()


def _local_default() -> str:
    """Fallback folder for local runs whose session names no checkpoint dir."""
    d = os.path.join(tempfile.gettempdir(), f"vitalmart-{getpass.getuser()}")
    os.makedirs(d, exist_ok=True)
    return d


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written tables.

    Uses ``spark.checkpoint.dir`` as the cluster names it, else the folder
    given to ``setCheckpointDir`` (Spark adds a per-application subfolder;
    its parent is the shared one). Only when nothing is set on a local master
    a folder under the system temp dir is registered; on a cluster that is an
    error, never a machine-local folder.
    """
    with _lock:
        sc = spark.sparkContext
        conf = spark.conf.get("spark.checkpoint.dir", None)
        current = sc.getCheckpointDir()
        if conf:
            if not current:
                sc.setCheckpointDir(conf)
            return conf.rstrip("/")
        if current:
            return current.rstrip("/").rsplit("/", 1)[0]
        if not sc.master.startswith("local"):
            # executors on other machines cannot share a driver-local folder
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object "
                               "store, ...) for vitalmart's written tables on a cluster")
        d = _local_default()
        sc.setCheckpointDir(d)
        return d


RUN_NAMESPACE_CONF = "spark.vitalmart.namespace"


def warehouse_path(spark: SparkSession, *parts: str) -> str:
    """<shared folder>/vitalmart[/<namespace>]/<parts>; a namespace (session
    conf) keeps e.g. a benchmark's tables apart from reusable ones."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    ns = spark.conf.get(RUN_NAMESPACE_CONF, "") or ""
    return "/".join([base, "vitalmart", *([ns] if ns else []), *parts])


TARGET_SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the files under ``paths`` (Hadoop file system sizes)."""
    sc = spark.sparkContext
    total = 0
    for p in paths:
        jp = sc._jvm.org.apache.hadoop.fs.Path(p)
        fs = jp.getFileSystem(sc._jsc.hadoopConfiguration())
        if fs.exists(jp):
            total += int(fs.getContentSummary(jp).getLength())
    return total


def shuffle_partitions_for(spark: SparkSession, paths,
                           target_bytes: int = TARGET_SHUFFLE_PARTITION_BYTES) -> int:
    """Shuffle partitions for a job reading ``paths``: input bytes / target
    (an upper bound of its shuffle after pruning and partial aggregation),
    never fewer than the session's setting; AQE coalesces what is too small."""
    current = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    wanted = -(-input_bytes(spark, paths) // target_bytes)
    return int(max(current, wanted))


@contextlib.contextmanager
def scoped_conf(spark: SparkSession, settings: dict):
    """Session settings for the duration of one job, restored afterwards."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
