"""Session settings the library relies on, and the shared checkpoint folder.

Library functions never create a session; they take the caller's.  The only
setting they need is a UTC session time zone when epoch numbers are turned
into ``TIMESTAMP`` (streams and text sources).  The test tables carry
``TIMESTAMP_NTZ`` and are zone-free.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings for a cluster run.  Shuffle partitions are left to AQE: it starts
# from ``spark.sql.shuffle.partitions`` and coalesces small ones, and splits
# skewed join partitions.
SCALE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Streams keep keyed state in RocksDB, off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app: str = "tidewatch",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests, the bench and command-line runs.  A
    ``spark.checkpoint.dir`` already configured for the cluster is kept."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names storage every executor reaches; it is a
    static setting, read here; it is applied only where Spark has not done so.  Only in local mode, where
    it is unset (tests), is a folder under the system temp directory used;
    a cluster without it is an error rather than a machine-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    named = bool(root or spark.sparkContext.getConf().get("spark.checkpoint.dir", None))
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        global _LOCAL_ROOT
        if _LOCAL_ROOT is None:
            import tempfile
            _LOCAL_ROOT = tempfile.mkdtemp(prefix="tidewatch-ckpt-")
        root = _LOCAL_ROOT
    if not named or not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)          # the session's own setting is left as it is
    return root


_LOCAL_ROOT: str | None = None


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """Checkpoint location for one streaming query, under the shared root."""
    return os.path.join(checkpoint_root(spark), "streams", name)

