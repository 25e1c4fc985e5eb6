"""SparkSession settings kept in one place.

Operators never depend on ``spark.sql.session.timeZone``: every time function
takes an explicit ``tz``.  The session settings below only tune execution.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# The zone the reference's jobs run in, and its run-time settings.
DEFAULT_TZ = "Asia/Shanghai"
WATERMARK_DELAY = "2 seconds"
WINDOW_SIZE = "10 seconds"
CHECKPOINT_INTERVAL = "5 seconds"

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(
    master: str = "local[*]",
    app_name: str = "flowmart",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session tuned for the warehouse jobs.

    * AQE on, with partition coalescing and skew-join splitting, so hot keys
      (a single mid or uid can carry a third of all rows) are split at run time.
    * Joins broadcast only sides whose size in bytes is known to be small: fixed
      tables by their statistics, others by AQE's measured shuffle output.
    * RocksDB state store: keyed state of the streaming processors lives off
      heap and is checkpointed incrementally.
    * UI off: no port is opened.
    """
    b = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # broadcasts follow sizes in bytes, never hints: small fixed tables at
        # planning time, other sides once AQE has measured their shuffle output
        .config("spark.sql.autoBroadcastJoinThreshold", "1MB")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    )
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, sub: str = "") -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared file system);
    an unset value is an error there.  Only in local mode (tests) is a private
    folder made and registered when it is unset.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster "
                             "(a machine-local folder would not survive executor loss)")
        base = tempfile.mkdtemp(prefix="flowmart-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return os.path.join(base, sub) if sub else base
