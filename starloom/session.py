"""Session helpers: a local session for tests/bench, and the shared folder
that lineage cuts and materialised tables go to."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "starloom") -> SparkSession:
    """Session used by tests and bench. Cluster users bring their own.
    ``spark.checkpoint.dir`` is left as configured (spark-defaults); only if
    nothing names one does this local session get a private folder."""
    scratch = tempfile.mkdtemp(prefix="starloom-ckpt-")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("STARLOOM_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
    )
    # extra settings for experiments: STARLOOM_CONF="key=value,key=value"
    for kv in filter(None, os.environ.get("STARLOOM_CONF", "").split(",")):
        k, v = kv.split("=", 1)
        builder = builder.config(k.strip(), v.strip())
    spark = builder.getOrCreate()
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, partition_bytes: int = 256 << 20, shuffle_bytes: int = 1 << 30) -> dict[str, str]:
    """Recommended settings for a cluster run over ``input_bytes`` of input.

    * Broadcast decisions only at run time: the static threshold trusts
      compressed file sizes (a dimension can be many times larger in
      memory), so it is off; AQE broadcasts a side after measuring it.
      Explicit ``broadcast()`` hints in the library are only on
      bounded tables: one row a partition, or keys whose count was checked.
    * Shuffle partitions: one per ``shuffle_bytes`` of input (shuffled data
      is a pruned fraction of it), at least 200. There is no upper bound: at
      100 TB this is about 100,000 partitions; a cluster that prefers fewer,
      larger ones says so with ``shuffle_bytes``. AQE coalesces small
      partitions toward ``partition_bytes`` and splits skewed join ones.
    """
    parts = max(200, -(-input_bytes // shuffle_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        # the intake's dedup state lives on local disk, its changes in the checkpoint
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        return spark.conf.get(key, None)
    except Exception:  # noqa: BLE001  (some keys are not readable remotely)
        return None


def app_key(spark: SparkSession) -> str:
    """Identifies the running application (cache key for built tables)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001  (no SparkContext in a Connect client)
        return _conf(spark, "spark.app.id") or f"session-{id(spark)}"


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, read from ``spark.checkpoint.dir``.

    It must be a folder that every executor and the driver can reach; there
    is no fallback to a folder of this machine (``local_session`` sets one
    where nothing else names it)."""
    root = _conf(spark, "spark.checkpoint.dir")
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001
            root = None
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set: set it to a shared folder (HDFS/S3/...) reachable from every executor")
    return root.rstrip("/")
