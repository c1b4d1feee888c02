"""SparkSession construction and cluster-aware settings."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins at runtime (broadcast of a
# side whose *measured* shuffle output is small, split of skewed partitions,
# coalescing of tiny shuffle partitions); UTC keeps timestamp_ntz <->
# timestamp casts exact.  Static broadcasts from file-size estimates are off:
# a broadcast is either bounded by construction (explicit hint) or chosen by
# AQE from measured sizes.
DEFAULT_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Without the call sites of Column operations a plan is built with far fewer
    # round trips to the JVM.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "tvlens",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``master`` is only set when given, so on a cluster the launcher decides;
    so does the number of shuffle partitions (8 for a local master).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is None and master and master.startswith("local"):
        shuffle_partitions = 8
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})  # e.g. cluster_conf(...) on a cluster
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The folder comes from ``spark.checkpoint.dir``.  Only when that is unset
    and Spark runs in local mode (tests, a laptop) a fresh scratch folder is
    created for this process; on a cluster a machine-local folder would be
    invisible to the executors, so an unset setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        configured = tempfile.mkdtemp(prefix="tvlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A fresh location for an intermediate table under the shared checkpoint
    folder; two jobs that use the same name do not meet."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex}")


def shuffle_partitions_for(shuffle_bytes: int, target_bytes: int = 256 * 1024 * 1024, minimum: int = 8) -> int:
    """Initial shuffle partition count for the largest expected shuffle.

    AQE only coalesces partitions (and splits skewed ones); it never raises
    the count, so the initial value must fit the largest shuffle: about one
    partition per ``target_bytes`` of shuffled data.
    """
    return max(minimum, -(-int(shuffle_bytes) // int(target_bytes)))


def cluster_conf(largest_shuffle_bytes: int) -> dict[str, str]:
    """Settings for a large cluster, to pass as ``build_session(extra_conf=...)``."""
    return {
        "spark.sql.shuffle.partitions": str(shuffle_partitions_for(largest_shuffle_bytes)),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    }
