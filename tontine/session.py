"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "tontine") -> SparkSession:
    """Local/test session. On a cluster the submitter's session is used as is."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    A session on one machine (master ``local[...]``) that has none gets a private folder,
    removed when the process ends.  On a cluster a folder of the driver's machine would be
    of no use to the executors, so there the setting is required.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tontine-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        atexit.register(shutil.rmtree, conf_dir, ignore_errors=True)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session settings the plans rely on to an existing session
    (runtime-settable ones only) and make sure a checkpoint folder exists."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.adaptive.skewJoin.enabled"):
        try:
            if spark.conf.get(k, None) != _CONF[k]:
                spark.conf.set(k, _CONF[k])
        except Exception:  # noqa: BLE001 - a locked setting stays as the cluster has it
            pass
    ensure_checkpoint_dir(spark)
    return spark


def recommended_conf(input_bytes: int, executor_cores_total: int,
                     target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings sized from the input volume, for a cluster session.

    Shuffle partitions so that one reduce partition holds about
    ``target_partition_bytes`` (and at least two waves of the cluster's cores);
    file splits of the same size; AQE coalescing towards the same advisory size
    and skew splitting of partitions five times the median and above 1 GiB.
    """
    parts = max(2 * executor_cores_total, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
    }
