"""Session and scratch-space helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def cluster_conf(total_cores: int) -> dict[str, str]:
    """Settings this design assumes on a large cluster (~100 TB, ~1000
    executors). They are suggestions for the job submitter; nothing in the
    library sets them on a session it did not create.

    * shuffle partitions start at ~3x the cores and AQE coalesces them to
      ~256 MB each, so a stage never runs with partitions far above memory;
    * AQE skew handling splits a partition over 5x the median and 512 MB;
    * broadcast stays behind the measured-size threshold (64 MB): dimensions
      broadcast, anything that grows with the facts sort-merges;
    * file splits of 256 MB keep scan tasks in the thousands, not millions.

    The submitter must also set ``spark.checkpoint.dir`` to a shared folder.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.shuffle.partitions": str(max(200, 3 * total_cores)),
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.sources.partitionOverwriteMode": "static",  # dynamic is set per write
        "spark.sql.session.timeZone": "UTC",
    }


def local_session(cores: int | str = "*", app: str = "burnlens", **conf) -> SparkSession:
    """A local session for tests and the benchmark (cluster jobs bring their own)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_CONF, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Only a local session that names none gets a private temporary folder; on a
    cluster every executor would write to its own disk, so there the setting is
    required.
    """
    d = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        require_shared_folder(spark.sparkContext.master)
        d = tempfile.mkdtemp(prefix="burnlens-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def require_shared_folder(master: str) -> None:
    """Raise unless all executors of ``master`` run on this machine."""
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), "burnlens", f"{name}-{uuid.uuid4().hex}")
