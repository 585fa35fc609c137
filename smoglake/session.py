"""Session construction for tests and benchmarks, and shared scratch paths.

Library functions never build a session: the caller passes ``spark``.
Scratch data (staged stream inputs, checkpoints, written tables) lives under
the shared folder named by ``spark.checkpoint.dir`` or ``setCheckpointDir``. A
private folder is chosen for local sessions only (tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

def build_session(cpus: int | str = "*", app: str = "smoglake", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Local session with the settings the package is tested under."""
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
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _configured_root(spark: SparkSession) -> str | None:
    """The conf ``spark.checkpoint.dir``, else the folder set with ``setCheckpointDir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root or spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for staged data.

    Where the session names none, a local session (one process) gets a
    folder of its own; on a cluster that would scatter the data over the
    machines, so there it raises.
    """
    root = _configured_root(spark)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("no shared folder for staged data: set spark.checkpoint.dir (or setCheckpointDir)")
        root = tempfile.mkdtemp(prefix="smoglake-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root.rstrip("/"), "smoglake", f"{name}-{uuid.uuid4().hex[:12]}")


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a staged folder, through the file system that holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scale_conf(input_bytes: int, cores: int = 1, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a given input volume (cluster deployment).

    Shuffle partitions start at about ``input / target`` (never fewer than
    the cores) so the distinct's reducers stay small enough to avoid spills;
    AQE then merges small ones and splits skewed ones at run time. Scan
    splits follow the same target. Broadcasts stay behind Catalyst's size
    estimate (explicit hints are used only for tables of fixed size).
    """
    parts = max(cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }
