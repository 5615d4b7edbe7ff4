"""Session helpers: a local session for tests and the bench, and the shared
work folder every job uses for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "loadcast") -> SparkSession:
    """Local-mode session with the settings the tests and the bench use.

    On a cluster the caller builds its own session; nothing in the library
    depends on these values except the checkpoint folder (``work_dir``).
    """
    parts = shuffle_partitions or (int(cores) if str(cores).isdigit() else 8)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Only a local master, whose executors are this very
    process, may leave it unset: a fresh temporary folder is then registered.
    On any other master a missing setting is an error, since executors could
    not see a folder of the driver's own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="loadcast-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/loadcast/{name}-{uuid.uuid4().hex[:12]}"


def scale_settings(input_bytes: int, total_cores: int,
                   target_partition_bytes: int = 128 * 1024 * 1024) -> dict[str, str]:
    """Starting values for a large run, from the input size and the cluster's
    total cores: scan splits and shuffle partitions of about
    ``target_partition_bytes`` (so a task's share fits executor memory and
    spills little), at least two waves of tasks, AQE to coalesce small
    partitions and split skewed ones at run time."""
    by_size = -(-int(input_bytes) // int(target_partition_bytes))
    partitions = max(2 * int(total_cores), by_size)
    size = str(int(target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
