"""Session helpers.

Library code never creates its own session; callers pass one in.  The
helpers here only set the SQL options the operators rely on, and create a
local session for tests and the benchmark.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# SQL options the operators rely on.  All are runtime (session) options.
REQUIRED_CONF = {
    # Timestamps are UTC throughout (the telemetry times are GMT strings).
    "spark.sql.session.timeZone": "UTC",
    # Property lists may repeat a key; the later value wins.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # The JVM never compiles a method of more than 8000 bytes (HotSpot's limit);
    # a stage whose generated code is longer runs faster operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Set where the session does not say otherwise.
PREFERRED_CONF = {
    # Rows that share most of their text (ids, names, nested arrays) take ten
    # and more times their shuffled size when sorted or hashed in a task.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Tables by date have thousands of folders; Spark lists each in a task of
    # its own, whose start takes longer than the listing.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the session options the operators need (idempotent)."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, value in PREFERRED_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used as is.  Only when it
    is unset and the session is local (tests) is a private folder created
    and registered; on a cluster an unset folder is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        # a machine-local folder is lost with its executor: a cluster must
        # name a shared one
        raise ValueError("spark.checkpoint.dir is not set; set it to a folder shared by the cluster")
    local = tempfile.mkdtemp(prefix="runlens-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder (e.g. for one streaming
    query's progress)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}"


def materialized(df: DataFrame) -> DataFrame:
    """The DataFrame, computed now and kept in the shared checkpoint folder:
    several readers compute it once, and no lost executor computes it again.
    It is kept as Parquet, which takes a fraction of a checkpoint's space for
    wide rows and whose readers read only their columns; rows with columns
    that have no type yet (NULL literals) are kept as a checkpoint."""
    spark = df.sparkSession
    if "void" in df.schema.simpleString() or not df.columns:
        checkpoint_dir(spark)
        return df.checkpoint(eager=True)
    path = checkpoint_path(spark, f"rows-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app_name: str = "runlens") -> SparkSession:
    """Local session for tests and benchmarks (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RUNLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024 * 1024,
               expansion: float = 2.0) -> dict[str, str]:
    """Settings sized for a volume: shuffle partitions so that a shuffle
    partition holds about ``target_partition_bytes`` even when a job's
    shuffles carry ``expansion`` times the input (typed aggregation unpivots
    rows), rounded up to whole waves of the cluster's cores; scan splits of
    the same size; AQE on to coalesce small partitions and split skewed
    ones.  ``input_bytes`` can come from ``sources.telemetry.input_size``
    (file metadata only)."""
    cores = max(1, int(total_cores))
    wanted = max(1, int(input_bytes * expansion // target_partition_bytes) + 1)
    partitions = ((wanted + cores - 1) // cores) * cores
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split a skewed join even where the aggregate above it then needs
        # another shuffle (a hot run's or attempt's rows)
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }


def apply_scale_conf(spark: SparkSession, input_bytes: int, total_cores: int, override: bool = False,
                     **kwargs) -> dict[str, str]:
    """Set the ``scale_conf`` values on a session (runtime SQL options); keys
    the session already sets explicitly are kept unless ``override``."""
    applied = {}
    for key, value in scale_conf(input_bytes, total_cores, **kwargs).items():
        current = spark.conf.get(key, None)
        if override or current is None or key == "spark.sql.shuffle.partitions" and current == "200":
            spark.conf.set(key, value)
            applied[key] = value
    return applied
