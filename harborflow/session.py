"""Session settings and durable intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on; all can be changed on a live session.
RUNTIME_CONF = {
    # Timestamps are compared and rendered in UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: partition coalescing and splitting of skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Replays overwrite only the partitions they rewrite.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int, partition_bytes: int = 256 << 20) -> int:
    """Set the number of shuffle partitions for an input of this size; AQE merges what turns out small."""
    partitions = max(200, -(-input_bytes // partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return partitions


def local_session(app: str = "harborflow", cores: str = "*", **conf: str) -> SparkSession:
    """Session for tests and benches; a cluster passes its own session to `configure`."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # No call-site capture per column expression: plans here have hundreds of them.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_root(spark: SparkSession) -> str:
    """Shared folder for durable intermediates: `spark.checkpoint.dir` of the session.

    A folder of our own is chosen only on a local session that names none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder all executors share")
    root = tempfile.mkdtemp(prefix="harborflow-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """Everything an application stores; may be removed as a whole when it has ended."""
    return os.path.join(shared_root(spark), f"harborflow-{spark.sparkContext.applicationId}")


def new_path(spark: SparkSession, label: str) -> str:
    return os.path.join(run_folder(spark), f"{label}-{uuid.uuid4().hex}")


def store(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage ends in durable files,
    so a lost executor never recomputes what came before, and later scans are pruned."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt evenly over the shuffle partitions, by keys or one by one: for row-by-row work on a table that comes in few files.

    The number is given, since AQE would merge partitions by their bytes, and the work is not in the bytes.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *keys)
