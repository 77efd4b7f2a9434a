"""Many small loads of a table into few files, behind its manifest."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborflow.sources.files import remove
from harborflow.sources.manifest import COMPACTED, LOAD, Manifest, counts, folder_key, read_manifest, write_manifest
from harborflow.sources.tables import STREAM_LOAD, partition_levels, read_table, save_load, table_path

SMALL_BYTES = 128 << 20
MIN_LOADS = 8


def load_folders(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One row per folder of a load: partition columns, load, folder key, files, bytes. No content is read."""
    levels = partition_levels(spark, base, name)
    files = spark.read.format("binaryFile").load(table_path(base, name))
    return files.groupBy(*levels, LOAD).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
        F.min(F.regexp_replace("path", "/[^/]*$", "")).alias("folder"),
    ).withColumn("key", folder_key(levels))


def _replayable(folders: DataFrame) -> DataFrame:
    """The last load of every writer: its batch may be written again when the stream restarts."""
    named = folders.select(
        LOAD, F.regexp_extract(LOAD, STREAM_LOAD, 1).alias("_writer"), F.regexp_extract(LOAD, STREAM_LOAD, 2).try_cast("long").alias("_batch")
    )
    return named.filter(F.col("_batch").isNotNull() & ~F.col(LOAD).startswith(COMPACTED)).groupBy("_writer").agg(F.max_by(LOAD, "_batch").alias(LOAD)).select(LOAD)


def small_folders(
    spark: SparkSession, base: str, name: str, closed: Column | None = None, small_bytes: int = SMALL_BYTES, min_loads: int = MIN_LOADS
) -> DataFrame:
    """Folders worth merging: those of streams and earlier compactions below `small_bytes`, in closed partitions with `min_loads` of them."""
    levels = partition_levels(spark, base, name)
    folders = load_folders(spark, base, name).filter(counts(read_manifest(spark, base, name), levels))
    mergeable = F.col(LOAD).startswith(COMPACTED) | F.col(LOAD).rlike(STREAM_LOAD)
    small = folders.filter(mergeable & (F.col("bytes") < small_bytes)).join(_replayable(folders), LOAD, "left_anti")
    if closed is not None:
        small = small.filter(closed)
    in_partition = F.count(F.lit(1)).over(W.partitionBy(*levels) if levels else W.partitionBy(F.lit(0)))
    return small.withColumn("_n", in_partition).filter(F.col("_n") >= min_loads).drop("_n")


def compact(
    spark: SparkSession, base: str, name: str, schema: T.StructType | None = None, *, closed: Column | None = None,
    small_bytes: int = SMALL_BYTES, min_loads: int = MIN_LOADS, fmt: str = "parquet",
) -> int:
    """Merge small loads; returns how many folders were replaced. One compaction of a table runs at a time.

    `closed` is a condition on the partition columns (by default all partitions take part). A partition is left with fewer than
    `min_loads` small folders besides the last load of every writer, which is never merged because a restarted stream may write it
    again. Loads of batch jobs stay as they are. Nothing changes for readers until the manifest is replaced; the replaced folders
    stay for those who read them until the next compaction. What a failed run left is removed by the next one.
    """
    removed = _remove_unused(spark, base, name)
    levels = partition_levels(spark, base, name)
    # Names of folders, which the file index of any scan of the table holds as well.
    chosen = tuple(sorted(r["key"] for r in small_folders(spark, base, name, closed, small_bytes, min_loads).select("key").collect()))
    before = read_manifest(spark, base, name)
    if not chosen:
        if removed:
            write_manifest(spark, base, name, Manifest(before.published))
        return 0
    load = COMPACTED + uuid.uuid4().hex
    rows = read_table(spark, base, name, schema, fmt).filter(folder_key(levels).isin(*chosen))
    save_load(rows.drop(LOAD), base, name, load, levels, fmt, gather=True)
    write_manifest(spark, base, name, Manifest((*before.published, load), chosen))
    return len(chosen)


def _remove_unused(spark: SparkSession, base: str, name: str) -> int:
    """Remove folders that the manifest says are replaced, and compacted loads that were never published."""
    levels = partition_levels(spark, base, name)
    unused = load_folders(spark, base, name).filter(~counts(read_manifest(spark, base, name), levels)).select("folder").collect()
    for row in unused:
        remove(spark, row["folder"])
    return len(unused)
