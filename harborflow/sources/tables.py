"""Lake tables: paths, scans, replay-safe appends, views, inspection, snapshot export."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborflow.operators.ordered import number_rows
from harborflow.sources.files import matching, read_text, remove, remove_if_empty, replace_text
from harborflow.sources.manifest import COMPACTED, LOAD, counts, read_manifest

# What a micro-batch calls its load: writer and batch number.
STREAM_LOAD = r"^(.+)-(\d+)$"
_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
_VERSIONS, _CURRENT = "versions", "current"
_JSON = {"ignoreNullFields": "false", "timestampFormat": _TIME}


def table_path(base: str, name: str) -> str:
    return os.path.join(base, name)


def read_table(
    spark: SparkSession, base: str, name: str, schema: T.StructType | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Scan a table, of tables with loads those that count (see `manifest`)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    while True:
        manifest = read_manifest(spark, base, name)
        found = reader.load(table_path(base, name))
        # The files are listed by now; a manifest replaced meanwhile may belong to other files.
        if read_manifest(spark, base, name) == manifest:
            break
    if LOAD not in found.columns:
        return found
    return found.filter(counts(manifest, partition_levels(spark, base, name)))


def partition_levels(spark: SparkSession, base: str, name: str) -> tuple[str, ...]:
    """Partition columns above the load level, read off the first folder of every level."""
    levels: list[str] = []
    folder = table_path(base, name)
    while True:
        below = [os.path.basename(p) for p in matching(spark, os.path.join(folder, "[!_.]*=*"))]
        if not below or below[0].startswith(f"{LOAD}="):
            return tuple(levels)
        levels.append(below[0].partition("=")[0])
        folder = os.path.join(folder, below[0])


def write_table(df: DataFrame, base: str, name: str, *, partition_by: tuple[str, ...] = (), fmt: str = "parquet") -> None:
    """Replace a table (or, with partitions, the partitions present in `df`)."""
    if not partition_by:
        df.write.format(fmt).mode("overwrite").save(table_path(base, name))
        return
    writer = _gathered(df, partition_by).write.format(fmt).mode("overwrite").partitionBy(*partition_by)
    writer.option("partitionOverwriteMode", "dynamic").save(table_path(base, name))


def _gathered(df: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """Bring a partition's rows together in files of a sensible size: without this every task would write
    a file per partition value. AQE splits a value that holds much of the data and merges small ones."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def append_batch(
    df: DataFrame, base: str, name: str, batch_id: int, *, partition_by: tuple[str, ...] = (), fmt: str = "parquet",
    writer: str | None = None, gather: bool = False,
) -> None:
    """Append a micro-batch into its own part of the table: the last partition level, `load`, names query and batch.

    A replayed batch overwrites exactly what its first attempt wrote. `writer` is by default the streaming query's id, which
    belongs to its checkpoint, so other queries, and a query on a new checkpoint, never touch these rows.
    """
    writer = writer or df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
    save_load(df, base, name, f"{writer}-{batch_id}", partition_by, fmt, gather=gather)


def write_load(df: DataFrame, base: str, name: str, load: str, *, partition_by: tuple[str, ...] = (), fmt: str = "parquet") -> None:
    """Batch counterpart of `append_batch`, for tables that streams append to as well: replace what `load` wrote before.

    Partitions that `load` wrote before and that are not in `df` lose its rows, after the new ones are in place.
    """
    if load.startswith(COMPACTED) or re.match(STREAM_LOAD, load):
        raise ValueError(f"{load!r} is a name for loads of streams or of compaction")
    spark = df.sparkSession
    if not partition_by:
        df.write.format(fmt).mode("overwrite").save(os.path.join(table_path(base, name), f"{LOAD}={load}"))
        return
    folders = os.path.join(table_path(base, name), *["*"] * len(partition_by), f"{LOAD}={load}")
    before = matching(spark, os.path.join(folders, "*"))
    save_load(df, base, name, load, partition_by, fmt)
    # New files have new names, so what is still there of the old ones lies in partitions without new rows.
    left = set(before) & set(matching(spark, os.path.join(folders, "*")))
    for file in left:
        remove(spark, file)
    for folder in {os.path.dirname(file) for file in left}:
        remove_if_empty(spark, folder)


def save_load(
    df: DataFrame, base: str, name: str, load: str, partition_by: tuple[str, ...], fmt: str, *, gather: bool = False
) -> None:
    """Write a load; `gather` brings its rows into few files also where there are no partitions."""
    rows = df.hint("rebalance") if gather and not partition_by else _gathered(df, partition_by)
    (
        rows.withColumn(LOAD, F.lit(load))
        .write.format(fmt).mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by, LOAD)
        .save(table_path(base, name))
    )


def register_sources(spark: SparkSession, base: str, schemas: dict[str, T.StructType], fmt: str = "parquet") -> None:
    """Lake tables as temp views, for SQL users."""
    for name, schema in schemas.items():
        read_table(spark, base, name, schema, fmt).select(*schema.names).createOrReplaceTempView(name)


def inspect(df: DataFrame, order_by: str | None = None, limit: int = 10) -> tuple[int, T.StructType, DataFrame]:
    """Row count, schema and the first rows, by `order_by` descending if given."""
    shown = df.orderBy(F.col(order_by).desc()) if order_by else df
    return df.count(), df.schema, shown.limit(limit)


def snapshot_lines(ships: DataFrame, generated_at: Column) -> DataFrame:
    """(position, value): the lines of `{"generated_at": ..., "ships_at_anchor": [...]}`, a ship a line in arrival order.

    Ships are numbered in a range-partitioned order, so no task sees them all.
    """
    head = F.concat(F.lit('{"generated_at":"'), F.date_format(generated_at, _TIME), F.lit('","ships_at_anchor":['))
    ends = ships.sparkSession.createDataFrame([(0, True), (2**62, False)], "position long, first boolean")
    ends = ends.select("position", F.when(F.col("first"), head).otherwise(F.lit("]}")).alias("value"))
    body = F.to_json(F.struct(*ships.columns), _JSON)
    numbered = number_rows(ships.withColumn("_body", body), ("arrival_time", "mmsi", "_body"), "_position")
    comma = F.when(F.col("_position") > 1, F.lit(",")).otherwise(F.lit(""))
    listed = numbered.select(F.col("_position").alias("position"), F.concat(comma, F.col("_body")).alias("value"))
    return ends.unionByName(listed)


def export_snapshot(ships: DataFrame, path: str, generated_at: Column | None = None) -> str:
    """Publish a snapshot of any size; returns its folder.

    Every export fills a new folder under `versions/`: JSON lines in `rows/`, and in `document/` text files that, one after the
    other, are a single JSON document. The file `current` names the version to read and is put in place by one rename when all
    is written, so readers see the former snapshot or this one whole, and a failed export changes nothing for them. The former
    version stays for those who are reading it; older and abandoned ones go.
    """
    spark = ships.sparkSession
    generated_at = F.current_timestamp() if generated_at is None else generated_at
    before = snapshot_folder(spark, path)
    version = uuid.uuid4().hex
    folder = os.path.join(path, _VERSIONS, version)
    rows = os.path.join(folder, "rows")
    ships.write.options(**_JSON).json(rows)
    written = spark.read.schema(ships.schema).options(**_JSON).json(rows)
    snapshot_lines(written, generated_at).orderBy("position").select("value").write.text(os.path.join(folder, "document"))
    replace_text(spark, os.path.join(path, _CURRENT), version)
    _keep_versions(spark, path, {version, os.path.basename(before or "")})
    return folder


def _keep_versions(spark: SparkSession, path: str, names: set[str]) -> None:
    for found in matching(spark, os.path.join(path, _VERSIONS, "*")):
        if os.path.basename(found) not in names:
            remove(spark, found)


def snapshot_folder(spark: SparkSession, path: str) -> str | None:
    """Folder of the published snapshot, None before the first."""
    version = read_text(spark, os.path.join(path, _CURRENT))
    return None if version is None else os.path.join(path, _VERSIONS, version)


def _published(spark: SparkSession, path: str) -> str:
    folder = snapshot_folder(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no snapshot has been published under {path}")
    return folder


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The published ships."""
    return spark.read.schema(schema).options(**_JSON).json(os.path.join(_published(spark, path), "rows"))


def read_snapshot_lines(spark: SparkSession, path: str) -> DataFrame:
    """The ships of the published document, one row a line (`value`), head and tail left out."""
    lines = spark.read.text(os.path.join(_published(spark, path), "document"))
    ship = F.regexp_replace("value", "^,", "")
    return lines.filter(~F.col("value").startswith('{"generated_at"') & (F.col("value") != "]}")).select(ship.alias("value"))
