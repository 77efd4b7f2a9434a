"""Registered queries that run the streaming jobs over the driver's tables.

Spark writes the tables as topic files in a few time-ordered slices; the stream then takes them in, a
micro-batch per slice, over the backlog present, and the query returns the sink's table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborflow import constants as K
from harborflow import schemas
from harborflow.session import new_path
from harborflow.sources import messages, tables
from harborflow.sources.compaction import compact
from harborflow.streaming import jobs, sinks
from workload import mapping as M
from workload.queries import query

SLICES = 5
# A slice has at least so many files, more when they would get more rows than this: a file is decoded by one task.
FILES_PER_SLICE = 4
ROWS_PER_FILE = 50_000
# In the state stream, rows arrive up to a day and a half before or after their slice, and the watermark is two days behind.
SHIFT_MICROS = 12 * 3600 * 1_000_000
DELAY = "2 days"


def _envelope_row(topic: str, message_type: str, meta: list[Column], report: Column, ingested_at: Column) -> Column:
    payload = F.struct(
        F.lit(message_type).alias("MessageType"), F.struct(*meta).alias("MetaData"),
        F.struct(report.alias(message_type)).alias("Message"),
    )
    envelope = F.struct(
        F.date_format(ingested_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("ingested_at"),
        F.lit(K.ENVELOPE_SOURCE).alias("source"), F.lit(K.ENVELOPE_VERSION).alias("schema_version"), payload.alias("payload"),
    )
    return F.concat(F.unhex(F.lit("0000000001")), F.to_json(envelope).cast("binary"))


def position_topic(positions: DataFrame) -> DataFrame:
    meta = [
        F.col("mmsi").cast("long").alias("MMSI"), F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
        F.concat(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"), F.lit(".994178528 +0000 UTC")).alias("time_utc"),
    ]
    report = F.struct(F.col("sog").alias("Sog"), F.col("nav_status_code").alias("NavigationalStatus"))
    value = _envelope_row(jobs.POSITIONS_TOPIC, "PositionReport", meta, report, F.col("ingested_at"))
    return positions.select(
        F.col("mmsi").cast("binary").alias("key"), value.alias("value"), F.lit(jobs.POSITIONS_TOPIC).alias("topic"),
        "partition", "offset", F.col("event_time").alias("timestamp"),
    )


def static_topic(static: DataFrame) -> DataFrame:
    meta = [F.col("mmsi").cast("long").alias("MMSI"), F.col("ship_name").alias("ShipName")]
    report = F.struct(
        F.col("call_sign").alias("CallSign"), F.col("destination").alias("Destination"),
        F.col("imo_number").alias("ImoNumber"), F.col("max_static_draught").alias("MaximumStaticDraught"),
        F.col("ship_type_code").alias("Type"),
    )
    value = _envelope_row(jobs.STATIC_TOPIC, "ShipStaticData", meta, report, F.col("ingested_at"))
    return static.select(
        F.col("mmsi").cast("binary").alias("key"), value.alias("value"), F.lit(jobs.STATIC_TOPIC).alias("topic"),
        F.lit(0).alias("partition"), "offset", F.col("ingested_at").alias("timestamp"),
    )


def write_slices(topic: DataFrame, path: str, slices: int = SLICES, shuffled: bool = False) -> int:
    """Append the topic's rows, slice by slice: files are read in the order they appear. Returns the number of files a slice.

    Slices follow time, but a second delivery comes a slice later; if shuffled, rows are also moved in time, by seven steps.
    """
    first, last, rows = topic.agg(F.min(F.unix_micros("timestamp")), F.max(F.unix_micros("timestamp")), F.count(F.lit(1))).first()
    if first is None:
        topic.write.parquet(path)
        return FILES_PER_SLICE
    files = max(FILES_PER_SLICE, -(-rows // (slices * ROWS_PER_FILE)))
    width = (last - first) // slices + 1
    event = F.col("offset") % 1_000_000_000
    shift = ((event * 7919) % 7 - 3) * SHIFT_MICROS if shuffled else F.lit(0)
    number = F.floor((F.unix_micros("timestamp") - F.lit(first) + shift) / F.lit(width))
    number = F.greatest(number, F.lit(0)) + F.floor(F.col("offset") / 1_000_000_000)
    # Encoded once, and dealt to the slices on the way.
    encoded = f"{path}-encoded"
    topic.withColumn("slice", F.least(number, F.lit(slices - 1)).cast("int")).write.partitionBy("slice").parquet(encoded)
    dealt = topic.sparkSession.read.schema(T.StructType([*topic.schema.fields, T.StructField("slice", T.IntegerType())])).parquet(encoded)
    for i in range(slices):
        # The same number of files a slice, so that a micro-batch is a slice.
        dealt.filter(F.col("slice") == i).drop("slice").repartition(files).write.mode("append").parquet(path)
    return files


def _source(path: str, files: int) -> dict[str, str]:
    return {"fmt": "parquet", "path": path, "maxFilesPerTrigger": str(files)}


def _finish(streaming_query) -> None:
    streaming_query.awaitTermination()


def run_silver(spark: SparkSession, sf: str) -> str:
    base = new_path(spark, "lake")
    files = write_slices(position_topic(M.positions(spark, sf)), f"{base}/topic")
    stream = jobs.position_stream(spark, **_source(f"{base}/topic", files))
    _finish(jobs.run_silver(stream, M.index(spark), base, available_now=True))
    return base


@query
def stream_silver(spark, sf):
    base = run_silver(spark, sf)
    stored = tables.read_table(spark, base, "positions_silver", schemas.POSITIONS_SILVER)
    return stored.withColumns({c: F.round(c, 6) for c in ("lat", "lon", "sog")}).select(*schemas.POSITIONS_SILVER.names)


@query
def stream_compacted(spark, sf):
    """The silver table after its loads were merged twice, the first time without the newest days."""
    base = run_silver(spark, sf)
    newest = tables.read_table(spark, base, "positions_silver", schemas.POSITIONS_SILVER).agg(F.max("event_date")).first()[0]
    closed = F.col("event_date") < F.lit(newest) if newest else None
    for condition in (closed, None):
        compact(spark, base, "positions_silver", schemas.POSITIONS_SILVER, closed=condition, min_loads=2)
    stored = tables.read_table(spark, base, "positions_silver", schemas.POSITIONS_SILVER)
    return stored.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("mmsi").alias("vessels"), F.max("event_time").alias("newest")
    )


@query
def stream_quarantine(spark, sf):
    base = run_silver(spark, sf)
    stored = tables.read_table(spark, base, "positions_quarantine", schemas.POSITIONS_QUARANTINE)
    return stored.groupBy("quality_failures").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("mmsi").alias("vessels")
    )


def run_state(spark: SparkSession, sf: str) -> str:
    """Every decoded row, bad and redelivered ones too, out of order."""
    base = new_path(spark, "lake")
    files = write_slices(position_topic(M.positions(spark, sf)), f"{base}/topic", shuffled=True)
    stream = jobs.position_stream(spark, delay=DELAY, **_source(f"{base}/topic", files))
    _finish(jobs.run_state_changes(
        stream, M.index(spark), base, available_now=True, debounce=M.DEBOUNCE, discrepancy=M.DISCREPANCY,
        expiry=M.EXPIRY, stretch=2 * 86400, message_format="json",
    ))
    return base


@query
def stream_state(spark, sf):
    return tables.read_table(spark, run_state(spark, sf), "vessel_state_changes", schemas.STATE_CHANGES).select(
        *schemas.STATE_CHANGES.names
    )


@query
def stream_state_messages(spark, sf):
    """The message side of the state stream, read back: changes by type and state."""
    stored = spark.read.schema("key string, value string, topic string").json(f"{run_state(spark, sf)}/state_change_messages")
    change = F.from_json("value", schemas.STATE_CHANGES)
    return stored.select("key", "topic", change.alias("c")).groupBy("topic", "c.event_type", F.col("c.derived_state").alias("derived_state")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("key").alias("vessels"), F.max("c.transition_time").alias("newest")
    )


@query
def stream_late_rows(spark, sf):
    """Rows behind the watermark, by vessel."""
    late = tables.read_table(spark, run_state(spark, sf), "late_positions", schemas.LATE)
    return late.groupBy("mmsi").agg(F.sum("late_rows").alias("late_rows"))


@query
def stream_ship_static(spark, sf):
    base = new_path(spark, "lake")
    files = write_slices(static_topic(M.ship_static(spark, sf)), f"{base}/topic")
    stream = jobs.static_stream(spark, **_source(f"{base}/topic", files))
    _finish(jobs.run_ship_static(stream, base, available_now=True))
    stored = tables.read_table(spark, base, "ship_static", schemas.SHIP_STATIC)
    return stored.withColumn("max_static_draught", F.round("max_static_draught", 6))


@query
def stream_routed(spark, sf):
    base = new_path(spark, "lake")
    M.feed_messages(spark, sf).select(F.col("raw").alias("value")).write.text(f"{base}/feed")
    feed = spark.readStream.schema("raw string").option("maxFilesPerTrigger", messages.MAX_FILES_PER_TRIGGER).text(f"{base}/feed")
    _finish(jobs.route_feed(feed, base, available_now=True))
    stored = spark.read.schema("key string, value string, topic string").parquet(f"{base}/topics")
    return stored.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("key").isNull()).alias("without_key"),
        F.count_distinct("key").alias("keys"),
    )


@query
def stream_deduplicated(spark, sf):
    """Deduplication across micro-batches: each (vessel, time) once."""
    base = new_path(spark, "lake")
    files = write_slices(position_topic(M.positions(spark, sf)), f"{base}/topic")
    stream = jobs.position_stream(spark, **_source(f"{base}/topic", files))
    once = jobs.without_redelivered(stream).select("mmsi", "event_time")
    _finish(sinks.append_stream(once, base, "once", sinks.checkpoint_path(base, "once"), available_now=True))
    return spark.read.schema("mmsi string, event_time timestamp").parquet(f"{base}/once")
