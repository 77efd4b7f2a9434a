"""foreachBatch sinks. Every write lands in a partition of its batch, so a replay replaces it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from harborflow import constants as K
from harborflow.operators.quality import quarantined_rows, valid_rows
from harborflow.operators.spatial import ZoneIndex, best_zone
from harborflow.schemas import POSITIONS_QUARANTINE, POSITIONS_SILVER, STATE_CHANGES
from harborflow.sources.tables import append_batch, table_path
from harborflow.streaming.state import ROCKSDB

BatchWriter = Callable[[DataFrame, int], None]


def silver_writer(base: str, zones: ZoneIndex, report: Callable[[int, dict[str, int]], None] | None = None) -> BatchWriter:
    """Of checked rows without redelivered ones: valid rows to `positions_silver` by event date, the rest to `positions_quarantine`.

    The batch is held for its counts and both writes, so that the stateful stream before it runs once; `report` gets the batch
    number and the counts of both kinds.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counts = tagged.agg(F.count_if("quality_ok").alias("valid"), F.count_if(~F.col("quality_ok")).alias("bad")).first().asDict()
            bad = quarantined_rows(tagged).withColumn("quarantined_at", F.current_timestamp())
            append_batch(bad.select(*POSITIONS_QUARANTINE.names), base, "positions_quarantine", batch_id, gather=True)
            if counts["valid"]:
                located = best_zone(valid_rows(tagged), zones)
                silver = located.withColumn("event_date", F.to_date("event_time"))
                append_batch(
                    silver.select(*POSITIONS_SILVER.names), base, "positions_silver", batch_id,
                    partition_by=("event_date",),
                )
            if report is not None:
                report(batch_id, counts)
        finally:
            tagged.unpersist()

    return write


def state_change_writer(base: str, message_format: str | None = None, **message_options: str) -> BatchWriter:
    """State changes to the `vessel_state_changes` table and, as messages, to their topic.

    `message_format="kafka"` publishes through the connector (at least once: readers drop exact
    copies); other formats write message rows next to the table. Both are distributed writes. Counts of rows that came
    too late go to `late_positions`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        tracked = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            held = tracked.filter(F.col("event_type").isNotNull()).select(*STATE_CHANGES.names)
            if "late_rows" in tracked.columns:
                late = tracked.filter(F.col("late_rows").isNotNull()).select("mmsi", "late_rows")
                if not late.isEmpty():
                    append_batch(late, base, "late_positions", batch_id)
            if held.isEmpty():
                return
            messages = held.select(
                F.col("mmsi").alias("key"), F.to_json(F.struct(*STATE_CHANGES.names)).alias("value"),
                F.lit(K.STATE_CHANGE_TOPIC).alias("topic"),
            )
            if message_format == "kafka":
                messages.write.format("kafka").options(**message_options).save()
            elif message_format:
                append_batch(messages, base, "state_change_messages", batch_id, fmt=message_format)
            append_batch(held, base, "vessel_state_changes", batch_id)
        finally:
            tracked.unpersist()

    return write


_STORE = "spark.sql.streaming.stateStore.providerClass"
_PARTITIONS, _ADAPTIVE = "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled"
# A task of a stateful stream has fixed costs of its own in every micro-batch: a worker, a store to open, files to commit.
STATE_TASKS_PER_CORE = 2


def _replanned(writer: BatchWriter) -> BatchWriter:
    """Streams switch re-planning off, and without it Spark ignores the hints that gather a batch's rows into few files."""

    def write(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf
        before = conf.get(_ADAPTIVE)
        conf.set(_ADAPTIVE, "true")
        try:
            writer(batch, batch_id)
        finally:
            conf.set(_ADAPTIVE, before)

    return write


def state_tasks(spark: SparkSession) -> int:
    """Shuffle partitions of a stateful stream: by cores, at most what the session has. State is held bucket by bucket, so that no
    task needs more memory when it has more buckets."""
    return min(int(spark.conf.get(_PARTITIONS)), STATE_TASKS_PER_CORE * spark.sparkContext.defaultParallelism)


def start(
    stream: DataFrame, writer: BatchWriter, checkpoint: str, *, available_now: bool = False,
    interval: str = K.TRIGGER_INTERVAL, name: str | None = None,
) -> StreamingQuery:
    """Run a batch writer on a trigger interval, or once over the present backlog.

    The query keeps its state in RocksDB, in `state_tasks` partitions, which a checkpoint keeps; the caller's session is as before
    when the query has started.
    """
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    query = stream.writeStream.foreachBatch(_replanned(writer)).option("checkpointLocation", checkpoint).trigger(**trigger)
    spark = stream.sparkSession
    before = {key: spark.conf.get(key, None) for key in (_STORE, _PARTITIONS)}
    spark.conf.set(_PARTITIONS, str(state_tasks(spark)))
    spark.conf.set(_STORE, ROCKSDB)
    try:
        return (query.queryName(name) if name else query).start()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def append_stream(
    stream: DataFrame, base: str, name: str, checkpoint: str, *, available_now: bool = False, fmt: str = "parquet"
) -> StreamingQuery:
    """Plain append of a stream to a table; the file sink's own log makes it exactly once."""
    trigger = {"availableNow": True} if available_now else {"processingTime": K.TRIGGER_INTERVAL}
    return (
        stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(**trigger).start(table_path(base, name))
    )


def checkpoint_path(base: str, job: str) -> str:
    return os.path.join(base, "_checkpoints", job)
