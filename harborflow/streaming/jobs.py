"""The three streaming jobs, from topic to table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from harborflow import constants as K
from harborflow import schemas
from harborflow.operators.quality import tag_quality
from harborflow.operators.spatial import ZoneIndex, best_zone
from harborflow.sources import messages
from harborflow.streaming import sinks
from harborflow.streaming.state import STRETCH_SECONDS, first_deliveries, track_vessels

POSITIONS_TOPIC = K.TOPIC_BY_MESSAGE_TYPE["PositionReport"]
STATIC_TOPIC = K.TOPIC_BY_MESSAGE_TYPE["ShipStaticData"]


def position_stream(spark: SparkSession, *, delay: str = K.WATERMARK_DELAY, **source: str) -> DataFrame:
    raw = messages.scan_topic_stream(spark, POSITIONS_TOPIC, **source)
    flat = messages.flatten_positions(messages.decode(raw, schemas.POSITION_ENVELOPE))
    return flat.withWatermark("event_time", delay)


def without_redelivered(positions: DataFrame) -> DataFrame:
    """Deduplicate across micro-batches, for as long as the watermark allows."""
    return positions.dropDuplicatesWithinWatermark(["mmsi", "event_time"])


def static_stream(spark: SparkSession, **source: str) -> DataFrame:
    raw = messages.scan_topic_stream(spark, STATIC_TOPIC, **source)
    return messages.flatten_static(messages.decode(raw, schemas.STATIC_ENVELOPE))


def run_silver(
    positions: DataFrame, zones: ZoneIndex, base: str, *, available_now: bool = False,
    keep: int = K.REDELIVERY_SECONDS, report: Callable[[int, dict[str, int]], None] | None = None, **bounds
) -> StreamingQuery:
    """Every row is checked first, so a bad first delivery never hides a good second one; of good ones the first stays.

    `report` gets every batch's number and its counts of valid and bad rows.
    """
    once = first_deliveries(tag_quality(positions, **bounds), keep)
    checkpoint = sinks.checkpoint_path(base, "positions_silver")
    return sinks.start(once, sinks.silver_writer(base, zones, report), checkpoint, available_now=available_now)


def run_ship_static(static: DataFrame, base: str, *, available_now: bool = False) -> StreamingQuery:
    checkpoint = sinks.checkpoint_path(base, "ship_static")
    return sinks.append_stream(static, base, "ship_static", checkpoint, available_now=available_now)


def run_state_changes(
    positions: DataFrame, zones: ZoneIndex, base: str, *, available_now: bool = False,
    debounce: int = K.DEBOUNCE_SECONDS, discrepancy: int = K.DISCREPANCY_SECONDS,
    expiry: int = K.EXPIRY_SECONDS, stretch: int = STRETCH_SECONDS, message_format: str | None = None, **message_options: str,
) -> StreamingQuery:
    """Every decoded position goes in, checked or not, in any order, with its best zone."""
    changes = track_vessels(best_zone(positions, zones), debounce=debounce, discrepancy=discrepancy, expiry=expiry, stretch=stretch)
    writer = sinks.state_change_writer(base, message_format, **message_options)
    checkpoint = sinks.checkpoint_path(base, "vessel_state_changes")
    return sinks.start(changes, writer, checkpoint, available_now=available_now)


def route_feed(feed: DataFrame, base: str, *, available_now: bool = False) -> StreamingQuery:
    """Feed text to topic rows, one partition per topic, the dead letters among them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.append_batch(messages.route(batch), base, "topics", batch_id, partition_by=("topic",))

    return sinks.start(feed, write, sinks.checkpoint_path(base, "route"), available_now=available_now)
