"""Topic scans, tolerant decoding, envelopes and routing of feed messages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborflow import constants as K
from harborflow import schemas
from harborflow.functions.scalars import feed_time, iso_time, lookup

# A micro-batch takes in at most this much, whatever the backlog.
MAX_FILES_PER_TRIGGER = "16"
MAX_OFFSETS_PER_TRIGGER = "5000000"


def _kafka_options(topic: str, options: Mapping[str, str]) -> dict[str, str]:
    return {"subscribe": topic, "startingOffsets": "earliest", **options}


def scan_topic(
    spark: SparkSession, topic: str, fmt: str = "parquet", path: str | None = None, **options: str
) -> DataFrame:
    """Batch scan of a topic, earliest to latest. `kafka` needs its connector on the class path."""
    if fmt == "kafka":
        reader = spark.read.format("kafka").options(**_kafka_options(topic, {"endingOffsets": "latest", **options}))
        return reader.load()
    reader = spark.read.format(fmt).schema(schemas.TOPIC_ROW).options(**options)
    return reader.load(path).filter(F.col("topic") == topic)


def scan_topic_stream(
    spark: SparkSession, topic: str, fmt: str = "parquet", path: str | None = None, **options: str
) -> DataFrame:
    """Streaming scan of a topic from the earliest message, with a bounded micro-batch."""
    if fmt == "kafka":
        defaults = {"maxOffsetsPerTrigger": MAX_OFFSETS_PER_TRIGGER, **options}
        return spark.readStream.format("kafka").options(**_kafka_options(topic, defaults)).load()
    defaults = {"maxFilesPerTrigger": MAX_FILES_PER_TRIGGER, **options}
    reader = spark.readStream.format(fmt).schema(schemas.TOPIC_ROW).options(**defaults)
    return reader.load(path).filter(F.col("topic") == topic)


def strip_frame(value: Column) -> Column:
    """Drop the magic byte and schema id that precede the payload."""
    return F.substring(value, K.FRAME_HEADER_BYTES + 1, 2_147_483_647)


def decode(
    raw: DataFrame,
    schema: T.StructType | str,
    *,
    codec: str = "json",
    framed: bool = True,
    required: str = "payload.MessageType",
) -> DataFrame:
    """Decode `value` without ever failing the job.

    A record counts as failed when its `required` leaf is null: permissive decoding returns a struct
    of nulls, not a null struct. `codec="avro"` takes the schema as JSON text and needs spark-avro.
    """
    payload = strip_frame(F.col("value")) if framed else F.col("value")
    if codec == "avro":
        from pyspark.sql.avro.functions import from_avro

        record = from_avro(payload, schema, {"mode": "PERMISSIVE"})
    else:
        record = F.from_json(payload.cast("string"), schema, {"mode": "PERMISSIVE"})
    decoded = raw.withColumn("_record", record)
    return decoded.select(
        F.col("key").cast("string").alias("key"), "partition", "offset", "timestamp",
        F.col(f"_record.{required}").isNull().alias("decode_failed"), "_record.*",
    )


def decodable(decoded: DataFrame) -> DataFrame:
    return decoded.filter(~F.col("decode_failed"))


def decode_audit(decoded: DataFrame) -> DataFrame:
    return decoded.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("decode_failed").alias("failed")
    )


def decode_sample(decoded: DataFrame, n: int = 10) -> DataFrame:
    """The first decodable position records, for a look at the data."""
    meta = "payload.MetaData"
    return decodable(decoded).orderBy("partition", "offset").limit(n).select(
        "key", "ingested_at", F.col(f"{meta}.ShipName").alias("ship_name"),
        F.col(f"{meta}.latitude").alias("latitude"), F.col(f"{meta}.longitude").alias("longitude"),
        F.col("payload.Message.PositionReport.Sog").alias("sog"),
    )


def flatten_positions(decoded: DataFrame) -> DataFrame:
    meta, report = "payload.MetaData", "payload.Message.PositionReport"
    return decodable(decoded).select(
        F.col(f"{meta}.MMSI").cast("string").alias("mmsi"),
        feed_time(F.col(f"{meta}.time_utc")).alias("event_time"),
        iso_time(F.col("ingested_at")).alias("ingested_at"),
        F.col(f"{meta}.latitude").alias("lat"),
        F.col(f"{meta}.longitude").alias("lon"),
        F.col(f"{report}.Sog").alias("sog"),
        F.col(f"{report}.NavigationalStatus").alias("nav_status_code"),
        "partition", "offset",
    )


def flatten_static(decoded: DataFrame) -> DataFrame:
    report = "payload.Message.ShipStaticData"
    return decodable(decoded).select(
        F.col("payload.MetaData.MMSI").cast("string").alias("mmsi"),
        F.col("payload.MetaData.ShipName").alias("ship_name"),
        F.col(f"{report}.CallSign").alias("call_sign"),
        F.col(f"{report}.Type").alias("ship_type_code"),
        F.col(f"{report}.Destination").alias("destination"),
        F.col(f"{report}.ImoNumber").alias("imo_number"),
        F.col(f"{report}.MaximumStaticDraught").alias("max_static_draught"),
        iso_time(F.col("ingested_at")).alias("ingested_at"),
    )


def is_json(text: Column) -> Column:
    """Whether text is one strictly valid JSON value: no single quotes, no text after it, not blank."""
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    return F.coalesce(F.try_parse_json(text).isNotNull() & alone, F.lit(False))


def route(
    feed: DataFrame, raw: str = "raw", received_at: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Feed text -> (topic, key, value) and the columns to `keep`, one output row per message.

    Known message types go to their topic in an envelope, others to the dead-letter topic in an
    envelope, unreadable text to the dead-letter topic with its error and without a key. The payload
    text is carried over as it came, whatever fields it has.
    """
    received_at = F.current_timestamp() if received_at is None else received_at
    text = F.col(raw)
    # Strings take whatever scalar stands there, so odd types of single fields never make a message unreadable.
    header = F.from_json(raw, schemas.FEED_HEADER, {"mode": "PERMISSIVE", "allowSingleQuotes": "false"})
    parsed = feed.withColumns({"_header": header, "_unreadable": ~is_json(text)})
    unreadable = F.col("_unreadable")
    envelope = F.concat(
        F.lit('{"ingested_at":"'), F.date_format(received_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"),
        F.lit(f'","source":"{K.ENVELOPE_SOURCE}","schema_version":{K.ENVELOPE_VERSION},"payload":'), text,
        F.lit("}"),
    )
    dead_letter = F.to_json(F.struct(text.alias("raw"), F.lit("message is not valid JSON").alias("error")))
    topic = lookup(F.col("_header.MessageType"), K.TOPIC_BY_MESSAGE_TYPE, K.DEAD_LETTER_TOPIC)
    return parsed.select(
        F.when(unreadable, K.DEAD_LETTER_TOPIC).otherwise(topic).alias("topic"),
        F.when(~unreadable, F.col("_header.MetaData.MMSI")).alias("key"),
        F.when(unreadable, dead_letter).otherwise(envelope).alias("value"),
        *keep,
    )


def in_feed_area(
    feed: DataFrame,
    lat: Column, lon: Column, message_type: Column,
    lat_range: tuple[float, float] = K.LAT_RANGE,
    lon_range: tuple[float, float] = K.LON_RANGE,
    message_types: Sequence[str] = tuple(K.TOPIC_BY_MESSAGE_TYPE),
) -> DataFrame:
    """The subscription of the feed: a box and the message types wanted."""
    return feed.filter(
        lat.between(*lat_range) & lon.between(*lon_range) & message_type.isin(*message_types)
    )
