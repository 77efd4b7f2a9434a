"""The driver's tables mapped to vessel-shaped tables (see FIXTURES.md, section 3)."""

from __future__ import annotations

import math
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborflow import schemas
from harborflow.functions import geometry as G
from harborflow.operators.dedup import drop_redelivered
from harborflow.operators.quality import tag_quality, valid_rows
from harborflow.operators.spatial import ZoneIndex, best_zone, zone_index
from harborflow.operators.state_machine import state_changes
from harborflow.plans import models
from harborflow.session import configure, spread, store

# Thresholds scaled to the sparse events of the test tables (seconds).
DEBOUNCE = 12 * 3600
DISCREPANCY = 36 * 3600
EXPIRY = 72 * 3600
AS_OF = "2024-02-01 00:00:00"

ZONES = [
    ("anch-b", "anchorage", "Anchorage B",
     [(-118.30, 33.55), (-118.20, 33.55), (-118.20, 33.65), (-118.30, 33.65)]),
    ("anch-b-7", "anchorage", "Sub-Anchorage B-7",
     [(-118.275, 33.57), (-118.23, 33.57), (-118.23, 33.61), (-118.275, 33.61)]),
    ("anch-g", "anchorage", "Anchorage G",
     [(-118.20, 33.55), (-118.06, 33.55), (-118.06, 33.64)]),
    ("berth-1", "berth", "Berth 1",
     [(-118.20, 33.65), (-118.10, 33.65), (-118.10, 33.70), (-118.15, 33.70), (-118.15, 33.765),
      (-118.20, 33.765)]),
    ("harbor-1", "harbor", "Harbor 1",
     [(-118.21, 33.66), (-118.095, 33.66), (-118.095, 33.77), (-118.21, 33.77)]),
]


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


_opened: dict[tuple[str, str], object] = {}


def _once(spark: SparkSession, name: str, make):
    """Static inputs are opened once per application."""
    key = (spark.sparkContext.applicationId, name)
    if key not in _opened:
        _opened[key] = make()
    return _opened[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    configure(spark)
    return _once(spark, path, lambda: spark.read.parquet(path))


def zones(spark: SparkSession) -> DataFrame:
    rows = [
        (zone_id, kind, "CFR", f"fixture {zone_id}", name, [[[*ring, ring[0]]]]) for zone_id, kind, name, ring in ZONES
    ]
    return configure(spark).createDataFrame(rows, schemas.ZONES)


def index(spark: SparkSession) -> ZoneIndex:
    return _once(spark, "zones", lambda: zone_index(zones(spark)))


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", "props",
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("event_time"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("user_id") + 100_000_000).cast("string").alias("mmsi"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their vessel and the number in `props`."""
    return _events(spark, sf_dir).withColumn("k", _k()).drop("props")


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One position per event; every fiftieth event is delivered twice."""
    k, kind = F.col("k"), F.col("event_type")
    copies = F.when(F.col("event_id") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    # The number is parsed along with the copies: filters on what derives from it stay above the parsing.
    delivered = _events(spark, sf_dir).select(
        "mmsi", "event_time", "event_id", "event_type", "value",
        F.inline(F.transform(copies, lambda c: F.struct(c.alias("copy"), _k().alias("k")))),
    )
    delay = F.when(k == 7, 600).otherwise((k % 6) * 60) + F.col("copy")
    slow = kind.isin("view", "click", "purchase")
    return delivered.select(
        "mmsi", "event_time",
        F.timestamp_micros(F.unix_micros("event_time") + delay * 1_000_000).alias("ingested_at"),
        (F.lit(33.56) + F.lit(0.022) * (k % 10)).alias("lat"),
        (F.lit(-118.29) + F.lit(0.025) * F.floor(k / 10)).alias("lon"),
        F.when(slow, F.col("value") / 100).otherwise(F.col("value") / 8).alias("sog"),
        F.when(kind == "view", 0).when(kind == "click", 1).when(kind == "purchase", 5)
        .when(kind == "signup", 8).otherwise(15).alias("nav_status_code"),
        F.lit(0).alias("partition"),
        (F.col("event_id") + F.col("copy") * 1_000_000_000).alias("offset"),
    )


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_quality(positions(spark, sf_dir))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid positions, each (vessel, time) once."""
    return drop_redelivered(valid_rows(tagged(spark, sf_dir)))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = best_zone(clean(spark, sf_dir), index(spark))
    return located.withColumn("event_date", F.to_date("event_time")).select(*schemas.POSITIONS_SILVER.names)


def vessel_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per possible position, key only: what hot vessels are counted from."""
    copies = F.when(F.col("event_id") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") + 100_000_000).cast("string").alias("mmsi"), F.explode(copies)
    ).select("mmsi")


def changes(spark: SparkSession, sf_dir: str, of: DataFrame | None = None, **options) -> DataFrame:
    return state_changes(
        silver(spark, sf_dir) if of is None else of, debounce=DEBOUNCE, discrepancy=DISCREPANCY, expiry=EXPIRY,
        count_from=vessel_keys(spark, sf_dir), **options,
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Read twice, so written once.
    stored = store(silver(spark, sf_dir), "silver")
    return models.vessel_sessions(changes(spark, sf_dir, stored), models.zones_lookup(stored), as_of())


def ship_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static messages: the sign-up events. `offset` settles equal times."""
    k = F.col("k")
    return events(spark, sf_dir).filter(F.col("event_type") == "signup").select(
        "mmsi",
        F.concat(F.lit("SHIP "), F.col("user_id").cast("string"), F.lit("-"), k.cast("string"), F.lit("   "))
        .alias("ship_name"),
        F.concat(F.lit("C"), k.cast("string"), F.lit(" ")).alias("call_sign"),
        k.alias("ship_type_code"),
        F.when(k % 2 == 0, "USLAX  ").otherwise("USLGB  ").alias("destination"),
        (F.col("user_id") + 9_000_000).alias("imo_number"),
        (F.col("value") / 10).alias("max_static_draught"),
        F.col("ts").alias("ingested_at"),
        F.col("event_id").alias("offset"),
    )


def dim_vessels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.dim_vessels(ship_static(spark, sf_dir), tie="offset")


def dwell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.anchorage_dwell(sessions(spark, sf_dir))


# --- feed messages ---------------------------------------------------------------


def feed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed text per delivered event: positions, static reports, unknown types and broken JSON.

    Unknown types have numbers written as text, which is valid; text is broken in four ways, one of them empty.
    """
    k, kind = F.col("k"), F.col("event_type")
    lat, lon = F.lit(33.56) + F.lit(0.022) * (k % 10), F.lit(-118.29) + F.lit(0.025) * F.floor(k / 10)
    sog = F.when(kind.isin("view", "click", "purchase"), F.col("value") / 100).otherwise(F.col("value") / 8)
    message_type = (
        F.when(kind == "signup", "ShipStaticData").when(kind == "purchase", "BaseStationReport")
        .otherwise("PositionReport")
    )
    # Every 40th number lacks a vessel id.
    number = F.when(k % 40 != 39, F.col("user_id") + 100_000_000)
    meta = F.struct(
        number.alias("MMSI"), number.alias("MMSI_String"),
        F.concat(F.lit("SHIP "), F.col("user_id").cast("string")).alias("ShipName"),
        lat.alias("latitude"), lon.alias("longitude"),
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("000 +0000 UTC")).alias("time_utc"),
    )
    report = F.struct(
        lat.alias("Latitude"), lon.alias("Longitude"), F.lit(1).alias("MessageID"),
        F.when(kind == "view", 0).when(kind == "click", 1).otherwise(15).alias("NavigationalStatus"),
        sog.alias("Sog"), number.alias("UserID"), F.lit(True).alias("Valid"),
    )
    static = F.struct(
        F.concat(F.lit("C"), k.cast("string"), F.lit(" ")).alias("CallSign"),
        F.when(k % 2 == 0, "USLAX  ").otherwise("USLGB  ").alias("Destination"),
        (F.col("user_id") + 9_000_000).alias("ImoNumber"), (F.col("value") / 10).alias("MaximumStaticDraught"),
        k.alias("Type"), number.alias("UserID"), F.lit(True).alias("Valid"),
    )
    body = F.struct(
        message_type.alias("MessageType"), meta.alias("MetaData"),
        F.struct(
            F.when(message_type == "PositionReport", report).alias("PositionReport"),
            F.when(message_type == "ShipStaticData", static).alias("ShipStaticData"),
        ).alias("Message"),
    )
    plain = F.to_json(body)
    quoted = F.regexp_replace(plain, r'"(MMSI|latitude)":([0-9.-]+)', r'"$1":"$2"')
    text = F.when((message_type == "BaseStationReport") & (k % 2 == 0), quoted).otherwise(plain)
    broken = (
        F.when(k % 5 == 1, F.replace(F.col("text"), F.lit('"'), F.lit("'"))).when(k % 5 == 2, F.concat(F.col("text"), F.lit(" xyz")))
        .when(k % 5 == 3, F.lit("")).otherwise(F.expr("left(text, length(text) - 20)"))
    )
    return events(spark, sf_dir).withColumns({"text": text, "message_type": message_type}).select(
        "event_id", "event_type", "k", "ts", lat.alias("lat"), lon.alias("lon"), "message_type",
        F.when(kind == "error", broken).otherwise(F.col("text")).alias("raw"),
    )


def topic_rows(routed: DataFrame, tie: str = "event_id") -> DataFrame:
    """Routed messages as rows of a topic, with a frame header before the payload."""
    header = F.unhex(F.lit("0000000001"))
    return routed.select(
        F.col("key").cast("binary").alias("key"),
        F.concat(header, F.col("value").cast("binary")).alias("value"), "topic",
        F.lit(0).alias("partition"), F.col(tie).alias("offset"), F.col("ts").alias("timestamp"),
    )


# --- zones derived from tables -----------------------------------------------------

# Customers, suppliers and parts give many zones spread over a wide area, so that zone queries
# grow with the tables.


def customer_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone per customer, on a lattice of one-degree tiles with 40 customers each.

    A rectangle; every third one has a hole of half its width and height, every fifth one a second part to its right.
    """
    key = F.col("c_custkey")
    tile = F.floor(key / 40)
    x = (tile % 300) - 150 + F.lit(0.02) * (key % 40) + F.lit(0.001) * (key % 7)
    y = F.floor(tile / 300) - 60 + F.lit(0.01) * ((key * 13) % 40)
    width = F.lit(0.05) + F.lit(0.002) * (key % 11)
    height = F.lit(0.15) + F.lit(0.003) * (key % 5)
    zone_type = F.get(F.array(*[F.lit(t) for t in ["anchorage", "berth", "harbor"]]), (key % 3).cast("int"))

    def rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
        return F.array(*[G.point(a, b) for a, b in [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]])

    whole = rectangle(x, y, x + width, y + height)
    hole = rectangle(x + width * 0.25, y + height * 0.25, x + width * 0.75, y + height * 0.75)
    second = rectangle(x + width * 2, y, x + width * 2.5, y + height)
    first = F.when(key % 3 == 0, F.array(whole, hole)).otherwise(F.array(whole))
    shape = F.when(key % 5 == 0, F.array(first, F.array(second))).otherwise(F.array(first))
    # Dealt before shapes are drawn: keys of many zones come in few files.
    return spread(table(spark, sf_dir, "customer").select("c_custkey", "c_name")).select(
        F.concat(F.lit("zone-"), F.lpad(key.cast("string"), 9, "0")).alias("zone_id"), zone_type.alias("zone_type"),
        F.lit("NOAA").alias("authority"), F.concat(F.lit("customer "), key.cast("string")).alias("source_ref"),
        F.col("c_name").alias("name"), shape.alias("shape"),
    )


def knotted_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer zones, three in four of them spoilt: by a spike, by a ring that touches itself, by a ring that cuts itself."""
    key = F.regexp_extract("zone_id", r"(\d+)$", 1).cast("long")
    ring = F.get(F.get(F.col("shape"), F.lit(0)), F.lit(0))
    a, b, c, d = (F.get(ring, F.lit(i)) for i in range(4))
    top = G.point(c["x"], c["y"] + F.lit(0.125))
    middle = G.point((a["x"] + c["x"]) / 2, (a["y"] + c["y"]) / 2)
    spike, touch, cut = F.array(a, b, c, top, c, d, a), F.array(a, b, middle, c, d, middle, a), F.array(a, c, b, d, a)
    spoilt = F.when(key % 4 == 1, spike).when(key % 4 == 2, touch).when(key % 4 == 3, cut)
    return store(customer_zones(spark, sf_dir), "zones").withColumn("shape", F.coalesce(G.shape_of(spoilt), F.col("shape")))


def order_waypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as the waypoints of one ring per order, set around a centre by their number."""
    n = F.col("l_linenumber")
    angle = n * (2 * math.pi / 8)
    reach = F.lit(0.001) + F.col("l_quantity") / 5000
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", n.alias("seq"), (F.lit(-118.2) + reach * F.cos(angle)).alias("x"),
        (F.lit(33.7) + reach * F.sin(angle)).alias("y"),
    )
