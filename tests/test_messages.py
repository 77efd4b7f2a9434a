import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from harborflow import constants as K
from harborflow import schemas
from harborflow.sources import messages

RECEIVED = dt.datetime(2026, 7, 15, 9, 17, 6, 500)


def position(mmsi=367625810, sog=5.2):
    return {
        "MessageType": "PositionReport",
        "MetaData": {"MMSI": mmsi, "MMSI_String": mmsi, "ShipName": "X", "latitude": 33.7, "longitude": -118.2,
                     "time_utc": "2026-07-15 09:17:05.994178528 +0000 UTC"},
        "Message": {"PositionReport": {"Sog": sog, "NavigationalStatus": 1, "Spare": 0}},
        "Unknown": {"kept": True},
    }


FEED = {
    "position": json.dumps(position()),
    "static": json.dumps({"MessageType": "ShipStaticData", "MetaData": {"MMSI": 1}, "Message": {}}),
    "other": json.dumps({"MessageType": "BaseStationReport", "MetaData": {"MMSI": 2}}),
    "no_vessel": json.dumps({"MessageType": "PositionReport", "MetaData": {}}),
    "no_metadata": json.dumps({"MessageType": "PositionReport"}),
    "broken": '{"MessageType": "Posit',
    "text": "not json at all",
    "text_numbers": '{"MessageType":"PositionReport","MetaData":{"MMSI":"367000001","latitude":"33.7"}}',
    "single_quotes": "{'MessageType':'PositionReport','MetaData':{'MMSI':3}}",
    "trailing": '{"MessageType":"PositionReport","MetaData":{"MMSI":4}} xyz',
    "two_values": '{"MessageType":"PositionReport"},{"MessageType":"PositionReport"}',
    "empty": "",
}


@pytest.fixture(scope="module")
def routed(spark):
    df = spark.createDataFrame(list(FEED.items()), "name string, raw string")
    out = messages.route(df, received_at=F.lit(RECEIVED), keep=["name"])
    return {r["name"]: r for r in out.collect()}


@pytest.mark.parametrize(
    ("name", "topic", "key"),
    [
        ("position", "ais.raw.positions", "367625810"), ("static", "ais.raw.static", "1"),
        ("other", "ais.deadletter", "2"), ("no_vessel", "ais.raw.positions", None),
        ("no_metadata", "ais.raw.positions", None), ("broken", "ais.deadletter", None), ("text", "ais.deadletter", None),
        ("text_numbers", "ais.raw.positions", "367000001"), ("single_quotes", "ais.deadletter", None),
        ("trailing", "ais.deadletter", None), ("two_values", "ais.deadletter", None), ("empty", "ais.deadletter", None),
    ],
)
def test_routing(routed, name, topic, key):
    assert (routed[name]["topic"], routed[name]["key"]) == (topic, key)


def test_envelope_carries_the_whole_payload(routed):
    envelope = json.loads(routed["position"]["value"])
    assert envelope["payload"] == position()
    assert envelope["source"] == K.ENVELOPE_SOURCE and envelope["schema_version"] == 1
    assert dt.datetime.fromisoformat(envelope["ingested_at"]) == RECEIVED.replace(tzinfo=dt.timezone.utc)


@pytest.mark.parametrize("name", ["broken", "text", "single_quotes", "trailing", "two_values"])
def test_unreadable_text_is_kept_with_its_error(routed, name):
    letter = json.loads(routed[name]["value"])
    assert letter["raw"] == FEED[name] and letter["error"]


def topic_rows(spark, values):
    rows = [(b"k", b"\x00\x00\x00\x00\x01" + v.encode(), "t", 0, i, RECEIVED) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, schemas.TOPIC_ROW)


def test_decoding_never_fails(spark, routed):
    raw = topic_rows(spark, [routed["position"]["value"], "plain text", "{}", routed["broken"]["value"]])
    decoded = messages.decode(raw, schemas.POSITION_ENVELOPE)
    assert {r["offset"]: r["decode_failed"] for r in decoded.collect()} == {0: False, 1: True, 2: True, 3: True}
    assert messages.decode_audit(decoded).first().asDict() == {"total": 4, "failed": 3}
    (flat,) = messages.flatten_positions(decoded).collect()
    assert flat.asDict() == {
        "mmsi": "367625810", "event_time": dt.datetime(2026, 7, 15, 9, 17, 5), "ingested_at": RECEIVED, "lat": 33.7,
        "lon": -118.2, "sog": 5.2, "nav_status_code": 1, "partition": 0, "offset": 0,
    }
    assert messages.flatten_positions(decoded).schema == schemas.POSITIONS


def test_static_flattening(spark):
    body = {"ingested_at": "2026-07-15T09:17:06+00:00", "payload": {
        "MessageType": "ShipStaticData", "MetaData": {"MMSI": 5, "ShipName": "A  "},
        "Message": {"ShipStaticData": {"CallSign": "C ", "Type": 70, "Destination": "USLAX", "ImoNumber": 9,
                                       "MaximumStaticDraught": 7.5, "Spare": True}}}}
    decoded = messages.decode(topic_rows(spark, [json.dumps(body)]), schemas.STATIC_ENVELOPE)
    flat = messages.flatten_static(decoded)
    assert flat.schema == schemas.SHIP_STATIC
    assert tuple(flat.first()) == ("5", "A  ", "C ", 70, "USLAX", 9, 7.5, dt.datetime(2026, 7, 15, 9, 17, 6))


def test_scan_reads_one_topic(spark, tmp_path):
    topic_rows(spark, ["{}"]).withColumn("topic", F.lit("a")).write.parquet(str(tmp_path / "t"))
    topic_rows(spark, ["{}", "{}"]).withColumn("topic", F.lit("b")).write.mode("append").parquet(str(tmp_path / "t"))
    assert messages.scan_topic(spark, "b", path=str(tmp_path / "t")).count() == 2


def test_feed_subscription(spark):
    df = spark.createDataFrame(
        [(33.6, -118.1, "PositionReport"), (33.55, -118.3, "ShipStaticData"), (34.0, -118.1, "PositionReport"),
         (33.6, -118.1, "Other")], "lat double, lon double, kind string")
    assert messages.in_feed_area(df, F.col("lat"), F.col("lon"), F.col("kind")).count() == 2
