import datetime as dt

import numpy as np
import pytest
from cases import ANCHORAGE, OPEN, POSITION_COLUMNS, SCENARIOS, at, events_of, obs, random_tracks, rows, transition
from pyspark.sql import functions as F

from harborflow import constants as K
from harborflow import schemas
from harborflow.operators.quality import tag_quality
from harborflow.operators.state_machine import state_changes
from harborflow.sources import tables
from harborflow.streaming import jobs, sinks
from harborflow.streaming.state import track_vessels
from workload import mapping as M
from workload import streams


def write_chunks(spark, path, *chunks):
    """One file per chunk, in this order."""
    for chunk in chunks:
        spark.createDataFrame(chunk, POSITION_COLUMNS).coalesce(1).write.mode("append").parquet(path)


def located_stream(spark, path, delay="10 minutes"):
    stream = spark.readStream.schema(POSITION_COLUMNS).option("maxFilesPerTrigger", "1").parquet(path)
    return stream.withWatermark("event_time", delay)


def run(spark, path, base, delay="10 minutes"):
    writer = sinks.state_change_writer(base, "json")
    query = sinks.start(track_vessels(located_stream(spark, path, delay)), writer, sinks.checkpoint_path(base, "state"), available_now=True)
    query.awaitTermination()


def stored(spark, base):
    return tables.read_table(spark, base, "vessel_state_changes", schemas.STATE_CHANGES).select(*schemas.STATE_CHANGES.names)


# A vessel that reports until the end keeps the watermark close behind the others.
CLOSING = "closing"


@pytest.fixture(scope="module")
def scenarios(spark, tmp_path_factory):
    """All scenarios as one stream: shuffled over three files, then a vessel that moves the watermark past them."""
    root = tmp_path_factory.mktemp("scenarios")
    data = [r for name, (o, _) in SCENARIOS.items() for r in rows(name, o)]
    shuffled = [data[i] for i in np.random.default_rng(7).permutation(len(data))]
    cuts = [shuffled[:len(data) // 3], shuffled[len(data) // 3:len(data) // 2], shuffled[len(data) // 2:]]
    write_chunks(spark, str(root / "in"), *cuts, rows(CLOSING, [obs(24 * 60, OPEN, 9.0)]))
    run(spark, str(root / "in"), str(root / "lake"), delay="10 hours")
    return events_of(stored(spark, str(root / "lake")))


@pytest.mark.parametrize("name", SCENARIOS)
def test_scenario_in_stream(scenarios, name):
    """The watermark passes the end of every scenario, so its vessel expires at last, unless it had already."""
    last = max(r[1] for r in rows(name, SCENARIOS[name][0]))
    want = list(SCENARIOS[name][1])
    states = sorted((e for e in want if e[2] is not None), key=lambda e: (e[6], e[2] == "EXPIRED"))
    if states and states[-1][2] != "EXPIRED":
        want.append((K.STATE_TRANSITION, states[-1][2], "EXPIRED", None, "EXPIRED", None, last))
    assert scenarios[name] == sorted(want, key=repr)


def test_timer_expires_silent_vessels_once(spark, tmp_path):
    quiet = rows("quiet", [obs(0, ANCHORAGE), obs(5, ANCHORAGE)])
    closing = [rows(CLOSING, [obs(m, OPEN, 9.0)]) for m in (5, 30, 50, 70, 90)]
    write_chunks(spark, str(tmp_path / "in"), quiet + closing[0], *closing[1:])
    run(spark, str(tmp_path / "in"), str(tmp_path / "lake"))
    got = events_of(stored(spark, str(tmp_path / "lake")))
    assert got["quiet"] == sorted(
        [transition(0, "UNKNOWN", "AT_ANCHOR", ANCHORAGE[1]), transition(5, "AT_ANCHOR", "EXPIRED")], key=repr)
    assert got[CLOSING] == [transition(5, "UNKNOWN", "UNDERWAY")]


def test_restart_from_checkpoint_equals_one_run_and_batch(spark, tmp_path):
    """Stop after each file, start again: the same events as without stopping, and as in batch."""
    data = sorted(random_tracks(np.random.default_rng(11), 25, 40), key=lambda r: (r[1], r[0], r[9]))
    size = len(data) // 4 + 1
    chunks = [data[i:i + size] for i in range(0, len(data), size)]
    parts, whole, halting = str(tmp_path / "parts"), str(tmp_path / "whole"), str(tmp_path / "halting")
    for chunk in chunks:
        write_chunks(spark, parts, chunk)
        run(spark, parts, halting)
    run(spark, parts, whole)
    batch = events_of(state_changes(
        # The stream applies what the watermark has passed.
        spark.createDataFrame([r for r in data if r[1] <= max(x[1] for x in data) - dt.timedelta(minutes=10)], POSITION_COLUMNS),
        # A timer needs the watermark to pass the expiry, batch to reach it.
        watermark=F.timestamp_micros(F.unix_micros(F.lit(max(r[1] for r in data))) - 600_000_000 - 1),
    ))
    assert events_of(stored(spark, whole)) == batch
    assert events_of(stored(spark, halting)) == batch


@pytest.mark.parametrize("limit", [10**6, 0])
def test_state_job_with_nested_zones(spark, tmp_path, limit):
    """The best zone counts, whether the zone side is broadcast or joined by shuffle."""
    from harborflow.operators.spatial import zone_index

    index = zone_index(M.zones(spark), max_broadcast_edges=limit)
    inside_both, outside = (33.6, -118.25), (33.7, -118.0)
    data = [("v", at(m), lat, lon, 0.1, 15, None, None, 0, m)
            for m, (lat, lon) in [(0, inside_both), (3, inside_both), (4, outside), (10, outside)]]
    write_chunks(spark, str(tmp_path / "in"), data, [("w", at(25), *outside, 0.1, 15, None, None, 0, 0)])
    positions = located_stream(spark, str(tmp_path / "in")).drop("zone_id", "zone_type")
    jobs.run_state_changes(positions, index, str(tmp_path / "lake"), available_now=True).awaitTermination()
    assert events_of(stored(spark, str(tmp_path / "lake")))["v"] == sorted(
        [transition(0, "UNKNOWN", "AT_ANCHOR", "anch-b-7"), transition(10, "AT_ANCHOR", "UNDERWAY")], key=repr)


def test_replayed_batch_leaves_one_copy_in_the_table(spark, tmp_path):
    base = str(tmp_path / "lake")
    df = spark.createDataFrame([("1", *transition(0, "UNKNOWN", "UNDERWAY"))], schemas.STATE_CHANGES)
    write = sinks.state_change_writer(base, "json")
    write(df, 0)
    write(df, 0)
    write(df.limit(0), 1)
    assert stored(spark, base).count() == 1
    message = spark.read.schema("key string, value string, topic string").json(f"{base}/state_change_messages").first()
    assert message["key"] == "1" and '"to_state":"UNDERWAY"' in message["value"]


def test_two_queries_and_a_batch_load_share_a_table(spark, tmp_path):
    """Two checkpoints both start at batch 0; neither replaces the other's rows, nor those of a batch load."""
    base = str(tmp_path / "lake")
    for name in ("a", "b"):
        write_chunks(spark, str(tmp_path / name), [(name, at(1), 33.6, -118.1, 1.0, 0, None, None, 0, 1)])
        stream = located_stream(spark, str(tmp_path / name)).drop("zone_id", "zone_type")

        def write(batch, batch_id):
            tables.append_batch(batch.select("mmsi"), base, "t", batch_id, partition_by=())

        sinks.start(stream, write, str(tmp_path / f"cp-{name}"), available_now=True).awaitTermination()
    tables.write_load(spark.createDataFrame([("c",)], "mmsi string"), base, "t", "batch")
    assert sorted(r["mmsi"] for r in tables.read_table(spark, base, "t").collect()) == ["a", "b", "c"]


def test_deduplication_across_batches(spark, tmp_path):
    twin = ("v", at(1), 33.6, -118.1, 1.0, 0, None, None, 0, 1)
    write_chunks(spark, str(tmp_path / "in"), [twin], [(*twin[:9], 2)])
    once = jobs.without_redelivered(located_stream(spark, str(tmp_path / "in")))
    query = sinks.append_stream(once, str(tmp_path), "once", str(tmp_path / "cp"), available_now=True)
    query.awaitTermination()
    assert tables.read_table(spark, str(tmp_path), "once").count() == 1


def test_silver_stream_equals_batch(spark):
    sf = "/root/testdata/sf0.001"
    base = streams.run_silver(spark, sf)
    silver = tables.read_table(spark, base, "positions_silver", schemas.POSITIONS_SILVER).select(*schemas.POSITIONS_SILVER.names)
    expected = M.silver(spark, sf)
    assert silver.exceptAll(expected).count() == 0 and expected.exceptAll(silver).count() == 0
    quarantined = tables.read_table(spark, base, "positions_quarantine", schemas.POSITIONS_QUARANTINE)
    assert quarantined.count() == M.tagged(spark, sf).filter("NOT quality_ok").count()


def test_late_rows_are_counted_and_the_rest_put_in_order(spark, tmp_path):
    """Rows shuffled over files: those behind the watermark are counted, all others give the events of a batch over them."""
    data = random_tracks(np.random.default_rng(3), 12, 40)
    start = min(r[1] for r in data)
    rng = np.random.default_rng(5)
    place = [int((r[1] - start).total_seconds() // 5400) + int(rng.integers(0, 3)) for r in data]
    chunks = [[r for r, p in zip(data, place) if p == i] for i in range(max(place) + 1)]
    chunks = [c for c in chunks if c]
    write_chunks(spark, str(tmp_path / "in"), *chunks)
    run(spark, str(tmp_path / "in"), str(tmp_path / "lake"), delay="1 hour")
    taken, late, mark = [], {}, None
    for chunk in chunks:
        for r in chunk:
            if mark is not None and r[1] <= mark:
                late[r[0]] = late.get(r[0], 0) + 1
            else:
                taken.append(r)
        mark = max([x[1] for c in chunks[:chunks.index(chunk) + 1] for x in c]) - dt.timedelta(hours=1)
    batch = events_of(state_changes(
        spark.createDataFrame([r for r in taken if r[1] <= mark], POSITION_COLUMNS),
        watermark=F.timestamp_micros(F.unix_micros(F.lit(mark)) - 1),
    ))
    assert events_of(stored(spark, str(tmp_path / "lake"))) == batch
    counted = tables.read_table(spark, str(tmp_path / "lake"), "late_positions", schemas.LATE).groupBy("mmsi").agg(F.sum("late_rows")).collect()
    assert dict(map(tuple, counted)) == late and late


def test_session_keeps_its_state_store(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    write_chunks(spark, str(tmp_path / "in"), rows("v", [obs(0, ANCHORAGE)]))
    run(spark, str(tmp_path / "in"), str(tmp_path / "lake"))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_silver_takes_the_first_good_delivery_across_batches(spark, tmp_path):
    """A bad first delivery does not hide the good one after it; later good ones, in the same or a later batch, are dropped."""
    def row(minute, offset, lat=33.7, mmsi="123456789", skew=0):
        return (mmsi, at(minute), at(minute + skew), lat, -118.2, 1.0, 0, 0, offset)

    columns = "mmsi string, event_time timestamp, ingested_at timestamp, lat double, lon double, sog double, nav_status_code int, partition int, offset long"
    chunks = [
        [row(0, 5), row(0, 3), row(1, 4, lat=99.0), row(2, 6, skew=9), row(3, 7)],
        [row(0, 8), row(1, 9), row(2, 10), row(2, 11), row(3, 12, lat=None), row(3, 13)],
        [row(1, 14), row(-9000, 15), row(0, 16, mmsi="987654321"), row(0, 17, mmsi=None)],
    ]
    for chunk in chunks:
        spark.createDataFrame(chunk, columns).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(columns).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in")).withWatermark("event_time", "1 minute")
    jobs.run_silver(stream, M.index(spark), str(tmp_path / "lake"), available_now=True).awaitTermination()
    silver = tables.read_table(spark, str(tmp_path / "lake"), "positions_silver", schemas.POSITIONS_SILVER)
    assert sorted(r["offset"] for r in silver.collect()) == [3, 7, 9, 10, 15, 16]
    bad = tables.read_table(spark, str(tmp_path / "lake"), "positions_quarantine", schemas.POSITIONS_QUARANTINE)
    assert sorted(r["offset"] for r in bad.collect()) == [4, 6, 12, 17]


def test_silver_reports_each_batch(spark, tmp_path):
    """A batch's counts are taken while its rows are written; a batch without valid rows writes none."""
    good = [("v", at(i), 33.6, -118.1, 1.0, 0, None, None, 0, i) for i in range(3)]
    bad = [("v", at(9), 133.6, -118.1, 1.0, 0, None, None, 0, 9)]
    batches = [good + bad, bad, good]
    seen, base = [], str(tmp_path / "lake")
    write = sinks.silver_writer(base, M.index(spark), lambda batch_id, counts: seen.append((batch_id, counts)))
    for i, data in enumerate(batches):
        batch = tag_quality(
            spark.createDataFrame(data, POSITION_COLUMNS).drop("zone_type", "zone_id")
            .withColumns({"ingested_at": F.col("event_time"), "mmsi": F.lit("366000001")})
        )
        write(batch, i)
    assert seen == [(0, {"valid": 3, "bad": 1}), (1, {"valid": 0, "bad": 1}), (2, {"valid": 3, "bad": 0})]
    assert tables.read_table(spark, base, "positions_silver", schemas.POSITIONS_SILVER).count() == 6
    assert tables.read_table(spark, base, "positions_quarantine", schemas.POSITIONS_QUARANTINE).count() == 2
