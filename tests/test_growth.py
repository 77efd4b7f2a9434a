"""Registered queries do their whole job, with work dealt over all tasks."""

from cases import ANCHORAGE, OPEN, POSITION_COLUMNS, events_of, obs, rows, transition
from conftest import SF_SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
from harborflow import schemas
from harborflow.functions import geometry as G
from harborflow.operators import spatial
from harborflow.sources import tables, zones
from harborflow.streaming import sinks, state
from workload import mapping as M
from workload import streams


def test_an_operator_named_only_by_a_part_is_not_missing(spark):
    """Names attribute parts, too: with them every operator has one."""
    assert entry.queries()["missing_operators"](spark, SF_SMALL).collect() == []


def test_a_call_holds_many_vessels(spark, tmp_path):
    """Vessels share buckets, so that calls to workers do not grow with them; each still gets its own events and late rows."""
    base = str(tmp_path)
    first = [r for v in range(60) for r in rows(f"v{v}", [obs(0, ANCHORAGE), obs(6, OPEN, 9.0), obs(12 + v / 60, OPEN, 9.0)])]
    spark.createDataFrame([*first, *rows("w", [obs(90)])], POSITION_COLUMNS).coalesce(1).write.mode("append").parquet(f"{base}/in")
    spark.createDataFrame([*rows("v7", [obs(1)] * 2), *rows("w", [obs(95)])], POSITION_COLUMNS).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(POSITION_COLUMNS).option("maxFilesPerTrigger", "1").parquet(f"{base}/in").withWatermark("event_time", "10 minutes")
    tracked = state.track_vessels(stream, buckets=2)
    sinks.start(tracked, sinks.state_change_writer(base), f"{base}/cp", available_now=True).awaitTermination()
    found = events_of(tables.read_table(spark, base, "vessel_state_changes", schemas.STATE_CHANGES).select(*schemas.STATE_CHANGES.names))
    for v in range(60):
        assert found[f"v{v}"] == sorted([
            transition(0, "UNKNOWN", "AT_ANCHOR", ANCHORAGE[1]), transition(12 + v / 60, "AT_ANCHOR", "UNDERWAY"),
            transition(12 + v / 60, "UNDERWAY", "EXPIRED"),
        ], key=repr)
    late = tables.read_table(spark, base, "late_positions", schemas.LATE).collect()
    assert [tuple(r)[:2] for r in late] == [("v7", 2)]


def test_a_table_in_one_file_is_dealt_over_all_tasks(spark):
    """Areas and zones cost time, not bytes: however they come, several tasks share them."""
    square = F.array(*[G.point(F.col("id") + x, F.lit(float(y))) for x, y in ((0, 0), (0.5, 0), (0.5, 0.5), (0, 0.5), (0, 0))])
    ids = spark.range(400).coalesce(1)
    areas = ids.select(
        F.lit("way").alias("element_type"), F.col("id").alias("element_id"), F.lit("a").alias("name"),
        F.lit(None).cast("string").alias("operator"), F.lit(None).cast("string").alias("brand"), square.alias("ring"),
    )
    berths = zones.berths_from_areas(areas)
    assert berths.count() == 400 and len(berths.inputFiles()) > 1
    covered = spatial.zone_index(berths.select(*schemas.ZONES.names)).cells
    one = spatial.zone_index(berths.select(*schemas.ZONES.names).coalesce(1)).cells
    assert len(one.inputFiles()) > 1
    assert one.exceptAll(covered).isEmpty() and covered.exceptAll(one).isEmpty()


def test_topics_are_encoded_and_members_drawn_once(spark, tmp_path):
    topic = streams.position_topic(M.positions(spark, SF_SMALL))
    streams.write_slices(topic, f"{tmp_path}/topic", shuffled=True)
    written = spark.read.schema(topic.schema).parquet(f"{tmp_path}/topic")
    assert written.exceptAll(topic).isEmpty() and topic.exceptAll(written).isEmpty()
    assert spark.read.parquet(f"{tmp_path}/topic-encoded").count() == topic.count()
    rings = entry.queries()["largest_outer_rings"](spark, SF_SMALL)
    assert any("/members-" in path for path in rings.inputFiles())


def test_topic_files_grow_with_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "ROWS_PER_FILE", 25)
    topic = streams.position_topic(M.positions(spark, SF_SMALL))
    files = streams.write_slices(topic, f"{tmp_path}/topic")
    assert files == -(-topic.count() // (streams.SLICES * 25)) > streams.FILES_PER_SLICE
    assert len(spark.read.parquet(f"{tmp_path}/topic").inputFiles()) == files * streams.SLICES


def test_a_stream_gathers_its_days_and_has_tasks_by_cores(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "100000")
    try:
        assert sinks.state_tasks(spark) == 2 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    base = streams.run_silver(spark, SF_SMALL)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    stored = spark.read.schema(schemas.POSITIONS_SILVER).parquet(f"{base}/positions_silver")
    folders = [path.rpartition("/")[0] for path in stored.inputFiles()]
    assert len(folders) == len(set(folders)) > 1


def test_zones_are_drawn_in_all_tasks(spark):
    """The table of keys is one small file; the zones drawn from it are written, and spoilt, by several tasks."""
    assert len(M.table(spark, SF_SMALL, "customer").inputFiles()) == 1
    assert len(M.knotted_zones(spark, SF_SMALL).inputFiles()) > 1
