"""From lake tables to the derived tables, their tests and the snapshot, in one application."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborflow import constants as K
from harborflow import schemas
from harborflow.operators import checks
from harborflow.operators.dedup import drop_redelivered
from harborflow.operators.quality import quarantined_rows, tag_quality, valid_rows
from harborflow.operators.spatial import ZoneIndex, best_zone
from harborflow.operators.state_machine import state_changes
from harborflow.plans import models
from harborflow.sources.tables import export_snapshot, read_table, write_load, write_table

SOURCES = {
    "positions_silver": schemas.POSITIONS_SILVER,
    "vessel_state_changes": schemas.STATE_CHANGES,
    "ship_static": schemas.SHIP_STATIC,
}


def build_lake(positions: DataFrame, zones: ZoneIndex, base: str, **thresholds: int) -> None:
    """Batch form of the streams: positions to silver, quarantine and state changes.

    The two outcomes of the quality check are two scans of `positions`, which is cheaper than holding or
    writing all of it; the state machine reads the silver table just written.
    """
    spark = positions.sparkSession
    tagged = tag_quality(positions)
    bad = quarantined_rows(tagged).withColumn("quarantined_at", F.current_timestamp())
    write_load(bad.select(*schemas.POSITIONS_QUARANTINE.names), base, "positions_quarantine", "batch")

    located = best_zone(drop_redelivered(valid_rows(tagged)), zones)
    silver = located.withColumn("event_date", F.to_date("event_time")).select(*schemas.POSITIONS_SILVER.names)
    write_load(silver, base, "positions_silver", "batch", partition_by=("event_date",))

    stored = read_table(spark, base, "positions_silver", schemas.POSITIONS_SILVER)
    write_load(state_changes(stored, **thresholds), base, "vessel_state_changes", "batch")


def load_sources(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    return {name: read_table(spark, base, name, schema).select(*schema.names) for name, schema in SOURCES.items()}


def build_gold(sources: Mapping[str, DataFrame], base: str, as_of: Column | None = None) -> dict[str, DataFrame]:
    """Write the derived tables; sessions are stored first because four tables read them."""
    spark = next(iter(sources.values())).sparkSession
    built: dict[str, DataFrame] = {}

    def build(name: str, df: DataFrame) -> DataFrame:
        write_table(df, base, name)
        built[name] = read_table(spark, base, name, df.schema)
        return built[name]

    changes = models.staged_state_changes(sources["vessel_state_changes"])
    zones = build("int_zones", models.zones_lookup(models.staged_positions(sources["positions_silver"])))
    sessions = build("int_vessel_sessions", models.vessel_sessions(changes, zones, as_of))
    build("dim_vessels", models.dim_vessels(models.staged_ship_static(sources["ship_static"])))
    build("fct_berth_visits", models.berth_visits(sessions))
    build("fct_anchorage_dwell", models.anchorage_dwell(sessions))
    build("fct_vessel_activity_daily", models.daily_activity(sessions))
    build("fct_discrepancy_events", models.discrepancy_episodes(changes, as_of))
    return built


def check_tables(sources: Mapping[str, DataFrame], gold: Mapping[str, DataFrame], as_of: Column | None = None) -> DataFrame:
    """All declared tests of sources and derived tables, one row each."""
    vessels = gold["dim_vessels"]
    keys = {
        "dim_vessels": ("mmsi", ["mmsi"]),
        "fct_berth_visits": ("berth_visit_id", ["berth_visit_id", "berth_id"]),
        "fct_anchorage_dwell": ("anchorage_dwell_id", ["anchorage_dwell_id", "anchorage_id"]),
        "fct_discrepancy_events": ("discrepancy_event_id", ["discrepancy_event_id", "mmsi"]),
        "int_zones": ("zone_id", ["zone_id"]),
        "int_vessel_sessions": ("session_id", ["session_id", "mmsi"]),
    }
    results = []
    for name, (key, required) in keys.items():
        results += [checks.unique(gold[name], name, key), checks.not_null(gold[name], name, required)]
    for name in ("fct_berth_visits", "fct_anchorage_dwell", "fct_vessel_activity_daily"):
        # A vessel may well report positions before its first static message: a warning only.
        results.append(checks.relationships(gold[name], name, "mmsi", vessels, "mmsi", "warn"))
    for name, column, values in [
        ("fct_vessel_activity_daily", "state", K.VESSEL_STATES),
        ("fct_discrepancy_events", "derived_state", K.VESSEL_STATES),
        ("int_vessel_sessions", "state", K.VESSEL_STATES),
        ("int_zones", "zone_type", K.ZONE_TYPES_IN_MODELS),
    ]:
        results.append(checks.accepted_values(gold[name], name, column, values))
    results += [
        checks.not_null(sources["positions_silver"], "positions_silver", ["mmsi", "event_time"]),
        checks.not_null(sources["vessel_state_changes"], "vessel_state_changes", ["mmsi"]),
        checks.not_null(sources["ship_static"], "ship_static", ["mmsi"]),
    ]
    for name, (column, warn, error) in K.FRESHNESS.items():
        results.append(checks.freshness(sources[name], name, column, warn, error, as_of))
    return checks.run_checks(results)


def run_gold(spark: SparkSession, base: str, as_of: Column | None = None) -> dict[str, DataFrame]:
    """Derived tables, their test results and the "at anchor now" snapshot under `base`."""
    sources = load_sources(spark, base)
    gold = build_gold(sources, base, as_of)
    results = check_tables(sources, gold, as_of)
    write_table(results, base, "test_results")
    snapshot = models.at_anchor_now(gold["fct_anchorage_dwell"], gold["dim_vessels"], as_of)
    export_snapshot(snapshot, f"{base}/at_anchor_now", as_of)
    return {**gold, "test_results": read_table(spark, base, "test_results", schemas.CHECK_RESULT)}
