"""Registered queries: one or more per operator, all over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborflow import constants as K
from harborflow import schemas
from harborflow.functions import geometry as G
from harborflow.functions import scalars as S
from harborflow.operators import checks, dedup, quality, spatial, validity
from harborflow.operators.asof import state_as_of
from harborflow.operators.buffers import line_buffers as line_buffers_of
from harborflow.operators.ordered import number_rows
from harborflow.operators.state_machine import vessel_timeline
from harborflow.plans import agreement as agree
from harborflow.plans import models
from harborflow.session import new_path, store
from harborflow.sources import messages, tables
from harborflow.sources import zones as zone_sources
from workload import mapping as M

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _r(column, digits: int = 6):
    return F.round(column, digits)


# --- quality, deduplication, silver ------------------------------------------------


@query
def quality_tagged(spark, sf):
    return M.tagged(spark, sf).select(
        "mmsi", "event_time", "offset", "quality_ok", "quality_failures"
    )


@query
def quarantine_summary(spark, sf):
    return (
        quality.quarantined_rows(M.tagged(spark, sf)).groupBy("quality_failures")
        .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("mmsi").alias("vessels"))
    )


@query
def quality_split(spark, sf):
    return M.tagged(spark, sf).groupBy("quality_ok").agg(F.count(F.lit(1)).alias("n"))


@query
def silver_positions(spark, sf):
    return M.silver(spark, sf).withColumns({"lat": _r("lat"), "lon": _r("lon"), "sog": _r("sog")})


@query
def silver_table(spark, sf):
    """Silver written by event_date, read back with a pruned scan over all its days."""
    base = new_path(spark, "silver")
    tables.write_table(M.silver(spark, sf), base, "positions_silver", partition_by=("event_date",))
    stored = tables.read_table(spark, base, "positions_silver", schemas.POSITIONS_SILVER)
    return stored.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n"), F.count("zone_id").alias("in_zone"), F.max("offset").alias("max_offset")
    )


@query
def inspected_silver(spark, sf):
    """Row count next to the newest rows, as a look at a table shows them."""
    count, _, shown = tables.inspect(store(M.silver(spark, sf), "silver"), "offset", 10)
    return shown.select("mmsi", "event_time", "offset", F.lit(count).alias("n"))


@query
def source_views(spark, sf):
    """SQL over the lake's tables, registered as views."""
    base = new_path(spark, "lake")
    tables.write_load(M.silver(spark, sf), base, "positions_silver", "batch", partition_by=("event_date",))
    tables.register_sources(spark, base, {"positions_silver": schemas.POSITIONS_SILVER})
    return spark.sql("SELECT zone_type, COUNT(*) AS n, COUNT(DISTINCT mmsi) AS vessels FROM positions_silver GROUP BY zone_type")


@query
def staged_positions(spark, sf):
    rounded = {c: _r(c) for c in ("lat", "lon", "sog")}
    return models.staged_positions(M.silver(spark, sf)).withColumns(rounded)


# --- zones ---------------------------------------------------------------------------


@query
def zone_matches(spark, sf):
    matched = spatial.match_zones(quality.valid_rows(M.tagged(spark, sf)), M.index(spark))
    return matched.select("mmsi", "event_time", "offset", "zone_id", "zone_type")


@query
def best_zone(spark, sf):
    located = spatial.best_zone(quality.valid_rows(M.tagged(spark, sf)), M.index(spark))
    return located.select("mmsi", "event_time", "offset", "zone_id", "zone_type", "zone_name")


@query
def best_zone_large(spark, sf):
    """The same lookup with the zone side joined by shuffle, on rows whose ids repeat or are null."""
    rows = quality.valid_rows(M.tagged(spark, sf)).withColumn("offset", F.when(F.col("offset") % 3 != 0, F.col("offset") % 10))
    located = spatial.best_zone(rows, spatial.zone_index(M.zones(spark), max_broadcast_edges=0))
    return located.select("mmsi", "event_time", "offset", "zone_id", "zone_type", "zone_name")


@query
def zone_occupancy(spark, sf):
    return models.zone_occupancy(M.silver(spark, sf))


@query
def match_summary(spark, sf):
    return models.match_summary(M.silver(spark, sf))


@query
def vessel_zones(spark, sf):
    return models.vessel_zones(M.silver(spark, sf))


@query
def zones_lookup(spark, sf):
    return models.zones_lookup(M.silver(spark, sf))


@query
def zone_priority(spark, sf):
    matched = spatial.match_zones(quality.valid_rows(M.tagged(spark, sf)), M.index(spark))
    return matched.groupBy("zone_id", "zone_type", F.col("_priority").alias("priority"), _r("_area", 9).alias("area")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def zone_overlaps(spark, sf):
    """Overlaps among customer zones with holes and parts; pairs three numbers apart are allowed to."""
    zones = M.customer_zones(spark, sf)
    neighbours = M.table(spark, sf, "customer").select(
        F.concat(F.lit("zone-"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("zone_a"),
        F.concat(F.lit("zone-"), F.lpad((F.col("c_custkey") + 3).cast("string"), 9, "0")).alias("zone_b"),
    )
    found = spatial.zone_overlaps(zones, neighbours, min_area=1e-12)
    return found.select("zone_a", "type_a", "zone_b", "type_b", _r("overlap_area", 8).alias("overlap_area"), "severity")


@query
def customer_zone_matches(spark, sf):
    """Suppliers as points against thousands of customer zones, some in their holes and second parts."""
    key = F.col("s_suppkey")
    points = M.table(spark, sf, "supplier").select(
        key.alias("s_suppkey"),
        ((F.floor(key / 4) % 300) - 150 + F.lit(0.02) * ((key * 7) % 40) + F.lit(0.00517)).alias("lon"),
        (F.floor(key / 1200) - 60 + F.lit(0.01) * ((key * 29) % 40) + F.lit(0.00713)).alias("lat"),
    )
    located = spatial.match_zones(points, spatial.zone_index(M.customer_zones(spark, sf)))
    return located.select("s_suppkey", "zone_id", "zone_type")


@query
def geojson_zones(spark, sf):
    """Customer zones written as GeoJSON features and scanned again."""
    path = new_path(spark, "zones")
    zone_sources.write_zones(M.customer_zones(spark, sf), path)
    return zone_sources.read_zones(spark, path, lines=True).select(
        "zone_id", "zone_type", "authority", "source_ref", "name",
        F.size("shape").alias("polygons"), F.size(F.flatten("shape")).alias("rings"),
        F.size(F.flatten(F.flatten("shape"))).alias("points"), _r(G.shape_area(F.col("shape")), 8).alias("area"),
    )


@query
def merged_zones(spark, sf):
    """Three zone sources under one schema, counted by type and authority."""
    suppliers = M.table(spark, sf, "supplier").select(
        F.concat(F.lit("circle-"), F.col("s_suppkey").cast("string")).alias("zone_id"),
        F.lit("anchorage").alias("zone_type"), F.lit("CFR").alias("authority"),
        F.lit("supplier").alias("source_ref"), F.col("s_name").alias("name"),
    )
    parts = M.table(spark, sf, "part").select(
        F.concat(F.lit("berth-"), F.col("p_partkey").cast("string")).alias("zone_id"),
        F.lit("berth").alias("zone_type"), F.lit("OSM").alias("authority"), F.lit("part").alias("source_ref"),
    )
    merged = zone_sources.merge_zones([M.customer_zones(spark, sf), suppliers, parts])
    return merged.groupBy("zone_type", "authority").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("name").isNull()).alias("unnamed")
    )


@query
def zone_faults(spark, sf):
    """Why zones are not valid: one in four has a spike, touches itself, or cuts itself."""
    return validity.zone_faults(M.knotted_zones(spark, sf))


@query
def valid_zone_overlaps(spark, sf):
    """Overlaps among the zones without fault."""
    found = spatial.zone_overlaps(M.knotted_zones(spark, sf), None, min_area=1e-12)
    return found.select("zone_a", "zone_b", _r("overlap_area", 8).alias("overlap_area"), "severity")


@query
def zone_checks(spark, sf):
    zones = M.knotted_zones(spark, sf)
    odd = zones.withColumn(
        "zone_type", F.when(F.col("zone_type") == "harbor", F.concat(F.lit("pier"), F.length("name"))).otherwise(F.col("zone_type"))
    ).withColumn("source_ref", F.when(F.col("zone_id").endswith("5"), "").otherwise(F.col("source_ref")))
    return checks.zone_checks(odd, "zones")


# --- zone building ---------------------------------------------------------------------


@query
def waypoint_rings(spark, sf):
    """One polygon per order from its line items' waypoints."""
    points = M.order_waypoints(spark, sf)
    rings = points.groupBy("l_orderkey").agg(
        G.ring_from_waypoints(F.col("seq"), F.col("x"), F.col("y")).alias("ring")
    )
    return rings.select("l_orderkey", F.size("ring").alias("points"), _r(G.ring_area(F.col("ring")), 9).alias("area"))


@query
def circle_zones(spark, sf):
    """A circle per supplier with its balance as radius: vertex count, box and area."""
    key = F.col("s_suppkey")
    zones = M.table(spark, sf, "supplier").select(
        "s_suppkey", F.lit(33.5).alias("lat"), (F.lit(-118.0) + key / 1000).alias("lon"),
        (F.abs(F.col("s_acctbal")) * K.YARD_IN_METRES).alias("radius"),
    ).withColumn("ring", G.circle_ring(F.col("lon"), F.col("lat"), F.col("radius")))
    box = G.bbox(F.col("ring"))
    return zones.select(
        "s_suppkey", F.size("ring").alias("points"), _r(G.ring_area(F.col("ring")), 8).alias("area"),
        _r(box["x_max"] - box["x_min"], 7).alias("width"), _r(box["y_max"] - box["y_min"], 7).alias("height"),
    )


@query
def line_buffers(spark, sf):
    """A 20 m wide rectangle around a line per order; its area is length times width."""
    key = F.col("o_orderkey")
    lines = M.table(spark, sf, "orders").select(
        "o_orderkey", F.lit(-118.2).alias("x1"), F.lit(33.7).alias("y1"),
        (F.lit(-118.2) + (key % 17) / 1000).alias("x2"), (F.lit(33.7) + F.lit(0.0)).alias("y2"),
    )
    ring = G.segment_buffer(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    box = G.bbox(F.col("ring"))
    return lines.withColumn("ring", ring).select(
        "o_orderkey", F.col("ring").isNotNull().alias("has_area"),
        _r(box["x_max"] - box["x_min"], 7).alias("width"), _r(box["y_max"] - box["y_min"], 7).alias("height"),
        _r(G.ring_area(F.col("ring")), 9).alias("area"),
    )


@query
def bent_line_buffers(spark, sf):
    """A zone around a line with one bend per order: segments, less what they share, and the round outside of the bend."""
    key = F.col("o_orderkey")
    x, y = F.lit(-118.2), F.lit(33.7)
    bend = x + F.lit(0.002) + (key % 17) / 10000
    lines = M.table(spark, sf, "orders").select("o_orderkey", F.array(
        G.point(x, y), G.point(bend, y), G.point(bend + F.lit(0.0013) - (key % 29) / 10000, y + F.lit(0.001) + (key % 13) / 10000)
    ).alias("points"))
    zones = line_buffers_of(lines, "o_orderkey", "points")
    return zones.select(
        "o_orderkey", F.size("ring").alias("points"), G.is_area(F.col("ring")).alias("usable"), _r(G.ring_area(F.col("ring")), 10).alias("area")
    )


def _order_ways(spark, sf):
    """A way per order through its line items; ways of even orders return to their start."""
    points = M.order_waypoints(spark, sf)
    ways = points.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct("seq", "x", "y"))).alias("w")
    )
    open_way = F.transform("w", lambda p: G.point(p["x"], p["y"]))
    closed = F.concat(open_way, F.slice(open_way, 1, 1))
    numbers = F.transform("w", lambda p: p["seq"])
    return ways.select(
        "l_orderkey", F.when(F.col("l_orderkey") % 2 == 0, closed).otherwise(open_way).alias("ring"),
        (F.size(F.array_distinct(numbers)) == F.size("w")).alias("distinct"),
    )


@query
def closed_ways(spark, sf):
    return _order_ways(spark, sf).select("l_orderkey", G.is_area(F.col("ring")).alias("is_area"))


def _cut_ways(ways):
    """Closed ways of distinct directions as two to four open pieces, every second one turned round; other ways as they are.

    All ways are drawn around one centre, so the cut ones go to places of their own: ends meet only where a way was cut. With a
    direction twice, neighbouring edges lie on each other, and rounding decides whether they count as crossing.
    """
    k, edges = F.col("member_no"), F.size("ring") - 1
    pieces = F.least(F.lit(2) + k % 3, edges)
    apart = F.transform("ring", lambda p: G.point(p["x"] + k % 1000, p["y"] + F.floor(k / 1000) % 1000))

    # Piece i runs over the points from i/pieces to (i+1)/pieces of the edges.
    def piece(i):
        lo, hi = F.floor(edges * i / pieces), F.floor(edges * (i + 1) / pieces)
        part = F.slice(apart, (lo + 1).cast("int"), (hi - lo + 1).cast("int"))
        return F.struct(i.alias("i"), F.when((k + i) % 2 == 0, part).otherwise(F.reverse(part)).alias("ring"))

    cut = F.transform(F.sequence(F.lit(0).cast("long"), pieces - 1), piece)
    closed = (edges >= 2) & (F.get("ring", F.lit(0)) == F.try_element_at("ring", F.lit(-1)))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("i"), F.col("ring").alias("ring")))
    each = F.explode(F.when(closed & F.col("distinct"), cut).otherwise(whole)).alias("p")
    return ways.select("element_id", "role", "member_no", each).select("element_id", "role", (k * 4 + F.col("p.i")).alias("member_no"), "p.ring")


@query
def largest_outer_rings(spark, sf):
    """A relation per customer whose members are pieces of its orders' ways; finished orders are outer."""
    orders = M.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("member_no"), F.col("o_custkey").alias("element_id"),
        F.when(F.col("o_orderstatus") == "F", "outer").otherwise("inner").alias("role"),
    )
    ways = _order_ways(spark, sf).withColumnRenamed("l_orderkey", "member_no")
    rings = zone_sources.largest_outer_rings(_cut_ways(orders.join(ways, "member_no")))
    return rings.select("element_id", _r(G.ring_area(F.col("ring")), 9).alias("area"))


@query
def dms_decimal(spark, sf):
    """Coordinates written as degree-minute-second text in three notations and read back."""
    k = F.col("k")
    minutes, seconds, west = k % 60, (F.col("event_id") % 600) / 10, F.col("event_id") % 2 == 0
    notation = (
        F.when(k % 3 == 0, F.format_string("%d°-%02d′-%04.1f″ %s", k % 120, minutes, seconds, F.when(west, "W").otherwise("E")))
        .when(k % 3 == 1, F.format_string("%d %d %.1f%s", k % 120, minutes, seconds, F.when(west, "s").otherwise("n")))
        .otherwise(F.format_string("%d-%02d %04.1f", k % 120, minutes, seconds))
    )
    return M.events(spark, sf).select("event_id", _r(S.dms_to_degrees(notation), 6).alias("degrees"))


def _part_names(spark, sf):
    """Parts as mapped areas: a name, sometimes an operator, sometimes a brand."""
    key = F.col("p_partkey")
    brands = ["Pier 400", "TraPac", "Long Beach Container Terminal", "Everport", "ITS Terminal", "APL",
              "Yusen", "PCT", "Terminal Island", "Port of Los Angeles"]
    label = F.get(F.array(*[F.lit(b) for b in brands]), (key % 10).cast("int"))
    return M.table(spark, sf, "part").select(
        "p_partkey",
        F.when(key % 3 == 0, label).when(key % 3 == 1, F.col("p_name")).alias("name"),
        F.when(key % 4 == 1, label).alias("operator"),
        F.when(key % 5 == 2, label).otherwise(F.col("p_brand")).alias("brand"),
    )


@query
def operator_tags(spark, sf):
    areas = _part_names(spark, sf)
    kept = areas.filter(S.not_excluded(F.col("name")))
    tag = S.operator_tag([F.col("name"), F.col("operator"), F.col("brand")])
    return kept.select("p_partkey", "name", tag.alias("operator"))


def _part_areas(spark, sf):
    """Parts as mapped areas with a square; that of every fourth part is left open."""
    x, y = (F.col("p_partkey") % 300).cast("double"), F.floor(F.col("p_partkey") / 300).cast("double")
    corners = F.array(G.point(x, y), G.point(x + 0.5, y), G.point(x + 0.5, y + 0.5), G.point(x, y + 0.5))
    ring = F.when(F.col("p_partkey") % 4 == 3, corners).otherwise(F.concat(corners, F.array(G.point(x, y))))
    return _part_names(spark, sf).select(F.lit("way").alias("element_type"), F.col("p_partkey").alias("element_id"), "name", "operator", "brand", ring.alias("ring"))


@query
def mapped_berths(spark, sf):
    berths = zone_sources.berths_from_areas(_part_areas(spark, sf))
    return berths.select("zone_id", "zone_type", "authority", "source_ref", "name", "operator", "osm_operator_tag")


@query
def skipped_areas(spark, sf):
    return zone_sources.skipped_areas(_part_areas(spark, sf))


@query
def attribution_report(spark, sf):
    tag = S.operator_tag([F.col("name"), F.col("operator"), F.col("brand")])
    tagged = _part_names(spark, sf).withColumn("operator", tag)
    return zone_sources.attribution_report(tagged)


@query
def missing_operators(spark, sf):
    """Operators no part is attributed to."""
    tag = S.operator_tag([F.col("name"), F.col("operator")])
    tagged = _part_names(spark, sf).withColumn("operator", tag)
    targets = spark.createDataFrame([(code,) for code in K.OPERATOR_ALIASES], "operator string")
    return zone_sources.missing_operators(tagged, targets)


@query
def named_lines(spark, sf):
    """Unnamed parts get a numbered name in key order, and every row an id made from its name."""
    lines = _part_names(spark, sf).select("p_partkey", "name")
    named = zone_sources.name_unnamed(lines, ["p_partkey"])
    return named.select("p_partkey", "name", S.slug("noaa-breakwater-", F.col("name")).alias("zone_id"))


# --- state, sessions and the tables on top ------------------------------------------------


@query
def raw_state(spark, sf):
    state = S.raw_state(F.col("zone_type"), F.col("sog"))
    return M.silver(spark, sf).groupBy(state.alias("raw_state")).agg(F.count(F.lit(1)).alias("n"))


@query
def reported_bucket(spark, sf):
    bucket = S.reported_bucket(F.col("nav_status_code"))
    return M.silver(spark, sf).groupBy("nav_status_code", bucket.alias("reported")).agg(F.count(F.lit(1)).alias("n"))


@query
def vessel_states(spark, sf):
    return vessel_timeline(
        M.silver(spark, sf), debounce=M.DEBOUNCE, expiry=M.EXPIRY, count_from=M.vessel_keys(spark, sf)
    ).select("mmsi", "event_time", "offset", "raw", "state", "reported")


@query
def state_transitions(spark, sf):
    return M.changes(spark, sf).filter(F.col("event_type") == K.STATE_TRANSITION).select(
        "mmsi", "from_state", "to_state", "zone_id", "transition_time"
    )


@query
def discrepancy_events(spark, sf):
    return M.changes(spark, sf).filter(F.col("event_type") != K.STATE_TRANSITION).select(
        "mmsi", "event_type", "derived_state", "reported_status", "transition_time"
    )


@query
def state_changes(spark, sf):
    """All events with a final watermark, so that vessels silent at the end expire too."""
    return M.changes(spark, sf, watermark=F.lit("2024-02-02 12:00:00").cast("timestamp"))


@query
def vessel_sessions(spark, sf):
    return M.sessions(spark, sf)


@query
def berth_visits(spark, sf):
    return models.berth_visits(M.sessions(spark, sf))


@query
def anchorage_dwell(spark, sf):
    return M.dwell(spark, sf)


@query
def activity_daily(spark, sf):
    return models.daily_activity(M.sessions(spark, sf))


@query
def activity_daily_split(spark, sf):
    return models.daily_activity(M.sessions(spark, sf), split_at_midnight=True)


@query
def discrepancy_episodes(spark, sf):
    return models.discrepancy_episodes(M.changes(spark, sf), M.as_of())


@query
def discrepancy_episodes_bounded(spark, sf):
    return models.discrepancy_episodes(M.changes(spark, sf), M.as_of(), bound_by_next_flag=True)


@query
def dim_vessels(spark, sf):
    return M.dim_vessels(spark, sf)


@query
def at_anchor_snapshot(spark, sf):
    return models.at_anchor_now(M.dwell(spark, sf), M.dim_vessels(spark, sf), M.as_of())


@query
def presented_snapshot(spark, sf):
    return models.presented(models.at_anchor_now(M.dwell(spark, sf), M.dim_vessels(spark, sf), M.as_of()))


@query
def staged_state_changes(spark, sf):
    return models.staged_state_changes(M.changes(spark, sf))


@query
def ships_at_anchor(spark, sf):
    snapshot = models.at_anchor_now(M.dwell(spark, sf), M.dim_vessels(spark, sf), M.as_of())
    return models.ships_at_anchor(snapshot)


@query
def snapshot_export(spark, sf):
    """The snapshot written to files, and its document read back line by line."""
    path = new_path(spark, "snapshot")
    snapshot = models.at_anchor_now(M.dwell(spark, sf), M.dim_vessels(spark, sf), M.as_of())
    tables.export_snapshot(snapshot, path, M.as_of())
    ship = F.from_json("value", snapshot.schema, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    return tables.read_snapshot_lines(spark, path).select(ship.alias("s")).select("s.*")


# --- as-of join and agreement -----------------------------------------------------------


@query
def asof_state(spark, sf):
    silver = store(M.silver(spark, sf), "silver")
    positions = silver.select("mmsi", "event_time", "partition", "offset", "nav_status_code")
    return state_as_of(positions, M.changes(spark, sf, silver)).select("mmsi", "event_time", "offset", "derived_state")


@query
def top_vessels(spark, sf):
    return dedup.top_keys(M.silver(spark, sf), "mmsi", 5)


@query
def trailing_window(spark, sf):
    recent = agree.trailing_window(store(M.silver(spark, sf), "silver"), 240)
    return recent.agg(
        F.count(F.lit(1)).alias("n"), F.min("event_time").alias("first"), F.max("event_time").alias("last")
    )


def _report(spark, sf):
    # Three results are taken from the same two tables: write them once.
    silver = store(M.silver(spark, sf), "silver")
    changes = store(M.changes(spark, sf, silver), "changes")
    return agree.agreement_report(silver, changes, hours=240, n_vessels=5)


@query
def agreement(spark, sf):
    report = _report(spark, sf)["agreement"]
    return report.withColumn("agreement_rate", _r("agreement_rate"))


@query
def agreement_all_vessels(spark, sf):
    silver = store(M.silver(spark, sf), "silver")
    everyone = silver.select("mmsi").distinct()
    report = agree.agreement_report(silver, M.changes(spark, sf, silver), hours=720, vessels=everyone)["agreement"]
    return report.withColumn("agreement_rate", _r("agreement_rate"))


@query
def uncovered_vessels(spark, sf):
    """Vessels with positions in the last two days none of which can be compared."""
    silver = store(M.silver(spark, sf), "silver")
    window = agree.trailing_window(silver, 48)
    everyone = window.select("mmsi").distinct()
    comparable = agree.comparable_positions(window, M.changes(spark, sf, silver), everyone)
    return checks.missing_keys(everyone, comparable, "mmsi")


# --- table tests --------------------------------------------------------------------------


@query
def dq_unique(spark, sf):
    return checks.run_checks([
        checks.unique(M.dwell(spark, sf), "anchorage_dwell", "anchorage_dwell_id"),
        checks.unique(M.table(spark, sf, "lineitem"), "lineitem", "l_orderkey"),
        checks.unique(M.table(spark, sf, "orders"), "orders", "o_orderkey"),
    ])


@query
def dq_not_null(spark, sf):
    return checks.run_checks([
        checks.not_null(M.silver(spark, sf), "positions_silver", ["mmsi", "event_time", "zone_id"]),
        checks.not_null(M.sessions(spark, sf), "vessel_sessions", ["session_id", "mmsi", "session_end"], "warn"),
    ])


@query
def dq_accepted(spark, sf):
    return checks.run_checks([
        checks.accepted_values(M.sessions(spark, sf), "vessel_sessions", "state", K.VESSEL_STATES),
        checks.accepted_values(M.changes(spark, sf), "vessel_state_changes", "to_state", K.VESSEL_STATES),
        checks.accepted_values(M.table(spark, sf, "orders"), "orders", "o_orderpriority", ["1-URGENT", "2-HIGH"], "warn"),
    ])


@query
def dq_relationships(spark, sf):
    return checks.run_checks([
        checks.relationships(M.dwell(spark, sf), "anchorage_dwell", "mmsi", M.dim_vessels(spark, sf), "mmsi", "warn"),
        checks.relationships(
            M.table(spark, sf, "orders"), "orders", "o_custkey", M.table(spark, sf, "customer"), "c_custkey"
        ),
        checks.relationships(
            M.table(spark, sf, "events"), "events", "user_id", M.table(spark, sf, "supplier"), "s_suppkey"
        ),
    ])


@query
def dq_freshness(spark, sf):
    at = F.lit("2024-01-31 01:00:00").cast("timestamp")
    tables_by_name = {
        "positions_silver": M.silver(spark, sf), "vessel_state_changes": M.changes(spark, sf),
        "ship_static": M.ship_static(spark, sf),
    }
    return checks.run_checks([
        checks.freshness(tables_by_name[name], name, column, warn, error, at)
        for name, (column, warn, error) in K.FRESHNESS.items()
    ])


# --- messages --------------------------------------------------------------------------------


def _routed(spark, sf):
    # The receipt time of a message is its event time here, so results repeat.
    feed = M.feed_messages(spark, sf)
    return messages.route(feed, received_at=F.col("ts"))


@query
def routed_messages(spark, sf):
    return _routed(spark, sf).groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("key").isNull()).alias("without_key"),
        F.count_distinct("key").alias("keys"),
    )


@query
def dead_letters(spark, sf):
    """Unreadable messages: the raw text survives as it came."""
    letters = _routed(spark, sf).filter((F.col("topic") == K.DEAD_LETTER_TOPIC) & F.get_json_object("value", "$.raw").isNotNull())
    return letters.groupBy(F.get_json_object("value", "$.error").alias("error")).agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.length(F.get_json_object("value", "$.raw")) > 0).cast("long")).alias("with_text")
    )


@query
def source_filter(spark, sf):
    feed = M.feed_messages(spark, sf)
    kept = messages.in_feed_area(
        feed, F.col("lat"), F.col("lon"), F.col("message_type"), lat_range=(33.57, 33.70), lon_range=(-118.25, -118.10)
    )
    return kept.groupBy("message_type").agg(F.count(F.lit(1)).alias("n"))


def _topic(spark, sf, topic):
    feed = M.feed_messages(spark, sf)
    routed = messages.route(feed, received_at=F.col("ts"), keep=("event_id", "ts"))
    # Every 25th record predates the current format.
    rows = M.topic_rows(routed)
    old = F.when(F.col("offset") % 25 == 0, F.lit("plain text").cast("binary")).otherwise(F.col("value"))
    path = new_path(spark, "topics")
    rows.withColumn("value", old).write.parquet(path)
    return messages.scan_topic(spark, topic, path=path)


@query
def decode_audit(spark, sf):
    decoded = messages.decode(_topic(spark, sf, "ais.raw.positions"), schemas.POSITION_ENVELOPE)
    return messages.decode_audit(decoded)


@query
def decoded_sample(spark, sf):
    """The first decoded records by offset, as the audit shows them."""
    decoded = messages.decode(_topic(spark, sf, "ais.raw.positions"), schemas.POSITION_ENVELOPE)
    return messages.decode_sample(decoded, 10).select(
        "key", "ship_name", _r("latitude").alias("latitude"), _r("longitude").alias("longitude"), _r("sog").alias("sog")
    )


@query
def decoded_positions(spark, sf):
    decoded = messages.decode(_topic(spark, sf, "ais.raw.positions"), schemas.POSITION_ENVELOPE)
    flat = messages.flatten_positions(decoded)
    return flat.withColumns({"lat": _r("lat"), "lon": _r("lon"), "sog": _r("sog")})


@query
def decoded_static(spark, sf):
    decoded = messages.decode(_topic(spark, sf, "ais.raw.static"), schemas.STATIC_ENVELOPE)
    flat = messages.flatten_static(decoded)
    return flat.withColumn("max_static_draught", _r("max_static_draught"))


# --- scans ------------------------------------------------------------------------------------


@query
def newest_positions(spark, sf):
    """Table inspection: the ten newest rows."""
    return dedup.top_rows(M.clean(spark, sf), [F.col("event_time").desc(), F.col("offset")], 10).select(
        "mmsi", "event_time", "offset"
    )


@query
def numbered_orders(spark, sf):
    return number_rows(M.table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], "n")


@query
def minute_differences(spark, sf):
    at = F.lit("2024-01-15 12:00:30").cast("timestamp")
    return M.events(spark, sf).select(
        "event_id", S.boundary_diff("minute", F.col("ts"), at).alias("minutes"),
        S.boundary_diff("second", F.col("ts"), at).alias("seconds"),
    )


@query
def surrogate_keys(spark, sf):
    return M.events(spark, sf).select("event_id", S.surrogate_key(F.col("mmsi"), F.col("ts")).alias("key"))
