"""Zone files and zone building."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborflow import constants as K
from harborflow import schemas
from harborflow.functions import geometry as G
from harborflow.functions.scalars import dms_to_degrees, not_excluded, operator_tag, slug
from harborflow.operators.buffers import line_buffers
from harborflow.operators.ordered import number_rows
from harborflow.operators.rings import stitched_rings
from harborflow.session import spread, store


def _zone_columns(feature: str) -> list:
    properties = [F.col(f"{feature}.properties.{c}").alias(c) for c in schemas.ZONES.names[:-1]]
    kind, text = F.col(f"{feature}.geometry.type"), F.col(f"{feature}.geometry.coordinates")
    polygons = F.when(kind == "MultiPolygon", F.from_json(text, schemas.GEOJSON_MULTI_POLYGON)).when(
        kind == "Polygon", F.array(F.from_json(text, schemas.GEOJSON_POLYGON))
    )
    return [*properties, _nested(polygons, lambda p: G.point(F.get(p, F.lit(0)), F.get(p, F.lit(1)))).alias("shape")]


def _nested(shape, point) -> Column:
    """Every point of a shape turned by `point`."""
    return F.transform(shape, lambda rings: F.transform(rings, lambda ring: F.transform(ring, point)))


def read_zones(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    """Zones of a GeoJSON FeatureCollection, or, with `lines`, of one feature per text line.

    A collection is one JSON document and is parsed by one task; large zone sets use lines.
    """
    if lines:
        return spark.read.schema(schemas.GEOJSON_FEATURE).json(path).select(F.struct("*").alias("f")).select(
            *_zone_columns("f")
        )
    collection = spark.read.schema(schemas.GEOJSON_COLLECTION).option("multiLine", True).json(path)
    return collection.select(F.explode("features").alias("f")).select(*_zone_columns("f"))


def write_zones(zones: DataFrame, path: str) -> None:
    """One GeoJSON feature per line; a shape of one polygon is a Polygon, any other a MultiPolygon."""
    polygons = _nested(F.col("shape"), lambda p: F.array(p["x"], p["y"]))

    def feature(kind: str, coordinates: Column) -> Column:
        return F.to_json(F.struct(
            F.lit("Feature").alias("type"),
            F.struct(*schemas.ZONES.names[:-1]).alias("properties"),
            F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")).alias("geometry"),
        ))

    single = feature("Polygon", F.get(polygons, F.lit(0)))
    text = F.when(F.size("shape") == 1, single).otherwise(feature("MultiPolygon", polygons))
    zones.select(text.alias("value")).write.mode("overwrite").text(path)


def merge_zones(parts: Sequence[DataFrame]) -> DataFrame:
    """All zone sources under one schema; run `checks.zone_checks` on the result."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return merged.select(*schemas.ZONES.names)


def zones_by_type(zones: DataFrame) -> DataFrame:
    return zones.groupBy("zone_type").agg(F.count(F.lit(1)).alias("n"))


# --- building zones from source tables ---------------------------------------


def anchorages_from_waypoints(waypoints: DataFrame) -> DataFrame:
    """(zone_id, name, source_ref, seq, lat_text, lon_text) -> one polygon per zone.

    A zone's waypoints are a handful of surveyed corners, collected into its one ring.
    """
    located = waypoints.withColumns({
        "_x": dms_to_degrees(F.col("lon_text")), "_y": dms_to_degrees(F.col("lat_text")),
    })
    ring = G.ring_from_waypoints(F.col("seq"), F.col("_x"), F.col("_y"))
    zones = located.groupBy("zone_id", "name", "source_ref").agg(ring.alias("ring"))
    return _as_zones(zones, "anchorage", "CFR")


def circular_anchorages(circles: DataFrame) -> DataFrame:
    """(zone_id, name, source_ref, lat_text, lon_text, radius, unit) -> circles; unit is 'm' or 'yd'."""
    metres = F.when(F.col("unit") == "yd", F.col("radius") * K.YARD_IN_METRES).otherwise(F.col("radius"))
    ring = G.circle_ring(dms_to_degrees(F.col("lon_text")), dms_to_degrees(F.col("lat_text")), metres)
    return _as_zones(circles.withColumn("ring", ring), "anchorage", "CFR")


def _dealt(areas: DataFrame) -> DataFrame:
    """Areas dealt over all tasks and stored: a filter on their rings would move to the few tasks that read them, and draw each ring anew."""
    return store(spread(areas), "areas")


def berths_from_areas(areas: DataFrame) -> DataFrame:
    """Mapped areas (element_type, element_id, name, operator, brand, ring) -> berth zones.

    Excluded names and anything that is not a closed area are left out. The extra columns hold the
    recognised operator and the operator tag as mapped.
    """
    usable = _dealt(areas).filter(not_excluded(F.col("name")) & G.is_area(F.col("ring")))
    element = F.concat_ws("/", "element_type", F.col("element_id").cast("string"))
    return usable.select(
        F.concat(F.lit("osm-"), F.replace(element, F.lit("/"), F.lit("-"))).alias("zone_id"),
        F.lit("berth").alias("zone_type"), F.lit("OSM").alias("authority"),
        F.concat(F.lit("https://www.openstreetmap.org/"), element).alias("source_ref"),
        "name", G.shape_of(F.col("ring")).alias("shape"),
        operator_tag([F.col("name"), F.col("operator"), F.col("brand")]).alias("operator"),
        F.col("operator").alias("osm_operator_tag"),
    )


def skipped_areas(areas: DataFrame) -> DataFrame:
    """How many mapped areas `berths_from_areas` leaves out, by reason."""
    reason = F.when(~not_excluded(F.col("name")), "excluded name").when(~G.is_area(F.col("ring")), "not a closed area")
    return _dealt(areas).select(reason.alias("reason")).filter(F.col("reason").isNotNull()).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def largest_outer_rings(members: DataFrame) -> DataFrame:
    """(element_id, role, member_no, ring) -> the largest closed outer ring of each relation.

    Outer members that are open ways are stitched where their ends meet, in any order and direction. A partial aggregate keeps
    one ring per relation and task.
    """
    # Stored, since closed and open ways are read from it one after the other.
    outer = store(members.filter(F.col("role") == "outer").select("element_id", "member_no", "ring"), "members")
    closed = F.get("ring", F.lit(0)) == F.try_element_at("ring", F.lit(-1))
    pieces = outer.filter(~closed).select("element_id", F.col("member_no").alias("way"), F.col("ring").alias("points"))
    rings = outer.select("element_id", "ring").unionByName(stitched_rings(pieces, "element_id"))
    # The points settle which of equally large rings is taken.
    ranked = rings.filter(G.is_area(F.col("ring"))).select("element_id", F.struct(G.ring_area(F.col("ring")).alias("area"), "ring").alias("_r"))
    return ranked.groupBy("element_id").agg(F.max("_r").alias("_r")).select("element_id", "_r.ring")


def name_unnamed(lines: DataFrame, order: Sequence[str], default: str = "Unnamed Breakwater") -> DataFrame:
    """Give rows without a name a numbered one, counting them in the given order."""
    blank = F.nullif(F.col("name"), F.lit("")).isNull()
    numbered = number_rows(lines.filter(blank), order, "_n")
    named = numbered.withColumn("name", F.concat(F.lit(default + " "), F.col("_n").cast("string")))
    return lines.filter(~blank).unionByName(named.drop("_n"))


def breakwaters_from_lines(lines: DataFrame, source_ref: str) -> DataFrame:
    """Named centre lines (name, points) -> one flat-capped harbor zone a line, its bends filled; names are unique.

    Lines without two different points are left out.
    """
    rings = line_buffers(lines, "name", "points")
    zones = rings.withColumns({"zone_id": slug("noaa-breakwater-", F.col("name")), "source_ref": F.lit(source_ref)})
    return _as_zones(zones, "harbor", "NOAA")


def breakwaters_from_segments(segments: DataFrame, source_ref: str) -> DataFrame:
    """Named centre-line segments (name, segment_no, x1, y1, x2, y2) -> flat-capped harbor zones.

    One zone per segment; the first keeps the line's id, later ones get their number appended.
    """
    ring = G.segment_buffer(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    base = slug("noaa-breakwater-", F.col("name"))
    suffix = F.when(F.col("segment_no") > 1, F.concat(F.lit("-"), F.col("segment_no").cast("string")))
    zones = segments.select(
        F.concat(base, F.coalesce(suffix, F.lit(""))).alias("zone_id"), "name",
        F.lit(source_ref).alias("source_ref"), ring.alias("ring"),
    )
    return _as_zones(zones.filter(F.col("ring").isNotNull()), "harbor", "NOAA")


def _as_zones(df: DataFrame, zone_type: str, authority: str) -> DataFrame:
    typed = df.withColumns({"zone_type": F.lit(zone_type), "authority": F.lit(authority), "shape": G.shape_of(F.col("ring"))})
    return typed.select(*schemas.ZONES.names)


# --- reports ------------------------------------------------------------------


def attribution_report(berths: DataFrame) -> DataFrame:
    return berths.agg(
        F.count(F.lit(1)).alias("zones"), F.count_if(F.col("operator").isNull()).alias("unattributed")
    )


def missing_operators(berths: DataFrame, targets: DataFrame) -> DataFrame:
    """Target operators (column `operator`) no berth was attributed to."""
    return targets.join(berths.select("operator").distinct(), "operator", "left_anti")
