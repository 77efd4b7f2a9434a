import json
import math
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from harborflow import schemas
from harborflow.functions import geometry as G
from harborflow.operators import spatial
from harborflow.operators.checks import zone_checks
from harborflow.operators.validity import zone_faults
from harborflow.operators.rings import stitched_rings
from harborflow.sources import zones as Z


def pts(*xy):
    return [(float(x), float(y)) for x, y in xy]


SQUARE = pts((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))


def zone(zone_id, ring, kind="anchorage", authority="CFR", name=None):
    return (zone_id, kind, authority, "ref", name or zone_id, [[ring]])


def zones_df(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.ZONES)


def rings(spark, *items):
    return spark.createDataFrame([(i, r) for i, r in enumerate(items)], "id int, ring array<struct<x double, y double>>")


def inside(ring, x, y):
    """Winding by angle sum: another rule than the one under test."""
    total = 0.0
    for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:], strict=True):
        a = math.atan2(y2 - y, x2 - x) - math.atan2(y1 - y, x1 - x)
        total += (a + math.pi) % (2 * math.pi) - math.pi
    return abs(total) > math.pi


def blob(rng, cx, cy, r, n):
    angles = np.sort(rng.uniform(0, 2 * math.pi, n))
    p = [(cx + r * rng.uniform(0.3, 1) * math.cos(a), cy + r * rng.uniform(0.3, 1) * math.sin(a)) for a in angles]
    return pts(*p, p[0])


@pytest.fixture(scope="module")
def world(spark):
    rng = np.random.default_rng(3)
    kinds = ["berth", "anchorage", "harbor", "channel"]
    zones = [
        zone(f"z{i:02d}", blob(rng, *rng.uniform(-1, 1, 2), rng.uniform(0.1, 0.6), 9), kinds[i % 4]) for i in range(25)
    ]
    points = [(0, i, f"v{i}", float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-1.5, 1.5, (400, 2)))]
    points += [(0, 400, "none", None, None)]
    df = spark.createDataFrame(points, "partition int, offset long, mmsi string, lon double, lat double")
    return zones, points, df, zones_df(spark, *zones)


def shoelace(ring):
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring[:-1], ring[1:], strict=True))) / 2


@pytest.mark.parametrize("limit", [10**9, 0])
def test_matches_against_brute_force(world, limit):
    zones, points, df, zdf = world
    index = spatial.zone_index(zdf, max_broadcast_edges=limit)
    assert index.small == (limit > 0)
    got = {(r["offset"], r["zone_id"]) for r in spatial.match_zones(df, index).collect()}
    want = set()
    for _, i, _, x, y in points:
        hits = {z[0] for z in zones if x is not None and inside(z[5][0][0], x, y)}
        want |= {(i, h) for h in hits} or {(i, None)}
    assert got == want

    order = {"berth": 0, "anchorage": 1, "harbor": 2, "channel": 3}
    best = {r["offset"]: r["zone_id"] for r in spatial.best_zone(df, index).collect()}
    for _, i, _, x, y in points:
        hits = [(order[z[1]], shoelace(z[5][0][0]), z[0]) for z in zones if x is not None and inside(z[5][0][0], x, y)]
        assert best[i] == (min(hits)[2] if hits else None)
    assert len(best) == len(points)


def test_small_zone_side_needs_no_shuffle_of_positions(world):
    _, _, df, zdf = world
    plan = spatial.best_zone(df, spatial.zone_index(zdf))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_points_on_edges_are_outside(spark):
    """The boundary belongs to no zone; of two squares sharing an edge neither owns it."""
    left, right = SQUARE, pts((1, 0), (2, 0), (2, 1), (1, 1), (1, 0))
    points = spark.createDataFrame(
        [(0, 0, 1.0, 0.5), (0, 1, 0.5, 1.0), (0, 2, 0.0, 0.5), (0, 3, 0.0, 0.0), (0, 4, 0.5, 0.5)], "partition int, offset long, lon double, lat double")
    index = spatial.zone_index(zones_df(spark, zone("left", left), zone("right", right)))
    found = {(r["offset"], r["zone_id"]) for r in spatial.match_zones(points, index).collect()}
    assert found == {(0, None), (1, None), (2, None), (3, None), (4, "left")}
def _clip_area(a, b, n=400):
    """Overlap area by sampling a fine lattice over both rings."""
    xs = [p[0] for p in a + b]
    ys = [p[1] for p in a + b]
    w, h = max(xs) - min(xs), max(ys) - min(ys)
    hits = sum(
        inside(a, min(xs) + (i + 0.5) * w / n, min(ys) + (j + 0.5) * h / n)
        and inside(b, min(xs) + (i + 0.5) * w / n, min(ys) + (j + 0.5) * h / n)
        for i in range(n) for j in range(n)
    )
    return hits * w * h / n / n


def test_overlap_area_exact_and_sampled(spark):
    shifted = pts((0.5, 0.5), (1.5, 0.5), (1.5, 1.5), (0.5, 1.5), (0.5, 0.5))
    touching = pts((1, 0), (2, 0), (2, 1), (1, 1), (1, 0))
    diamond = pts((0.5, -0.5), (1.5, 0.5), (0.5, 1.5), (-0.5, 0.5), (0.5, -0.5))
    bowl = pts((0, 0), (3, 0), (3, 2), (2, 2), (2, 1), (1, 1), (1, 2), (0, 2), (0, 0))
    bar = pts((-1, 1.5), (4, 1.5), (4, 1.75), (-1, 1.75), (-1, 1.5))
    cases = [(SQUARE, SQUARE, 1.0), (SQUARE, shifted, 0.25), (SQUARE, touching, 0.0), (SQUARE, diamond, 1.0),
             (bowl, bar, 0.5)]
    rng = np.random.default_rng(5)
    for _ in range(3):
        a, b = blob(rng, 0, 0, 1, 8), blob(rng, 0.4, 0.2, 1, 8)
        cases.append((a, b, None))
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)],
                               "id int, a array<struct<x double, y double>>, b array<struct<x double, y double>>")
    got = df.select("id", G.overlap_area(G.shape_of(F.col("a")), G.shape_of(F.col("b"))).alias("v")).collect()
    for r in got:
        a, b, want = cases[r["id"]]
        assert r["v"] == (pytest.approx(want, abs=1e-9) if want is not None else pytest.approx(_clip_area(a, b), rel=0.02))


def test_overlap_report(spark, world):
    zones, _, _, _ = world
    rows = [
        zone("a", SQUARE), zone("a-inner", pts((0.2, 0.2), (0.4, 0.2), (0.4, 0.4), (0.2, 0.4), (0.2, 0.2))),
        zone("b", pts((0.9, 0), (2, 0), (2, 1), (0.9, 1), (0.9, 0)), "berth"),
        zone("c", pts((0.95, 0.5), (3, 0.5), (3, 2), (0.95, 2), (0.95, 0.5))),
        zone("next-door", pts((2, 0), (2.5, 0), (2.5, 0.5), (2, 0.5), (2, 0))),
    ]
    allowed = spark.createDataFrame([("a-inner", "a")], "zone_a string, zone_b string")
    found = {
        (r["zone_a"], r["zone_b"]): (r["severity"], round(r["overlap_area"], 9))
        for r in spatial.zone_overlaps(zones_df(spark, *rows), allowed).collect()
    }
    assert found == {
        ("a", "b"): ("warning", 0.1), ("a", "c"): ("error", 0.025), ("b", "c"): ("warning", 0.525),
    }
    pairs = {(r["zone_a"], r["zone_b"]) for r in spatial.zone_overlaps(zones_df(spark, *zones), None, 1e-4).collect()}
    # Rings that cut through themselves take no part.
    knotted = {r["zone_id"] for r in zone_faults(zones_df(spark, *zones)).collect()}
    usable = [z for z in zones if z[0] not in knotted]
    brute = {
        (a[0], b[0]) for a, b in combinations(usable, 2) if _clip_area(a[5][0][0], b[5][0][0], 120) > 2e-3
    }
    assert len(brute) > 5 and not knotted & {z for pair in pairs for z in pair}
    assert brute <= pairs


def test_rings(spark):
    bow_tie = pts((0, 0), (1, 1), (1, 0), (0, 1), (0, 0))
    open_way, flat = SQUARE[:-1], pts((0, 0), (1, 0), (2, 0), (0, 0))
    df = rings(spark, SQUARE, bow_tie, open_way, flat, pts((0, 0), (1, 1), (0, 0)))
    got = [r["ok"] for r in df.select(G.is_area(F.col("ring")).alias("ok"), "id").orderBy("id").collect()]
    assert got == [True, False, False, False, False]
    assert [r["zone_id"] for r in zone_faults(zones_df(spark, zone("ok", SQUARE), zone("bad", bow_tie))).collect()] == ["bad"]


def test_circle_and_buffer_sizes(spark):
    row = spark.range(1).select(
        G.circle_ring(F.lit(-118.2), F.lit(33.7), F.lit(1000.0)).alias("c"),
        G.segment_buffer(F.lit(-118.2), F.lit(33.7), F.lit(-118.19), F.lit(33.71)).alias("s"),
        G.segment_buffer(F.lit(1.0), F.lit(1.0), F.lit(1.0), F.lit(1.0)).alias("none"),
    ).first()
    assert len(row["c"]) == 129 and row["c"][0] == row["c"][-1] and row["none"] is None
    kx, ky = 92_850.0, 110_920.0  # metres per degree near 33.7 N, within 0.1 %
    area = shoelace([(p["x"] * kx, p["y"] * ky) for p in row["c"]])
    assert area == pytest.approx(64 * math.sin(math.pi / 64) * 1e6, rel=2e-3)
    length = math.hypot(0.01 * kx, 0.01 * ky)
    assert shoelace([(p["x"] * kx, p["y"] * ky) for p in row["s"]]) == pytest.approx(length * 20, rel=2e-3)


def test_zone_building(spark):
    corners = [("33°44′00″ N", "118°13′00″ W"), ("33°44′00″ N", "118°12′00″ W"), ("33°43′00″ N", "118°12′00″ W")]
    way = spark.createDataFrame(
        [("cfr-x", "Anchorage X", "CFR", i, la, lo) for i, (la, lo) in reversed(list(enumerate(corners)))],
        "zone_id string, name string, source_ref string, seq int, lat_text string, lon_text string",
    )
    built = Z.anchorages_from_waypoints(way).first()
    ((ring,),) = built["shape"]
    assert len(ring) == 4 and ring[0] == ring[3] and built["zone_type"] == "anchorage"
    assert ring[1]["x"] == pytest.approx(-118.2)

    areas = spark.createDataFrame(
        [("way", 1, "Pier 400", None, None, SQUARE), ("way", 2, "Terminal Island", None, None, SQUARE),
         ("way", 3, None, "Everport", None, SQUARE), ("way", 4, "Road", None, None, SQUARE[:-1])],
        "element_type string, element_id long, name string, operator string, brand string, ring array<struct<x double, y double>>",
    )
    berths = Z.berths_from_areas(areas)
    assert {(r["zone_id"], r["operator"]) for r in berths.collect()} == {("osm-way-1", "APM"), ("osm-way-3", "Everport")}
    assert berths.first()["source_ref"] == "https://www.openstreetmap.org/way/1"
    targets = spark.createDataFrame([("APM",), ("YTI",)], "operator string")
    assert [r[0] for r in Z.missing_operators(berths, targets).collect()] == ["YTI"]

    lines = spark.createDataFrame([(3, None), (1, ""), (2, "Middle Breakwater")], "id int, name string")
    assert {(r["id"], r["name"]) for r in Z.name_unnamed(lines, ["id"]).collect()} == {
        (1, "Unnamed Breakwater 1"), (2, "Middle Breakwater"), (3, "Unnamed Breakwater 2"),
    }
    segments = spark.createDataFrame(
        [("Middle Breakwater", 1, 0.0, 0.0, 1.0, 0.0), ("Middle Breakwater", 2, 1.0, 0.0, 1.0, 1.0)],
        "name string, segment_no int, x1 double, y1 double, x2 double, y2 double",
    )
    harbor = Z.breakwaters_from_segments(segments, "chart")
    assert {r["zone_id"] for r in harbor.collect()} == {"noaa-breakwater-middle-breakwater", "noaa-breakwater-middle-breakwater-2"}

    circles = spark.createDataFrame(
        [("cfr-b-7", "B-7", "CFR", "33-43′ 52.0″ N", "118-12′ 47.9″ W", 450.0, "yd")],
        "zone_id string, name string, source_ref string, lat_text string, lon_text string, radius double, unit string",
    )
    merged = Z.merge_zones([Z.anchorages_from_waypoints(way), Z.circular_anchorages(circles), berths, harbor])
    assert {(r["zone_type"], r["n"]) for r in Z.zones_by_type(merged).collect()} == {("anchorage", 2), ("berth", 2), ("harbor", 2)}
    assert {r["status"] for r in zone_checks(merged).collect()} == {"pass"}


def test_relation_keeps_its_largest_closed_outer_ring(spark):
    big = pts((0, 0), (3, 0), (3, 3), (0, 3), (0, 0))
    members = spark.createDataFrame(
        [(1, "outer", 0, SQUARE), (1, "outer", 1, big), (1, "inner", 2, big), (2, "outer", 0, SQUARE[:-1])],
        "element_id int, role string, member_no int, ring array<struct<x double, y double>>",
    )
    got = {r["element_id"]: len(r["ring"]) for r in Z.largest_outer_rings(members).collect()}
    assert got == {1: 5}


def stitched(spark, ways):
    rows = [(g, n, pts(*w)) for g, n, w in ways]
    df = spark.createDataFrame(rows, "g int, way int, points array<struct<x double, y double>>")
    got = stitched_rings(df, "g").select("g", "ring", G.ring_area(F.col("ring")).alias("a"), G.is_area(F.col("ring")).alias("ok")).collect()
    assert all(r["ok"] for r in got)
    return sorted((r["g"], len(r["ring"]), round(r["a"], 9)) for r in got)


def test_stitching_in_any_order_and_direction(spark):
    r = random.Random(5)
    ring = [(math.cos(i / 40 * 2 * math.pi), math.sin(i / 40 * 2 * math.pi)) for i in range(40)]
    area = 20 * math.sin(math.pi / 20)
    ways = []
    for g in range(12):
        cuts = sorted(r.sample(range(40), g + 1)) if g else [7]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:] + [cuts[0] + 40], strict=True)):
            way = [ring[i % 40] for i in range(a, b + 1)]
            ways.append((g, n, way if r.random() < 0.5 else way[::-1]))
    r.shuffle(ways)
    assert stitched(spark, ways) == [(g, 41, round(area, 9)) for g in range(12)]


def test_stitching_leaves_out_what_encloses_nothing(spark):
    left, right = [(0, 0), (0, 2), (2, 2)], [(2, 2), (2, 0), (0, 0)]
    ways = [
        # A spur outside, one inside, and a way to a smaller ring inside.
        (1, 0, left), (1, 1, right), (1, 2, [(2, 2), (3, 3)]), (1, 3, [(0, 0), (0.5, 0.5)]), (1, 4, [(0.5, 0.5), (1, 1)]),
        (1, 5, [(1, 1), (1.5, 1)]), (1, 6, [(1.5, 1), (1, 1.5), (1, 1)]),
        # Never closed; one point; the same point twice.
        (2, 0, left), (2, 1, [(5, 5)]), (2, 2, [(6, 6), (6, 6)]),
        # Repeated points do no harm.
        (3, 0, [(0, 0), (0, 0), (0, 2), (2, 2), (2, 2)]), (3, 1, right),
    ]
    assert stitched(spark, ways) == [(1, 4, 0.125), (1, 5, 4.0), (3, 5, 4.0)]


def test_stitching_rings_that_touch_and_rings_that_share_a_way(spark):
    ways = [
        # Two squares with one point in common: two rings.
        (1, 0, [(0, 0), (1, 0), (1, 1)]), (1, 1, [(1, 1), (0, 1), (0, 0)]), (1, 2, [(1, 1), (2, 1), (2, 2)]), (1, 3, [(2, 2), (1, 2), (1, 1)]),
        # A shared border between two areas: one ring around both.
        (2, 0, [(0, 0), (2, 0), (2, 1), (1, 1)]), (2, 1, [(1, 1), (0, 1), (0, 0)]), (2, 2, [(0, 0), (1, 1)]),
        # Three petals at one point.
        (3, 0, [(0, 0), (2, 1), (2, -1)]), (3, 1, [(2, -1), (0, 0)]), (3, 2, [(0, 0), (-1, 2)]), (3, 3, [(-1, 2), (-2, 1), (0, 0)]),
        (3, 4, [(0, 0), (-1, -3), (1, -3), (0, 0)]),
    ]
    assert stitched(spark, ways) == [(1, 5, 1.0), (1, 5, 1.0), (2, 6, 2.0), (3, 4, 1.5), (3, 4, 2.0), (3, 4, 3.0)]


def test_stitching_nothing(spark):
    assert stitched(spark, []) == []


def test_geojson_both_forms(spark, tmp_path):
    feature = {
        "type": "Feature",
        "properties": {"zone_id": "a", "zone_type": "anchorage", "authority": "CFR", "source_ref": "r", "extra": 1},
        "geometry": {"type": "Polygon", "coordinates": [[list(p) for p in SQUARE]]},
    }
    path = tmp_path / "zones.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [feature, feature]}, indent=2))
    read = Z.read_zones(spark, str(path))
    assert read.columns == schemas.ZONES.names and read.count() == 2
    assert read.first()["name"] is None and [[[tuple(p) for p in ring] for ring in rings] for rings in read.first()["shape"]] == [[SQUARE]]
    Z.write_zones(read, str(tmp_path / "lines"))
    assert Z.read_zones(spark, str(tmp_path / "lines"), lines=True).exceptAll(read).count() == 0


def test_zone_checks_report_each_fault(spark):
    zones = zones_df(
        spark, zone("a", SQUARE), zone("a", SQUARE, "pier"), ("b", "berth", "OSM", "", "b", [[SQUARE[:-1]]]),
        zone("c", SQUARE, authority="ME"),
    )
    faults = {(r["check"], r["column"]): r["failures"] for r in zone_checks(zones).collect() if r["failures"]}
    assert faults == {
        ("unique", "zone_id"): 1, ("accepted_values", "zone_type"): 1, ("accepted_values", "authority"): 1,
        ("not_null", "source_ref"): 1, ("valid_shape", "shape"): 1, ("no_empty", "shape"): 1,
    }


def test_regulated_anchorages_overlap_only_where_allowed(spark):
    from harborflow.constants import ALLOWED_OVERLAPS
    from harborflow.sources.regulated_zones import regulated_anchorages

    zones = regulated_anchorages(spark)
    assert zones.count() == 13 and zone_faults(zones).count() == 0
    allowed = spark.createDataFrame(ALLOWED_OVERLAPS, "zone_a string, zone_b string")
    assert spatial.zone_overlaps(zones, allowed, 1e-10).collect() == []
    assert spatial.zone_overlaps(zones, None, 1e-10).count() == len(ALLOWED_OVERLAPS)


def star(cx, cy, r, n, k=0.45):
    """A jagged ring with n tips."""
    turns = [(r if i % 2 == 0 else k * r, math.pi * i / n) for i in range(2 * n)]
    ring = [(cx + q * math.cos(a), cy + q * math.sin(a)) for q, a in turns]
    return pts(*ring, ring[0])


def box(x0, y0, x1, y1):
    return pts((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))


def in_shape(shape, x, y):
    return sum(inside(ring, x, y) for rings in shape for ring in rings) % 2 == 1


SHAPES = {
    "holed": [[box(0, 0, 10, 10), box(2, 2, 4, 8), star(7, 5, 2, 7)]],
    "parts": [[box(-5, -5, -1, -1), box(-4, -4, -2, -2)], [box(-3.5, -3.5, -2.5, -2.5)], [box(20, 20, 20.001, 20.001)]],
    "jagged": [[star(3, 3, 40, 300)]],
    "wide": [[box(-60, -30, 60, 30), box(-16, -16, 16, 16)]],
    "on cell borders": [[box(0.25, 0.25, 0.75, 1), box(0.5, 0.5, 0.625, 0.75)]],
}


@pytest.mark.parametrize("limit", [10**9, 0])
def test_holes_and_parts_against_brute_force(spark, limit):
    rng = np.random.default_rng(11)
    rows = [(name, "anchorage", "CFR", "ref", name, shape) for name, shape in SHAPES.items()]
    spots = [*map(tuple, rng.uniform(-70, 70, (300, 2))), *map(tuple, rng.uniform(-6, 11, (500, 2))), *map(tuple, rng.uniform(0, 1, (200, 2)))]
    # Corners, edges, and cell borders through the middle of things.
    spots += [(0.25, 0.5), (0.5, 0.5), (0.5, 0.6), (0.75, 1.0), (0.25, 0.25), (0.5, 0.9), (0.7, 0.75), (16.0, 0.0), (-16.0, 4.0), (0.0, 0.0), (4.0, 5.0), (20.0005, 20.0005)]
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(spots)], "offset long, lon double, lat double")
    index = spatial.zone_index(zones_df(spark, *rows), max_broadcast_edges=limit)
    got = {(r["offset"], r["zone_id"]) for r in spatial.match_zones(points, index).collect()}
    want = set()
    for i, (x, y) in enumerate(spots):
        on_edge = {
            name for name, shape in SHAPES.items() for rings in shape for ring in rings for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:])
            if (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2)
        }
        hits = {name for name, shape in SHAPES.items() if name not in on_edge and in_shape(shape, x, y)}
        want |= {(i, h) for h in hits} or {(i, None)}
    assert got == want
    areas = {r["zone_id"]: r["_area"] for r in index.cells.select("zone_id", "_area").distinct().collect()}
    assert areas["wide"] == pytest.approx(120 * 60 - 32 * 32) and areas["parts"] == pytest.approx(16 - 4 + 1 + 1e-6)
    # No cell keeps more edges of a zone than allowed, and a fine one none that is far away.
    assert index.cells.filter(F.size("_edges") > spatial.CELL_EDGES).count() == 0


def test_rows_of_a_wide_zone_grow_with_its_border(spark):
    square = (("wide", "anchorage", "CFR", "ref", "wide", [[box(-30.1, -30.1, 30.1, 30.1)]]),)
    index = spatial.zone_index(zones_df(spark, *square))
    assert index.cells.count() <= 25
    # Many tips on the border: cells follow the border, whatever lies between.
    tips = 4000
    jagged = zones_df(spark, ("jagged", "anchorage", "CFR", "ref", "jagged", [[star(0, 0, 30, tips, 0.98)]]))
    cells = spatial.zone_index(jagged).cells
    border, inner = cells.filter(F.size("_edges") > 0).count(), cells.filter(F.size("_edges") == 0).count()
    assert border <= 2 * tips and inner <= 4 * border
    edges = cells.agg(F.sum(F.size("_edges"))).first()[0]
    assert edges <= 8 * 2 * tips


def test_crowded_cells_are_cut_but_not_without_end(spark):
    zones = [zone(f"z{i:03d}", box(i * 1e-4, 0, 1 + i * 1e-4, 1)) for i in range(150)]
    index = spatial.zone_index(zones_df(spark, *zones))
    assert index.cells.agg(F.max("_depth")).first()[0] == spatial.CROWDED_TIERS
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 0.00505, 0.5), (3, 1.00505, 0.999), (4, 2.0, 0.5)], "offset long, lon double, lat double")
    counts = {r["offset"]: r["n"] for r in spatial.match_zones(points, index).groupBy("offset").agg(F.count("zone_id").alias("n")).collect()}
    assert counts == {1: 150, 2: 51, 3: 99, 4: 0}


def test_zones_without_area_and_points_without_place(spark):
    rows = [("null", "berth", "OSM", "r", "n", None), ("none", "berth", "OSM", "r", "n", []), zone("ok", SQUARE)]
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, None, 0.5), (3, float("nan"), 0.5), (4, float("inf"), 0.5)], "offset long, lon double, lat double")
    index = spatial.zone_index(zones_df(spark, *rows))
    assert {(r["offset"], r["zone_id"]) for r in spatial.match_zones(points, index).collect()} == {(1, "ok"), (2, None), (3, None), (4, None)}
    empty = spatial.zone_index(zones_df(spark, *rows[:2]))
    assert {(r["offset"], r["zone_id"]) for r in spatial.best_zone(points, empty).collect()} == {(i, None) for i in (1, 2, 3, 4)}
    assert {(r["offset"], r["zone_id"], r["_area"]) for r in spatial.match_zones(points, empty).collect()} == {(i, None, None) for i in (1, 2, 3, 4)}


def test_overlaps_of_holes_parts_and_far_sizes(spark):
    rows = [
        ("a", "anchorage", "CFR", "r", "a", [[box(0, 0, 10, 10), box(2, 2, 8, 8)]]),
        ("in-hole", "anchorage", "CFR", "r", "b", [[box(3, 3, 7, 7)]]),
        ("half", "berth", "CFR", "r", "c", [[box(7, 3, 9, 4)], [box(20, 20, 21, 21)]]),
        ("tiny", "anchorage", "CFR", "r", "d", [[box(20.5, 20.5, 20.501, 20.501)]]),
        ("world", "harbor", "CFR", "r", "e", [[box(-100, -50, 100, 50), box(-1, -1, 15, 15)]]),
        ("bad", "harbor", "CFR", "r", "f", [[pts((0, 0), (10, 10), (10, 0), (0, 10), (0, 0))]]),
    ]
    found = {(r["zone_a"], r["zone_b"]): r["overlap_area"] for r in spatial.zone_overlaps(zones_df(spark, *rows), None, 1e-9).collect()}
    assert found == {
        ("a", "half"): pytest.approx(1.0), ("half", "world"): pytest.approx(1.0), ("half", "tiny"): pytest.approx(1e-6),
        ("tiny", "world"): pytest.approx(1e-6),
    }


def test_geojson_keeps_holes_and_parts(spark, tmp_path):
    rows = [(name, "anchorage", "CFR", "ref", name, shape) for name, shape in SHAPES.items()]
    zones = zones_df(spark, *rows)
    Z.write_zones(zones, str(tmp_path / "lines"))
    read = Z.read_zones(spark, str(tmp_path / "lines"), lines=True)
    assert read.exceptAll(zones).count() == 0 and read.count() == len(rows)
    point = {"type": "Feature", "properties": {"zone_id": "p"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}
    (tmp_path / "more.json").write_text(json.dumps(point) + "\n" + json.dumps(point | {"geometry": None}))
    assert [r["shape"] for r in Z.read_zones(spark, str(tmp_path / "more.json"), lines=True).collect()] == [None, None]
