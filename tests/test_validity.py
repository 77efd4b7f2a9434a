"""Faults of rings and buffers of lines against plain loops."""

import math
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from harborflow import schemas
from harborflow.functions import geometry as G
from harborflow.operators import validity
from harborflow.operators.buffers import line_buffers
from harborflow.operators.contacts import contacts, ring_edges
from harborflow.operators.validity import valid_zones, zone_faults

RINGS = "id string, rings array<array<struct<x double, y double>>>"


def closed(*points):
    return [*points, points[0]]


SQUARE = closed((0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0))
SHAPES = {
    "square": [[SQUARE]],
    "repeated point": [[[(0.0, 0.0), (0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (4.0, 4.0), (0.0, 0.0)]]],
    "hole": [[SQUARE, closed((1.0, 1.0), (2.0, 1.0), (2.0, 2.0))]],
    "hole touching at a point": [[SQUARE, closed((0.0, 2.0), (2.0, 1.0), (2.0, 3.0))]],
    "crossing": [[closed((0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 4.0))]],
    "hole across": [[SQUARE, closed((3.0, 1.0), (5.0, 1.0), (5.0, 2.0))]],
    "spike": [[closed((0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (4.0, 6.0), (4.0, 4.0), (0.0, 4.0))]],
    "inner spike": [[closed((0.0, 0.0), (2.0, 0.0), (2.0, 1.0), (2.0, 0.0), (4.0, 0.0), (4.0, 4.0))]],
    "overlap": [[SQUARE, closed((0.0, 1.0), (2.0, 2.0), (0.0, 3.0))]],
    "self_touch": [[closed((0.0, 0.0), (4.0, 0.0), (2.0, 2.0), (4.0, 4.0), (0.0, 4.0), (2.0, 2.0))]],
    "vertex on edge": [[closed((0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 0.0), (0.0, 4.0))]],
    "empty": [[SQUARE[:-1]]],
    "flat": [[closed((0.0, 0.0), (1.0, 0.0), (2.0, 0.0))]],
    "no rings": [[]],
    "two parts": [[SQUARE], [closed((5.0, 0.0), (6.0, 0.0), (6.0, 1.0))]],
    "parts across": [[SQUARE], [closed((3.0, 3.0), (6.0, 3.0), (6.0, 6.0), (3.0, 6.0))]],
}
FOUND = {
    "crossing": "crossing", "hole across": "crossing", "parts across": "crossing", "spike": "spike", "inner spike": "spike",
    "overlap": "overlap", "self_touch": "self_touch", "vertex on edge": "self_touch", "empty": "empty", "flat": "spike",
    "no rings": "empty", "null": "empty",
}


def test_each_fault(spark):
    rows = [(name, "berth", "OSM", "s", name, shape) for name, shape in [*SHAPES.items(), ("null", None)]]
    # The same id with another shape, and the same zone again.
    rows += [("square", "berth", "OSM", "s", "other", SHAPES["crossing"]), rows[0]]
    zones = spark.createDataFrame(rows, schemas.ZONES)
    found = sorted((r["zone_id"], r["fault"]) for r in zone_faults(zones).collect())
    assert found == sorted([*FOUND.items(), ("square", "crossing")])
    kept = sorted(r["zone_id"] for r in valid_zones(zones).collect())
    assert kept == sorted(["square", "square", "repeated point", "hole", "hole touching at a point", "two parts"])
    assert valid_zones(zones).columns == zones.columns
    assert zone_faults(zones.limit(0)).count() == 0


def _meet(p, q):
    side = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    box = lambda a, b, c: min(a[0], b[0]) <= c[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= c[1] <= max(a[1], b[1])
    (a, b), (c, d) = p, q
    if side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0:
        return True
    return any(side(u, v, w) == 0 and box(u, v, w) for u, v, w in [(a, b, c), (a, b, d), (c, d, a), (c, d, b)])


@pytest.mark.parametrize("scale, whole", [(1.0, True), (1e-4, False), (3000.0, False)])
def test_contacts_equal_all_pairs(spark, scale, whole):
    """Random walks, on a lattice so that edges touch and lie on each other, or anywhere."""
    draw = random.Random(3)
    walks = {}
    for name in "abc":
        points = [(float(draw.randrange(12)), float(draw.randrange(12))) if whole else (draw.random() * scale, draw.random() * scale) for _ in range(60)]
        walks[name] = [p for i, p in enumerate(points) if i == 0 or p != points[i - 1]]
    groups = spark.createDataFrame([(n, [w]) for n, w in walks.items()], RINGS)
    found = {(r["id"], r["a"]["edge"], r["b"]["edge"]) for r in contacts(ring_edges(groups, "id", "rings"), "id").collect()}
    want = {
        (n, i, j) for n, w in walks.items() for (i, e), (j, f) in combinations(enumerate(zip(w, w[1:])), 2) if _meet(e, f)
    }
    assert found == want and len(want) > 500


def _near(line, x, y, width):
    """Whether a point belongs to the line's zone: in a segment's rectangle, or around a bend."""
    for (ax, ay), (bx, by) in zip(line, line[1:]):
        length = math.hypot(bx - ax, by - ay)
        along = ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / length
        if 0 <= along <= length and abs((x - ax) * (by - ay) - (y - ay) * (bx - ax)) / length <= width:
            return True
    return any(math.hypot(x - px, y - py) <= width and _outside(line, i, x, y) for i, (px, py) in enumerate(line) if 0 < i < len(line) - 1)


def _outside(line, i, x, y):
    """Past the end of the segment before and before the start of the one after."""
    (ax, ay), (px, py), (bx, by) = line[i - 1:i + 2]
    return (x - px) * (px - ax) + (y - py) * (py - ay) >= 0 and (x - px) * (bx - px) + (y - py) * (by - py) <= 0


EAST, NORTH = 92_740.0, 110_920.0
LINES = {
    "straight": [(0, 0), (100, 0)],
    "in three": [(0, 0), (50, 0), (100, 0)],
    "bend": [(0, 0), (100, 0), (150, 80)],
    "zigzag": [(0, 0), (100, 0), (50, 80), (150, 90)],
    "short segments": [(0, 0), (60, 0), (63, 2), (64, 6), (64, 70)],
    "hook": [(0, 0), (100, 0), (100, 12), (40, 12)],
    "sharp": [(0, 0), (100, 0), (0, 9)],
    "there and back": [(0, 0), (100, 0), (30, 0)],
    "crosses itself": [(0, 0), (120, 0), (120, 80), (60, 80), (60, -60)],
}


def test_buffers_hold_what_is_near(spark):
    """Random points on either side of the border, but for a strip where arcs are not quite round and degrees not quite metres."""
    lat = 33.7
    rows = [(n, [(-118.2 + x / EAST, lat + y / NORTH) for x, y in line]) for n, line in LINES.items()]
    rows += [("one point", rows[0][1][:1]), ("no length", rows[0][1][:1] * 3), ("none", None)]
    lines = spark.createDataFrame(rows, "name string, points array<struct<x double, y double>>")
    got = {r["name"]: r["ring"] for r in line_buffers(lines, "name", "points").collect()}
    assert set(got) == set(LINES)
    probe, draw = [], random.Random(5)
    for name, line in LINES.items():
        for _ in range(800):
            x, y = draw.uniform(-30, 190), draw.uniform(-90, 120)
            firm = {_near(line, x + dx, y + dy, 10 + dw) for dx in (-0.5, 0.5) for dy in (-0.5, 0.5) for dw in (-0.4, 0.4)}
            if len(firm) == 1:
                probe.append((name, x, y, firm.pop()))
    rings = spark.createDataFrame([(n, [[(p["x"], p["y"]) for p in ring]]) for n, ring in got.items()], RINGS)
    points = spark.createDataFrame(probe, "id string, x double, y double, want boolean")
    inside = G.inside(G.edges(F.get("rings", F.lit(0))), F.lit(-118.2) + F.col("x") / EAST, F.lit(lat) + F.col("y") / NORTH)
    wrong = points.join(rings, "id").filter(inside != F.col("want")).select("id", "x", "y", "want").collect()
    # The one that crosses itself has a hole, which is filled.
    wrong = [r for r in wrong if not (r["id"] == "crosses itself" and 60 < r["x"] < 120 and 0 < r["y"] < 80)]
    assert wrong == [] and sum(p[3] for p in probe) > 300
    faults = spark.createDataFrame([(n, "harbor", "NOAA", "s", n, [[[(p["x"], p["y"]) for p in r]]]) for n, r in got.items()], schemas.ZONES)
    assert valid_zones(faults).count() >= len(LINES) - 2


def test_small_rings_are_looked_at_row_by_row(spark, monkeypatch):
    """Row by row and by the join of edges the same faults are found, and the join is left to large shapes."""
    rng = np.random.default_rng(4)
    data = []
    for i in range(300):
        # Few places, so that edges meet in every way.
        rings = [[tuple(map(float, p)) for p in rng.integers(0, 4, (int(rng.integers(3, 8)), 2))] for _ in range(int(rng.integers(1, 4)))]
        data.append((i, [[*ring, ring[0]] for ring in rings]))
    groups = spark.createDataFrame(data, "id long, rings array<array<struct<x:double,y:double>>>")
    few = {r["id"]: r["fault"] for r in validity.ring_faults(groups, "id", "rings").collect()}
    assert few == {r["id"]: r["fault"] for r in validity._joined_faults(groups, "id", "rings").collect()}
    assert set(few.values()) == {"crossing", "overlap", "spike", "self_touch"}

    def no_join(*_):
        raise AssertionError("edges of small shapes were joined")

    monkeypatch.setattr(validity, "contacts", no_join)
    shapes = groups.select(F.col("id").cast("string").alias("zone_id"), F.lit("a").alias("zone_type"), F.array("rings").alias("shape"))
    assert validity.zone_faults(shapes).count() >= len(few)
    lines = spark.createDataFrame([(i, [(0.0, 0.0), (0.002 + i / 1e5, 0.0), (0.003, 0.001)]) for i in range(20)], "id long, points array<struct<x:double,y:double>>")
    assert line_buffers(lines, "id", "points").count() == 20
