"""Planar geometry over `ring` columns (ARRAY<STRUCT<x, y>>, first point repeated last) and `shape` columns.

A shape is an array of polygons, a polygon an array of rings: its outer ring, then its holes. What lies inside follows from
all rings together by the even-odd rule. Every expression below is evaluated row by row in the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from harborflow import constants as K

WGS84_A = 6378137.0
WGS84_E2 = 0.00669437999014


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def close_ring(points: Column) -> Column:
    """Repeat the first point at the end unless the ring is closed already."""
    first, last = F.get(points, F.lit(0)), F.try_element_at(points, F.lit(-1))
    return F.when(first == last, points).otherwise(F.concat(points, F.slice(points, 1, 1)))


def ring_from_waypoints(seq: Column, x: Column, y: Column) -> Column:
    """Aggregate: the waypoints of one zone, in order, as a closed ring."""
    ordered = F.sort_array(F.collect_list(F.struct(seq.alias("seq"), x.alias("x"), y.alias("y"))))
    return close_ring(F.transform(ordered, lambda p: point(p["x"], p["y"])))


def edges(ring: Column) -> Column:
    return F.zip_with(
        F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))),
        F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))),
        lambda a, b: F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
        ),
    )


def signed_area(ring: Column) -> Column:
    """Shoelace area in squared coordinate units, measured from the first vertex for precision; negative if clockwise."""
    origin = F.get(ring, F.lit(0))
    twice = F.aggregate(
        edges(ring),
        F.lit(0.0),
        lambda acc, e: acc
        + (e["x1"] - origin["x"]) * (e["y2"] - origin["y"])
        - (e["x2"] - origin["x"]) * (e["y1"] - origin["y"]),
    )
    return twice / 2


def ring_area(ring: Column) -> Column:
    return F.abs(signed_area(ring))


def bbox(ring: Column) -> Column:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("x_min"), F.array_max(xs).alias("x_max"),
        F.array_min(ys).alias("y_min"), F.array_max(ys).alias("y_max"),
    )


def shape_of(ring: Column) -> Column:
    """The shape of a single ring without holes."""
    return F.when(ring.isNotNull(), F.array(F.array(ring)))


def shape_edges(shape: Column) -> Column:
    return F.flatten(F.transform(F.flatten(shape), edges))


def shape_area(shape: Column) -> Column:
    """Area of all polygons, their holes taken off."""

    def polygon(rings: Column) -> Column:
        return _sum(F.transform(rings, lambda ring, i: F.when(i == 0, ring_area(ring)).otherwise(-ring_area(ring))))

    return _sum(F.transform(shape, polygon))


def shape_bbox(shape: Column) -> Column:
    return bbox(F.flatten(F.flatten(shape)))


def _right_of(e: Column, x: Column, y: Column) -> Column:
    """For an edge that reaches the height `y`: whether it passes to the right of the point."""
    return x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]


def _reaches(e: Column, y: Column) -> Column:
    return (e["y1"] > y) != (e["y2"] > y)


def _carries(e: Column, x: Column, y: Column) -> Column:
    """Whether the point lies on the edge."""
    level = (e["x2"] - e["x1"]) * (y - e["y1"]) == (e["y2"] - e["y1"]) * (x - e["x1"])
    within_x = x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
    return level & within_x & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))


def inside(edge_array: Column, x: Column, y: Column) -> Column:
    """Even-odd rule over the edges of any number of rings; of an edge's two sides the right and upper one counts for points on it."""
    return F.aggregate(
        edge_array, F.lit(False),
        lambda acc, e: acc != F.when(_reaches(e, y), _right_of(e, x, y)).otherwise(F.lit(False)),
    )


def _turns(e: Column, from_x: Column, from_y: Column, x: Column, y: Column) -> Column:
    """Whether an edge is crossed on the way up or down from one point to the height of another, and then across to it."""
    at = (e["y2"] - e["y1"]) * (from_x - e["x1"]) / (e["x2"] - e["x1"]) + e["y1"]
    upright = F.when((e["x1"] > from_x) != (e["x2"] > from_x), (from_y < at) != (y < at)).otherwise(F.lit(False))
    across = F.when(_reaches(e, y), _right_of(e, from_x, y) != _right_of(e, x, y)).otherwise(F.lit(False))
    return upright != across


def inside_from(edge_array: Column, from_inside: Column, from_x: Column, from_y: Column, x: Column, y: Column) -> Column:
    """`inside` by what is known of another point and the edges that may lie between the two."""
    return F.aggregate(edge_array, from_inside, lambda acc, e: acc != _turns(e, from_x, from_y, x, y))


def contains_from(edge_array: Column, from_inside: Column, from_x: Column, from_y: Column, x: Column, y: Column) -> Column:
    """As `inside_from`, but a point on an edge is outside. One walk over the edges: 2 stands for a point on one."""
    found = F.aggregate(
        edge_array, from_inside.cast("int"),
        lambda acc, e: F.when((acc == 2) | _carries(e, x, y), 2).when(_turns(e, from_x, from_y, x, y), 1 - acc).otherwise(acc),
    )
    return found == 1


def _metres_per_degree(lat: Column) -> tuple[Column, Column]:
    """Length of one degree of longitude and of latitude on the ellipsoid at `lat`."""
    s = F.sin(F.radians(lat))
    w2 = F.lit(1.0) - F.lit(WGS84_E2) * s * s
    prime = F.lit(WGS84_A) / F.sqrt(w2)
    meridian = F.lit(WGS84_A * (1 - WGS84_E2)) / (w2 * F.sqrt(w2))
    degree = math.pi / 180
    return prime * F.cos(F.radians(lat)) * degree, meridian * degree


def without_repeats(points: Column) -> Column:
    """Points, each one different from the one before it."""
    return F.filter(points, lambda p, i: (i == 0) | (p != F.get(points, i - 1)))


def on_plane(points: Column) -> Column:
    """(points, x, y, east, north): points in metres from the first one, on the tangent plane at the middle latitude."""
    ys = F.transform(points, lambda p: p["y"])
    east, north = _metres_per_degree((F.array_min(ys) + F.array_max(ys)) / 2)
    first = F.get(points, F.lit(0))
    return _bind(
        F.struct(points.alias("p"), first["x"].alias("x"), first["y"].alias("y"), east.alias("east"), north.alias("north")),
        lambda s: F.struct(
            F.transform(s["p"], lambda p: point((p["x"] - s["x"]) * s["east"], (p["y"] - s["y"]) * s["north"])).alias("points"),
            s["x"].alias("x"), s["y"].alias("y"), s["east"].alias("east"), s["north"].alias("north"),
        ),
    )


def from_plane(points: Column, plane: Column) -> Column:
    """Points in metres of `on_plane` as degrees."""
    return F.transform(points, lambda p: point(p["x"] / plane["east"] + plane["x"], p["y"] / plane["north"] + plane["y"]))


def circle_ring(
    lon: Column, lat: Column, radius_m: Column, segments: int = 4 * K.CIRCLE_SEGMENTS_PER_QUADRANT
) -> Column:
    """Polygon inscribed in a circle, on the tangent plane at its centre.

    The plane replaces a map projection: the error grows with the square of the radius and is
    below a metre for radii of a few kilometres.
    """
    east, north = _metres_per_degree(lat)

    def vertex(i: Column) -> Column:
        angle = (i % segments) * (2 * math.pi / segments)
        return point(lon + radius_m * F.cos(angle) / east, lat + radius_m * F.sin(angle) / north)

    return F.transform(F.sequence(F.lit(0), F.lit(segments)), vertex)


def segment_buffer(
    x1: Column, y1: Column, x2: Column, y2: Column, half_width_m: float = K.BREAKWATER_HALF_WIDTH_M
) -> Column:
    """Flat-capped rectangle around one line segment; null for a zero-length segment.

    Whole lines, with filled bends, are a matter of `operators.buffers`.
    """
    east, north = _metres_per_degree((y1 + y2) / 2)
    dx, dy = (x2 - x1) * east, (y2 - y1) * north
    length = F.sqrt(dx * dx + dy * dy)
    off_x = F.try_divide(-dy, length) * half_width_m / east
    off_y = F.try_divide(dx, length) * half_width_m / north
    corners = F.array(
        point(x1 + off_x, y1 + off_y), point(x2 + off_x, y2 + off_y),
        point(x2 - off_x, y2 - off_y), point(x1 - off_x, y1 - off_y),
        point(x1 + off_x, y1 + off_y),
    )
    return F.when(length > 0, corners)


def _side(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    return F.signum((bx - ax) * (py - ay) - (by - ay) * (px - ax))


def properly_cross(e: Column, f: Column) -> Column:
    """True when two segments cut through each other in the interior of both."""
    return (
        _side(e["x1"], e["y1"], e["x2"], e["y2"], f["x1"], f["y1"])
        * _side(e["x1"], e["y1"], e["x2"], e["y2"], f["x2"], f["y2"])
        < 0
    ) & (
        _side(f["x1"], f["y1"], f["x2"], f["y2"], e["x1"], e["y1"])
        * _side(f["x1"], f["y1"], f["x2"], f["y2"], e["x2"], e["y2"])
        < 0
    )


def boxed(e: Column) -> Column:
    """An edge with the bounds of its box, which are compared first: most pairs of edges lie apart."""
    return F.struct(
        e["x1"].alias("x1"), e["y1"].alias("y1"), e["x2"].alias("x2"), e["y2"].alias("y2"),
        F.least(e["x1"], e["x2"]).alias("x_min"), F.greatest(e["x1"], e["x2"]).alias("x_max"),
        F.least(e["y1"], e["y2"]).alias("y_min"), F.greatest(e["y1"], e["y2"]).alias("y_max"),
    )


def boxes_meet(e: Column, f: Column) -> Column:
    return (e["x_min"] <= f["x_max"]) & (f["x_min"] <= e["x_max"]) & (e["y_min"] <= f["y_max"]) & (f["y_min"] <= e["y_max"])


def is_simple(ring: Column) -> Column:
    """No two edges of the ring cut through each other."""

    def clean(es: Column) -> Column:
        # Each pair once, and none that follow each other: they share an end.
        hits = F.transform(es, lambda e, i: F.exists(F.slice(es, i + 3, F.size(es)), lambda f: boxes_meet(e, f) & properly_cross(e, f)))
        return ~F.exists(hits, lambda hit: hit)

    return _bind(F.transform(edges(ring), boxed), clean)


def is_closed(ring: Column) -> Column:
    """Closed as given, at least four points."""
    closed = F.get(ring, F.lit(0)) == F.try_element_at(ring, F.lit(-1))
    return F.coalesce((F.size(ring) >= 4) & closed, F.lit(False))


def is_area(ring: Column) -> Column:
    """A usable polygon: closed as given, at least four points, a non-zero area, no crossings."""
    return is_closed(ring) & F.coalesce((ring_area(ring) > 0) & is_simple(ring), F.lit(False))


def all_rings(shape: Column, holds: Callable[[Column], Column]) -> Column:
    """At least one polygon, each with an outer ring, and `holds` for every ring."""
    whole = F.forall(shape, lambda rings: (F.size(rings) > 0) & F.forall(rings, holds))
    return F.coalesce((F.size(shape) > 0) & whole, F.lit(False))


def _crossing_xs(edge_array: Column, y: Column) -> Column:
    hits = F.filter(edge_array, lambda e: (e["y1"] > y) != (e["y2"] > y))
    return F.sort_array(
        F.transform(hits, lambda e: (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])
    )


def _spans(xs: Column) -> Column:
    """Sorted crossings paired up: the stretches of the scan line inside the polygon."""
    return F.transform(
        F.filter(F.sequence(F.lit(0), F.size(xs)), lambda i: (i % 2 == 0) & (i < F.size(xs) - 1)),
        lambda i: F.struct(F.get(xs, i).alias("lo"), F.get(xs, i + 1).alias("hi")),
    )


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` evaluated once, however often `use` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _cut_height(e: Column, f: Column) -> Column:
    """Height at which two segments cut through each other, else null."""
    along = (e["x2"] - e["x1"]) * (f["y2"] - f["y1"]) - (e["y2"] - e["y1"]) * (f["x2"] - f["x1"])
    t = F.try_divide(
        (f["x1"] - e["x1"]) * (f["y2"] - f["y1"]) - (f["y1"] - e["y1"]) * (f["x2"] - f["x1"]), along
    )
    return F.when(properly_cross(e, f), e["y1"] + t * (e["y2"] - e["y1"]))


def _shared_width(ea: Column, eb: Column, y: Column) -> Column:
    """Length of the scan line at `y` that lies in both polygons."""

    def common(p: Column, q: Column) -> Column:
        return F.greatest(F.least(p["hi"], q["hi"]) - F.greatest(p["lo"], q["lo"]), F.lit(0.0))

    return _bind(
        F.struct(_bind(_crossing_xs(ea, y), _spans).alias("a"), _bind(_crossing_xs(eb, y), _spans).alias("b")),
        lambda s: _sum(F.transform(s["a"], lambda p: _sum(F.transform(s["b"], lambda q: common(p, q))))),
    )


def overlap_area(shape_a: Column, shape_b: Column) -> Column:
    """Area common to two shapes whose rings neither cross themselves nor each other.

    Between neighbouring heights at which anything happens (a vertex, or an edge of one cutting an
    edge of the other) the shared width changes linearly, so the height at the middle of each slab
    gives the slab's area exactly. Shared borders contribute nothing, and neither do heights that
    only one of the polygons reaches.
    """

    def heights(e: Column) -> Column:
        box_a, box_b = e["box_a"], e["box_b"]
        cuts = F.flatten(F.transform(e["a"], lambda p: F.transform(F.filter(e["b"], lambda q: boxes_meet(p, q)), lambda q: _cut_height(p, q))))
        ends = F.concat(F.transform(e["a"], lambda p: p["y1"]), F.transform(e["b"], lambda p: p["y1"]))
        lo, hi = F.greatest(box_a["y_min"], box_b["y_min"]), F.least(box_a["y_max"], box_b["y_max"])
        return F.sort_array(F.array_distinct(F.filter(F.concat(ends, cuts), lambda v: v.between(lo, hi))))

    def area(e: Column) -> Column:
        return _bind(
            heights(e),
            lambda hs: _sum(
                F.zip_with(
                    F.slice(hs, 1, F.greatest(F.size(hs) - 1, F.lit(0))),
                    F.slice(hs, 2, F.greatest(F.size(hs) - 1, F.lit(0))),
                    lambda lo, hi: _shared_width(e["a"], e["b"], (lo + hi) / 2) * (hi - lo),
                )
            ),
        )

    both = F.struct(
        F.transform(shape_edges(shape_a), boxed).alias("a"), F.transform(shape_edges(shape_b), boxed).alias("b"),
        shape_bbox(shape_a).alias("box_a"), shape_bbox(shape_b).alias("box_b"),
    )
    return _bind(both, area)
