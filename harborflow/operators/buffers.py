"""Zones of a given width around lines: flat at both ends, round outside the bends, one ring a line.

A line whose bends are wide enough for its segments gets its ring directly: offset points on both sides, an arc outside each bend
and the meeting point of the offset lines inside. All other lines, and those that come back to themselves, get the outer ring around
everything their offset curve encloses: its edges are cut where they meet and stitched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborflow import constants as K
from harborflow.functions import geometry as G
from harborflow.operators.contacts import contacts, ring_edges
from harborflow.operators.rings import stitched_rings
from harborflow.operators.validity import ring_faults
from harborflow.session import spread, store

_STEP = math.pi / 2 / K.BEND_SEGMENTS_PER_QUADRANT


def _legs(points: Column) -> Column:
    """Segments with start, end, direction and length."""

    def leg(e: Column) -> Column:
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        return F.struct(
            e["x1"].alias("x"), e["y1"].alias("y"), e["x2"].alias("to_x"), e["y2"].alias("to_y"),
            F.atan2(dy, dx).alias("angle"), F.sqrt(dx * dx + dy * dy).alias("length"),
        )

    return F.transform(G.edges(points), leg)


def _with_turns(legs: str) -> Column:
    """Segments of a column with `turn`, the angle to the next one, above zero to the left, null at the end, and `before`, the turn that
    leads to them. Where a line goes back on itself, both sides go around its tip: the turn is -pi in either direction."""

    def turn(leg: Column, after: Column) -> Column:
        # Between -pi and pi: a difference of two directions lies within one turn of it.
        raw = F.pmod(after["angle"] - leg["angle"] + math.pi, F.lit(2 * math.pi)) - math.pi
        return F.when(F.abs(raw) > math.pi - 1e-9, F.lit(-math.pi)).when(F.abs(raw) < 1e-12, F.lit(0.0)).otherwise(raw)

    of = F.col(legs)
    return F.transform(of, lambda leg, i: leg.withField("turn", turn(leg, F.get(of, i + 1))).withField("before", turn(F.get(of, i - 1), leg)))


def _left_side(legs: str, width: float, through: bool) -> Column:
    """Offset points to the left of a line; inside a bend the point where the offset lines meet, or, if `through`, the way by the bend itself."""

    def off(x: Column, y: Column, angle: Column) -> Column:
        return G.point(x - width * F.sin(angle), y + width * F.cos(angle))

    def from_leg(leg: Column) -> Column:
        x, y, turn, angle = leg["to_x"], leg["to_y"], leg["turn"], leg["angle"]
        start, end = off(leg["x"], leg["y"], angle), off(x, y, angle)
        steps = F.greatest(F.ceil(-turn / _STEP), F.lit(1)).cast("int")
        arc = F.transform(F.sequence(F.lit(0), steps), lambda i: off(x, y, angle + turn * i / steps))
        middle, reach = angle + turn / 2, width / F.cos(turn / 2)
        meeting = F.array(G.point(x - reach * F.sin(middle), y + reach * F.cos(middle)))
        inner = F.array(end, G.point(x, y), off(x, y, angle + turn)) if through else meeting
        bend = F.when(turn.isNull() | (turn == 0), F.array(end)).when(turn < 0, arc).otherwise(inner)
        return F.when(leg["before"].isNull(), F.concat(F.array(start), bend)).otherwise(bend)

    return F.flatten(F.transform(legs, from_leg))


def _ring(width: float, through: bool) -> Column:
    return G.close_ring(F.concat(_left_side("_there", width, through), _left_side("_back", width, through)))


def _taken(leg: Column, width: float) -> Column:
    """What the bends at the two ends of a segment take away of it."""

    def taken(turn: Column) -> Column:
        # A line that goes back on itself takes more than any segment has.
        return F.when(turn < -3.14, F.lit(math.inf)).otherwise(F.coalesce(width * F.tan(F.abs(turn) / 2), F.lit(0.0)))

    return taken(leg["turn"]) + taken(leg["before"])


def _bends_fit(width: float) -> Column:
    """Whether every segment is long enough for what the bends at its two ends take away of it."""
    return F.forall("_there", lambda leg: _taken(leg, width) < leg["length"])


def _surely_fit(width: float) -> Column:
    """Whether the ring of a line with fitting bends need not be looked at: with at most one bend, the sides meet at the bend only."""
    return (F.size("_there") <= 2) & F.forall("_there", lambda leg: _taken(leg, width) < leg["length"] * (1 - 1e-9))


def line_buffers(lines: DataFrame, key: str, points: str, half_width_m: float = K.BREAKWATER_HALF_WIDTH_M) -> DataFrame:
    """(key, points) -> (key, ring); `key` is unique. Lines without two different points give none, holes are filled.

    Distances are metres on the tangent plane at the line's middle latitude.
    """
    clean = G.without_repeats(F.filter(points, lambda p: p["x"].isNotNull() & p["y"].isNotNull()))
    usable = spread(lines.select(key, clean.alias("_line")).filter(F.size("_line") > 1), key).select(key, G.on_plane(F.col("_line")).alias("_plane"))
    there, back = _legs(F.col("_plane.points")), _legs(F.reverse("_plane.points"))
    legs = usable.select(key, F.col("_plane").dropFields("points").alias("_plane"), there.alias("_there"), back.alias("_back"))
    drawn = legs.select(key, "_plane", _with_turns("_there").alias("_there"), _with_turns("_back").alias("_back"))
    fitted = drawn.select("*", _bends_fit(half_width_m).alias("_fit"), _surely_fit(half_width_m).alias("_sure"))
    # Of lines that surely fit the ring is all that is used; of others the curve through the bends, too.
    drawn = store(fitted.select(
        key, "_plane", "_fit", "_sure", F.when(F.col("_fit"), _ring(half_width_m, False)).alias("_direct"),
        F.when(~F.col("_sure"), _ring(half_width_m, True)).alias("_curve"),
    ), "buffers")
    rings = drawn.filter("_sure").select(key, "_plane", F.col("_direct").alias("_ring"))
    unsure = drawn.filter("NOT _sure")
    if not unsure.isEmpty():
        fit = unsure.filter("_fit")
        knotted = store(ring_faults(fit.select(key, F.array("_direct").alias("_rings")), key, "_rings").select(key), "knotted")
        rings = rings.unionByName(fit.join(knotted, key, "left_anti").select(key, "_plane", F.col("_direct").alias("_ring")))
        others = unsure.filter("NOT _fit").unionByName(fit.join(knotted, key, "left_semi"))
        if not others.isEmpty():
            outer = _outer_rings(others.select(key, F.array("_curve").alias("_rings")), key)
            rings = rings.unionByName(others.select(key, "_plane").join(outer, key).select(key, "_plane", "_ring"))
    return rings.select(key, G.from_plane(F.col("_ring"), F.col("_plane")).alias("ring"))


def _outer_rings(curves: DataFrame, key: str) -> DataFrame:
    """(key, _ring): the largest ring around what a group's curves enclose."""
    edges = ring_edges(curves, key, "_rings")
    met = contacts(edges, key)
    cuts = _cuts(met, key)
    ends = F.array(G.point(F.col("x1"), F.col("y1")), G.point(F.col("x2"), F.col("y2")))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")

    def along(p: Column) -> Column:
        return F.struct(((p["x"] - F.col("x1")) * dx + (p["y"] - F.col("y1")) * dy).alias("t"), p["x"].alias("x"), p["y"].alias("y"))

    inner = F.coalesce(F.col("_cuts"), F.array().cast("array<struct<x:double,y:double>>"))
    stops = F.transform(F.array_sort(F.transform(F.array_distinct(F.concat(ends, inner)), along)), lambda p: G.point(p["x"], p["y"]))
    pieces = edges.join(cuts, [key, "ring", "edge"], "left").select(key, F.explode(G.edges(stops)).alias("_e"))
    start, end = G.point(F.col("_e.x1"), F.col("_e.y1")), G.point(F.col("_e.x2"), F.col("_e.y2"))
    # Pieces that lie on each other are one.
    single = pieces.select(key, F.least(start, end).alias("_p"), F.greatest(start, end).alias("_q")).distinct()
    ways = store(single.select(key, F.monotonically_increasing_id().alias("way"), F.array("_p", "_q").alias("points")), "pieces")
    ranked = stitched_rings(ways, key).select(key, F.struct(G.ring_area(F.col("ring")).alias("area"), "ring").alias("_r"))
    return ranked.groupBy(key).agg(F.max("_r").alias("_r")).select(key, F.col("_r.ring").alias("_ring"))


def _cuts(met: DataFrame, key: str) -> DataFrame:
    """(key, ring, edge, _cuts): the points at which an edge is cut."""
    both = met.select(key, "points", F.explode(F.array("a", "b")).alias("_at"))
    return both.groupBy(key, F.col("_at.ring").alias("ring"), F.col("_at.edge").alias("edge")).agg(
        F.flatten(F.collect_list("points")).alias("_cuts")
    )
