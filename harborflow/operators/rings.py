"""Closed rings out of open ways that meet at their ends.

Every way is two directed sides. A side that arrives at a point goes on with the next way leaving it, clockwise; following that
from side to side walks once around each face. Ways with the same face on both sides (dangling ends and ways between two rings)
are left out, and what remains is walked again: the faces then have a ring each, the outside has one walk around everything that
hangs together. Turning the other way at each point cuts the outside's walk where it touches itself, so it becomes the rings
around the union of the faces.

Walks are found by pointer jumping: after k joins every side knows the least side among the 2^k that follow it, and how far away
it is. Nothing is gathered but the ends at one point and the points of one ring.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harborflow.functions import geometry as G
from harborflow.session import store


def _sides(ways: DataFrame, group: str) -> DataFrame:
    """Both directions of every way: `side` numbers them (2n and 2n + 1), x and y say where it starts and angle how it leaves."""
    directed = ways.select(group, F.explode(F.array(
        F.struct((F.col("way") * 2).alias("side"), F.col("points")),
        F.struct((F.col("way") * 2 + 1).alias("side"), F.reverse("points").alias("points")),
    )).alias("s")).select(group, "s.side", "s.points")
    start, second = F.get("points", F.lit(0)), F.get("points", F.lit(1))
    return directed.select(
        group, "side", "points", start["x"].alias("x"), start["y"].alias("y"),
        F.atan2(second["y"] - start["y"], second["x"] - start["x"]).alias("angle"),
    )


def _next_sides(sides: DataFrame, group: str, clockwise: bool) -> DataFrame:
    """(group, side, ptr): the side that follows each side of `sides`, among these.

    At a point, a side arrives in the direction in which its opposite leaves, and a turn takes it to the nearest leaving side.
    """
    end, before = F.try_element_at("points", F.lit(-1)), F.try_element_at("points", F.lit(-2))
    leaving = sides.select(group, "x", "y", "angle", F.col("side").alias("tie"), F.lit(0).alias("kind"), "side")
    arriving = sides.select(
        group, end["x"].alias("x"), end["y"].alias("y"), F.atan2(before["y"] - end["y"], before["x"] - end["x"]).alias("angle"),
        F.col("side").bitwiseXOR(F.lit(1)).alias("tie"), F.lit(1).alias("kind"), "side",
    )
    out = F.when(F.col("kind") == 0, F.col("side"))
    at = W.partitionBy(group, "x", "y")
    turn = at.orderBy(F.col("angle").desc() if clockwise else F.col("angle").asc(), "tie", "kind")
    later = F.first(out, ignorenulls=True).over(turn.rowsBetween(1, W.unboundedFollowing))
    again = F.first(out, ignorenulls=True).over(turn.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    turned = leaving.unionByName(arriving).withColumn("ptr", F.coalesce(later, again))
    return turned.filter("kind = 1").select(group, "side", "ptr")


def _walks(sides: DataFrame, group: str, clockwise: bool) -> DataFrame:
    """`sides` with `walk`, the least side of the walk that a side is in, and `ahead`, how many sides before that one comes."""
    state = _next_sides(sides, group, clockwise).select(group, "side", "ptr", F.col("side").alias("walk"), F.lit(0).cast("long").alias("ahead"))
    state, span = store(state, "walks"), 1
    while True:
        there = state.select(group, F.col("side").alias("ptr"), F.col("ptr").alias("far"), F.col("walk").alias("w"), F.col("ahead").alias("d"))
        nearer = F.col("w") < F.col("walk")
        state = store(state.join(there, [group, "ptr"]).select(
            group, "side", F.col("far").alias("ptr"), F.least("walk", "w").alias("walk"),
            F.when(nearer, F.col("d") + span).otherwise(F.col("ahead")).alias("ahead"), nearer.alias("moved"),
        ), "walks")
        # Where no window of this length has a lesser side than the one before it, windows of all lengths agree.
        if state.filter("moved").isEmpty():
            return sides.join(state.select(group, "side", "walk", "ahead"), [group, "side"])
        state, span = state.drop("moved"), span * 2


def _rings(walked: DataFrame, group: str) -> DataFrame:
    """(group, walk, ring): the points of each walk's sides in order, closed."""
    order = F.struct((F.col("ahead") > 0).alias("later"), (-F.col("ahead")).alias("at"), F.slice("points", F.lit(1), F.size("points") - 1).alias("p"))
    points = F.flatten(F.transform(F.array_sort(F.collect_list(order)), lambda s: s["p"]))
    return walked.groupBy(group, "walk").agg(points.alias("points")).select(group, "walk", G.close_ring(F.col("points")).alias("ring"))


def stitched_rings(ways: DataFrame, group: str) -> DataFrame:
    """(group, way, points) -> (group, ring): the rings around what the ways of a group enclose together.

    `way` numbers the ways of a group. Ways meet at equal first and last points only and may run in any direction; a point may
    have any number of them. Ways that enclose nothing give no ring; a ring inside another one is given, too. A way with fewer
    than two different points in a row is left out, as are null points.
    """
    clean = ways.select(group, F.col("way").cast("long").alias("way"), G.without_repeats(F.col("points")).alias("points"))
    sides = store(_sides(clean.filter(F.size("points") >= 2), group), "sides")
    walked = _walks(sides, group, clockwise=True)
    both = W.partitionBy(group, F.shiftright("side", 1))
    firm = walked.withColumn("_l", F.min("walk").over(both)).withColumn("_h", F.max("walk").over(both)).filter("_l < _h")
    firm = store(firm.select(*sides.columns), "sides")
    walked = store(_walks(firm, group, clockwise=True), "faces")
    outside = _rings(walked, group).filter(G.signed_area(F.col("ring")) < 0).select(group, "walk")
    outer = store(walked.join(outside, [group, "walk"], "left_semi").select(*sides.columns), "sides")
    return _rings(_walks(outer, group, clockwise=False), group).select(group, "ring")
