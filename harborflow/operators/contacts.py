"""Where the edges of a group of rings meet: an equi-join on the cells of a grid of the group's own.

The grid has about as many cells as the group has edges, and an edge is listed in the cells that it passes, not in all of its box. So
a ring of any size is spread over many tasks, and a cell holds few edges unless they lie on top of each other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborflow.functions import geometry as G

# Cells are widened by this share of their size, so that edges that touch on a cell's border share a cell.
_MARGIN = 1e-9
_ENDS = ("x1", "y1", "x2", "y2")


def ring_edges(groups: DataFrame, key: str, rings: str) -> DataFrame:
    """(key, rings) -> (key, ring, edge, edges, x1, y1, x2, y2) and the group's grid (_x, _y, _size).

    Edges are numbered in each ring, from 0; points that repeat the one before them have none.
    """
    clean = groups.select(key, F.transform(rings, lambda ring: G.edges(G.without_repeats(ring))).alias("_rings"))
    edges = F.flatten("_rings")
    xs = F.flatten(F.transform(edges, lambda e: F.array(e["x1"], e["x2"])))
    ys = F.flatten(F.transform(edges, lambda e: F.array(e["y1"], e["y2"])))
    wide = F.greatest(F.array_max(xs) - F.array_min(xs), F.array_max(ys) - F.array_min(ys))
    size = wide / F.ceil(F.sqrt(F.size(edges)))
    grid = clean.select(key, "_rings", F.array_min(xs).alias("_x"), F.array_min(ys).alias("_y"), size.alias("_size"))
    each = grid.filter("_size > 0").select(key, "_x", "_y", "_size", F.posexplode("_rings").alias("ring", "_edges"))
    return each.select(
        key, "_x", "_y", "_size", "ring", F.size("_edges").alias("edges"), F.posexplode("_edges").alias("edge", "_e")
    ).select(key, "ring", "edge", "edges", "_x", "_y", "_size", *[F.col(f"_e.{c}").alias(c) for c in _ENDS])


def _steps(low: Column, high: Column) -> Column:
    return F.explode(F.sequence(F.floor(low - _MARGIN), F.floor(high + _MARGIN)))


def _in_cells(edges: DataFrame) -> DataFrame:
    """One row per edge and cell it passes: column by column, the rows between its heights at the column's sides."""
    u1, u2 = (F.col("x1") - F.col("_x")) / F.col("_size"), (F.col("x2") - F.col("_x")) / F.col("_size")
    v1, v2 = (F.col("y1") - F.col("_y")) / F.col("_size"), (F.col("y2") - F.col("_y")) / F.col("_size")
    left, right = F.least(u1, u2), F.greatest(u1, u2)
    columns = edges.withColumn("_cx", _steps(left, right))

    def height(u: Column) -> Column:
        """Height of the edge at `u`, where its ends are kept to exactly; an upright edge has both."""
        return F.greatest(F.least(F.try_divide((u - u1) * (v2 - v1), u2 - u1) + v1, F.greatest(v1, v2)), F.least(v1, v2))

    start, end = F.greatest(F.col("_cx").cast("double"), left), F.least(F.col("_cx") + F.lit(1.0), right)
    low, high = F.least(height(start), height(end)), F.greatest(height(start), height(end))
    upright = u1 == u2
    return columns.withColumn("_cy", _steps(
        F.when(upright, F.least(v1, v2)).otherwise(low), F.when(upright, F.greatest(v1, v2)).otherwise(high)
    ))


def _side(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    return F.signum((bx - ax) * (py - ay) - (by - ay) * (px - ax))


def _within(e: str, px: Column, py: Column) -> Column:
    x1, y1, x2, y2 = (F.col(f"{e}.{c}") for c in _ENDS)
    return px.between(F.least(x1, x2), F.greatest(x1, x2)) & py.between(F.least(y1, y2), F.greatest(y1, y2))


def contacts(edges: DataFrame, key: str) -> DataFrame:
    """(key, a, b, crosses, points): pairs of edges of a group that have a point in common, each pair once.

    a and b are structs (ring, edge, edges), a the lesser. `crosses` says that the edges cut through each other in the interior of
    both; otherwise an end of one lies on the other, at one point, or at two where they lie on each other for a stretch.
    """
    cells = _in_cells(edges)
    a = cells.alias("a")
    b = cells.alias("b")
    ax1, ay1, ax2, ay2 = (F.col(f"a.{c}") for c in _ENDS)
    bx1, by1, bx2, by2 = (F.col(f"b.{c}") for c in _ENDS)
    of_b1, of_b2 = _side(ax1, ay1, ax2, ay2, bx1, by1), _side(ax1, ay1, ax2, ay2, bx2, by2)
    of_a1, of_a2 = _side(bx1, by1, bx2, by2, ax1, ay1), _side(bx1, by1, bx2, by2, ax2, ay2)
    crosses = (of_b1 * of_b2 < 0) & (of_a1 * of_a2 < 0)
    ends = [
        ((of_b1 == 0) & _within("a", bx1, by1), G.point(bx1, by1)), ((of_b2 == 0) & _within("a", bx2, by2), G.point(bx2, by2)),
        ((of_a1 == 0) & _within("b", ax1, ay1), G.point(ax1, ay1)), ((of_a2 == 0) & _within("b", ax2, ay2), G.point(ax2, ay2)),
    ]
    touches = reduce(Column.__or__, [on for on, _ in ends])
    along = F.try_divide(
        (bx1 - ax1) * (by2 - by1) - (by1 - ay1) * (bx2 - bx1), (ax2 - ax1) * (by2 - by1) - (ay2 - ay1) * (bx2 - bx1)
    )
    cut = G.point(ax1 + along * (ax2 - ax1), ay1 + along * (ay2 - ay1))
    on_ends = F.array_distinct(F.array_compact(F.array(*[F.when(on, p) for on, p in ends])))
    earlier = (F.col("a.ring") < F.col("b.ring")) | ((F.col("a.ring") == F.col("b.ring")) & (F.col("a.edge") < F.col("b.edge")))
    same_cell = reduce(Column.__and__, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in (key, "_cx", "_cy")])
    met = a.join(b.hint("merge"), same_cell & earlier & (crosses | touches)).select(
        F.col(f"a.{key}").alias(key), *[F.struct(*[F.col(f"{e}.{c}") for c in ("ring", "edge", "edges")]).alias(e) for e in "ab"],
        crosses.alias("crosses"), F.when(crosses, F.array(cut)).otherwise(on_ends).alias("points"),
    )
    # Edges meet again in every cell that both pass.
    return met.groupBy(key, "a", "b").agg(F.first("crosses").alias("crosses"), F.first("points").alias("points"))
