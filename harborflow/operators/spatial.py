"""Point-in-zone joins and zone overlap.

An index covers every zone with cells of a quadtree whose tiers are a factor of four apart. A zone starts on the tier of its
extent, so it touches at most 25 cells there, whatever its size. Cells wholly inside keep no edge, cells outside are not
stored, and cells on the border keep the edges that touch them and whether their lower left corner is inside; those with many
edges, or shared by many zones, are cut again. So rows grow with a zone's border, not with its area, and no row holds a
whole zone. Points meet cells by one equi-join a tier. Every tier is measured when the index is built: a small one is
broadcast, a large one is joined by shuffle, where AQE splits crowded cells.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborflow import constants as K
from harborflow.functions import geometry as G
from harborflow.operators.validity import valid_zones
from harborflow.functions.scalars import zone_priority
from harborflow.session import spread, store

# Powers of two, so that cells, corners and halves are exact; the smallest is about 25 m.
SIZES = tuple(4.0**k for k in range(4, -7, -1))
# Cells with more edges of a zone are cut; so are cells on the border of more zones, up to so many tiers below the zone's own.
CELL_EDGES = 16
CELL_ZONES = 64
CROWDED_TIERS = 2
# Tiers whose cells and edges, counted together, stay below this (about 32 MB) are broadcast.
MAX_BROADCAST_EDGES = 1_000_000

_KEY = ["_tier", "_cell_x", "_cell_y"]
_BEST = ["zone_id", "zone_type", "zone_authority", "zone_name"]
_LAST = len(SIZES) - 1


def _size(tier: Column) -> Column:
    return F.get(F.array(*[F.lit(s) for s in SIZES]), tier)


def _cell(value: Column, size: Column | float) -> Column:
    return F.floor(value / (F.lit(size) if isinstance(size, float) else size)).cast("long")


def _tier_of(box: Column) -> Column:
    """The tier with the largest cells that are not larger than the box."""
    extent = F.greatest(box["x_max"] - box["x_min"], box["y_max"] - box["y_min"])
    return F.coalesce(*[F.when(extent >= s, F.lit(i)) for i, s in enumerate(SIZES)], F.lit(_LAST))


@dataclass(frozen=True)
class Tier:
    """Cells of one size: `lists` has one row a cell with all its zones. `small` says that it was measured to be fit for a broadcast."""

    size: float
    lists: DataFrame
    small: bool


@dataclass(frozen=True)
class ZoneIndex:
    """Zones prepared for lookup and stored, so that no query or micro-batch prepares them again.

    `cells` has one row per zone and cell of its cover, `tiers` the same by cell, for every cell size in use.
    """

    cells: DataFrame
    tiers: tuple[Tier, ...]

    @property
    def small(self) -> bool:
        return all(tier.small for tier in self.tiers)


def zone_index(
    zones: DataFrame, priorities: Mapping[str, int] = K.ZONE_PRIORITY, max_broadcast_edges: int = MAX_BROADCAST_EDGES
) -> ZoneIndex:
    # A cover takes time, not bytes: zones are dealt out evenly.
    prepared = spread(zones).select(
        "zone_id", "zone_type", F.col("authority").alias("zone_authority"), F.col("name").alias("zone_name"),
        zone_priority(F.col("zone_type"), priorities).alias("_priority"),
        G.shape_area(F.col("shape")).alias("_area"), G.shape_edges(F.col("shape")).alias("_edges"),
        G.shape_bbox(F.col("shape")).alias("_box"),
    )
    cells = _cover(prepared)
    entry = F.struct("_priority", "_area", *_BEST, "_corner", "_edges")
    listed = store(cells.groupBy(*_KEY).agg(F.collect_list(entry).alias("_zones")), "zone-lists")
    weight = F.sum(F.aggregate("_zones", F.lit(0), lambda n, z: n + 1 + F.size(z["_edges"])))
    weights = {r["_tier"]: r["n"] for r in listed.groupBy("_tier").agg(weight.alias("n")).collect()}
    tiers = []
    for i in sorted(weights):
        small = weights[i] <= max_broadcast_edges
        lists = listed.filter(F.col("_tier") == i).select("_cell_x", "_cell_y", "_zones")
        tiers.append(Tier(SIZES[i], lists.coalesce(1) if small else lists, small))
    return ZoneIndex(cells, tuple(tiers))


def _corner(axis: str, size: Column) -> Column:
    return F.col(f"_cell_{axis}") * size


def _touching(size: Column) -> Column:
    """Edges that touch the cell, widened a little so that rounding at its border never loses one."""
    half = size * (0.5 + 1 / 1024)
    x, y = _corner("x", size) + size / 2, _corner("y", size) + size / 2

    def touches(e: Column) -> Column:
        near = (
            (F.greatest(e["x1"], e["x2"]) >= x - half) & (F.least(e["x1"], e["x2"]) <= x + half)
            & (F.greatest(e["y1"], e["y2"]) >= y - half) & (F.least(e["y1"], e["y2"]) <= y + half)
        )
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        return near & (F.abs(dx * (y - e["y1"]) - dy * (x - e["x1"])) <= (F.abs(dx) + F.abs(dy)) * half)

    return F.filter("_edges", touches)


def _cover(zones: DataFrame) -> DataFrame:
    """One row per zone and cell that it touches, cut as long as a cell is too full."""
    box, size = F.col("_box"), _size(F.col("_tier"))
    first = zones.withColumn("_tier", _tier_of(box)).withColumn("_depth", F.lit(0))
    for axis in ("x", "y"):
        first = first.withColumn(f"_cell_{axis}", F.explode(F.sequence(_cell(box[f"{axis}_min"], size), _cell(box[f"{axis}_max"], size))))
    whole = first.drop("_box").withColumn("_corner", G.inside(F.col("_edges"), _corner("x", size), _corner("y", size)))
    cells = store(_kept(whole.withColumn("_edges", _touching(size))), "zone-cells")
    while True:
        border = cells.filter((F.size("_edges") > 0) & (F.col("_tier") < _LAST))
        shared = border.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > CELL_ZONES)
        full = F.size("_edges") > CELL_EDGES
        crowded = F.col("_n").isNotNull() & (F.col("_depth") < CROWDED_TIERS)
        marked = cells.join(shared, _KEY, "left").withColumn(
            "_cut", (F.col("_tier") < _LAST) & (F.size("_edges") > 0) & (full | crowded)
        ).drop("_n")
        if marked.filter("_cut").isEmpty():
            return cells
        cells = store(marked.filter(~F.col("_cut")).drop("_cut").unionByName(_parts(marked.filter("_cut").drop("_cut"))), "zone-cells")


def _kept(cells: DataFrame) -> DataFrame:
    return cells.filter((F.size("_edges") > 0) | F.col("_corner"))


def _parts(cells: DataFrame) -> DataFrame:
    """The sixteen cells that each cell consists of."""
    size = _size(F.col("_tier"))
    parts = cells.withColumns({"_from_x": _corner("x", size), "_from_y": _corner("y", size), "_tier": F.col("_tier") + 1, "_depth": F.col("_depth") + 1})
    for axis in ("x", "y"):
        steps = F.array(*[F.col(f"_cell_{axis}") * 4 + i for i in range(4)])
        parts = parts.withColumn(f"_cell_{axis}", F.explode(steps))
    corner = G.inside_from(
        F.col("_edges"), F.col("_corner"), F.col("_from_x"), F.col("_from_y"), _corner("x", size), _corner("y", size)
    )
    parts = parts.withColumn("_corner", corner).drop("_from_x", "_from_y")
    return _kept(parts.withColumn("_edges", _touching(size)))


def _holds(size: float, x: Column, y: Column):
    """Whether an entry of the list of the point's cell contains the point."""
    from_x, from_y = _cell(x, size) * size, _cell(y, size) * size
    return lambda z: G.contains_from(z["_edges"], z["_corner"], from_x, from_y, x, y)


def _with_hits(positions: DataFrame, index: ZoneIndex, lon: str, lat: str) -> tuple[DataFrame, Column]:
    """Positions joined with their cells, and the array of zones that contain them."""
    found, hits = positions, []
    x, y = F.col(lon), F.col(lat)
    for i, tier in enumerate(index.tiers):
        side = tier.lists.select(F.col("_cell_x").alias(f"_x{i}"), F.col("_cell_y").alias(f"_y{i}"), F.col("_zones").alias(f"_zones{i}"))
        same = (_cell(x, tier.size) == F.col(f"_x{i}")) & (_cell(y, tier.size) == F.col(f"_y{i}"))
        found = found.join(F.broadcast(side) if tier.small else side, same, "left")
        fields = ["_priority", "_area", *_BEST]
        hits.append(F.transform(F.filter(f"_zones{i}", _holds(tier.size, x, y)), lambda z: F.struct(*[z[c].alias(c) for c in fields])))
    return found, F.flatten(F.array_compact(F.array(*hits))) if hits else F.array()


def _no_zone(positions: DataFrame, more: list[str]) -> DataFrame:
    kinds = {"_priority": "int", "_area": "double"}
    return positions.select(*positions.columns, *[F.lit(None).cast(kinds.get(c, "string")).alias(c) for c in more])


def match_zones(positions: DataFrame, index: ZoneIndex, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Left join: one row per position and zone containing it, positions outside all zones kept once."""
    columns = [*_BEST, "_priority", "_area"]
    if not index.tiers:
        return _no_zone(positions, columns)
    found, hits = _with_hits(positions, index, lon, lat)
    return found.select(*positions.columns, F.explode_outer(hits).alias("_hit")).select(
        *positions.columns, *[F.col(f"_hit.{c}").alias(c) for c in columns]
    )


def best_zone(positions: DataFrame, index: ZoneIndex, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Each row of `positions` once, with the zone of lowest (priority, area, zone_id) that contains it.

    A lookup per row in its cells' lists, on a batch or a stream; rows need no key and are never merged.
    """
    if not index.tiers:
        return _no_zone(positions, _BEST)
    found, hits = _with_hits(positions, index, lon, lat)
    return found.select(*positions.columns, F.array_min(hits).alias("_best")).select(
        *positions.columns, *[F.col(f"_best.{c}").alias(c) for c in _BEST]
    )


def _box_cells(boxes: DataFrame, tiers: Column) -> DataFrame:
    """One row per zone, tier of `tiers` and cell of that tier that its box touches."""
    box, size = F.col("_box"), _size(F.col("_tier"))
    out = boxes.withColumn("_tier", F.explode(tiers))
    for axis in ("x", "y"):
        out = out.withColumn(f"_cell_{axis}", F.explode(F.sequence(_cell(box[f"{axis}_min"], size), _cell(box[f"{axis}_max"], size))))
    return out


def zone_overlaps(zones: DataFrame, allowed: DataFrame | None = None, min_area: float = 0.0) -> DataFrame:
    """Unordered pairs of zones sharing more than `min_area`, except allowed pairs.

    Same type: error; different types: warning. Zones that merely touch do not overlap, and zones whose shape is not valid
    (`operators.validity`) take no part. Boxes meet on cells of the tier of the larger one, of which each touches at most 25. A pair is reported
    from one cell only, the one holding the lower left corner of the boxes' intersection, so no later deduplication is
    needed; the join itself emits only pairs whose boxes intersect.
    """
    boxed = valid_zones(zones).select(
        "zone_id", "zone_type", "shape", G.shape_bbox(F.col("shape")).alias("_box")
    )
    slim = boxed.select("zone_id", "_box", _tier_of(F.col("_box")).alias("_own"))
    # Pairs meet on the larger zone's tier: cells of tiers that no zone starts on hold all zones of a region for nothing.
    used = F.array(*[F.lit(r["_own"]) for r in slim.select("_own").distinct().collect()]).cast("array<int>")
    # Catalyst cannot foresee how many cells a zone touches: never broadcast this side by estimate.
    a = _box_cells(slim, F.array("_own")).alias("a")
    b = _box_cells(slim, F.filter(used, lambda tier: tier <= F.col("_own"))).hint("merge").alias("b")
    corner_x = F.greatest(F.col("a._box.x_min"), F.col("b._box.x_min"))
    corner_y = F.greatest(F.col("a._box.y_min"), F.col("b._box.y_min"))
    size = _size(F.col("a._tier"))
    pairs = a.join(
        b,
        reduce(lambda p, q: p & q, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in _KEY])
        # Of zones on one tier the lesser id is the first; otherwise it is the larger zone.
        & ((F.col("a._own") < F.col("b._own")) | (F.col("a.zone_id") < F.col("b.zone_id")))
        & (corner_x < F.least(F.col("a._box.x_max"), F.col("b._box.x_max")))
        & (corner_y < F.least(F.col("a._box.y_max"), F.col("b._box.y_max")))
        & (_cell(corner_x, size) == F.col("a._cell_x"))
        & (_cell(corner_y, size) == F.col("a._cell_y")),
    ).select(
        F.least("a.zone_id", "b.zone_id").alias("zone_a"), F.greatest("a.zone_id", "b.zone_id").alias("zone_b")
    )
    if allowed is not None:
        listed = allowed.select(F.least("zone_a", "zone_b").alias("zone_a"), F.greatest("zone_a", "zone_b").alias("zone_b"))
        pairs = pairs.join(listed, ["zone_a", "zone_b"], "left_anti")

    def side(name: str) -> DataFrame:
        return boxed.select(
            F.col("zone_id").alias(f"zone_{name}"), F.col("zone_type").alias(f"type_{name}"),
            F.col("shape").alias(f"_shape_{name}"),
        )

    # Emitting zero or one row keeps the area from being evaluated again by a filter.
    area = G.overlap_area(F.col("_shape_a"), F.col("_shape_b"))
    real = F.filter(F.array(area), lambda v: v > min_area)
    # Areas take time, not bytes: pairs are dealt out evenly.
    both = store(spread(pairs.join(side("a"), "zone_a").join(side("b"), "zone_b")), "pairs")
    return both.select(
        "zone_a", "type_a", "zone_b", "type_b", F.explode(real).alias("overlap_area"),
        F.when(F.col("type_a") == F.col("type_b"), "error").otherwise("warning").alias("severity"),
    )
