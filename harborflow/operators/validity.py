"""Which shapes are not valid areas, and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborflow.functions import geometry as G
from harborflow.operators.contacts import contacts, ring_edges
from harborflow.session import spread, store

# A zone is reported with the first one that applies.
FAULTS = ("empty", "crossing", "overlap", "spike", "self_touch")
_KEY = "_shape_key"
# Groups of up to so many points are looked at row by row, pair of edges by pair; the edges of larger ones are joined on cells.
SMALL_POINTS = 64


def _is_small(rings: Column) -> Column:
    return F.coalesce(F.size(F.flatten(rings)) <= SMALL_POINTS, F.lit(True))


def _side(e: Column, x: Column, y: Column) -> Column:
    return F.signum((e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"]))


def _pair_rank(a: Column, b: Column) -> Column:
    """Place among `FAULTS` of what two edges with boxes that meet do to their rings, as `_joined_faults` has it; null: nothing."""
    def on(side: Column, e: Column, x: Column, y: Column, point: Column) -> Column:
        within = x.between(e["x_min"], e["x_max"]) & y.between(e["y_min"], e["y_max"])
        return F.when((side == 0) & within, point)

    def rank(s: Column) -> Column:
        points = F.size(F.array_distinct(F.array_compact(F.array(*[
            on(s[side], e, f[x], f[y], G.point(f[x], f[y]))
            for side, e, f, x, y in (("b1", a, b, "x1", "y1"), ("b2", a, b, "x2", "y2"), ("a1", b, a, "x1", "y1"), ("a2", b, a, "x2", "y2"))
        ]))))
        one_ring = a["ring"] == b["ring"]
        follows = one_ring & ((b["edge"] == a["edge"] + 1) | ((a["edge"] == 0) & (b["edge"] == a["edges"] - 1)))
        met = F.when(points == 2, F.when(follows, FAULTS.index("spike") + 1).otherwise(FAULTS.index("overlap") + 1)).when(
            (points == 1) & one_ring & ~follows, FAULTS.index("self_touch") + 1
        )
        crosses = (s["b1"] * s["b2"] < 0) & (s["a1"] * s["a2"] < 0)
        return F.when(crosses, FAULTS.index("crossing") + 1).when(
            (s["b1"] * s["b2"] * s["a1"] * s["a2"]) == 0, met
        )

    sides = F.struct(
        _side(a, b["x1"], b["y1"]).alias("b1"), _side(a, b["x2"], b["y2"]).alias("b2"),
        _side(b, a["x1"], a["y1"]).alias("a1"), _side(b, a["x2"], a["y2"]).alias("a2"),
    )
    return F.get(F.transform(F.array(sides), rank), F.lit(0))


def _row_fault(rings: Column) -> Column:
    """The fault of a group of few rings with few edges, found in its row."""

    def numbered(ring: Column, r: Column) -> Column:
        edges = F.filter(G.edges(ring), lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]))
        return F.get(F.transform(F.array(edges), lambda es: F.transform(es, lambda e, i: F.struct(
            r.alias("ring"), i.alias("edge"), F.size(es).alias("edges"), *[G.boxed(e)[c].alias(c) for c in (
                "x1", "y1", "x2", "y2", "x_min", "x_max", "y_min", "y_max")],
        ))), F.lit(0))

    none = F.lit(len(FAULTS) + 1)

    def least(es: Column) -> Column:
        """Over each pair once; edges are listed in order."""

        def of_edge(a: Column, i: Column) -> Column:
            return F.aggregate(
                F.slice(es, i + 2, F.size(es)), none,
                lambda best, b: F.when(G.boxes_meet(a, b), F.least(best, F.coalesce(_pair_rank(a, b), none))).otherwise(best),
            )

        return F.array_min(F.transform(es, of_edge))

    rank = F.get(F.transform(F.array(F.flatten(F.transform(rings, numbered))), least), F.lit(0))
    return F.get(_ranks(), rank - 1)


def ring_faults(groups: DataFrame, key: str, rings: str) -> DataFrame:
    """(key, rings) -> (key, fault), one row per group of rings that has a fault.

    Groups of few points are looked at row by row, others by a join of their edges, see `_joined_faults`.
    """
    small = _is_small(F.col(rings))
    looked = store(spread(groups.select(key, F.when(small, F.col(rings)).alias("_few"), F.when(~small, F.col(rings)).alias("_many"))), "rings")
    found = looked.filter("_few IS NOT NULL").select(key, _row_fault(F.col("_few")).alias("fault")).filter(F.col("fault").isNotNull())
    many = looked.filter("_many IS NOT NULL").select(key, F.col("_many").alias(rings))
    return found if many.isEmpty() else found.unionByName(_joined_faults(many, key, rings))


def _joined_faults(groups: DataFrame, key: str, rings: str) -> DataFrame:
    """(key, rings) -> (key, fault), one row per group of rings that has a fault, by a join of edges on cells.

    crossing: two edges cut through each other. overlap: two edges lie on each other for a stretch; spike: they follow each other in
    their ring, which goes out and back. self_touch: a ring meets itself at a point. Different rings may touch at points.
    """
    met = contacts(ring_edges(groups, key, rings), key)
    a, b = F.col("a"), F.col("b")
    one_ring = a["ring"] == b["ring"]
    follows = one_ring & ((b["edge"] == a["edge"] + 1) | ((a["edge"] == 0) & (b["edge"] == a["edges"] - 1)))
    fault = (
        F.when(F.col("crosses"), "crossing").when((F.size("points") > 1) & follows, "spike").when(F.size("points") > 1, "overlap")
        .when(one_ring & ~follows, "self_touch")
    )
    rank = F.array_position(_ranks(), fault)
    found = met.select(key, rank.alias("_rank")).filter(F.col("_rank").isNotNull())
    return found.groupBy(key).agg(F.min("_rank").alias("_rank")).select(key, F.element_at(_ranks(), F.col("_rank").cast("int")).alias("fault"))


def _ranks() -> Column:
    return F.array(*[F.lit(f) for f in FAULTS])


def _keyed(zones: DataFrame) -> DataFrame:
    """Zones with a key of id and shape, since ids may repeat."""
    text = F.coalesce(F.to_json("shape"), F.lit(""))
    return zones.withColumn(_KEY, F.struct(F.coalesce("zone_id", F.lit("")).alias("id"), F.sha2(text, 256).alias("shape")))


def _drawn() -> Column:
    return G.all_rings(F.col("shape"), G.is_closed)


def _has_area() -> Column:
    return G.all_rings(F.col("shape"), lambda ring: G.ring_area(ring) > 0)


def _checked(zones: DataFrame) -> DataFrame:
    """Zones with `fault`: of those with few points found row by row, of others by joining edges, where equal zones are looked at once.

    Stored, since callers read it more than once and shapes may be long expressions.
    """
    dealt = store(spread(zones), "zones").withColumn("_few", _is_small(F.flatten("shape")))
    flaw = F.when(_drawn(), F.coalesce(F.when(F.col("_few"), _row_fault(F.flatten("shape"))), F.when(~_has_area(), "empty"))).otherwise("empty")
    looked = store(dealt.withColumn("fault", flaw), "zones")
    joined = ~F.col("_few") & F.coalesce(_drawn(), F.lit(False))
    many = looked.filter(joined)
    if many.isEmpty():
        return looked.drop("_few")
    keyed = store(_keyed(many.withColumnRenamed("fault", "_flat")), "zones")
    distinct = keyed.groupBy(_KEY).agg(F.first(F.flatten("shape")).alias("_rings"))
    faults = store(_joined_faults(distinct, _KEY, "_rings"), "faults")
    merged = keyed.join(faults, _KEY, "left").withColumn("fault", F.coalesce("fault", "_flat"))
    return store(looked.filter(~joined).unionByName(merged.drop(_KEY, "_flat")).drop("_few"), "zones")


def zone_faults(zones: DataFrame) -> DataFrame:
    """(zone_id, zone_type, fault): a row for every zone that is not valid; empty means a missing or open ring, or one without area.

    Holes outside their outer ring and parts inside one another are not looked for: the even-odd rule settles what they mean.
    """
    return _checked(zones).filter(F.col("fault").isNotNull()).select("zone_id", "zone_type", "fault")


def valid_zones(zones: DataFrame) -> DataFrame:
    return _checked(zones.filter(F.col("shape").isNotNull())).filter(F.col("fault").isNull()).drop("fault")
