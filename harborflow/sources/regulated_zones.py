"""Federal anchorages whose limits the regulation gives in full (33 CFR 110.214).

Coordinates are NAD 83 as printed and are taken as WGS 84: the two differ by about a metre here.
Anchorages N, P and Q are bounded by the shoreline and cannot be closed from the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from harborflow.sources.zones import anchorages_from_waypoints, circular_anchorages, merge_zones

# ---------------------------------------------------------------------------
# Corners and circles as printed in the regulation.
# ---------------------------------------------------------------------------

POLYGONS = [
    ("cfr-anchorage-b", "Commercial Anchorage B", "33 CFR 110.214(b)(2)", [
        ("33°-44′-37.0″ N", "118°-13′-00.0″ W"), ("33°-44′-12.0″ N", "118°-12′-36.2″ W"),
        ("33°-43′-38.2″ N", "118°-11′-36.9″ W"), ("33°-43′-26.1″ N", "118°-11′-47.2″ W"),
        ("33°-43′-26.1″ N", "118°-12′-22.7″ W"), ("33°-42′-58.9″ N", "118°-13′-53.0″ W"),
        ("33°-43′-46.0″ N", "118°-14′-13.6″ W"), ("33°-43′-54.5″ N", "118°-13′-50.0″ W"),
        ("33°-44′-22.8″ N", "118°-13′-51.0″ W"),
    ]),
    ("cfr-anchorage-c", "Commercial Anchorage C", "33 CFR 110.214(b)(3)", [
        ("33°-44′-20.0″ N", "118°-08′-26.2″ W"), ("33°-44′-23.5″ N", "118°-09′-32.6″ W"),
        ("33°-44′-52.8″ N", "118°-09′-33.2″ W"), ("33°-44′-25.2″ N", "118°-08′-26.2″ W"),
    ]),
    ("cfr-anchorage-d", "Commercial Anchorage D", "33 CFR 110.214(b)(4)", [
        ("33°-43′-27.2″ N", "118°-08′-12.6″ W"), ("33°-43′-27.2″ N", "118°-10′-46.5″ W"),
        ("33°-43′-51.0″ N", "118°-10′-46.5″ W"), ("33°-44′-18.5″ N", "118°-10′-27.2″ W"),
        ("33°-44′-18.5″ N", "118°-08′-12.6″ W"),
    ]),
    ("cfr-anchorage-e", "Commercial Anchorage E", "33 CFR 110.214(b)(5)", [
        ("33°-44′-37.0″ N", "118°-09′-48.5″ W"), ("33°-44′-18.5″ N", "118°-09′-56.8″ W"),
        ("33°-44′-18.5″ N", "118°-10′-27.2″ W"), ("33°-44′-27.6″ N", "118°-10′-41.0″ W"),
        ("33°-44′-29.0″ N", "118°-10′-57.4″ W"), ("33°-45′-06.4″ N", "118°-11′-09.5″ W"),
        ("33°-45′-15.2″ N", "118°-10′-46.1″ W"), ("33°-45′-11.0″ N", "118°-10′-32.0″ W"),
        ("33°-44′-52.0″ N", "118°-10′-32.0″ W"),
    ]),
    ("cfr-anchorage-f", "Commercial Anchorage F", "33 CFR 110.214(b)(6)", [
        ("33°43′05.1″ N", "118°08′04.0″ W"), ("33°43′05.0″ N", "118°10′32.5″ W"),
        ("33°42′13.3″ N", "118°09′54.8″ W"), ("33°40′51.3″ N", "118°09′32.2″ W"),
        ("33°38′36.2″ N", "118°07′43.8″ W"), ("33°40′44.4″ N", "118°06′51.4″ W"),
    ]),
    ("cfr-anchorage-g", "Commercial Anchorage G", "33 CFR 110.214(b)(7)", [
        ("33°43′05.4″ N", "118°11′17.9″ W"), ("33°43′05.4″ N", "118°12′18.6″ W"),
        ("33°42′25.8″ N", "118°14′19.2″ W"), ("33°40′50.4″ N", "118°13′01.2″ W"),
        ("33°41′02.9″ N", "118°12′19.0″ W"), ("33°42′10.8″ N", "118°11′36.0″ W"),
    ]),
]

# (zone, name, reference, centre, radius, unit)
CIRCLES = [
    ("cfr-anchorage-explosives", "Explosives Anchorage", "33 CFR 110.214(d)",
     "33°43′37.0″ N", "118°09′05.3″ W", 1745.0, "m"),
    ("cfr-anchorage-b-7", "Sub-Anchorage B-7", "33 CFR 110.214(a)(2)(i)(A)",
     "33-43′ 52.0″ N", "118-12′ 47.9″ W", 450.0, "yd"),
    ("cfr-anchorage-b-9", "Sub-Anchorage B-9", "33 CFR 110.214(a)(2)(i)(A)",
     "33-43′ 28.5″ N", "118-13′ 10.5″ W", 500.0, "yd"),
    ("cfr-anchorage-b-11", "Sub-Anchorage B-11", "33 CFR 110.214(a)(2)(i)(A)",
     "33-43′ 44.5″ N", "118-12′ 17″ W", 450.0, "yd"),
    ("cfr-anchorage-d-5", "Sub-Anchorage D-5", "33 CFR 110.214(a)(2)(i)(A)",
     "33-43′ 40.5′ N", "118-10′ 30″ W", 450.0, "yd"),
    ("cfr-anchorage-d-6", "Sub-Anchorage D-6", "33 CFR 110.214(a)(2)(i)(A)",
     "33-43′ 40.5′ N", "118-9′ 57.5″ W", 450.0, "yd"),
    ("cfr-anchorage-d-7", "Sub-Anchorage D-7", "33 CFR 110.214(a)(2)(i)(A)",
     "33-43′ 40.5′ N", "118-9′ 25″ W", 450.0, "yd"),
]


def regulated_anchorages(spark: SparkSession) -> DataFrame:
    waypoints = [
        (zone_id, name, ref, seq, lat, lon)
        for zone_id, name, ref, corners in POLYGONS for seq, (lat, lon) in enumerate(corners)
    ]
    return merge_zones([
        anchorages_from_waypoints(spark.createDataFrame(
            waypoints, "zone_id string, name string, source_ref string, seq int, lat_text string, lon_text string"
        )),
        circular_anchorages(spark.createDataFrame(
            CIRCLES,
            "zone_id string, name string, source_ref string, lat_text string, lon_text string, radius double, unit string",
        )),
    ])
