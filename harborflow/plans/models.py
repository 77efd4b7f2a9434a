"""Sessions, visits, dwell, activity, discrepancy episodes, vessels.

The inputs here are state changes. They are bounded per vessel (see `state_changes`), so plain windows
by vessel are safe; exact copies from replays are removed by an aggregate before any window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborflow import constants as K
from harborflow.functions.scalars import boundary_diff, surrogate_key, trimmed
from harborflow.operators.dedup import pick_one


def _now(as_of: Column | None) -> Column:
    return F.current_timestamp() if as_of is None else as_of


# --- staging ------------------------------------------------------------------


def staged_positions(silver: DataFrame) -> DataFrame:
    return silver.select(
        "mmsi", "event_time", "event_date", "lat", "lon", "sog", "nav_status_code",
        "zone_id", "zone_type", "zone_name", "ingested_at",
    )


def staged_state_changes(changes: DataFrame) -> DataFrame:
    return changes.select(
        "mmsi", "event_type", "from_state", "to_state", "zone_id", "derived_state", "reported_status",
        "transition_time",
    )


def staged_ship_static(static: DataFrame) -> DataFrame:
    return static.select(
        "mmsi", "ship_name", "call_sign", "ship_type_code", "destination", "imo_number",
        "max_static_draught", "ingested_at",
    )


# --- models -------------------------------------------------------------------


def zones_lookup(silver: DataFrame) -> DataFrame:
    """Every zone ever matched, with its type and name."""
    return silver.filter(F.col("zone_id").isNotNull()).select("zone_id", "zone_type", "zone_name").distinct()


def vessel_sessions(changes: DataFrame, zones: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Intervals between transitions. EXPIRED closes the session before it but is none itself.

    EXPIRED sorts last among transitions of one instant: it is set at the vessel's last position.
    """
    transitions = (
        changes.filter(F.col("event_type") == K.STATE_TRANSITION)
        .select("mmsi", F.col("to_state").alias("state"), "zone_id", F.col("transition_time").alias("session_start"))
        .distinct()
    )
    in_order = Window.partitionBy("mmsi").orderBy("session_start", F.col("state") == K.EXPIRED, "state", "zone_id")
    sessions = transitions.withColumn("session_end", F.lead("session_start").over(in_order)).filter(
        F.col("state") != K.EXPIRED
    )
    # No hint: Catalyst broadcasts the lookup while it is small.
    return sessions.join(zones, "zone_id", "left").select(
        surrogate_key(F.col("mmsi"), F.col("session_start")).alias("session_id"),
        "mmsi", "state", "zone_id", "zone_type", "zone_name", "session_start", "session_end",
        boundary_diff("second", F.col("session_start"), F.coalesce("session_end", _now(as_of)))
        .alias("session_duration_seconds"),
        F.col("session_end").isNull().alias("is_ongoing"),
    )


def berth_visits(sessions: DataFrame) -> DataFrame:
    return sessions.filter((F.col("state") == K.MOORED) & (F.col("zone_type") == "berth")).select(
        F.col("session_id").alias("berth_visit_id"), "mmsi",
        F.col("zone_id").alias("berth_id"), F.col("zone_name").alias("berth_name"),
        F.col("session_start").alias("arrival_time"), F.col("session_end").alias("departure_time"),
        "session_duration_seconds", "is_ongoing",
    )


def anchorage_dwell(sessions: DataFrame) -> DataFrame:
    """Stays in anchorages and whether the vessel's next session was at a berth (null: none yet)."""
    in_order = Window.partitionBy("mmsi").orderBy("session_start", "state", "zone_id")
    followed = sessions.withColumns({
        "_next_state": F.lead("state").over(in_order), "_next_type": F.lead("zone_type").over(in_order),
    })
    return followed.filter((F.col("state") == K.AT_ANCHOR) & (F.col("zone_type") == "anchorage")).select(
        F.col("session_id").alias("anchorage_dwell_id"), "mmsi",
        F.col("zone_id").alias("anchorage_id"), F.col("zone_name").alias("anchorage_name"),
        F.col("session_start").alias("arrival_time"), F.col("session_end").alias("departure_time"),
        F.col("session_duration_seconds").alias("dwell_seconds"), "is_ongoing",
        ((F.col("_next_state") == K.MOORED) & (F.col("_next_type") == "berth")).alias("proceeded_to_berth"),
    )


def daily_activity(sessions: DataFrame, *, split_at_midnight: bool = False) -> DataFrame:
    """Closed sessions per vessel, day and state.

    A session counts for the day it starts; with `split_at_midnight` its seconds (and a count of one)
    go to every day it touches.
    """
    closed = sessions.filter(F.col("session_end").isNotNull())
    start_day, seconds = F.to_date("session_start"), F.col("session_duration_seconds")
    if split_at_midnight:
        # A session ending at midnight does not touch the day that begins there.
        last = F.greatest(F.to_date(F.col("session_end") - F.expr("INTERVAL 1 MICROSECOND")), start_day)
        closed = closed.withColumn("_day", F.explode(F.sequence(start_day, last)))
        start_day = F.col("_day")
        day_begins = F.col("_day").cast("timestamp")
        seconds = boundary_diff(
            "second",
            F.greatest("session_start", day_begins),
            F.least("session_end", F.date_add("_day", 1).cast("timestamp")),
        )
    return (
        closed.select("mmsi", start_day.alias("activity_date"), "state", seconds.alias("_seconds"))
        .groupBy("mmsi", "activity_date", "state")
        .agg(F.count(F.lit(1)).alias("session_count"), F.sum("_seconds").alias("total_duration_seconds"))
    )


def discrepancy_episodes(
    changes: DataFrame, as_of: Column | None = None, *, bound_by_next_flag: bool = False
) -> DataFrame:
    """Each flag with the first later clear of the vessel.

    A vessel whose state expired while flagged emits no clear, so the flag is paired with the clear of
    a later episode; `bound_by_next_flag` leaves such a flag open at the next one instead.
    """
    flagged = F.col("event_type") == K.DISCREPANCY_FLAGGED
    events = (
        changes.filter(F.col("event_type").isin(K.DISCREPANCY_FLAGGED, K.DISCREPANCY_CLEARED))
        .select(
            "mmsi", "event_type", "transition_time",
            F.when(flagged, F.col("derived_state")).alias("derived_state"),
            F.when(flagged, F.col("reported_status")).alias("reported_status"),
        )
        .distinct()
    )
    later = (
        Window.partitionBy("mmsi").orderBy(F.unix_micros("transition_time"))
        .rangeBetween(1, Window.unboundedFollowing)
    )
    cleared_at = F.min(F.when(~flagged, F.col("transition_time"))).over(later)
    paired = events.withColumn("cleared_at", cleared_at)
    if bound_by_next_flag:
        paired = paired.withColumn("_next", F.min(F.when(flagged, F.col("transition_time"))).over(later))
        kept = F.col("_next").isNull() | (F.col("cleared_at") <= F.col("_next"))
        paired = paired.withColumn("cleared_at", F.when(kept, F.col("cleared_at")))
    return paired.filter(flagged).select(
        surrogate_key(F.col("mmsi"), F.col("transition_time")).alias("discrepancy_event_id"),
        "mmsi", "derived_state", "reported_status", F.col("transition_time").alias("flagged_at"), "cleared_at",
        boundary_diff("second", F.col("transition_time"), F.coalesce("cleared_at", _now(as_of)))
        .alias("duration_seconds"),
        F.col("cleared_at").isNull().alias("is_ongoing"),
    )


def dim_vessels(static: DataFrame, tie: str | None = None) -> DataFrame:
    """Latest static data per vessel; without a tie column equal times are settled by the values."""
    settle = ["ingested_at", *([tie] if tie else [c for c in static.columns if c not in ("mmsi", "ingested_at")])]
    latest = pick_one(static, ["mmsi"], settle, last=True)
    return latest.select(
        "mmsi", trimmed(F.col("ship_name")).alias("ship_name"), trimmed(F.col("call_sign")).alias("call_sign"),
        "ship_type_code", trimmed(F.col("destination")).alias("destination"), "imo_number",
        "max_static_draught", F.col("ingested_at").alias("last_seen_at"),
    )


def at_anchor_now(dwell: DataFrame, vessels: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Vessels at anchor, longest stay first."""
    return (
        dwell.filter("is_ongoing").join(vessels.select("mmsi", "ship_name"), "mmsi", "left")
        .select(
            "mmsi", "ship_name", "anchorage_name", "arrival_time",
            boundary_diff("minute", F.col("arrival_time"), _now(as_of)).alias("minutes_at_anchor"),
        )
        .orderBy("arrival_time", "mmsi")
    )


def ships_at_anchor(snapshot: DataFrame) -> DataFrame:
    return snapshot.agg(F.count(F.lit(1)).alias("ships_at_anchor"))


def presented(snapshot: DataFrame) -> DataFrame:
    """Column titles for display."""
    return snapshot.withColumnsRenamed({
        "mmsi": "MMSI", "ship_name": "Ship", "anchorage_name": "Anchorage", "arrival_time": "Arrived",
        "minutes_at_anchor": "Minutes at anchor",
    })


def zone_occupancy(best: DataFrame) -> DataFrame:
    """Positions and distinct vessels per zone; the null zone is open water."""
    return best.groupBy("zone_id", "zone_type").agg(
        F.count(F.lit(1)).alias("positions"), F.count_distinct("mmsi").alias("vessels")
    )


def match_summary(best: DataFrame) -> DataFrame:
    """Matched and total positions, counted by distinct (mmsi, lat, lon) for the matched."""
    matched = F.col("zone_id").isNotNull()
    return best.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(matched).alias("matched"),
        F.count_distinct(F.when(matched, F.struct("mmsi", "lat", "lon"))).alias("matched_distinct"),
    )


def vessel_zones(best: DataFrame) -> DataFrame:
    """Which vessels were seen in which zones."""
    return best.filter(F.col("zone_id").isNotNull()).select("mmsi", "zone_id", "zone_type", "zone_name").distinct()
