"""Debounced vessel state and sustained disagreement with the reported status, as window scans.

Per vessel, in time order, rows fall into *tracks* (no silence longer than the expiry) and within a
track into *runs* of equal raw state. The first run of a track takes effect at once. Any later run takes
effect at its first row, after the opening one, that is at least `debounce` away from the run's start.
The state at a row is the last one that took effect. Comparable rows (reported status not OTHER) form
runs of agreement and disagreement in the same way; a disagreement is flagged after `discrepancy`
seconds and cleared by the next agreement. A track that another one follows ends in EXPIRED.

Every rule is "the latest earlier row with some property", i.e. `OrderedRows.scan`: one shuffle and one
sort by vessel and time serve all of them, and vessels with very many rows are scanned in segments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborflow import constants as K
from harborflow.functions.scalars import raw_state, reported_bucket
from harborflow.operators.ordered import OrderedRows, ordered_parts, run_on_parts
from harborflow.schemas import STATE_CHANGES

MICROS = 1_000_000


def observations(positions: DataFrame, tie: Sequence[str] = ("partition", "offset")) -> DataFrame:
    """The columns the state machine looks at. Rows without vessel or time cannot be ordered."""
    raw = raw_state(F.col("zone_type"), F.col("sog"))
    return positions.filter(F.col("mmsi").isNotNull() & F.col("event_time").isNotNull()).select(
        "mmsi", F.unix_micros("event_time").alias("t"), *tie,
        raw.alias("raw"),
        F.when(raw != K.UNDERWAY, F.col("zone_id")).alias("zone_id"),
        reported_bucket(F.col("nav_status_code")).alias("reported"),
    )


def _event(kind: str, at: Column, **fields: Column) -> Column:
    values = {"event_type": F.lit(kind), "transition_time": F.timestamp_micros(at), **fields}
    return F.struct(*[
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in STATE_CHANGES.fields if f.name != "mmsi"
    ])


def _transition(from_state: Column, to_state: Column, zone_id: Column, at: Column) -> Column:
    return _event(
        K.STATE_TRANSITION, at, from_state=from_state, to_state=to_state, zone_id=zone_id,
        derived_state=to_state,
    )


def _discrepancy(kind: str, at: Column) -> Column:
    return _event(kind, at, derived_state=F.col("state"), reported_status=F.col("reported"))


def _with_state(rows: OrderedRows, tie: Sequence[str], debounce: int, expiry: int) -> OrderedRows:
    t, row_id = F.col("t"), F.struct("t", *tie)

    rows = rows.scan(before={"prev": F.struct(row_id.alias("id"), "raw")})
    new_track = F.col("prev").isNull() | (t - F.col("prev.id.t") > expiry * MICROS)
    new_run = new_track | (F.col("prev.raw") != F.col("raw"))
    rows = rows.with_columns({"new_track": new_track, "new_run": new_run})

    rows = rows.scan(upto={
        "run": F.when(F.col("new_run"), row_id), "track": F.when(F.col("new_track"), row_id),
    })
    held = t - F.col("run.t") >= debounce * MICROS
    # The row before was too early to take effect: it opened the run, or had not been held long enough.
    held_first_now = (F.col("prev.id") == F.col("run")) | (
        F.col("prev.id.t") - F.col("run.t") < debounce * MICROS
    )
    later_run = ~F.col("new_run") & (F.col("run") != F.col("track"))
    rows = rows.with_columns({"takes_effect": F.col("new_track") | (later_run & held & held_first_now)})

    effective = F.when(F.col("takes_effect"), F.col("raw"))
    return rows.scan(before={"state_before": effective}, upto={"state": effective})


def _with_discrepancy(rows: OrderedRows, tie: Sequence[str], threshold: int) -> OrderedRows:
    t, row_id = F.col("t"), F.struct("t", *tie)
    comparable, agrees = F.col("reported") != K.OTHER, F.col("reported") == F.col("state")
    rows = rows.scan(before={
        "cmp": F.when(comparable, F.struct(row_id.alias("id"), agrees.alias("agrees"), "track"))
    })
    same_track = F.coalesce(F.col("cmp.track") == F.col("track"), F.lit(False))
    opens = comparable & ~(same_track & F.coalesce(F.col("cmp.agrees") == agrees, F.lit(False)))
    rows = rows.with_columns({
        "comparable": comparable, "agrees": agrees, "cmp_same_track": same_track, "cmp_opens": opens,
    })

    start = F.when(F.col("cmp_opens"), row_id)
    rows = rows.scan(before={"cmp_run_before": start}, upto={"cmp_run": start})

    limit = threshold * MICROS
    flags = (
        F.col("comparable") & ~F.col("agrees") & ~F.col("cmp_opens")
        & (t - F.col("cmp_run.t") >= limit)
        & ((F.col("cmp.id") == F.col("cmp_run")) | (F.col("cmp.id.t") - F.col("cmp_run.t") < limit))
    )
    clears = (
        F.col("comparable") & F.col("agrees") & F.col("cmp_opens") & F.col("cmp_same_track")
        & (F.col("cmp.id") != F.col("cmp_run_before"))
        & (F.col("cmp.id.t") - F.col("cmp_run_before.t") >= limit)
    )
    return rows.with_columns({"flags": flags, "clears": clears})


def _events(rows: OrderedRows, silent_at_end: Column) -> DataFrame:
    """Up to five events per row; `silent_at_end` is true on the last row of a vessel that has expired."""
    t = F.col("t")
    expired = F.when(
        F.col("new_track") & F.col("prev").isNotNull(),
        _transition(F.col("state_before"), F.lit(K.EXPIRED), F.lit(None), F.col("prev.id.t")),
    )
    from_state = F.when(F.col("new_track"), F.lit(K.UNKNOWN)).otherwise(F.col("state_before"))
    changed = F.when(
        F.col("takes_effect") & (from_state != F.col("raw")),
        _transition(from_state, F.col("raw"), F.col("zone_id"), t),
    )
    flagged = F.when(F.col("flags"), _discrepancy(K.DISCREPANCY_FLAGGED, t))
    cleared = F.when(F.col("clears"), _discrepancy(K.DISCREPANCY_CLEARED, t))
    ended = F.when(silent_at_end, _transition(F.col("state"), F.lit(K.EXPIRED), F.lit(None), t))
    events = F.array_compact(F.array(expired, changed, flagged, cleared, ended))
    return rows.df.select("mmsi", F.inline(events)).select(*STATE_CHANGES.names)


def state_changes(
    positions: DataFrame,
    *,
    debounce: int = K.DEBOUNCE_SECONDS,
    discrepancy: int = K.DISCREPANCY_SECONDS,
    expiry: int = K.EXPIRY_SECONDS,
    watermark: Column | None = None,
    tie: Sequence[str] = ("partition", "offset"),
    count_from: DataFrame | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """State transitions and discrepancy events of all vessels (schema `STATE_CHANGES`).

    `positions` need `zone_id`/`zone_type` of their best zone; (event_time, tie) must be unique per
    vessel. With `watermark`, vessels silent for `expiry` seconds at that instant get a final EXPIRED.

    A vessel yields at most one transition per `debounce` seconds and two discrepancy events per
    `discrepancy` seconds, so, unlike positions, its events are few enough for plain windows downstream.
    """
    if debounce <= 0 or discrepancy <= 0:
        raise ValueError("debounce and discrepancy must be positive")
    # Null vessels are left out, so their rows must not be counted as a hot key either.
    counted = None if count_from is None else count_from.filter(F.col("mmsi").isNotNull())
    parts = ordered_parts(
        observations(positions, tie), ["mmsi"], ["t", *tie], count_from=counted, max_rows=max_rows
    )

    def plan(part: OrderedRows) -> DataFrame:
        rows = _with_discrepancy(_with_state(part, tie, debounce, expiry), tie, discrepancy)
        if watermark is None:
            return _events(rows, F.lit(False))
        silent = F.unix_micros(watermark) >= F.col("t") + expiry * MICROS
        return _events(rows.mark_last("is_last"), F.col("is_last") & silent)

    return run_on_parts(parts, plan)


def vessel_timeline(
    positions: DataFrame, *, debounce: int = K.DEBOUNCE_SECONDS, expiry: int = K.EXPIRY_SECONDS,
    tie: Sequence[str] = ("partition", "offset"), count_from: DataFrame | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Every observation with its raw state and the debounced state after it."""
    parts = ordered_parts(
        observations(positions, tie), ["mmsi"], ["t", *tie], count_from=count_from, max_rows=max_rows
    )
    return run_on_parts(
        parts,
        lambda part: _with_state(part, tie, debounce, expiry).df.select(
            "mmsi", F.timestamp_micros("t").alias("event_time"), *tie, "raw", "state", "reported"
        ),
    )
