"""Small builders and the state-machine scenarios shared by the batch and streaming tests."""

from __future__ import annotations

import datetime as dt

from harborflow import constants as K

T0 = dt.datetime(2026, 7, 15, 12, 0)
ANCHORAGE = ("anchorage", "cfr-anchorage-b")
BERTH = ("berth", "osm-way-1")
OPEN = (None, None)


def at(minute: float) -> dt.datetime:
    return T0 + dt.timedelta(minutes=minute)


def obs(minute: float, zone=OPEN, sog: float | None = 0.2, code: int | None = 15):
    """(minute, zone, sog, nav status code)"""
    return (minute, zone, sog, code)


def transition(minute, before, after, zone=None):
    return (K.STATE_TRANSITION, before, after, zone, after, None, at(minute))


def flagged(minute, derived, reported):
    return (K.DISCREPANCY_FLAGGED, None, None, None, derived, reported, at(minute))


def cleared(minute, derived, reported):
    return (K.DISCREPANCY_CLEARED, None, None, None, derived, reported, at(minute))


_ADOPTED = transition(0, "UNKNOWN", "AT_ANCHOR", ANCHORAGE[1])
_DISAGREEING = [obs(0, ANCHORAGE, 0.1, 1)] + [obs(m, ANCHORAGE, 0.1, 0) for m in range(1, 17)]

SCENARIOS = {
    "first_observation_is_adopted": ([obs(0, ANCHORAGE)], [_ADOPTED]),
    "speed_jitter_changes_nothing": (
        [obs(0, ANCHORAGE)] + [obs(m, ANCHORAGE, 0.2 if m % 2 == 0 else 0.6) for m in range(1, 21)], [_ADOPTED],
    ),
    "change_takes_effect_after_five_minutes": (
        [obs(0, ANCHORAGE)] + [obs(m, OPEN, 8.0) for m in range(1, 7)],
        [_ADOPTED, transition(6, "AT_ANCHOR", "UNDERWAY")],
    ),
    "five_minutes_are_not_reached": ([obs(0, ANCHORAGE)] + [obs(m, OPEN, 8.0) for m in range(1, 6)], [_ADOPTED]),
    "berth_then_anchorage": (
        [obs(0, BERTH, 0.1)] + [obs(m, ANCHORAGE, 0.1) for m in range(1, 7)],
        [transition(0, "UNKNOWN", "MOORED", BERTH[1]), transition(6, "MOORED", "AT_ANCHOR", ANCHORAGE[1])],
    ),
    "disagreement_is_flagged_once": (
        [*_DISAGREEING, obs(17, ANCHORAGE, 0.1, 0)], [_ADOPTED, flagged(16, "AT_ANCHOR", "UNDERWAY")],
    ),
    "agreement_clears": (
        [*_DISAGREEING, obs(17, ANCHORAGE, 0.1, 1)],
        [_ADOPTED, flagged(16, "AT_ANCHOR", "UNDERWAY"), cleared(17, "AT_ANCHOR", "AT_ANCHOR")],
    ),
    "ambiguous_codes_are_never_compared": (
        [obs(0, ANCHORAGE, 0.1, 1)] + [obs(m, ANCHORAGE, 0.1, 2) for m in range(1, 30)], [_ADOPTED],
    ),
    "ambiguous_codes_do_not_reset_the_clock": (
        [obs(0, ANCHORAGE, 0.1, 1), obs(1, ANCHORAGE, 0.1, 0), obs(8, ANCHORAGE, 0.1, 2), obs(16, ANCHORAGE, 0.1, 0)],
        [_ADOPTED, flagged(16, "AT_ANCHOR", "UNDERWAY")],
    ),
    "missing_speed_is_under_way": ([obs(0, ANCHORAGE, None)], [transition(0, "UNKNOWN", "UNDERWAY")]),
    "missing_code_is_not_compared": (
        [obs(0, ANCHORAGE, 0.1, None), obs(20, ANCHORAGE, 0.1, None)], [_ADOPTED],
    ),
    "silence_expires_at_the_last_position": (
        [obs(0, ANCHORAGE), obs(2, ANCHORAGE), obs(33, OPEN, 9.0)],
        [_ADOPTED, transition(2, "AT_ANCHOR", "EXPIRED"), transition(33, "UNKNOWN", "UNDERWAY")],
    ),
    "silence_of_exactly_the_expiry_does_not": (
        [obs(0, ANCHORAGE), obs(30, ANCHORAGE)], [_ADOPTED],
    ),
    "expiry_forgets_a_flag": (
        [*_DISAGREEING, obs(60, ANCHORAGE, 0.1, 1)],
        [
            _ADOPTED, flagged(16, "AT_ANCHOR", "UNDERWAY"), transition(16, "AT_ANCHOR", "EXPIRED"),
            transition(60, "UNKNOWN", "AT_ANCHOR", ANCHORAGE[1]),
        ],
    ),
    "transition_and_expiry_at_one_instant": (
        [obs(0, OPEN, 9.0), obs(1, ANCHORAGE), obs(6, ANCHORAGE), obs(60, OPEN, 9.0)],
        [
            transition(0, "UNKNOWN", "UNDERWAY"), transition(6, "UNDERWAY", "AT_ANCHOR", ANCHORAGE[1]),
            transition(6, "AT_ANCHOR", "EXPIRED"), transition(60, "UNKNOWN", "UNDERWAY"),
        ],
    ),
}


def rows(name: str, observations) -> list[tuple]:
    """(mmsi, event_time, lat, lon, sog, nav_status_code, zone_type, zone_id, partition, offset)"""
    return [
        (name, at(minute), 33.73, -118.22, sog, code, zone[0], zone[1], 0, i)
        for i, (minute, zone, sog, code) in enumerate(observations)
    ]


POSITION_COLUMNS = (
    "mmsi string, event_time timestamp, lat double, lon double, sog double, nav_status_code int, "
    "zone_type string, zone_id string, partition int, offset long"
)


def events_of(df) -> dict[str, list[tuple]]:
    """Collected state changes by vessel."""
    found: dict[str, list[tuple]] = {}
    for r in df.collect():
        found.setdefault(r["mmsi"], []).append(tuple(r)[1:])
    return {k: sorted(v, key=repr) for k, v in found.items()}


def random_tracks(rng, vessels: int, steps: int):
    """Random vessels: repeated instants, jitter, ambiguous codes and silences well past the expiry."""
    kinds = [(OPEN, 9.0), (ANCHORAGE, 0.1), (BERTH, 0.1), (ANCHORAGE, 0.7)]
    out = []
    for v in range(vessels):
        minute, name = 0.0, f"{100000000 + v}"
        for i in range(steps):
            minute += rng.choice([0, 0.5, 1, 1, 2, 3, 4, 7, 29, 30, 31, 90]) if rng.random() < 0.9 else 200
            kind = kinds[rng.integers(len(kinds))] if i == 0 or rng.random() < 0.4 else kind  # noqa: F821
            code = int(rng.choice([0, 1, 5, 8, 2, 15]))
            zone, sog = kind
            out.append((name, at(minute), 33.7, -118.2, sog, code, zone[0], zone[1], 0, i))
    return out
