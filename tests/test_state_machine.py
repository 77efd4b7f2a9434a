import numpy as np
import pandas as pd
import pytest
from cases import POSITION_COLUMNS, SCENARIOS, at, events_of, random_tracks, rows, transition
from pyspark.sql import functions as F

from harborflow import constants as K
from harborflow.operators.state_machine import observations, state_changes, vessel_timeline
from harborflow.schemas import STATE_CHANGES
from harborflow.streaming.state import _EMPTY, Tracker


@pytest.fixture(scope="module")
def scenario_events(spark):
    data = [r for name, (o, _) in SCENARIOS.items() for r in rows(name, o)]
    return events_of(state_changes(spark.createDataFrame(data, POSITION_COLUMNS)))


@pytest.mark.parametrize("name", SCENARIOS)
def test_scenario_in_batch(scenario_events, name):
    assert scenario_events[name] == sorted(SCENARIOS[name][1], key=repr)


def tracked(frame: pd.DataFrame, sizes) -> list[tuple]:
    """Events of the streaming tracker fed with one vessel's rows in chunks."""
    tracker, state, events, lo = Tracker(K.DEBOUNCE_SECONDS, K.DISCREPANCY_SECONDS, K.EXPIRY_SECONDS), dict(_EMPTY), [], 0
    while lo < len(frame):
        size = next(sizes)
        events += tracker.advance(state, frame.iloc[lo:lo + size].reset_index(drop=True))
        lo += size
    return sorted(
        (tuple(e[c] if c != "transition_time" else pd.Timestamp(e[c], unit="us").to_pydatetime()
               for c in STATE_CHANGES.names if c != "mmsi") for e in events),
        key=repr,
    )


def frames(spark, data):
    df = spark.createDataFrame(data, POSITION_COLUMNS)
    extra = df.select("mmsi", F.unix_micros("event_time").alias("t"), "offset", "lat", "lon", "sog")
    pdf = observations(df).join(extra, ["mmsi", "t", "offset"]).toPandas()
    pdf = pdf.astype({"zone_id": object})
    pdf["zone_id"] = pdf["zone_id"].where(pdf["zone_id"].notna(), None)
    return {m: g.sort_values(["t", "offset"]).reset_index(drop=True) for m, g in pdf.groupby("mmsi")}


@pytest.mark.parametrize("seed", range(3))
def test_windows_segments_and_tracker_agree(spark, seed):
    """The window form, the segmented form and the streaming tracker give the same events."""
    rng = np.random.default_rng(seed)
    data = random_tracks(rng, 60, 60)
    hot = [("999999999", *r[1:]) for r in random_tracks(np.random.default_rng(50 + seed), 1, 900)]
    df = spark.createDataFrame(data + hot, POSITION_COLUMNS)
    plain = events_of(state_changes(df))
    if seed == 0:
        assert events_of(state_changes(df, max_rows=100)) == plain
        end = F.lit(max(r[1] for r in data + hot))
        closed = events_of(state_changes(df, watermark=end))
        assert closed != plain and events_of(state_changes(df, max_rows=100, watermark=end)) == closed
    for mmsi, frame in frames(spark, data + hot).items():
        chunked = tracked(frame, iter(lambda: int(rng.integers(1, 40)), None))
        assert chunked == plain.get(mmsi, []), mmsi


def _step_by_step(track):
    """Debounced states of one gap-free track, read off the definition for every row by itself."""
    states = []
    for i, (_, raw) in enumerate(track):
        if i == 0:
            states.append(raw)
            continue
        # The unbroken run of this raw state that ends here.
        j = i
        while j > 0 and track[j - 1][1] == raw:
            j -= 1
        held = j < i and track[i][0] - track[j][0] >= K.DEBOUNCE_SECONDS * 1_000_000
        states.append(raw if held else states[-1])
    return states


def test_states_follow_the_definition(spark):
    data = random_tracks(np.random.default_rng(7), 30, 50)
    timeline = vessel_timeline(spark.createDataFrame(data, POSITION_COLUMNS)).toPandas()
    for _, vessel in timeline.groupby("mmsi"):
        vessel = vessel.sort_values(["event_time", "offset"])
        times = [int(t.value // 1000) for t in vessel["event_time"]]
        raws, got, lo = vessel["raw"].tolist(), vessel["state"].tolist(), 0
        for hi in range(1, len(times) + 1):
            if hi == len(times) or times[hi] - times[hi - 1] > K.EXPIRY_SECONDS * 1_000_000:
                assert got[lo:hi] == _step_by_step(list(zip(times[lo:hi], raws[lo:hi], strict=True)))
                lo = hi


def test_final_expiry_needs_the_watermark(spark):
    df = spark.createDataFrame(rows("a", [(0, ("anchorage", "z"), 0.1, 15)]), POSITION_COLUMNS)
    early = state_changes(df, watermark=F.lit(at(29)))
    late = events_of(state_changes(df, watermark=F.lit(at(30))))
    assert early.count() == 1
    assert transition(0, "AT_ANCHOR", "EXPIRED") in late["a"]


def test_rows_without_vessel_or_time_are_left_out(spark):
    data = [(None, at(0), 0.0, 0.0, 1.0, 0, None, None, 0, 1), ("a", None, 0.0, 0.0, 1.0, 0, None, None, 0, 2)]
    assert state_changes(spark.createDataFrame(data, POSITION_COLUMNS)).count() == 0


def test_batch_plan_has_one_shuffle_by_vessel_and_no_python(spark):
    df = spark.createDataFrame(rows("a", [(0, ("anchorage", "z"), 0.1, 15)]), POSITION_COLUMNS)
    plan = state_changes(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.count("Sort [") == 1
    assert "Python" not in plan and "ArrowEval" not in plan
