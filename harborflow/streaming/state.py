"""Vessel state across micro-batches: the streaming form of `operators.state_machine`.

Vessels are dealt by hash to a fixed number of buckets, whose state is read and written as a whole: a call per vessel and
micro-batch would cost more than all its rows. Rows arrive in any order. Each is held, by bucket and stretch of time, until the
watermark has passed it; a timer then folds what is due into the vessels' states, in time order, one stretch after the other, so
that no more than a bucket's stretch is in memory. A row that the watermark had passed when its micro-batch began is too late to be
put in order: it is counted, not applied. Silence longer than the expiry ends a track, seen either in the data or by the timer
once the watermark has passed it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

import harborflow
from harborflow import constants as K
from harborflow.functions.scalars import raw_state, reported_bucket
from harborflow.schemas import STATE_CHANGES, TRACKED

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MICROS = 1_000_000
# Held rows are stored, read and folded by stretches of this length.
STRETCH_SECONDS = 1800
# Vessels are kept in so many buckets; like the number of shuffle partitions, it stays what it was when a checkpoint was begun.
BUCKETS = 512

_L, _S = T.LongType(), T.StringType()
# Times are microseconds since the epoch.
STATE = T.StructType([
    T.StructField("current_state", _S), T.StructField("candidate_state", _S), T.StructField("candidate_since", _L),
    T.StructField("candidate_zone_id", _S), T.StructField("last_position_time", _L),
    T.StructField("discrepancy_since", _L), T.StructField("discrepancy_flagged", T.BooleanType()),
])
_EMPTY = dict.fromkeys(STATE.names) | {"discrepancy_flagged": False}
# `due` is a bucket's first held row, `silent` the millisecond from which the first of its vessels is silent, `timer` in milliseconds.
CLOCK = T.StructType([T.StructField("due", _L), T.StructField("silent", _L), T.StructField("timer", _L)])
BLOB = T.StructType([T.StructField("rows", T.BinaryType())])

_ORDER = ["mmsi", "t", "tie_1", "tie_2"]
_RANK = ["priority", "area", "zone_id"]
_HELD = pa.schema([
    ("mmsi", pa.string()), ("t", pa.int64()), ("tie_1", pa.int64()), ("tie_2", pa.int64()), ("priority", pa.float64()),
    ("area", pa.float64()), ("zone_id", pa.string()), ("raw", pa.string()), ("reported", pa.string()),
])
_VESSELS = pa.schema([
    ("mmsi", pa.string()), ("current_state", pa.string()), ("candidate_state", pa.string()), ("candidate_since", pa.int64()),
    ("candidate_zone_id", pa.string()), ("last_position_time", pa.int64()), ("discrepancy_since", pa.int64()),
    ("discrepancy_flagged", pa.bool_()),
])
_SEEN = pa.schema([("mmsi", pa.string()), ("delivered_t", pa.int64()), ("since", pa.int64())])


def _row(kind: str, at: int, **fields: Any) -> dict[str, Any]:
    return dict.fromkeys(STATE_CHANGES.names) | {"event_type": kind, "transition_time": at} | fields


class Tracker:
    """One vessel's state, advanced by time-ordered columns of observations."""

    def __init__(self, debounce: int, discrepancy: int, expiry: int):
        self.debounce = debounce * MICROS
        self.discrepancy = discrepancy * MICROS
        self.expiry = expiry * MICROS

    def expire(self, state: dict[str, Any]) -> list[dict[str, Any]]:
        """Forget the vessel."""
        if state["current_state"] is None:
            return []
        event = _row(
            K.STATE_TRANSITION, state["last_position_time"], from_state=state["current_state"],
            to_state=K.EXPIRED, derived_state=K.EXPIRED,
        )
        state.update(_EMPTY)
        return [event]

    def advance(self, state: dict[str, Any], obs: pd.DataFrame) -> list[dict[str, Any]]:
        """Fold sorted rows (t, raw, zone_id, reported) into `state`; return events."""
        events: list[dict[str, Any]] = []
        for row in zip(*[obs[c].tolist() for c in ("t", "raw", "zone_id", "reported")], strict=True):
            self.step(state, *row, events)
        return events

    def step(self, state: dict[str, Any], t: int, raw: str, zone: str | None, reported: str, events: list) -> None:
        last = state["last_position_time"]
        if last is not None and t - last > self.expiry:
            events += self.expire(state)
        current = state["current_state"]
        if raw == current:
            if state["candidate_state"] is not None:
                state.update(candidate_state=None, candidate_since=None, candidate_zone_id=None)
        elif current is not None and state["candidate_state"] != raw:
            state.update(candidate_state=raw, candidate_since=t, candidate_zone_id=zone)
        elif current is None or t >= state["candidate_since"] + self.debounce:
            events.append(_row(
                K.STATE_TRANSITION, t, from_state=current or K.UNKNOWN, to_state=raw, zone_id=zone, derived_state=raw,
            ))
            state.update(current_state=raw, candidate_state=None, candidate_since=None, candidate_zone_id=None)
        state["last_position_time"] = t
        if reported != K.OTHER:
            self._compare(state, t, reported, events)

    def _compare(self, state: dict[str, Any], t: int, reported: str, events: list) -> None:
        derived, kind = state["current_state"], None
        if reported == derived:
            if state["discrepancy_flagged"]:
                kind = K.DISCREPANCY_CLEARED
            state["discrepancy_since"], state["discrepancy_flagged"] = None, False
        elif state["discrepancy_since"] is None:
            state["discrepancy_since"] = t
        elif not state["discrepancy_flagged"] and t >= state["discrepancy_since"] + self.discrepancy:
            state["discrepancy_flagged"], kind = True, K.DISCREPANCY_FLAGGED
        if kind is not None:
            events.append(_row(kind, t, derived_state=derived, reported_status=reported))


def _frame(mmsi: str, events: list[dict[str, Any]]) -> pd.DataFrame:
    """A vessel's events as rows of `STATE_CHANGES`."""
    out = pd.DataFrame([event | {"mmsi": mmsi} for event in events], columns=STATE_CHANGES.names)
    out["transition_time"] = pd.to_datetime(out["transition_time"].astype("Int64"), unit="us")
    return out


def _tracked(events: list[dict[str, Any]], late: dict[str, int]) -> pd.DataFrame:
    """Events and, for vessels of which rows came too late, a row without an event that says how many."""
    rows = [*events, *[dict.fromkeys(STATE_CHANGES.names) | {"mmsi": mmsi, "late_rows": n} for mmsi, n in late.items()]]
    out = pd.DataFrame(rows, columns=TRACKED.names)
    out["transition_time"] = pd.to_datetime(out["transition_time"].astype("Int64"), unit="us")
    out["late_rows"] = out["late_rows"].astype("Int64")
    return out


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


class VesselProcessor(StatefulProcessor):
    """Keeps the `STATE` of a bucket's vessels, their held rows by stretch of time, and one timer: at the first held row, or at the
    first vessel's last position + expiry, whichever the watermark passes first.

    Rows come in chunks of bounded size and go to their stretches chunk by chunk; a fold reads one stretch at a time. A stretch is
    as large as what a bucket's vessels report in it.
    """

    def __init__(self, debounce: int, discrepancy: int, expiry: int, stretch: int):
        self.tracker, self.stretch = Tracker(debounce, discrepancy, expiry), stretch * MICROS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.clock = handle.getValueState("clock", CLOCK)
        self.vessels = handle.getValueState("vessels", BLOB)
        self.held = handle.getMapState("held", T.StructType([T.StructField("stretch", _L)]), BLOB)

    def _load(self) -> dict[str, Any]:
        return dict(zip(CLOCK.names, self.clock.get(), strict=True)) if self.clock.exists() else dict.fromkeys(CLOCK.names)

    def _save(self, clock: dict[str, Any]) -> None:
        """Store the clock with its one timer; forget a bucket of which nothing is known or held."""
        # A row is due from the first full millisecond on that is not before it.
        due = None if clock["due"] is None else -(-clock["due"] // 1000)
        timer = min((at for at in (due, clock["silent"]) if at is not None), default=None)
        if timer != clock["timer"]:
            if clock["timer"] is not None:
                self.handle.deleteTimer(clock["timer"])
            if timer is not None:
                self.handle.registerTimer(timer)
        clock["timer"] = timer
        if timer is None:
            self.clock.clear()
        else:
            self.clock.update(tuple(clock[name] for name in CLOCK.names))

    def _hold(self, clock: dict[str, Any], rows: pd.DataFrame) -> None:
        for stretch, part in rows.groupby(rows["t"] // self.stretch):
            key = (int(stretch),)
            table = pa.Table.from_pandas(part[_HELD.names], _HELD, preserve_index=False)
            if self.held.containsKey(key):
                table = pa.concat_tables([_unpacked(bytes(self.held.getValue(key)[0])), table])
            self.held.updateValue(key, (_packed(table),))
        if len(rows):
            first = int(rows["t"].min())
            clock["due"] = first if clock["due"] is None else min(first, clock["due"])

    def _load_vessels(self) -> dict[str, dict[str, Any]]:
        if not self.vessels.exists():
            return {}
        return {row.pop("mmsi"): row for row in _unpacked(bytes(self.vessels.get()[0])).to_pylist()}

    def _save_vessels(self, vessels: dict[str, dict[str, Any]]) -> None:
        rows = [{"mmsi": mmsi} | state for mmsi, state in vessels.items()]
        if rows:
            self.vessels.update((_packed(pa.Table.from_pylist(rows, _VESSELS)),))
        else:
            self.vessels.clear()

    def _fold(self, clock: dict[str, Any], vessels: dict[str, dict[str, Any]], watermark: int) -> list[dict[str, Any]]:
        """Apply all held rows up to the watermark (microseconds), in order."""
        events, width = [], self.stretch
        clock["due"] = None
        for stretch in sorted(key[0] for key in self.held.keys()):
            if stretch * width > watermark:
                clock["due"] = stretch * width
                break
            table = _unpacked(bytes(self.held.getValue((stretch,))[0]))
            obs = table.to_pandas()
            ready = obs[obs["t"] <= watermark].sort_values([*_ORDER, *_RANK], kind="stable")
            # A position that came once per matching zone counts with its best one.
            ready = ready.drop_duplicates(_ORDER)
            zones = ready["zone_id"].astype(object).where(ready["zone_id"].notna(), None)
            lists = [zones.tolist() if c == "zone_id" else ready[c].tolist() for c in ("mmsi", "t", "raw", "zone_id", "reported")]
            for mmsi, *row in zip(*lists, strict=True):
                state = vessels.get(mmsi)
                if state is None:
                    state = vessels[mmsi] = dict(_EMPTY)
                before = len(events)
                self.tracker.step(state, *row, events)
                for event in events[before:]:
                    event["mmsi"] = mmsi
            late = (obs["t"] > watermark).to_numpy()
            if late.any():
                self.held.updateValue((stretch,), (_packed(table.filter(pa.array(late))),))
                clock["due"] = int(obs["t"][late].min())
                break
            self.held.removeKey((stretch,))
        return events

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        clock, late = self._load(), {}
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        for chunk in rows:
            in_time = chunk["t"] > watermark
            for mmsi, n in chunk["mmsi"][~in_time].value_counts().items():
                late[mmsi] = late.get(mmsi, 0) + int(n)
            self._hold(clock, chunk[in_time])
        self._save(clock)
        if late:
            yield _tracked([], late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        clock = self._load()
        if expiredTimerInfo.getExpiryTimeInMs() != clock["timer"]:
            return
        watermark, vessels = timerValues.getCurrentWatermarkInMs(), self._load_vessels()
        events = self._fold(clock, vessels, watermark * 1000)
        # Silence exceeds the expiry from the first full millisecond on that is past it.
        silent = {mmsi: (state["last_position_time"] + self.tracker.expiry) // 1000 + 1 for mmsi, state in vessels.items()}
        for mmsi, at in silent.items():
            if watermark >= at:
                events += [event | {"mmsi": mmsi} for event in self.tracker.expire(vessels.pop(mmsi))]
        clock["silent"] = min((silent[mmsi] for mmsi in vessels), default=None)
        self._save_vessels(vessels)
        self._save(clock)
        if events:
            yield _tracked(events, {})

    def close(self) -> None:
        pass


def _bucket(mmsi: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(mmsi), F.lit(buckets))


def _observed(positions: DataFrame, tie: tuple[str, str]) -> list[Column]:
    raw = raw_state(F.col("zone_type"), F.col("sog"))
    rank = {
        name: F.col(f"_{name}") if f"_{name}" in positions.columns else F.lit(0) for name in ("priority", "area")
    }
    # The watermarked column itself stays behind: Spark would drop late rows by it before they can be counted.
    return [
        *[column.cast("double").alias(name) for name, column in rank.items()],
        F.col("mmsi"), F.unix_micros("event_time").alias("t"),
        F.col(tie[0]).cast("long").alias("tie_1"), F.col(tie[1]).cast("long").alias("tie_2"), raw.alias("raw"),
        F.when(raw != K.UNDERWAY, F.col("zone_id")).alias("zone_id"),
        reported_bucket(F.col("nav_status_code")).alias("reported"),
    ]


def track_vessels(
    positions: DataFrame, *, debounce: int = K.DEBOUNCE_SECONDS, discrepancy: int = K.DISCREPANCY_SECONDS,
    expiry: int = K.EXPIRY_SECONDS, tie: tuple[str, str] = ("partition", "offset"), stretch: int = STRETCH_SECONDS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Streaming positions (with watermark and zone), in any order -> streaming rows of schema `TRACKED`: state changes, and
    per vessel and micro-batch how many rows came behind the watermark.

    Positions come with their best zone, or once per matching zone as `match_zones` gives them. Started by `sinks.start`,
    which names the state store. `buckets` must stay the same as long as a checkpoint is used.
    """
    # Workers get the processor with the query and need not have this package installed.
    cloudpickle.register_pickle_by_value(harborflow)
    usable = positions.filter(F.col("mmsi").isNotNull() & F.col("event_time").isNotNull())
    return usable.select(*_observed(usable, tie), _bucket(F.col("mmsi"), buckets).alias("bucket")).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=VesselProcessor(debounce, discrepancy, expiry, stretch),
        outputStructType=TRACKED, outputMode="Append", timeMode="EventTime",
    )


class FirstDelivery(StatefulProcessor):
    """Passes rows that failed the quality check, and of valid ones the first delivery of every vessel and time: the lowest offset of
    the micro-batch in which they are first seen. Later deliveries are dropped for `keep` seconds of processing time.

    A log delivers a key's rows by rising offset, so the row that stays is the one with the lowest offset of all.
    """

    def __init__(self, schema: T.StructType, keep: int):
        self.columns, self.keep = schema.names, keep * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.value = handle.getValueState("seen", BLOB)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        place = ["mmsi", "delivered_t"]
        seen = (_unpacked(bytes(self.value.get()[0])) if self.value.exists() else _SEEN.empty_table()).to_pandas()
        now, kept, unsorted = None, [], 0

        def first(parts: list[pd.DataFrame]) -> pd.DataFrame:
            new = pd.concat(parts, ignore_index=True)
            return new.sort_values([*place, "partition", "offset"], kind="stable").drop_duplicates(place)

        for chunk in rows:
            if now is None:
                now = int(chunk["delivered_now"].iloc[0])
                seen = seen[seen["since"] > now - self.keep]
            valid = chunk["quality_ok"].to_numpy(bool)
            if not valid.all():
                yield chunk[~valid][self.columns]
            new = chunk[valid]
            if not len(new):
                continue
            kept.append(new)
            unsorted += len(new)
            # Sorted anew when chunks have brought as much as was kept, at most one row a vessel and time, so not for every chunk.
            if len(kept) > 1 and unsorted >= len(kept[0]):
                kept, unsorted = [first(kept)], 0
        best = first(kept) if kept else None
        if best is not None and len(seen):
            known = best[place].merge(seen[place], how="left", on=place, indicator=True)["_merge"].to_numpy() == "both"
            best = best[~known]
        if best is not None and len(best):
            added = pd.concat([seen, best[place].assign(since=now)], ignore_index=True)
            self.value.update((_packed(pa.Table.from_pandas(added, _SEEN, preserve_index=False)),))
            yield best[self.columns]

    def close(self) -> None:
        pass


def first_deliveries(tagged: DataFrame, keep: int = K.REDELIVERY_SECONDS, buckets: int = BUCKETS) -> DataFrame:
    """Quality-tagged streaming positions without redelivered valid rows (equal vessel and time), across micro-batches.

    A valid row has a vessel; invalid rows without one are dealt to the buckets by offset, and are only passed on. Started by
    `sinks.start`. `buckets` must stay the same as long as a checkpoint is used.
    """
    cloudpickle.register_pickle_by_value(harborflow)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in tagged.schema.fields])
    keyed = tagged.withColumns({
        "bucket": F.when(F.col("quality_ok"), _bucket(F.col("mmsi"), buckets)).otherwise(_bucket(F.col("offset"), buckets)),
        # One instant a micro-batch, and the same when it is replayed.
        "delivered_now": F.unix_millis(F.current_timestamp()),
        "delivered_t": F.coalesce(F.unix_micros("event_time"), F.lit(0)),
        # Without the watermark's mark: late rows are silver, too.
        "event_time": F.timestamp_micros(F.unix_micros("event_time")),
    })
    return keyed.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=FirstDelivery(schema, keep), outputStructType=schema, outputMode="Append", timeMode="None",
    )
