import datetime as dt
import glob
import json
import os

import pytest
from cases import ANCHORAGE, T0, at, cleared, flagged, transition
from pyspark.sql import functions as F

from harborflow import constants as K
from harborflow import schemas
from harborflow.operators import checks
from harborflow.operators.asof import state_as_of
from harborflow.operators.dedup import drop_redelivered, top_keys
from harborflow.operators.ordered import number_rows
from harborflow.plans import agreement as agree
from harborflow.plans import gold, models
from harborflow.sources import tables

AS_OF = at(1000)


def changes_df(spark, *events, mmsi="1"):
    return spark.createDataFrame([(mmsi, *e) for e in events], schemas.STATE_CHANGES)


def zones_df(spark):
    return spark.createDataFrame([(ANCHORAGE[1], "anchorage", "B"), ("berth-1", "berth", "Berth 1")],
                                 "zone_id string, zone_type string, zone_name string")


def sessions_of(spark, *events):
    return models.vessel_sessions(changes_df(spark, *events), zones_df(spark), F.lit(AS_OF))


def test_sessions_drop_replays_and_close_on_expiry(spark):
    first = transition(0, "UNKNOWN", "AT_ANCHOR", ANCHORAGE[1])
    got = sessions_of(spark, first, first, transition(10, "AT_ANCHOR", "UNDERWAY"), transition(40, "UNDERWAY", "EXPIRED"))
    rows = {r["state"]: r for r in got.collect()}
    assert set(rows) == {"AT_ANCHOR", "UNDERWAY"}
    assert rows["AT_ANCHOR"]["session_duration_seconds"] == 600 and rows["AT_ANCHOR"]["zone_name"] == "B"
    assert rows["UNDERWAY"]["session_end"] == at(40) and not rows["UNDERWAY"]["is_ongoing"]


def test_expiry_tied_with_a_transition_ends_it_at_once(spark):
    got = sessions_of(spark, transition(0, "UNKNOWN", "UNDERWAY"), transition(6, "UNDERWAY", "AT_ANCHOR", ANCHORAGE[1]),
                      transition(6, "AT_ANCHOR", "EXPIRED"))
    anchored = got.filter("state = 'AT_ANCHOR'").first()
    assert anchored["session_end"] == at(6) and not anchored["is_ongoing"]


def test_ongoing_session_is_measured_to_the_given_instant(spark):
    row = sessions_of(spark, transition(0, "UNKNOWN", "UNDERWAY")).first()
    assert row["is_ongoing"] and row["session_duration_seconds"] == 60_000


@pytest.mark.parametrize(
    ("after", "proceeded"),
    [([transition(9, "AT_ANCHOR", "MOORED", "berth-1")], True), ([transition(9, "AT_ANCHOR", "UNDERWAY")], False),
     ([], None), ([transition(9, "AT_ANCHOR", "EXPIRED")], None),
     ([transition(9, "AT_ANCHOR", "EXPIRED"), transition(60, "UNKNOWN", "MOORED", "berth-1")], True)],
)
def test_dwell_outcome(spark, after, proceeded):
    dwell = models.anchorage_dwell(sessions_of(spark, transition(0, "UNKNOWN", "AT_ANCHOR", ANCHORAGE[1]), *after))
    assert dwell.first()["proceeded_to_berth"] is proceeded


def test_daily_activity_both_ways(spark):
    # 12:00 on the 15th to 06:00 on the 17th.
    sessions = sessions_of(spark, transition(0, "UNKNOWN", "UNDERWAY"), transition(42 * 60, "UNDERWAY", "AT_ANCHOR", ANCHORAGE[1]))
    whole = [tuple(r) for r in models.daily_activity(sessions).collect()]
    assert whole == [("1", dt.date(2026, 7, 15), "UNDERWAY", 1, 42 * 3600)]
    split = {r["activity_date"].day: r["total_duration_seconds"] for r in models.daily_activity(sessions, split_at_midnight=True).collect()}
    assert split == {15: 12 * 3600, 16: 24 * 3600, 17: 6 * 3600}
    to_midnight = sessions_of(spark, transition(0, "UNKNOWN", "UNDERWAY"), transition(720, "UNDERWAY", "EXPIRED"))
    assert [r["activity_date"].day for r in models.daily_activity(to_midnight, split_at_midnight=True).collect()] == [15]


def test_episode_pairs_with_the_next_clear(spark):
    events = [flagged(0, "UNDERWAY", "MOORED"), cleared(0, "UNDERWAY", "UNDERWAY"), flagged(50, "UNDERWAY", "MOORED"),
              cleared(70, "UNDERWAY", "UNDERWAY"), flagged(90, "UNDERWAY", "MOORED")]
    df = changes_df(spark, *events, events[0])
    free = {r["flagged_at"]: (r["cleared_at"], r["is_ongoing"], r["duration_seconds"])
            for r in models.discrepancy_episodes(df, F.lit(AS_OF)).collect()}
    assert free == {at(0): (at(70), False, 4200), at(50): (at(70), False, 1200), at(90): (None, True, 910 * 60)}
    bound = {r["flagged_at"]: r["cleared_at"]
             for r in models.discrepancy_episodes(df, F.lit(AS_OF), bound_by_next_flag=True).collect()}
    assert bound == {at(0): None, at(50): at(70), at(90): None}


def test_latest_static_row_wins_and_text_is_trimmed(spark):
    rows = [("1", "OLD", "C ", 70, "X  ", 9, 7.0, at(0)), ("1", "NEW   ", "C ", 71, "USLAX  ", 9, 7.5, at(5)),
            ("2", "B", None, 1, None, 8, 1.0, at(1))]
    got = {r["mmsi"]: r for r in models.dim_vessels(spark.createDataFrame(rows, schemas.SHIP_STATIC)).collect()}
    assert (got["1"]["ship_name"], got["1"]["destination"], got["1"]["ship_type_code"]) == ("NEW", "USLAX", 71)
    assert got["2"]["call_sign"] is None and len(got) == 2


def positions_df(spark, *rows):
    return spark.createDataFrame(
        [("1", at(m), 0, i, code) for i, (m, code) in enumerate(rows)],
        "mmsi string, event_time timestamp, partition int, offset long, nav_status_code int")


@pytest.mark.parametrize("max_rows", [None, 3])
def test_as_of_join(spark, max_rows):
    changes = changes_df(spark, transition(5, "UNKNOWN", "UNDERWAY"), transition(10, "UNDERWAY", "MOORED", "z"),
                         transition(10, "MOORED", "EXPIRED"), flagged(6, "UNDERWAY", "MOORED"))
    positions = positions_df(spark, (4, 0), (5, 0), (9, 0), (10, 0), (10, 0), (99, 0))
    got = state_as_of(positions, changes, max_rows=max_rows).orderBy("offset").collect()
    assert [r["derived_state"] for r in got] == [None, "UNDERWAY", "UNDERWAY", "EXPIRED", "EXPIRED", "EXPIRED"]


def test_as_of_against_the_range_join(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    positions = spark.createDataFrame(
        [(str(rng.integers(5)), at(float(m)), 0, i, 0) for i, m in enumerate(rng.integers(0, 300, 400))],
        "mmsi string, event_time timestamp, partition int, offset long, nav_status_code int")
    changes = spark.createDataFrame(
        [(str(v), *transition(float(m), None, str(rng.choice(["MOORED", "UNDERWAY", "EXPIRED"]))))
         for v in range(5) for m in sorted(set(rng.integers(0, 300, 20).tolist()))], schemas.STATE_CHANGES)
    p, t = positions.alias("p"), changes.alias("t")
    slow = p.join(t, (F.col("p.mmsi") == F.col("t.mmsi")) & (F.col("t.transition_time") <= F.col("p.event_time")), "left") \
        .groupBy("p.mmsi", "p.offset").agg(F.max_by("t.to_state", "t.transition_time").alias("s"))
    want = {(r["mmsi"], r["offset"]): r["s"] for r in slow.collect()}
    for max_rows in (None, 50):
        got = {(r["mmsi"], r["offset"]): r["derived_state"] for r in state_as_of(positions, changes, max_rows=max_rows).collect()}
        assert got == want


def test_as_of_keeps_rows_without_a_vessel(spark):
    positions = positions_df(spark, (4, 0)).withColumn("mmsi", F.lit(None).cast("string"))
    changes = changes_df(spark, transition(1, "UNKNOWN", "UNDERWAY"), mmsi=None)
    assert [r["derived_state"] for r in state_as_of(positions, changes).collect()] == [None]


def test_agreement_counts_expired_as_disagreement(spark):
    changes = changes_df(spark, transition(0, "UNKNOWN", "UNDERWAY"), transition(10, "UNDERWAY", "EXPIRED"))
    positions = positions_df(spark, (-1, 0), (1, 0), (2, 5), (3, 2), (11, 0))
    report = agree.agreement_report(positions, changes, hours=24)
    rows = {r["mmsi"]: r for r in report["agreement"].collect()}
    assert rows["1"]["n_comparable"] == 3 and rows["1"]["agreement_rate"] == pytest.approx(1 / 3)
    assert rows[None]["n_comparable"] == 3 and rows[None]["state_pairs"] == 3 and not rows[None]["trivial_window"]
    assert report["uncovered"].count() == 0
    assert tuple(report["bounds"].first()) == (at(11) - dt.timedelta(hours=24), at(11))


def test_agreement_without_comparable_rows(spark):
    report = agree.agreement_report(positions_df(spark, (1, 2)), changes_df(spark, transition(0, "UNKNOWN", "UNDERWAY")))
    (overall,) = report["agreement"].collect()
    assert overall["n_comparable"] == 0 and overall["agreement_rate"] is None and overall["trivial_window"]
    assert [r[0] for r in report["uncovered"].collect()] == ["1"]


def test_trailing_window_includes_both_ends(spark):
    positions = positions_df(spark, (0, 0), (60, 0), (-0.5, 0))
    assert sorted(r["event_time"] for r in agree.trailing_window(positions, 1).collect()) == [at(0), at(60)]


def document_in(folder):
    """The text files one after the other are one JSON document."""
    return json.loads("".join(open(p).read() for p in sorted(glob.glob(os.path.join(folder, "document", "part-*")))))


def test_snapshot_files(spark, base):
    dwell = models.anchorage_dwell(sessions_of(spark, transition(0, "UNKNOWN", "AT_ANCHOR", ANCHORAGE[1])))
    vessels = spark.createDataFrame([("9", "OTHER")], "mmsi string, ship_name string")
    snapshot = models.at_anchor_now(dwell, vessels, F.lit(AS_OF))
    folder = tables.export_snapshot(snapshot.limit(0), base, F.lit(AS_OF))
    assert document_in(folder)["ships_at_anchor"] == []
    # A later export replaces the document, whatever its size.
    many = spark.range(500).join(snapshot).withColumn("mmsi", F.col("id").cast("string")).select(snapshot.columns)
    folder = tables.export_snapshot(many, base, F.lit(AS_OF))
    assert sorted(int(s["mmsi"]) for s in document_in(folder)["ships_at_anchor"]) == list(range(500))
    folder = tables.export_snapshot(snapshot, base, F.lit(AS_OF))
    (ship,) = document_in(folder)["ships_at_anchor"]
    assert ship["mmsi"] == "1" and ship["ship_name"] is None and ship["minutes_at_anchor"] == 1000
    assert models.ships_at_anchor(snapshot).first()[0] == 1
    assert models.presented(snapshot).columns[0] == "MMSI"


def test_snapshot_is_replaced_as_a_whole(spark, base):
    ships = spark.createDataFrame([(AS_OF, "1"), (AS_OF, "2")], "arrival_time timestamp, mmsi string")
    names = lambda rows: sorted(r["mmsi"] for r in rows.collect())
    assert tables.snapshot_folder(spark, base) is None
    with pytest.raises(FileNotFoundError):
        tables.read_snapshot(spark, base, ships.schema)
    first = tables.export_snapshot(ships, base, F.lit(AS_OF))
    reader = tables.read_snapshot(spark, base, ships.schema)
    lines = tables.read_snapshot_lines(spark, base)

    # A write that fails half-way: the rows are there, the document is not.
    with pytest.raises(Exception, match="broken"):
        tables.export_snapshot(ships.limit(1), base, F.raise_error(F.lit("broken")).cast("timestamp"))
    assert tables.snapshot_folder(spark, base) == first
    assert names(tables.read_snapshot(spark, base, ships.schema)) == ["1", "2"]

    second = tables.export_snapshot(ships.filter("mmsi = '2'"), base, F.lit(AS_OF))
    assert tables.snapshot_folder(spark, base) == second != first
    assert names(tables.read_snapshot(spark, base, ships.schema)) == ["2"]
    # Who had begun to read the former version can finish; what failed is gone.
    assert names(reader) == ["1", "2"] and lines.count() == 2
    assert sorted(os.listdir(os.path.join(base, "versions"))) == sorted(map(os.path.basename, (first, second)))


def test_dedup_top_keys_and_numbering(spark):
    df = spark.createDataFrame([("a", 1, 5, "x"), ("a", 1, 3, "y"), ("b", 1, 9, "z"), ("a", 2, 1, None)],
                               "mmsi string, event_time int, offset int, v string")
    assert {tuple(r) for r in drop_redelivered(df).collect()} == {("a", 1, 3, "y"), ("b", 1, 9, "z"), ("a", 2, 1, None)}
    assert [tuple(r) for r in top_keys(df, "mmsi", 1).collect()] == [("a", 3)]
    numbered = number_rows(spark.range(1000).withColumn("k", (F.col("id") * 7919) % 1009), ["k"], "n")
    got = [r["n"] for r in numbered.orderBy("k").collect()]
    assert got == list(range(1, 1001))


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("x", None), ("x", 5), ("x", 6)], "k string, v int")
    parent = spark.createDataFrame([("a",)], "k string")
    got = {(r["check"], r["column"]): (r["failures"], r["status"]) for r in checks.run_checks([
        checks.unique(df, "t", "k"), checks.not_null(df, "t", ["k", "v"]),
        checks.accepted_values(df, "t", "k", ["a"]), checks.relationships(df, "t", "k", parent, "k", "warn"),
    ]).collect()}
    assert got == {("unique", "k"): (2, "error"), ("not_null", "k"): (1, "error"), ("not_null", "v"): (1, "error"),
                   ("accepted_values", "k"): (1, "error"), ("relationships", "k"): (3, "warn")}


@pytest.mark.parametrize(("minutes", "status"), [(15, "pass"), (16, "warn"), (30, "warn"), (31, "error")])
def test_freshness(spark, minutes, status):
    df = spark.createDataFrame([(T0,), (None,)], "ingested_at timestamp")
    row = checks.freshness(df, "t", "ingested_at", 15, 30, F.lit(at(minutes))).first()
    assert row["status"] == status
    assert checks.freshness(df.limit(0), "t", "ingested_at", 15, 30).first()["status"] == "error"


def test_append_batch_replaces_its_replay(spark, base):
    df = spark.range(3)
    tables.append_batch(df, base, "t", 1)
    tables.append_batch(df, base, "t", 2)
    tables.append_batch(df, base, "t", 2)
    assert tables.read_table(spark, base, "t").count() == 6
    count, schema, newest = tables.inspect(tables.read_table(spark, base, "t"), "id", 2)
    assert count == 6 and schema.names == ["id", "load"] and [r["id"] for r in newest.collect()] == [2, 2]


def test_lake_and_gold(spark, base):
    from workload import mapping as M

    sf = "/root/testdata/sf0.001"
    gold.build_lake(M.positions(spark, sf), M.index(spark), base, debounce=M.DEBOUNCE, discrepancy=M.DISCREPANCY, expiry=M.EXPIRY)
    tables.write_table(M.ship_static(spark, sf).select(*schemas.SHIP_STATIC.names), base, "ship_static")
    built = gold.run_gold(spark, base, M.as_of())
    assert built["fct_anchorage_dwell"].count() == M.dwell(spark, sf).count() > 0
    results = {(r["table"], r["check"], r["column"]): r["status"] for r in built["test_results"].collect()}
    assert all(v == "pass" for k, v in results.items() if k[1] in ("unique", "accepted_values")), results
    assert results["positions_silver", "freshness", "ingested_at"] == "error"
    tables.register_sources(spark, base, gold.SOURCES)
    assert spark.sql("select count(*) from positions_silver where zone_id is not null").first()[0] > 0
    assert {r["event_type"] for r in spark.table("vessel_state_changes").select("event_type").distinct().collect()} <= {
        K.STATE_TRANSITION, K.DISCREPANCY_FLAGGED, K.DISCREPANCY_CLEARED}
    # One day of silver is read from one partition.
    day = tables.read_table(spark, base, "positions_silver", schemas.POSITIONS_SILVER).filter("event_date = date'2024-01-05'")
    assert len(day.inputFiles()) >= 1
    assert "PartitionFilters: [isnotnull(event_date" in day._jdf.queryExecution().executedPlan().toString()
