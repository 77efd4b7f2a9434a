import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from harborflow.functions import scalars as S


def value(spark, column, **inputs):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()] or [F.lit(1).alias("_")])
    return row.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("text", "degrees"),
    [
        ("33°-44′-37.0″ N", 33 + 44 / 60 + 37 / 3600),
        ("118°-13′-00.0″ W", -(118 + 13 / 60)),
        ("33-43′ 40.5′ N", 33 + 43 / 60 + 40.5 / 3600),
        ("118-12′ 17″ w", -(118 + 12 / 60 + 17 / 3600)),
        ("33 43 05.1S", -(33 + 43 / 60 + 5.1 / 3600)),
        ("33°43′", None),
        ("north", None),
    ],
)
def test_dms(spark, text, degrees):
    got = value(spark, S.dms_to_degrees(F.lit(text)))
    assert got == (None if degrees is None else pytest.approx(degrees, abs=1e-12))


@pytest.mark.parametrize(
    ("unit", "a", "b", "n"),
    [
        ("second", "2024-01-01 00:00:00.9", "2024-01-01 00:00:02.1", 2),
        ("minute", "2024-01-01 00:00:59", "2024-01-01 00:01:01", 1),
        ("minute", "2024-01-01 00:00:00", "2024-01-01 00:00:59.9", 0),
        ("second", "1969-12-31 23:59:59.5", "1970-01-01 00:00:00", 1),
    ],
)
def test_boundary_diff(spark, unit, a, b, n):
    ts = lambda t: F.lit(t).cast("timestamp")
    assert value(spark, S.boundary_diff(unit, ts(a), ts(b))) == n


def test_feed_time(spark):
    text = "2026-07-15 09:17:05.994178528 +0000 UTC"
    assert value(spark, S.feed_time(F.lit(text))) == dt.datetime(2026, 7, 15, 9, 17, 5)
    assert value(spark, S.feed_time(F.lit("yesterday"))) is None
    assert value(spark, S.iso_time(F.lit("2026-07-15T09:17:05.123456+00:00"))) == dt.datetime(2026, 7, 15, 9, 17, 5, 123456)
    assert value(spark, S.iso_time(F.lit("soon"))) is None


def test_surrogate_key(spark):
    key = S.surrogate_key(F.lit("367"), F.lit("2024-01-01 10:00:00.25").cast("timestamp"))
    assert value(spark, key) == hashlib.md5(b"367|2024-01-01 10:00:00.25").hexdigest()
    assert value(spark, S.surrogate_key(F.lit(None).cast("string"), F.lit("x"))) is None


@pytest.mark.parametrize(
    ("zone", "sog", "state"),
    [
        ("berth", 0.49, "MOORED"), ("anchorage", 0.0, "AT_ANCHOR"), ("harbor", 0.1, "UNDERWAY"),
        ("berth", 0.5, "UNDERWAY"), ("berth", None, "UNDERWAY"), (None, 0.1, "UNDERWAY"),
    ],
)
def test_raw_state(spark, zone, sog, state):
    assert value(spark, S.raw_state(F.lit(zone).cast("string"), F.lit(sog).cast("double"))) == state


@pytest.mark.parametrize(("code", "bucket"), [(0, "UNDERWAY"), (8, "UNDERWAY"), (1, "AT_ANCHOR"), (5, "MOORED"), (2, "OTHER"), (None, "OTHER")])
def test_reported_bucket(spark, code, bucket):
    assert value(spark, S.reported_bucket(F.lit(code).cast("int"))) == bucket


def test_operator_tag(spark):
    def tag(*names):
        return value(spark, S.operator_tag([F.lit(n).cast("string") for n in names]))

    assert tag("Pier 400", None, None) == "APM"
    assert tag(None, "Yusen Terminals", None) == "YTI"
    assert tag("APL", None, None) == "APL"
    assert tag("Maple Street", None, None) is None
    assert tag(None, None, None) is None


def test_excluded_names_keep_unnamed_rows(spark):
    assert value(spark, S.not_excluded(F.lit("Terminal Island"))) is False
    assert value(spark, S.not_excluded(F.lit(None).cast("string"))) is True
    assert value(spark, S.slug("noaa-breakwater-", F.lit("Middle Breakwater"))) == "noaa-breakwater-middle-breakwater"
