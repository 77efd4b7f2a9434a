import datetime as dt

import pytest
from cases import T0

from harborflow.operators.quality import quarantined_rows, tag_quality, valid_rows

COLUMNS = "mmsi string, lat double, lon double, sog double, event_time timestamp, ingested_at timestamp"


def row(mmsi="367625810", lat=33.73, lon=-118.22, sog=5.2, late=2.0, ingested=True):
    return (mmsi, lat, lon, sog, T0, T0 + dt.timedelta(seconds=late) if ingested else None)


CASES = {
    "valid": (row(), None),
    "latitude": (row(lat=40.0), "lat:in_range"),
    "longitude": (row(lon=-100.0), "lon:in_range"),
    "negative_speed": (row(sog=-1.0), "sog:in_range"),
    "speed_not_available": (row(sog=102.3), "sog:in_range"),
    "speed_nan": (row(sog=float("nan")), "sog:in_range"),
    "short_number": (row(mmsi="12345"), "mmsi:str_matches"),
    "letter_in_number": (row(mmsi="36762581X"), "mmsi:str_matches"),
    "skew_too_long": (row(late=600), "timestamp_skew"),
    "skew_negative": (row(late=-600), "timestamp_skew"),
    "skew_short": (row(late=240), None),
    "skew_at_the_limit": (row(late=300), None),
    "no_receipt_time": (row(ingested=False), None),
    "bounds_are_inclusive": (row(lat=33.55, lon=-118.05, sog=40.0), None),
    "several": (row(lat=40.0, sog=-1.0, mmsi="bad"), "mmsi:str_matches,lat:in_range,sog:in_range"),
    "nulls": (row(mmsi=None, lat=None, lon=None, sog=None),
              "mmsi:not_nullable,lat:not_nullable,lon:not_nullable,sog:not_nullable"),
}


@pytest.fixture(scope="module")
def results(spark):
    df = spark.createDataFrame([r for r, _ in CASES.values()], COLUMNS).coalesce(1)
    return dict(zip(CASES, tag_quality(df).collect(), strict=True))


@pytest.mark.parametrize("name", CASES)
def test_reasons(results, name):
    expected = CASES[name][1]
    assert results[name]["quality_failures"] == expected
    assert results[name]["quality_ok"] is (expected is None)


def test_split_keeps_every_row_once(spark):
    df = spark.createDataFrame([row("111111111"), row("222222222", lat=99.0), row("333333333")], COLUMNS)
    tagged = tag_quality(df)
    assert [r["mmsi"] for r in valid_rows(tagged).collect()] == ["111111111", "333333333"]
    bad = quarantined_rows(tagged).collect()
    assert [r["mmsi"] for r in bad] == ["222222222"] and bad[0]["quality_failures"] == "lat:in_range"


def test_tagging_stays_in_the_jvm(spark):
    plan = tag_quality(spark.createDataFrame([row()], COLUMNS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInPandas" not in plan


def test_bounds_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([row()], COLUMNS).write.parquet(str(tmp_path / "p"))
    valid = valid_rows(tag_quality(spark.read.schema(COLUMNS).parquet(str(tmp_path / "p"))))
    plan = valid._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(lat,33.55)" in plan and "LessThanOrEqual(sog,40.0)" in plan
    assert "concat_ws" not in plan and valid.count() == 1
