"""Row quality: tag every row, never drop one; callers split valid from quarantined."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborflow import constants as K


class _Rule(NamedTuple):
    """A named check. A rule that `needs` a value gives no reason for a null, whose own rule fails."""

    name: str
    passes: Column
    needs: Column | None = None

    @property
    def reason(self) -> Column:
        failed = ~self.passes if self.needs is None else self.needs.isNotNull() & ~self.passes
        return F.when(failed, F.lit(self.name))


def _required(column: str, check: str, holds: Column) -> list[_Rule]:
    value = F.col(column)
    # NaN fails a range: it is not between any bounds.
    return [_Rule(f"{column}:not_nullable", value.isNotNull()), _Rule(f"{column}:{check}", holds, value)]


def within_skew(event_time: Column, ingested_at: Column, seconds: int = K.MAX_SKEW_SECONDS) -> Column:
    """Exactly the tolerance passes, and so does a missing clock."""
    skew = F.abs(F.unix_micros(ingested_at) - F.unix_micros(event_time))
    return event_time.isNull() | ingested_at.isNull() | (skew <= seconds * 1_000_000)


def tag_quality(
    positions: DataFrame,
    *,
    lat_range: tuple[float, float] = K.LAT_RANGE,
    lon_range: tuple[float, float] = K.LON_RANGE,
    sog_range: tuple[float, float] = K.SOG_RANGE,
    max_skew_seconds: int = K.MAX_SKEW_SECONDS,
) -> DataFrame:
    """Add `quality_ok` and `quality_failures`, a comma-joined list of `column:check`, null when fine."""
    rules = [
        *_required("mmsi", "str_matches", F.col("mmsi").rlike(K.MMSI_PATTERN)),
        *_required("lat", "in_range", F.col("lat").between(*lat_range)),
        *_required("lon", "in_range", F.col("lon").between(*lon_range)),
        *_required("sog", "in_range", F.col("sog").between(*sog_range)),
        _Rule("timestamp_skew", within_skew(F.col("event_time"), F.col("ingested_at"), max_skew_seconds)),
    ]
    # A plain conjunction: a filter on it reaches the scan, and needs none of the reason texts.
    return positions.withColumns({
        "quality_ok": reduce(Column.__and__, [rule.passes for rule in rules]),
        "quality_failures": F.nullif(F.concat_ws(",", *[rule.reason for rule in rules]), F.lit("")),
    })


def valid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter("quality_ok").drop("quality_ok", "quality_failures")


def quarantined_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(~F.col("quality_ok")).drop("quality_ok")
