"""Scalar column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from harborflow import constants as K


def lookup(key: Column, mapping: Mapping, default) -> Column:
    """`mapping[key]` as a CASE expression; null and unknown keys give `default`."""
    result = F
    for value, target in mapping.items():
        result = result.when(key == F.lit(value), F.lit(target))
    return result.otherwise(F.lit(default))


def raw_state(zone_type: Column, sog: Column) -> Column:
    """State suggested by one observation alone. A null speed counts as under way."""
    by_zone = lookup(zone_type, K.STATIONARY_STATE_BY_ZONE, K.UNDERWAY)
    return F.when(sog < K.SOG_THRESHOLD_KN, by_zone).otherwise(F.lit(K.UNDERWAY))


def reported_bucket(nav_status_code: Column) -> Column:
    return lookup(nav_status_code, K.REPORTED_BUCKETS, K.OTHER)


def zone_priority(zone_type: Column, priorities: Mapping[str, int] = K.ZONE_PRIORITY) -> Column:
    return lookup(zone_type, priorities, K.ZONE_PRIORITY_OTHER)


def feed_time(text: Column) -> Column:
    """Feed clock text with nanoseconds and zone suffix, to whole seconds; bad text is null."""
    return F.try_to_timestamp(F.substring(text, 1, 19), F.lit(K.FEED_TIME_FORMAT))


def iso_time(text: Column) -> Column:
    return F.try_to_timestamp(text)


def boundary_diff(unit: str, start: Column, end: Column) -> Column:
    """Number of second/minute boundaries crossed between two instants."""
    size = {"second": 1, "minute": 60}[unit]

    def ticks(ts: Column) -> Column:
        return F.floor(F.unix_micros(ts) / F.lit(size * 1_000_000)).cast("long")

    return ticks(end) - ticks(start)


def surrogate_key(*parts: Column) -> Column:
    """md5 over the parts joined by '|'; null if any part is null."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [part.cast("string"), F.lit("|")]
    return F.md5(F.concat(*pieces[:-1]))


def trimmed(text: Column) -> Column:
    """Fixed-width text fields arrive padded with blanks."""
    return F.trim(text)


_DMS_GAP = r"[\s°′″'\"\-]"
_DMS_PATTERN = (
    rf"(?i)^{_DMS_GAP}*(\d{{1,3}}){_DMS_GAP}+(\d{{1,2}}(?:\.\d+)?){_DMS_GAP}+"
    rf"(\d{{1,2}}(?:\.\d+)?){_DMS_GAP}*([NSEW])"
)


def dms_to_degrees(text: Column) -> Column:
    """Degree/minute/second text with hemisphere letter -> signed degrees; null if unreadable."""

    def part(i: int) -> Column:
        return F.regexp_extract(text, _DMS_PATTERN, i)

    degrees = (
        part(1).try_cast("double") + part(2).try_cast("double") / 60 + part(3).try_cast("double") / 3600
    )
    return F.when(F.upper(part(4)).isin("S", "W"), -degrees).otherwise(degrees)


def operator_tag(
    names: Sequence[Column], aliases: Mapping[str, Iterable[str]] = K.OPERATOR_ALIASES
) -> Column:
    """First operator one of whose aliases occurs in the joined, lower-cased names."""
    text = F.lower(F.concat(*[F.concat(F.coalesce(n, F.lit("")), F.lit(" ")) for n in names]))
    result = F
    for code, fragments in aliases.items():
        hit = F.lit(False)
        for fragment in fragments:
            hit = hit | text.contains(fragment)
        result = result.when(hit, F.lit(code))
    return result.otherwise(F.lit(None).cast("string"))


def not_excluded(name: Column, excluded: Sequence[str] = K.EXCLUDED_AREA_NAMES) -> Column:
    """True unless the name is on the list; rows without a name stay."""
    return ~F.coalesce(name.isin(*excluded), F.lit(False))


def slug(prefix: str, name: Column) -> Column:
    return F.concat(F.lit(prefix), F.lower(F.replace(name, F.lit(" "), F.lit("-"))))
