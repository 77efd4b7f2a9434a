"""Declared schemas. Nothing in the library infers one."""

from pyspark.sql import types as T

_S, _I, _L, _D, _B, _TS = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType(),
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# --- wire messages ---------------------------------------------------------

_METADATA = _struct(
    MMSI=_L, MMSI_String=_L, ShipName=_S, latitude=_D, longitude=_D, time_utc=_S,
)

_POSITION_REPORT = _struct(
    Cog=_D, CommunicationState=_L, Latitude=_D, Longitude=_D, MessageID=_I,
    NavigationalStatus=_I, PositionAccuracy=_B, Raim=_B, RateOfTurn=_I, RepeatIndicator=_I,
    Sog=_D, Spare=_I, SpecialManoeuvreIndicator=_I, Timestamp=_I, TrueHeading=_I, UserID=_L,
    Valid=_B,
)

# `Spare` really is a boolean here and an integer in position reports.
_SHIP_STATIC = _struct(
    AisVersion=_I, CallSign=_S, Destination=_S, Dimension=_struct(A=_I, B=_I, C=_I, D=_I),
    Dte=_B, Eta=_struct(Day=_I, Hour=_I, Minute=_I, Month=_I), FixType=_I, ImoNumber=_L,
    MaximumStaticDraught=_D, MessageID=_I, Name=_S, RepeatIndicator=_I, Spare=_B, Type=_I,
    UserID=_L, Valid=_B,
)


def _envelope(message: T.StructType) -> T.StructType:
    return _struct(
        ingested_at=_S, source=_S, schema_version=_I,
        payload=_struct(MessageType=_S, MetaData=_METADATA, Message=message),
    )


POSITION_ENVELOPE = _envelope(_struct(PositionReport=_POSITION_REPORT))
STATIC_ENVELOPE = _envelope(_struct(ShipStaticData=_SHIP_STATIC))

# The little the router has to see of a feed message.
FEED_HEADER = _struct(MessageType=_S, MetaData=_struct(MMSI=_S))

# Topic rows as the `kafka` source gives them; file sources in tests use the same shape.
TOPIC_ROW = _struct(key=T.BinaryType(), value=T.BinaryType(), topic=_S, partition=_I, offset=_L, timestamp=_TS)

# --- tables ----------------------------------------------------------------

POSITIONS = _struct(
    mmsi=_S, event_time=_TS, ingested_at=_TS, lat=_D, lon=_D, sog=_D, nav_status_code=_I,
    partition=_I, offset=_L,
)

POSITIONS_SILVER = _struct(
    mmsi=_S, event_time=_TS, event_date=T.DateType(), lat=_D, lon=_D, sog=_D, nav_status_code=_I,
    zone_id=_S, zone_type=_S, zone_name=_S, ingested_at=_TS, partition=_I, offset=_L,
)

POSITIONS_QUARANTINE = _struct(
    mmsi=_S, event_time=_TS, lat=_D, lon=_D, sog=_D, nav_status_code=_I, partition=_I, offset=_L,
    ingested_at=_TS, quality_failures=_S, quarantined_at=_TS,
)

STATE_CHANGES = _struct(
    mmsi=_S, event_type=_S, from_state=_S, to_state=_S, zone_id=_S, derived_state=_S,
    reported_status=_S, transition_time=_TS,
)

# What the state stream gives: a state change, or how many rows of a vessel came too late to be applied.
TRACKED = T.StructType([*STATE_CHANGES.fields, T.StructField("late_rows", _L)])

LATE = _struct(mmsi=_S, late_rows=_L)

SHIP_STATIC = _struct(
    mmsi=_S, ship_name=_S, call_sign=_S, ship_type_code=_I, destination=_S, imo_number=_L,
    max_static_draught=_D, ingested_at=_TS,
)

POINT = _struct(x=_D, y=_D)
RING = T.ArrayType(POINT)
# Polygons, each an outer ring and its holes.
SHAPE = T.ArrayType(T.ArrayType(RING))
ZONES = _struct(zone_id=_S, zone_type=_S, authority=_S, source_ref=_S, name=_S, shape=SHAPE)

# How deep coordinates are nested depends on the geometry's type, so they are read as text first.
GEOJSON_POLYGON = T.ArrayType(T.ArrayType(T.ArrayType(_D)))
GEOJSON_MULTI_POLYGON = T.ArrayType(GEOJSON_POLYGON)
GEOJSON_FEATURE = _struct(
    type=_S,
    properties=_struct(zone_id=_S, zone_type=_S, authority=_S, source_ref=_S, name=_S),
    geometry=_struct(type=_S, coordinates=_S),
)
GEOJSON_COLLECTION = _struct(type=_S, features=T.ArrayType(GEOJSON_FEATURE))

CHECK_RESULT = T.StructType([
    T.StructField("check", _S), T.StructField("table", _S), T.StructField("column", _S),
    T.StructField("severity", _S), T.StructField("failures", _L), T.StructField("status", _S),
])
