"""Domain constants shared by the batch and the streaming forms."""

# ---------------------------------------------------------------------------
# Thresholds, codes and names that results depend on.
# ---------------------------------------------------------------------------

UNDERWAY = "UNDERWAY"
AT_ANCHOR = "AT_ANCHOR"
MOORED = "MOORED"
UNKNOWN = "UNKNOWN"
EXPIRED = "EXPIRED"
OTHER = "OTHER"
VESSEL_STATES = [UNDERWAY, AT_ANCHOR, MOORED]

STATE_TRANSITION = "state_transition"
DISCREPANCY_FLAGGED = "discrepancy_flagged"
DISCREPANCY_CLEARED = "discrepancy_cleared"

# Below this speed (knots) a vessel inside a zone counts as stationary.
SOG_THRESHOLD_KN = 0.5

DEBOUNCE_SECONDS = 5 * 60
DISCREPANCY_SECONDS = 15 * 60
EXPIRY_SECONDS = 30 * 60
WATERMARK_DELAY = "10 minutes"
# A report delivered again within this time (of processing) is recognised across micro-batches.
REDELIVERY_SECONDS = 3600
TRIGGER_INTERVAL = "30 seconds"

# AIS navigational status code -> comparable state; every other code is OTHER.
REPORTED_BUCKETS = {0: UNDERWAY, 1: AT_ANCHOR, 5: MOORED, 8: UNDERWAY}

# State of a slow vessel by the type of the zone it lies in.
STATIONARY_STATE_BY_ZONE = {"berth": MOORED, "anchorage": AT_ANCHOR}

# Lower wins when a position lies in several zones.
ZONE_PRIORITY = {"berth": 0, "anchorage": 1, "harbor": 2}
ZONE_PRIORITY_OTHER = 3

ZONE_TYPES = ["anchorage", "berth", "channel", "harbor"]
ZONE_TYPES_IN_MODELS = ["anchorage", "berth", "harbor"]
ZONE_AUTHORITIES = ["CFR", "OSM", "NOAA"]
ZONE_REQUIRED = ["zone_id", "zone_type", "authority", "source_ref"]

# Quality bounds (inclusive) and the largest tolerated clock skew.
LAT_RANGE = (33.55, 33.78)
LON_RANGE = (-118.30, -118.05)
SOG_RANGE = (0.0, 40.0)
MMSI_PATTERN = r"^\d{9}$"
MAX_SKEW_SECONDS = 5 * 60

# Message envelope and routing.
TOPIC_BY_MESSAGE_TYPE = {
    "PositionReport": "ais.raw.positions",
    "ShipStaticData": "ais.raw.static",
}
DEAD_LETTER_TOPIC = "ais.deadletter"
STATE_CHANGE_TOPIC = "vessel.state.changes"
ENVELOPE_SOURCE = "aisstream"
ENVELOPE_VERSION = 1
FRAME_HEADER_BYTES = 5
FEED_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

YARD_IN_METRES = 0.9144
BREAKWATER_HALF_WIDTH_M = 10.0
CIRCLE_SEGMENTS_PER_QUADRANT = 32
BEND_SEGMENTS_PER_QUADRANT = 16

# Terminal operator -> name fragments that identify it, first operator wins.
OPERATOR_ALIASES = {
    "APM": ["apm terminals", "pier 400", "apm"],
    "TraPac": ["trapac"],
    "LBCT": ["long beach container terminal", "lbct"],
    "Everport": ["everport"],
    "ITS": ["international transportation service", "its terminal"],
    "APL": ["apl "],
    "YTI": ["yusen", "yti"],
    "PCT": ["pacific container terminal", "pct"],
}
EXCLUDED_AREA_NAMES = ["Port of Los Angeles", "Port of Long Beach", "Terminal Island"]

# Zone pairs that are meant to overlap.
ALLOWED_OVERLAPS = [
    ("cfr-anchorage-b", "cfr-anchorage-b-7"),
    ("cfr-anchorage-b", "cfr-anchorage-b-9"),
    ("cfr-anchorage-b", "cfr-anchorage-b-11"),
    ("cfr-anchorage-d", "cfr-anchorage-d-5"),
    ("cfr-anchorage-d", "cfr-anchorage-d-6"),
    ("cfr-anchorage-d", "cfr-anchorage-d-7"),
    ("cfr-anchorage-explosives", "cfr-anchorage-c"),
    ("cfr-anchorage-explosives", "cfr-anchorage-d"),
    ("cfr-anchorage-explosives", "cfr-anchorage-f"),
    ("cfr-anchorage-explosives", "cfr-anchorage-d-6"),
    ("cfr-anchorage-explosives", "cfr-anchorage-d-7"),
]

# Source table -> (load-time column, warn after minutes, error after minutes).
FRESHNESS = {
    "positions_silver": ("ingested_at", 15, 30),
    "vessel_state_changes": ("transition_time", 15, 30),
    "ship_static": ("ingested_at", 60, 180),
}
