"""How often the derived state agrees with what vessels report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborflow import constants as K
from harborflow.functions.scalars import reported_bucket
from harborflow.operators.asof import state_as_of
from harborflow.operators.checks import missing_keys
from harborflow.operators.dedup import top_keys

# Every (derived, reported) pair has its own bit; EXPIRED can be derived but never agrees.
_DERIVED = [*K.VESSEL_STATES, K.EXPIRED]


def trailing_window(positions: DataFrame, hours: float) -> DataFrame:
    """Positions of the last `hours` before the newest one, both ends included.

    The bound is a scalar subquery; with an `event_date` partition column whole days are pruned.
    """
    newest = positions.agg(F.max("event_time")).scalar()
    start = F.timestamp_micros(F.unix_micros(newest) - F.lit(int(hours * 3_600_000_000)))
    in_window = (F.col("event_time") >= start) & (F.col("event_time") <= newest)
    if "event_date" in positions.columns:
        in_window = in_window & (F.col("event_date") >= F.to_date(start))
    return positions.filter(in_window)


def _pair_bit() -> Column:
    number = F.lit(None).cast("int")
    for i, derived in enumerate(_DERIVED):
        for j, reported in enumerate(K.VESSEL_STATES):
            hit = (F.col("derived_state") == derived) & (F.col("reported_status") == reported)
            number = F.when(hit, F.lit(i * len(K.VESSEL_STATES) + j)).otherwise(number)
    return F.call_function("shiftleft", F.lit(1).cast("long"), number)


def comparable_positions(
    positions: DataFrame, changes: DataFrame, vessels: DataFrame, max_rows: int | None = None
) -> DataFrame:
    """Positions of the chosen vessels whose derived and reported states can be compared."""
    chosen = positions.join(vessels.select("mmsi"), "mmsi", "left_semi")
    their_changes = changes.join(vessels.select("mmsi"), "mmsi", "left_semi")
    joined = state_as_of(
        chosen.select("mmsi", "event_time", "partition", "offset", "nav_status_code"), their_changes,
        max_rows=max_rows,
    ).withColumn("reported_status", reported_bucket(F.col("nav_status_code")))
    return joined.filter(
        (F.col("reported_status") != K.OTHER) & F.col("derived_state").isNotNull()
    ).withColumn("agrees", F.col("derived_state") == F.col("reported_status"))


def agreement(comparable: DataFrame) -> DataFrame:
    """One row per vessel and one with a null vessel for all of them.

    The overall row is summed from the vessels' rows, so positions are aggregated once.
    `trivial_window` warns that at most one pair of states was ever seen.
    """
    per_vessel = comparable.groupBy("mmsi").agg(
        F.count(F.lit(1)).alias("n_comparable"), F.count_if("agrees").alias("n_agree"),
        F.bit_or(_pair_bit()).alias("_pairs"),
    )
    overall = per_vessel.agg(
        F.lit(None).cast("string").alias("mmsi"), F.coalesce(F.sum("n_comparable"), F.lit(0)).alias("n_comparable"),
        F.coalesce(F.sum("n_agree"), F.lit(0)).alias("n_agree"), F.bit_or("_pairs").alias("_pairs"),
    )
    pairs = F.coalesce(F.bit_count("_pairs"), F.lit(0)).cast("long")
    return per_vessel.unionByName(overall).select(
        "mmsi", "n_comparable", F.try_divide(F.col("n_agree"), F.col("n_comparable")).alias("agreement_rate"),
        pairs.alias("state_pairs"), (pairs <= 1).alias("trivial_window"),
    )


def agreement_report(
    positions: DataFrame, changes: DataFrame, *, hours: float = 24, n_vessels: int = 5,
    vessels: DataFrame | None = None, max_rows: int | None = None,
) -> dict[str, DataFrame]:
    """Agreement over the trailing window for given vessels or the busiest `n_vessels`."""
    window = trailing_window(positions, hours)
    chosen = vessels if vessels is not None else top_keys(window, "mmsi", n_vessels)
    comparable = comparable_positions(window, changes, chosen, max_rows=max_rows)
    bounds = positions.agg(F.max("event_time").alias("end_time")).select(
        F.timestamp_micros(F.unix_micros("end_time") - F.lit(int(hours * 3_600_000_000))).alias("start_time"),
        "end_time",
    )
    return {
        "agreement": agreement(comparable),
        "vessels": chosen.select("mmsi"),
        "uncovered": missing_keys(chosen, comparable, "mmsi"),
        "bounds": bounds,
    }
