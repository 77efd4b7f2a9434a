"""As-of join: the latest transition at or before each position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborflow import constants as K
from harborflow.operators.ordered import ordered_parts, run_on_parts


def state_as_of(
    positions: DataFrame,
    transitions: DataFrame,
    tie: Sequence[str] = ("partition", "offset"),
    max_rows: int | None = None,
) -> DataFrame:
    """Positions with `derived_state`, null before the first transition of the vessel.

    Both sides are laid into one time line per vessel and scanned once, so no position is ever paired
    with all earlier transitions. Of transitions at the same instant EXPIRED counts as the later one.
    """
    carried = [c for c in positions.columns if c not in ("mmsi", "event_time", *tie)]
    # Rows without a vessel match nothing: each gets a window of its own instead of all sharing one.
    keyed = positions.withColumn("spread", F.when(F.col("mmsi").isNull(), F.xxhash64(*tie)).otherwise(F.lit(0)))
    left = keyed.select(
        "mmsi", "spread", F.col("event_time").alias("at"), F.lit(2).alias("side"),
        F.struct(*tie).alias("tie"), F.struct(F.lit(1).alias("_"), *carried).alias("row"),
        F.lit(None).cast("string").alias("to_state"),
    )
    right = transitions.filter((F.col("event_type") == K.STATE_TRANSITION) & F.col("mmsi").isNotNull()).select(
        "mmsi", F.lit(0).cast("long").alias("spread"), F.col("transition_time").alias("at"),
        F.when(F.col("to_state") == K.EXPIRED, 1).otherwise(0).alias("side"), "to_state",
    )
    line = left.unionByName(right, allowMissingColumns=True)
    # Every vessel's transitions are bounded by time, so the positions alone decide what is hot.
    parts = ordered_parts(
        line, ["mmsi", "spread"], ["at", "side", "tie", "to_state"],
        count_from=keyed.select("mmsi", "spread"), max_rows=max_rows,
    )
    return run_on_parts(
        parts,
        lambda part: part.scan(upto={"derived_state": F.col("to_state")}).df.filter("side = 2").select(
            "mmsi", F.col("at").alias("event_time"), *[F.col(f"tie.{c}").alias(c) for c in tie],
            *[F.col(f"row.{c}").alias(c) for c in carried], "derived_state",
        ),
    )
