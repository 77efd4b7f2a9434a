"""The two alternatives the design was measured against: not part of the library.

`asof_range_join` pairs every position with all earlier transitions of its vessel and ranks them;
`state_grouped_pandas` folds each vessel's rows in a Python worker.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import harborflow
from harborflow.operators.asof import state_as_of
from harborflow.operators.state_machine import observations
from harborflow.schemas import STATE_CHANGES
from harborflow.session import store
from harborflow.streaming.state import _EMPTY, Tracker, _frame
from workload import mapping as M

_stored: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}


def _inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Silver and changes, stored once so that only the compared operator is timed."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _stored:
        silver = store(M.silver(spark, sf), "silver")
        _stored[key] = silver, store(M.changes(spark, sf, silver), "changes")
    return _stored[key]


def asof_time_line(spark: SparkSession, sf: str) -> DataFrame:
    silver, changes = _inputs(spark, sf)
    return state_as_of(silver.select("mmsi", "event_time", "partition", "offset"), changes)


def asof_range_join(spark: SparkSession, sf: str) -> DataFrame:
    silver, changes = _inputs(spark, sf)
    p = silver.select("mmsi", "event_time", "partition", "offset").alias("p")
    t = changes.filter("event_type = 'state_transition'").select("mmsi", "transition_time", "to_state").alias("t")
    paired = p.join(t, (F.col("p.mmsi") == F.col("t.mmsi")) & (F.col("t.transition_time") <= F.col("p.event_time")), "left")
    w = Window.partitionBy("p.mmsi", "p.event_time", "p.partition", "p.offset").orderBy(
        F.col("t.transition_time").desc(), F.col("t.to_state").desc()
    )
    ranked = paired.select("p.*", "t.to_state", F.row_number().over(w).alias("rank"))
    return ranked.filter("rank = 1").drop("rank")


def state_windows(spark: SparkSession, sf: str) -> DataFrame:
    silver, _ = _inputs(spark, sf)
    return M.changes(spark, sf, silver)


def state_grouped_pandas(spark: SparkSession, sf: str) -> DataFrame:
    silver, _ = _inputs(spark, sf)
    cloudpickle.register_pickle_by_value(harborflow)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    def fold(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["t", "offset"]).assign(lat=0.0, lon=0.0, sog=0.0)
        rows["zone_id"] = rows["zone_id"].astype(object).where(rows["zone_id"].notna(), None)
        events = Tracker(M.DEBOUNCE, M.DISCREPANCY, M.EXPIRY).advance(dict(_EMPTY), rows.reset_index(drop=True))
        return _frame(key[0], events)

    return observations(silver).groupBy("mmsi").applyInPandas(fold, STATE_CHANGES)


COMPARISONS = {
    f.__name__: f for f in (asof_time_line, asof_range_join, state_windows, state_grouped_pandas)
}
