"""Table tests with one result shape: (check, table, column, severity, failures, status)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborflow import constants as K
from harborflow.operators.validity import FAULTS, zone_faults
from harborflow.schemas import CHECK_RESULT


def _result(counted: DataFrame, check: str | Column, table: str, column: Column, severity: str) -> DataFrame:
    name = F.lit(check) if isinstance(check, str) else check
    failed = F.lit("warn" if severity == "warn" else "error")
    return counted.select(
        name.alias("check"), F.lit(table).alias("table"), column.alias("column"),
        F.lit(severity).alias("severity"), F.col("failures").cast("long").alias("failures"),
        F.when(F.col("failures") == 0, F.lit("pass")).otherwise(failed).alias("status"),
    )


def unique(df: DataFrame, table: str, column: str, severity: str = "error") -> DataFrame:
    """Failures: values that occur more than once. Nulls are ignored."""
    repeated = df.filter(F.col(column).isNotNull()).groupBy(column).count().filter("count > 1")
    return _result(repeated.agg(F.count(F.lit(1)).alias("failures")), "unique", table, F.lit(column), severity)


def not_null(df: DataFrame, table: str, columns: Sequence[str], severity: str = "error") -> DataFrame:
    """Failures: rows with a null; all columns are counted in one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot([], list(columns), "_column", "failures")
    return _result(long, "not_null", table, F.col("_column"), severity)


def accepted_values(
    df: DataFrame, table: str, column: str, values: Sequence[str], severity: str = "error"
) -> DataFrame:
    """Failures: distinct values off the list. Nulls pass."""
    off_list = df.filter(~F.col(column).isin(*values)).agg(F.count_distinct(column).alias("failures"))
    return _result(off_list, "accepted_values", table, F.lit(column), severity)


def relationships(
    child: DataFrame, table: str, column: str, parent: DataFrame, field: str, severity: str = "error"
) -> DataFrame:
    """Failures: child rows whose non-null key is missing from the parent.

    Child rows are counted per key before the anti join, so a frequent key costs one row.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key")).count()
    orphans = keys.join(parent.select(F.col(field).alias("_key")), "_key", "left_anti")
    counted = orphans.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("failures"))
    return _result(counted, "relationships", table, F.lit(column), severity)


def missing_keys(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Keys asked for that have no row."""
    return wanted.select(key).distinct().join(present.select(key).distinct(), key, "left_anti")


def freshness(
    df: DataFrame, table: str, loaded_at: str, warn_minutes: int, error_minutes: int,
    as_of: Column | None = None,
) -> DataFrame:
    """Age of the newest row against two limits. An empty table is stale."""
    as_of = F.current_timestamp() if as_of is None else as_of
    newest = df.agg(F.max(loaded_at).alias("loaded_at"))
    age = F.unix_micros(as_of) - F.unix_micros("loaded_at")
    status = (
        F.when(age.isNull() | (age > error_minutes * 60_000_000), "error")
        .when(age > warn_minutes * 60_000_000, "warn").otherwise("pass")
    )
    return newest.select(
        F.lit("freshness").alias("check"), F.lit(table).alias("table"), F.lit(loaded_at).alias("column"),
        status.alias("severity"), F.when(status == "pass", 0).otherwise(1).cast("long").alias("failures"),
        status.alias("status"),
    )


def zone_checks(zones: DataFrame, table: str = "zones") -> DataFrame:
    """Required properties, enumerations, duplicate ids, valid shapes: `valid_shape` counts zones with any fault, the others by fault."""
    present = zones.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in K.ZONE_REQUIRED])
    counts = [F.count_if(F.col("fault") == fault).alias(f"no_{fault}") for fault in FAULTS]
    faults = zone_faults(zones).agg(F.count(F.lit(1)).alias("valid_shape"), *counts).unpivot([], None, "_check", "failures")
    return run_checks([
        not_null(present, table, K.ZONE_REQUIRED),
        accepted_values(zones, table, "zone_type", K.ZONE_TYPES),
        accepted_values(zones, table, "authority", K.ZONE_AUTHORITIES),
        unique(zones, table, "zone_id"),
        _result(faults, F.col("_check"), table, F.lit("shape"), "error"),
    ])


def run_checks(results: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results).to(CHECK_RESULT)
