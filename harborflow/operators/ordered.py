"""Per-key ordered scans whose tasks stay bounded when one key holds much of the data.

A window over (key, time) puts every row of a key into one task. Keys are therefore counted first
(one pruned scan with map-side combine). Ordinary keys use the plain window. Rows of keys above
`MAX_ROWS_PER_TASK` are range-partitioned by (key, time) into evenly sized segments, each scanned by
itself; what a row needs from earlier segments is carried over from one summary row per segment.
Both ways give the same values.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborflow.session import store

MAX_ROWS_PER_TASK = 20_000_000
MAX_BROADCAST_KEYS = 500_000

_SEGMENT = "_segment"
_BEFORE = (Window.unboundedPreceding, -1)
_UP_TO = (Window.unboundedPreceding, Window.currentRow)


@dataclass(frozen=True)
class OrderedRows:
    """Rows with a key and a total order within the key; `segmented` rows carry a segment number."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    segmented: bool = False

    def with_columns(self, columns: Mapping[str, Column]) -> OrderedRows:
        return replace(self, df=self.df.withColumns(dict(columns)))

    def scan(
        self, *, before: Mapping[str, Column] | None = None, upto: Mapping[str, Column] | None = None
    ) -> OrderedRows:
        """Add columns holding the latest non-null value among the key's rows strictly before the
        current one (`before`) or up to and including it (`upto`)."""
        wanted = {n: (v, _BEFORE) for n, v in (before or {}).items()}
        wanted |= {n: (v, _UP_TO) for n, v in (upto or {}).items()}
        if not self.segmented:
            window = Window.partitionBy(*self.keys).orderBy(*self.order)
            return self.with_columns({
                n: F.last(v, True).over(window.rowsBetween(*frame)) for n, (v, frame) in wanted.items()
            })

        # The scan reads its input twice: end the lineage in durable files first.
        rows = store(self.df.withColumns({f"_in_{n}": v for n, (v, _) in wanted.items()}), "segments")
        order = F.struct(*self.order).alias("order")
        tails = rows.groupBy(*self.keys, _SEGMENT).agg(*[
            F.max(F.when(F.col(f"_in_{n}").isNotNull(), F.struct(order, F.col(f"_in_{n}").alias("v"))))["v"]
            .alias(f"_tail_{n}")
            for n in wanted
        ])
        # One row per (key, segment).
        earlier = Window.partitionBy(*self.keys).orderBy(_SEGMENT).rowsBetween(*_BEFORE)
        carried = tails.select(
            *self.keys, _SEGMENT,
            *[F.last(f"_tail_{n}", True).over(earlier).alias(f"_carry_{n}") for n in wanted],
        )
        within = Window.partitionBy(*self.keys, _SEGMENT).orderBy(*self.order)
        scanned = rows.withColumns({
            n: F.last(f"_in_{n}", True).over(within.rowsBetween(*frame)) for n, (_, frame) in wanted.items()
        })
        joined = scanned.join(carried, [*self.keys, _SEGMENT], "left")
        merged = joined.withColumns({n: F.coalesce(F.col(n), F.col(f"_carry_{n}")) for n in wanted})
        return replace(self, df=merged.drop(*[f"_in_{n}" for n in wanted], *[f"_carry_{n}" for n in wanted]))

    def mark_last(self, out: str) -> OrderedRows:
        """Add a boolean column, true on the last row of every key."""
        if not self.segmented:
            window = Window.partitionBy(*self.keys).orderBy(*self.order)
            return self.with_columns({out: F.lead(F.lit(1)).over(window).isNull()})
        rows = store(self.df, "segments")
        final = rows.groupBy(*self.keys).agg(F.max(_SEGMENT).alias("_final"))
        within = Window.partitionBy(*self.keys, _SEGMENT).orderBy(*self.order)
        last = F.lead(F.lit(1)).over(within).isNull() & (F.col(_SEGMENT) == F.col("_final"))
        marked = rows.join(final, list(self.keys)).withColumn(out, last)
        return replace(self, df=marked.drop("_final"))


def hot_keys(df: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame:
    """Keys with more than `max_rows` rows and their counts; at most rows / max_rows of them."""
    return df.groupBy(*keys).count().filter(F.col("count") > max_rows)


def ordered_parts(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    count_from: DataFrame | None = None,
    max_rows: int | None = None,
) -> list[OrderedRows]:
    """Split `df` into the rows of ordinary keys and, if there are any, of hot keys.

    `count_from` may name a cheaper table with the same keys whose per-key counts are not smaller
    (the stored source of `df`), so that counting does not run the plan of `df`.
    """
    max_rows = max_rows or MAX_ROWS_PER_TASK
    keys, order = tuple(keys), tuple(order)
    hot = hot_keys(count_from if count_from is not None else df, keys, max_rows)
    total, n_hot = hot.agg(F.sum("count"), F.count(F.lit(1))).first()
    if not n_hot:
        return [OrderedRows(df, keys, order)]

    # Both parts read `df`: run its plan once. The list of hot keys is short, since each accounts for more
    # than max_rows rows, and its size is known.
    df = store(df, "ordered")
    hot_list = store(hot.select(*keys), "hot-keys")
    if n_hot <= MAX_BROADCAST_KEYS:
        hot_list = F.broadcast(hot_list)
    segments = max(2, -(-total // max_rows))
    # The partition number is written out once, so no retry can ever number rows differently.
    hot_rows = store(
        df.join(hot_list, list(keys), "left_semi")
        .repartitionByRange(segments, *keys, *order)
        .withColumn(_SEGMENT, F.spark_partition_id()),
        "hot-rows",
    )
    return [
        OrderedRows(df.join(hot_list, list(keys), "left_anti"), keys, order),
        OrderedRows(hot_rows, keys, order, segmented=True),
    ]


def run_on_parts(parts: Sequence[OrderedRows], plan: Callable[[OrderedRows], DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [plan(part) for part in parts])


def number_rows(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Number all rows 1, 2, ... in a global order without sending them through one task."""
    placed = store(
        df.repartitionByRange(*order).withColumn(_SEGMENT, F.spark_partition_id()), "numbered"
    )
    sizes = placed.groupBy(_SEGMENT).count()
    # One row per partition.
    earlier = Window.orderBy(_SEGMENT).rowsBetween(*_BEFORE)
    offsets = sizes.select(_SEGMENT, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(_SEGMENT).orderBy(*order)
    return (
        placed.withColumn(out, F.row_number().over(within).cast("long"))
        .join(F.broadcast(offsets), _SEGMENT)
        .withColumn(out, F.col(out) + F.col("_offset"))
        .drop(_SEGMENT, "_offset")
    )
