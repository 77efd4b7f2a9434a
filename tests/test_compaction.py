import os

import pytest
from pyspark.sql import functions as F

from harborflow.sources import compaction, tables
from harborflow.sources.compaction import compact, load_folders, small_folders
from harborflow.sources.manifest import COMPACTED

DAYS = ("event_date",)
SCHEMA = "n int, event_date date"


def batch(spark, first, days=("2024-01-01", "2024-01-02")):
    return spark.createDataFrame([(first + i, d) for i, d in enumerate(days)], "n int, event_date string").withColumn(
        "event_date", F.to_date("event_date")
    )


def fill(spark, base, batches=10, writer="w", days=("2024-01-01", "2024-01-02")):
    for b in range(batches):
        tables.append_batch(batch(spark, 10 * b, days), base, "t", b, partition_by=DAYS, writer=writer)


def numbers(df):
    return sorted(r["n"] for r in df.collect())


def stored(spark, base):
    return tables.read_table(spark, base, "t", tables_schema(spark))


def tables_schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def test_loads_become_few_files(spark, base):
    fill(spark, base)
    tables.write_load(batch(spark, 500), base, "t", "history", partition_by=DAYS)
    want = numbers(stored(spark, base))
    assert compact(spark, base, "t", min_loads=4) == 18
    assert numbers(stored(spark, base)) == want
    # A day holds one compacted load, the last batch and the batch job's load: three folders of one file.
    compact(spark, base, "t", min_loads=4)
    left = load_folders(spark, base, "t").groupBy("event_date").agg(F.sum("files").alias("n")).collect()
    assert [r["n"] for r in left] == [3, 3] and numbers(stored(spark, base)) == want
    assert stored(spark, base).schema["event_date"].dataType.typeName() == "date"


def test_readers_see_old_or_new(spark, base, monkeypatch):
    """A reader between any two steps sees every row once; a run that fails before it publishes changes nothing."""
    fill(spark, base)
    want = numbers(stored(spark, base))
    early = stored(spark, base)
    seen = []
    publish = compaction.write_manifest

    def fail(*args):
        seen.append(numbers(stored(spark, base)))
        raise RuntimeError("lost")

    monkeypatch.setattr(compaction, "write_manifest", fail)
    with pytest.raises(RuntimeError):
        compact(spark, base, "t", min_loads=4)
    folders = load_folders(spark, base, "t").filter(F.col("load").startswith(COMPACTED)).count()
    assert seen == [want] and folders == 2 and numbers(stored(spark, base)) == want

    def watched(*args):
        seen.append(numbers(stored(spark, base)))
        publish(*args)
        seen.append(numbers(stored(spark, base)))

    monkeypatch.setattr(compaction, "write_manifest", watched)
    assert compact(spark, base, "t", min_loads=4) == 18
    assert seen == [want] * 3
    # Whoever listed the table before still finds the replaced files.
    assert numbers(early) == want
    loads = load_folders(spark, base, "t").filter(F.col("load").startswith(COMPACTED)).select("load").distinct()
    assert loads.count() == 1


def test_late_loads_and_replayed_batches(spark, base):
    fill(spark, base)
    compact(spark, base, "t", min_loads=4)
    # The last batch again, as after a restart, then more batches of a closed day.
    tables.append_batch(batch(spark, 90), base, "t", 9, partition_by=DAYS, writer="w")
    for b in range(10, 15):
        tables.append_batch(batch(spark, 10 * b, ("2024-01-01",)), base, "t", b, partition_by=DAYS, writer="w")
    want = sorted([10 * b for b in range(15)] + [10 * b + 1 for b in range(10)])
    assert numbers(stored(spark, base)) == want
    # The first day merges its compacted load as well; the second has one small folder and one that nothing replays any more.
    assert compact(spark, base, "t", min_loads=4) == 6
    assert numbers(stored(spark, base)) == want
    assert compact(spark, base, "t", min_loads=4) == 0 and numbers(stored(spark, base)) == want


def test_only_closed_partitions_and_small_folders(spark, base):
    fill(spark, base, 6)
    closed = F.col("event_date") < F.lit("2024-01-02").cast("date")
    assert {str(r["event_date"]) for r in small_folders(spark, base, "t", closed, min_loads=2).collect()} == {"2024-01-01"}
    assert compact(spark, base, "t", closed=closed, min_loads=2, small_bytes=1) == 0
    assert compact(spark, base, "t", closed=closed, min_loads=2) == 5


def test_table_without_partitions(spark, base):
    for b in range(6):
        tables.append_batch(spark.createDataFrame([(b,)], "n int"), base, "u", b, writer="w")
    assert compact(spark, base, "u", min_loads=2) == 5
    assert numbers(tables.read_table(spark, base, "u")) == list(range(6))
    assert compact(spark, base, "u", min_loads=2) == 0
    assert load_folders(spark, base, "u").count() == 2


def test_load_loses_its_absent_days(spark, base):
    tables.write_load(batch(spark, 1), base, "t", "history", partition_by=DAYS)
    tables.append_batch(batch(spark, 10), base, "t", 0, partition_by=DAYS, writer="w")
    tables.write_load(batch(spark, 3, ("2024-01-02",)), base, "t", "history", partition_by=DAYS)
    assert numbers(stored(spark, base)) == [3, 10, 11]
    assert not os.path.exists(f"{base}/t/event_date=2024-01-01/load=history")
    for name in ("w-1", COMPACTED + "x"):
        with pytest.raises(ValueError):
            tables.write_load(batch(spark, 1), base, "t", name, partition_by=DAYS)
