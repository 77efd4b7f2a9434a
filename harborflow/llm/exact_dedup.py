"""Exact deduplication as a stream with keyed state.

Files of documents arrive as a stream. The state, one entry a digest, on disk in RocksDB, never expires. It retains the
digest, the count, and of the best document its length, stable identifier and content locator (file and row). Only
built-in streaming aggregation is used; the state is then read back as a table, and every document whose digest was hit more
than once is compared, byte by byte, with the text at the locator. Texts that only share a digest are regrouped by
their bytes.

Texts are equal when identical without the white space 0x20 and 0x09-0x0D. Of equal texts the row with the most code
points stays, then the smallest doc_id, then the last locator. Edge cases: null text is empty, and empty texts are equal; a null
doc_id loses ties; repeated rows are separate rows of which one stays; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborflow.llm.stages import Stages
from harborflow.session import new_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Session settings of the stream; the state lives under the shared folder, RocksDB's memory is bounded per executor.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "300",
    # Many small stores: no megabytes set aside in advance for each.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """Text without white space; successive literal replacements stay in generated code."""
    out = F.coalesce(text, F.lit(""))
    for c in " \t\n\x0b\x0c\r":
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _located(frame: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    text = normalised(F.col("text"))
    points = F.length(F.coalesce(F.col("text"), F.lit(""))).cast("long")
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    best = F.struct(points.alias("points"), F.bitwise_not(F.col("doc_id").cast("long")).alias("order"), place.alias("place"))
    return frame.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("norm"), digest(text).alias("digest"), best.alias("me"))


def _glob(path: str) -> str:
    """A pattern that matches only this path; the file stream takes a single file only as a pattern."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def keyed_state(
    spark: SparkSession, path: str, checkpoint: str, digest: Callable[[Column], Column] = sha256, bytes_per_trigger: str | None = None
) -> DataFrame:
    """Run the stream over all files that are there, then read its state: digest, best, copies.

    A later call with the same checkpoint goes on with the files that have come since.
    """
    before = {k: spark.conf.get(k, None) for k in STREAM_CONF}
    for key, value in STREAM_CONF.items():
        spark.conf.set(key, value)
    try:
        reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFileAge", "36500d")
        if bytes_per_trigger:
            reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
        arrived = _located(reader.parquet(_glob(path)), digest)
        state = arrived.groupBy("digest").agg(F.max("me").alias("best"), F.count(F.lit(1)).alias("copies"))
        query = state.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    held = spark.read.format("statestore").load(checkpoint)
    key, value = held.schema["key"].dataType.names, held.schema["value"].dataType.names
    return held.select(F.col("key")[key[0]].alias("digest"), F.col("value")[value[0]].alias("best"), F.col("value")[value[1]].alias("copies"))


def exact_dedup(
    spark: SparkSession, path: str, digest: Callable[[Column], Column] = sha256, checkpoint: str | None = None, bytes_per_trigger: str | None = None
) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, digest. `digest` may be weaker: bytes decide."""
    steps = Stages(spark, "exact-dedup")
    state = keyed_state(spark, path, checkpoint or new_path(spark, "exact-dedup-state"), digest, bytes_per_trigger)
    docs = _located(spark.read.parquet(path), digest)
    single = docs.drop("norm").join(state, "digest")
    # Hits: only digests met more than once carry their texts on.
    hits = steps.put(docs.join(state.filter(F.col("copies") > 1), "digest"), "hits")
    stays = hits.filter(F.col("me") == F.col("best")).select("digest", F.col("norm").alias("kept_norm"))
    clash = hits.join(stays, "digest").filter(F.col("norm") != F.col("kept_norm")).select("digest").distinct()
    clash = steps.put(clash, "clashes")
    # Texts that only share a digest: grouped by their bytes instead.
    mixed = hits.drop("best", "copies").join(clash, "digest", "left_semi")
    groups = mixed.groupBy("digest", "norm").agg(F.max("me").alias("best"), F.count(F.lit(1)).alias("copies"))
    apart = mixed.join(groups, ["digest", "norm"]).select(single.columns)
    out = single.join(clash, "digest", "left_anti").unionByName(apart)
    return out.select(
        "doc_id", F.bitwise_not(F.col("best.order")).alias("keep_id"), F.col("copies").alias("group_size"),
        (F.col("me") == F.col("best")).alias("kept"), "digest",
    )
