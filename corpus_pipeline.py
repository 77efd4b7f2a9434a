"""Pipeline from raw documents to packed sequences; each stage is one operator of harborflow.llm.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but the last return the columns of
documents. `run` writes each stage's result to the folder that all executors share before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborflow.llm import jaccard_join, line_dedup, mixing, packing, quality_classifier
from harborflow.llm.names import free_names
from harborflow.llm.stages import Stages


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from labels outside its held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    fold = quality_classifier.bucket_of(F.col("doc_id"), 5)
    rules = quality_classifier.train(docs, labels.filter(fold != 0))
    scored = quality_classifier.score_quality(docs, rules)
    return scored.filter(F.col("score") >= quality_classifier.THRESHOLD).select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that occurred before, alike or nearly; documents without any line left go."""
    return line_dedup.deduplicated_texts(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group that links of five-word shingles connect. Documents without a
    doc_id come after all others and are told apart by their place; the first of a group without any doc_id stays.
    """
    if docs.filter(F.col("doc_id").isNull()).isEmpty():
        return _smallest(docs, "doc_id")
    (number,) = free_names(docs.columns, "_number")
    place = F.lit(2**62) + F.monotonically_increasing_id()
    numbered = docs.withColumn(number, F.coalesce(F.col("doc_id").cast("long"), place))
    # Written, so that a place does not depend on which task reads which file when a lost one is run again.
    numbered = Stages(spark, "pipeline").put(numbered, "numbered")
    return _smallest(numbered, number).drop(number)


def _smallest(docs: DataFrame, number: str) -> DataFrame:
    groups = jaccard_join.jaccard_join(docs.select(F.col(number).alias("doc_id"), "text"), words=5, share=(4, 5))
    keep = groups.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_keep")).distinct()
    return docs.join(keep, docs[number] == keep["_keep"], "left_semi")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts as often, and as far, as the mix takes them."""
    return mixing.mixed_texts(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(docs, payload=packing.crc)
    return packed.withColumn("ids_crc32", F.conv(F.hex("payload"), 16, 10).cast("long")).drop("payload")


STAGES = [("quality classifier", quality), ("line dedup", lines), ("n-gram jaccard join", near_duplicates), ("source mixing", mix), ("packing", pack)]

# Models, edit distances, set similarity and tokenisation are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = Stages(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        docs = steps.put(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            steps.drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
