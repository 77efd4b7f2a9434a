"""Mixing sources to target weights.

Every row gets a hash-random key. Within its source, rows are range-sorted by that key in equal key ranges; the sums of
the ranges are prefix-summed over a table of (source, range), the rest inside each range. A row's place in its source's
running total says how many of its words fall before the source's budget. Whole epochs are taken first, then the part.

Edge cases: null or empty text has size 0 and takes 0; a null source is a source of its own, sorted last; a null
doc_id has a key like any other; repeated rows are separate rows; an empty table gives an empty result. The added columns
replace columns of the same names. The words taken of a source are its target rounded down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harborflow.llm.names import free_names

WORD = r"[^\x20\x09-\x0D]+"
# Production mix: weights by rank of the source name, repeating; all targets together as a share of all words; cap.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
SEED = "mix-1:"
ROWS_PER_RANGE = 4_000
ADDED = ("size", "source_size", "target", "taken")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def water_levels(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Target of every source; input: one row a source (_source, source_size). Windows here run over sources, not rows.

    Filled by weight in order of cap over weight: a source whose cap lies under the level that the rest would get is
    filled to its cap, so what it leaves is shared by the others, which is the fixed point of resharing.
    """
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = sources.withColumn("_rank", F.row_number().over(W.orderBy("_source")))
    ranked = ranked.withColumn("_weight", F.element_at(cycle, ((F.col("_rank") - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("_cap", F.col("source_size") * cap)
    order = W.orderBy((F.col("_cap") / F.col("_weight")).asc(), F.col("_source").asc())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.partitionBy()
    level = (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / F.sum(
        "_weight"
    ).over(after)
    filled = ranked.withColumn("_level", level).withColumn("_full", F.col("_cap") <= F.col("_level") * F.col("_weight"))
    rest = F.min(F.when(~F.col("_full"), F.struct((F.col("_cap") / F.col("_weight")).alias("o"), "_source", F.col("_level").alias("l")))).over(
        everything
    )["l"]
    target = F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(F.col("_weight") * rest)
    return filled.select("_source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP, seed: str = SEED, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """All columns of `docs` with size, source_size, target and taken: how many words of the row the mix takes."""
    ranges = max(1, -(-docs.count() // rows_per_range))
    group, key, part, tie, start, inside = free_names([*docs.columns, *ADDED], "_source", "_key", "_range", "_text", "_start", "_inside")
    name = F.when(F.col("source").isNull(), F.lit("b")).otherwise(F.concat(F.lit("a"), F.col("source")))
    hashed = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    rows = docs.drop(*ADDED).withColumns({"size": n_words(F.col("text")), group: name, key: hashed, tie: F.xxhash64("text")})
    rows = rows.withColumn(part, F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * ranges / F.lit(1 << 32)).cast("long"))

    parts = rows.groupBy(F.col(group).alias("_source"), F.col(part).alias("_range")).agg(F.sum("size").alias("_part"))
    targets = water_levels(parts.groupBy("_source").agg(F.sum("_part").alias("source_size")), weights, share, cap)
    earlier = W.partitionBy("_source").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.withColumn("_start", F.coalesce(F.sum("_part").over(earlier), F.lit(0))).join(targets, "_source").select(
        F.col("_source").alias(group), F.col("_range").alias(part), F.col("_start").alias(start), "source_size", "target"
    )

    # Different texts of one doc_id and size keep their order when the mix is run again.
    before = W.partitionBy(group, part).orderBy(key, "doc_id", "size", tie).rowsBetween(W.unboundedPreceding, -1)
    placed = rows.withColumn(inside, F.coalesce(F.sum("size").over(before), F.lit(0))).join(starts, [group, part])
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    left = budget - epochs * F.col("source_size") - F.col(start) - F.col(inside)
    taken = epochs * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left))
    return placed.withColumn("taken", taken).drop(group, part, key, tie, start, inside)


def mixed_texts(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, in the columns of `docs`, which keep what they hold whatever their names: a row taken in part is cut after
    its last taken word (words then joined by one space), a row taken more than once repeats its text after a line feed, a row of
    which nothing is taken goes.
    """
    clashing = [c for c in docs.columns if c.lower() in ADDED]
    aside = dict(zip(clashing, free_names([*docs.columns, *ADDED], *(f"_own_{c}" for c in clashing)), strict=True))
    mixed = mix_sources(docs.withColumnsRenamed(aside), **options).filter(F.col("taken") > 0)
    words = F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rest = (F.col("taken") % F.col("size")).cast("int")
    whole = F.array_repeat(F.col("text"), F.floor(F.col("taken") / F.col("size")).cast("int"))
    part = F.when(rest > 0, F.array(F.array_join(F.slice(words, F.lit(1), rest), " "))).otherwise(F.array().cast("array<string>"))
    out = mixed.withColumn("text", F.array_join(F.concat(whole, part), "\n"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])
