"""Quality classifier as a sparse rule ensemble.

Statistics of each text are the only inputs. Shallow trees are grown on a bounded sample of labelled rows; every path from a
root is a conjunctive rule over statistics. A logistic regression with a lasso penalty gives most rules weight 0. The
rules that are left are compiled into one Spark column expression, which scores all rows without Python.

Training reads at most about `train_rows` labelled rows, drawn by hash. The same rows give the same model.

Edge cases: null text is empty and scored like any text; without labels, or with labels of one kind, the score is their share
(0.5 without any); of several labels of a doc_id the highest counts; null doc_ids have no label and are not held out;
repeated rows are scored each; an empty table gives an empty result; other columns are kept by `score_quality`, except those
named like a statistic, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborflow.llm import words as wd
from harborflow.llm.language_id import bucket_of
from harborflow.llm.stages import SMALL_BATCHES, Stages

TRAIN_ROWS = 20_000
SCAN_BYTES = 1 << 18  # a task holds about a hundred bytes for each byte of the texts it scans at once
TREES, DEPTH, LASSO, SEED = 30, 3, 0.002, 17
THRESHOLD = 0.3
STATISTICS = (
    "s_words", "s_mean_length", "s_max_length", "s_upper", "s_digits", "s_symbols", "s_marks", "s_shouts", "s_distinct", "s_adjacent",
    "s_trigrams", "s_lines", "s_dup_lines", "s_line_words", "s_short_lines", "s_lone_marks", "s_lower_words",
)


def _class(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


UPPER, DIGIT = _class(bytes(range(65, 91))), _class(b"0123456789")
LETTER = _class(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
SMALL = _class(bytes(range(97, 123)))
SYMBOL, MARK, SHOUT = _class(b"#*$%&|<>{}\\~^@=+_/"), _class(b".,;:'\"()-"), _class(b"!?")


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row a text, one column a statistic; shares are 0 where there is nothing to share."""
    texts = len(offsets) - 1
    start, end, first = wd.spans(data, offsets)
    counts = np.diff(first).astype(float)
    own = np.repeat(np.arange(texts), np.diff(first))

    def sums(flags):
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total

    def in_text(flags):
        total = sums(flags)
        return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)

    def per_word(flags):
        total = sums(flags)
        return total[end] - total[start]

    def share(x, n):
        return np.divide(x, n, out=np.zeros(texts), where=n > 0)

    def of_words(flags):
        return np.bincount(own, weights=flags, minlength=texts)

    def distinct(text, values):
        order = np.lexsort((values, text))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (text[order][1:] != text[order][:-1]) | (values[order][1:] != values[order][:-1])
        return np.bincount(text[order][fresh], minlength=texts)

    points = per_word((data & 0xC0) != 0x80)
    letters = in_text(LETTER[data])
    used = in_text(~wd.SPACE[data])
    hashes = wd.span_hashes(wd.prefix_hashes(data), start, end)
    longest = np.zeros(texts)
    np.maximum.at(longest, own, points)
    adjacent = np.zeros(len(hashes))
    adjacent[1:] = (hashes[1:] == hashes[:-1]) & (own[1:] == own[:-1])
    inside = np.flatnonzero(wd.runs_inside(first, 3))
    trigrams = distinct(own[inside], wd.run_hashes(hashes, 3)[inside]) if len(inside) else np.zeros(texts)

    cuts = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(data == 10) + 1, offsets[1:]]))
    word_at = np.searchsorted(start, cuts)
    held = np.diff(word_at) > 0
    line_from, line_to = cuts[:-1][held], end[word_at[1:][held] - 1] if held.any() else cuts[:0]
    line_text = np.searchsorted(offsets, line_from, "right") - 1
    line_words = np.diff(word_at)[held]
    lines = np.bincount(line_text, minlength=texts).astype(float)
    raw = wd.span_hashes(wd.prefix_hashes(data), start[word_at[:-1][held]], line_to)
    lone = per_word(LETTER[data] | DIGIT[data]) == 0
    return np.stack([
        counts, share(of_words(points), counts), longest, share(in_text(UPPER[data]), letters), share(in_text(DIGIT[data]), used),
        share(in_text(SYMBOL[data]), used), share(in_text(MARK[data]), used), share(in_text(SHOUT[data]), used), share(distinct(own, hashes), counts),
        share(of_words(adjacent), counts), share(trigrams, np.maximum(counts - 2, 0)), lines, share(lines - distinct(line_text, raw), lines),
        share(counts, lines), share(np.bincount(line_text, weights=line_words < 4, minlength=texts), lines), share(of_words(lone), counts),
        share(of_words(per_word(SMALL[data]) > 0), counts),
    ], axis=1)


def scan(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in wd.chunks(batch.column("text"), SCAN_BYTES):
                found = statistics(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(lo, hi - lo) for c in names] + [pa.array(found[:, i]) for i in range(len(STATISTICS))],
                    [*names, *STATISTICS],
                )

    return run


def with_statistics(docs: DataFrame, columns: list[str]) -> DataFrame:
    """`columns` of docs, text among them, and the statistics."""
    kept = docs.select(columns)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema] + [f"{s} double" for s in STATISTICS])
    return kept.mapInArrow(scan(columns), schema)


# --- rules ---------------------------------------------------------------------------------


Condition = tuple[str, bool, float]  # statistic, at most (or more than), bound


def paths(model) -> list[tuple[Condition, ...]]:
    """The conjunction on the way to every node below a root, each once."""
    found: dict[tuple[Condition, ...], None] = {}

    def walk(node, way):
        if way:
            tightest: dict[tuple[str, bool], float] = {}
            for name, at_most, bound in way:
                old = tightest.get((name, at_most), bound)
                tightest[name, at_most] = min(old, bound) if at_most else max(old, bound)
            found.setdefault(tuple(sorted((n, m, b) for (n, m), b in tightest.items())))
        if node.subtreeDepth() > 0:
            split = node.split()
            name, bound = STATISTICS[split.featureIndex()], float(split.threshold())
            walk(node.leftChild(), [*way, (name, True, bound)])
            walk(node.rightChild(), [*way, (name, False, bound)])

    for tree in model.trees:
        walk(tree._call_java("rootNode"), [])
    return list(found)


def holds(rule: tuple[Condition, ...]) -> Column:
    return reduce(Column.__and__, [F.col(n) <= F.lit(b) if at_most else F.col(n) > F.lit(b) for n, at_most, b in rule])


class Rules:
    """Weighted rules; `column()` is the score."""

    def __init__(self, intercept: float, rules: list[tuple[tuple[Condition, ...], float]]):
        self.intercept, self.rules = intercept, rules

    def column(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def fit_rules(labelled: DataFrame) -> Rules:
    """From statistics and `label` (0 or 1) of a bounded sample."""
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    ones, zeros = counts.get(1.0, 0), counts.get(0.0, 0)
    if not ones or not zeros:
        share = (ones + 0.5) / (ones + zeros + 1)
        return Rules(float(np.log(share / (1 - share))), [])
    rows = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(labelled).select("label", "features", *STATISTICS)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, minInstancesPerNode=5, featureSubsetStrategy="onethird").fit(rows)
    rules = paths(forest)
    if not rules:
        share = ones / (ones + zeros)
        return Rules(float(np.log(share / (1 - share))), [])
    flags = rows.select("label", array_to_vector(F.array(*[holds(r).cast("double") for r in rules])).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, standardization=False, maxIter=60).fit(flags)
    weights = lasso.coefficients.toArray()
    return Rules(float(lasso.intercept), [(r, float(w)) for r, w in zip(rules, weights, strict=True) if w != 0])


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Rules:
    """Rules from the texts of labelled documents; labels: doc_id, quality."""
    steps = Stages(docs.sparkSession, "quality-classifier", SMALL_BATCHES)
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("double").alias("label"))
    order = F.xxhash64(F.lit("quality"), "doc_id")
    # At most train_rows rows of two numbers: broadcast, so that no text is shuffled.
    sample = F.broadcast(known.orderBy(order, "doc_id").limit(train_rows))
    chosen = with_statistics(docs.select("doc_id", "text").join(sample, "doc_id").select("text", "label"), ["text", "label"]).drop("text")
    chosen = steps.put(chosen.coalesce(8), "sample")
    return fit_rules(chosen.orderBy(*STATISTICS, "label").coalesce(4))


def score_quality(docs: DataFrame, rules: Rules) -> DataFrame:
    """All columns of docs with the statistics and `score`."""
    columns = [c for c in docs.columns if c not in STATISTICS and c != "score"]
    return with_statistics(docs, columns).withColumn("score", rules.column())


def quality_classifier(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted. Learns from labels of rows that are not held out."""
    fold = F.coalesce((bucket_of(F.col("doc_id"), folds) == held_out) & F.col("doc_id").isNotNull(), F.lit(False))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rules = train(docs, labels.filter(~fold), train_rows)
    scored = score_quality(docs.withColumn("held_out", fold), rules)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
