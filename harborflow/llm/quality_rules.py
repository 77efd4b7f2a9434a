"""Quality rules: text statistics of each document, and lines that many documents of a host share.

Lines are normalised (words, A-Z lower-cased, one space) and hashed. For each host (the `source` column) and line, the
documents of different content that hold it are counted; exact copies of a document count once. A line in at least
`min_docs` of them, however large the host, is removed from all documents but the one with the smallest doc_id. Callers
can ask for at least `min_share` of the host's contents as well; the default asks for none. A document that keeps less than `min_left` of its words is rejected as depleted.

Edge cases: null or empty text has no words, so the base rules reject it; a null source is a host of its own; rows are
told apart by position, so repeated rows and null doc_ids are judged each; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborflow.llm import words as wd
from harborflow.llm.stages import Stages

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
MIN_DOCS = 20
MIN_SHARE = 0.0
MIN_LEFT = 0.4

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True

SCANNED = (
    "doc_id long, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "content long, lines array<struct<line:long,words:int>>"
)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _later_equal(text: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Group numbers of equal (text, value) pairs: for each entry (is not the first, group has more than one)."""
    order = np.lexsort((value, text))
    same = np.zeros(len(order), bool)
    same[1:] = (text[order][1:] == text[order][:-1]) & (value[order][1:] == value[order][:-1])
    many = same.copy()
    many[:-1] |= same[1:]
    later, multiple = np.zeros(len(order), bool), np.zeros(len(order), bool)
    later[order], multiple[order] = same, many
    return np.stack([later, multiple])


def statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Statistics of each text of a chunk, and its lines as (text number, hash, words)."""
    texts = len(offsets) - 1
    start, end, first = wd.spans(data, offsets)
    counts = np.diff(first)
    of_word = np.repeat(np.arange(texts), counts)
    hashes = wd.text_hashes(data, start, end)
    out = {"n_words": counts, "n_symbols": _per_text(SYMBOL[data], offsets)}
    points = (data & 0xC0) != 0x80
    out["word_chars"] = _per_text(points & ~wd.SPACE[data], offsets)

    # Lines: pieces between line feeds or text ends that hold a word.
    feeds = np.flatnonzero(data == 10)
    cuts = np.unique(np.concatenate([offsets[:-1], feeds + 1, offsets[1:]]))
    begin = cuts[:-1]
    stop = cuts[1:] - (data[cuts[1:] - 1] == 10) if len(cuts) > 1 else cuts[1:]
    word_from, word_to = np.searchsorted(start, begin), np.searchsorted(start, stop)
    held = word_to > word_from
    begin, stop, word_from, word_to = begin[held], stop[held], word_from[held], word_to[held]
    of_line = np.searchsorted(offsets, begin, "right") - 1
    raw = wd.text_hashes(data, begin, stop)
    out["n_dup_lines"] = np.bincount(of_line[_later_equal(of_line, raw)[0]], minlength=texts)
    lower = wd.text_hashes(wd.LOWER[data], start, end)
    out["line"] = _sequence(lower, word_from, word_to)
    out["line_words"], out["line_text"] = word_to - word_from, of_line
    out["content"] = _sequence(hashes, first[:-1], first[1:])

    # Words inside windows that occur more than once in their text.
    out["n_repeat_words"] = np.zeros(texts, np.int64)
    inside = np.flatnonzero(wd.runs_inside(first, WINDOW))
    if len(inside):
        runs = wd.run_hashes(hashes, WINDOW)[inside]
        repeated = inside[_later_equal(of_word[inside], runs)[1]]
        edge = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(edge, repeated, 1)
        np.add.at(edge, repeated + WINDOW, -1)
        out["n_repeat_words"] = np.bincount(of_word[np.cumsum(edge[:-1]) > 0], minlength=texts)
    return out


def _sequence(hashes: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of the word sequences [begin, stop)."""
    up, down = wd._Powers.to(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return wd.mix((sums[stop] - sums[begin]) * down[begin] + (stop - begin).astype(np.uint64))


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in wd.chunks(batch.column("text")):
            s = statistics(data, offsets)
            ends = np.searchsorted(s["line_text"], np.arange(hi - lo + 1)).astype(np.int32)
            entries = pa.StructArray.from_arrays(
                [pa.array(s["line"].view(np.int64)), pa.array(s["line_words"].astype(np.int32))], ["line", "words"]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), batch.column("source").slice(lo, hi - lo)]
                + [pa.array(s[c].astype(np.int64)) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
                + [pa.array(s["content"].view(np.int64)), pa.ListArray.from_arrays(pa.array(ends), entries)],
                ["doc_id", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content", "lines"],
            )


def quality_rules(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE, min_left: float = MIN_LEFT
) -> DataFrame:
    """One row a document: statistics, removed_words, base_failed and kept."""
    steps = Stages(docs.sparkSession, "quality-rules")
    scanned = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"))
    scanned = scanned.mapInArrow(scan, SCANNED).withColumn("_row", F.monotonically_increasing_id())
    scanned = scanned.withColumn("_host", F.when(F.col("source").isNull(), F.lit("b")).otherwise(F.concat(F.lit("a"), "source")))
    scanned = steps.put(scanned, "scan")

    # Exact copies are one content: its smallest doc_id stands for it.
    contents = scanned.groupBy("_host", "content").agg(F.min_by("lines", "_row").alias("lines"), F.min("doc_id").alias("doc_id"))
    lines = contents.select("_host", "doc_id", F.explode(F.array_distinct(F.col("lines.line"))).alias("line"))
    counts = lines.groupBy("_host", "line").agg(F.count(F.lit(1)).alias("_docs"), F.min("doc_id").alias("_first"))
    common = counts.filter(F.col("_docs") >= min_docs)
    if min_share > 0:
        hosts = scanned.groupBy("_host").agg(F.count_distinct("content").alias("_contents"))
        common = common.join(hosts, "_host").filter(F.col("_docs") >= F.col("_contents") * F.lit(min_share))
    common = common.select("_host", "line", "_first")

    held = scanned.select("_host", "_row", "doc_id", F.explode("lines").alias("l")).select("_host", "_row", "doc_id", "l.line", "l.words")
    hit = held.join(common, ["_host", "line"]).filter(~F.col("doc_id").eqNullSafe(F.col("_first")))
    removed = hit.groupBy("_row").agg(F.sum("words").cast("long").alias("removed_words"))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words")
    return (
        scanned.drop("lines", "content", "_host").join(removed, "_row", "left").fillna(0, ["removed_words"])
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~base_failed & (left >= F.col("n_words") * F.lit(min_left)))
        .drop("_row")
    )
