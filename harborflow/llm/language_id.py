"""Language identification by prediction by partial matching (PPM).

For each language a context tree over bytes, up to `ORDER` preceding bytes, holds how often each byte followed each context.
Its statistics are frozen after training. The code length of a byte is that of the longest context in which it was seen, plus
the escapes from longer contexts that exist (method C: a context of n bytes seen and d different ones escapes with d / (n + d)).
The language with the shortest code for the whole text is predicted. Since the statistics are frozen, the code lengths of
all known contexts and bytes are tables, which are joined to the positions of a text by binary search.

Training reads a bounded sample: about `train_docs` texts of each language, drawn by hash; the model keeps at most
`MAX_CONTEXTS` contexts. Case is folded for ASCII and Latin-1 letters, digits are one symbol.

Edge cases: null text and text without letters are `und` with score 0; without training rows every text is; a null lang is
not learned; rows are predicted each for itself, so repeated rows and null doc_ids are kept (a null doc_id is not held out); an
empty table gives an empty result; other columns are ignored. Very long texts are scored one at a time, in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborflow.llm import words as wd
from harborflow.llm.stages import Stages

ORDER = 4
TRAIN_DOCS = 2000
MIN_COUNT = 2
MAX_CONTEXTS = 1_000_000
MAX_LANGS = 10_000  # more than there are language codes; bounds the table that is broadcast
EVIDENCE = 64  # bytes of evidence that the score counts at most
UNKNOWN = "und"
_U = np.uint64

FOLD = wd.LOWER.copy()
FOLD[48:58] = 48
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True


def bucket_of(doc_id: Column, n: int) -> Column:
    """crc32 of the doc_id as text, modulo n; a null doc_id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each byte with the ORDER bytes before it in its text, as one number; missing ones are 0."""
    folded = FOLD[data]
    latin = np.zeros(len(data), bool)
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    folded[latin] += 32
    code = np.zeros(len(data), np.uint64)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    for back in range(ORDER + 1):
        before = np.zeros(len(data), np.uint64)
        before[back:] = folded[:len(folded) - back] if back else folded
        if back:
            before[place < back] = 0
        code |= before << _U(8 * back)
    return code


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of a task's training texts, one language after the other."""
    for batch in batches:
        langs = batch.column("lang")
        for lang in langs.unique().to_pylist():
            texts = batch.column("text").filter(pa.compute.equal(langs, lang))
            for _, _, data, offsets in wd.chunks(texts):
                found, n = np.unique(grams(data, offsets), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(n)], ["lang", "gram", "n"]
                )


class Trees:
    """Frozen context trees of several languages as sorted tables: for each order the grams with the code length of
    their last byte in every language, and the contexts with their escapes."""

    def __init__(self, langs: list[str], counts: list[tuple[np.ndarray, np.ndarray]]):
        self.langs, size = langs, len(langs)
        self.grams, self.costs, self.contexts, self.escapes = [], [], [], []
        below_grams, below_costs = np.zeros(0, np.uint64), np.zeros((0, size), np.float32)
        self.uniform = np.float32(8.0)
        for order in range(ORDER + 1):
            mask = _U((1 << (8 * (order + 1))) - 1)
            per_lang = []
            for found, n in counts:
                grams_, where = np.unique(found & mask, return_inverse=True)
                total = np.bincount(where, weights=n)
                if order >= 3:
                    keep = total >= MIN_COUNT
                    grams_, total = grams_[keep], total[keep]
                per_lang.append((grams_, total))
            everything = np.unique(np.concatenate([g for g, _ in per_lang])) if per_lang else np.zeros(0, np.uint64)
            contexts = np.unique(everything >> _U(8))
            escapes = np.zeros((len(contexts), size), np.float32)
            seen = np.full((len(everything), size), np.nan, np.float32)
            for k, (grams_, total) in enumerate(per_lang):
                at = np.searchsorted(contexts, grams_ >> _U(8))
                n = np.bincount(at, weights=total, minlength=len(contexts))
                d = np.bincount(at, minlength=len(contexts))
                here = n > 0
                escapes[here, k] = -np.log2(d[here] / (n[here] + d[here]))
                seen[np.searchsorted(everything, grams_), k] = -np.log2(total / (n[at] + d[at]))
            if order == 0:
                rest = np.full((len(everything), size), self.uniform, np.float32)
            else:
                low = np.searchsorted(below_grams, everything & (mask >> _U(8)))
                low = np.minimum(low, max(len(below_grams) - 1, 0))
                rest = below_costs[low] if len(below_grams) else np.full((len(everything), size), self.uniform, np.float32)
            rest = rest + escapes[np.searchsorted(contexts, everything >> _U(8))]
            costs = np.where(np.isnan(seen), rest, seen).astype(np.float32)
            self.grams.append(everything)
            self.costs.append(costs)
            self.contexts.append(contexts)
            self.escapes.append(escapes)
            below_grams, below_costs = everything, costs

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits that each text takes in each language."""
        code, own = grams(data, offsets), np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        out = np.zeros((len(offsets) - 1, len(self.langs)))

        def add(own, costs):
            for k in range(len(self.langs)):
                out[:, k] += np.bincount(own, weights=costs[:, k], minlength=len(out))

        for order in range(ORDER, -1, -1):
            if not len(code):
                return out
            code = code & _U((1 << (8 * (order + 1))) - 1)
            table = self.grams[order]
            at = np.minimum(np.searchsorted(table, code), max(len(table) - 1, 0))
            hit = table[at] == code if len(table) else np.zeros(len(code), bool)
            add(own[hit], self.costs[order][at[hit]])
            code, own = code[~hit], own[~hit]
            contexts = self.contexts[order]
            if len(contexts) and len(code):
                at = np.minimum(np.searchsorted(contexts, code >> _U(8)), len(contexts) - 1)
                known = contexts[at] == code >> _U(8)
                add(own[known], self.escapes[order][at[known]])
        add(own, np.full((len(own), len(self.langs)), self.uniform))
        return out


def has_letters(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.int64)
    np.cumsum(LETTER[data], out=sums[1:])
    out = sums[offsets[1:]] > sums[offsets[:-1]]
    for i in np.flatnonzero(~out & (np.diff(offsets) > 0)):
        out[i] = any(c.isalpha() for c in data[offsets[i]:offsets[i + 1]].tobytes().decode())
    return out


def predict(trees: Trees):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(trees.langs + [UNKNOWN], object)
        for batch in batches:
            for lo, hi, data, offsets in wd.chunks(batch.column("text"), 1 << 20):
                letters = has_letters(data, offsets)
                best, score = np.full(hi - lo, len(trees.langs)), np.zeros(hi - lo)
                if trees.langs:
                    bits = trees.code_lengths(data, offsets)
                    least = bits.argmin(axis=1)
                    weigh = np.minimum(1.0, EVIDENCE / np.maximum(1, np.diff(offsets)))
                    odds = np.exp2(-(bits - bits.min(axis=1, keepdims=True)) * weigh[:, None]).sum(axis=1)
                    best, score = np.where(letters, least, best), np.where(letters, 1 / odds, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo), batch.column("held_out").slice(lo, hi - lo),
                        pa.array(names[best], pa.string()), pa.array(score),
                    ],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    return run


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Trees:
    """Trees of every language in `docs` (text, lang), from a sample by hash of about `train_docs` texts of each."""
    steps = Stages(docs.sparkSession, "language-id")
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("text").cast("string"), F.col("lang").cast("string"), "doc_id")
    share = usable.groupBy("lang").agg(F.least(F.lit(1.0), train_docs / F.count(F.lit(1))).alias("share"))
    share = F.broadcast(share.orderBy("share", "lang").limit(MAX_LANGS))
    draw = F.pmod(F.xxhash64(F.lit("language-id"), "doc_id"), F.lit(1 << 20)) < F.col("share") * (1 << 20)
    sample = usable.join(share, "lang").filter(draw).select("text", "lang")
    counts = sample.mapInArrow(count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = steps.put(counts, "grams")
    kept = counts.orderBy(F.desc("n"), "lang", "gram").limit(MAX_CONTEXTS).toArrow()  # bounded
    langs = sorted(set(kept.column("lang").to_pylist()))
    gram, n = kept.column("gram").to_numpy().view(np.uint64), kept.column("n").to_numpy()
    of = np.array(kept.column("lang").to_pylist(), object)
    return Trees(langs, [(gram[of == lang], n[of == lang]) for lang in langs])


def language_id(docs: DataFrame, folds: int = 4, held_out: int = 2, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """One row a document: doc_id, held_out, lang_pred, score. Learns from rows that are not held out."""
    fold = F.coalesce(bucket_of(F.col("doc_id"), folds) == held_out, F.lit(False))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").alias("lang"))
    docs = docs.withColumn("held_out", fold)
    trees = train(docs.filter(~F.col("held_out")), train_docs)
    return docs.select("doc_id", "held_out", "text").mapInArrow(
        predict(trees), "doc_id long, held_out boolean, lang_pred string, score double"
    )
