"""Lexical retrieval packing: documents with neighbours by BM25, in windows of at most `window` ids.

A document's ids, closed by `end_id`, are cut into whole windows and a tail. Tails are sorted by min-hashes of their
ids, so similar ones come near each other, and dealt into shards of `SHARD` tails. Each shard has an inverted index of id ->
tails with BM25 weights; document frequencies and lengths are those of the whole corpus (a table bounded by the
vocabulary). The first unused tail seeds a window; its best unused neighbours fill it, and the last is cut to fit. The rest of
that one seeds the next window. What a shard leaves open is filled by the next shard of the same task, so that at most one
window a task is padded.

A sequence is a window; it has `window` ids, or fewer in the last window of a task. Edge cases: null text is empty and has
only `end_id`; a null doc_id and repeated rows are packed like others, each row for itself; an empty table gives an empty
result; other columns are ignored. Very long texts are encoded one at a time.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborflow.llm import tokens
from harborflow.llm import words as wd
from harborflow.llm.stages import Stages

VOCABULARY = "byte_bpe_50k.tiktoken"  # the ids of byte_bpe_50k.json
WINDOW = 1024
END_ID = 0
SHARD = 2048
TAILS_PER_TASK = 8192
QUERY_TERMS = 12
K1, B = 1.2, 0.75

ENCODED = "doc_id long, doc_tokens long, near1 long, near2 long, whole array<binary>, tail binary"
PACKED = "doc_id long, start long, length long, payload binary, doc_tokens long, sequence_id long, offset long"


def crc(ids: np.ndarray) -> bytes:
    """Payload: crc32 of the ids as little-endian unsigned 32-bit numbers; its own bytes are big-endian."""
    return zlib.crc32(ids.astype("<u4").tobytes()).to_bytes(4, "big")


def as_bytes(ids: np.ndarray) -> bytes:
    """Payload: the ids themselves."""
    return ids.astype("<u4").tobytes()


def _min_hashes(ids: np.ndarray) -> tuple[int, int]:
    mixed = [wd.mix(ids.astype(np.uint64) + np.uint64(salt)) for salt in (0x1234567, 0x89ABCDEF0)]
    return tuple(int(m.min().view(np.int64)) if len(m) else 0 for m in mixed)


def encode(path: str, window: int, end_id: int, payload: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(path)
        for batch in batches:
            for lo, hi, data, offsets in wd.chunks(batch.column("text"), 1 << 20):
                ids, at = encoder.encode(data, offsets)
                rows = []
                for i in range(hi - lo):
                    own = np.append(ids[at[i]:at[i + 1]], np.uint32(end_id))
                    full = len(own) // window * window
                    tail = own[full:]
                    rows.append((len(own), *_min_hashes(tail), [payload(own[k:k + window]) for k in range(0, full, window)], tail.astype("<u4").tobytes()))
                cols = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo)] + [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                    ["doc_id", "doc_tokens", "near1", "near2", "whole", "tail"],
                )

    return run


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequency of every id over the tails of a task; -1 counts tails, -2 their ids."""
    found = np.zeros(1 << 16, np.int64)
    tails = size = 0
    for batch in batches:
        for lo, hi, data, offsets in wd.chunks(batch.column("tail")):
            ids = data.view("<u4").astype(np.int64)
            own = np.repeat(np.arange(hi - lo), np.diff(offsets) // 4)
            pairs = np.unique(own << 32 | ids) & 0xFFFFFFFF
            if len(pairs) and pairs.max() >= len(found):
                found = np.concatenate([found, np.zeros(int(pairs.max()) + 1 - len(found), np.int64)])
            found += np.bincount(pairs, minlength=len(found))
            tails, size = tails + int(np.count_nonzero(np.diff(offsets))), size + len(ids)
    terms = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([terms, [-1, -2]])), pa.array(np.concatenate([found[terms], [tails, size]]))], ["term", "n"]
    )


class Shard:
    """Inverted index over some tails, with the tails that are still unused."""

    def __init__(self, tails: list[np.ndarray], weight_of: np.ndarray, mean: float):
        self.tails = tails
        self.left = np.array([len(t) for t in tails])
        own = np.repeat(np.arange(len(tails)), self.left)
        flat = np.concatenate(tails).astype(np.int64) if tails else np.zeros(0, np.int64)
        pairs, tf = np.unique(flat << 32 | own, return_counts=True)
        self.term, doc = pairs >> 32, pairs & 0xFFFFFFFF
        norm = K1 * (1 - B + B * self.left[doc] / mean)
        self.docs, self.weight = doc, weight_of[self.term] * tf * (K1 + 1) / (tf + norm)
        by_doc = np.argsort(doc, kind="stable")
        self.by_doc, self.doc_at = by_doc, np.searchsorted(doc[by_doc], np.arange(len(tails) + 1))
        self.terms, self.term_at = np.unique(self.term, return_index=True)
        self.term_at = np.append(self.term_at, len(self.term))
        self.unused = self.left > 0
        self.next = 0

    def neighbours(self, seed: int) -> Iterator[int]:
        """Unused tails, best BM25 score for the seed's heaviest terms first; then the others in order."""
        entries = self.by_doc[self.doc_at[seed]:self.doc_at[seed + 1]]
        heavy = entries[np.argsort(-self.weight[entries], kind="stable")[:QUERY_TERMS]]
        scores = np.zeros(len(self.tails))
        for k in np.searchsorted(self.terms, self.term[heavy]):
            a, b = self.term_at[k], self.term_at[k + 1]
            scores[self.docs[a:b]] += self.weight[a:b]
        scores[~self.unused] = 0
        found = np.flatnonzero(scores)
        if len(found) > 64:  # the best first; the rest only if these do not fill the window
            best = found[np.argpartition(-scores[found], 64)[:64]]
            yield from best[np.argsort(-scores[best], kind="stable")].tolist()
        yield from found[np.argsort(-scores[found], kind="stable")].tolist()
        while (i := self.first_unused()) is not None:
            yield i

    def use(self, i: int, ids: int) -> None:
        self.left[i] -= ids
        self.unused[i] = self.left[i] > 0

    def first_unused(self) -> int | None:
        while self.next < len(self.tails) and not self.unused[self.next]:
            self.next += 1
        return self.next if self.next < len(self.tails) else None


def pack(window: int, weight_of: np.ndarray, mean: float, payload: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = itertools.count(TaskContext.get().partitionId() << 40)
        sequence, room = -1, 0  # the open window, which may go on in the next shard
        for rows in _shards(batches):
            out = [(row[0], k * window, window, own, row[1], next(numbers), 0) for row in rows for k, own in enumerate(row[2])]
            shard = Shard([np.frombuffer(row[3], "<u4") for row in rows], weight_of, mean)
            rest = None  # a tail that was cut seeds the next window
            while (seed := shard.first_unused() if rest is None else rest) is not None:
                if room == 0:
                    sequence, room = next(numbers), window
                rest = None
                for i in itertools.chain([seed], shard.neighbours(seed)):
                    if not shard.unused[i]:
                        continue
                    ids, (doc_id, total) = shard.tails[i], rows[i][:2]
                    done, take = len(ids) - int(shard.left[i]), int(min(room, shard.left[i]))
                    out.append((doc_id, total - len(ids) + done, take, payload(ids[done:done + take]), total, sequence, window - room))
                    room -= take
                    shard.use(i, take)
                    if room == 0:
                        rest = i if shard.unused[i] else None
                        break
            yield _batch(out)

    return run


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "whole", "tail")), strict=True):
            rows.append(row)
            if len(rows) == SHARD:
                yield rows
                rows = []
    if rows:
        yield rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    names = ["doc_id", "start", "length", "payload", "doc_tokens", "sequence_id", "offset"]
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)


def pack_documents(
    docs: DataFrame, path: str | None = None, window: int = WINDOW, end_id: int = END_ID, payload: Callable = as_bytes,
    tails_per_task: int = TAILS_PER_TASK,
) -> DataFrame:
    """One row a piece: doc_id, start, length, payload, doc_tokens, sequence_id, offset. `path`: a vocabulary of ranks."""
    steps = Stages(docs.sparkSession, "packing")
    path = path or public_tokenizers.path(VOCABULARY)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    encoded = steps.put(narrow.mapInArrow(encode(path, window, end_id, payload), ENCODED), "encoded")
    # Bounded by the vocabulary.
    counts = dict(encoded.select("tail").mapInArrow(_term_counts, "term long, n long").groupBy("term").agg(F.sum("n")).collect())
    tails, size = counts.pop(-1, 0), counts.pop(-2, 0)
    weight_of = np.zeros(max(counts, default=0) + 1)
    for term, n in counts.items():
        weight_of[term] = np.log1p((tails - n + 0.5) / (n + 0.5))
    tasks = max(1, -(-encoded.count() // tails_per_task))
    near = encoded.repartitionByRange(tasks, "near1", "near2", "doc_id", "doc_tokens").sortWithinPartitions(
        "near1", "near2", "doc_id", "doc_tokens", "tail"
    )
    return near.select("doc_id", "doc_tokens", "whole", "tail").mapInArrow(
        pack(window, weight_of, max(1.0, size / max(1, tails)), payload), PACKED
    )
