"""Substring deduplication with prefix-partitioned suffix trees over words.

A suffix starts at a word; it matters down to `depth` words, the least length of a repeat. Every window of `depth` words is
assigned to its anchor, the least-hashed run of `ANCHOR` words in it. Successive windows with one anchor travel as
one stretch of word hashes, so that a window costs a few words instead of `depth`.

1. Anchors of all documents, without content, are dealt to buckets by their upper bits; only those that occur in several
   documents go on. A task that meets an anchor in two of its own documents knows it already, and sends it once.
2. The stretches of these anchors, with content, are grouped by anchor. Copies of a whole text are left out: they lose every
   window. Hot anchors (more than `hot` stretches) are split by longer prefixes, the first words of each suffix down to the
   full depth, after equal stretches have become one, so that no group outgrows a task.
3. A task takes groups up to `SUFFIXES` suffixes, splits them by prefix and builds each subtree as a sorted suffix list
   with the lengths of common prefixes. Internal nodes at `depth` or deeper are repeats; the smallest doc_id below such a node is
   the one that keeps the words.
4. For each document, the words under windows that a smaller doc_id also has are removed from its text.

Word equality is that of 64-bit word hashes, compared word by word.

Edge cases: null or empty text has no words; a null doc_id is neither a source nor loses words; rows with the same doc_id take
nothing from each other and are told apart by a 31-bit hash of their texts; an empty table gives an empty result; other
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

DEPTH = 13
ANCHOR = 5
HOT = 20_000
SUFFIXES = 150_000
ANCHORS_PER_BUCKET = 400_000
ANCHORS_PER_TASK = 1_000_000
_U = np.uint64


# --- anchors -------------------------------------------------------------------------


def anchored(hashes: np.ndarray, first: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that lie inside one text, and the position of the anchor of each."""
    windows = len(hashes) - depth + 1
    if windows <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    runs = wd.run_hashes(hashes, ANCHOR)
    best = runs[:windows].copy()
    at = np.zeros(windows, np.int64)
    for j in range(1, depth - ANCHOR + 1):
        other = runs[j:j + windows]
        less = other < best
        best[less] = other[less]
        at[less] = j
    inside = np.flatnonzero(wd.runs_inside(first, depth))
    return inside, inside + at[inside]


def _hashed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end, first = wd.spans(data, offsets)
    return wd.text_hashes(data, start, end), first


def send_anchors(depth: int, buckets: int):
    """(bucket, meet, hashes, docs, positions): entries that must meet others, or that are known to be shared."""

    def flush(hashes, docs, positions):
        hashes, docs, positions = np.concatenate(hashes), np.concatenate(docs), np.concatenate(positions)
        order = np.lexsort((docs, hashes))
        hashes, docs, positions = hashes[order], docs[order], positions[order]
        head = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]) != 0)
        sizes = np.diff(np.append(head, len(hashes)))
        shared = np.repeat(docs[head] != docs[head + sizes - 1], sizes)
        for meet, chosen in ((True, ~shared), (False, shared)):
            h, d, pos = hashes[chosen], docs[chosen], positions[chosen]
            if not meet:  # one entry stands for all here, so that others elsewhere learn of it
                mark = hashes[head][shared[head]]
                h2 = np.concatenate([mark, mark])
                d2 = np.concatenate([docs[head][shared[head]], docs[head + sizes - 1][shared[head]]])
                yield from _blobs(h2, True, h2, d2, np.full(len(h2), -1, np.int64), buckets)
            yield from _blobs(h if meet else wd.mix(d.view(np.uint64)), meet, h, d, pos, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, docs, positions, held = [], [], [], 0
        for batch in batches:
            ids, tags = batch.column("doc_id").to_numpy(), batch.column("tag").to_numpy()
            for lo, hi, data, offsets in wd.chunks(batch.column("text")):
                words, first = _hashed(data, offsets)
                _, anchor = anchored(words, first, depth)
                anchor = np.unique(anchor)
                if not len(anchor):
                    continue
                own = np.searchsorted(first, anchor, "right") - 1
                hashes.append(wd.run_hashes(words, ANCHOR)[anchor])
                docs.append(ids[lo:hi][own])
                positions.append((tags[lo:hi][own].astype(np.int64) << 32) | (anchor - first[own]))
                held += len(anchor)
                if held >= ANCHORS_PER_TASK:
                    yield from flush(hashes, docs, positions)
                    hashes, docs, positions, held = [], [], [], 0
        if held:
            yield from flush(hashes, docs, positions)

    return run


def _blobs(place, meet, hashes, docs, positions, buckets):
    if not len(hashes):
        return
    bucket = ((place >> _U(32)) * _U(buckets)) >> _U(32)
    by = np.argsort(bucket, kind="stable")
    marks = np.flatnonzero(np.diff(bucket[by].astype(np.int64), prepend=-1))
    stops = np.append(marks[1:], len(by))
    cut = lambda x: pa.array([x[by[a:b]].tobytes() for a, b in zip(marks, stops, strict=True)], pa.binary())
    yield pa.RecordBatch.from_arrays(
        [pa.array(bucket[by][marks].astype(np.int64)), pa.array(np.full(len(marks), meet)), cut(hashes), cut(docs), cut(positions)],
        ["bucket", "meet", "hashes", "docs", "positions"],
    )


def shared_anchors(table: pa.Table) -> pa.Table:
    """Of one bucket: (doc_id, tag, position) of anchors that several documents have."""
    out = []
    for flag in (True, False):
        rows = table.filter(table.column("meet") if flag else pa.compute.invert(table.column("meet")))
        raw = [b"".join(rows.column(c).to_pylist()) for c in ("hashes", "docs", "positions")]
        hashes, docs, positions = (np.frombuffer(x, kind) for x, kind in zip(raw, (np.uint64, np.int64, np.int64), strict=True))
        if flag and len(hashes):
            order = np.lexsort((docs, hashes))
            hashes, docs, positions = hashes[order], docs[order], positions[order]
            head = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]) != 0)
            sizes = np.diff(np.append(head, len(hashes)))
            keep = np.repeat(docs[head] != docs[head + sizes - 1], sizes) & (positions >= 0)
            docs, positions = docs[keep], positions[keep]
        out.append((docs, positions))
    docs, places = (np.concatenate(x) for x in zip(*out, strict=True))
    return pa.table({"doc_id": docs, "tag": (places >> 32).astype(np.int32), "position": (places & 0xFFFFFFFF).astype(np.int32)})


# --- stretches -----------------------------------------------------------------------------


def stretches(depth: int):
    """(anchor, content, doc_id, tag, start, words): stretches of successive windows with one shared anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags, lists = batch.column("doc_id").to_numpy(), batch.column("tag").to_numpy(), batch.column("positions")
            values, at = lists.flatten().to_numpy(), lists.offsets.to_numpy().astype(np.int64)
            at = at - at[0]
            for lo, hi, data, offsets in wd.chunks(batch.column("text")):
                words, first = _hashed(data, offsets)
                window, anchor = anchored(words, first, depth)
                wanted = np.zeros(len(words) + 1, bool)
                wanted[np.repeat(first[:-1], np.diff(at[lo:hi + 1])) + values[at[lo]:at[hi]]] = True
                window, anchor = window[wanted[anchor]], anchor[wanted[anchor]]
                if not len(window):
                    continue
                begins = np.flatnonzero((np.diff(window, prepend=-9) != 1) | (np.diff(anchor, prepend=-9) != 0))
                start = window[begins]
                length = np.diff(np.append(begins, len(window))) + depth - 1
                own = np.searchsorted(first, start, "right") - 1
                up, down = wd._Powers.to(len(words) + 1)
                sums = np.zeros(len(words) + 1, np.uint64)
                np.cumsum(words * up[: len(words)], out=sums[1:])
                content = wd.mix((sums[start + length] - sums[start]) * down[start] + length.astype(np.uint64))
                raw = words.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(wd.run_hashes(words, ANCHOR)[anchor[begins]].view(np.int64)), pa.array(content.view(np.int64)),
                        pa.array(ids[lo:hi][own]), pa.array(tags[lo:hi][own]), pa.array((start - first[own]).astype(np.int32)),
                        pa.array([raw[8 * a:8 * (a + n)] for a, n in zip(start.tolist(), length.tolist(), strict=True)], pa.binary()),
                    ],
                    ["anchor", "content", "doc_id", "tag", "start", "words"],
                )

    return run


# --- subtrees ---------------------------------------------------------------------------------


def subtree(suffixes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort suffixes of one prefix group; common prefix lengths of neighbours bound the tree's nodes.

    Returns the order, the number of the deep node (all `depth` words) of each sorted suffix and the smallest doc_id of it."""
    order = np.lexsort(suffixes.T[::-1])
    ordered = suffixes[order]
    common = np.zeros(len(order), np.int64)
    if len(order) > 1:
        equal = ordered[1:] == ordered[:-1]
        common[1:] = np.where(equal.all(axis=1), suffixes.shape[1], equal.argmin(axis=1))
    node = np.cumsum(common < suffixes.shape[1]) - 1
    heads = np.flatnonzero(common < suffixes.shape[1])
    return order, node, np.minimum.reduceat(docs[order], heads) if len(order) else docs


def keepers(words: np.ndarray, lengths: np.ndarray, docs: np.ndarray, depth: int) -> np.ndarray:
    """For every window of some stretches, one after the other, the smallest doc_id that has it."""
    begin = np.cumsum(lengths) - lengths
    windows = lengths - depth + 1
    at = np.repeat(begin - (np.cumsum(windows) - windows), windows) + np.arange(int(windows.sum()))
    owners, out = np.repeat(docs, windows), np.empty(len(at), np.int64)
    # Prefix groups: by the first word, as many as fit; suffixes of different groups share no node.
    by = np.argsort(words[at], kind="stable")
    edges = np.append(np.flatnonzero(np.diff(words[at][by], prepend=~words[at][by][:1]) != 0), len(by))
    low = 0
    while low < len(edges) - 1:
        high = max(low + 1, int(np.searchsorted(edges, edges[low] + SUFFIXES // 2, "right")) - 1)
        group = by[edges[low]:edges[high]]
        order, node, least = subtree(words[at[group][:, None] + np.arange(depth)], owners[group])
        out[group[order]] = least[node]
        low = high
    return out


def subtrees(depth: int):
    """From stretches sorted by anchor: (doc_id, tag, windows), the word positions of windows that a smaller doc_id has."""

    def solve(rows):
        number, distinct, least, which = {}, [], [], []
        for anchor, content, words, doc, _, _ in rows:  # equal stretches are one
            i = number.setdefault((anchor, content, words), len(distinct))
            if i == len(distinct):
                distinct.append(words)
                least.append(doc)
            elif doc < least[i]:
                least[i] = doc
            which.append(i)
        lengths = np.array([len(w) // 8 for w in distinct])
        kept = keepers(np.frombuffer(b"".join(distinct), np.uint64), lengths, np.array(least, np.int64), depth)
        windows = lengths - depth + 1
        ends = np.cumsum(windows)
        which = np.array(which)
        docs, starts = np.array([r[3] for r in rows], np.int64), np.array([r[5] for r in rows], np.int64)
        return _lost(docs, [r[4] for r in rows], starts, kept, (ends - windows)[which], windows[which])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, last = [], 0, None
        for batch in batches:  # sorted by anchor: a group is never cut
            columns = (batch.column(c).to_pylist() for c in ("anchor", "content", "words", "doc_id", "tag", "start"))
            for row in zip(*columns, strict=True):
                if held >= SUFFIXES and row[0] != last:
                    yield solve(rows)
                    rows, held = [], 0
                rows.append(row)
                held += len(row[2]) // 8 - depth + 1
                last = row[0]
        if rows:
            yield solve(rows)

    return run


def _lost(docs, tags, starts, kept, begin, windows) -> pa.RecordBatch:
    """Rows with windows kept[begin : begin + windows]: which of them a smaller doc_id keeps."""
    own = np.repeat(np.arange(len(docs)), windows)
    inside = np.arange(len(own)) - np.repeat(np.cumsum(windows) - windows, windows)
    lost = kept[begin[own] + inside] < docs[own]
    ends = np.searchsorted(own[lost], np.arange(len(docs) + 1)).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array((starts[own] + inside)[lost].astype(np.int32)))
    return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(tags, pa.int32()), lists], ["doc_id", "tag", "windows"])


def lost_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same for hot anchors, from rows with the keepers of their windows."""
    for batch in batches:
        blobs = batch.column("keepers").to_pylist()
        sizes = np.array([len(b) // 8 for b in blobs], np.int64)
        docs, starts = batch.column("doc_id").to_numpy(), batch.column("start").to_numpy().astype(np.int64)
        yield _lost(docs, batch.column("tag").to_pylist(), starts, np.frombuffer(b"".join(blobs), np.int64), np.cumsum(sizes) - sizes, sizes)


# --- texts -------------------------------------------------------------------------------------


def cleaned(depth: int):
    """Texts without the words under lost windows; `windows` is a list of lists of word positions, or null; `whole`: all are lost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, removed, kept, spans = [], [], [], []
            columns = (batch.column(c) for c in ("text", "windows", "whole"))
            for text, lists, whole in zip(*columns, strict=True):
                own = (text.as_py() or "").encode().split()
                gone = np.zeros(len(own) + depth + 1, np.int64)
                if whole.as_py() and len(own) >= depth:
                    gone[0] = 1
                elif lists.is_valid and len(lists.values):
                    at = np.unique(lists.values.flatten().to_numpy())
                    gone[at] += 1
                    gone[at + depth] -= 1
                covered = np.cumsum(gone)[: len(own)] > 0
                n_words.append(len(own))
                removed.append(int(covered.sum()))
                kept.append(b" ".join([w for w, c in zip(own, covered.tolist(), strict=True) if not c]) if removed[-1] else b" ".join(own))
                edge = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
                spans.append([{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, kind)],
                ["doc_id", "n_words", "n_removed", "kept", "removed"],
            )

    return run


CLEANED = "doc_id long, n_words long, n_removed long, kept binary, removed array<struct<start:int,end:int>>"
LOST = "doc_id long, tag int, windows array<int>"


def substring_dedup(docs: DataFrame, depth: int = DEPTH, hot: int = HOT) -> DataFrame:
    """One row a document: doc_id, n_words, n_removed, kept (the words left, joined by one space) and the word spans removed."""
    steps = Stages(docs.sparkSession, "substring-dedup")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("tag", F.xxhash64("text").bitwiseAND(F.lit((1 << 31) - 1)).cast("int"))
    named = docs.filter(F.col("doc_id").isNotNull())
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // (25 * ANCHORS_PER_BUCKET)))  # an anchor is met every 25 bytes or so

    # Copies of a whole text lose all that they have; 128 bits and the length tell texts apart.
    digest = named.select("doc_id", "tag", F.xxhash64("text").alias("d1"), F.xxhash64(F.lit(1), F.reverse("text")).alias("d2"), F.octet_length("text").alias("n"))
    digest = steps.put(digest, "digests")
    first = digest.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("h")).filter(F.col("keeper") < F.col("h"))
    copies = digest.join(first, ["d1", "d2", "n"]).filter(F.col("doc_id") > F.col("keeper")).select("doc_id", "tag").distinct()
    copies = steps.put(copies, "copies")

    sent = named.mapInArrow(send_anchors(depth, buckets), "bucket long, meet boolean, hashes binary, docs binary, positions binary")
    shared = sent.groupBy("bucket").applyInArrow(shared_anchors, "doc_id long, tag int, position int")
    shared = shared.join(copies, ["doc_id", "tag"], "left_anti")
    shared = steps.put(shared.groupBy("doc_id", "tag").agg(F.collect_set("position").alias("positions")), "anchors")
    steps.drop(digest)

    found = named.join(shared, ["doc_id", "tag"]).select("doc_id", "tag", "text", "positions")
    found = found.mapInArrow(stretches(depth), "anchor long, content long, doc_id long, tag int, start int, words binary")
    found = steps.put(found, "stretches")
    steps.drop(shared)
    hot_anchors = steps.put(found.groupBy("anchor").count().filter(F.col("count") > hot).select("anchor"), "hot")
    plain = found.join(hot_anchors, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor")
    lost = plain.select("anchor", "content", "words", "doc_id", "tag", "start").mapInArrow(subtrees(depth), LOST)
    split = found.join(hot_anchors, "anchor", "left_semi")
    lost = lost.unionByName(longer_prefixes(split, depth)).filter(F.size("windows") > 0)
    lost = steps.put(lost, "lost")
    steps.drop(found)
    lost = lost.groupBy("doc_id", "tag").agg(F.collect_list("windows").alias("windows"))
    marked = lost.join(copies.withColumn("whole", F.lit(True)), ["doc_id", "tag"], "full")
    return docs.join(marked, ["doc_id", "tag"], "left").mapInArrow(cleaned(depth), CLEANED)


def longer_prefixes(stretch: DataFrame, depth: int) -> DataFrame:
    """The same as `subtrees` for hot anchors: every suffix is its own group, by a prefix of all `depth` words."""
    distinct = stretch.groupBy("anchor", "content", "words").agg(F.min("doc_id").alias("doc_id"))
    cut = distinct.select("anchor", "content", "doc_id", F.expr(f"explode(sequence(0, int(length(words) / 8) - {depth}))").alias("i"), "words")
    cut = cut.select("anchor", "content", "doc_id", "i", F.expr(f"substring(words, i * 8 + 1, {depth * 8})").alias("prefix"))
    least = cut.groupBy("prefix").agg(F.min("doc_id").alias("keeper"))
    each = cut.select("anchor", "content", "i", "prefix").join(least, "prefix")
    lists = each.groupBy("anchor", "content").agg(F.array_sort(F.collect_list(F.struct("i", "keeper"))).alias("l"))
    packed = lists.select("anchor", "content", F.col("l.keeper").alias("k")).mapInArrow(_packed, "anchor long, content long, keepers binary")
    rows = stretch.select("anchor", "content", "doc_id", "tag", "start").join(packed, ["anchor", "content"])
    return rows.select("doc_id", "tag", "start", "keepers").mapInArrow(lost_windows, LOST)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = [np.array(k, np.int64).tobytes() for k in batch.column("k").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("anchor"), batch.column("content"), pa.array(raw, pa.binary())], ["anchor", "content", "keepers"])
