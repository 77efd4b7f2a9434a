"""Line dedup by a segment-partition edit join.

A line is what stands between line feeds, from its first word to the end of its last. A line goes if the same line, or one within
`TAU` byte edits of it, occurs earlier: at a smaller doc_id, or further up. Lines under `MIN_BYTES` only equal themselves.

1. Scan: hashes, lengths and byte histograms of all lines, and join keys. A line of a length is cut into TAU + 1 segments; of two
   lines within TAU edits, the longer has one of the shorter's segments as a substring at one of few positions (both its
   distance from the start and from the end bound them). Keys hold length, segment number and hash of the bytes.
2. Distinct lines with their first occurrence. Keys are packed into buckets and sorted there; keys of one line are left out.
3. Candidates: first, the lines of a key against the earliest of them; then, those not yet near an earlier line against all
   earlier ones. Lengths and histograms must allow TAU edits, as a condition of the join, so pairs that fail are never rows.
   Keys of more than `group` lines are split by parts of the histogram: TAU edits change at most 2 * TAU of its lanes, so
   of 2 * TAU + 1 parts one is equal.
4. Candidates are verified by a bit-parallel automaton over the 2 * TAU + 1 diagonals of the band.

Edge cases: null or empty text has no lines; null doc_ids come last; repeated rows are separate documents of which the
first in storage order is the earlier; an empty table gives an empty result; other columns are kept by `deduplicated_texts`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborflow.llm import words as wd
from harborflow.llm.names import free_names
from harborflow.llm.stages import SMALL_BATCHES, Stages

TAU = 2
MIN_BYTES = 20
GROUP = 1024
KEYS_PER_BUCKET = 500_000
KEYS_PER_TASK = 1_000_000
KEYS_PER_BATCH = 1 << 17
SCAN_BYTES = 1 << 18  # a task holds about a hundred bytes for each byte of the texts it scans at once
_U = np.uint64
SKETCH = ("s1", "s2", "s3", "s4", "s5", "s6")  # histograms of bytes and of runs of three bytes
LANES = 16
RUN_BLOCK = 1 << 14
_LANE = (wd.mix(np.arange(256, dtype=np.uint64)) % _U(LANES)).astype(np.uint8)
_WEIGHT = wd.mix(np.arange(LANES, dtype=np.uint64) + _U(99))

SCANNED = "doc_id long, body long, lines array<struct<no:int,h1:long,h2:long,size:int,s1:long,s2:long,s3:long,s4:long,s5:long,s6:long>>, keys array<long>"


# --- lines and keys -----------------------------------------------------------------------


def lines_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and end byte, text and number of every line that holds a word."""
    start, end, _ = wd.spans(data, offsets)
    cuts = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(data == 10) + 1, offsets[1:]]))
    at = np.searchsorted(start, cuts)
    held = np.diff(at) > 0
    begin, stop = start[at[:-1][held]], end[at[1:][held] - 1]
    text = np.searchsorted(offsets, begin, "right") - 1
    feeds = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data == 10, out=feeds[1:])
    return begin, stop, text, feeds[begin] - feeds[offsets[text]]


def _places(n: int, begin: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """For each of n bytes where its line's counters begin, `width` a line; what lies in no line has counters of its own after all."""
    rows = np.full(2 * len(begin) + 1, len(begin) * width)
    rows[1::2] = np.arange(len(begin)) * width
    edges = np.concatenate([[0], np.stack([begin, begin + size], axis=1).reshape(-1), [n]])
    return np.repeat(rows, np.diff(edges))


def histograms(data: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Of each line: its bytes by lane, then its runs of three bytes by lane (twice as many), modulo 256. Lines come in order."""
    n, lines, size = len(data), len(begin), stop - begin
    runs = np.zeros(n, np.uint8)
    # In blocks that stay in the processor's cache.
    for low in range(0, n - 2, RUN_BLOCK):
        part = data[low:low + RUN_BLOCK + 2].astype(np.uint64)
        code = (part[:-2] << _U(16)) | (part[1:-1] << _U(8)) | part[2:]
        runs[low:low + len(code)] = wd.mix(code) % _U(2 * LANES)
    single, triple = (
        np.bincount(_places(n, begin, held, width) + lane, minlength=(lines + 1) * width)[: lines * width].reshape(lines, width)
        for held, width, lane in ((size, LANES, _LANE[data]), (np.maximum(size - 2, 0), 2 * LANES, runs))
    )
    return np.concatenate([single, triple], axis=1).astype(np.uint8)


def segment(size: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of segment i (from 0) of lines of these sizes; the last ones take the rest."""
    base, rest = size // (TAU + 1), size % (TAU + 1)
    longer = np.maximum(0, i - (TAU + 1 - rest))
    return i * base + longer, base + (i >= TAU + 1 - rest)


def join_keys(sums: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """One row a line: TAU + 1 keys to be found by (even), then those it looks for (odd)."""
    size, columns = stop - begin, []

    def key(length, i, from_, span, role):
        h = wd.span_hashes(sums, begin + from_, begin + from_ + span)
        h = wd.mix(h + wd.mix(length.astype(np.uint64) * _U(64) + _U(i)))
        return (h & ~_U(1)) | _U(role)

    for i in range(TAU + 1):
        from_, span = segment(size, i)
        columns.append(key(size, i, from_, span, 0))
    for shorter in range(TAU + 1):
        length = size - shorter
        for i in range(TAU + 1):
            from_, span = segment(length, i)
            for shift in range(max(-i, shorter - (TAU - i)), min(i, shorter + (TAU - i)) + 1):
                at = np.clip(from_ + shift, 0, size - span)
                columns.append(key(length, i, at, span, 1))
    return np.stack(columns, axis=1) if len(begin) else np.zeros((0, 1), np.uint64)


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in wd.chunks(batch.column("text"), SCAN_BYTES):
            begin, stop, text, number = lines_of(data, offsets)
            sums = wd.prefix_hashes(data)
            first, second = wd.text_hashes(data, begin, stop), wd.span_hashes(sums, begin, stop)
            lanes = histograms(data, begin, stop).view(np.int64)
            ends = np.searchsorted(text, np.arange(hi - lo + 1)).astype(np.int32)
            entries = pa.StructArray.from_arrays(
                [
                    pa.array(number.astype(np.int32)), pa.array(first.view(np.int64)), pa.array(second.view(np.int64)),
                    pa.array((stop - begin).astype(np.int32)), *[pa.array(lanes[:, i]) for i in range(len(SKETCH))],
                ],
                ["no", "h1", "h2", "size", *SKETCH],
            )
            long = stop - begin >= MIN_BYTES
            keys = join_keys(sums, begin[long], stop[long])
            key_ends = (np.searchsorted(text[long], np.arange(hi - lo + 1)) * keys.shape[1]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(lo, hi - lo), batch.column("body").slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends), entries),
                    pa.ListArray.from_arrays(pa.array(key_ends), pa.array(keys.reshape(-1).view(np.int64))),
                ],
                ["doc_id", "body", "lines", "keys"],
            )


def deal(buckets: int):
    """(bucket, keys, lines): each line of a task once, to the buckets of its keys."""

    def flush(ids, keys):
        ids, keys = np.concatenate(ids), np.concatenate(keys)
        ids, once = np.unique(ids, return_index=True)
        keys = keys[once]
        own, keys = np.repeat(ids, keys.shape[1]), keys.reshape(-1)
        bucket = ((keys >> _U(32)) * _U(buckets)) >> _U(32)
        by = np.argsort(bucket, kind="stable")
        marks = np.flatnonzero(np.diff(bucket[by].astype(np.int64), prepend=-1))
        stops = np.append(marks[1:], len(by))
        # A batch for about as many keys each, cut between buckets.
        for part in np.split(np.arange(len(marks)), np.flatnonzero(np.diff(marks // KEYS_PER_BATCH)) + 1):
            held = [by[a:b] for a, b in zip(marks[part], stops[part], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[by[marks[part]]].astype(np.int64)), pa.array([keys[x].tobytes() for x in held], pa.binary()),
                    pa.array([own[x].tobytes() for x in held], pa.binary()),
                ],
                ["bucket", "keys", "lines"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, keys, held = [], [], 0
        for batch in batches:
            entries = batch.column("lines").flatten()
            long = entries.field("size").to_numpy() >= MIN_BYTES
            if not long.any():
                continue
            own = entries.field("h1").to_numpy()[long]
            flat = batch.column("keys").flatten().to_numpy().view(np.uint64).reshape(len(own), -1)
            ids.append(own)
            keys.append(flat)
            held += flat.size
            if held >= KEYS_PER_TASK:
                full = flush(ids, keys)
                ids, keys, held = [], [], 0
                yield from full
        if held:
            yield from flush(ids, keys)

    return run


def meet(table: pa.Table) -> pa.Table:
    """Of one bucket: (key, seeks, line) of keys that one line offers and another seeks."""
    raw = [b"".join(table.column(c).to_pylist()) for c in ("keys", "lines")]
    keys, lines = np.frombuffer(raw[0], np.uint64), np.frombuffer(raw[1], np.int64)
    order = np.lexsort((lines, keys))
    keys, lines = keys[order], lines[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (lines[1:] != lines[:-1])
    keys, lines = keys[fresh], lines[fresh]
    stem, seeks = keys >> _U(1), (keys & _U(1)).astype(bool)
    head = np.flatnonzero(np.diff(stem, prepend=~stem[:1]) != 0)
    sizes = np.diff(np.append(head, len(stem)))
    offered = np.add.reduceat((~seeks).astype(np.int64), head) if len(head) else head
    low = np.minimum.reduceat(lines, head) if len(head) else head
    high = np.maximum.reduceat(lines, head) if len(head) else head
    keep = np.repeat((offered > 0) & (offered < sizes) & (low < high), sizes)
    return pa.table({"key": stem[keep].view(np.int64), "seeks": seeks[keep], "line": lines[keep]})


def split_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of large keys once for each part of the histogram, with that part in the key."""
    parts = 2 * TAU + 1
    in_part = np.arange(LANES) % parts
    for batch in batches:
        lanes = np.stack([batch.column(c).to_numpy() for c in ("s1", "s2")], axis=1).copy().view(np.uint8).astype(np.uint64)
        key = batch.column("key").to_numpy().view(np.uint64)
        for part in range(parts):
            own = (lanes[:, in_part == part] * _WEIGHT[in_part == part]).sum(axis=1, dtype=np.uint64)
            new = wd.mix(own + wd.mix(key + _U(part + 1)))
            yield batch.set_column(batch.schema.get_field_index("key"), "key", pa.array(new.view(np.int64)))


# --- verification ---------------------------------------------------------------------------


def within(x: list[bytes], y: list[bytes], tau: int = TAU) -> np.ndarray:
    """Whether each x and y are within tau edits: sets of diagonals reached with 0 .. tau errors, as bits, for all pairs at once."""
    sizes = np.array([[len(a), len(b)] for a, b in zip(x, y, strict=True)]).reshape(-1, 2)
    out = np.zeros(len(sizes), bool)
    order = np.argsort(sizes.max(axis=1), kind="stable")
    begin = 0
    while begin < len(order):
        end = begin + 1
        while end < len(order) and end - begin < 4096 and (end - begin + 1) * (sizes[order[end]].max() + 1) <= 4_000_000:
            end += 1
        chosen = order[begin:end]
        m, n = sizes[chosen, 0], sizes[chosen, 1]
        height = int(m.max()) if len(m) else 0
        a = np.full((height + 1, len(chosen)), 256, np.int16)
        b = np.full((height + 1 + 4 * tau + 1, len(chosen)), 257, np.int16)
        for j, i in enumerate(chosen):
            a[: m[j], j] = np.frombuffer(x[i], np.uint8)
            own = np.frombuffer(y[i], np.uint8)[: len(b) - tau]
            b[tau:tau + len(own), j] = own
        full = np.uint16((1 << (2 * tau + 1)) - 1)
        reach = []
        for e in range(tau + 1):  # row 0: insertions only
            reach.append(np.full(len(chosen), sum(1 << (tau + d) for d in range(e + 1)), np.uint16))
        done = np.zeros(len(chosen), bool)
        final = np.where(np.abs(n - m) <= tau, 1 << np.clip(n - m + tau, 0, 2 * tau), 0).astype(np.uint16)
        done |= (m == 0) & ((reach[tau] & final) > 0)
        for row in range(height):
            same = np.zeros(len(chosen), np.uint16)
            for d in range(2 * tau + 1):
                same |= (a[row] == b[row + d]).astype(np.uint16) << np.uint16(d)
            new = [reach[0] & same]
            for e in range(1, tau + 1):
                new.append(((reach[e] & same) | reach[e - 1] | (reach[e - 1] >> np.uint16(1)) | (new[e - 1] << np.uint16(1))) & full)
            reach = new
            last = m == row + 1
            done |= last & ((reach[tau] & final) > 0)
        out[chosen] = done
        begin = end
    return out


def wanted_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(line, body) of the lines of a text whose hashes are wanted."""
    for batch in batches:
        lists = batch.column("wanted")
        values, at = lists.flatten().to_numpy().view(np.uint64), lists.offsets.to_numpy().astype(np.int64)
        at = at - at[0]
        for lo, hi, data, offsets in wd.chunks(batch.column("text"), SCAN_BYTES):
            begin, stop, text, _ = lines_of(data, offsets)
            hashes = wd.text_hashes(data, begin, stop)
            pairs = wd.mix(values[at[lo]:at[hi]]) + np.repeat(np.arange(hi - lo), np.diff(at[lo:hi + 1])).astype(np.uint64)
            hit = np.flatnonzero(np.isin(wd.mix(hashes) + text.astype(np.uint64), pairs))
            raw = data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes[hit].view(np.int64)),
                    pa.array([raw[a:b] for a, b in zip(begin[hit].tolist(), stop[hit].tolist(), strict=True)], pa.binary()),
                ],
                ["line", "body"],
            )


def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        near = within(batch.column("x").to_pylist(), batch.column("y").to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column("late").filter(pa.array(near))], ["late"])


def _allow(x: str, y: str) -> Column:
    """Whether histograms allow TAU edits: an edit changes at most 2 bytes and 6 runs of three."""
    def apart(names) -> Column:
        total = []
        for s in names:
            for lane in range(8):
                left = F.shiftrightunsigned(F.col(f"{x}.{s}"), 8 * lane).bitwiseAND(F.lit(255))
                right = F.shiftrightunsigned(F.col(f"{y}.{s}"), 8 * lane).bitwiseAND(F.lit(255))
                total.append(F.least(F.abs(left - right), 256 - F.abs(left - right)))
        return reduce(Column.__add__, total)

    return (apart(SKETCH[:2]) <= 2 * TAU) & (apart(SKETCH[2:]) <= 6 * TAU)


# --- the join ---------------------------------------------------------------------------------


class Dedup:
    def __init__(self, docs: DataFrame, group: int):
        self.steps, self.group = Stages(docs.sparkSession, "line-dedup", SMALL_BATCHES), group
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("body"))

    def stars(self, rows: DataFrame) -> DataFrame:
        """(late, early): every line of a key with the key's earliest one; rows: key, seeks, line, first, size and the sketch."""
        earliest = rows.groupBy("key").agg(F.min(F.struct("first", "line", "size", *SKETCH)).alias("p")).select("key", "p.*")
        x, y = earliest.alias("x"), rows.alias("y")
        near = F.abs(F.col("y.size") - F.col("x.size")) <= TAU
        found = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.line") != F.col("y.line")) & near & _allow("x", "y"))
        return found.select(F.col("y.line").alias("late"), F.col("x.line").alias("early")).distinct()

    def pairs(self, open_: DataFrame, rows: DataFrame) -> DataFrame:
        """(late, early): lines that are still open with all earlier ones of their keys."""
        x, y = open_.alias("x"), rows.alias("y")
        longer = F.when(F.col("x.seeks"), F.col("x.size") - F.col("y.size")).otherwise(F.col("y.size") - F.col("x.size"))
        near = (F.col("x.seeks") != F.col("y.seeks")) & longer.between(0, TAU) & (F.col("y.first") < F.col("x.first")) & (F.col("x.line") != F.col("y.line"))
        found = x.join(y, (F.col("x.key") == F.col("y.key")) & near & _allow("x", "y"))
        return found.select(F.col("x.line").alias("late"), F.col("y.line").alias("early")).distinct()

    def split(self, rows: DataFrame) -> DataFrame:
        """Rows with large keys split."""
        large = rows.groupBy("key").count().filter(F.col("count") > self.group).select("key")
        large = self.steps.put(large, "large")
        many = rows.join(large, "key", "left_semi").select(rows.columns)
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in many.schema)
        return self.steps.put(rows.join(large, "key", "left_anti").select(rows.columns).unionByName(many.mapInArrow(split_groups, schema)), "split")

    def verify(self, pairs: DataFrame, distinct: DataFrame) -> DataFrame:
        """The late lines of pairs within TAU edits."""
        pairs = self.steps.put(pairs, "pairs")
        if pairs.isEmpty():
            return pairs.select("late")
        needed = pairs.select(F.explode(F.array("late", "early")).alias("line")).distinct().join(distinct, "line")
        homes = needed.groupBy(F.col("first.doc_id").alias("doc_id")).agg(F.collect_list("line").alias("wanted"))
        found = self.docs.join(homes, self.docs["doc_id"].eqNullSafe(homes["doc_id"])).select("text", "wanted")
        bodies = self.steps.put(found.mapInArrow(wanted_lines, "line long, body binary").distinct(), "bodies")
        x, y = bodies.select(F.col("line").alias("late"), F.col("body").alias("x")), bodies.select(F.col("line").alias("early"), F.col("body").alias("y"))
        late = pairs.join(x, "late").join(y, "early").select("late", "x", "y").mapInArrow(confirmed, "late long").distinct()
        late = self.steps.put(late, "late")
        self.steps.drop(pairs, bodies)
        return late

    def run(self, *shown: Column | str) -> tuple[DataFrame, DataFrame]:
        """Scanned documents (doc_id, body, _row and lines, or what is shown of them), and the occurrences that stay: (_row, no)."""
        steps = self.steps
        scanned = steps.put(self.docs.mapInArrow(scan, SCANNED).withColumn("_row", F.monotonically_increasing_id()), "scan")
        each = scanned.select("doc_id", "_row", F.explode("lines").alias("l"))
        place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_row", "l.no").alias("place")
        each = each.select("l.h1", "l.h2", place, "l.size", *[f"l.{s}" for s in SKETCH])
        lines = each.groupBy("h1", "h2").agg(F.min("place").alias("first"), *[F.max(c).alias(c) for c in ("size", *SKETCH)])
        lines = steps.put(lines.withColumnRenamed("h1", "line"), "lines")

        total = scanned.agg(F.sum(F.greatest(F.size("keys"), F.lit(0)).cast("long"))).first()[0] or 0
        buckets = max(1, -(-total // KEYS_PER_BUCKET))
        dealt = scanned.select("lines", "keys").mapInArrow(deal(buckets), "bucket long, keys binary, lines binary")
        met = dealt.groupBy("bucket").applyInArrow(meet, "key long, seeks boolean, line long")
        rows = steps.put(met.join(lines.drop("h2"), "line"), "met")
        kept = steps.put(scanned.select(*shown) if shown else scanned.drop("keys"), "occurrences")
        steps.drop(scanned)

        late = self.verify(self.stars(rows), lines)
        undone = rows.join(late.withColumnRenamed("late", "line"), "line", "left_anti")
        rows = self.split(rows.join(undone.select("key").distinct(), "key", "left_semi").select(rows.columns))
        undone = rows.join(late.withColumnRenamed("late", "line"), "line", "left_anti").select(rows.columns)
        late = late.unionByName(self.verify(self.pairs(undone, rows), lines)).distinct()
        stays = lines.join(late.withColumnRenamed("late", "line"), "line", "left_anti")
        stays = steps.put(stays.select("first._row", "first.no"), "stays")
        steps.keep(kept, stays)
        return kept, stays


def line_dedup(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """One row a document: doc_id, lines (no, h1, h2, size, ...), n_lines, kept_lines (numbers of the lines that stay, sorted)."""
    kept, stays = Dedup(docs, group).run()
    lists = stays.groupBy("_row").agg(F.array_sort(F.collect_list("no")).alias("kept_lines"))
    return kept.join(lists, "_row", "left").select(
        "doc_id", "lines", F.size("lines").alias("n_lines"), F.coalesce("kept_lines", F.array().cast("array<int>")).alias("kept_lines")
    )


def rebuilt(kept_lines: str, n_lines: str):
    """Texts of the kept lines only, whose numbers the named columns give; a text of which all lines stay is left as it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, kept, n in zip(*(batch.column(c).to_pylist() for c in ("text", kept_lines, n_lines)), strict=True):
                lines = text.split("\n") if len(kept) < n else []
                out.append("\n".join(lines[i] for i in kept) if lines else text)
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(out, pa.string())).drop_columns([kept_lines, n_lines])

    return run


def deduplicated_texts(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """The columns of docs; texts hold the lines that stay, whole and in order. Documents without any are left out, and n_chars
    is counted anew. Rows meet their lines by doc_id and a 64-bit hash of the text. Rows equal in both would all meet the lines that
    the first of them keeps, so only the first in storage order is taken. Columns keep what they hold whatever their names.
    """
    hashed, place, kept_lines, n_lines = free_names(docs.columns, "_hash", "_at", "kept_lines", "n_lines")
    body = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    dedup = Dedup(docs, group)
    kept, stays = dedup.run(F.col("doc_id").alias("_doc"), F.col("body").alias("_body"), "_row", F.size("lines").alias("n_lines"))
    lists = stays.groupBy("_row").agg(F.array_sort(F.collect_list("no")).alias("kept_lines"))
    found = kept.join(lists, "_row").drop("_row").alias("f")
    repeated = kept.groupBy("_doc", "_body").count().filter(F.col("count") > 1).select("_doc", "_body")
    repeated = dedup.steps.put(repeated, "repeated").alias("r")

    def met(one: DataFrame, lines: DataFrame) -> DataFrame:
        one, lines = one.withColumn(hashed, body).alias("o"), lines.alias("l")
        return one.join(lines, F.col("o.doc_id").eqNullSafe(F.col("l._doc")) & (F.col(f"o.{hashed}") == F.col("l._body")))

    def parts(rows: DataFrame, numbered: bool = False) -> DataFrame:
        return rows.select(F.struct(*[F.col(f"o.`{c}`") for c in docs.columns]).alias("o"), "l.*", *([F.col(f"o.{place}").alias("_at")] if numbered else []))

    same = F.col("f._doc").eqNullSafe(F.col("r._doc")) & (F.col("f._body") == F.col("r._body"))
    if repeated.isEmpty():
        joined = parts(met(docs, found))
    else:
        many = parts(met(docs.withColumn(place, F.monotonically_increasing_id()), found.join(repeated, same, "left_semi")), numbered=True)
        first = many.groupBy("_doc", "_body").agg(*[F.min_by(c, "_at").alias(c) for c in ("o", "kept_lines", "n_lines")])
        joined = parts(met(docs, found.join(repeated, same, "left_anti"))).unionByName(first)
    joined = joined.select(*[F.col("o").getField(c).alias(c) for c in docs.columns], F.col("kept_lines").alias(kept_lines), F.col("n_lines").alias(n_lines))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    out = joined.mapInArrow(rebuilt(kept_lines, n_lines), schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
