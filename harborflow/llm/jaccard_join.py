"""N-gram Jaccard join by universe partition and pigeonhole, with connected components.

A document is the set of its distinct word shingles. Two sets of Jaccard similarity of at least share = p/q, the smaller of size s, differ
in at most H = s * (q - p) / p elements. Sizes are divided into bands. For a band, all possible elements are dealt by a
hash into m segments; a set's part in a segment is a key. If a set has more than H segments that are not empty, then a
similar set has the same part in at least one of them. m leaves room for empty segments (`segments`).

1. Scan: set sizes, digests, keys. Equal sets are one class, for which its smallest doc_id stands.
2. Keys are packed into buckets by their upper bits and sorted there; keys of one document are left out. Before that,
   each task sends only the smallest document of a key and of a class, so a hot key or class is met once a task.
3. Stars: every member of a key is compared with one pivot, the member that shares most keys with others and so lies nearest to the
   middle of its group. Members linked to one pivot are known to be connected.
4. Keys whose members are not all known to be connected: pairs across are compared, without those within.
   Before any two sets are fetched, their parity bitmaps are compared, of which the bits that differ are at most as many as the
   elements that differ. This is a condition of the join itself, so pairs that fail it are never rows.
5. Keys of more than `hot` unconnected groups, and sets with too few segments: the parts are taken from elements that at most
   `hot` groups of these sets have, so no key can be hot again. The allocation is fixed: empty segments get 0,
   those of one element 1 (the part itself), others 2 (the part and its one-deletion neighbours), more than H in sum. Sets that have
   too few rare elements go into another round with a higher limit, until none is left.

6. Links: steps 3 and 4 leave out pairs already known to be connected. Linked sets are of one component, so all pairs of classes
   of a component are compared, in pairs of blocks of bounded size; no link is left out. `jaccard_counts` adds up how many links
   every class has, a number per class and pair of blocks, and never makes a row a link; `jaccard_links` returns the links.

Verification compares the whole sets (of 64-bit element hashes) that are fetched for candidates only, and of those only the pairs
that a second parity bitmap, with a bit or two for each element, allows: the fixed one of step 4 says little of large sets.

Edge cases: null or empty text and text without words has the empty set and links with nothing; fewer words than a
shingle are one element; a null doc_id links with nothing and has no component; rows with the same doc_id are one node
with several contents; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborflow.llm import words as wd
from harborflow.llm.graph import components
from harborflow.llm.stages import SMALL_BATCHES, Stages

HOT = 1024
BLOCK = 512  # sets of a component that meet another block of it in one group
BLOCK_ELEMENTS = 1_000_000
LANES = 8  # 64-bit words of a parity bitmap
KEYS_PER_BUCKET = 500_000
KEYS_PER_TASK = 1_000_000
KEYS_PER_BATCH = 1 << 17
SCAN_BYTES = 1 << 18  # a task holds about a hundred bytes for each byte of the texts it scans at once
WIDTH = 1.4  # ratio of a band's sizes
_U = np.uint64

BITS = [f"b{i}" for i in range(LANES)]
FETCHED = "doc_id long, d1 long, d2 long, elements binary"
SKETCHED = "doc_id long, n long, bits binary, elements binary"
SCANNED = "doc_id long, n_shingles long, d1 long, d2 long, " + ", ".join(f"{b} long" for b in BITS) + ", short boolean, keys array<long>"


# --- sets ----------------------------------------------------------------------------


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct element hashes of every text, one after the other, and where each text's begin."""
    start, end, first = wd.spans(data, offsets)
    if lower:
        data = wd.LOWER[data]
    hashes = wd.text_hashes(data, start, end)
    counts = np.diff(first)
    runs = np.maximum(counts - k + 1, (counts > 0).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(runs)])
    out = np.empty(int(at[-1]), np.uint64)
    inside = wd.runs_inside(first, k)
    out_long = np.repeat(counts >= k, runs)
    out[out_long] = wd.run_hashes(hashes, k)[inside]
    for i in np.flatnonzero((counts > 0) & (counts < k)):
        out[at[i]] = wd.run_hashes(hashes[first[i]:first[i + 1]], int(counts[i]))[0] ^ _U(int(counts[i]))
    for i in range(len(counts)):
        out[at[i]:at[i + 1]].sort()
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[at[:-1][runs > 0]] = True
    sizes = np.zeros(len(out) + 1, np.int64)
    np.cumsum(fresh, out=sizes[1:])
    return out[fresh], sizes[at]


def parity(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bitmap of every set: a bit says whether an odd number of its elements falls on it."""
    place = (wd.mix(values + _U(0x2545F4914F6CDD1D)) >> _U(40)).astype(np.int64) % (64 * LANES)
    own = np.repeat(np.arange(len(at) - 1), np.diff(at))
    odd = np.bincount(own * 64 * LANES + place, minlength=(len(at) - 1) * 64 * LANES) % 2
    return np.packbits(odd.astype(np.uint8).reshape(-1, 64 * LANES), axis=1).view(np.int64)


def sketches(values: np.ndarray, at: np.ndarray) -> list[bytes]:
    """Parity bitmap of every set with a bit or two an element: a power of two of bits, 64 at least. Its halves, one xor the other,
    are the set's bitmap of half as many bits."""
    sizes = np.diff(at)
    width = np.array([max(64, 1 << (n - 1).bit_length()) for n in sizes.tolist()], np.int64)
    base = np.concatenate([[0], np.cumsum(width)])
    own = np.repeat(np.arange(len(sizes)), sizes)
    place = wd.mix(values + _U(0x9FB21C651E98DF25)) & (width[own] - 1).astype(np.uint64)
    odd = np.bincount(base[own] + place.astype(np.int64), minlength=int(base[-1])) & 1
    raw = np.packbits(odd.astype(np.uint8)).tobytes()
    return [raw[a:b] for a, b in zip((base[:-1] // 8).tolist(), (base[1:] // 8).tolist(), strict=True)]


def sketches_differ(x: np.ndarray, y: np.ndarray) -> int:
    """How many bits of two sketches (words of 64 bits) differ, at the size of the smaller one: at most as many as elements do."""
    if len(x) > len(y):
        x, y = y, x
    while len(x) < len(y):
        y = y[: len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


# --- bands and keys ---------------------------------------------------------------------


def segments(low: int, bound: int) -> int:
    """How many segments a band needs: more than `bound` that are not empty, for all but one set in 1,000 or so."""
    m = bound + 1
    while True:
        empty = m * math.exp(-low / m)
        if empty + 3.1 * math.sqrt(empty) + 0.5 <= m - bound - 1 + (empty < 0.001):
            return m
        if m > 2 * bound + 64:
            return bound + 1 + bound // 4
        m += 1


@functools.cache
def bands(p: int, q: int, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First size, H and m of each band up to size `top`."""
    lows, bounds, counts, low = [], [], [], 1
    while low <= top:
        high = max(low, int(low * WIDTH))
        while (high + 1) * (q - p) // p == high * (q - p) // p:
            high += 1
        bound = high * (q - p) // p
        lows.append(low)
        bounds.append(bound)
        counts.append(segments(low, bound))
        low = high + 1
    return np.array(lows), np.array(bounds), np.array(counts)


def band_range(sizes: np.ndarray, lows: np.ndarray, p: int, q: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last band in which a set of each size looks for partners: those of the smaller set's size."""
    least = -(-sizes * p // q)
    return np.searchsorted(lows, np.maximum(least, 1), "right") - 1, np.searchsorted(lows, sizes, "right") - 1


def parts(values: np.ndarray, own: np.ndarray, m: np.ndarray, band: np.ndarray, salt: int):
    """Deal values of sets (own: set number) into m[set] segments. Returns slot of each value, slots before each set, key
    and count of each slot, element hash of each value."""
    base = np.concatenate([[0], np.cumsum(m)])
    dealt = wd.mix(values ^ wd.mix(band[own].astype(np.uint64) + _U(salt * 1000 + 17)))
    slot = base[own] + (dealt % m[own].astype(np.uint64)).astype(np.int64)
    element = wd.mix(values + _U(0x632BE59BD9B4E019))
    key = np.zeros(int(base[-1]), np.uint64)
    np.add.at(key, slot, element)
    return slot, base, key, np.bincount(slot, minlength=int(base[-1])), element


def closed(key: np.ndarray, position: np.ndarray, band: np.ndarray, salt: int) -> np.ndarray:
    return wd.mix(key + wd.mix(position.astype(np.uint64) * _U(0x9E3779B97F4A7C15) + band.astype(np.uint64) + _U(salt << 20)))


def exact_keys(values, at, sizes, p, q):
    """Keys of every set in all its bands: keys, owner of each, and whether a set has too few segments in some band."""
    top = int(sizes.max()) if len(sizes) else 0
    if top == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(sizes), bool)
    lows, bounds, counts = bands(p, q, 1 << (top - 1).bit_length())
    first, last = band_range(sizes, lows, p, q)
    keys, owners, short = [], [], np.zeros(len(sizes), bool)
    for step in range(int((last - first).max()) + 1):
        band = first + step
        active = np.flatnonzero((band <= last) & (sizes > 0) & (bounds[np.minimum(band, len(lows) - 1)] > 0))
        if not len(active):
            continue
        lengths = (at[1:] - at[:-1])[active]
        own = np.repeat(np.arange(len(active)), lengths)
        taken = values[_spread(at[:-1][active], lengths)]
        m, b = counts[band[active]], band[active]
        _, base, key, held, _ = parts(taken, own, m, b, 0)
        slots = np.repeat(np.arange(len(active)), m)
        used = held > 0
        short[active] |= np.bincount(slots[used], minlength=len(active)) <= bounds[b]
        position = np.arange(len(key)) - base[slots]
        keys.append(closed(key, position, b[slots], 0)[used])
        owners.append(active[slots[used]])
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), short
    return np.concatenate(keys), np.concatenate(owners), short


def _spread(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    stops = np.cumsum(length)
    return np.arange(int(stops[-1]) if len(stops) else 0) + np.repeat(begin - (stops - length), length)


def rare_keys(values, at, sizes, p, q, salt):
    """Keys from the rare elements of sets (whole sizes given) with the allocation 0, 1 or 2 of each segment."""
    top = int(sizes.max()) if len(sizes) else 0
    lows, bounds, counts = bands(p, q, 1 << max(top - 1, 1).bit_length())
    first, last = band_range(sizes, lows, p, q)
    keys, owners, short = [], [], np.zeros(len(sizes), bool)
    for step in range(int((last - first).max()) + 1 if len(sizes) else 0):
        band = first + step
        active = np.flatnonzero((band <= last) & (bounds[np.minimum(band, len(lows) - 1)] > 0))
        if not len(active):
            continue
        lengths = (at[1:] - at[:-1])[active]
        own = np.repeat(np.arange(len(active)), lengths)
        b = band[active]
        m = bounds[b] + 1
        slot, base, key, held, element = parts(values[_spread(at[:-1][active], lengths)], own, m, b, salt)
        slots = np.repeat(np.arange(len(active)), m)
        position = np.arange(len(key)) - base[slots]
        ones = np.bincount(slots[held == 1], minlength=len(active))
        more = np.bincount(slots[held > 1], minlength=len(active))
        short[active] |= ones + 2 * more < m
        used = held > 0
        keys.append(closed(key, position, b[slots], salt)[used])
        owners.append(active[slots[used]])
        # The neighbour without an element has the part's key less that element.
        deep = held[slot] > 1
        s = slot[deep]
        keys.append(closed(key[s] - element[deep], position[s], b[slots[s]], salt))
        owners.append(active[slots[s]])
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), short
    return np.concatenate(keys), np.concatenate(owners), short


# --- tasks ---------------------------------------------------------------------------------


def _lists(keys: np.ndarray, owners: np.ndarray, n: int) -> pa.ListArray:
    order = np.argsort(owners, kind="stable")
    ends = np.searchsorted(owners[order], np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[order].view(np.int64)))


def scan(k: int, p: int, q: int, lower: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in wd.chunks(batch.column("text"), SCAN_BYTES):
                values, at = shingle_sets(data, offsets, k, lower)
                sizes = np.diff(at)
                keys, owners, short = exact_keys(values, at, sizes, p, q)
                bitmap = parity(values, at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(sizes), *digests(values, at)]
                    + [pa.array(bitmap[:, i]) for i in range(LANES)] + [pa.array(short), _lists(keys, owners, hi - lo)],
                    ["doc_id", "n_shingles", "d1", "d2", *BITS, "short", "keys"],
                )

    return run


def deal(buckets: int):
    """(bucket, meet, keys, docs): entries that must meet others go to the bucket of their key, the rest to any."""

    def flush(docs, digests, lists):
        lengths = np.concatenate([x[0] for x in lists])
        keys = np.concatenate([x[1] for x in lists])
        docs, digests = np.concatenate(docs), np.concatenate(digests)
        # A class is met once: at its smallest document.
        order = np.lexsort((docs, digests[:, 1], digests[:, 0]))
        again = np.zeros(len(docs), bool)
        again[order[1:]] = (digests[order[1:]] == digests[order[:-1]]).all(axis=1)
        own = np.repeat(np.arange(len(docs)), lengths)
        keep = ~again[own]
        keys, own = keys[keep], docs[own[keep]]
        order = np.lexsort((own, keys))
        keys, own = keys[order], own[order]
        head = np.ones(len(keys), bool)
        head[1:] = keys[1:] != keys[:-1]
        alone = head.copy()
        alone[:-1] &= head[1:]
        for meet, chosen in ((True, head), (False, ~alone)):
            chosen_keys, chosen_docs = keys[chosen], own[chosen]
            place = chosen_keys if meet else wd.mix(chosen_docs.view(np.uint64))
            bucket = ((place >> _U(32)) * _U(buckets)) >> _U(32)
            by = np.argsort(bucket, kind="stable")
            marks = np.flatnonzero(np.diff(bucket[by].astype(np.int64), prepend=-1))
            if not len(by):
                continue
            stops = np.append(marks[1:], len(by))
            # A batch for about as many keys each, cut between buckets.
            for part in np.split(np.arange(len(marks)), np.flatnonzero(np.diff(marks // KEYS_PER_BATCH)) + 1):
                held = [by[a:b] for a, b in zip(marks[part], stops[part], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[by[marks[part]]].astype(np.int64)), pa.array(np.full(len(part), meet)),
                        pa.array([chosen_keys[x].tobytes() for x in held], pa.binary()),
                        pa.array([chosen_docs[x].tobytes() for x in held], pa.binary()),
                    ],
                    ["bucket", "meet", "keys", "docs"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, digests, lists, held = [], [], [], 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            column = batch.column("keys")
            docs.append(batch.column("doc_id").to_numpy())
            digests.append(np.stack([batch.column(c).to_numpy() for c in ("d1", "d2")], axis=1))
            keys = column.flatten().to_numpy().view(np.uint64)
            lists.append((np.diff(column.offsets.to_numpy()), keys))
            held += len(keys)
            if held >= KEYS_PER_TASK:
                full = flush(docs, digests, lists)
                docs, digests, lists, held = [], [], [], 0
                yield from full
        if docs:
            yield from flush(docs, digests, lists)

    return run


def meet(table: pa.Table) -> pa.Table:
    """Of one bucket: (key, doc_id) of keys that several documents have."""
    def side(flag: bool) -> tuple[np.ndarray, np.ndarray]:
        rows = table.filter(table.column("meet") if flag else pa.compute.invert(table.column("meet")))
        blobs = [b"".join(rows.column(c).to_pylist()) for c in ("keys", "docs")]
        return np.frombuffer(blobs[0], np.uint64), np.frombuffer(blobs[1], np.int64)

    keys, docs = side(True)
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
    keys, docs = keys[fresh], docs[fresh]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[1:] == keys[:-1]
    many = same[1:] | same[:-1]
    sure_keys, sure_docs = side(False)
    return pa.table({
        "key": np.concatenate([keys[many], sure_keys]).view(np.int64), "doc_id": np.concatenate([docs[many], sure_docs]),
    })


def digests(values: np.ndarray, at: np.ndarray) -> list[pa.Array]:
    """Two 64-bit numbers that stand for a set."""
    out = []
    for salt in (0xA5A5A5A5, 0x5C5C5C5C5C):
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(wd.mix(values + _U(salt)), out=sums[1:])
        out.append(pa.array(wd.mix(sums[at[1:]] - sums[at[:-1]]).view(np.int64)))
    return out


def fetched(k: int, lower: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in wd.chunks(batch.column("text"), SCAN_BYTES):
                values, at = shingle_sets(data, offsets, k, lower)
                raw = [values[at[i]:at[i + 1]].tobytes() for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), *digests(values, at), pa.array(raw, pa.binary())], ["doc_id", "d1", "d2", "elements"]
                )

    return run


def sketched(k: int, lower: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in wd.chunks(batch.column("text"), SCAN_BYTES):
                values, at = shingle_sets(data, offsets, k, lower)
                raw = [values[at[i]:at[i + 1]].tobytes() for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(at)), pa.array(sketches(values, at), pa.binary()), pa.array(raw, pa.binary())],
                    ["doc_id", "n", "bits", "elements"],
                )

    return run


def alike(p: int, q: int):
    """Pairs that their sketches allow to link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = batch.column("n").to_numpy() + batch.column("m").to_numpy()
            x, y = ([np.frombuffer(e.as_buffer(), np.uint64) for e in batch.column(c)] for c in ("x", "y"))
            differ = np.array([sketches_differ(a, b) for a, b in zip(x, y, strict=True)], np.int64)
            keep = pa.array(differ * (p + q) <= total * (q - p))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])

    return run


def linked(p: int, q: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                if len(x) * q < len(y) * p or not len(x):
                    continue
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int(np.count_nonzero(y[at] == x))
                keep[i] = common * q >= (len(x) + len(y) - common) * p
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], ["a", "b"])

    return run


def block_pairs(table: pa.Table, p: int, q: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of two blocks of a component (or one with itself): a row and the later rows whose sets link with its set."""
    own = table.column("own").to_numpy()
    sets = [np.frombuffer(e, np.uint64) for e in table.column("elements").to_pylist()]
    sizes = np.array([len(e) for e in sets], np.int64)
    alone = table.column("i")[0] == table.column("j")[0]
    low = own == own.min()
    left, right = np.flatnonzero(low), np.flatnonzero(low if alone else ~low)
    elements = np.concatenate([sets[i] for i in right]) if len(right) else np.zeros(0, np.uint64)
    begin = np.cumsum(sizes[right]) - sizes[right]
    for n, x in enumerate(left if len(right) else ()):
        first = n + 1 if alone else 0
        if first == len(right):
            return
        some = elements[begin[first]:]
        at = np.minimum(np.searchsorted(sets[x], some), sizes[x] - 1)
        common = np.add.reduceat((sets[x][at] == some).astype(np.int64), begin[first:] - begin[first])
        either = sizes[x] + sizes[right[first:]] - common
        yield int(x), right[first:][common * q >= either * p]


def block_links(p: int, q: int):
    """The links between the classes of two blocks, named by their smallest doc_ids."""

    def run(table: pa.Table) -> pa.Table:
        ids, found = table.column("doc_id").to_numpy(), [np.zeros((2, 0), np.int64)]
        for x, others in block_pairs(table, p, q):
            found.append(np.stack([np.minimum(ids[others], ids[x]), np.maximum(ids[others], ids[x])]))
        found = np.concatenate(found, axis=1)
        return pa.table({"a": found[0], "b": found[1]})

    return run


def block_counts(p: int, q: int):
    """How many links to the other block each class has that has any."""

    def run(table: pa.Table) -> pa.Table:
        counts = np.zeros(table.num_rows, np.int64)
        for x, others in block_pairs(table, p, q):
            counts[x] += len(others)
            counts[others] += 1
        has = pa.array(counts > 0)
        return pa.table({"d1": table.column("d1").filter(has), "d2": table.column("d2").filter(has), "n_links": pa.array(counts).filter(has)})

    return run


def rare(p: int, q: int, salt: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("rare")
            values = column.flatten().to_numpy().view(np.uint64)
            at = column.offsets.to_numpy().astype(np.int64)
            keys, owners, short = rare_keys(values, at - at[0], batch.column("size").to_numpy(), p, q, salt)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(short), _lists(keys, owners, batch.num_rows)], ["doc_id", "short", "keys"]
            )

    return run


# --- the join ---------------------------------------------------------------------------------


class Join:
    def __init__(self, docs: DataFrame, words: int, share: tuple[int, int], lower: bool, hot: int):
        self.k, (self.p, self.q), self.lower, self.hot = words, share, lower, hot
        self.steps = Stages(docs.sparkSession, "jaccard-join", SMALL_BATCHES)
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.sets: DataFrame | None = None

    def classes(self, scanned: DataFrame) -> DataFrame:
        """doc_id -> node, the smallest doc_id with an equal set, for documents that can link; with size and bitmap."""
        named = scanned.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
        kept = [F.max(b).alias(b) for b in BITS]  # equal sets have equal bitmaps
        least = named.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("node"), *kept).withColumnRenamed("n_shingles", "n")
        own = named.select("doc_id", "d1", "d2", F.col("n_shingles").alias("n")).distinct()
        return own.join(least, ["d1", "d2", "n"]).select("doc_id", "node", "d1", "d2", "n", *BITS)

    def near(self, x: str, y: str):
        """Whether bitmaps and sizes allow two sets to link."""
        differ = reduce(Column.__add__, [F.bit_count(F.col(f"{x}.{b}").bitwiseXOR(F.col(f"{y}.{b}"))) for b in BITS])
        n, m, p, q = F.col(f"{x}.n"), F.col(f"{y}.n"), self.p, self.q
        return (differ * (p + q) <= (n + m) * (q - p)) & (F.least(n, m) * q >= F.greatest(n, m) * p)

    def verify(self, pairs: DataFrame, *behind: DataFrame) -> DataFrame:
        """Of pairs (a, b) those that link. Sets are computed once for each document that occurs in pairs, and meet only in pairs that
        their sketches allow: a set of thousands of elements may share a key with many others.

        behind: tables that nothing reads once the pairs are written.
        """
        pairs = self.steps.put(pairs, "pairs")
        self.steps.drop(*behind)
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        wanted = self.docs.join(nodes, "doc_id", "left_semi").mapInArrow(sketched(self.k, self.lower), SKETCHED)
        # Every task that scans texts may find a few of them: without this, each would write its own file.
        sets = self.steps.put(wanted.hint("rebalance", "doc_id"), "sets")
        x = sets.select(F.col("doc_id").alias("a"), "n", F.col("bits").alias("x"))
        y = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("m"), F.col("bits").alias("y"))
        found = pairs.join(x, "a").join(y, "b").select("a", "b", "n", "m", "x", "y").mapInArrow(alike(self.p, self.q), "a long, b long")
        near = self.steps.put(found.distinct(), "near")
        x = sets.select(F.col("doc_id").alias("a"), F.col("elements").alias("x"))
        y = sets.select(F.col("doc_id").alias("b"), F.col("elements").alias("y"))
        found = near.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(linked(self.p, self.q), "a long, b long")
        links = self.steps.put(found.distinct(), "links")
        self.steps.drop(pairs, sets, near)
        return links

    def joined(self, links: DataFrame, more: DataFrame) -> DataFrame:
        both = self.steps.put(links.unionByName(more), "links")
        self.steps.drop(links, more)
        return both

    def labelled(self, links: DataFrame) -> DataFrame:
        """(doc_id, label): documents of one label are connected. One pass over links (a, b), which form stars."""
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("doc_id"), F.least("a", "m").alias("m"))
        above = least.select(F.col("doc_id").alias("m"), F.col("m").alias("mm"))
        return self.steps.put(least.join(above, "m", "left").select("doc_id", F.least("m", F.coalesce("mm", "m")).alias("label")), "labels")

    def open_keys(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """Rows of keys with members of several labels, with the label; a document without one is its own."""
        rows = members.join(labels, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
        split = rows.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter(F.col("l") < F.col("h"))
        return self.steps.put(rows.join(split.select("key"), "key", "left_semi"), "open")

    def stars(self, members: DataFrame) -> DataFrame:
        """Pairs (a, b) of each key's members with its pivot."""
        score = members.groupBy("doc_id").agg(F.count(F.lit(1)).alias("score"))
        best = members.join(score, "doc_id").groupBy("key").agg(F.max(F.struct("score", F.bitwise_not("doc_id").alias("o"), "n", *BITS)).alias("p"))
        x = best.select("key", F.bitwise_not("p.o").alias("pivot"), "p.n", *[f"p.{b}" for b in BITS]).alias("x")
        y = members.alias("y")
        found = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("pivot") != F.col("doc_id")) & self.near("x", "y"))
        return found.select(F.least("doc_id", "pivot").alias("a"), F.greatest("doc_id", "pivot").alias("b")).distinct()

    def across(self, rows: DataFrame, hot: int | None) -> tuple[DataFrame, DataFrame]:
        """Pairs of documents of one key and different labels, and the documents of keys with more than `hot` labels."""
        cold, many = rows, rows.select("doc_id").limit(0)
        if hot is not None:
            counts = rows.groupBy("key", "label").agg(F.lit(1).alias("_")).groupBy("key").count()
            large = self.steps.put(counts.filter(F.col("count") > hot).select("key"), "large")
            cold = rows.join(large, "key", "left_anti")
            many = rows.join(large, "key", "left_semi").select("doc_id").distinct()
        x, y = cold.alias("x"), cold.alias("y")
        found = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.label") < F.col("y.label")) & self.near("x", "y"))
        return found.select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct(), many

    def run(self) -> DataFrame:
        steps, p, q = self.steps, self.p, self.q
        scanned = steps.put(self.docs.mapInArrow(scan(self.k, p, q, self.lower), SCANNED), "scan")
        result = steps.put(scanned.select("doc_id", "n_shingles").hint("rebalance"), "sizes")
        nodes = steps.put(self.classes(scanned), "classes")
        usable = scanned.filter(F.col("doc_id").isNotNull())
        total = usable.agg(F.sum(F.greatest(F.size("keys"), F.lit(0)).cast("long"))).first()[0] or 0
        buckets = max(1, -(-total // KEYS_PER_BUCKET))
        dealt = usable.select("doc_id", "d1", "d2", "keys").mapInArrow(deal(buckets), "bucket long, meet boolean, keys binary, docs binary")
        found = dealt.groupBy("bucket").applyInArrow(meet, "key long, doc_id long")
        found = found.join(nodes, "doc_id").select("key", F.col("node").alias("doc_id"), "n", *BITS).distinct()
        members = steps.put(found, "members")
        short = steps.put(usable.filter("short").join(nodes, "doc_id").select(F.col("node").alias("doc_id")).distinct(), "short")
        steps.drop(scanned)

        done = steps.put(self.stars(members), "stars")
        links = self.verify(done)
        labels = self.labelled(links)
        rows = self.open_keys(members, labels)
        steps.drop(members, labels)
        pairs, rest = self.across(rows, self.hot)
        rest = steps.put(rest.unionByName(short).distinct(), "rest")
        links = self.joined(links, self.verify(pairs.join(done, ["a", "b"], "left_anti"), rows, done, short))
        facts = nodes.filter(F.col("doc_id") == F.col("node")).drop("node", "d1", "d2")
        salt, hot = 1, self.hot
        while rest.count() > 1:
            rest, more = self.round(rest, facts, self.labelled(links), salt, hot)
            links = self.joined(links, more)
            salt, hot = salt + 1, hot * 8
        steps.keep(result, nodes, links)

        # A doc_id with several contents ties their classes.
        several = nodes.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("h")).filter(F.col("a") < F.col("h"))
        tied = nodes.join(several, "doc_id").filter(F.col("node") > F.col("a")).select("a", F.col("node").alias("b"))
        labels = components(steps, links.unionByName(tied))
        steps.drop(links)
        self.nodes, self.labels = nodes, labels
        named = nodes.join(labels, "node", "left").select("doc_id", F.coalesce("component", "node").alias("component"))
        named = named.groupBy("doc_id").agg(F.min("component").alias("component"))
        out = result.join(named, "doc_id", "left")
        return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))

    def blocks(self, block: int) -> DataFrame:
        """Every class that may have links, once for each pair of blocks of its component that its own is in; after `run`."""
        classes = self.nodes.filter(F.col("doc_id") == F.col("node")).select("doc_id", "d1", "d2", "n")
        members = classes.join(self.labels.withColumnRenamed("node", "doc_id"), "doc_id")
        blocks = F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n") / BLOCK_ELEMENTS)).cast("int")
        many = members.groupBy("component").agg(F.count(F.lit(1)).alias("count"), blocks.alias("blocks")).filter(F.col("count") > 1)
        members = members.join(many, "component").select("doc_id", "d1", "d2", "component", "blocks")
        members = self.steps.put(members.withColumn("own", F.pmod(F.xxhash64("d1", "d2"), F.col("blocks")).cast("int")), "blocks")
        wanted = self.docs.join(members.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(fetched(self.k, self.lower), FETCHED)
        # A document with several texts stands for the classes it is the smallest of, each with its own set; equal rows once.
        sets = wanted.filter(F.octet_length("elements") > 0).dropDuplicates(["doc_id", "d1", "d2"])
        sets = self.steps.put(members.join(sets, ["doc_id", "d1", "d2"]), "link-sets")
        each = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return each.select("component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "doc_id", "d1", "d2", "elements")

    def links(self, block: int) -> DataFrame:
        """(a, b), a <= b: the links between classes, each named by its smallest doc_id."""
        found = self.blocks(block).groupBy("component", "i", "j").applyInArrow(block_links(self.p, self.q), "a long, b long")
        return self.steps.put(found, "all-links")

    def counts(self, block: int) -> DataFrame:
        """(doc_id, n_links) of documents with links: those of its class, or of its classes together."""
        found = self.blocks(block).groupBy("component", "i", "j").applyInArrow(block_counts(self.p, self.q), "d1 long, d2 long, n_links long")
        each = found.groupBy("d1", "d2").agg(F.sum("n_links").alias("n_links"))
        return self.nodes.join(each, ["d1", "d2"]).groupBy("doc_id").agg(F.sum("n_links").alias("n_links"))

    def round(self, rest: DataFrame, facts: DataFrame, labels: DataFrame, salt: int, hot: int) -> tuple[DataFrame, DataFrame]:
        """Links among `rest` by their rare elements; returns the sets left over, and the links."""
        steps = self.steps
        wanted = self.docs.join(rest, "doc_id", "left_semi").mapInArrow(self.listed(), "doc_id long, elements array<long>")
        wanted = wanted.join(labels, "doc_id", "left")
        wanted = steps.put(wanted.select("doc_id", "elements", F.coalesce("label", "doc_id").alias("label")), "rest-sets")
        each = wanted.select("doc_id", "label", F.explode("elements").alias("element"))
        spread = each.groupBy("element", "label").agg(F.lit(1).alias("_")).groupBy("element").count()
        cold = each.join(spread.filter(F.col("count") <= hot).select("element"), "element", "left_semi")
        held = cold.groupBy("doc_id").agg(F.collect_set("element").alias("rare"))
        sized = wanted.groupBy("doc_id").agg(F.max(F.size("elements")).cast("long").alias("size")).join(held, "doc_id", "left")
        sized = sized.select("doc_id", "size", F.coalesce("rare", F.array().cast("array<long>")).alias("rare"))
        keyed = steps.put(sized.mapInArrow(rare(self.p, self.q, salt), "doc_id long, short boolean, keys array<long>"), "rest-keys")
        steps.drop(wanted)
        members = keyed.select("doc_id", F.explode("keys").alias("key")).distinct().join(facts, "doc_id")
        left = steps.put(keyed.filter("short").select("doc_id"), "rest")
        rows = self.open_keys(members, labels)
        steps.drop(keyed, labels, rest)
        # No key has more labels than a rare element has.
        pairs, _ = self.across(rows, None)
        return left, self.verify(pairs, rows)

    def listed(self):
        k, lower = self.k, self.lower

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo, hi, data, offsets in wd.chunks(batch.column("text"), SCAN_BYTES):
                    values, at = shingle_sets(data, offsets, k, lower)
                    lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.view(np.int64)))
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), lists], ["doc_id", "elements"])

        return run


def jaccard_join(docs: DataFrame, words: int = 5, share: tuple[int, int] = (4, 5), lower: bool = True, hot: int = HOT) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (smallest doc_id that links reach, itself included)."""
    return Join(docs, words, share, lower, hot).run()


def jaccard_counts(
    docs: DataFrame, words: int = 5, share: tuple[int, int] = (4, 5), lower: bool = True, hot: int = HOT, block: int = BLOCK
) -> DataFrame:
    """The rows of `jaccard_join` with n_links: how many other sets the document's set links with, whoever has them, exact copies
    once. The links of a doc_id with several texts are added up."""
    join = Join(docs, words, share, lower, hot)
    return join.run().join(join.counts(block), "doc_id", "left").fillna(0, ["n_links"])


def jaccard_links(
    docs: DataFrame, words: int = 5, share: tuple[int, int] = (4, 5), lower: bool = True, hot: int = HOT, block: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """The rows of `jaccard_join`, and all links (a, b) between different sets, each set named by the smallest doc_id that has it, a <= b."""
    join = Join(docs, words, share, lower, hot)
    return join.run(), join.links(block)
