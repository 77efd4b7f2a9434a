"""Ranked lexical search over bit-sliced Bloom signatures.

The index holds documents in blocks. A block is a table of bits, one row a hash position and one column a document, so that
the documents that may hold a term are the AND of a few rows. A term that occurs tf times sets bits for the levels
1, 2, 4, ... up to tf. From the levels that look set follows a bound on tf, never too low, and from that, the exact length of the
document and the exact weight of the term a bound on the term's part of the score: the rows of a term, weighted by what each level
adds, sum up to an upper bound of every document's score.

A search runs over the index twice. The first pass rescores, exactly and from the texts, the SEEDS documents of highest bound
of each item; their tenth best score is a floor that the item's tenth best of all documents cannot lie under. The second
pass gives every document whose bound reaches the floor (at the floor itself: whose id does not lose the tie), and all of these
are rescored exactly. So the result is exact, whatever the signatures' rate of false hits; they only decide how much is rescored.

Score: terms are maximal runs of ASCII letters, digits and all characters beyond ASCII, of A-Z only lower-cased. With N documents
that have a term, L terms in all of them and n in one, a term in df documents weighs w = floor(1000 ln((2N+2)/(2df+1))); with
m = 100-75+(75nN div L), a document's score sums w * (1000000000 tf div (1000 tf + 8m)) over the item's terms, repeats included.
df, N and L are exact: the lexicon counts terms by their bytes.

Scale: building is one pass of tasks plus an aggregate over terms. Items are taken in blocks of at most ITEMS items or OCCURRENCES
terms (one item with more is a block of its own), and each block's passes are tasks without shuffle; only candidates are joined with
the texts, broadcast up to BROADCAST_IDS ids, by shuffle beyond.

Edge cases: null or empty text and text without terms is in no count and no result; a null doc_id is searched like any other and
loses ties; repeated rows (or ids) are separate documents, whose order among equal score and id is open; a null item text has
no result; an item row that repeats another counts once, equal ids with different texts are separate items; an empty table gives an
empty result; other columns are ignored. Texts of any length are indexed whole; a signature has at most MAX_BITS positions,
beyond which it only lets more documents through to the exact score.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborflow.llm import words
from harborflow.llm.stages import Stages

TERM = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"
TOP = 10
SEEDS = 40
ITEMS = 256
OCCURRENCES = 65_536
BROADCAST_IDS = 200_000

# Signature: positions a term and level, positions a document per token it holds, and bounds of a block.
HASHES = 3
BITS_PER_TOKEN = 16
MAX_BITS = 1 << 22
BLOCK_DOCS = 1_024
BLOCK_CELLS = 1 << 25
TEXT_CHUNK = 8 << 20
TERM_ROWS = 1_024

_BETWEEN = np.ones(256, bool)
for _characters in (string.ascii_letters, string.digits):
    _BETWEEN[[ord(c) for c in _characters]] = False
_BETWEEN[128:] = False
_U = np.uint64


@dataclass(frozen=True)
class Index:
    """`blocks`: doc_ids, n, bits (rows x documents, packed), positions, levels; `lexicon`: term, df; N documents with L terms."""

    blocks: DataFrame
    lexicon: DataFrame
    n_docs: int
    n_terms: int


@dataclass(frozen=True)
class Items:
    """One block of items: distinct terms with weights, and per item the places and repeats of its terms."""

    ids: list
    terms: list[bytes]
    weights: np.ndarray
    places: list[np.ndarray]
    repeats: list[np.ndarray]


# --- terms -----------------------------------------------------------------------


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All terms of some texts, as codes into their distinct bytes, and the first term of every text."""
    start, end, first = words.spans(data, offsets, _BETWEEN)
    ends = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    packed = np.ascontiguousarray(words.LOWER[data[~_BETWEEN[data]]])
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(packed)])
    return column.dictionary_encode(), first


def _counts(codes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, code, occurrences) of every code a text holds, by text."""
    text = np.repeat(np.arange(len(first) - 1, dtype=np.int64), np.diff(first))
    known = codes >= 0
    pairs, tf = np.unique(text[known] * max(width, 1) + codes[known], return_counts=True)
    return *np.divmod(pairs, max(width, 1)), tf


def _hashes(terms: pa.LargeBinaryArray | list[bytes]) -> np.ndarray:
    column = terms if isinstance(terms, pa.Array) else pa.array(terms, pa.large_binary())
    if len(column) == 0:
        return np.zeros(0, np.uint64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
    return words.span_hashes(words.prefix_hashes(data), offsets[:-1] - offsets[0], offsets[1:] - offsets[0])


def _positions(hashes: np.ndarray, level: np.ndarray | int, positions: int) -> np.ndarray:
    """HASHES rows of the table for every token (a term's hash and a level)."""
    h = words.mix(hashes + _U(0x9E3779B97F4A7C15) * (np.atleast_1d(level).astype(np.uint64) + _U(1)))
    low, high, mask = h & _U(0xFFFFFFFF), h >> _U(32), _U(0xFFFFFFFF)
    each = [(((low + _U(i) * high) & mask) * _U(positions)) >> _U(32) for i in range(HASHES)]
    return np.stack(each, 1).astype(np.int64)


# --- index -----------------------------------------------------------------------


def _blocks(tokens: np.ndarray) -> Iterator[np.ndarray]:
    """Texts with a like number of tokens, in blocks bounded in texts and cells."""
    order = np.argsort(tokens, kind="stable")
    begin = 0
    while begin < len(order):
        end, least = begin + 1, tokens[order[begin]]
        while (
            end < len(order) and end - begin < BLOCK_DOCS and tokens[order[end]] <= 1.5 * least + 64
            and BITS_PER_TOKEN * tokens[order[end]] * (end + 1 - begin) <= BLOCK_CELLS
        ):
            end += 1
        yield order[begin:end]
        begin = end


def _signatures(ids: pa.Array, data: np.ndarray, offsets: np.ndarray) -> dict | None:
    """Blocks of some texts as columns; the first row also has their distinct terms and document counts."""
    coded, first = _terms(data, offsets)
    hashes = _hashes(coded.dictionary)
    text, code, tf = _counts(np.asarray(coded.indices), first, len(hashes))
    if not len(text):
        return None
    n = np.diff(first)
    level = np.frexp(tf.astype(np.float64))[1] - 1
    tokens = np.bincount(text, level + 1, len(n)).astype(np.int64)
    bounds = np.searchsorted(text, np.arange(len(n) + 1))
    with_terms = np.flatnonzero(n > 0)
    out: dict[str, list] = {"doc_ids": [], "n": [], "positions": [], "levels": [], "bits": [], "terms": [], "dfs": []}
    for rows in (with_terms[b] for b in _blocks(tokens[with_terms])):
        positions = int(min(MAX_BITS, max(64, BITS_PER_TOKEN * tokens[rows].max())))
        cells = np.zeros((positions, -(-len(rows) // 8) * 8), bool)
        mine = np.concatenate([np.arange(bounds[r], bounds[r + 1]) for r in rows])
        column = np.repeat(np.arange(len(rows)), bounds[rows + 1] - bounds[rows])
        levels = int(level[mine].max()) + 1
        for j in range(levels):
            deep = level[mine] >= j
            cells[_positions(hashes[code[mine[deep]]], j, positions), column[deep, None]] = True
        out["doc_ids"].append(ids.take(pa.array(rows)).to_pylist())
        out["n"].append(n[rows].tolist())
        out["positions"].append(positions)
        out["levels"].append(levels)
        out["bits"].append(np.packbits(cells, axis=1).tobytes())
    blocks = len(out["n"])
    out["terms"] = [coded.dictionary.to_pylist(), *[[]] * (blocks - 1)]
    out["dfs"] = [np.bincount(code, minlength=len(hashes)).tolist(), *[[]] * (blocks - 1)]
    return out


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    steps = Stages(docs.sparkSession, "lexical-index")
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("doc_ids", T.ArrayType(id_type)), T.StructField("n", T.ArrayType(T.LongType())), T.StructField("positions", T.IntegerType()),
        T.StructField("levels", T.IntegerType()), T.StructField("bits", T.BinaryType()),
        T.StructField("terms", T.ArrayType(T.BinaryType())), T.StructField("dfs", T.ArrayType(T.LongType())),
    ])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = None
        for batch in batches:
            for begin, end, data, offsets in words.chunks(batch.column(1), TEXT_CHUNK):
                made = _signatures(batch.column(0).slice(begin, end - begin), data, offsets)
                if made is not None:
                    target = target or _arrow_schema(batch.schema.field(0).type)
                    yield pa.RecordBatch.from_pydict(made, target)

    stored = steps.put(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(part, schema), "blocks")
    pairs = stored.filter(F.size("terms") > 0).select(F.explode(F.arrays_zip("terms", "dfs")).alias("t"))
    lexicon = steps.put(pairs.groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.dfs").alias("df")), "lexicon")
    n_docs, n_terms = stored.agg(
        F.sum(F.size("n").cast("long")), F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, v: a + v))
    ).first()
    return Index(stored.drop("terms", "dfs"), lexicon, n_docs or 0, n_terms or 0)


def _arrow_schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([
        ("doc_ids", pa.list_(id_type)), ("n", pa.list_(pa.int64())), ("positions", pa.int32()), ("levels", pa.int32()), ("bits", pa.binary()),
        ("terms", pa.list_(pa.binary())), ("dfs", pa.list_(pa.int64())),
    ])


# --- items -----------------------------------------------------------------------


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[list[tuple]]:
    """(id, terms) of all items in bounded blocks."""
    text = F.translate(F.col("text"), string.ascii_uppercase, string.ascii_lowercase)
    terms = F.coalesce(F.regexp_extract_all(text, F.lit(TERM), F.lit(1)), F.array().cast("array<string>"))
    block, size = [], 0
    asked = items.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).distinct()
    for row in asked.select("id", terms.alias("terms")).toLocalIterator():
        if not row["terms"]:
            continue
        if block and (len(block) == ITEMS or size + len(row["terms"]) > OCCURRENCES):
            yield block
            block, size = [], 0
        block.append((row["id"], [t.encode() for t in row["terms"]]))
        size += len(row["terms"])
    if block:
        yield block


def weighed(spark: SparkSession, index: Index, block: list[tuple]) -> Items:
    """Weights of a block's terms, from the exact document counts of the lexicon."""
    terms = sorted({t for _, ts in block for t in ts})
    asked = spark.createDataFrame([(t,) for t in terms], "asked binary")
    known = index.lexicon.join(F.broadcast(asked), F.col("term") == F.col("asked")).select("term", "df").collect()
    df = {bytes(r["term"]): r["df"] for r in known}
    weights = [math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in terms]
    place = {t: i for i, t in enumerate(terms)}
    found = [np.unique([place[t] for t in ts], return_counts=True) for _, ts in block]
    return Items([i for i, _ in block], terms, np.array(weights, np.int64), [p for p, _ in found], [r for _, r in found])


def _lengths(n: np.ndarray, index_docs: int, index_terms: int) -> np.ndarray:
    """The score's m of documents with n terms."""
    return np.array([25 + (75 * int(v) * index_docs) // index_terms for v in n], np.int64)


def _saturated(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


# --- upper bounds ----------------------------------------------------------------


def _bounds(row: dict, items: Items, hashes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Upper bounds of the scores, items x documents of one block."""
    n = np.array(row["n"], np.int64)
    positions, width = row["positions"], -(-len(n) // 8)
    table = np.frombuffer(row["bits"], np.uint8).reshape(positions, width)
    m = _lengths(n, n_docs, n_terms)
    steps = []
    for j in range(row["levels"]):
        upper, lower = np.minimum((2 << j) - 1, n), np.minimum((1 << j) - 1, n)
        steps.append((_saturated(upper, m) - _saturated(lower, m)).astype(np.float64))
    total = np.zeros((len(items.ids), len(n)))
    for begin in range(0, len(hashes), TERM_ROWS):
        some = hashes[begin:begin + TERM_ROWS]
        part = np.zeros((len(some), len(n)))
        for j, step in enumerate(steps):
            rows = _positions(some, j, positions)
            both = table[rows[:, 0]]
            for i in range(1, HASHES):
                both &= table[rows[:, i]]
            hit = np.flatnonzero(both.any(1))
            part[hit] += np.unpackbits(both[hit], axis=1, count=len(n)) * step
        part *= items.weights[begin:begin + TERM_ROWS, None]
        for k, (places, repeats) in enumerate(zip(items.places, items.repeats)):
            low, high = np.searchsorted(places, (begin, begin + len(some)))
            if low < high:
                total[k] += repeats[low:high] @ part[places[low:high] - begin]
    # Sums of whole numbers are exact below 2**53; larger ones may round, by less than this.
    return np.where(total < 2.0**52, total, total * (1 + 1e-9))


def _candidates(index: Index, items: Items, id_type: T.DataType, choose) -> DataFrame:
    """(doc_id, item, bound) of the documents of each block that `choose(item, bounds, ids)` picks."""
    n_docs, n_terms = index.n_docs, index.n_terms

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _hashes(items.terms)
        for batch in batches:
            for row in range(batch.num_rows):
                block = {c: batch.column(c)[row].as_py() for c in ("n", "positions", "levels", "bits")}
                bounds = _bounds(block, items, hashes, n_docs, n_terms)
                ids = batch.column("doc_ids")[row].values
                chosen = [choose(k, bounds[k], ids) for k in range(len(bounds))]
                item = np.repeat(np.arange(len(chosen)), [len(c) for c in chosen])
                at = np.concatenate(chosen)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(at)), pa.array(item, pa.int32()), pa.array(bounds[item, at], pa.float64())], names=["doc_id", "item", "bound"]
                    )

    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("item", T.IntegerType()), T.StructField("bound", T.DoubleType())])
    return index.blocks.select("doc_ids", "n", "positions", "levels", "bits").mapInArrow(part, schema)


def _seeds(k: int, bounds: np.ndarray, ids: pa.Array) -> np.ndarray:
    positive = np.flatnonzero(bounds > 0)
    return positive[np.argsort(-bounds[positive], kind="stable")[:SEEDS]]


# --- exact scores ----------------------------------------------------------------


def _rescored(docs: DataFrame, wanted: DataFrame, items: Items, index: Index, id_col: str, text_col: str) -> DataFrame:
    """(item, doc_id, score) of the wanted (doc_id, items), exactly, from the texts; scores of 0 are left out."""
    n_docs, n_terms = index.n_docs, index.n_terms
    id_field = T.StructField("doc_id", docs.schema[id_col].dataType)
    schema = T.StructType([T.StructField("item", T.IntegerType()), id_field, T.StructField("score", T.LongType())])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = pa.array(items.terms, pa.large_binary())
        for batch in batches:
            lists = batch.column(2)
            for begin, end, data, offsets in words.chunks(batch.column(1), TEXT_CHUNK):
                coded, first = _terms(data, offsets)
                place = pc.fill_null(pc.index_in(coded.dictionary, value_set=asked), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                codes = place[np.asarray(coded.indices)] if len(coded) else np.zeros(0, np.int64)
                text, term, tf = _counts(codes, first, len(items.terms))
                bounds = np.searchsorted(text, np.arange(end - begin + 1))
                m = _lengths(np.diff(first), n_docs, n_terms)
                found = []
                for t in range(end - begin):
                    dense = np.zeros(len(items.terms), np.int64)
                    dense[term[bounds[t]:bounds[t + 1]]] = tf[bounds[t]:bounds[t + 1]]
                    for k in lists[begin + t].as_py():
                        places = items.places[k]
                        score = int((items.weights[places] * items.repeats[k] * _saturated(dense[places], m[t])).sum())
                        if score > 0:
                            found.append((k, begin + t, score))
                if found:
                    item, at, score = zip(*found)
                    ids = batch.column(0).take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), ids, pa.array(score, pa.int64())], names=schema.names)

    lists = wanted.groupBy(F.col("doc_id").alias("_wanted")).agg(F.collect_set("item").alias("_items"))
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    side = F.broadcast(lists) if wanted.select("doc_id").distinct().count() <= BROADCAST_IDS else lists
    return texts.join(side, F.col("doc_id").eqNullSafe(F.col("_wanted"))).select("doc_id", "text", "_items").mapInArrow(part, schema)


def _best(rows: DataFrame, order: list, k: int) -> DataFrame:
    """The first k of every item; Spark keeps k an item in each task before it shuffles."""
    return rows.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)


def search(
    index: Index, docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's best documents; `docs` is what the index was built from."""
    spark = docs.sparkSession
    steps = Stages(spark, "lexical-search")
    id_type, item_type = docs.schema[id_col].dataType, items.schema[item_col].dataType
    exact = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    results = []
    for block in item_blocks(items, item_col, item_text) if index.n_docs else ():
        asked = weighed(spark, index, block)
        first = _candidates(index, asked, id_type, _seeds)
        seeds = steps.put(_best(first, [F.col("bound").desc(), F.col("doc_id").asc_nulls_last()], SEEDS), "seeds")
        scored = _best(_rescored(docs, seeds, asked, index, id_col, text_col), exact, top)
        # Floor of an item: score and id of its last place among the seeds, if that place is taken.
        floors = {r["item"]: (r["score"], r["doc_id"]) for r in scored.filter(F.col("rank") == top).collect()}

        def reaches(k: int, bounds: np.ndarray, ids: pa.Array, floors=floors) -> np.ndarray:
            if k not in floors:
                return np.flatnonzero(bounds > 0)
            score, last = floors[k]
            over = np.flatnonzero(bounds >= score)
            if last is None:
                return over
            # At the floor itself an id that comes later loses the tie.
            tied = bounds[over] == score
            loses = np.array([tied[i] and ((v := ids[int(o)].as_py()) is None or v > last) for i, o in enumerate(over)], bool)
            return over[~loses]

        wanted = steps.put(_candidates(index, asked, id_type, reaches).select("doc_id", "item"), "wanted")
        ranked = _best(_rescored(docs, wanted, asked, index, id_col, text_col), exact, top)
        names = spark.createDataFrame(list(enumerate(asked.ids)), T.StructType([T.StructField("_no", T.IntegerType()), T.StructField(item_col, item_type)]))
        found = ranked.join(F.broadcast(names), F.col("item") == F.col("_no")).select(F.col(item_col).alias("item_id"), "rank", "doc_id", "score")
        results.append(steps.put(found, "found"))
        steps.drop(seeds, wanted)
    if not results:
        empty = [("item_id", item_type), ("rank", T.IntegerType()), ("doc_id", id_type), ("score", T.LongType())]
        return spark.createDataFrame([], T.StructType([T.StructField(*f) for f in empty]))
    return spark.read.schema(results[0].schema).parquet(*[steps.paths[id(r)] for r in results])
