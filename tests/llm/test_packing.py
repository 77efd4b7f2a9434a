"""Packing against the tokenizers library: every id once, crc32 of every piece, gapless windows."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from harborflow.llm import packing, tokens
from harborflow.llm import words as wd

ODD = [
    "", None, " ", "\n", "a", "  two  spaces ", "\n\nlines\n\n\n", "tab\t x\r\n", "nbsp   x　", "<|endoftext|> it's we'll 12 3a", "é中\U0001f600x ",
    "a\x1c\x1d b\x85 c", "x" * 5000, "word " * 3000,
]


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def check(pieces, texts, reference, window=1024):
    """texts: list of (doc_id, text). Returns the number of padded ids."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    want = defaultdict(list)
    for doc_id, text in texts:
        want[doc_id].append(reference(text) + [0])
    assert set(by_doc) == set(want)
    for doc_id, versions in want.items():
        if len(versions) > 1:
            assert sum(p["length"] for p in by_doc[doc_id]) == sum(map(len, versions))
            continue
        ids, at = versions[0], 0
        for p in sorted(by_doc[doc_id], key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            own = np.array(ids[at:at + p["length"]], "<u4")
            assert p["ids_crc32"] == zlib.crc32(own.tobytes())
            at += p["length"]
        assert at == len(ids)
    padded = 0
    for rows in by_sequence.values():
        at = 0
        for p in sorted(rows, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window
        padded += window - at
    return padded


def test_encoder_equals_tokenizers(reference):
    column = pa.array(ODD + ["the cat"] * 3)
    encoder = tokens.Encoder(public_tokenizers.path(packing.VOCABULARY))
    for _ in range(2):
        for lo, hi, data, offsets in wd.chunks(column, 64):
            ids, at = encoder.encode(data, offsets)
            for i in range(lo, hi):
                assert ids[at[i - lo]:at[i - lo + 1]].tolist() == reference(column[i].as_py())


def test_small_table(spark, reference):
    texts = [(i if i != 3 else None, t) for i, t in enumerate(ODD)] + [(1000, "same"), (1000, "same")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("whole", F.lit(1)).withColumn("tail", F.lit("x"))
    out = packing.pack_documents(docs, payload=packing.crc).withColumn("ids_crc32", F.conv(F.hex("payload"), 16, 10).cast("long"))
    assert check([r.asDict() for r in out.collect()], texts, reference) < 1024


def test_ids_themselves(spark, reference):
    docs = spark.createDataFrame([(1, "one two three"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: np.frombuffer(r.payload, "<u4").tolist() for r in packing.pack_documents(docs).collect()}
    assert rows == {1: reference("one two three") + [0], 2: [0]}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(docs).count() == 0


def test_several_tasks_and_shards(spark, reference, monkeypatch):
    from harborflow.llm.queries import QUERIES

    rows = QUERIES["op10_retrieval_packing"](spark, "/root/testdata/sf0.001").collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert check([r.asDict() for r in rows], texts, reference) < 1024


def test_neighbours_come_first():
    tails = [np.array(x, np.uint32) for x in ([5, 6, 7, 8], [1, 2, 3], [5, 6, 9], [1, 2, 4])]
    shard = packing.Shard(tails, np.ones(10), 3.25)
    shard.use(0, 4)
    assert next(shard.neighbours(0)) == 2
    shard.use(1, 3)
    assert next(shard.neighbours(1)) == 3
