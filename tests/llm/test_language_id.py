"""Language identification: held-out accuracy, and the tables against a plain PPM."""

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from harborflow.llm import language_id as li
from harborflow.llm import words as wd


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = li.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id")
    rows = out.groupBy("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("a"), F.count(F.lit(1)).alias("n")).collect()
    assert sum(r.n for r in rows) == 1000
    assert all(r.a > 0.97 for r in rows)


def plain_bits(train, text, langs):
    """PPM with dictionaries."""
    def codes(t):
        for _, _, data, offsets in wd.chunks(pa.array([t])):
            return li.grams(data, offsets).tolist()
        return []

    out = []
    for lang in langs:
        trees = [defaultdict(lambda: defaultdict(int)) for _ in range(li.ORDER + 1)]
        for t in train[lang]:
            for code in codes(t):
                for k in range(li.ORDER + 1):
                    part = code & ((1 << 8 * (k + 1)) - 1)
                    trees[k][part >> 8][part & 255] += 1
        for k in range(3, li.ORDER + 1):
            for ctx in list(trees[k]):
                trees[k][ctx] = {s: n for s, n in trees[k][ctx].items() if n >= li.MIN_COUNT}
        bits = 0.0
        for code in codes(text):
            for k in range(li.ORDER, -1, -1):
                part = code & ((1 << 8 * (k + 1)) - 1)
                held = trees[k].get(part >> 8)
                if not held:
                    continue
                total = sum(held.values()) + len(held)
                if part & 255 in held:
                    bits -= math.log2(held[part & 255] / total)
                    break
                bits -= math.log2(len(held) / total)
            else:
                bits += 8
        out.append(bits)
    return out


def test_tables_equal_plain_ppm():
    train = {"a": ["the cat sat on the mat", "Étude 12 was the cat"], "b": ["le chat est sur le tapis", "été ou hiver"]}
    langs, counts = sorted(train), []
    for lang in langs:
        parts = [li.grams(data, offsets) for _, _, data, offsets in wd.chunks(pa.array(train[lang]))]
        counts.append(np.unique(np.concatenate(parts), return_counts=True))
    trees = li.Trees(langs, counts)
    texts = ["the tapis", "Ö12 cat", "sur le mat", "x", "zzz \U0001f600"]
    for _, _, data, offsets in wd.chunks(pa.array(texts)):
        bits = trees.code_lengths(data, offsets)
    for got, text in zip(bits, texts, strict=True):
        assert got.tolist() == pytest.approx(plain_bits(train, text, langs), rel=1e-4)


def test_odd_rows(spark):
    rows = [(i, "the cat sat on the mat with the dog", "en") for i in range(40)] + [(i + 40, "le chat est sur le tapis avec un chien", "fr") for i in range(40)]
    rows += [(100, None, "en"), (101, "", "en"), (102, " 12 34 !", "fr"), (103, "the the", None), (None, "un chien", None), (103, "the the", None), (104, "le tapis " * 50000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x")).withColumn("held_out", F.lit(3))
    out = li.language_id(docs).filter("doc_id >= 100 or doc_id is null").collect()
    got = sorted(((r.doc_id, r.lang_pred) for r in out), key=repr)
    assert got == sorted([(100, "und"), (101, "und"), (102, "und"), (103, "en"), (103, "en"), (None, "fr"), (104, "fr")], key=repr)
    assert all(0 <= r.score <= 1 for r in out) and not any(r.held_out for r in out if r.doc_id is None)


def test_nothing_to_learn_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in li.language_id(docs).collect()] == [("und", 0.0)]
    assert li.language_id(docs.limit(0)).count() == 0
