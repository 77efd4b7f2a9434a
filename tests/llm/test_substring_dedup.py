"""Substring dedup against a table of all windows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from harborflow.llm import substring_dedup as sd


def brute(rows, depth):
    words = [(t or "").encode().split() for _, t in rows]
    least = {}
    for (doc, _), own in zip(rows, words):
        for i in range(len(own) - depth + 1):
            if doc is not None:
                key = tuple(own[i:i + depth])
                least[key] = min(least.get(key, doc), doc)
    out = []
    for (doc, _), own in zip(rows, words):
        gone = [False] * len(own)
        for i in range(len(own) - depth + 1):
            if doc is not None and least[tuple(own[i:i + depth])] < doc:
                gone[i:i + depth] = [True] * depth
        kept = b" ".join(w for w, g in zip(own, gone) if not g)
        out.append((doc, len(own), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def removed(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"tag": F.lit("x"), "anchor": F.lit(1)})
    out = sd.substring_dedup(docs, **options).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    return sorted((tuple(r) for r in out.collect()), key=repr)


def mixed(seed, n=60):
    r = random.Random(seed)
    passages = [[f"p{r.randrange(300)}" for _ in range(r.choice([8, 13, 14, 30, 60]))] for _ in range(8)]
    rows = []
    for i in range(n):
        own = []
        for _ in range(r.randrange(1, 5)):
            own += [f"w{r.randrange(1000)}" for _ in range(r.randrange(25))]
            own += r.choice(passages)
        if r.random() < 0.2:
            own = ["same"] * r.randrange(40)
        rows.append((r.randrange(1000), r.choice([" ", "\n", "  \t"]).join(own)))
    rows += [(2000 + i, rows[i][1]) for i in range(0, 20)]
    return list({d: (d, t) for d, t in rows}.values())


@pytest.mark.parametrize("hot", [sd.HOT, 3])
def test_mixed(spark, hot):
    rows = mixed(1)
    assert removed(spark, rows, hot=hot) == brute(rows, 13)


def test_small_groups(spark, monkeypatch):
    monkeypatch.setattr(sd, "SUFFIXES", 40)
    monkeypatch.setattr(sd, "ANCHORS_PER_TASK", 30)
    monkeypatch.setattr(sd, "ANCHORS_PER_BUCKET", 50)
    rows = mixed(2)
    assert removed(spark, rows) == brute(rows, 13)


def test_odd_rows(spark):
    long = " ".join(f"v{i}" for i in range(40))
    rows = [
        (1, None), (2, ""), (3, " \n "), (4, "a b c"), (5, "a b c"), (7, long), (6, long), (None, long), (None, long), (8, long), (8, long),
        (9, long + " tail"), (9, "head " + long), (10, "é " * 30), (11, "é " * 30), (12, " ".join(["x"] * 12)), (13, "x\x0bx " * 20),
    ]
    assert removed(spark, rows) == brute(rows, 13)


def test_empty_table(spark):
    assert removed(spark, []) == []


def test_real_texts(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    assert removed(spark, rows) == brute(rows, 13)
    assert sum(r[2] for r in removed(spark, rows)) > 0
