"""Ranked lexical search: brute force over every document, bounds, ties, odd rows, blocks of items."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from harborflow.llm import lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=10):
    held = [(d, terms(t)) for d, t in docs]
    held = [(d, ts) for d, ts in held if ts]
    n_docs, n_terms = len(held), sum(len(ts) for _, ts in held)
    df = {}
    for _, ts in held:
        for t in set(ts):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in set(items):
        scored = []
        for d, ts in held:
            m = 25 + (75 * len(ts) * n_docs) // n_terms
            score = 0
            for t in terms(text):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1)))
                score += w * ((1_000_000_000 * ts.count(t)) // (1000 * ts.count(t) + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, rank, d, -s) for rank, (s, _, d) in enumerate(scored[:top], 1)]
    return sorted(out, key=repr)


def corpus(rng):
    vocabulary = ["".join(rng.choices("abcdefgéß0中", k=rng.randint(1, 5))) for _ in range(400)]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]

    def text(k):
        return "".join(rng.choice([w, w.upper(), w.capitalize()]) + rng.choice([" ", "\n", ", ", "_", "\x7f", "."]) for w in rng.choices(vocabulary, weights, k=k))

    docs = [(i, text(rng.choice([1, 5, 20, 60, 150]))) for i in range(500)]
    docs += [(1000 + i, docs[3][1]) for i in range(40)]  # ties beyond the tenth place
    docs += [(5, docs[9][1]), (6, docs[9][1]), (6, docs[9][1]), (None, docs[3][1]), (None, "zeta zeta"), (7, None), (8, ""), (9, " ,.-\n"), (2000, text(4000)), (2001, "only " * 3000)]
    items = [(i, text(rng.choice([1, 4, 30]))) for i in range(30)]
    items += [(100, docs[3][1]), (101, docs[9][1]), (102, None), (103, ""), (104, "unseen words"), (105, "Only ONLY"), (100, "zeta"), (None, "zeta only"), (1, items[1][1])]
    return docs, items


def run(spark, docs, items):
    frame = spark.createDataFrame([(d, t, 0) for d, t in docs], "doc_id long, text string, item int").repartition(4)
    asked = spark.createDataFrame(items, "item_id long, text string")
    out = L.search(L.build_index(frame), frame, asked)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, out.collect()), key=repr)


def test_against_every_document(spark):
    docs, items = corpus(random.Random(2))
    assert run(spark, docs, items) == brute(docs, items)


def test_small_blocks_and_weak_signatures(spark, monkeypatch):
    """Many blocks of items and documents, and signatures that hit by chance more often than not: the result is the same."""
    docs, items = corpus(random.Random(4))
    for name, value in (("ITEMS", 7), ("BLOCK_DOCS", 13), ("SEEDS", 10), ("TERM_ROWS", 16), ("BROADCAST_IDS", 0), ("BITS_PER_TOKEN", 2), ("MAX_BITS", 128)):
        monkeypatch.setattr(L, name, value)
    assert run(spark, docs, items) == brute(docs, items)


def test_empty(spark):
    docs, items = [(1, "a b"), (2, None)], [(1, "a")]
    assert run(spark, docs, []) == [] and run(spark, [], items) == [] and run(spark, docs[1:], items) == []


@pytest.mark.parametrize("seed", range(3))
def test_bounds_are_never_too_low_and_seldom_high(seed):
    """Every document's bound against its exact score; a bound above twice the score is rare for texts that hold an item's terms."""
    docs, items = corpus(random.Random(seed))
    texts = pa.array([t for _, t in docs], pa.large_string())
    held = [terms(t) for t in texts.to_pylist()]
    n_docs, n_terms = sum(1 for h in held if h), sum(map(len, held))
    block = [(i, [t.encode() for t in terms(x)]) for i, x in items if terms(x)]
    vocabulary = sorted({t for _, ts in block for t in ts})
    place = {t: i for i, t in enumerate(vocabulary)}
    weights = np.array([random.Random(t).randrange(1, 9000) for t in vocabulary], np.int64)
    found = [np.unique([place[t] for t in ts], return_counts=True) for _, ts in block]
    asked = L.Items([i for i, _ in block], vocabulary, weights, [p for p, _ in found], [r for _, r in found])
    (_, _, data, offsets), = L.words.chunks(texts, 1 << 30)
    made = L._signatures(pa.array(range(len(docs))), data, offsets)
    assert sorted(d for ids in made["doc_ids"] for d in ids) == [i for i, h in enumerate(held) if h]
    close = total = 0
    for b in range(len(made["n"])):
        bounds = L._bounds({c: made[c][b] for c in ("n", "positions", "levels", "bits")}, asked, L._hashes(vocabulary), n_docs, n_terms)
        for column, d in enumerate(made["doc_ids"][b]):
            m = 25 + (75 * len(held[d]) * n_docs) // n_terms
            for k, (_, ts) in enumerate(block):
                score = sum(int(weights[place[t]]) * ((10**9 * (tf := held[d].count(t.decode()))) // (1000 * tf + 8 * m)) for t in ts)
                assert bounds[k, column] >= score
                if score:
                    total += 1
                    close += bounds[k, column] <= 2 * score
    assert close >= 0.9 * total


def test_columns_with_other_names(spark):
    frame = spark.createDataFrame([("a", "x y"), ("b", "x")], "id string, body string")
    index = L.build_index(frame, "id", "body")
    items = frame.select(F.col("id").alias("q"), F.col("body").alias("words"))
    out = L.search(index, frame, items, id_col="id", text_col="body", item_col="q", item_text="words").collect()
    assert sorted((r.item_id, r.doc_id) for r in out if r["rank"] == 1) == [("a", "a"), ("b", "b")]
