"""Hashes that stand for bytes: patterns that cancel out in sums of powers, through every operator that compares by them."""

import hashlib

import numpy as np

from harborflow.llm import jaccard_join, line_dedup, quality_rules, substring_dedup
from harborflow.llm import words as wd


def thue_morse(n, a="a", b="b"):
    """Two texts that differ everywhere and whose sums of powers of any odd base agree modulo 2**64."""
    bits = [i.bit_count() % 2 for i in range(n)]
    return "".join(b if x else a for x in bits), "".join(a if x else b for x in bits)


ONE, OTHER = thue_morse(4096)


def hashed(texts, hashes):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([len(t.encode()) for t in texts])
    return hashes(data, ends - [len(t.encode()) for t in texts], ends)


def test_patterns_do_not_cancel():
    assert len(set(hashed([ONE, OTHER], lambda d, s, e: wd.span_hashes(wd.prefix_hashes(d), s, e)).tolist())) == 1
    assert len(set(hashed([ONE, OTHER], wd.text_hashes).tolist())) == 2
    # Wherever a span lies, its hash is the same; length counts, also of bytes of any value.
    texts = ["a", "b", "ab", "ab", "a", "\x00", "\x00\x00", ONE, "x", OTHER, ONE, "é" * 3000]
    found = hashed(texts, wd.text_hashes).tolist()
    assert {t: {h for u, h in zip(texts, found) if u == t} for t in texts} == {t: {found[texts.index(t)]} for t in texts}
    assert len(set(found)) == len(set(texts))
    assert len(wd.text_hashes(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64))) == 0


def frame(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("doc_id", "text", "'web' as source")


def test_jaccard_join(spark):
    pad = " ".join(f"w{i}" for i in range(3))
    out = jaccard_join.jaccard_counts(frame(spark, f"{ONE} {pad}", f"{OTHER} {pad}"), 3, (9, 10)).collect()
    assert sorted((r.doc_id, r.component_id, r.n_links) for r in out) == [(0, 0, 0), (1, 1, 0)]


def test_substring_dedup(spark):
    words = [f"w{i}" for i in range(12)]
    out = substring_dedup.substring_dedup(frame(spark, " ".join([*words, ONE]), " ".join([*words, OTHER]))).collect()
    assert sorted((r.doc_id, r.n_removed) for r in out) == [(0, 0), (1, 0)]


def test_line_dedup(spark):
    out = line_dedup.line_dedup(frame(spark, ONE, OTHER, ONE)).collect()
    assert sorted((r.doc_id, list(r.kept_lines)) for r in out) == [(0, [0]), (1, [0]), (2, [])]


def test_quality_rules(spark):
    out = quality_rules.quality_rules(frame(spark, f"{ONE}\n{OTHER}\n{ONE}")).collect()
    assert [r.n_dup_lines for r in out] == [1]


def test_packing(spark):
    from harborflow.llm import packing
    from tokenizers import Tokenizer
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    out = packing.pack_documents(frame(spark, ONE, OTHER), payload=packing.crc).collect()
    assert {r.doc_id: r.doc_tokens for r in out} == {
        i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate((ONE, OTHER))
    }
    first = {r.doc_id: bytes(r.payload) for r in out if r.start == 0}
    assert first[0] != first[1] and hashlib.sha256(first[0]).digest()
