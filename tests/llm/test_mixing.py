"""Mixing: targets by repeated resharing, cuts at exact budgets, whole epochs, texts."""

import re

from pyspark.sql import functions as F

from harborflow.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Water filling by hand: sources in order, weights 5, 2, 1, caps of twice the size."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, out, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        rest = total - sum(out.values())
        full = [s for s in free if weight[s] * rest / sum(weight[x] for x in free) >= 2 * sizes[s]]
        if not full:
            return out | {s: weight[s] * rest / sum(weight[x] for x in free) for s in free}
        out |= {s: 2.0 * sizes[s] for s in full}
        free -= set(full)
    return out


def rows():
    texts = [(i, ["zeta", "alpha", None, "Beta", "é"][i % 7 % 5], " ".join(["w"] * (i % 11)) + ("\n\t" if i % 2 else "")) for i in range(300)]
    return texts + [(None, "alpha", "a b c"), (7, None, None), (8, "empty", ""), (9, "zeta", "x " * 5000), (9, "zeta", "x " * 5000)]


def frame(spark):
    return spark.createDataFrame(rows(), "doc_id long, source string, text string").withColumns({"size": F.lit("x"), "n_chars": F.lit(0)})


def test_targets_and_budgets(spark):
    out = mixing.mix_sources(frame(spark), rows_per_range=20).collect()
    sizes = {}
    for _, source, text in rows():
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    want = targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in out:
        assert r.size == len(WORD.findall(r.text or "")) and r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source]) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert len(out) == len(rows())
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = mixing.mix_sources(frame(spark).repartition(7), rows_per_range=50).collect()
    assert sorted(map(repr, ((r.doc_id, r.source, r.taken) for r in out))) == sorted(map(repr, ((r.doc_id, r.source, r.taken) for r in again)))


def test_texts_follow_what_is_taken(spark):
    docs = frame(spark)
    taken = sorted(((r.doc_id, r.source, r.taken) for r in mixing.mix_sources(docs).collect() if r.taken), key=repr)
    out = mixing.mixed_texts(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.source, len(WORD.findall(r.text))) for r in out.collect()), key=repr)
    assert got == taken


def test_names_that_clash(spark):
    names = ["_source", "_key", "_range", "_part", "_start", "_inside", "_text", "Target", "_own_size", "taken"]
    docs = frame(spark).withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in names})
    plain = sorted((repr((r.doc_id, r.source, r.taken)) for r in mixing.mix_sources(frame(spark)).collect()))
    out = mixing.mix_sources(docs)
    assert {"_source", "_key", "_range", "_part", "_start", "_inside", "_text", "_own_size"} <= set(out.columns)
    assert sorted(repr((r.doc_id, r.source, r.taken)) for r in out.collect()) == plain
    texts = mixing.mixed_texts(docs)
    assert texts.columns == docs.columns
    for r in texts.collect():
        assert r["size"] == "x" and all(r[c] == (None if r.doc_id is None else f"{c}{r.doc_id}") for c in names)


def test_equal_ids_and_sizes_are_taken_alike_in_any_order(spark):
    docs = spark.createDataFrame([(1, "a", f"w{i} x") for i in range(40)], "doc_id long, source string, text string")
    one = sorted(tuple(r) for r in mixing.mixed_texts(docs).collect())
    other = sorted(tuple(r) for r in mixing.mixed_texts(docs.orderBy(F.desc("text")).repartition(5)).collect())
    assert one == other and 0 < len(one)


def test_empty_table(spark):
    assert mixing.mix_sources(frame(spark).limit(0)).count() == 0
