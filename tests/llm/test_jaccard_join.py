"""The Jaccard join against all pairs."""

import glob
import os
import random
import re
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from harborflow.llm import jaccard_join as jj
from harborflow.llm.stages import CLEANUP, Stages

SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    words = SPACES.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(rows, k, p, q):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None:
                continue
            both = len(sets[i] & sets[j])
            same = rows[i][0] == rows[j][0]
            if same or (sets[i] and sets[j] and q * both >= p * (len(sets[i]) + len(sets[j]) - both)):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), None if d is None else least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def near_copies(seed, words, groups, size, edits):
    r = random.Random(seed)
    rows, doc = [], 0
    for _ in range(groups):
        base = [f"w{r.randrange(5000)}" for _ in range(words)]
        for _ in range(size):
            own = list(base)
            for _ in range(r.randrange(edits + 1)):
                at = r.randrange(len(own))
                own[at:at + r.randrange(2)] = [f"x{r.randrange(5000)}"]
            rows.append((doc, " ".join(own)))
            doc += 1
    r.shuffle(rows)
    return rows


def joined(spark, rows, k, p, q, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("keys", F.lit("x")).withColumn("component", F.lit(1))
    return sorted((tuple(r) for r in jj.jaccard_join(docs, k, (p, q), **options).collect()), key=repr)


@pytest.mark.parametrize("k,p,q", [(3, 9, 10), (5, 4, 5)])
def test_near_copies(spark, k, p, q):
    rows = near_copies(1, 60, 12, 6, 4) + [(i + 1000, t) for i, t in near_copies(2, 12, 30, 4, 2)]
    assert joined(spark, rows, k, p, q) == brute(rows, k, p, q)


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One TWO"), (6, "one"), (7, "one two three"), (8, "one  two\tthree"), (None, "one two"),
        (9, "a b c"), (9, "one two three"), (10, "a b c"), (11, "É é x"), (12, "é é x"), (13, "w " * 4000), (14, "w w w"),
    ]
    assert joined(spark, rows, 3, 9, 10) == brute(rows, 3, 9, 10)


@pytest.mark.parametrize("block", [jj.BLOCK, 4])
def test_all_links(spark, block):
    """Every link between different sets, those inside a group that a star has connected too, and how many each document has."""
    rows = near_copies(4, 200, 3, 25, 3) + [(i + 1000, t) for i, t in near_copies(6, 40, 8, 3, 2)]
    rows += [(2000, rows[0][1]), (None, rows[0][1]), (2001, None), (2002, "alone")]
    node = {}
    for doc, text in rows:
        if doc is not None and (own := shingles(text, 3)):
            node[own] = min(node.get(own, doc), doc)
    sets = list(node)
    want = {tuple(sorted((node[x], node[y]))) for i, x in enumerate(sets) for y in sets[:i] if 10 * len(x & y) >= 9 * len(x | y)}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out, links = jj.jaccard_links(docs, 3, (9, 10), block=block)
    assert sorted(map(tuple, links.select("a", "b").collect())) == sorted(want) and len(want) > 300
    counts = {r.doc_id: r.n_links for r in jj.jaccard_counts(docs, 3, (9, 10), block=block).collect()}
    nodes = {d: node.get(shingles(t, 3)) if d is not None else None for d, t in rows}
    assert counts == {d: sum(n in pair for pair in want) for d, n in nodes.items()}


@pytest.mark.parametrize("block", [jj.BLOCK, 3])
def test_links_of_repeated_ids(spark, block):
    """A doc_id with several texts, that is the smallest of several classes: every class links by its own set only."""
    base, far = [f"b{i}" for i in range(100)], [f"f{i}" for i in range(100)]
    text = " ".join
    rows = [(3, text(far)), (5, text(base)), (5, text(far)), (7, text([*base, "x"])), (8, text([*far, "x"])), (5, text(far)), (1, text(["z", *base])), (1, text(["z", *far]))]
    rows += [(20 + i, text([*base, f"y{i}"])) for i in range(7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    of = {}
    for doc, body in rows:
        of.setdefault(shingles(body, 3), set()).add(doc)
    links = [(x, y) for i, x in enumerate(of) for y in list(of)[:i] if 10 * len(x & y) >= 9 * len(x | y)]
    want = {doc: sum(doc in of[x] for link in links for x in link) for doc, _ in rows}
    got = {r.doc_id: r.n_links for r in jj.jaccard_counts(docs, 3, (9, 10), block=block).collect()}
    assert got == want and got[8] == 2 and got[3] == 2
    _, found = jj.jaccard_links(docs, 3, (9, 10), block=block)
    assert sorted(map(tuple, found.collect())) == sorted(tuple(sorted((min(of[x]), min(of[y])))) for x, y in links)


def test_empty_table(spark):
    assert joined(spark, [], 3, 9, 10) == []


def test_hot_passage_needs_rare_elements(spark):
    """Every text has one long passage: keys are hot, and only rare elements and further rounds find the links."""
    r = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = []
    for i in range(60):
        own = " ".join(f"o{r.randrange(10**6)}" for _ in range(r.choice([1, 3, 8, 20])))
        rows.append((2 * i, f"{passage} {own}"))
        rows.append((2 * i + 1, f"{passage} {own} end{i % 3}"))
    assert joined(spark, rows, 3, 9, 10, hot=2) == brute(rows, 3, 9, 10)
    assert joined(spark, rows, 5, 4, 5, hot=2) == brute(rows, 5, 4, 5)


def test_real_texts(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert joined(spark, rows, 3, 9, 10) == brute(rows, 3, 9, 10)


@pytest.mark.parametrize("seed", range(3))
def test_pigeonhole_of_keys(seed):
    """Similar sets share a key, unless both are reported as short; so do the rare keys."""
    r = np.random.default_rng(seed)
    for p, q in ((9, 10), (4, 5)):
        for size in (4, 9, 20, 60, 300):
            x = np.sort(r.integers(0, 1 << 63, size, dtype=np.uint64))
            drop = r.integers(0, size * (q - p) // q + 1)
            y = np.delete(x, r.choice(size, drop, replace=False))
            y = np.sort(np.concatenate([y, r.integers(0, 1 << 63, max(0, (len(y) * q // p - size) // 2), dtype=np.uint64)]))
            both = len(np.intersect1d(x, y))
            if both * q < (len(x) + len(y) - both) * p or np.array_equal(x, y):
                continue
            for make in (lambda v, a, s: jj.exact_keys(v, a, s, p, q), lambda v, a, s: jj.rare_keys(v, a, s, p, q, 3)):
                keys, owners, short = make(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]), np.array([len(x), len(y)]))
                assert short.all() or np.intersect1d(keys[owners == 0], keys[owners == 1]).size


def test_tasks_hold_little_at_once():
    rng = np.random.default_rng(5)
    letters = rng.integers(97, 123, (1000, 2100), dtype=np.uint8)
    letters[:, ::7] = 32
    batch = pa.record_batch({"doc_id": pa.array(range(1000)), "text": [r.tobytes().decode() for r in letters]})

    def peak(run):
        tracemalloc.start()
        for _ in run:
            pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    scan = jj.scan(5, 4, 5, True)
    scanned = list(scan(iter([batch])))  # tables of weights are made, too
    assert sum(b.num_rows for b in scanned) == 1000
    assert peak(scan(iter([batch]))) < 30e6
    assert peak(jj.fetched(5, True)(iter([batch]))) < 20e6
    # Sets of other digests, with the same keys: each key is met once, and all others but the first of a key are sure.
    again = [b.set_column(i, b.schema.field(i), pa.array(b.column(i).to_numpy() ^ n)) for n in range(8) for b in scanned for i in [2]]
    dealt = list(jj.deal(62)(iter(again)))
    assert max(b.nbytes for b in dealt) < 4e6

    def sent(batches):
        found = set()
        for b in batches:
            for at, meet, keys, docs in zip(*[b.column(c).to_pylist() for c in ("bucket", "meet", "keys", "docs")], strict=True):
                found |= {(at, meet, *x) for x in zip(np.frombuffer(keys, np.uint64).tolist(), np.frombuffer(docs, np.int64).tolist(), strict=True)}
        return found

    whole = jj.KEYS_PER_BATCH
    try:
        jj.KEYS_PER_BATCH = 1 << 60
        assert sent(jj.deal(62)(iter(again))) == sent(dealt)
    finally:
        jj.KEYS_PER_BATCH = whole


def test_few_sets_go_to_few_files(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(40))) for i in range(400)]
    rows[300:] = [(i + 300, f"{t} tail") for i, t in rows[:100]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(24).localCheckpoint()
    join = jj.Join(docs, 5, (4, 5), True, jj.HOT)
    files, put = {}, join.steps.put

    def count(df, name):
        out = put(df, name)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    join.steps.put = count
    found = {r["doc_id"]: r["component_id"] for r in join.run().collect()}
    assert all(found[i] == (i - 300 if i >= 300 else i) for i in range(400))
    assert files["sets"] <= 2 and files["sizes"] <= 2, files


def long_sets(n, size):
    """Texts of words of their own but for ten at their end, and one that nearly equals the first."""
    rows = [(i, " ".join([f"d{i}w{j}" for j in range(size)] + [f"c{j}" for j in range(10)])) for i in range(n)]
    return rows + [(n, rows[0][1].replace("d0w7 ", "other "))]


def test_unlike_sets_do_not_meet_in_full(spark, monkeypatch):
    """Whole sets go to no more than a few pairs, however many share a key: each pair would carry both of its sets."""
    def all_of_them(p, q):
        def run(batches):
            for batch in batches:
                yield batch.select(["a", "b"])

        return run

    rows = long_sets(40, 1500)
    pairs = spark.createDataFrame([(a, b) for a in range(41) for b in range(a + 1, 41)], "a long, b long")
    join = jj.Join(spark.createDataFrame(rows, "doc_id long, text string"), 5, (4, 5), True, jj.HOT)
    assert [tuple(r) for r in join.verify(pairs).collect()] == [(0, 40)]
    monkeypatch.setattr(jj, "linked", all_of_them)
    assert [tuple(r) for r in join.verify(pairs).collect()] == [(0, 40)]


@pytest.mark.parametrize("seed", range(4))
def test_sketches_allow_all_links(seed):
    r = np.random.default_rng(seed)
    for n in (1, 5, 63, 64, 65, 1000, 1100, 5000):
        base = r.integers(0, 1 << 63, n, dtype=np.uint64)
        for share in (0, 0.05, 0.1, 0.2, 1):
            other = np.unique(np.concatenate([base[int(n * share):], r.integers(0, 1 << 63, int(n * share), dtype=np.uint64)]))
            sets = [np.unique(base), other]
            x, y = (np.frombuffer(b, np.uint64) for b in jj.sketches(np.concatenate(sets), np.cumsum([0, *map(len, sets)])))
            apart = len(np.setxor1d(*sets))
            assert jj.sketches_differ(x, y) == jj.sketches_differ(y, x) <= apart
            if share == 1 and n >= 1000:
                assert jj.sketches_differ(x, y) * 9 > sum(map(len, sets))


def test_only_what_the_result_reads_is_left(spark):
    from harborflow.session import run_folder

    def tables():
        folder = run_folder(spark).removeprefix("file:")
        return set(os.listdir(folder)) if os.path.isdir(folder) else set()

    rows = near_copies(1, 60, 12, 6, 4) + [(i + 1000, t) for i, t in near_copies(2, 12, 30, 4, 2)]
    before = tables()
    out = jj.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), 3, (9, 10), hot=4)
    left = {name.rsplit("-", 1)[0] for name in tables() - before}
    assert left == {"jaccard-join-sizes", "jaccard-join-classes", "jaccard-join-edges"}
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute(rows, 3, 9, 10)


def test_shuffles_go_with_their_query(spark):
    dirs = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def shuffles():
        return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*")}

    before, setting = shuffles(), spark.conf.get(CLEANUP)
    rows = spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).count()
    table = Stages(spark, "test").put(rows, "counts")
    end = time.time() + 20
    while shuffles() - before and time.time() < end:
        time.sleep(0.1)
    assert not shuffles() - before
    assert table.count() == rows.count() == 1000
    assert spark.conf.get(CLEANUP) == setting
