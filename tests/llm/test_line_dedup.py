"""Line dedup against all pairs of lines."""

import os
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from harborflow.llm import line_dedup as ld
from harborflow.llm import quality_classifier as qc
from harborflow.llm.stages import Stages

SPACE = b" \t\n\r\x0b\x0c"


def distance(a, b, limit=ld.TAU):
    """Edit distance as far as `limit`, else limit + 1: the table near its diagonal only."""
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    row = {j: j for j in range(min(limit, len(b)) + 1)}
    for i in range(1, len(a) + 1):
        new, x = {}, a[i - 1]
        for j in range(max(0, i - limit), min(len(b), i + limit) + 1):
            best = row.get(j, limit) + 1
            if j:
                best = min(best, new.get(j - 1, limit) + 1, row.get(j - 1, limit + 1) + (x != b[j - 1]))
            new[j] = min(best, limit + 1)
        if min(new.values()) > limit:
            return limit + 1
        row = new
    return row[len(b)]


def brute(rows):
    """(doc_id, n_lines, kept lines); rows in storage order."""
    places = []
    for at, (doc, text) in enumerate(rows):
        for no, line in enumerate((text or "").encode().split(b"\n")):
            if line.strip(SPACE):
                places.append(((doc is None, doc or 0, at, no), line.strip(SPACE)))
    places.sort()
    first, kept = {}, {}
    for place, line in places:
        if line in first:
            continue
        near = any(
            abs(len(line) - len(old)) <= ld.TAU and min(len(line), len(old)) >= ld.MIN_BYTES and distance(line, old) <= ld.TAU for old in first
        )
        first[line] = place
        if not near:
            kept.setdefault(place[2], []).append(place[3])
    out = []
    for at, (doc, _) in enumerate(rows):
        out.append((doc, sum(p[2] == at for p, _ in places), tuple(kept.get(at, []))))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).withColumns({"lines": F.lit("x"), "body": F.lit(1)})
    return sorted(((r.doc_id, r.n_lines, tuple(r.kept_lines)) for r in ld.line_dedup(docs, **options).collect()), key=repr)


def edited(r, line):
    for _ in range(r.randrange(4)):
        at = r.randrange(len(line)) if line else 0
        line = line[:at] + r.choice(["", "x", line[at:at + 1] + "y"]) + line[at + 1:]
    return line


def mixed(seed, n=40):
    r = random.Random(seed)
    bases = ["".join(r.choice("abcd é") for _ in range(r.choice([5, 18, 21, 24, 40, 90]))) for _ in range(12)]
    return [(r.randrange(10**6), "\n".join(edited(r, r.choice(bases)) for _ in range(r.randrange(5)))) for _ in range(n)]


@pytest.mark.parametrize("group", [ld.GROUP, 2])
def test_mixed(spark, group):
    rows = mixed(3)
    assert found(spark, rows, group=group) == brute(rows)


def test_odd_rows(spark):
    long = "a line that is long enough to be near another"
    rows = [
        (5, None), (6, ""), (7, " \n\t\n"), (9, long + "\n" + long), (8, long + "s"), (None, long), (None, long), (10, "short"), (11, "short"), (12, "short."),
        (13, "x" * 30000), (14, "x" * 30001), (15, "y" * 300), (15, "y" * 300), (16, "  " + long + "  \r"), (17, "é" * 20 + "\n" + "e" * 40),
    ]
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_texts(spark):
    long = "a line that is long enough to be near another"
    rows = [(1, f"{long}\nfirst own line", "a", 1), (2, f"{long}!\nsecond own line of its own", "b", 2), (3, long, None, 3), (None, "no id", "c", 4), (4, None, "c", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_lines string, n_chars int")
    out = sorted((tuple(r) for r in ld.deduplicated_texts(docs.withColumnRenamed("kept_lines", "extra")).collect()), key=repr)
    second = "second own line of its own"
    assert out == sorted([(1, rows[0][1], "a", len(rows[0][1])), (2, second, "b", len(second)), (None, "no id", "c", 5)], key=repr)


def test_only_what_the_texts_read_is_left(spark, monkeypatch):
    held = []
    monkeypatch.setattr(ld, "Stages", lambda *a: held.append(Stages(*a)) or held[-1])
    texts = [f"a line of {w} that is long enough\nand its own line {w * 2}\na common line for them all" for w in ("oak", "elm", "ash")]
    docs = spark.createDataFrame([*enumerate(texts), *enumerate(texts)], "doc_id long, text string")
    out = ld.deduplicated_texts(docs)
    (steps,) = held
    assert sorted(os.path.basename(path).rsplit("-", 1)[0] for path in steps.there) == ["line-dedup-occurrences", "line-dedup-repeated", "line-dedup-stays"]
    for path in steps.there:
        table = spark.read.parquet(path)
        assert "lines" not in table.columns and table.count() > 0
    assert out.count() == 3


def test_repeated_rows_through_two_stages(spark):
    """Rows equal in doc_id and text, and copies without a doc_id, stay once; the next stage gets no copies either."""
    text = "this line is long enough\nand so is this other one"
    rows = [(1, text, "a")] * 5 + [(None, "a text without an id that comes twice", "b")] * 3 + [(None, text, "c"), (2, text, "c"), (3, "a line of its own", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)
    lined = Stages(spark, "test-repeats").put(corpus_pipeline.lines(spark, docs, ""), "lined")
    want = sorted([(1, text, "a"), (None, "a text without an id that comes twice", "b"), (3, "a line of its own", "d")], key=repr)
    assert sorted((tuple(r) for r in lined.collect()), key=repr) == want
    single = corpus_pipeline.near_duplicates(spark, lined, "")
    assert sorted((tuple(r) for r in single.collect()), key=repr) == want


def test_texts_with_names_that_clash(spark):
    names = ["_hash", "_at", "kept_lines", "n_lines", "f", "o", "l", "_doc", "_body", "_row"]
    text = "this line is long enough\nand so is this other one"
    rows = [(1, text), (1, text), (2, text + "\nsome more of it"), (None, "a text without an id that comes twice"), (None, "a text without an id that comes twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    docs = docs.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id"), F.lit(0)).cast("string")) for c in names})
    got = ld.deduplicated_texts(docs)
    assert got.columns == docs.columns
    want = [(1, text), (2, "some more of it"), (None, rows[-1][1])]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((d, t, *(f"{c}{d or 0}" for c in names)) for d, t in want), key=repr)


def test_automaton():
    r = random.Random(1)
    x, y = [], []
    for _ in range(400):
        a = bytes(r.choice(b"ab") for _ in range(r.randrange(12)))
        x.append(a)
        y.append(edited(r, a.decode()).encode() if a and r.random() < 0.7 else bytes(r.choice(b"ab") for _ in range(r.randrange(12))))
    assert ld.within(x, y).tolist() == [distance(a, b) <= ld.TAU for a, b in zip(x, y, strict=True)]
    assert ld.within([], []).tolist() == []


def test_real_texts(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert found(spark, rows) == brute(rows)


def test_histograms_count_each_line_alone():
    """Blocks, gaps between lines and short lines change no count."""
    import numpy as np

    data = np.frombuffer(b" ab\n\nxyz xyz \nq\n" + b"word " * 5000 + b"\nend", np.uint8)
    begin, stop, _, _ = ld.lines_of(data, np.array([0, len(data)]))
    found = ld.histograms(data, begin, stop)
    for line, (a, b) in enumerate(zip(begin, stop, strict=True)):
        alone = ld.histograms(data[a:b], np.array([0]), np.array([b - a]))
        assert (found[line] == alone[0]).all()
        assert found[line][: ld.LANES].sum(dtype=int) % 256 == (b - a) % 256
        assert found[line][ld.LANES:].sum(dtype=int) % 256 == max(0, b - a - 2) % 256


def test_tasks_hold_little_at_once():
    rng = np.random.default_rng(5)
    letters = rng.integers(97, 123, (1000, 2100), dtype=np.uint8)
    letters[:, ::7], letters[:, ::70] = 32, 10
    batch = pa.record_batch({"doc_id": pa.array(range(1000)), "body": pa.array(range(1000)), "text": [r.tobytes().decode() for r in letters]})

    def peak(run):
        tracemalloc.start()
        for _ in run:
            pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    scanned = list(ld.scan(iter([batch])))  # tables of powers are made, too
    assert peak(ld.scan(iter([batch]))) < 20e6
    assert peak(qc.scan(["doc_id"])(iter([batch]))) < 15e6
    dealt = list(ld.deal(62)(iter(scanned * 4)))
    assert max(b.nbytes for b in dealt) < 4e6
    buckets = [x for b in dealt for x in b.column("bucket").to_pylist()]
    assert set(buckets) == set(range(62))
    own = np.concatenate([np.frombuffer(b"".join(b.column("lines").to_pylist()), np.int64) for b in dealt])
    keys = np.frombuffer(b"".join(x for b in dealt for x in b.column("keys").to_pylist()), np.uint64)
    flat = np.concatenate([b.column("keys").flatten().to_numpy().view(np.uint64) for b in scanned])
    lines = np.concatenate([b.column("lines").flatten().field("h1").to_numpy()[b.column("lines").flatten().field("size").to_numpy() >= ld.MIN_BYTES] for b in scanned])
    given = set(zip(flat.tolist(), np.repeat(lines, len(flat) // len(lines)).tolist(), strict=True))
    assert set(zip(keys.tolist(), own.tolist(), strict=True)) == given
