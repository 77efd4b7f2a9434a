"""The pipeline's stages against brute force on what each was given, and the contract of its module."""

import re
from collections import Counter

import test_jaccard_join
import test_line_dedup
import test_mixing
import test_packing
from test_packing import reference  # noqa: F401  (a fixture)

import corpus_pipeline as cp
from harborflow.llm.queries import ORACLE, QUERIES
from harborflow.llm.stages import Stages

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [(r.doc_id, r.text, r.source) for r in df.select("doc_id", "text", "source").collect()]


def test_stages(spark, reference):  # noqa: F811
    steps, docs = Stages(spark, "test-pipeline"), spark.read.parquet(f"{SF}/documents.parquet")
    columns, given = docs.columns, []
    for name, stage in cp.STAGES[:-1]:
        given.append(rows_of(docs))
        docs = steps.put(stage(spark, docs, SF), name.replace(" ", "-"))
        assert docs.columns == columns
    given.append(rows_of(docs))
    start, accepted, lined, single, mixed = given

    scores = {r.doc_id: r.predicted for r in QUERIES["op8_quality_classifier"](spark, SF).collect()}
    assert sorted(accepted) == sorted(r for r in start if scores[r[0]] == 1)

    want = {}
    kept = {d: k for d, _, k in test_line_dedup.brute([r[:2] for r in sorted(accepted)])}
    for doc, text, source in accepted:
        lines = text.split("\n")
        n = sum(bool(line.strip(" \t\r\x0b\x0c")) for line in lines)
        if kept[doc]:
            want[doc] = (text if len(kept[doc]) == n else "\n".join(lines[i] for i in kept[doc]), source)
    assert {d: (t, s) for d, t, s in lined} == want and len(lined) == len(want)

    groups = test_jaccard_join.brute([r[:2] for r in lined], 5, 4, 5)
    assert sorted(d for d, _, _ in single) == sorted(d for d, _, c in groups if d == c)

    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = Counter(), Counter()
    for _, text, source in single:
        sizes[source] += words(text)
    for _, text, source in mixed:
        taken[source] += words(text)
    targets = test_mixing.targets(dict(sizes))
    assert all(abs(taken[s] - targets[s]) <= 1 for s in targets)
    texts = {d: t for d, t, _ in single}
    assert all(re.split(r"[\x20\x09-\x0D]+", t.strip())[0] == re.split(r"[\x20\x09-\x0D]+", texts[d].strip())[0] for d, t, _ in mixed)

    pieces = [r.asDict() for r in cp.STAGES[-1][1](spark, docs, SF).collect()]
    test_packing.check(pieces, [r[:2] for r in mixed], reference)


def test_near_copies_without_ids(spark):
    words = [f"w{i}" for i in range(60)]
    near = lambda *other: " ".join(w if i not in other else f"o{i}" for i, w in enumerate(words))
    rows = [(None, near(), "a"), (None, near(59), "b"), (None, near(58, 59), "c"), (None, "quite another text of a few words", "d"), (None, None, "e"), (None, None, "f")]
    frame = lambda more: spark.createDataFrame(rows + more, "doc_id long, text string, source string").coalesce(1)
    assert sorted(r.source for r in cp.near_duplicates(spark, frame([]), SF).collect()) == ["a", "d", "e", "f"]
    got = cp.near_duplicates(spark, frame([(7, near(0), "g"), (5, near(1), "h")]), SF)
    assert got.columns == ["doc_id", "text", "source"]
    assert sorted((r.doc_id or 0, r.source) for r in got.collect()) == [(0, "d"), (0, "e"), (0, "f"), (5, "h")]


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = Stages(spark, "test-pipeline-run")
    for name, stage in cp.STAGES:
        docs = steps.put(stage(spark, docs, SF), name.replace(" ", "-"))
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, cp.run(spark, SF).select(key).collect())) == sorted(map(tuple, docs.select(key).collect()))


def test_registration():
    assert cp.ORACLE_SQL is None and len(cp.STAGES) == 5
    assert [re.match(r"op(\d+)_", n)[1] for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [str(i) for i in range(1, 14)]
    assert set(ORACLE) <= set(QUERIES)


def test_sql_counterparts(spark):
    from compare import connect, duck_result, spark_result

    con = connect(SF)
    for name, sql in ORACLE.items():
        assert spark_result(QUERIES[name](spark, SF)) == duck_result(con, sql), name
