"""Exact dedup against a dictionary, with weak digests as well."""

import hashlib

import pytest
from pyspark.sql import functions as F

from harborflow.llm import exact_dedup as ed
from harborflow.session import new_path

GONE = dict.fromkeys(map(ord, " \t\n\x0b\x0c\r"))


def brute(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault((text or "").translate(GONE), []).append((-len(text or ""), doc is None, doc))
    out = []
    for doc, text in rows:
        group = groups[(text or "").translate(GONE)]
        out.append((doc, min(group)[2], len(group), hashlib.sha256((text or "").translate(GONE).encode()).hexdigest()))
    return sorted(out, key=repr)


def write(spark, rows, files=2):
    path = new_path(spark, "documents")
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"digest": F.lit("x"), "copies": F.lit(1)})
    docs.repartition(files).write.parquet(path)
    return path


ROWS = [
    (1, "a b"), (2, "ab"), (3, " a\tb\n"), (4, None), (5, ""), (6, " "), (7, "x" * 200000), (8, "x" * 200000 + " "), (9, "é\xa0"), (10, "é"), (None, "ab  "),
    (11, "same"), (11, "same"), (12, "a\x0bc"), (13, "a\x0c c"), (14, "only"),
]


@pytest.mark.parametrize("digest", [ed.sha256, lambda t: F.substring(ed.sha256(t), 1, 1)])
def test_against_dictionary(spark, digest):
    path = write(spark, ROWS)
    out = ed.exact_dedup(spark, path, digest).collect()
    assert sum(r.kept for r in out) == len({(t or "").translate(GONE) for _, t in ROWS})
    want = [(d, k, n) for d, k, n, _ in brute(ROWS)]
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in out), key=repr) == sorted(want, key=repr)


def test_digest_is_that_of_the_text(spark):
    out = ed.exact_dedup(spark, write(spark, ROWS[:5])).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.digest) for r in out), key=repr) == brute(ROWS[:5])


def test_state_goes_on_with_new_files(spark):
    path, checkpoint = write(spark, [(2, "a"), (3, "b")], 1), new_path(spark, "state")
    assert {r.copies for r in ed.keyed_state(spark, path, checkpoint).collect()} == {1}
    spark.createDataFrame([(1, "a ", "x", 1)], "doc_id long, text string, digest string, copies int").write.mode("append").parquet(path)
    out = {r.doc_id: (r.keep_id, r.group_size) for r in ed.exact_dedup(spark, path, checkpoint=checkpoint).collect()}
    assert out == {1: (1, 2), 2: (1, 2), 3: (3, 1)}


def test_empty_table(spark):
    assert ed.exact_dedup(spark, write(spark, [], 1)).count() == 0


def test_plan_has_no_python(spark):
    plan = ed.exact_dedup(spark, write(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan
