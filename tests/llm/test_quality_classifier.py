"""Quality classifier: held-out accuracy, statistics by hand, rules as columns."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from harborflow.llm import quality_classifier as qc
from harborflow.llm import words as wd


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = qc.quality_classifier(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    rows = out.join(labels, "doc_id").filter("held_out").select("quality", "score", "predicted").collect()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.9
    good, bad = [r.score for r in rows if r.quality], [r.score for r in rows if not r.quality]
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / len(good) / len(bad) > 0.95


def test_statistics():
    texts = ["One two two\nthree!\nthree!", "", None, "AB | 12 # é"]
    for _, _, data, offsets in wd.chunks(pa.array(texts)):
        found = qc.statistics(data, offsets)
    named = [dict(zip(qc.STATISTICS, row, strict=True)) for row in found.tolist()]
    assert named[0]["s_words"] == 5 and named[0]["s_mean_length"] == pytest.approx((3 + 3 + 3 + 6 + 6) / 5)
    assert named[0]["s_distinct"] == 3 / 5 and named[0]["s_adjacent"] == 2 / 5 and named[0]["s_lines"] == 3
    assert named[0]["s_dup_lines"] == pytest.approx(1 / 3) and named[0]["s_short_lines"] == 1 and named[0]["s_shouts"] == pytest.approx(2 / 21)
    assert set(named[1].values()) == set(named[2].values()) == {0.0}
    assert named[3]["s_lone_marks"] == 2 / 5 and named[3]["s_lower_words"] == 0 and named[3]["s_digits"] == 2 / 8


def test_rules_are_columns(spark):
    rules = qc.Rules(0.5, [((("s_words", True, 3.0), ("s_lines", False, 1.0)), 2.0), ((("s_words", False, 3.0),), -1.0)])
    df = spark.createDataFrame([(2.0, 2.0), (2.0, 1.0), (9.0, 5.0)], "s_words double, s_lines double")
    scores = [r[0] for r in df.select(rules.column()).collect()]
    assert scores == pytest.approx([1 / (1 + 2.718281828 ** -x) for x in (2.5, 0.5, -0.5)], rel=1e-6)


def test_odd_rows_and_labels(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (None, "a b", 3), (3, "x " * 50000, 4), (3, "x", 5)], "doc_id long, text string, s_words int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = qc.quality_classifier(docs, none).collect()
    assert len(out) == 5 and {r.score for r in out} == {0.5} and {r.predicted for r in out} == {1}
    one = spark.createDataFrame([(1, 1), (1, None), (2, 1), (3, 1)], "doc_id long, quality int")
    assert all(r.score > 0.5 for r in qc.quality_classifier(docs, one, held_out=4).collect())
    assert qc.quality_classifier(docs.limit(0), none).count() == 0
    kept = qc.score_quality(docs.withColumn("extra", F.lit("e")), qc.Rules(0.0, []))
    assert kept.filter("extra = 'e' and score = 0.5").count() == 5
