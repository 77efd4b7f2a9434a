"""URL filter: brute force over every rule, deep and long URLs, hot expressions, clashing names."""

import random
import re

import pytest
from pyspark.sql import functions as F

from harborflow.llm import url_filter as U

PAGES = "page_id long, url string, rule string, _salt int, html string"


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + p), len(h), v, h + p) for h, p, v in ((h.lower() if h else h, p, v) for h, p, v in rules if None not in (h, p, v))
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, default, None))
    return host, path, best[3], best[2]


def urls():
    rng = random.Random(5)
    labels, segments = ["com", "net", "example", "www", "a", "é", "EXAMPLE", "co"], ["en", "es", "fr", "", "x.html", "english", "é"]
    made = []
    for _ in range(600):
        host = ".".join(rng.choices(labels, k=rng.randint(1, 5)))
        path = "".join("/" + s for s in rng.choices(segments, k=rng.randint(0, 4)))
        made.append(rng.choice(["http", "HTTPS", ""]) + "://" + host + path + rng.choice(["", "?a=://b/en/", "#/en/", "/", "/?q"]))
    odd = [
        None, "", "com/", "http:/com/", "://", "://com/", "http://com", "http://COM/", "http://.com/", "http://com./", "http://example.com:80/en/",
        "x://net/es/\n/y", "a://b://c.com/", "http://" + "a." * 5000 + "com/" + "en/" * 5000, "http://" + "d." * 40 + "deep.com/" + "p/" * 80 + "q",
        "http://d.deep.com/" + "p/" * 80,
    ]
    return made + odd + ["http://hot.com/en/"] * 300


RULES = [
    *U.RULES, ("com", "/en", "block"), ("EXAMPLE.com", "/en/", "allow"), (None, "/", "block"), ("net", None, "block"), ("net", "/", None), ("", "", "allow"),
    ("d." * 39 + "deep.com", "/" + "p/" * 79, "block"), ("deep.com", "/" + "p/" * 70, "allow"), ("com", "", "block"), ("co", "en", "block"),
]


@pytest.mark.parametrize(("rules", "limit"), [(U.RULES, 100), (RULES, 100), (RULES, 0)])
def test_against_every_rule(spark, rules, limit):
    rows = [(i if i % 9 else None, u, "mine", 3, "<p>") for i, u in enumerate(urls())]
    pages = spark.createDataFrame(rows, PAGES).repartition(5)
    out = U.url_filter(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), broadcast_rules=limit)
    assert out.columns == ["page_id", "url", "_salt", "html", "host", "path", "rule", "verdict"]
    got = sorted(((r.page_id, r.url, r.host, r.path, r.rule, r.verdict) for r in out.collect()), key=repr)
    assert got == sorted(((i, u, *brute(u, rules)) for i, u, *_ in rows), key=repr)


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.com/"), (2, None)], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert sorted(map(tuple, U.url_filter(pages, none, "block").select("page_id", "rule", "verdict").collect())) == [(1, None, "block"), (2, None, "block")]
    assert U.url_filter(pages.limit(0), spark.createDataFrame(U.RULES, none.schema)).count() == 0


def test_native(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    plan = U.url_filter(pages, U.production_rules(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_long_expressions_meet_only_by_digest(spark):
    rules = U.prepared_rules(spark.createDataFrame(RULES, "host string, path string, verdict string"))
    assert rules.filter((F.col("labels") > U.MAX_LABELS) | (F.col("segments") > U.MAX_SEGMENTS)).count() == 0
