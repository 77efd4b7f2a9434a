"""Quality rules against plain Python."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from harborflow.llm import quality_rules as qr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    count = defaultdict(int)
    for i in range(len(words) - 7):
        count[tuple(words[i:i + 8])] += 1
    covered = set()
    for i in range(len(words) - 7):
        if count[tuple(words[i:i + 8])] > 1:
            covered |= set(range(i, i + 8))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def lower(line):
    return " ".join("".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(line))


def brute(rows, min_docs, min_share, min_left):
    contents = defaultdict(list)
    for doc, text, host in rows:
        contents[host, tuple(WORD.findall(text or ""))].append((doc is None, doc, text))
    holders, hosts = defaultdict(list), defaultdict(int)
    for (host, _), same in contents.items():
        hosts[host] += 1
        ids = [d for _, d, _ in same if d is not None]
        for line in {lower(x) for x in (same[0][2] or "").split("\n")} - {""}:
            holders[host, line].append(min(ids) if ids else None)
    out = []
    for doc, text, host in rows:
        n, *rest = base(text)
        gone = 0
        for line in (text or "").split("\n"):
            docs = holders.get((host, lower(line)), [])
            if len(docs) >= min_docs and len(docs) >= hosts[host] * min_share:
                known = [d for d in docs if d is not None]
                if doc != (min(known) if known else None):
                    gone += len(WORD.findall(line))
        failed = n < 20 or 100 * rest[-1] > 30 * n
        out.append((doc, n, *rest, failed, not failed and n - gone >= n * min_left))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"lines": F.lit(1), "kept": F.lit("x")})
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return sorted((tuple(r) for r in qr.quality_rules(docs, **options).select(names).collect()), key=repr)


def rows():
    own = lambda i: "\n".join(" ".join(f"w{i}x{j}y{k}" for k in range(6)) for j in range(5))
    out = [(i, "Shared LINE of  all\n" * (i % 3) + own(i), ["h", None][i % 2]) for i in range(40)]
    out += [(100 + i, f"shared line OF all\nmore shared words that many have here and that go on for long enough to count as a text of some words\ntiny {i} line", "h") for i in range(12)]
    out += [(200 + i, out[3][1], "h") for i in range(5)] + [(300, None, "h"), (301, "", None), (302, " \n\t\n", "h"), (303, "é#* <b>|% $&\n" * 4, "h")]
    out += [(304, "a b c d e f g h " * 9, "h"), (305, "one two\none two \none two", "h"), (None, own(1), "h"), (None, None, None), (306, "w " * 30000, "h")]
    return out + [out[0], out[0]]


@pytest.mark.parametrize("min_docs,min_share", [(3, 0.0), (5, 0.3)])
def test_against_plain_python(spark, min_docs, min_share):
    got = run(spark, rows(), min_docs=min_docs, min_share=min_share, min_left=0.5)
    assert got == brute(rows(), min_docs, min_share, 0.5)
    assert any(not r[-1] and not r[-2] for r in got)


@pytest.mark.parametrize("others", [100, 12_000])
def test_one_limit_for_every_host_size(spark, others):
    """The same boilerplate line in 20 documents is common in a small and in a large host."""
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(25))
    line = "all rights reserved by the owners of this very site"
    docs = [(i, f"{line}\n{own(i)}", "h") for i in range(20)] + [(100 + i, own(100 + i), "h") for i in range(others)]
    out = qr.quality_rules(spark.createDataFrame(docs, "doc_id long, text string, source string"))
    removed = {r.doc_id: r.removed_words for r in out.filter("doc_id < 100").collect()}
    assert removed == {i: 10 if i else 0 for i in range(20)}


def test_empty_table(spark):
    assert run(spark, []) == []


def test_real_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "source")
    real = [tuple(r) for r in docs.collect()]
    assert run(spark, real) == brute(real, qr.MIN_DOCS, qr.MIN_SHARE, qr.MIN_LEFT)
