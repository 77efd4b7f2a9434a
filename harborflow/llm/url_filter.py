"""URL filter by host and path rules.

A rule (host, path, verdict) fits a URL if the URL's host is the rule's host or ends in "." and the rule's host, and the
URL's path starts with the rule's path. The rule with the longest host and path together decides; of two as long, the one
with the longer host, then the greater verdict by code point (block before allow). URLs without a fitting rule get the
default verdict.

Every rule is known by one expression: its last host labels and its first path segments, that is its path up to the last
slash. Every URL is expanded into the expressions of the shapes (labels, segments) that any rule has, so a URL makes as many
rows as there are shapes. Expressions and rules meet by an equi-join on a short prefix of their SHA-256 digests; then the full
digests, the host and the whole path are compared. Rules deeper than MAX_LABELS labels or MAX_SEGMENTS segments are known by
their first MAX_SEGMENTS segments and last MAX_LABELS labels, which the comparison of host and path makes exact again.

Scale: a verdict belongs to a distinct URL, so equal URLs are merged before they are expanded. Rules of proven small size are
broadcast; others meet the expressions by shuffle, where expressions of at least one thousandth of all rows (so at most 1,000,
like "com/") are dealt to SALTS partitions. The same holds for the way back from distinct URLs to rows.

Edge cases: the host is what follows the first "://" up to "/", "?", "#" or the end, with A-Z lower-cased; the path goes on up
to "?", "#" or the end. A null URL, or one without "://", has an empty host and path, which a rule with an empty host and path
fits. Rules with a null host, path or verdict are ignored, equal rules merged. An empty rule table gives every row the default;
an empty table gives an empty result. Repeated rows stay as they are. Columns host, path, rule and verdict are replaced;
all other columns, whatever their names, stay.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborflow.llm.names import free_names
from harborflow.llm.stages import Stages

MAX_LABELS = 32
MAX_SEGMENTS = 64
# Rules up to this many rows and characters are broadcast.
BROADCAST_RULES = 200_000
BROADCAST_CHARS = 16 << 20
PREFIX = 8
# A key with at least one row in so many is dealt to SALTS partitions; there are at most so many such keys.
HOT_ONE_IN = 1_000
SALTS = 64

# Production rules.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
DEFAULT = "allow"


def production_rules(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in RULES]
    return spark.range(1).select(F.inline(F.array(*rows)))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.call_function("substring", url, at + 3))
    host = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _times(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _expression(host: Column, path: Column, labels: Column, segments: Column) -> Column:
    """The last labels of the host and the path up to the slash that ends so many segments."""
    start = F.when(segments > 0, F.concat(F.call_function("substring_index", path, F.lit("/"), segments), F.lit("/")))
    return F.concat(F.call_function("substring_index", host, F.lit("."), -labels), F.coalesce(start, F.lit("")))


def _labels(host: Column) -> Column:
    return (_times(host, ".") + 1).cast("int")


def _segments(path: Column) -> Column:
    return _times(path, "/").cast("int")


def prepared_rules(rules: DataFrame) -> DataFrame:
    """(rule_host, rule_path, rule_verdict, labels, segments, digest), one row a rule."""
    known = rules.select(lower_ascii(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))
    merged = known.dropna().groupBy("rule_host", "rule_path").agg(F.max("rule_verdict").alias("rule_verdict"))
    shaped = merged.withColumns({
        "labels": F.least(_labels(F.col("rule_host")), F.lit(MAX_LABELS)),
        "segments": F.least(_segments(F.col("rule_path")), F.lit(MAX_SEGMENTS)),
    })
    text = _expression(F.col("rule_host"), F.col("rule_path"), F.col("labels"), F.col("segments"))
    return shaped.withColumn("digest", F.sha2(text, 256))


def expand(urls: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """(url_key, host, path) -> one row an expression, with its digest."""
    known = F.array(*[F.struct(F.lit(a).alias("labels"), F.lit(b).alias("segments")) for a, b in shapes])
    deep = urls.withColumns({"_labels": _labels(F.col("host")), "_segments": _segments(F.col("path"))})
    usable = F.filter(known, lambda s: (s["labels"] <= F.col("_labels")) & (s["segments"] <= F.col("_segments")))
    digests = F.transform(usable, lambda s: F.sha2(_expression(F.col("host"), F.col("path"), s["labels"], s["segments"]), 256))
    return deep.select("url_key", "host", "path", F.explode(digests).alias("url_digest"))


def hot_keys(counted: DataFrame, key: str, n: str) -> DataFrame:
    """Keys with at least one row in HOT_ONE_IN; at most that many."""
    total = counted.agg(F.sum(n)).first()[0] or 0
    return counted.groupBy(key).agg(F.sum(n).alias("_n")).filter(F.col("_n") * HOT_ONE_IN >= F.lit(total)).select(F.col(key).alias("_hot"))


def spread_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, hot: DataFrame, spread: Column, how: str, also: Column | None = None) -> DataFrame:
    """Equi-join in which the rows of hot keys of the left side go to SALTS partitions, and the right side's to all of them."""
    is_hot, salt, other = free_names([*left.columns, *right.columns], "_is_hot", "_salt", "_other")
    marked = F.broadcast(hot.select(F.col("_hot").alias(is_hot)))
    a = left.join(marked, F.col(left_key) == F.col(is_hot), "left")
    a = a.withColumn(salt, F.when(F.col(is_hot).isNotNull(), F.pmod(spread, F.lit(SALTS))).otherwise(F.lit(0)).cast("int")).drop(is_hot)
    b = right.join(marked, F.col(right_key) == F.col(is_hot), "left")
    every = F.when(F.col(is_hot).isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    b = b.withColumn(other, F.explode(every)).drop(is_hot)
    met = (F.col(left_key) == F.col(right_key)) & (F.col(salt) == F.col(other))
    return a.join(b, met if also is None else met & also, how).drop(salt, other)


def verdicts(urls: DataFrame, rules: DataFrame, broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """(url_key, host, path) -> (rule_of, rule, verdict) of the distinct URLs that a rule fits; `rules` as prepared."""
    shapes = sorted(tuple(r) for r in rules.select("labels", "segments").distinct().collect())
    expressions = expand(urls, shapes).withColumn("url_prefix", F.substring("url_digest", 1, PREFIX))
    known = rules.withColumn("rule_prefix", F.substring("digest", 1, PREFIX))
    rows, chars = rules.agg(F.count(F.lit(1)), F.sum(F.length("rule_host") + F.length("rule_path"))).first()
    host, path = F.col("rule_host"), F.col("rule_path")
    fits = (
        (F.col("url_digest") == F.col("digest")) & F.col("path").startswith(path)
        & ((F.col("host") == host) | F.col("host").endswith(F.concat(F.lit("."), host)))
    )
    if rows <= broadcast_rules and (chars or 0) <= BROADCAST_CHARS:
        met = expressions.join(F.broadcast(known), (F.col("url_prefix") == F.col("rule_prefix")) & fits)
    else:
        counted = expressions.groupBy("url_prefix").agg(F.count(F.lit(1)).alias("n"))
        met = spread_join(expressions, known, "url_prefix", "rule_prefix", hot_keys(counted, "url_prefix", "n"), F.xxhash64("url_key"), "inner", fits)
    order = F.struct(F.length(F.concat(host, path)).alias("n"), F.length(host).alias("h"), F.col("rule_verdict").alias("verdict"), F.concat(host, path).alias("rule"))
    # At most one rule a shape and depth beyond it: a short list, kept by a hash aggregate.
    best = met.groupBy("url_key").agg(F.array_max(F.collect_set(order)).alias("_best"))
    return best.select(F.col("url_key").alias("rule_of"), F.col("_best.rule").alias("rule"), F.col("_best.verdict").alias("verdict"))


def url_filter(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """All rows of `pages` (column url) with host, path, the deciding rule (null: none) and the verdict."""
    steps = Stages(pages.sparkSession, "url-filter")
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    key, rule_of = free_names([*kept, "host", "path", "rule", "verdict"], "url_key", "rule_of")
    host, path = host_and_path(F.col("url"))
    rows = pages.select(*[F.col(f"`{c}`") for c in kept], host.alias("host"), path.alias("path"))
    rows = rows.withColumn(key, F.sha2(F.concat("host", "path"), 256))
    known = steps.put(prepared_rules(rules), "rules")
    if known.isEmpty():
        return rows.drop(key).withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    one = pages.select(host.alias("host"), path.alias("path")).groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    urls = steps.put(one.withColumn("url_key", F.sha2(F.concat("host", "path"), 256)), "urls")
    found = steps.put(verdicts(urls, known, broadcast_rules), "verdicts").withColumnRenamed("rule_of", rule_of)
    # Equal rows of one URL are told apart by the input partition that they come from.
    back = spread_join(rows, found, key, rule_of, hot_keys(urls, "url_key", "n"), F.xxhash64(F.spark_partition_id(), *[c for c in kept if c == "page_id"]), "left")
    return back.withColumn("verdict", F.coalesce("verdict", F.lit(default))).select(*[F.col(f"`{c}`") for c in kept], "host", "path", "rule", "verdict")
