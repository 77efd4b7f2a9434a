"""Secret scan with a random forest that removes false positives, in DataFrame functions only.

A candidate is a run of at least 16 characters of the kind keys are made of, with a digit, or any value of at least 4 characters
that is assigned (`=` or `:`) to a name with a key word. Its text, the words before and after it on the line and its surroundings as a path give the features: length, character classes and the transitions between
them, coverage by dictionary words, key words and disclaimers near it, quotes, assignment, path and address signs.

The forest learns from labelled findings. Those given (`labelled`: candidate, before, after, label) are used as they are;
without any, findings are labelled by high-precision rules: published key formats and assignments of letters with
digits to key words are 1; of the others, plain numbers, dates, UUIDs, repeated characters, dictionary text and disclaimed examples
are 0; the rest is not labelled. A disclaimer is a whole word at most `NEAR` characters from the candidate; mail addresses,
URLs and host names hold none. At most about `train_findings` of them, drawn by hash, are learned from. Trees become nested column expressions.

Edge cases: null or empty text has no candidates; null doc_ids are scanned like others; repeated rows give their
findings each; without labelled findings of both kinds the score is their share (0.5 without any); an empty table gives an empty
result; other columns are ignored. Whole texts are scanned, however long.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harborflow.llm.stages import Stages

KEY_RUN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}={0,2}"
CONTEXT = 60
TRAIN_FINDINGS = 20_000
TREES, DEPTH, SEED = 15, 4, 29
THRESHOLD = 0.5

# Published key formats, words that go with secrets or deny them, and common parts of words.
FORMATS = r"^(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|glpat-[A-Za-z0-9_-]{20}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|sk_live_[A-Za-z0-9]{24,})$"
SECRET_WORDS = r"(?i)(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|private[_-]?key|bearer)"
ASSIGNED_WORDS = r"(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth(?!or(?!iz))|credential|private[_-]?key|bearer)"
# A value after a name with a key word; looked at from behind in three steps, the cheap ones first.
ASSIGNED = (
    r"(?<=[=: \t\"'])(?<=[=:][ \t]{0,3}[\"']?)(?<=" + ASSIGNED_WORDS + r"[A-Za-z0-9_-]{0,20}[\"']?[ \t]{0,3}[=:]{1,2}[ \t]{0,3}[\"']?)"
    r"(?![=:])[^\s\"'`<>,;&|(){}\[\]]{4,}(?<![.:])"
)
FOUND = f"(?:{ASSIGNED}|{KEY_RUN})"
NEAR = 24
DENIALS = r"(?i)(?<![A-Za-z0-9])(?:example|sample|dummy|placeholder|changeme|your(?=[_-])|x{4,}|sha\d*|md5|digest|checksum|commit|uuid|isbn|version)(?![A-Za-z0-9])"
NAMES = r"(?i)https?://\S*|\S*@\S*|(?<![A-Za-z0-9.-])(?:[a-z0-9-]+\.)+(?:[a-z0-9-]+\.[a-z]{2,}|com|org|net|edu|gov|io|dev)(?![A-Za-z0-9-])"
DICTIONARY = (
    "about after also and are able been before but can come config data day default details end error file first for from get good have "
    "home ing into its key know like line list log make man may ment more name new not now number one only other out over page path "
    "people read see service some state such test than that the then there these this time tion two type use user value very was way "
    "well were what when which who will with work world would year"
).split()

FEATURES = (
    "length", "digits", "uppers", "lowers", "signs", "letter_digit", "case_changes", "vowel_changes", "repeats", "hex", "dictionary",
    "word_before", "word_after", "denied", "assigned", "quoted", "path", "address", "first_in_line", "format",
)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, start, candidate, before, after. The pieces between candidates come from a split by the same pattern."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).filter(F.col("text").rlike(FOUND))
    rows = rows.select(
        "doc_id", F.monotonically_increasing_id().alias("_row"), F.regexp_extract_all("text", F.lit(FOUND), F.lit(0)).alias("found"),
        F.split("text", FOUND, -1).alias("pieces"),
    )
    sides = F.transform("pieces", lambda p: F.struct(F.length(p).alias("size"), F.right(p, F.lit(CONTEXT)).alias("end"), F.left(p, F.lit(CONTEXT)).alias("begin")))
    rows = rows.select("doc_id", "_row", "found", sides.alias("sides"))
    after = F.slice("sides", F.lit(2), F.size("found"))
    zipped = F.arrays_zip(F.col("found"), F.slice("sides", F.lit(1), F.size("found")).alias("left"), after.alias("right"))
    each = rows.select("doc_id", "_row", F.posexplode(zipped).alias("no", "z"))
    each = each.select(
        "doc_id", "_row", "no", F.col("z.found").alias("candidate"), F.col("z.left.size").alias("_gap"),
        F.substring_index("z.left.end", "\n", -1).alias("before"), F.substring_index("z.right.begin", "\n", 1).alias("after"),
    )
    earlier = W.partitionBy("_row").orderBy("no").rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("_gap") + F.length("candidate")).over(earlier), F.lit(0)) + F.col("_gap")
    return each.withColumn("start", start.cast("long")).select("doc_id", "start", "candidate", "before", "after")


def features(findings: DataFrame) -> DataFrame:
    c, before, after = F.col("candidate"), F.col("before"), F.col("after")
    size = F.length(c).cast("double")

    def share(pattern: str) -> Column:
        return F.regexp_count(c, F.lit(pattern)) / size

    def flag(condition: Column) -> Column:
        return condition.cast("double")

    def denied() -> Column:
        """Whether a whole word of DENIALS stands in or near the candidate, names of hosts and mailboxes aside."""
        left, right = F.regexp_replace(before, NAMES, " "), F.regexp_replace(after, NAMES, " ")
        return left.rlike(DENIALS + f".{{0,{NEAR}}}$") | c.rlike(DENIALS) | right.rlike(f"^.{{0,{NEAR}}}?{DENIALS}")

    rest = F.regexp_replace(F.lower(c), "|".join(sorted(DICTIONARY, key=len, reverse=True)), "")
    values = {
        "length": size, "digits": share("[0-9]"), "uppers": share("[A-Z]"), "lowers": share("[a-z]"), "signs": share("[+/_=-]"),
        "letter_digit": share("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])"), "case_changes": share("[a-z](?=[A-Z])|[A-Z](?=[a-z])"),
        "vowel_changes": share("(?i)[aeiou](?=[b-df-hj-np-tv-z])|[b-df-hj-np-tv-z](?=[aeiou])"), "repeats": share(r"(.)(?=\1)"),
        "hex": flag(c.rlike("^[0-9a-f]+$")), "dictionary": 1 - F.length(rest) / size,
        "word_before": flag(before.rlike(SECRET_WORDS)), "word_after": flag(after.rlike(SECRET_WORDS)),
        "denied": flag(denied()), "assigned": flag(before.rlike(r"[=:]\s*[\"']?$")),
        "quoted": flag(before.rlike(r"[\"']$")), "path": flag(before.rlike(r"[/\\.]$") | c.contains("/")), "address": flag(before.rlike(r"(?:https?:|www\.)\S*$")),
        "first_in_line": flag(F.trim(before) == ""), "format": flag(c.rlike(FORMATS)),
    }
    return findings.withColumns({f"f_{k}": values[k] for k in FEATURES})


def labelled_by_rules(findings: DataFrame) -> DataFrame:
    """Findings with a `label` where a high-precision rule has one."""
    c = F.col("candidate")
    keyed = (F.col("f_word_before") == 1) & (F.col("f_assigned") == 1) & (F.col("f_letter_digit") > 0)
    plain = c.rlike("^[0-9_/+-]+$") | c.rlike("(?i)^[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}$") | (F.col("f_repeats") > 0.4)
    label = F.when((F.col("f_format") == 1) | keyed, 1.0).when((F.col("f_denied") == 1) | plain | (F.col("f_dictionary") > 0.6) | (F.col("f_address") == 1), 0.0)
    return findings.withColumn("label", label).filter(F.col("label").isNotNull())


def tree_column(node) -> Column:
    """A tree as nested conditions; leaves give the share of label 1."""
    if node.subtreeDepth() == 0:
        stats = list(node.impurityStats().stats())
        return F.lit(float(stats[1] / sum(stats)))
    split = node.split()
    name = f"f_{FEATURES[split.featureIndex()]}"
    return F.when(F.col(name) <= F.lit(float(split.threshold())), tree_column(node.leftChild())).otherwise(tree_column(node.rightChild()))


def fit_forest(labelled: DataFrame) -> Column:
    """Score expression from features and labels of a bounded set of findings."""
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    ones, zeros = counts.get(1.0, 0), counts.get(0.0, 0)
    if not ones or not zeros:
        return F.lit((ones + 0.5) / (ones + zeros + 1))
    rows = VectorAssembler(inputCols=[f"f_{x}" for x in FEATURES], outputCol="features").transform(labelled)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird").fit(rows)
    votes = [tree_column(tree._call_java("rootNode")) for tree in forest.trees]
    return reduce(Column.__add__, votes) / len(votes)


def secret_scan(docs: DataFrame, labelled: DataFrame | None = None, train_findings: int = TRAIN_FINDINGS) -> DataFrame:
    """One row a candidate: doc_id, start, candidate, before, after, score, secret. `start` counts characters from 0."""
    steps = Stages(docs.sparkSession, "secret-scan")
    found = steps.put(features(candidates(docs)), "findings")
    known = labelled_by_rules(found) if labelled is None else features(labelled.select("candidate", "before", "after", F.col("label").cast("double")))
    # The same findings whatever the order of rows.
    known = known.select("candidate", "before", "after", "label", *[f"f_{x}" for x in FEATURES]).distinct()
    known = known.orderBy(F.xxhash64("candidate", "before", "after"), "candidate", "before", "after").limit(train_findings)
    known = steps.put(known.coalesce(4), "labelled")
    score = fit_forest(known)
    scored = found.withColumn("score", score)
    return scored.select("doc_id", "start", "candidate", "before", "after", "score", (F.col("score") >= THRESHOLD).alias("secret"))
