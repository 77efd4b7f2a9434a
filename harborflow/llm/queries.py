"""One registered query an operator, over whole tables, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborflow.llm import exact_dedup, jaccard_join, language_id, lexical_search, line_dedup, mixing, packing, quality_classifier, quality_rules, secret_scan, substring_dedup, url_filter, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


@query
def op5_exact_dedup(spark, sf):
    found = exact_dedup.exact_dedup(spark, f"{sf}/documents.parquet")
    return found.withColumnRenamed("digest", "text_sha256")


ORACLE["op5_exact_dedup"] = r"""
with t as (
  select doc_id, length(coalesce(text, '')) as points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm from documents
), g as (
  select doc_id, first_value(doc_id) over (partition by norm order by points desc, doc_id) as keep_id,
    count(*) over (partition by norm) as group_size, sha256(norm) as text_sha256 from t
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from g
"""


@query
def op6_mix_sources(spark, sf):
    return mixing.mix_sources(documents(spark, sf).select("doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


ORACLE["op6_mix_sources"] = r"""
with t as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
    md5('mix-1:' || coalesce(cast(doc_id as varchar), '')) as key from documents
), s as (
  select source, cast(sum(size) as bigint) as source_size from t group by source
), r as (
  select *, row_number() over (order by source nulls last) as rank from s
), w as (
  select *, source_size * 2 as cap, [5, 2, 1][cast((rank - 1) % 3 + 1 as bigint)] as weight from r
), o as (
  select *, cap / weight as ratio from w
), l as (
  select *, (cast(sum(source_size) over () as double) * 1.5 - coalesce(sum(cap) over (order by ratio, source nulls last
      rows between unbounded preceding and 1 preceding), 0)) / sum(weight) over (order by ratio, source nulls last
      rows between current row and unbounded following) as level from o
), f as (
  select *, cap <= level * weight as is_full from l
), e as (
  select source, source_size, case when is_full then cast(cap as double)
    else weight * (select first(level order by ratio, source nulls last) from f where not is_full) end as target from f
), p as (
  select t.doc_id, size, source_size, target, cast(floor(target) as bigint) as budget,
    coalesce(sum(size) over (partition by t.source order by key, t.doc_id, size rows between unbounded preceding and 1 preceding), 0) as before
  from t join e on t.source is not distinct from e.source
), q as (
  select *, case when source_size > 0 then budget // source_size else 0 end as epochs from p
)
select doc_id, size, source_size, target,
  cast(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) as bigint) as taken from q
"""


@query
def op9_quality_rules(spark, sf):
    return quality_rules.quality_rules(documents(spark, sf))


ORACLE["op9_quality_rules"] = r"""
with t as (
  select row_number() over () as row, doc_id, source, coalesce(text, '') as text from documents
), w as (
  select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words from t
), cut as (
  select row, doc_id, source, unnest(string_split(text, chr(10))) as line from w
), l as (
  select row, doc_id, source, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') as parts from cut
), line as (
  select row, doc_id, source, line, len(parts) as words,
    translate(array_to_string(parts, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm
  from l where len(parts) > 0
), dup as (
  select row, count(*) - count(distinct line) as n from line group by row
), win as (
  select row, i, array_to_string(words[i:i + 7], ' ') as run from (select row, words, unnest(range(1, len(words) - 6)) as i from w)
), twice as (
  select row, i from win qualify count(*) over (partition by row, run) > 1
), again as (
  select row, count(distinct i + j) as n from twice, (select unnest(range(8)) as j) group by row
), content as (
  select source, min(row) as row, min(doc_id) as doc_id from w group by source, array_to_string(words, ' ')
), held as (
  select distinct c.source, c.row, c.doc_id, norm from content c join line using (row)
), common as (
  select source, norm, min(doc_id) as first_doc from held group by source, norm having count(*) >= 20
), gone as (
  select l.row, cast(sum(words) as bigint) as n from line l join common c on l.norm = c.norm and l.source is not distinct from c.source
  where l.doc_id is distinct from c.first_doc group by l.row
), s as (
  select doc_id, source, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(dup.n, 0) as n_dup_lines,
    coalesce(again.n, 0) as n_repeat_words, coalesce(gone.n, 0) as removed_words
  from w left join dup using (row) left join again using (row) left join gone using (row)
), b as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from s
)
select *, not base_failed and n_words - removed_words >= n_words * 0.4e0 as kept from b
"""


@query
def op10_retrieval_packing(spark, sf):
    packed = packing.pack_documents(documents(spark, sf), payload=packing.crc)
    return packed.withColumn("ids_crc32", F.conv(F.hex("payload"), 16, 10).cast("long")).drop("payload")


@query
def op1_jaccard_join(spark, sf):
    return jaccard_join.jaccard_counts(documents(spark, sf), words=3, share=(9, 10))


@query
def op2_substring_dedup(spark, sf):
    found = substring_dedup.substring_dedup(documents(spark, sf))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op2_substring_dedup"] = r"""
with w as (
  select row_number() over () as row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), win as (
  select row, doc_id, i, array_to_string(words[i:i + 12], ' ') as run
  from (select row, doc_id, words, unnest(range(1, len(words) - 11)) as i from w where doc_id is not null)
), hit as (
  select row, i from win qualify min(doc_id) over (partition by run) < doc_id
), gone as (
  select distinct row, i + j as place from hit, (select unnest(range(13)) as j)
), each as (
  select row, unnest(words) as word, generate_subscripts(words, 1) as place from w
), left_over as (
  select row, string_agg(word, ' ' order by place) as kept, count(*) as n from each anti join gone using (row, place) group by row
)
select doc_id, len(words) as n_words, len(words) - coalesce(n, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from w left join left_over using (row)
"""


@query
def op3_language_id(spark, sf):
    return language_id.language_id(documents(spark, sf))


@query
def op8_quality_classifier(spark, sf):
    return quality_classifier.quality_classifier(documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))


@query
def op7_line_dedup(spark, sf):
    """Per document: lines with a word, how many stay, and the numbers of the last and of all that stay."""
    found = line_dedup.line_dedup(documents(spark, sf))
    return found.select("doc_id", "n_lines", F.size("kept_lines").alias("n_kept"), "kept_lines")


@query
def op4_secret_scan(spark, sf):
    """Findings without their text: place, length, digest, score and verdict."""
    found = secret_scan.secret_scan(documents(spark, sf))
    return found.select("doc_id", "start", F.length("candidate").alias("length"), F.sha2("candidate", 256).alias("candidate_sha256"), "score", "secret")


@query
def op12_url_filter(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    return url_filter.url_filter(pages, url_filter.production_rules(spark)).select("page_id", "host", "path", "rule", "verdict")


ORACLE["op12_url_filter"] = r"""
with cut as (
  select page_id, case when strpos(url, '://') > 0 then substring(url, strpos(url, '://') + 3) else '' end as rest from pages
), raw as (
  select page_id, regexp_extract(rest, '^[^/?#]*') as raw_host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut
), u as (
  select page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, path from raw
), d as (
  select distinct host, path from u
), rules(rule_host, rule_path, verdict) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), f as (
  select host, path, max(struct_pack(n := length(rule_host || rule_path), h := length(rule_host), v := verdict, r := rule_host || rule_path)) as best
  from d join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  group by host, path
)
select page_id, u.host, u.path, best.r as rule, coalesce(best.v, 'allow') as verdict
from u left join f on u.host = f.host and u.path = f.path
"""


@query
def op13_embedding_whitening(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    model = whitening.fit(vectors)
    rows = whitening.apply(vectors, model)
    n, shares = (model.n, (model.values / model.trace).tolist()) if model and len(model.values) else (0, [])
    explained = F.array(*[F.lit(float(v)) for v in shares]).cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened")).select(
        "vec_id", (F.col("_at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("_at")).alias("explained"), F.lit(whitening.identity_error(rows)).cast("double").alias("identity_error"),
    )


@query
def op11_ranked_search(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    return lexical_search.search(lexical_search.build_index(docs), docs, spark.read.parquet(f"{sf}/benchmark.parquet"))


ORACLE["op11_ranked_search"] = r"""
with d as (
  select row_number() over () as row, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents
), h as (
  select row, doc_id, len(terms) as n, terms from d where len(terms) > 0
), s as (
  select count(*) as docs, cast(sum(n) as bigint) as all_terms from h
), q as (
  select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark
), c as (
  select item_id, term, count(*) as repeats from q group by item_id, term
), o as (
  select row, doc_id, n, unnest(terms) as term from h
), t as (
  select row, doc_id, n, term, count(*) as tf from o where term in (select term from c) group by row, doc_id, n, term
), w as (
  select term, cast(floor(1000 * ln(cast(2 * max(docs) + 2 as double) / cast(2 * count(*) + 1 as double))) as bigint) as w from t, s group by term
), r as (
  select item_id, doc_id, row, cast(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // all_terms)))) as bigint) as score
  from c join t using (term) join w using (term), s group by item_id, doc_id, row
), k as (
  select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score from r where score > 0
)
select item_id, rank, doc_id, score from k where rank <= 10
"""
