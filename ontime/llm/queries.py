"""One registered query per operator, over whole tables with production parameters, and the SQL equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ontime.llm.common import fresh_folder, table
from ontime.llm.exact_dedup import exact_groups
from ontime.llm.minhash import near_duplicates
from ontime.llm.mixing import entropy_mix
from ontime.llm.quality_classifier import quality
from ontime.llm.quality_rules import quality_rules
from ontime.llm.secret_scan import secret_spans
from ontime.llm.segmentation import sample_segmentations
from ontime.llm.token_counts import token_counts
from ontime.llm.toxicity import toxicity
from ontime.llm.url_filter import RULES, judged_urls
from ontime.llm.vector_codes import ENTRIES, PARTS, ROUNDS, vector_codes
from ontime.llm.warc import archived_pages
from ontime.llm.whitening import whitened


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, similarity=85)


def op4_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"))


def op5_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir, "documents"), fresh_folder(spark, "ledger"))


def op6_quality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality_rules(table(spark, sf_dir, "documents"), trusted)


def op7_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_segmentations(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).drop("row_id")


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entropy_mix(table(spark, sf_dir, "documents")).drop("copies", "text_key")


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "rule string, verdict string")
    return judged_urls(table(spark, sf_dir, "pages"), rules)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_quality_classifier, op3_near_duplicates, op4_warc_archive, op5_secret_ledger,
        op6_quality_ratio, op7_segmentations, op8_toxicity, op9_exact_dedup, op10_source_mixing,
        op11_url_filter, op12_whitening, op13_vector_codes,
    )
}


def _url_sql() -> str:
    """Rules from the longest to the shortest, as one case expression for the rule and one for the verdict."""
    fits = []
    for rule, verdict in sorted(RULES, key=lambda r: -len(r[0])):
        host, slash, path = rule.partition("/")
        where = f"(host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{slash + path}')"
        fits.append((where, rule, verdict))
    named = " ".join(f"when {where} then '{rule}'" for where, rule, _ in fits)
    judged = " ".join(f"when {where} then '{verdict}'" for where, _, verdict in fits)
    return rf"""
with rest_v as (
 select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
parts_v as (
 select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from rest_v)
select page_id, host, path, case {named} end as rule, case {judged} else 'allow' end as verdict from parts_v"""


def _codes_sql() -> str:
    """Every round as a table of assigned parts and one of entries; distances by a join of each part with its codebook."""
    def assigned(k: int) -> str:
        return f"""a{k} as materialized (
 select vec_id, label, part, v, d // {ENTRIES} as error, d % {ENTRIES} as entry from (
  select p.*, (select min({ENTRIES} * list_sum(list_transform(range(1, len(p.v) + 1),
    lambda i: (p.v[i] - b.v[i]) * (p.v[i] - b.v[i]))) + b.entry) from b{k} b where b.part = p.part) as d from parts p))"""

    def entries(k: int) -> str:
        return f"""m{k} as materialized (
 select part, entry, list(m order by i) as v from (
  select part, entry, i, floor(sum(v[i]) / count(*))::bigint as m from a{k}, range(1, {64 // PARTS} + 1) r(i)
  group by part, entry, i) group by part, entry),
b{k + 1} as materialized (
 select part, entry, coalesce(m{k}.v, b{k}.v) as v from b{k} left join m{k} using (part, entry))"""

    rounds = ",".join(assigned(k) + ("," + entries(k) if k < ROUNDS else "") for k in range(ROUNDS + 1))
    return f"""
with kept as materialized (
 select vec_id, label, list_transform(embedding, lambda c: floor(4096 * c::double)::bigint) as x from embeddings
 where embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
parts as materialized (
 select vec_id, label, p::bigint as part, x[p * (len(x) // {PARTS}) + 1 : (p + 1) * (len(x) // {PARTS})] as v
 from kept, range({PARTS}) r(p)),
b0 as materialized (
 select part, row_number() over (partition by part order by vec_id) - 1 as entry, v from parts
 where vec_id in (select vec_id from kept order by vec_id limit {ENTRIES})),
{rounds},
rows_v as (
 select vec_id, label, string_agg(printf('%02x', entry), '' order by part) as code, sum(error)::bigint as error
 from a{ROUNDS} group by vec_id, label)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
 (select sha256(string_agg(array_to_string(v, ','), ',' order by part, entry)) from b{ROUNDS}) as codebooks_sha256
from rows_v"""


ORACLES = {
    "op11_url_filter": _url_sql(),
    "op13_vector_codes": _codes_sql(),
    "op4_warc_archive": """
select page_id, payload_bytes, payload_digest, case when refers_to is null then 'response' else 'revisit' end as record_type,
 refers_to
from (select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 1000 then nullif(max(page_id) over (partition by payload_digest), page_id) end as refers_to
 from (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest
  from pages))""",
    "op9_exact_dedup": r"""
select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = min(doc_id) over w as kept,
 sha256(t) as text_sha256
from (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
window w as (partition by t)""",
}
