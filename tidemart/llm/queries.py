"""One query per operator, each over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemart.llm.blob_ledger import secret_digests
from tidemart.llm.byte_bpe import round_trip_digests
from tidemart.llm.common import prepared, vocabulary
from tidemart.llm.html_text import main_text
from tidemart.llm.merkle_log import manifest_digests
from tidemart.llm.minhash import MinHash, near_duplicates
from tidemart.llm.oracles import MANIFEST, REPAIR, SECRETS
from tidemart.llm.packing import cut_documents, pack
from tidemart.llm.quality import judge_quality
from tidemart.llm.suffix_dedup import repeat_digests
from tidemart.llm.token_files import write_token_files
from tidemart.llm.topk import top_k
from tidemart.llm.toxicity import score_documents, train
from tidemart.llm.turn_repair import damaged, repair_conversations
from tidemart.llm.url_filter import Rule, judge_urls

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: SQL for the queries that it can express.
ORACLES: dict[str, str] = {}

WORD_VOCAB = "word_bpe_49k.json"
BYTE_VOCAB = "byte_bpe_multi_50k.tiktoken"


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(prepared(spark), sf_dir)

    QUERIES[build.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = vocabulary(public_tokenizers.path(WORD_VOCAB))
    return write_token_files(table(spark, sf_dir, "documents"), vocab).read(spark)


@query
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = vocabulary(public_tokenizers.path(BYTE_VOCAB))
    return round_trip_digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op3_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"))


@query
def op4_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = vocabulary(public_tokenizers.path(WORD_VOCAB))
    return pack(cut_documents(table(spark, sf_dir, "documents"), vocab))


@query
def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), MinHash(width=3, percent=85)).drop("text_hash")


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return score_documents(documents, train(documents, table(spark, sf_dir, "labels")))


@query
def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return top_k(embeddings, embeddings.filter("vec_id % 50 = 0"))


ORACLES["op8_topk_search"] = """
    with v as (
        select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
        from embeddings
        where vec_id is not null and embedding is not null
          and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), s as (
        select a.vec_id as query_id, b.vec_id, cast(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) as bigint) as score
        from v a join v b on a.vec_id <> b.vec_id and len(a.q) = len(b.q)
        where a.vec_id % 50 = 0
    )
    select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank,
           vec_id, score
    from s
    qualify rank <= 5
"""


#: The rules of the query op10_url_filter.
URL_RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


ORACLES["op10_url_filter"] = r"""
    with recursive p as (
        select page_id, coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
               coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') as path,
               case when url like '%://%' then regexp_extract(url, '^(?s:.*?)://[^/?#]*([^#]*)', 1) end as rest, url,
               regexp_extract(regexp_extract(html, '(?is)(<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>)', 1), '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) as canonical,
               regexp_extract(regexp_extract(html, '(?is)(<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>)', 1), '(?is)\burl\s*=\s*["'']?([^"''\s>;]+)', 1) as refresh
        from pages
    ), own as (
        select *, case when rest is not null then host || case when rest = '' then '/' else rest end end as node from p
    ), target as (
        select node as src, replace(unnest([canonical, refresh]), '&amp;', '&') as t, url, path from own where node is not null
    ), resolved as (
        select src, case when contains(t, '://') then t when starts_with(t, '//') then regexp_extract(url, '^((?s:.*?))://', 1) || ':' || t
                         when starts_with(t, '/') then regexp_extract(url, '^((?s:.*?)://[^/?#]*)', 1) || t
                         else regexp_extract(url, '^((?s:.*?)://[^/?#]*)', 1) || coalesce(nullif(regexp_extract(path, '^(.*/)', 1), ''), '/') || t end as u
        from target where t <> ''
    ), far as (
        select src, translate(regexp_extract(u, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
               regexp_extract(u, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path, regexp_extract(u, '^(?s:.*?)://[^/?#]*([^#]*)', 1) as rest from resolved
    ), edge as (
        select src as a, host || case when rest = '' then '/' else rest end as b from far
    ), both_ways as (
        select a, b from edge union select b, a from edge
    ), reach as (
        select a as node, a as other from both_ways union select r.node, e.b from reach r join both_ways e on e.a = r.other
    ), rules as (
        select * from (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) t(rule_host, rule_path, verdict)
    ), places as (
        select host, path, node from own union
        select host, path, host || case when rest = '' then '/' else rest end from far
    ), fits as (
        select host, path, node, rule_host || rule_path as rule, verdict,
               row_number() over (partition by host, path, node order by length(rule_host || rule_path) desc, verdict) as k
        from places join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
    ), best as (
        select * from fits where k = 1
    ), spread as (
        select r.node from reach r join best b on b.node = r.other group by r.node
        having count(*) filter (b.verdict = 'allow') = 0
    )
    select o.page_id, o.host, o.path, b.rule,
           coalesce(b.verdict, case when s.node is not null then 'block' else 'allow' end) as verdict
    from own o left join best b on b.host = o.host and b.path = o.path and b.node is not distinct from o.node
               left join spread s on s.node = o.node
"""


@query
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(table(spark, sf_dir, "documents"))


@query
def op11_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(table(spark, sf_dir, "documents"))


@query
def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(table(spark, sf_dir, "conversations")))


@query
def op13_merkle_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_digests(table(spark, sf_dir, "documents"))


ORACLES |= {"op11_blob_ledger": SECRETS, "op12_turn_repair": REPAIR, "op13_merkle_log": MANIFEST}
