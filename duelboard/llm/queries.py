"""Registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from duelboard.llm.tables import in_fold, table

#: Rules of the URL filter: fixed values.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

#: Key of the registered queries; a real corpus uses a secret of its own.
SURROGATE_KEY = "registered queries"


def vocabulary_path() -> str:
    """Place of the installed public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_pq_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    from duelboard.llm.pq_dedup import vector_links

    return vector_links(table(spark, sf_dir, "embeddings"))


def op2_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from duelboard.llm.pu_toxicity import score_documents

    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from duelboard.llm.rendezvous import assign_shards

    return assign_shards(table(spark, sf_dir, "documents"))


def op4_edit_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from duelboard.llm.edit_decontam import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from duelboard.llm.bagminhash import near_duplicate_classes

    return near_duplicate_classes(table(spark, sf_dir, "documents"))


def op6_digest_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from duelboard.llm.digest_filter import judge_urls, write_rules

    rules = write_rules(spark.createDataFrame(URL_RULES, "host string, path string, verdict string"))
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


def op7_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from duelboard.llm.chunk_bpe import encoding_digests

    docs = table(spark, sf_dir, "documents").select("doc_id", encoding_digests(F.col("text"), vocabulary_path()).alias("d"))
    return docs.select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256")


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from duelboard.llm.surrogates import replace_entities

    return replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY, count="n_entities")


def op9_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from duelboard.llm.ppm import score_texts

    return score_texts(table(spark, sf_dir, "documents"))


def op10_license_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from duelboard.llm.license_scan import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op11_sync_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from duelboard.llm.sync_runs import run_digests

    return run_digests(table(spark, sf_dir, "documents"))


def op12_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from duelboard.llm.threshold_negatives import hard_negatives

    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, label)


def op13_mph_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four fifths of the rows, told by their id, are the history."""
    from pyspark.sql import functions as F

    from duelboard.llm.mph_dedup import exact_duplicates

    return exact_duplicates(table(spark, sf_dir, "documents"), ~in_fold(F.col("doc_id"), 0))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pq_links,
        op2_pu_toxicity,
        op3_rendezvous_shards,
        op4_edit_decontamination,
        op5_bagminhash,
        op6_digest_url_filter,
        op7_chunked_bpe,
        op8_surrogates,
        op9_ppm_scores,
        op10_license_windows,
        op11_sync_runs,
        op12_threshold_negatives,
        op13_mph_exact_dedup,
    )
}

ORACLES: dict[str, str] = {
    # float components as doubles; equal vectors are linked whatever their rounded cosine
    "op1_pq_links": r"""
with recursive good as (
  select vec_id, list_transform(embedding, lambda x: x::double) as v
  from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id as a, b.vec_id as b
  from good a join good b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.95
), reach(a, b) as (
  select a, b from links union select r.a, l.b from reach r join links l on l.a = r.b
)
select e.vec_id, coalesce(n.n, 0)::bigint as n_links, least(e.vec_id, coalesce(c.low, e.vec_id)) as component_id,
  e.vec_id = least(e.vec_id, coalesce(c.low, e.vec_id)) as kept
from embeddings e
left join (select a, count(*) as n from links group by a) n on n.a = e.vec_id
left join (select a, min(b) as low from reach group by a) c on c.a = e.vec_id
""",
    "op6_digest_url_filter": r"""
with parts as (
  select page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages
), rules(h, p, verdict) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits as (
  select page_id, arg_max(h || p, length(h || p)) as rule, arg_max(verdict, length(h || p)) as verdict
  from parts join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
  group by page_id
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
from parts left join fits using (page_id)
""",
    # whole numbers as doubles: exact for these components
    "op12_threshold_negatives": r"""
with good as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score
  from good a join good b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where a.vec_id % 100 = 0
), positives as (
  select anchor_id, other_id as positive_id, score as positive_score
  from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
)
select p.anchor_id, p.positive_id, p.positive_score, n.other_id as negative_id, n.score as negative_score,
  row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.other_id)::int as rank
from positives p join scored n on n.anchor_id = p.anchor_id and not n.same
where 80 * p.positive_score <= 100 * n.score and n.score <= p.positive_score
qualify row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.other_id) <= 5
""",
    "op13_mph_exact_dedup": r"""
with d as (
  select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256 from documents
)
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size, doc_id = max(doc_id) over same as kept, text_sha256
from d window same as (partition by text_sha256)
""",
}
