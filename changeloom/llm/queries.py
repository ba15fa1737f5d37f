"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neardup import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"), 75)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license import scanned

    return scanned(_table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import encoded_documents

    return encoded_documents(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality

    return quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import packed_documents

    return packed_documents(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), 2048)


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import top_k

    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .rangejoin import near_vectors

    return near_vectors(_table(spark, sf_dir, "embeddings"), 0.9)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity

    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archived

    back = archived(_table(spark, sf_dir, "pages"), payload="response", verify=True).filter(F.col("warc_type").isin("response", "revisit"))  # pushed down to the headers
    revisited = F.col("warc_type") == "revisit"
    return back.select("page_id", "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), F.when(revisited, F.regexp_extract("refers_to", r"page:(-?\d+)$", 1).cast("long")).alias("refers_to"))


def op10_token_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .slots import slot_digests

    return slot_digests(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_minhash_near_dedup, op2_license_scan, op3_byte_bpe, op4_quality_classifier, op5_best_fit_packing, op6_exact_top_k, op7_embedding_near_dedup, op8_toxicity, op9_warc, op10_token_slots)}


def oracle_sql() -> dict[str, str]:
    from .license import oracle

    return {"op1_minhash_near_dedup": OP1_SQL, "op2_license_scan": oracle(), "op9_warc": OP9_SQL, "op6_exact_top_k": OP6_SQL, "op7_embedding_near_dedup": OP7_SQL}


_FINITE = "len(embedding) > 0 and list_count(embedding) = len(embedding) and len(list_filter(embedding, lambda x: not isfinite(x))) = 0"

OP6_SQL = f"""
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as w
           from embeddings where embedding is not null and vec_id is not null and {_FINITE}),
s as (select q.vec_id as query_id, c.vec_id as vec_id,
             cast(list_sum(list_transform(list_zip(q.w, c.w), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))) as bigint) as score
      from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id),
r as (select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""

OP7_SQL = f"""
with recursive v as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
           where embedding is not null and {_FINITE} and len(list_filter(embedding, lambda x: x <> 0)) > 0),
n as (select vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) as u from v),
links as (select a.vec_id as a, b.vec_id as b from n a join n b on a.vec_id <> b.vec_id and len(a.u) = len(b.u)
          where list_dot_product(a.u, b.u) >= 0.9),
reach as (select vec_id as id, vec_id as root from embeddings
          union select l.b, r.root from reach r join links l on l.a = r.id),
c as (select id, min(root) as component_id from reach group by id),
d as (select a, count(*) as n from links group by a)
select e.vec_id, cast(coalesce(d.n, 0) as bigint) as n_links, c.component_id, e.vec_id = c.component_id as kept
from embeddings e join c on c.id = e.vec_id left join d on d.a = e.vec_id
"""

OP1_SQL = """
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
  from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
                      else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) end as s
  from words),
each as (select doc_id, len(s) as n, unnest(s) as shingle from sets),
met as (select a.doc_id as a, b.doc_id as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as common
        from each a join each b on a.shingle = b.shingle and a.doc_id <> b.doc_id
        where 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n) group by a.doc_id, b.doc_id),
links as (select a, b from met where 100 * common >= 75 * (na + nb - common)),
reach as (select doc_id as id, doc_id as root from documents
          union select l.b, r.root from reach r join links l on l.a = r.id),
c as (select id, min(root) as component_id from reach group by id)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, c.component_id, s.doc_id = c.component_id as kept
from sets s join c on c.id = s.doc_id
"""


def _base32(hexadecimal: str) -> str:
    """SQL: the base-32 digits of 40 hexadecimal ones; five of these are 20 bits, so four of those."""
    group = lambda g: f"cast('0x' || substr({hexadecimal}, {5 * g + 1}, 5) as bigint)"
    return " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(({group(g)} >> {15 - 5 * k}) & 31 as integer) + 1, 1)" for g in range(8) for k in range(4))


OP9_SQL = f"""
with p as (select page_id, coalesce(html, '') as payload from pages),
f as (select *, sha1(payload) as hex, min(page_id) over (partition by payload) as first from p)
select page_id, cast(strlen(payload) as bigint) as payload_bytes, {_base32("hex")} as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to
from f
"""
