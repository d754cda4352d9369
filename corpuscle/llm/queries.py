"""The queries of this subpackage: one per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpuscle.llm import bpe, exact_dedup, kn_lm, langid, line_dedup, mixing, pivot_search, sharding, simhash, url_templates
from corpuscle.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).select("doc_id", "source", "epoch")


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kn_lm.score(table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judged(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search: the queries are the vectors whose id is divisible by 100, against all."""
    vectors = table(spark, sf_dir, "embeddings")
    return pivot_search.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    found = [
        op1_simhash_near_dedup, op2_line_dedup, op3_mixing, op4_lm_scoring, op5_url_filter, op6_exact_top_k, op7_sharding, op8_language_id, op9_bpe, op10_exact_dedup
    ]
    return {f.__name__: f for f in found}


_MIXING = r"""
with d as (
  select doc_id, source, ('0x' || substr(md5('0|' || doc_id::varchar), 1, 15))::bigint as key, len(regexp_extract_all(text, '\S+')) as n from documents
), t as (
  select source, sum(n)::hugeint as st, floor(sqrt(sum(n)))::hugeint as w from d group by source
), b as (
  select source, st, (w * (select sum(st) from t)) // (select sum(w) from t) as budget from t
), c as (
  select source, st, budget, budget // st as epochs, budget % st as rest from b
), r as (
  select doc_id, source, sum(n) over (partition by source order by key, doc_id) as run from d
), k as (
  select r.doc_id, r.source, c.epochs + case when r.run <= c.rest then 1 else 0 end as copies from r join c using (source)
)
select doc_id, source, unnest(range(1, copies::bigint + 1)) as epoch from k
"""

_LINES = """
with d as (select doc_id, string_split(text, chr(10)) as lines from documents where text is not null),
w as (select doc_id, unnest(range(1, len(lines) - 1)) as pos, lines from d where len(lines) > 2),
x as (select doc_id, pos, lines[pos] || chr(10) || lines[pos + 1] || chr(10) || lines[pos + 2] as win from w
      where trim(lines[pos]) <> '' or trim(lines[pos + 1]) <> '' or trim(lines[pos + 2]) <> ''),
later as (select doc_id, pos from (select doc_id, pos, row_number() over (partition by win order by doc_id, pos) as rn from x) where rn > 1),
gone as (select distinct doc_id, unnest([pos, pos + 1, pos + 2]) as pos from later),
each as (select doc_id, unnest(lines) as line, unnest(range(1, len(lines) + 1)) as pos from d where doc_id in (select doc_id from gone)),
kept as (select e.doc_id, string_agg(e.line, chr(10) order by e.pos) filter (where g.pos is null) as text
         from each e left join gone g on e.doc_id = g.doc_id and e.pos = g.pos group by e.doc_id)
select d.doc_id, case when k.doc_id is null then d.text else coalesce(k.text, '') end as text from documents d left join kept k on d.doc_id = k.doc_id
"""

_TOP_K = """
with n as (select vec_id, embedding::double[] as v from embeddings),
u as (select vec_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) as v from n),
p as (select a.vec_id, b.vec_id as neighbor_id, round(list_dot_product(a.v, b.v), 6) as similarity from u a join u b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
r as (select *, row_number() over (partition by vec_id order by similarity desc, neighbor_id)::int as rank from p)
select vec_id, neighbor_id, rank, similarity from r where rank <= 10
"""

_EXACT = """
select doc_id, first_id as duplicate_of
from (select doc_id, min(doc_id) over (partition by text) as first_id from documents where text is not null)
where doc_id <> first_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": _LINES, "op3_mixing": _MIXING, "op6_exact_top_k": _TOP_K, "op10_exact_dedup": _EXACT}
