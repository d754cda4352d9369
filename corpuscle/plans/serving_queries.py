"""Queries of the serving layer: search, retrieval context, facets, views and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.functions import text
from corpuscle.operators import evaluation, serving
from corpuscle.operators.common import spread
from corpuscle.plans.base import joined, pages, table, turns

WORDS = "the and treaty of the"


def _edges(spark: SparkSession, d: str) -> DataFrame:
    """lineitem as weighted edges between parts and suppliers."""
    li = table(spark, d, "lineitem")
    return li.select(F.concat(F.lit("p"), "l_partkey").alias("src"), F.concat(F.lit("s"), "l_suppkey").alias("dst"), F.col("l_quantity").alias("weight"), F.col("l_returnflag").alias("type"))


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select(F.concat(F.lit("p"), "p_partkey").alias("node_id"), F.lit("Place").alias("type"), F.col("p_name").alias("label"))
    s = table(spark, d, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("node_id"), F.lit("Organization").alias("type"), F.col("s_name").alias("label"))
    return p.unionAll(s)


def weighted_degree(spark: SparkSession, d: str) -> DataFrame:
    return serving.weighted_degree(_edges(spark, d))


def node_budget(spark: SparkSession, d: str) -> DataFrame:
    return serving.node_budget(_nodes(spark, d), _edges(spark, d), 300).select("node_id", "type", "degree")


def edge_cap(spark: SparkSession, d: str) -> DataFrame:
    return serving.edge_cap(_edges(spark, d), 8).select("src", "dst", "weight")


def graph_view(spark: SparkSession, d: str) -> DataFrame:
    n, e = serving.graph_view(_nodes(spark, d), _edges(spark, d), hidden_edges=["R"], least=45.0)
    return e.groupBy("type").agg(F.count("*").alias("n"), F.countDistinct("src").alias("sources"))


def conversation_summary(spark: SparkSession, d: str) -> DataFrame:
    t = turns(spark, d).withColumns({
        "language": F.array("role"), "quality_score": F.col("page_number") / 10.0, "review_required": F.col("page_number") > 5,
        "review_priority": F.when(F.col("page_number") > 7, "high").when(F.col("page_number") > 5, "normal").otherwise("none"),
    })
    s = serving.document_summary(t)
    return s.select("document_id", joined("languages").alias("languages"), "quality_score", "review_required", "review_priority", "pages", F.length("text").alias("chars"))


def facets(spark: SparkSession, d: str) -> DataFrame:
    return serving.facets(pages(spark, d), ["language", "doc_type", "treaty_id", "year"])


def page_groups(spark: SparkSession, d: str) -> DataFrame:
    return serving.page_groups(turns(spark, d), 3)


def inverted_index(spark: SparkSession, d: str) -> DataFrame:
    i = serving.index(spread(table(spark, d, "documents")), F.col("text"), "doc_id")
    return i.groupBy("token").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def keyword_search(spark: SparkSession, d: str) -> DataFrame:
    docs = spread(table(spark, d, "documents")).select("doc_id", "text", F.array("lang").alias("languages"))
    i = serving.index(docs, F.col("text"), "doc_id")
    return serving.search(docs.drop("text"), i, WORDS, 20, "language:en", "doc_id").select("doc_id", F.round("score", 6).alias("score"))


def keyword_overlap(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").withColumn("keywords", F.lower(F.concat_ws(" ", "p_name", "p_type", "p_brand")))
    return serving.keyword_overlap(p, "small red widget economy", 10, "keywords", "p_partkey").select("p_partkey", F.col("score").cast("int").alias("score"))


def bm25_search(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    i = serving.index(docs, F.col("text"), "doc_id").withColumn("field", F.lit("text"))
    return serving.bm25(i, "nation threea", 20, id_col="doc_id")


def related_documents(spark: SparkSession, d: str) -> DataFrame:
    e = _edges(spark, d).select(F.concat(F.lit("doc:"), "src").alias("src"), F.concat(F.lit("doc:"), "dst").alias("dst"), "type", F.col("weight").alias("combined"), F.lit(None).cast("double").alias("quality_weight"))
    return serving.related_documents(e.dropDuplicates(["src", "dst", "type", "combined"]), 4).select("document_id", "other_id", "type", "score", "rank")


def entities_of(spark: SparkSession, d: str) -> DataFrame:
    links = _edges(spark, d).select(F.col("dst").alias("document_id"), F.col("src").alias("node_id"), (F.col("weight") / 50).alias("confidence"))
    return serving.entities_of(links, _nodes(spark, d), 6).select("document_id", "node_id", "label", "confidence", "rank")


def confusion_sweep(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber")
    cases = li.select(
        key.alias("case_id"), F.when(F.col("l_returnflag") == "A", "positive").when(F.col("l_returnflag") == "N", "negative").otherwise("exclude").alias("label"), F.lit("duplicate").alias("expected_type"),
        (F.col("l_discount") * 10).alias("lexical"), (F.col("l_tax") * 12).alias("semantic"), F.lit(True).alias("known"), F.lit(False).alias("apart"),
    )
    return evaluation.confusion(cases, evaluation.grid(spark, {"w_lexical": [0.5], "duplicate": [0.75, 0.95], "clause_reuse": [0.45], "translation": [0.65], "weak_link": [0.35]}))


_ED = "ed as (select 'p' || l_partkey as src, 's' || l_suppkey as dst, l_quantity as weight, l_returnflag as type from lineitem)"
_DEG = f"{_ED}, dg as (select node, round(sum(case when weight = 0 then 1 else weight end), 6) as degree from (select src as node, weight from ed union all select dst, weight from ed) group by node)"
_NO = "no as (select 'p' || p_partkey as node_id, 'Place' as type, p_name as label from part union all select 's' || s_suppkey, 'Organization', s_name from supplier)"

QUERIES = [
    weighted_degree, node_budget, edge_cap, graph_view, conversation_summary, facets, page_groups, inverted_index, keyword_search, keyword_overlap, bm25_search, related_documents, entities_of,
    confusion_sweep,
]
SQL = {
    "weighted_degree": f"with {_DEG} select * from dg",
    "node_budget": f"with {_DEG}, {_NO} select node_id, type, coalesce(degree, 0) as degree from no left join dg on node = node_id order by type = 'Place', degree desc nulls last, node_id limit 300",
    "edge_cap": f"""with {_ED}, o as (select * from (select *, row_number() over (partition by src, dst order by weight desc) as rn from ed) where rn = 1),
        r as (select src, dst, weight, row_number() over (partition by src order by weight desc, src, dst) as a, row_number() over (partition by dst order by weight desc, src, dst) as b from o)
        select src, dst, weight from r where least(a, b) <= 8""",
    "graph_view": f"with {_ED} select type, count(*) as n, count(distinct src) as sources from ed where type <> 'R' and weight >= 45 group by type",
    "conversation_summary": """select 'c' || conv_id as document_id, array_to_string(list_sort(list(distinct role)), '; ') as languages, round(avg((turn + 1) / 10.0), 6) as quality_score, bool_or(turn + 1 > 5) as review_required,
        case when max(turn + 1) > 7 then 'high' when max(turn + 1) > 5 then 'normal' else 'none' end as review_priority, count(*) as pages, (sum(length(coalesce(text, ''))) + count(*) - 1)::bigint as chars from conversations group by conv_id""",
    "facets": """select 'language' as facet, lang as value, count(*) as n from documents group by 2 union all select 'doc_type', lang, count(*) from documents group by 2
        union all select 'treaty_id', source, count(*) from documents group by 2 union all select 'year', (1880 + doc_id % 150)::int::varchar, count(*) from documents group by 2""",
    "page_groups": """with r as (select 'c' || conv_id as document_id, (turn + 1)::int as p, ((row_number() over (partition by conv_id order by turn) - 1) // 3)::int as g from conversations)
        select document_id, g as "group", min(p) as first, max(p) as last from r group by 1, 2""",
    "inverted_index": r"""with t as (select doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}\p{M}_]+')) as token from documents), i as (select doc_id, token, count(*) as tf from t group by all)
        select token, count(*) as df, sum(tf)::bigint as cf from i group by token""",
    "keyword_search": r"""with t as (select doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}\p{M}_]+')) as token from documents where lang = 'en')
        select doc_id, round(sum(case token when 'the' then 2 else 1 end) / 5.0, 6)::double as score from t where token in ('the', 'and', 'treaty', 'of') group by 1 order by score desc, doc_id limit 20""",
    "keyword_overlap": """with k as (select p_partkey, lower(concat_ws(' ', p_name, p_type, p_brand)) as k from part)
        select p_partkey, (contains(k, 'small')::int + contains(k, 'red')::int + contains(k, 'widget')::int + contains(k, 'economy')::int) as score from k order by score desc, p_partkey limit 10""",
    "related_documents": f"""with {_ED}, u as (select distinct * from ed), b as (select src as document_id, dst as other_id, type, weight as score from u union all select dst, src, type, weight from u),
        r as (select *, row_number() over (partition by document_id order by score desc, other_id, type)::int as rank from b) select * from r where rank <= 4""",
    "entities_of": f"""with {_ED}, {_NO}, m as (select dst as document_id, src as node_id, max(weight / 50) as confidence from ed group by 1, 2),
        r as (select *, row_number() over (partition by document_id order by confidence desc, node_id)::int as rank from m) select document_id, r.node_id, label, confidence, rank from r join no using (node_id) where rank <= 6""",
    "bm25_search": r"""with t as (select doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}\p{M}_]+')) as token from documents), i as (select doc_id, token, count(*) as tf from t group by all),
        st as (select sum(tf) / count(distinct doc_id) as mean, count(distinct doc_id) as docs from i), ln as (select doc_id, sum(tf) as len from i group by 1),
        q as (select * from (values ('nation', 6, 1), ('threea', 6, 1)) v(term, n, far)),
        f as (select i.*, term, case when token = term then 1.0 when starts_with(token, term) then 0.375 * n / length(token) when levenshtein(token, term) <= far then 0.45 * (1 - levenshtein(token, term) / n) end as w from i, q),
        g as (select * from f where w is not null), d as (select token, count(distinct doc_id) as df from g group by 1)
        select doc_id, round(sum(w * ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (1 - 0.7 + 0.7 * len / mean))), 6)::double as score from g join d using (token) join ln using (doc_id), st group by 1 order by score desc, doc_id limit 20""",
    "confusion_sweep": """with g as (select * from (values (0, 0.75), (1, 0.95)) v(config, dup)), c as (select l_returnflag = 'A' as pos, l_discount * 10 as x, l_tax * 12 as s from lineitem where l_returnflag in ('A', 'N')),
        p as (select config, pos, case when x >= dup then 'duplicate' when x >= 0.45 then 'c' when s >= 0.65 then 'k' when s >= 0.35 then 'w' end as t from c, g),
        n as (select config, count(*) filter (pos and t = 'duplicate') as tp, count(*) filter (t is not null and not (pos and t = 'duplicate')) as fp, count(*) filter (pos and t is distinct from 'duplicate') as fn,
          count(*) filter (not pos and t is null) as tn from p group by config)
        select config, tp, fp, fn, tn, 0 as missing_pairs, round(tp / (tp + fp), 6) as precision, round(tp / (tp + fn), 6) as recall, round(2 * tp / (2 * tp + fp + fn), 6) as f1 from n""",
}
