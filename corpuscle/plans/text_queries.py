"""Queries of the text, quality, chunk and similarity operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.functions import ids, quality, text
from corpuscle.functions.dates import calendar_valid, extract_dates
from corpuscle.operators import chunking, inventory, layout, release, shingles, similarity
from corpuscle.operators.common import cut, small
from corpuscle.plans.base import BAND, QUALITY, joined, pages, table, turns, year_of

CFG = similarity.Config(translation=0.30, weak_link=0.20)
_AB = similarity.coefficients(128)
_PERMUTATIONS = "(values " + ", ".join(f"({i}, {a}::bigint, {b}::bigint)" for i, (a, b) in enumerate(_AB)) + ") as perm(i, a, b)"


def exact_dup_groups(spark: SparkSession, d: str) -> DataFrame:
    return inventory.duplicate_groups(table(spark, d, "documents"), F.col("text"), "doc_id")


def quality_metrics(spark: SparkSession, d: str) -> DataFrame:
    m = F.col("metrics")
    names = ("printable_ratio", "alnum_ratio", "isolated_word_ratio", "noise_ratio")
    return pages(spark, d).select("doc_id", m["char_count"].alias("char_count"), m["word_count"].alias("word_count"), *[F.round(m[c], 6).alias(c) for c in names])


def quality_score_band(spark: SparkSession, d: str) -> DataFrame:
    p = pages(spark, d)
    return p.select("doc_id", "quality_score", text.quality_band(F.col("quality_score")).alias("band"), quality.native_is_credible(F.col("metrics"), F.col("quality_score")).alias("credible"))


def review_reasons(spark: SparkSession, d: str) -> DataFrame:
    m, none = F.col("metrics"), F.lit(None).cast("double")
    r = quality.review_reasons(F.col("quality_score"), none, none, F.lit(0.05), m["char_count"], m["noise_ratio"], F.lit(1), F.col("year"))
    p = pages(spark, d).withColumn("r", r)
    return p.select("doc_id", joined("r").alias("reasons"), quality.review_priority(F.col("r"), F.col("quality_score")).alias("priority"))


def review_queue(spark: SparkSession, d: str) -> DataFrame:
    return release.review_queue(pages(spark, d).withColumn("review_reasons", F.array("review_priority")))


def page_tags(spark: SparkSession, d: str) -> DataFrame:
    p = pages(spark, d)
    c = F.col
    return p.select("doc_id", joined(release.page_tags(F.array(c("treaty_id")), c("language"), c("script"), c("quality_score"), c("review_required"), c("review_priority"), c("method"))).alias("tags"))


def period_century(spark: SparkSession, d: str) -> DataFrame:
    y = F.year("o_orderdate") - F.pmod(F.col("o_orderkey"), F.lit(700)).cast("int")
    return table(spark, d, "orders").select("o_orderkey", release.period(y).alias("period"), release.century(y).alias("century"))


def document_tags(spark: SparkSession, d: str) -> DataFrame:
    p = pages(spark, d)
    mapping = table(spark, d, "nation").select(F.lower(F.substring("n_name", 1, 2)).alias("doc_type"), F.lit("treaty").alias("instrument_type"), F.lit("binding").alias("legal_force")).dropDuplicates(["doc_type"])
    rows = p.join(small(mapping), "doc_type", "left")
    return rows.select("doc_id", joined(release.document_tags(F.col("doc_type"), F.col("year"), F.col("instrument_type"), F.col("legal_force"))).alias("tags"))


def compact_excerpt(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.length(text.compact(F.col("text"))).alias("compact_chars"), text.excerpt(F.col("text"), 120).alias("excerpt"))


def keywords(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.keywords(F.col("text")).alias("keywords"))


def context_windows(spark: SparkSession, d: str) -> DataFrame:
    at = F.instr("text", "th") - 1
    return table(spark, d, "documents").where(at >= 0).select("doc_id", at.alias("char_start"), text.context(F.col("text"), at, at + 2).alias("context"))


def identifiers(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    key = F.col("p_partkey")
    sha = ids.text_sha256(F.col("p_name"))
    qid = F.when(key % 3 == 0, F.concat(F.lit("Q"), key.cast("string")))
    return p.select(
        "p_partkey", ids.chunk_id(sha, F.col("p_size"), (key % 2000).cast("int")).alias("chunk_id"), ids.entity_node(F.lit("Place"), ids.ascii_slug(F.col("p_name")), qid).alias("node_id"),
        ids.edge_key(F.col("p_type"), F.col("p_name"), F.when(key % 2 == 0, "similar_to").otherwise("party_to")).alias("edge_key"),
        ids.mention_id(F.col("p_brand"), F.col("p_size"), F.lit(1), F.lit(9), F.lit("Place"), F.col("p_name")).alias("mention_id"), ids.chunk_scope(F.col("p_brand"), sha).alias("scope"),
    )


def unicode_slugs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", ids.slug(F.col("text")).alias("slug"), text.uri_component(F.col("text")).alias("uri"))


def lexical_normal_form(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.normalise_lexical("text").alias("lexical"))


def reading_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Readings that differ in case and full stops, and in ten digits at the end of one."""
    t = table(spark, d, "benchmark")
    other = F.concat(F.upper(F.replace("text", F.lit("."), F.lit(""))), F.lit(" 0000000000"))
    return t.select("item_id", F.round(text.agreement(F.col("text"), other), 6).alias("agreement"))


def char_ngrams(spark: SparkSession, d: str) -> DataFrame:
    g = text.char_ngrams(text.normalise_lexical("text"))
    return table(spark, d, "documents").select("doc_id", g.alias("g")).select("doc_id", F.size("g").alias("n"), F.array_min("g").alias("first"), F.array_max("g").alias("last"))


def _sigs(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return similarity.signatures(docs, "doc_id", F.col("text"), form=text.lexical)


def minhash_signatures(spark: SparkSession, d: str) -> DataFrame:
    return _sigs(spark, d).select(F.col("id").alias("doc_id"), F.md5(F.array_join(F.transform("sig", lambda x: x.cast("string")), ",")).alias("signature"))


def lexical_pairs(spark: SparkSession, d: str) -> DataFrame:
    return similarity.lexical_pairs(_sigs(spark, d))


def shingle_jaccard_pairs(spark: SparkSession, d: str) -> DataFrame:
    return shingles.similar_pairs(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text"), 0.6, text.lexical)


def knn_cosine(spark: SparkSession, d: str) -> DataFrame:
    return similarity.knn(table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")))


def _fused(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    p = pages(spark, d).withColumn("chunk_id", F.col("doc_id"))
    semantic = similarity.semantic_pairs(knn_cosine(spark, d))
    return similarity.fuse(lexical_pairs(spark, d), semantic, p, CFG), p


def fused_edges(spark: SparkSession, d: str) -> DataFrame:
    return _fused(spark, d)[0].drop("weighted_combined", "level", "evidence", "pipeline_version")


def document_edges(spark: SparkSession, d: str) -> DataFrame:
    edges, p = _fused(spark, d)
    return similarity.document_edges(cut(edges), p.select("chunk_id", F.col("treaty_id").alias("document_id"))).drop("level", "method", "pipeline_version")


def components(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return similarity.components(lexical_pairs(spark, d).where("jaccard >= 0.6"), docs.select(F.col("doc_id").alias("node")))


def communities(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    edges = lexical_pairs(spark, d).where("jaccard >= 0.5").select("src", "dst", F.col("jaccard").alias("weight"))
    groups = similarity.clusters(similarity.communities(edges, docs.select(F.col("doc_id").alias("node"))), "louvain")
    return groups.where("size > 1").select("cluster_id", "size", joined(F.transform("documents", lambda x: x.cast("string"))).alias("documents"))


def similarity_summary(spark: SparkSession, d: str) -> DataFrame:
    edges, p = _fused(spark, d)
    edges = cut(edges)
    groups = similarity.clusters(similarity.components(edges, p.select(F.col("chunk_id").alias("node"))).withColumnRenamed("root", "community"), "components")
    s = similarity.similarity_summary(edges, groups)
    return s.select("measure", F.round("value", 6).alias("value"))


def embedding_cache(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", F.sha2("text", 256).alias("text_sha256"))
    c = docs.withColumn("embedding_model", F.lit(None).cast("string")).withColumn("embedding_created_at", F.lit(None).cast("string"))
    stamp = F.lit("2024-01-01T00:00:00Z")
    _, cache = similarity.embed(c.where("doc_id % 2 = 0"), None, "hashed", now=stamp)
    out, _ = similarity.embed(c, cache, "hashed", now=F.lit("2024-01-02T00:00:00Z"))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    return out.select("doc_id", "embedding_created_at", F.round(norm, 4).alias("norm"))


def chunk_windows(spark: SparkSession, d: str) -> DataFrame:
    rows = chunking.chunk_pages(pages(spark, d).select("document_id", "source_sha256", "page_number", "text", "title", "doc_type", "quality_score", "review_priority", "pipeline_version", "source_filename"))
    return rows.select("chunk_id", "document_id", "chunk_index", F.length("text").alias("chars"), "text_sha256")


def word_lines(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "lineitem").select(
        "l_orderkey", (F.col("l_linenumber") % 2).alias("line"), F.col("l_linenumber").alias("word_num"), F.concat("l_returnflag", "l_linestatus", F.col("l_suppkey").cast("string")).alias("text"),
        (F.col("l_discount") * 10).alias("conf"), F.col("l_tax").alias("x0"), F.col("l_discount").alias("y0"), (F.col("l_tax") + 0.1).alias("x1"), (F.col("l_discount") + 0.1).alias("y1"),
    )
    out = layout.lines_from_words(w, ["l_orderkey", "line"])
    return out.select("l_orderkey", "line", "text", "confidence", *[F.round(F.col("bbox")[i], 6).alias(f"b{i}") for i in range(4)])


def date_mentions(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    t = F.concat(F.lit("Fait le "), F.dayofmonth("o_orderdate").cast("string"), F.lit(" mars "), F.year("o_orderdate").cast("string"), F.lit(", revu "), F.date_format("o_orderdate", "d/M/yyyy"), F.lit("."))
    rows = o.select("o_orderkey", F.inline(extract_dates(t)))
    return rows.select("o_orderkey", "surface", "char_start", "char_end", "iso_date", "confidence", calendar_valid(F.col("iso_date")).alias("in_calendar"))


def contract_violations(spark: SparkSession, d: str) -> DataFrame:
    p = pages(spark, d)
    broken = p.withColumn("page_number", F.when(F.col("doc_id") % 50 == 0, 0).otherwise(1)).withColumn("quality_score", F.when(F.col("doc_id") % 70 == 0, None).otherwise(F.col("quality_score"))).withColumn(
        "tags", F.when(F.col("doc_id") % 90 == 0, F.array(F.lit("no namespace"))).otherwise(F.array(F.lit("a:b")))
    )
    return release.violations(broken, "page", "document_id")


def metadata_join(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    files = s.select(F.concat("s_name", F.lit(".PDF")).alias("filename"), F.sha2((F.col("s_suppkey") % 40).cast("string"), 256).alias("sha256"))
    c = table(spark, d, "customer")
    records = c.select(F.lower(F.concat(F.replace("c_name", F.lit("Customer"), F.lit("Supplier")), F.lit(".pdf"))).alias("filename"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("treaty_id"), F.lit(None).cast("string").alias("treaty_number"), F.lit("x").alias("doc_type"), (F.col("c_nationkey") + 1900).alias("year"))
    out = inventory.metadata_view(inventory.with_metadata(files, inventory.group_metadata(records)))
    return out.select("document_id", "canonical_filename", "title", "treaty_id", "year", F.size("metadata").alias("n"))


def pipe_list(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    kinds = F.array(*[F.lit(x) for x in ("Traité de paix", "Accord (franco) x", "Échange de lettres", "Texte de loi", "Inconnu au bataillon", "")])
    ref = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("TRA"), F.year("o_orderdate").cast("string"), F.lit("/"), F.col("o_custkey").cast("string"))).otherwise(F.concat(F.lit("TRA"), F.year("o_orderdate").cast("string")))
    line = F.concat_ws("|", F.lit("http://x"), F.concat(F.col("o_orderkey").cast("string"), F.lit(".pdf")), ref, F.element_at(kinds, (F.col("o_orderkey") % 6 + 1).cast("int")))
    return inventory.parse_pipe_list(o.select(F.when(F.col("o_orderkey") % 10 == 0, F.concat(F.lit("#"), line)).otherwise(line).alias("value"))).drop("url")


def type_distributions(spark: SparkSession, d: str) -> DataFrame:
    return inventory.distributions(pipe_list(spark, d))


QUERIES = [
    exact_dup_groups, quality_metrics, quality_score_band, review_reasons, review_queue, page_tags, period_century, document_tags, compact_excerpt, keywords, context_windows, identifiers, unicode_slugs,
    lexical_normal_form, reading_agreement, char_ngrams, minhash_signatures, lexical_pairs, shingle_jaccard_pairs, knn_cosine, fused_edges, document_edges, components, communities,
    similarity_summary, embedding_cache, chunk_windows, word_lines, date_mentions, contract_violations, metadata_join, pipe_list, type_distributions,
]

_LEX = "trim(regexp_replace(lower(strip_accents(replace(text, 'ß', 'ss'))), '[^a-z0-9]+', ' ', 'g'))"
_GRAMS = f"""
gx as (select doc_id, replace({_LEX}, ' ', '') as s from documents),
gg as (select doc_id, case when length(s) = 0 then []::varchar[] when length(s) <= 5 then [s] else list_distinct(list_transform(range(1, length(s) - 3), lambda i: substr(s, i, 5))) end as g from gx)
"""
_SIG = f"""{_GRAMS},
gh as (select doc_id, ('0x' || substr(md5(gram), 1, 8))::bigint % 2147483647 as h from (select doc_id, unnest(g) as gram from gg)),
sv as (select doc_id, i, min((h * a + b) % 2147483647) as v from gh, {_PERMUTATIONS} group by doc_id, i),
sg as (select doc_id, list(v order by i) as sig from sv group by doc_id)"""
_LEXICAL = f"""{_SIG},
bk as (select doc_id, b, array_to_string(sig[b * 5 + 1 : b * 5 + 5], ',') as k from sg, range(25) as r(b)),
cand as (select distinct x.doc_id as src, y.doc_id as dst from bk x join bk y on x.b = y.b and x.k = y.k and x.doc_id < y.doc_id),
eq as (select src, dst, count(*) filter (where x.v = y.v) as m from cand join sv x on x.doc_id = src join sv y on y.doc_id = dst and y.i = x.i group by src, dst),
lp as (select src, dst, round(m / 128, 6) as jaccard from eq)"""
_KNN = """
kp as (select x.vec_id as src, y.vec_id as dst, round(greatest(0.0, least(1.0, list_dot_product(x.embedding::double[], y.embedding::double[])
  / (sqrt(list_dot_product(x.embedding::double[], x.embedding::double[])) * sqrt(list_dot_product(y.embedding::double[], y.embedding::double[]))))), 6) as cosine
  from embeddings x join embeddings y on x.vec_id <> y.vec_id),
kn as (select src, dst, cosine from (select *, row_number() over (partition by src order by cosine desc, dst) as rn from kp) where rn <= 20)"""
_FUSED = f"""{_LEXICAL}, {_KNN},
sp as (select least(src, dst) as src, greatest(src, dst) as dst, max(cosine) as cosine from kn group by 1, 2),
fj as (select coalesce(l.src, s.src) as src, coalesce(l.dst, s.dst) as dst, coalesce(jaccard, 0) as lexical, coalesce(cosine, 0) as semantic from lp l full join sp s on l.src = s.src and l.dst = s.dst),
ft as (select f.*, least(a.quality, b.quality) as quality_weight, a.quality < 0.97 or b.quality < 0.97 as provisional, a.source as sa, b.source as sb,
  case when lexical >= 0.9 then 'duplicate' when lexical >= 0.6 then 'clause_reuse' when semantic >= 0.3 and a.lang <> b.lang then 'translation' when semantic >= 0.3 then 'semantic_kin'
  when semantic >= 0.2 then 'weak_link' end as type from fj f join qs a on a.doc_id = f.src join qs b on b.doc_id = f.dst),
fe as (select src, dst, type, lexical, semantic, round(round(0.5 * lexical + 0.5 * semantic, 9) + 1e-10, 6) as combined, quality_weight, provisional, sa, sb,
  case when semantic <> 0 then 'minhash_lsh+knn' else 'minhash_lsh' end as method from ft where type is not null)"""
_CC = """
cn as (select doc_id as node from documents),
ce as (select src as a, dst as b from {edges} union select dst, src from {edges}),
walk(node, seen) as (select node, node from cn union select w.node, e.b from walk w join ce e on e.a = w.seen),
roots as (select node, min(seen) as root from walk group by node)"""
_PIPES = """
pl as (select o_orderkey as k, o_custkey as c, year(o_orderdate) as y, ['Traité de paix', 'Accord (franco) x', 'Échange de lettres', 'Texte de loi', 'Inconnu au bataillon', ''][o_orderkey % 6 + 1] as title from orders where o_orderkey % 10 <> 0),
pr as (select k || '.pdf' as filename, title, 'TRA' || y as treaty_id, case when k % 3 = 0 then c::varchar else '' end as treaty_number, y::int as year,
  ['Traité', 'Accord', 'Échange de lettres', 'Texte', 'Autre', 'Inconnu'][k % 6 + 1] as doc_type from pl)"""

SQL = {
    "exact_dup_groups": "select sha256(text) as sha256, count(*) as n, min(doc_id) as first_id from documents group by 1 having count(*) > 1",
    "quality_metrics": f"with {QUALITY} select doc_id, n as char_count, word_count, round(printable, 6) as printable_ratio, round(alnum, 6) as alnum_ratio, round(isolated, 6) as isolated_word_ratio, round(noise, 6) as noise_ratio from qm",
    "quality_score_band": f"with {QUALITY} select doc_id, quality as quality_score, {BAND.format('quality')} as band, n >= 3 and replaced = 0 and private = 0 and printable >= 0.98 and noise <= 0.01 and quality >= 0.82 as credible from qs",
    "review_reasons": f"""with {QUALITY}, r as (select doc_id, quality, list_filter([case when quality < 0.85 then 'low_confidence' end, case when n < 10 then 'no_text_with_visible_ink' end,
        case when n < 80 and quality < 0.90 then 'sparse_text_with_visible_ink' end, case when noise > 0.02 then 'unexpected_characters' end], lambda x: x is not null) as r from qs)
        select doc_id, array_to_string(r, '; ') as reasons, case when len(r) = 0 then 'none' when quality < 0.65 or list_contains(r, 'no_text_with_visible_ink') then 'high' else 'normal' end as priority from r""",
    "review_queue": f"""with {QUALITY} select sha256(text) as source_sha256, 1 as page_number, string_agg(source || '-' || doc_id, ' | ' order by source || '-' || doc_id) as filenames, round(min(quality), 6) as quality_score,
        case when min(quality) < 0.9 then 'high' else 'normal' end as reasons, case when min(quality) < 0.9 then 'high' else 'normal' end as priority from qs where quality < 0.97 group by 1""",
    "page_tags": f"""with {QUALITY} select doc_id, array_to_string(list_sort([source, 'language:' || lang, 'script:Latin', 'ocr_method:native_pymupdf', 'quality:' || {BAND.format('quality')},
        case when quality >= 0.97 then 'review:not_required' when quality < 0.9 then 'review:required_high' else 'review:required_normal' end]), '; ') as tags from qs""",
    "period_century": """with y as (select o_orderkey, year(o_orderdate) - o_orderkey % 700 as y from orders) select o_orderkey,
        case when y >= 1990 then 'contemporary_1990_present' when y >= 1939 then 'world_war_ii_and_postwar_1939_1989' when y >= 1914 then 'world_war_i_and_interwar_1914_1938' when y >= 1816 then 'nineteenth_century_1816_1913'
        when y >= 1789 then 'revolutionary_napoleonic_1789_1815' when y >= 1516 then 'early_modern_1516_1788' else 'unknown' end as period,
        case when (y - 1) // 100 + 1 between 16 and 21 then 'c' || ((y - 1) // 100 + 1) else 'unknown' end as century from y""",
    "document_tags": """with m as (select distinct lower(substr(n_name, 1, 2)) as t from nation), y as (select doc_id, lang, 1880 + doc_id % 150 as y, m.t from documents left join m on m.t = lang)
        select doc_id, array_to_string(list_sort(['corpus:documents', 'stage:live_snapshot', 'source_db:corpus', 'rights_status:to_review', 'doc_type:' || lang,
        'instrument_type:' || case when t is null then 'unknown' else 'treaty' end, 'legal_force:' || case when t is null then 'unknown' else 'binding' end, 'century:c' || ((y - 1) // 100 + 1),
        'period:' || case when y >= 1990 then 'contemporary_1990_present' when y >= 1939 then 'world_war_ii_and_postwar_1939_1989' when y >= 1914 then 'world_war_i_and_interwar_1914_1938' else 'nineteenth_century_1816_1913' end]), '; ') as tags from y""",
    "compact_excerpt": r"""with c as (select doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) as c from documents)
        select doc_id, length(c) as compact_chars, case when length(c) <= 120 then c else rtrim(substr(c, 1, 119)) || '…' end as excerpt from c""",
    "keywords": f"""with w as (select doc_id, list_filter(regexp_extract_all(lower(text), '[a-zà-öø-ÿ0-9]{{3,}}'), lambda x: not list_contains([{', '.join("'" + w + "'" for w in text.stop_words())}], x)) as w from documents),
        u as (select doc_id, x, min(i) as i from (select doc_id, unnest(w) as x, unnest(range(1, len(w) + 1)) as i from w) group by doc_id, x),
        r as (select doc_id, x, i, row_number() over (partition by doc_id order by i) as rn from u)
        select d.doc_id, coalesce(string_agg(x, ' ' order by i), '') as keywords from documents d left join (select * from r where rn <= 40) r on r.doc_id = d.doc_id group by d.doc_id""",
    "context_windows": r"""with a as (select doc_id, text, instr(text, 'th') - 1 as s from documents) select doc_id, s as char_start,
        trim(regexp_replace(substr(text, greatest(s - 90, 0) + 1, least(s + 92, length(text)) - greatest(s - 90, 0)), '\s+', ' ', 'g')) as context from a where s >= 0""",
    "identifiers": r"""with s as (select *, sha256(p_name) as sha, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') as slug from part)
        select p_partkey, sha || ':p' || lpad(p_size::varchar, 4, '0') || ':c' || case when p_partkey % 2000 < 1000 then lpad((p_partkey % 2000)::varchar, 3, '0') else (p_partkey % 2000)::varchar end as chunk_id,
        case when p_partkey % 3 = 0 then 'ent:wd:Q' || p_partkey else 'ent:Place:' || slug end as node_id,
        case when p_partkey % 2 = 0 then 'similar_to:' || least(p_type, p_name) || '->' || greatest(p_type, p_name) else 'party_to:' || p_type || '->' || p_name end as edge_key,
        sha256(p_brand || ':' || p_size || ':1:9:Place:' || p_name) as mention_id, sha256(p_brand || chr(0) || sha) as scope from s""",
    "lexical_normal_form": f"select doc_id, {_LEX} as lexical from documents",
    "unicode_slugs": "select doc_id, coalesce(nullif(trim(regexp_replace(lower(strip_accents(replace(text, 'ß', 'ss'))), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'unknown') as slug, url_encode(text) as uri from documents",
    "reading_agreement": r"""with n as (select item_id, length(regexp_replace(replace(lower(text), 'ß', 'ss'), '[^\p{L}\p{N}]', '', 'g')) as n from benchmark)
        select item_id, case when n >= 20 then round(2 * n / (2 * n + 10), 6) end as agreement from n""",
    "char_ngrams": f"with {_GRAMS} select doc_id, len(g) as n, list_min(g) as first, list_max(g) as last from gg",
    "minhash_signatures": f"with {_SIG} select doc_id, md5(array_to_string(sig, ',')) as signature from sg",
    "lexical_pairs": f"with {_LEXICAL} select src, dst, jaccard from lp",
    "shingle_jaccard_pairs": f"""with w as (select doc_id, list_filter(string_split({_LEX}, ' '), lambda x: x <> '') as w from documents),
        g as (select doc_id, list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as g from w where len(w) >= 3),
        e as (select doc_id, len(g) as n, unnest(g) as x from g), c as (select a.doc_id as src, b.doc_id as dst, a.n + b.n as n, count(*) as m from e a join e b on a.x = b.x and a.doc_id < b.doc_id group by all)
        select src, dst, round(m / (n - m), 6) as jaccard from c where round(m / (n - m), 6) >= 0.6""",
    "knn_cosine": f"with {_KNN} select src, dst, cosine from kn",
    "fused_edges": f"with {QUALITY}, {_FUSED} select src, dst, type, lexical, semantic, combined, quality_weight, provisional, method from fe",
    "document_edges": f"""with {QUALITY}, {_FUSED},
        dk as (select *, least(sa, sb) as a, greatest(sa, sb) as b, case type when 'duplicate' then 'same_instrument_as' when 'translation' then 'translation' else 'similar_to' end as kind from fe where sa <> sb),
        db as (select * from (select *, row_number() over (partition by a, b order by combined desc, src, dst) as rn from dk) where rn = 1),
        dt as (select a, b, kind, row_number() over (partition by a, b order by count(*) desc, min((src, dst))) as rn from dk group by a, b, kind),
        da as (select a, b, round(round(avg(quality_weight), 9) + 1e-10, 6) as quality_weight, bool_and(provisional) as provisional, count(*) as n from dk group by a, b)
        select 'doc:' || da.a as src, 'doc:' || da.b as dst, dt.kind as type, db.lexical, db.semantic, db.combined, da.quality_weight, da.provisional, 'chunk_pairs=' || n as evidence
        from da join db on db.a = da.a and db.b = da.b join dt on dt.a = da.a and dt.b = da.b and dt.rn = 1""",
    "components": f"with recursive {_LEXICAL}, le as (select * from lp where jaccard >= 0.6), {_CC.format(edges='le')} select node, root from roots",
    "similarity_summary": f"""with recursive {QUALITY}, {_FUSED}, {_CC.format(edges='fe')}, sz as (select count(*) as n from roots group by root)
        select 'type:' || type as measure, count(*)::double as value from fe group by type union all select 'provisional_ratio', round(avg(provisional::int), 6) from fe
        union all select 'median_cluster_size', median(n) from sz union all select 'clusters', count(*)::double from sz""",
    "embedding_cache": """with h as (select text, bool_or(doc_id % 2 = 0) as old, length(text) >= 3 as encoded from documents group by text)
        select doc_id, case when old then '2024-01-01T00:00:00Z' else '2024-01-02T00:00:00Z' end as embedding_created_at, case when encoded then 1.0 else 0.0 end::double as norm from documents join h using (text)""",
    "chunk_windows": r"""with recursive t as (select doc_id, text, regexp_extract_all(text, '\S+\s*') as w, length(text) - length(ltrim(text, chr(9) || chr(10) || chr(13) || ' ')) as lead from documents),
        n as (select *, len(w) as n, case when len(w) = 0 then 0 when len(w) <= 384 then 1 else ceil((len(w) - 384) / 320)::int + 1 end as k from t),
        i as (select doc_id, text, w, unnest(range(k)) as i from n),
        c as (select doc_id, i, text, rtrim(array_to_string(w[i * 320 + 1 : i * 320 + 384], ''), chr(9) || chr(10) || chr(13) || ' ') as c from i)
        select sha256('d' || doc_id || chr(0) || sha256(text)) || ':p0001:c' || lpad(i::varchar, 3, '0') as chunk_id, 'd' || doc_id as document_id, i as chunk_index, length(c) as chars, sha256(c) as text_sha256 from c""",
    "word_lines": """with w as (select l_orderkey, l_linenumber % 2 as line, l_linenumber as wn, l_returnflag || l_linestatus || l_suppkey as t, l_discount * 10 as conf, l_tax, l_discount from lineitem)
        select l_orderkey, line, string_agg(t, ' ' order by wn, t) as text, round(sum(conf * length(t)) / sum(length(t)), 6) as confidence, round(min(l_tax), 6) as b0, round(min(l_discount), 6) as b1,
        round(max(l_tax + 0.1), 6) as b2, round(max(l_discount + 0.1), 6) as b3 from w group by 1, 2""",
    "date_mentions": """with o as (select o_orderkey, day(o_orderdate) as d, month(o_orderdate) as m, year(o_orderdate) as y from orders)
        select o_orderkey, 'le ' || d || ' mars ' || y as surface, 5 as char_start, 5 + length('le ' || d || ' mars ' || y) as char_end, y || '-03-' || lpad(d::varchar, 2, '0') as iso_date, 0.95::double as confidence, true as in_calendar from o
        union all select o_orderkey, d || '/' || m || '/' || y, 5 + length('le ' || d || ' mars ' || y || ', revu '), 5 + length('le ' || d || ' mars ' || y || ', revu ' || d || '/' || m || '/' || y),
        y || '-' || lpad(m::varchar, 2, '0') || '-' || lpad(d::varchar, 2, '0'), 0.85::double, true from o""",
    "contract_violations": """select 'd' || doc_id as key, 'page_number' as "column", 'min' as rule from documents where doc_id % 50 = 0 union all select 'd' || doc_id, 'quality_score', 'required' from documents where doc_id % 70 = 0
        union all select 'd' || doc_id, 'tags', 'items' from documents where doc_id % 90 = 0""",
    "metadata_join": """with f as (select s_name || '.PDF' as filename, s_suppkey % 40 as h from supplier), r as (select lower(replace(c_name, 'Customer', 'Supplier')) || '.pdf' as k, * from customer),
        g as (select k, min(c_name) as title, arg_min(c_mktsegment, c_name) as treaty_id, min(c_nationkey + 1900) as year, count(*) as n from r group by k)
        select replace(filename, '.PDF', '') as document_id, first_value(filename) over (partition by h order by lower(filename)) as canonical_filename, coalesce(title, '') as title, coalesce(treaty_id, '') as treaty_id, year, coalesce(n, 0)::int as n
        from f left join g on lower(filename) = k""",
    "pipe_list": f"with {_PIPES} select * from pr",
    "type_distributions": f"with {_PIPES} select 'doc_type' as kind, doc_type as value, count(*) as n from pr group by 2 union all select 'year', year::varchar, count(*) from pr group by 2 union all select 'treaties', null, count(distinct treaty_id) from pr",
}
