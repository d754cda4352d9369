"""Queries of the release, evaluation and site operators, and of the readings and lines of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.functions import text
from corpuscle.operators import evaluation, graph, layout, release, serving
from corpuscle.plans.base import QUALITY, joined, pages, table, turns
from corpuscle.plans.serving_queries import _DEG, _ED, _NO, _edges, _nodes

# ---- text functions


def normalised_text(spark: SparkSession, d: str) -> DataFrame:
    """Names with blanks, digits and punctuation of many kinds as lines, their keys, and their form for comparisons."""
    raw = F.concat(F.lit("\t "), F.col("c_name"), F.lit(" \u2014  "), F.col("c_custkey").cast("string"), F.lit("\xad; E\u0301te\u0301 "), F.col("c_mktsegment"), F.lit("\ufeff "))
    return table(spark, d, "customer").select(
        "c_custkey", text.normalize_line(raw).alias("line"), text.recurring_key(raw).alias("line_key"), text.normalized(raw).alias("compared"), text.uri_component(F.concat("c_name", F.lit("/é "), "c_mktsegment")).alias("uri")
    )


def scripts_languages(spark: SparkSession, d: str) -> DataFrame:
    """Texts with words of other scripts: the shares that count, and the guessed languages of the texts themselves."""
    other = F.element_at(F.array(F.lit(""), F.lit("Привет мир "), F.lit("Καλημέρα "), F.lit("שלום "), F.lit("日本 ")), (F.col("doc_id") % 5 + 1).cast("int"))
    t = F.concat(F.repeat(other, F.ceil(F.length("text") / 40).cast("int")), F.col("text"))
    return table(spark, d, "documents").select("doc_id", joined(text.scripts_in_text(t)).alias("scripts"), joined(text.languages_in_text("text")).alias("languages"))



# ---- pages


def _reading(d: DataFrame, method: str, t: Column, conf: float, cover: Column, seq: int) -> DataFrame:
    return d.select("doc_id", F.lit(method).alias("method"), t.alias("text"), F.lit(conf).alias("confidence"), cover.alias("image_cover"), F.lit(seq).alias("seq"))


def chosen_readings(spark: SparkSession, d: str) -> DataFrame:
    """Of three readings the chosen one: embedded text is missing, damaged or under a picture in turn."""
    docs = table(spark, d, "documents")
    c, none = F.col("text"), F.lit(0.2)
    native = F.when(F.col("doc_id") % 3 == 0, F.lit("")).when(F.col("doc_id") % 5 == 1, F.concat(c, F.lit("�"))).otherwise(c)
    cover = F.when(F.col("doc_id") % 2 == 0, 0.8).otherwise(0.2)
    rows = _reading(docs, "native_text", native, 0.9, cover, 0).unionByName(_reading(docs, "apple_vision", c, 0.88, none, 1)).unionByName(_reading(docs, "tesseract", F.replace(c, F.lit(" "), F.lit("  ")), 0.85, none, 2))
    out = layout.choose(rows, ["doc_id"])
    return out.select("doc_id", "method", F.round("score", 5).alias("score"), F.round("agreement", 6).alias("agreement"))


def _headed(spark: SparkSession, d: str) -> DataFrame:
    """Pages of conversations under a header with their number, over a footer on every second page."""
    t = turns(spark, d)
    head = F.concat(F.lit("Conversation "), F.substring("document_id", 2, 20), F.lit(" — Page "), F.col("page_number").cast("string"), F.lit("\n\n"))
    foot = F.when(F.col("page_number") % 2 == 0, F.concat(F.lit("\n\nConfidential "), F.col("page_number").cast("string"))).otherwise(F.lit(""))
    return t.withColumn("text", F.concat(head, F.regexp_replace(F.coalesce("text", F.lit("")), r"[\r\n\s]+", " "), foot))


def recurring_lines(spark: SparkSession, d: str) -> DataFrame:
    return layout.recurring_lines(_headed(spark, d), ["document_id"])


def cleaned_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages without their recurring headers and footers."""
    out = layout.cleaned(_headed(spark, d), ["document_id"])
    return out.select("document_id", "page_number", F.col("cleaned_text").alias("cleaned"), F.array_join("removed_lines", " / ").alias("removed"))


# ---- release


def _mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("en", "treaty", "binding"), ("fr", "protocol", "binding"), ("it", "letter", "none")], "doc_type string, instrument_type string, legal_force string")


def release_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents of several pages with tags, rights and what they are grouped by."""
    p = pages(spark, d).withColumns({"document_id": F.concat(F.lit("g"), (F.col("doc_id") % 97).cast("string")), "page_number": (F.col("doc_id") / 97).cast("int") + 1})
    out = release.publishable(release.documents(p, _mapping(spark)).withColumn("rights_status", F.when(F.col("year") % 3 == 0, "public_domain").when(F.col("year") % 3 == 1, "to_review")))
    return out.select("document_id", "title", "doc_type", "year", F.size("aliases").alias("aliases"), "eligible", "reason", release.first_namespace(F.col("tags"), "instrument_type").alias("instrument_type"), release.first_namespace(F.col("tags"), "none").alias("none"))


def documents_from_pages(spark: SparkSession, d: str) -> DataFrame:
    p = pages(spark, d).withColumns({"document_id": F.concat(F.lit("g"), (F.col("doc_id") % 97).cast("string")), "page_number": (F.col("doc_id") / 97).cast("int") + 1})
    out = graph.with_mapping(graph.documents_from_pages(p), _mapping(spark))
    return out.select("document_id", "title", "treaty_id", "doc_type", "year", F.round("confidence", 5).alias("confidence"), "provisional", "instrument_type", "legal_force")


def document_rollup(spark: SparkSession, d: str) -> DataFrame:
    p = pages(spark, d).withColumn("cleaned_text", F.trim("text"))
    return release.document_rollup(p, ["treaty_id"]).withColumn("methods", joined("methods"))


def published_documents(spark: SparkSession, d: str) -> DataFrame:
    p = pages(spark, d)
    n = F.col("doc_id")
    return release.corpus_summary(p.select("doc_id", F.when(n % 7 > 0, F.col("page_count")).alias("pages"), F.when(n % 5 > 0, F.col("title")).otherwise("").alias("title"), F.when(n % 3 > 0, F.col("treaty_id")).alias("treaty_id"), F.when(n % 4 > 0, F.col("year")).alias("year"), F.when(n % 2 > 0, F.col("review_required").cast("int")).alias("review_pages")))


def deduped_edges(spark: SparkSession, d: str) -> DataFrame:
    """Three edge tables as one; the earlier table wins, then the higher score."""
    li = table(spark, d, "lineitem").select(F.concat(F.lit("p"), "l_partkey").alias("src"), F.concat(F.lit("s"), "l_suppkey").alias("dst"), F.lit("document").alias("level"), F.col("l_returnflag").alias("type"), F.col("l_linestatus").alias("method"), (F.col("l_quantity") / 50).alias("combined"))
    return release.dedupe_edges(li.where("type = 'A'"), li.where("type <> 'R'"), li)


def type_mapping_differences(spark: SparkSession, d: str) -> DataFrame:
    return release.mapping_differences(table(spark, d, "documents").select("lang").distinct(), _mapping(spark))


def front_matter(spark: SparkSession, d: str) -> DataFrame:
    t = turns(spark, d).withColumn("title", F.concat(F.lit('Talk "'), "document_id", F.lit('" \\')))
    return release.markdown(t).select("document_id", F.length("markdown").alias("chars"), F.md5("markdown").alias("hash"))


# ---- evaluation


def _cases(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("case_id"), F.when(F.col("l_returnflag") == "A", "positive").when(F.col("l_returnflag") == "N", "negative").otherwise("exclude").alias("label"),
        F.when(F.col("l_linenumber") == 1, "any").when(F.col("l_linenumber") == 2, "translation").when(F.col("l_linenumber") == 3, "semantic_kin").when(F.col("l_linenumber") > 3, "duplicate").alias("expected_type"),
        (F.col("l_discount") * 10).alias("lexical"), (F.col("l_tax") * 12).alias("semantic"), (F.col("l_suppkey") % 4 > 0).alias("known"), (F.col("l_partkey") % 2 == 0).alias("apart"),
    )


def confusion_all(spark: SparkSession, d: str) -> DataFrame:
    """Every one of the 243 settings."""
    return evaluation.confusion(_cases(spark, d), evaluation.grid(spark))


def confusion_by_type(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.by_type(_cases(spark, d), evaluation.grid(spark, {"w_lexical": [0.5], "duplicate": [0.85, 0.95], "clause_reuse": [0.5], "translation": [0.75], "weak_link": [0.35]}))


def calibration_sweep(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.sweep(_cases(spark, d), evaluation.grid(spark))


def scored_cases(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of parts and suppliers to be judged, with the scores that some of them have and their ends' languages."""
    ps = table(spark, d, "lineitem").select(F.concat(F.lit("p"), "l_partkey").alias("src"), F.concat(F.lit("s"), "l_suppkey").alias("dst"), "l_returnflag", "l_quantity").groupBy("src", "dst").agg(F.max("l_returnflag").alias("f"), F.max("l_quantity").alias("q"))
    cases = ps.select(F.concat("src", "dst").alias("case_id"), F.col("dst").alias("src"), F.col("src").alias("dst"), F.when(F.col("f") == "R", "exclude").when(F.col("f") == "A", "positive").otherwise("negative").alias("label"), F.lit("any").alias("expected_type"))
    scores = ps.where("q > 20").select("src", "dst", (F.col("q") / 100).alias("lexical"), (F.col("q") / 50).alias("semantic"))
    chunks = table(spark, d, "part").select(F.concat(F.lit("p"), "p_partkey").alias("chunk_id"), F.array(F.substring("p_type", 1, 2)).alias("language"))
    other = table(spark, d, "supplier").where("s_suppkey % 3 > 0").select(F.concat(F.lit("s"), "s_suppkey").alias("chunk_id"), F.array(F.lit("EC")).alias("language"))
    return evaluation.scored_cases(cases, scores, chunks.unionByName(other))


def benchmark_checks(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "benchmark")
    n = F.col("item_id")
    words = F.split("text", " ")
    rows = b.select(
        "item_id", "text", F.array(F.lit("Latin")).alias("scripts"), F.when(n % 2 == 0, "native_text").otherwise("tesseract").alias("method"), (n % 3 == 0).alias("review"),
        F.when(n % 4 > 0, 200 + n % 100).alias("min_chars"), F.when(n % 5 > 0, F.array(F.upper(words[0]), F.when(n % 7 == 0, F.lit("nowhere")).otherwise(words[2]))).alias("contains"),
        F.when(n % 6 == 0, "Greek").when(n % 6 < 4, "Latin").alias("script"), F.when(n % 3 == 1, "native").alias("method_prefix"), F.when(n % 2 == 1, F.lit(True)).alias("review_required"),
    )
    return evaluation.benchmark_checks(rows).select("item_id", "chars_ok", "contains_ok", "script_ok", "method_ok", "review_ok", "passed")


def representative_chunks(spark: SparkSession, d: str) -> DataFrame:
    p = pages(spark, d).select(F.col("doc_id").alias("chunk_id"), F.col("treaty_id").alias("document_id"), F.col("doc_type"), F.round("quality_score", 1).alias("quality_score"), F.col("year").alias("page_number"), F.lit(0).alias("chunk_index"), "text")
    keys = p.withColumn("document_id", F.concat_ws("-", "document_id", "doc_type"))
    return evaluation.representative_chunks(keys).select("document_id", "chunk_id", "quality_score")


def band_sample(spark: SparkSession, d: str) -> DataFrame:
    """Five pairs of each score band, suppliers and parts as documents of ten."""
    e = _edges(spark, d).select("src", "dst", (F.col("weight") / 50).alias("combined"))
    docs = _nodes(spark, d).select(F.col("node_id").alias("chunk_id"), F.concat(F.substring("node_id", 1, 1), (F.substring("node_id", 2, 20).cast("int") % 10).cast("string")).alias("document_id"))
    return evaluation.band_sample(e, docs, 5).select("band", "place", "d1", "d2", "src", "dst")


def band_counts(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.band_counts(band_sample(spark, d))


def no_edge_negatives(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of nations of a region without an edge."""
    n = table(spark, d, "nation")
    reps = n.select(F.col("n_name").alias("document_id"), F.concat(F.lit("c"), "n_nationkey").alias("chunk_id"), F.col("n_regionkey").cast("string").alias("doc_type"), (1900 + F.col("n_regionkey")).alias("year"))
    edges = n.select(F.concat(F.lit("c"), "n_nationkey").alias("src"), F.concat(F.lit("c"), ((F.col("n_nationkey") + 1) % 25).cast("string")).alias("dst"))
    return evaluation.no_edge_negatives(reps, edges, 1000).select("src", "dst")


# ---- graph and site


def edge_choice(spark: SparkSession, d: str) -> DataFrame:
    """Of edges of one key the one of highest quality weight, the first on ties, and only between nodes."""
    li = table(spark, d, "lineitem").select(F.concat(F.lit("p"), "l_partkey").alias("src"), F.concat(F.lit("s"), "l_suppkey").alias("dst"), F.when(F.col("l_returnflag") == "A", "similar_to").otherwise("party_to").alias("type"), F.col("l_quantity").alias("quality_weight"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"), F.lit("x").alias("evidence"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("method"))
    some = _nodes(spark, d).where("node_id not like '%7'")
    return graph.with_ends(graph.add_edges(li), some).select("src", "dst", "type", "quality_weight", "method")


def type_summary(spark: SparkSession, d: str) -> DataFrame:
    """Counts of nodes and edges by type and of all."""
    n = _nodes(spark, d).withColumn("provisional", F.substring("node_id", -1, 1) == "3")
    e = _edges(spark, d).withColumn("provisional", F.col("weight") > 40)
    return graph.graph_summary(n, e).withColumn("type", F.coalesce("type", F.lit("(all)")))


def reduced_graph(spark: SparkSession, d: str) -> DataFrame:
    """The edges of the 150 nodes of a view, eight a node."""
    return serving.reduce_graph(_nodes(spark, d), _edges(spark, d), 150, 8)[1].select("src", "dst", "weight")


def focused_view(spark: SparkSession, d: str) -> DataFrame:
    """A node's neighbourhood among labels that contain a text, node types hidden or not."""
    n, e = serving.graph_view(_nodes(spark, d), _edges(spark, d), hidden_nodes=["Person"], least=10.0, label="0", focus="s1")
    return n.select("node_id", F.lit("node").alias("kind")).unionByName(e.select(F.col("src").alias("node_id"), F.lit("edge").alias("kind")))


def similar_documents(spark: SparkSession, d: str) -> DataFrame:
    """The ten most similar others of each document; ends are chunks of parts, or documents by name."""
    e = _edges(spark, d).where("weight > 5").select("src", F.concat(F.lit("doc:"), "dst").alias("dst"), F.when(F.col("type") == "A", F.lit(None)).when(F.col("type") == "N", 0.0).otherwise(F.col("weight") / 50).alias("combined"), (F.col("weight") / 100).alias("semantic"), F.lit(0.3).alias("lexical"), F.when(F.col("type") != "R", F.col("type")).alias("type"), F.lit(None).cast("boolean").alias("provisional"))
    chunks = table(spark, d, "part").where("p_partkey % 5 > 0").select(F.concat(F.lit("p"), "p_partkey").alias("chunk_id"), F.concat(F.lit("t"), (F.col("p_partkey") % 50).cast("string")).alias("document_id"))
    titles = table(spark, d, "supplier").where("s_suppkey % 2 = 0").select(F.concat(F.lit("s"), "s_suppkey").alias("document_id"), F.col("s_name").alias("title"))
    return serving.similar_documents(e, chunks, titles, 10).select("document_id", "other_id", "title", F.round("score", 6).alias("score"), "type", "provisional", "rank")


def outgoing_relations(spark: SparkSession, d: str) -> DataFrame:
    e = _edges(spark, d).groupBy("src", "dst", "type").agg(F.max("weight").alias("quality_weight")).withColumn("combined", F.lit(None).cast("double"))
    return serving.related_documents(e, 4, symmetric=False).select("document_id", "other_id", "type", "score", "rank")


def retrieval_context(spark: SparkSession, d: str) -> DataFrame:
    """The context of eight hits for each region: nations as chunks, customers' segments as entities."""
    n = table(spark, d, "nation")
    hits = n.select(F.col("n_regionkey").alias("query_id"), F.concat(F.lit("c"), "n_nationkey").alias("chunk_id"), F.row_number().over(_window()).alias("rank"), F.lit(1.0).alias("score"))
    chunks = n.select(F.concat(F.lit("c"), "n_nationkey").alias("chunk_id"), F.col("n_nationkey").alias("document_id"), (F.col("n_nationkey") + 1).alias("page_number"), F.concat(F.lit(" A  text of "), "n_name").alias("text"))
    docs = n.select(F.col("n_nationkey").alias("document_id"), F.col("n_name").alias("title"))
    c = table(spark, d, "customer")
    links = c.where("c_nationkey % 6 > 0").select(F.col("c_nationkey").alias("document_id"), F.col("c_mktsegment").alias("node_id"), (F.col("c_acctbal") / 10000).alias("confidence"))
    entities = serving.entities_of(links, c.select(F.col("c_mktsegment").alias("node_id"), F.lower("c_mktsegment").alias("label"), F.lit("Party").alias("type")).distinct(), 3)
    related = n.where("n_nationkey % 4 > 0").select(F.col("n_nationkey").alias("document_id"), F.col("n_regionkey").cast("string").alias("other_id"), F.lit(1).alias("rank"))
    return serving.rag_context(hits, chunks, docs, entities, related)


def _window():  # noqa: ANN202
    from pyspark.sql import Window

    return Window.partitionBy("n_regionkey").orderBy("n_nationkey")


QUERIES = [
    normalised_text, scripts_languages, chosen_readings, recurring_lines, cleaned_pages, release_documents, documents_from_pages, document_rollup, published_documents, deduped_edges, type_mapping_differences,
    front_matter, confusion_all, confusion_by_type, calibration_sweep, scored_cases, benchmark_checks, representative_chunks, band_sample, band_counts, no_edge_negatives, edge_choice, type_summary,
    reduced_graph, focused_view, similar_documents, outgoing_relations, retrieval_context,
]

_BLANKS = "[\\t\\x{a0}\\x{1680}\\x{2000}-\\x{200b}\\x{202f}\\x{205f}\\x{3000}]+"
_PAGES = "pg as (select *, 'g' || doc_id % 97 as document_id, (doc_id // 97)::int + 1 as page_number, (1880 + doc_id % 150)::int as year from qs)"
_LETTERS = {"Cyrillic": r"\x{400}-\x{52f}", "Greek": r"\x{370}-\x{3ff}", "Hebrew": r"\x{590}-\x{5ff}", "Han": r"\x{4e00}-\x{9fff}", "Latin": r"A-Za-z\x{aa}\x{ba}\x{c0}-\x{24f}"}
_CASES = """cs as (select l_orderkey || '-' || l_linenumber as case_id, l_returnflag = 'A' as pos, case l_linenumber when 1 then 'any' when 2 then 'translation' when 3 then 'semantic_kin' else 'duplicate' end as e,
  l_discount * 10 as x, l_tax * 12 as s, l_suppkey % 4 > 0 as known, l_partkey % 2 = 0 as apart from lineitem where l_returnflag in ('A', 'N'))"""
_GRID = """gr as (select (row_number() over (order by w, dup, cr, tr, wl) - 1)::int as config, dup, cr, tr, wl from (values (0.4), (0.5), (0.6)) a(w), (values (0.85::double), (0.90::double), (0.95::double)) b(dup),
  (values (0.50::double), (0.60::double), (0.70::double)) c(cr), (values (0.75::double), (0.80::double), (0.85::double)) d(tr), (values (0.60::double), (0.65::double), (0.70::double)) f(wl) where cr < dup and wl < tr)"""
_PREDICTED = """pr as (select config, pos, e, known, case when x >= dup then 'duplicate' when x >= cr then 'clause_reuse' when s >= tr and apart then 'translation' when s >= tr then 'semantic_kin' when s >= wl then 'weak_link' end as t,
  from cs, gr)"""
_COUNTS = """cc as (select config, count(*) filter (pos and (e = 'any' or coalesce(t = e, false))) as tp, count(*) filter (t is not null and not (pos and (e = 'any' or t = e))) as fp,
  count(*) filter (pos and not (e = 'any' or coalesce(t = e, false))) as fn, count(*) filter (not pos and t is null) as tn, count(*) filter (not known) as missing_pairs from pr group by config),
cf as (select *, case when tp + fp > 0 then tp / (tp + fp) else 0 end as p, case when tp + fn > 0 then tp / (tp + fn) else 0 end as r from cc),
cr as (select config, tp, fp, fn, tn, missing_pairs, round(p, 6) as precision, round(r, 6) as recall, round(case when p + r > 0 then 2 * p * r / (p + r) else 0 end, 6) as f1 from cf)"""
_HEADED = r"""hd as (select 'c' || conv_id as document_id, (turn + 1)::int as page_number, 'Conversation ' || conv_id || ' — Page ' || (turn + 1) as head, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) as body,
  case when turn % 2 = 1 then 'Confidential ' || (turn + 1) end as foot from conversations),
hn as (select document_id, count(*) as n, count(*) filter (foot is not null) as f from hd group by 1)"""

SQL = {
    "normalised_text": f"""with r as (select c_custkey, c_name, c_mktsegment, chr(9) || ' ' || c_name || ' —  ' || c_custkey || chr(173) || '; E' || chr(769) || 'te' || chr(769) || ' ' || c_mktsegment || chr(65279) || ' ' as raw from customer),
        l as (select *, trim(replace(replace(regexp_replace(nfc_normalize(raw), '{_BLANKS}', ' ', 'g'), chr(173), ''), chr(65279), '')) as line from r)
        select c_custkey, line, trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '#', 'g'), '[^\\p{{L}}\\p{{N}}_#]+', ' ', 'g')) as line_key,
        trim(regexp_replace(lower(nfc_normalize(raw)), '[\\s\\x{{a0}}\\x{{2009}}]+', ' ', 'g')) as compared, url_encode(c_name || '/é ' || c_mktsegment) as uri from l""",
    "scripts_languages": "with t as (select doc_id, text, repeat(['', 'Привет мир ', 'Καλημέρα ', 'שלום ', '日本 '][doc_id % 5 + 1], ceil(length(text) / 40)::int) || text as t from documents), c as ("
    + " union all ".join(f"select doc_id, '{k}' as s, length(regexp_replace(t, '[^{v}]', '', 'g')) as n, instr(regexp_replace(t, '[{v}]', chr(1), 'g'), chr(1)) as pos from t" for k, v in _LETTERS.items())
    + """), u as (select doc_id, string_agg(s, '; ' order by n desc, pos) as scripts from (select *, n / sum(n) over (partition by doc_id) as share from c) where n > 0 and share >= 0.02 group by doc_id),
        f as ("""
    + " union all ".join(f"select '{lang}' as lang, unnest(string_split('{words}', ' ')) as w" for lang, words in text._FREQUENT.items())
    + r"""), w as (select doc_id, w, count(*) as n from (select doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}]+')) as w from documents where length(trim(regexp_replace(text, '\s+', ' ', 'g'))) >= 40) group by all),
        s as (select doc_id, lang, sum(n) as n from w join f using (w) group by all), k as (select *, n / sum(n) over (partition by doc_id) as share, row_number() over (partition by doc_id order by n desc, lang) as rn from s),
        g as (select doc_id, string_agg(lang, '; ' order by rn) as languages from k where rn <= 3 and share >= 0.1 group by doc_id)
        select d.doc_id, coalesce(scripts, '') as scripts, coalesce(languages, '') as languages from documents d left join u using (doc_id) left join g using (doc_id)""",
    "chosen_readings": "with rd as (select doc_id, 'native_text' as method, 0 as seq, 0.9 as conf, case when doc_id % 2 = 0 then 0.8 else 0.2 end as cover, case when doc_id % 3 = 0 then '' when doc_id % 5 = 1 then text || '�' else text end as text from documents"
    + " union all select doc_id, 'apple_vision', 1, 0.88, 0.2, text from documents union all select doc_id, 'tesseract', 2, 0.85, 0.2, replace(text, ' ', '  ') from documents), "
    + QUALITY.replace("from documents", "from rd").replace("0.36 * 0.99", "0.36 * conf").replace("round(least(1.0", "(least(1.0").replace("77.0), 6)", "77.0))").replace("private * 0.01))), 6)", "private * 0.01))))")
    + r""", qc as (select *, seq = 0 and n >= 3 and replaced = 0 and private = 0 and printable >= 0.98 and noise <= 0.01 and quality >= 0.82 as credible, length(trim(text)) > 0 as filled,
        length(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g')) as alnums from qs),
        pg as (select doc_id, bool_or(credible and cover < 0.75) as sure, min(alnums) filter (seq > 0) >= 20 as agreed, count(*) filter (seq > 0 and filled) = 2 as pair, bool_or(filled) as any_ from qc group by 1),
        sc as (select qc.*, sure, any_, case when any_ and not sure and agreed and pair then 1.0::double end as agreement, case when not sure and any_ and seq > 0 and agreed and pair then least(1.0, quality + 0.45 * 0.08) else quality end as score from qc join pg using (doc_id)),
        tp as (select *, max(case when filled then score end) over (partition by doc_id) as top from sc),
        od as (select *, row_number() over (partition by doc_id order by case when not any_ then 0 when sure and credible and cover < 0.75 then 0 when credible and filled and score >= top - 0.03 then 1 when filled then 2 else 3 end, case when any_ then -score else 0 end, seq) as rn from tp)
        select doc_id, method, round(score, 5) as score, agreement from od where rn = 1""",
    "recurring_lines": rf"""with {_HEADED} select document_id, lower('conversation # page #') as key, n from hn where n >= 3
        union all select document_id, 'confidential #', f from hn where n >= 3 and f >= greatest(3, ceil(n * 0.4))
        union all select document_id, key, m from (select document_id, trim(regexp_replace(regexp_replace(lower(body), '[0-9]+', '#', 'g'), '[^\p{{L}}\p{{M}}\p{{N}}_#]+', ' ', 'g')) as key, count(*) as m from hd where body <> '' group by 1, 2) join hn using (document_id)
          where n >= 3 and m >= greatest(3, ceil(n * 0.4)) and length(key) >= 2""",
    "cleaned_pages": rf"""with {_HEADED}, hk as (select *, trim(regexp_replace(regexp_replace(lower(body), '[0-9]+', '#', 'g'), '[^\p{{L}}\p{{M}}\p{{N}}_#]+', ' ', 'g')) as key from hd),
        hm as (select hk.*, n, f, count(*) over (partition by document_id, key) as m from hk join hn using (document_id)),
        hg as (select *, n >= 3 as h, n >= 3 and f >= greatest(3, ceil(n * 0.4)) and foot is not null as g, n >= 3 and m >= greatest(3, ceil(n * 0.4)) and length(key) >= 2 and body <> '' as b from hm)
        select document_id, page_number, array_to_string(list_filter([case when not h then head end, case when not b and body <> '' then body end, case when not g then foot end], lambda x: x is not null), chr(10) || chr(10)) as cleaned,
        array_to_string(list_filter([case when h then head end, case when b then body end, case when g then foot end], lambda x: x is not null), ' / ') as removed from hg""",
    "release_documents": f"""with {QUALITY}, {_PAGES}, g as (select document_id, arg_min('Title ' || doc_id, page_number) as title, arg_min(lang, page_number) as doc_type, arg_min(year, page_number) as year, count(distinct source || '-' || doc_id) as aliases from pg group by 1)
        select document_id, title, doc_type, year, aliases::int as aliases, year % 3 = 0 as eligible, case year % 3 when 1 then 'rights_status=to_review' when 2 then 'rights_status=missing' end as reason,
        case doc_type when 'en' then 'treaty' when 'fr' then 'protocol' else 'unknown' end as instrument_type, null::varchar as "none" from g""",
    "documents_from_pages": f"""with {QUALITY}, {_PAGES} select document_id, arg_min('Title ' || doc_id, page_number) as title, arg_min(source, page_number) as treaty_id, arg_min(lang, page_number) as doc_type, arg_min(year, page_number) as year,
        round(round(avg(quality), 6), 5) as confidence, bool_or(quality < 0.97) as provisional, case arg_min(lang, page_number) when 'en' then 'treaty' when 'fr' then 'protocol' else 'unknown' end as instrument_type,
        case when arg_min(lang, page_number) in ('en', 'fr') then 'binding' else 'unknown' end as legal_force from pg group by 1""",
    "document_rollup": f"""with {QUALITY} select source as treaty_id, count(*) as pages, sum(length(text))::bigint as raw_chars, sum(length(trim(text)))::bigint as clean_chars, round(avg(quality), 4) as mean_quality, round(min(quality), 4) as min_quality,
        sum((quality < 0.97)::int)::bigint as review_pages, 'native_text' as methods from qs group by 1""",
    "published_documents": f"""with {QUALITY} select count(*) as documents, count(*) filter (doc_id % 7 > 0) as pages, count(*) filter (doc_id % 5 > 0) as with_title, count(*) filter (doc_id % 3 > 0 and source <> '') as with_treaty_id,
        count(*) filter (doc_id % 4 > 0) as with_year, count(*) filter (doc_id % 2 > 0 and quality < 0.97) as review_pages from qs""",
    "deduped_edges": """with e as (select 'p' || l_partkey as src, 's' || l_suppkey as dst, 'document' as level, l_returnflag as type, l_linestatus as method, l_quantity / 50 as combined from lineitem)
        select src, dst, level, type, method, max(combined) as combined from e group by all""",
    "type_mapping_differences": "select lang as value, 'unmapped' as side from documents where lang not in ('en', 'fr', 'it') group by 1 union all select v, 'unused' from (values ('en'), ('fr'), ('it')) t(v) where v not in (select lang from documents)",
    "front_matter": r"""with p as (select 'c' || conv_id as document_id, turn + 1 as p, coalesce(text, '') as t from conversations),
        m as (select document_id, '---' || chr(10) || 'document_id: ' || document_id || chr(10) || 'title: "Talk \"' || document_id || '\" \\"' || chr(10) || 'pages: ' || count(*) || chr(10) || '---' || chr(10) || chr(10)
          || string_agg('<!-- page ' || p || ' -->' || chr(10) || chr(10) || t, chr(10) || chr(10) order by p, t) || chr(10) as m from p group by 1)
        select document_id, length(m)::int as chars, md5(m) as hash from m""",
    "confusion_all": f"with {_CASES}, {_GRID}, {_PREDICTED}, {_COUNTS} select * from cr",
    "confusion_by_type": f"""with {_CASES}, gr as (select * from (values (0, 0.85::double, 0.5::double, 0.75::double, 0.35::double), (1, 0.95::double, 0.5::double, 0.75::double, 0.35::double)) v(config, dup, cr, tr, wl)), {_PREDICTED},
        h as (select *, pos and (e = 'any' or coalesce(t = e, false)) as hit from pr),
        o as (select config, e as type, 'tp' as outcome from h where hit union all select config, e, 'fn' from h where pos and not hit union all select config, t, 'fp' from h where not hit and t is not null union all select config, 'negative', 'tn' from h where not pos and t is null)
        select config, type, outcome, count(*) as n from o group by all""",
    "calibration_sweep": f"with {_CASES}, {_GRID}, {_PREDICTED}, {_COUNTS} select config, precision, recall, f1, tp, fp, fn, tn from cr order by f1 desc, precision desc, recall desc, config limit 1",
    "scored_cases": """with ps as (select 'p' || l_partkey as src, 's' || l_suppkey as dst, l_partkey as pk, l_suppkey as sk, max(l_returnflag) as f, max(l_quantity) as q from lineitem group by 1, 2, 3, 4)
        select src || dst as case_id, case f when 'R' then 'exclude' when 'A' then 'positive' else 'negative' end as label, 'any' as expected_type, case when q > 20 then q / 100 else 0 end as lexical, case when q > 20 then q / 50 else 0 end as semantic,
        q > 20 as known, sk % 3 > 0 and substr(p_type, 1, 2) <> 'EC' as apart from ps join part on p_partkey = pk""",
    "benchmark_checks": """with b as (select *, item_id as n, string_split(text, ' ') as w, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) as c from benchmark),
        k as (select item_id, n % 4 = 0 or length(text) >= 200 + n % 100 as chars_ok, n % 5 = 0 or (contains(c, lower(w[1])) and contains(c, case when n % 7 = 0 then 'nowhere' else lower(w[3]) end)) as contains_ok, n % 6 <> 0 as script_ok,
          n % 3 <> 1 or n % 2 = 0 as method_ok, n % 2 = 0 or n % 3 = 0 as review_ok from b)
        select *, chars_ok and contains_ok and script_ok and method_ok and review_ok as passed from k""",
    "representative_chunks": f"""with {QUALITY}, r as (select source || '-' || lang as document_id, doc_id as chunk_id, round(quality, 1) as quality_score, 1880 + doc_id % 150 as y from qs where length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) >= 160)
        select document_id, chunk_id, quality_score from (select *, row_number() over (partition by document_id order by quality_score desc, y, chunk_id) as rn from r) where rn = 1""",
    "band_sample": f"""with {_ED}, {{bands}} select * from b1 union all select * from b2 union all select * from b3 union all select * from b4""",
    "band_counts": f"""with {_ED}, {{bands}} select band, count(*) as n from (select * from b1 union all select * from b2 union all select * from b3 union all select * from b4) group by 1""",
    "no_edge_negatives": """with p as (select 'c' || a.n_nationkey as x, 'c' || b.n_nationkey as y from nation a join nation b on a.n_regionkey = b.n_regionkey and a.n_nationkey < b.n_nationkey),
        e as (select 'c' || n_nationkey as x, 'c' || (n_nationkey + 1) % 25 as y from nation), q as (select least(x, y) as src, greatest(x, y) as dst from p)
        select * from q where (src, dst) not in (select (least(x, y), greatest(x, y)) from e)""",
    "edge_choice": """with l as (select 'p' || l_partkey as src, 's' || l_suppkey as dst, case when l_returnflag = 'A' then 'similar_to' else 'party_to' end as type, l_quantity as quality_weight, l_orderkey || '-' || l_linenumber as method, l_orderkey * 8 + l_linenumber as seq from lineitem),
        r as (select *, row_number() over (partition by src, dst, type order by quality_weight desc, seq) as rn from l) select src, dst, type, quality_weight, method from r where rn = 1 and src not like '%7' and dst not like '%7'""",
    "type_summary": f"""with {_ED}, {_NO}, b as (select 'node' as kind, type, right(node_id, 1) = '3' as v from no union all select 'edge', type, weight > 40 from ed)
        select kind, type, count(*) as n, sum(v::int)::bigint as provisional from b group by 1, 2 union all select kind, '(all)', count(*), sum(v::int)::bigint from b group by 1""",
    "reduced_graph": f"""with {_DEG}, {_NO}, ch as (select node_id from no left join dg on node = node_id order by type = 'Place', degree desc nulls last, node_id limit 150),
        o as (select * from (select *, row_number() over (partition by src, dst order by weight desc) as rn from ed where src in (select node_id from ch) and dst in (select node_id from ch)) where rn = 1),
        r as (select src, dst, weight, row_number() over (partition by src order by weight desc, src, dst) as a, row_number() over (partition by dst order by weight desc, src, dst) as b from o)
        select src, dst, weight from r where least(a, b) <= 8""",
    "focused_view": f"""with {_ED}, {_NO}, e as (select * from ed where weight >= 10 and (src = 's1' or dst = 's1')), n as (select node_id from no where contains(lower(label), '0') and (node_id = 's1' or node_id in (select src from e) or node_id in (select dst from e)))
        select node_id, 'node' as kind from n union all select src, 'edge' from e where src in (select node_id from n) and dst in (select node_id from n)""",
    "similar_documents": f"""with {_ED}, x as (select 't' || (substr(src, 2)::int % 50) as a, dst as b, src as p, case type when 'R' then weight / 50 else weight / 100 end as score, case when type <> 'R' then type end as type from ed where weight > 5 and substr(src, 2)::int % 5 > 0),
        y as (select least(a, b) as d1, greatest(a, b) as d2, score, coalesce(type, 'similar_to') as type, row_number() over (partition by a, b order by score desc, p, b, type nulls first) as rn from x),
        z as (select d1 as document_id, d2 as other_id, score, type from y where rn = 1 union all select d2, d1, score, type from y where rn = 1),
        r as (select *, row_number() over (partition by document_id order by score desc, other_id)::int as rank from z)
        select document_id, other_id, coalesce(s_name, other_id) as title, round(score, 6) as score, type, false as provisional, rank from r left join (select 's' || s_suppkey as k, s_name from supplier where s_suppkey % 2 = 0) on k = other_id where rank <= 10""",
    "outgoing_relations": f"""with {_ED}, g as (select src as document_id, dst as other_id, type, max(weight) as score from ed group by 1, 2, 3), r as (select *, row_number() over (partition by document_id order by score desc, other_id, type)::int as rank from g) select * from r where rank <= 4""",
    "retrieval_context": """with b as (select c_nationkey as d, c_mktsegment as m, max(c_acctbal / 10000) as c from customer where c_nationkey % 6 > 0 group by 1, 2), k as (select *, row_number() over (partition by d order by c desc, m) as rk from b),
        e as (select d, string_agg(lower(m), ', ' order by rk) as e from k where rk <= 3 group by d),
        h as (select n_regionkey as q, n_nationkey as d, n_name, row_number() over (partition by n_regionkey order by n_nationkey) as rk from nation),
        t as (select q, rk, '[' || rk || '] ' || n_name || ', p. ' || (h.d + 1) || chr(10) || 'A text of ' || n_name || case when e is null then '' else chr(10) || 'entities: ' || e end || case when h.d % 4 = 0 then '' else chr(10) || 'related: ' || q end as t from h left join e on e.d = h.d)
        select q as query_id, string_agg(t, chr(10) || chr(10) order by rk) as context from t group by q""",
}


def _bands() -> str:
    out = [
        "bx as (select 'p' || (l_partkey % 10) as d1, 's' || (l_suppkey % 10) as d2, 'p' || l_partkey as src, 's' || l_suppkey as dst, l_quantity / 50 as c, md5('0|p' || l_partkey || '|s' || l_suppkey) as k from lineitem)"
    ]
    for i, (name, (low, high)) in enumerate(evaluation.BANDS.items(), 1):
        used = "".join(f" and (d1, d2) not in (select (d1, d2) from b{j})" for j in range(1, i))
        one = f"select *, row_number() over (partition by d1, d2 order by k, src, dst) as rn from bx where c >= {low}::double and c < {high}::double{used}"
        out.append(f"b{i} as (select '{name}' as band, (row_number() over (order by k, src, dst))::int as place, d1, d2, src, dst from ({one}) where rn = 1 qualify place <= 5)")
    return ", ".join(out)


SQL = {k: v.replace("{bands}", _bands()) for k, v in SQL.items()}
