"""Queries of the knowledge graph: documents with a dictionary of frequent words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.operators import graph
from corpuscle.operators.common import cut
from corpuscle.plans.base import QUALITY, joined, pages, table
from corpuscle.plans.pipelines import build_graph

#: Dictionary entries: label, aliases, qid, type.
ENTRIES = [("the", "le|der", "Q1", "Place"), ("and", "et", "", "Organization"), ("of the", "", "Q3", "Party"), ("nation", "", "Q4", "Place")]


def _entries(spark: SparkSession) -> DataFrame:
    rows = [(label, aliases, qid, "", "en", kind) for label, aliases, qid, kind in ENTRIES]
    return graph.gazetteer(spark.createDataFrame(rows, "label string, aliases string, qid string, iso3 string, lang string, type string"))


def _mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("en", "treaty", "binding"), ("fr", "protocol", "binding")], "doc_type string, instrument_type string, legal_force string")


def _graph(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return build_graph(pages(spark, d), _entries(spark), _mapping(spark))


def gazetteer_mentions(spark: SparkSession, d: str) -> DataFrame:
    m = graph.match_gazetteer(table(spark, d, "documents"), _entries(spark)).select("doc_id", F.inline("hits"))
    return m.groupBy("doc_id", "label", "type").agg(F.count("*").alias("n"), F.min("char_start").alias("first"))


def graph_nodes(spark: SparkSession, d: str) -> DataFrame:
    n = _graph(spark, d)["nodes"]
    return n.select("node_id", "type", "label", joined("aliases").alias("aliases"), "confidence", "provisional")


def graph_edges(spark: SparkSession, d: str) -> DataFrame:
    return _graph(spark, d)["edges"].select("src", "dst", "type", "level", "quality_weight", "provisional", "method")


def graph_summary(spark: SparkSession, d: str) -> DataFrame:
    return _graph(spark, d)["summary"]


def triples(spark: SparkSession, d: str) -> DataFrame:
    return _graph(spark, d)["triples"].groupBy("p", "o_kind").agg(F.count("*").alias("n"))


def pattern_match(spark: SparkSession, d: str) -> DataFrame:
    t = cut(_graph(spark, d)["triples"])
    return graph.match_patterns(t, [("?doc", "slo:sameInstrumentAs", "?instrument"), ("?instrument", "slo:aboutTopic", "?topic"), ("?topic", "rdfs:label", "?label")]).groupBy("label").agg(F.count("*").alias("documents"))


def simple_degree(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select(F.concat(F.lit("p"), "l_partkey").alias("src"), F.concat(F.lit("s"), "l_suppkey").alias("dst"))
    return graph.simple_degree(li)


def graph_layout(spark: SparkSession, d: str) -> DataFrame:
    return graph.layout(table(spark, d, "part").select(F.concat(F.lit("p"), "p_partkey").alias("node_id")))


QUERIES = [gazetteer_mentions, graph_nodes, graph_edges, graph_summary, triples, pattern_match, simple_degree, graph_layout]
_W, _N = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"
_GRAPH = QUALITY + rf""",
gp as (select 'd' || doc_id as document_id, 'Title ' || doc_id as title, source, lang, (1880 + doc_id % 150)::int as year, quality as confidence, quality < 0.97 as provisional, text, regexp_replace(text, '(?i)\bof the\b', chr(1), 'g') as rest,
  case lang when 'en' then 'treaty' when 'fr' then 'protocol' else 'unknown' end as kind from qs),
gt as (select document_id, source, provisional, unnest(regexp_extract_all(rest, '{_W}+')) as surface from gp),
gm as (select document_id, source, provisional, surface, 'ent:wd:Q1' as node, 'Place' as type, 'the' as label from gt where lower(surface) in ('the', 'le', 'der')
  union all select document_id, source, provisional, surface, 'ent:Organization:and', 'Organization', 'and' from gt where lower(surface) in ('and', 'et')
  union all select document_id, source, provisional, surface, 'ent:Place:nation', 'Place', 'nation' from gt where lower(surface) = 'nation'
  union all select document_id, source, provisional, unnest(regexp_extract_all(text, '(?i)\bof the\b')), 'ent:wd:Q3', 'Party', 'of the' from gp),
gn as (select 'doc:' || document_id as node_id, 'Document' as type, title as label, document_id as aliases, confidence, provisional, year from gp
  union all select 'instr:' || source, 'Instrument', arg_min(title, document_id), source, arg_max(confidence, document_id), bool_or(provisional), arg_max(year, document_id) from gp group by source
  union all select node, type, label, array_to_string(list_sort(list(distinct surface)), '; '), 0.95, bool_or(provisional), null from gm group by node, type, label
  union all select distinct 'ent:TopicConcept:instrument_type_' || kind, 'TopicConcept', 'instrument_type:' || kind, '', 1.0, false, null::int from gp),
ge as (select 'doc:' || document_id as src, 'instr:' || source as dst, 'same_instrument_as' as type, 'document' as level, confidence as quality_weight, provisional, 'metadata:treaty_id' as method from gp
  union all select case type when 'Party' then node else 'instr:' || source end, case type when 'Party' then 'instr:' || source else node end, case type when 'Party' then 'party_to' when 'Organization' then 'issued_by' else 'signed_at' end, 'entity', 0.95,
    arg_min(provisional, document_id || ':'), 'gazetteer' from gm group by node, type, source
  union all select distinct 'instr:' || source, 'ent:TopicConcept:instrument_type_' || kind, 'about_topic', 'entity', 1.0, false, 'doc_type_mapping' from gp)"""
SQL = {
    "gazetteer_mentions": rf"""with x as (select doc_id, ' ' || regexp_replace(lower(text), '\bof the\b', repeat(chr(1), 6), 'g') || ' ' as t from documents),
        k as (select doc_id, t, regexp_extract_all(t, '{_W}+') as w from x),
        e as (select * from (values ('the', 'Place', '(?:the|le|der)', ['the', 'le', 'der']), ('and', 'Organization', '(?:and|et)', ['and', 'et']), ('nation', 'Place', 'nation', ['nation'])) v(label, type, p, s)),
        n as (select doc_id, label, type, len(list_filter(w, lambda y: list_contains(s, y))) as n,
            length(case label when 'the' then regexp_extract(t, '(?s)^(.*?{_N})(?:the|le|der){_N}', 1) when 'and' then regexp_extract(t, '(?s)^(.*?{_N})(?:and|et){_N}', 1) else regexp_extract(t, '(?s)^(.*?{_N})nation{_N}', 1) end) - 1 as first from k, e
          union all select doc_id, 'of the', 'Party', ((length(t) - length(replace(t, chr(1), ''))) / 6)::int, instr(t, chr(1)) - 2 from x)
        select doc_id, label, type, n::bigint as n, first::int as first from n where n > 0""",
    "graph_layout": """with n as (select 'p' || p_partkey as node_id from part order by 1 limit 10000),
        h as (select node_id, sqrt(('0x' || substr(md5('r|' || node_id), 1, 8))::bigint / 4294967296) as r, ('0x' || substr(md5('a|' || node_id), 1, 8))::bigint / 4294967296 * 2 * 3.141592653589793::double as a from n)
        select node_id, round(r * cos(a), 6) as x, round(r * sin(a), 6) as y from h""",
    "graph_nodes": f"with {_GRAPH} select node_id, type, label, aliases, confidence, provisional from gn",
    "graph_edges": f"with {_GRAPH} select src, dst, type, level, quality_weight, provisional, method from ge",
    "graph_summary": f"""with {_GRAPH}, b as (select 'node' as kind, type, provisional from gn union all select 'edge', type, provisional from ge)
        select kind, type, count(*) as n, sum(provisional::int)::bigint as provisional from b group by 1, 2 union all select kind, null, count(*), sum(provisional::int)::bigint from b group by 1""",
    "triples": f"""with {_GRAPH}, l as (select count(*) as n from ge where type = 'same_instrument_as'), c as (select count(*) as n from gn)
        select 'rdf:type' as p, 'uri' as o_kind, (select n from c) + n as n from l union all select 'rdfs:label', 'literal', n from c union all select 'slo:qualityScore', 'literal', n from c
        union all select 'slo:provisional', 'literal', (select n from c) + n from l union all select 'slo:src', 'uri', n from l union all select 'slo:dst', 'uri', n from l union all select 'slo:linkType', 'literal', n from l
        union all select 'owl:sameAs', 'uri', count(*) from gn where node_id like 'ent:wd:%' having count(*) > 0 union all select 'schema:datePublished', 'literal', count(*) from gn where year is not null
        union all select case type when 'same_instrument_as' then 'slo:sameInstrumentAs' when 'party_to' then 'slo:partyTo' when 'issued_by' then 'slo:issuedBy' when 'signed_at' then 'slo:signedAt' else 'slo:aboutTopic' end, 'uri', count(*) from ge group by 1""",
    "pattern_match": f"with {_GRAPH} select 'instrument_type:' || replace(t.dst, 'ent:TopicConcept:instrument_type_', '') as label, count(distinct (e.src, e.dst)) as documents from ge e join ge t on t.src = e.dst and t.type = 'about_topic' where e.type = 'same_instrument_as' group by 1",
    "simple_degree": """with e as (select distinct 'p' || l_partkey as a, 's' || l_suppkey as b from lineitem) select node, count(*) as degree from (select a as node from e union all select b from e) group by node""",
}
