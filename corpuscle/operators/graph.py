"""The knowledge graph: mentions, nodes, edges, triples and their summaries."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.functions import ids
from corpuscle.functions.dates import extract_dates
from corpuscle.functions.text import each, uri_component
from corpuscle.operators.common import first_by, small

VERSION = "1"
_WORD = re.compile(r"\w")
MIN_CONFIDENCE = 0.70
UNKNOWN = ("unknown", "unknown")
_HIT = pa.list_(pa.struct([(c, pa.string()) for c in ("label", "type", "qid", "surface")] + [(c, pa.int32()) for c in ("char_start", "char_end")]))


def gazetteer(rows: DataFrame) -> DataFrame:
    """Dictionary entries from CSV text: trimmed, empty as null, aliases split; a malformed QID raises."""
    t = lambda c: F.when(F.trim(c) != "", F.trim(c))
    alias = F.filter(F.transform(F.split(F.coalesce("aliases", F.lit("")), r"\|"), lambda a: F.trim(a)), lambda a: a != "")
    bad = F.raise_error(F.concat(F.lit("malformed QID "), F.col("qid"))).cast("string")
    qid = F.when(t("qid").isNull() | t("qid").rlike(ids.QID), t("qid")).otherwise(bad)
    return rows.select(F.coalesce(t("label"), F.lit("")).alias("label"), alias.alias("aliases"), qid.alias("qid"), t("iso3").alias("iso3"), t("lang").alias("lang"), F.coalesce(t("type"), F.lit("")).alias("type"))


def drop_overlaps(hits: list[tuple]) -> list[tuple]:
    """Of overlapping (start, end, label, …) the longest stay, then the first; in text order."""
    hits = sorted(hits, key=lambda h: h[:3])
    if all(a[1] <= b[0] for a, b in zip(hits, hits[1:], strict=False)):
        return hits
    taken, kept = set(), []
    for hit in sorted(hits, key=lambda h: (h[0] - h[1], h[0], h[2])):
        span = range(hit[0], hit[1])
        if taken.isdisjoint(span):
            taken.update(span)
            kept.append(hit)
    return sorted(kept, key=lambda h: h[:3])


def match_gazetteer(pages: DataFrame, entries: DataFrame, text_col: str = "text") -> DataFrame:
    """pages with `hits`: whole-word, case-blind finds of all names of the entries, without overlaps.

    The dictionary is collected: it is one of names, checked to be under 200,000 rows, and its names become one alternation.
    """
    rows = entries.select("label", "type", "qid", F.explode(F.array_distinct(F.concat(F.array("label"), "aliases"))).alias("surface")).where("surface <> ''")
    if rows.limit(200_001).count() > 200_000:
        raise ValueError("a dictionary of more than 200,000 names needs a join on tokens instead")
    by: dict[str, list[tuple]] = {}
    for r in rows.collect():
        by.setdefault(r["surface"].lower(), []).append((r["label"], r["type"], r["qid"]))
    shared = pages.sparkSession.sparkContext.broadcast(by)

    # overlapping finds of different names matter for the choice: each place is tried with the longest name, then with its beginnings
    ready: dict = {}

    def one(t: str | None) -> list[dict]:
        names = shared.value
        if not ready:  # in each worker
            ready["words"] = re.compile(r"(?<!\w)(?=(" + "|".join(re.escape(n) for n in sorted(names, key=len, reverse=True)) + r")(?!\w))", re.I) if names else None
            ready["lengths"] = sorted({len(n) for n in names})
        words, lengths, hits = ready["words"], ready["lengths"], []
        for m in words.finditer(t or "") if words else []:
            whole = t[m.start() : m.start() + len(m[1])].lower()
            for n in lengths:
                name, end = whole[:n], m.start() + n
                if n <= len(whole) and name in names and not (end < len(t) and _WORD.match(t[end])):
                    hits += [(m.start(), end, label, kind, qid, t[m.start() : end]) for label, kind, qid in names[name]]
        return [{"label": h[2], "type": h[3], "qid": h[4], "surface": h[5], "char_start": h[0], "char_end": h[1]} for h in drop_overlaps(hits)]

    find = each(one, _HIT, nulls=False)
    return pages.withColumn("hits", find(F.col(text_col)))


def mentions(pages: DataFrame, entries: DataFrame, least: float = MIN_CONFIDENCE) -> DataFrame:
    """Dictionary and date mentions of pages that aren't blank, of at least this confidence."""
    rows = match_gazetteer(pages.where(F.coalesce("text", F.lit("")).rlike(r"(?U)\S")), entries)
    none = F.lit(None).cast("string")
    date = F.transform(extract_dates(F.col("text")), lambda d: F.struct(
        F.lit("TopicConcept").alias("type"), d["surface"].alias("surface"), F.concat(F.lit("date:"), d["iso_date"]).alias("canonical_hint"), none.alias("qid"),
        d["char_start"].alias("char_start"), d["char_end"].alias("char_end"), d["confidence"].alias("confidence"), F.lit("date_regex").alias("method"),
    ))
    name = F.transform("hits", lambda h: F.struct(
        h["type"].alias("type"), h["surface"].alias("surface"), h["label"].alias("canonical_hint"), h["qid"].alias("qid"), h["char_start"].alias("char_start"),
        h["char_end"].alias("char_end"), F.lit(0.95).alias("confidence"), F.lit("gazetteer").alias("method"),
    ))
    provisional = F.coalesce(F.col("review_required"), F.lit(False)) | (F.coalesce("review_priority", F.lit("")) == "high")
    rows = rows.select("document_id", "treaty_id", "source_sha256", "page_number", provisional.alias("provisional"), F.coalesce("pipeline_version", F.lit("")).alias("pipeline_version"), F.inline(F.concat(name, date)))
    id_ = ids.mention_id(*[F.col(c) for c in ("document_id", "page_number", "char_start", "char_end", "type", "surface")])
    return rows.withColumn("mention_id", id_).where(F.col("confidence") >= least)


def documents_from_pages(pages: DataFrame) -> DataFrame:
    """A row per document: the attributes of its first page, mean quality as confidence, provisional if any page needs review."""
    first = F.min_by(F.struct("source_sha256", "title", "treaty_id", "doc_type", "year", "pipeline_version"), F.struct("page_number", "source_sha256"))
    out = pages.groupBy("document_id").agg(
        first.alias("f"), F.round(F.avg(F.coalesce("quality_score", F.lit(0.0))), 6).alias("confidence"), F.bool_or(F.coalesce("review_required", F.lit(False))).alias("provisional")
    )
    filled = lambda c, d: F.coalesce(F.when(F.col(f"f.{c}") != "", F.col(f"f.{c}")), d).alias(c)
    return out.select(
        "document_id", "f.source_sha256", filled("title", F.col("document_id")), "f.treaty_id", filled("doc_type", F.lit("Inconnu")), "f.year",
        filled("pipeline_version", F.lit(VERSION)), "confidence", "provisional",
    )


def with_mapping(documents: DataFrame, mapping: DataFrame) -> DataFrame:
    """documents with instrument_type and legal_force of their type, unknown where the mapping (doc_type, …) lacks it."""
    out = documents.join(small(mapping), "doc_type", "left")
    return out.withColumns({c: F.coalesce(c, F.lit("unknown")) for c in ("instrument_type", "legal_force")})


def _tags() -> Column:
    pair = lambda c: F.concat(F.lit(c + ":"), c)
    return F.array_sort(F.array(pair("doc_type"), pair("instrument_type"), pair("legal_force"), F.lit("source_db:corpus")))


def link_mentions(found: DataFrame) -> DataFrame:
    """Mentions with the id of the node that they mean."""
    dated = (F.col("type") == "TopicConcept") & F.col("canonical_hint").startswith("date:")
    topic = F.concat(F.lit("ent:TopicConcept:"), ids.slug(F.col("canonical_hint")))
    return found.withColumn("node_id", F.when(dated, topic).otherwise(ids.entity_node(F.col("type"), ids.slug(F.col("canonical_hint")), F.col("qid"))))


def nodes(documents: DataFrame, linked: DataFrame) -> DataFrame:
    """Document, instrument, topic and entity nodes.

    documents is what with_mapping gives, linked what link_mentions gives.  Instruments merge the documents of a treaty in the
    order of their ids: first title, last confidence, latest year that is known.  Entities merge their mentions in the order of
    document, page and place: first label, last QID, highest confidence.  All aliases and tags stay.
    """
    none, no_int, empty = F.lit(None).cast("string"), F.lit(None).cast("int"), F.array().cast("array<string>")
    columns = ("node_id", "type", "label", "aliases", "wikidata_qid", "document_id", "source_sha256", "year", "confidence", "provisional", "pipeline_version", "tags")
    pick = lambda df, **v: df.select(*[v[c].alias(c) if c in v else F.col(c) for c in columns])
    docs = documents.withColumn("tags", _tags())
    document = pick(docs, node_id=ids.document_node(F.col("document_id")), type=F.lit("Document"), label=F.col("title"), aliases=F.array("document_id"), wikidata_qid=none)
    with_treaty = docs.where("coalesce(treaty_id, '') <> ''")
    instrument = with_treaty.groupBy("treaty_id").agg(
        F.min_by("title", "document_id").alias("label"), F.max_by("confidence", "document_id").alias("confidence"), F.bool_or("provisional").alias("provisional"),
        F.max_by("year", F.when(F.col("year").isNotNull(), F.col("document_id"))).alias("year"), F.max_by("pipeline_version", "document_id").alias("pipeline_version"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("tags")))).alias("tags"),
    )
    instrument = pick(instrument, node_id=ids.instrument_node(F.col("treaty_id")), type=F.lit("Instrument"), aliases=F.array("treaty_id"), wikidata_qid=none, document_id=none, source_sha256=none)
    entity = linked.groupBy("node_id").agg(
        F.max_by("type", F.struct("document_id", "page_number", "char_start", "mention_id")).alias("type"),
        F.min_by(F.regexp_replace("canonical_hint", "date:", ""), F.struct("document_id", "page_number", "char_start", "mention_id")).alias("label"),
        F.sort_array(F.collect_set("surface")).alias("aliases"), F.max_by("qid", F.struct("document_id", "page_number", "char_start", "mention_id")).alias("wikidata_qid"),
        F.max("confidence").alias("confidence"), F.bool_or("provisional").alias("provisional"),
        F.max_by("pipeline_version", F.struct("document_id", "page_number", "char_start", "mention_id")).alias("pipeline_version"),
    )
    entity = pick(entity, document_id=none, source_sha256=none, year=no_int, tags=empty)
    topic = with_treaty.select("instrument_type").distinct().withColumn("t", F.concat(F.lit("instrument_type:"), "instrument_type"))
    topic = pick(
        topic, node_id=_topic_node(), type=F.lit("TopicConcept"), label=F.col("t"), aliases=empty, wikidata_qid=none, document_id=none, source_sha256=none, year=no_int,
        confidence=F.lit(1.0), provisional=F.lit(False), pipeline_version=F.lit(VERSION), tags=F.array("t"),
    )
    both = topic.withColumn("o", F.lit(0)).unionByName(entity.withColumn("o", F.lit(1)))
    merged = both.groupBy("node_id").agg(
        F.max_by("type", "o").alias("type"), F.min_by("label", "o").alias("label"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("aliases")))).alias("aliases"),
        F.max_by("wikidata_qid", "o").alias("wikidata_qid"), F.max("confidence").alias("confidence"), F.bool_or("provisional").alias("provisional"),
        F.max_by("pipeline_version", "o").alias("pipeline_version"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("tags")))).alias("tags"),
    )
    merged = pick(merged, document_id=none, source_sha256=none, year=no_int)
    return document.unionByName(instrument).unionByName(merged)


def _topic_node() -> Column:
    return F.concat(F.lit("ent:TopicConcept:instrument_type_"), ids.ascii_slug(F.col("instrument_type")))


def add_edges(edges: DataFrame, order: str = "seq") -> DataFrame:
    """Per key the edge of the highest quality weight, the first in `order` on ties; the order goes."""
    key = ids.edge_key(F.col("src"), F.col("dst"), F.col("type"))
    weight = F.coalesce("quality_weight", F.lit(0.0))
    return first_by(edges.withColumn("__key", key), ["__key"], weight.desc(), order, "src", "dst", "evidence").drop("__key", order)


#: By mention type: the edge type, and whether it points to the instrument.
MENTION_EDGES = {"Party": ("party_to", True), "Organization": ("issued_by", False), "Place": ("signed_at", False), "TopicConcept": ("dated", False)}


def edges(nodes_: DataFrame, documents: DataFrame, linked: DataFrame, document_edges: DataFrame | None = None) -> DataFrame:
    """Edges from documents to instruments, of mentions, to topics, and imported document edges; both ends are nodes."""
    none = F.lit(None).cast("double")
    treaty = documents.where("coalesce(treaty_id, '') <> ''").withColumn("instr", ids.instrument_node(F.col("treaty_id")))
    tail = lambda *e: [none.alias("lexical"), none.alias("semantic"), none.alias("combined"), *e]
    first = treaty.select(
        F.lit(0).alias("seq"), ids.document_node(F.col("document_id")).alias("src"), F.col("instr").alias("dst"), F.lit("document").alias("level"), F.lit("same_instrument_as").alias("type"),
        *tail(F.col("confidence").alias("quality_weight"), "provisional", F.lit("metadata:treaty_id").alias("method"), F.concat(F.lit("treaty_id="), "treaty_id").alias("evidence"), "pipeline_version"),
    )
    m = linked.drop("treaty_id", "pipeline_version").join(treaty.select("document_id", "instr", "pipeline_version"), "document_id")
    m = m.where((F.col("type") != "TopicConcept") | F.col("node_id").startswith("ent:TopicConcept:date_"))
    kind = F.create_map(*[F.lit(x) for k, (e, _) in MENTION_EDGES.items() for x in (k, e)])[F.col("type")]
    to = F.col("type") == "Party"
    span = F.format_string("%s:p%04d:%d-%d", "document_id", "page_number", "char_start", "char_end")
    second = m.where(F.col("type").isin(*MENTION_EDGES)).select(
        F.lit(1).alias("seq"), F.when(to, F.col("node_id")).otherwise(F.col("instr")).alias("src"), F.when(to, F.col("instr")).otherwise(F.col("node_id")).alias("dst"),
        F.lit("entity").alias("level"), kind.alias("type"), *tail(F.col("confidence").alias("quality_weight"), "provisional", "method", span.alias("evidence"), "pipeline_version"),
    )
    third = treaty.select(
        F.lit(2).alias("seq"), F.col("instr").alias("src"), _topic_node().alias("dst"), F.lit("entity").alias("level"), F.lit("about_topic").alias("type"),
        *tail(F.lit(1.0).alias("quality_weight"), F.lit(False).alias("provisional"), F.lit("doc_type_mapping").alias("method"), F.lit("doc_type_mapping").alias("evidence"), F.lit(VERSION).alias("pipeline_version")),
    )
    every = first.unionByName(second).unionByName(third)
    if document_edges is not None:
        every = every.unionByName(document_edges.select(F.lit(3).alias("seq"), *[c for c in every.columns if c != "seq"]))
    return with_ends(add_edges(every), nodes_)


def with_ends(edges_: DataFrame, nodes_: DataFrame) -> DataFrame:
    """Edges both ends of which are nodes."""
    have = nodes_.select("node_id")
    return edges_.join(have.withColumnRenamed("node_id", "src"), "src", "left_semi").join(have.withColumnRenamed("node_id", "dst"), "dst", "left_semi")


def graph_summary(nodes_: DataFrame, edges_: DataFrame) -> DataFrame:
    """(kind, type, n, provisional): counts by type and, with a null type, of all nodes and edges."""
    both = nodes_.select(F.lit("node").alias("kind"), "type", "provisional").unionByName(edges_.select(F.lit("edge").alias("kind"), "type", "provisional"))
    return both.groupingSets([["kind", "type"], ["kind"]], "kind", "type").agg(F.count("*").alias("n"), F.sum(F.col("provisional").cast("int")).alias("provisional"))


def simple_degree(edges_: DataFrame) -> DataFrame:
    """(node, degree): parallel edges count once whatever their direction, a loop twice."""
    pairs = edges_.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))


# ---- triples

#: Predicates by edge type; other types are references.
PREDICATES = {
    "party_to": "partyTo", "signed_at": "signedAt", "issued_by": "issuedBy", "dated": "dated", "amends": "amends", "supersedes": "supersedes", "translation_of": "translationOf",
    "same_instrument_as": "sameInstrumentAs", "similar_to": "similarTo", "about_topic": "aboutTopic", "translation": "translation",
}
_LINKED = ("similar_to", "translation", "same_instrument_as")


def triples(nodes_: DataFrame, edges_: DataFrame, base: str = "urn:corpus:") -> DataFrame:
    """(s, p, o, o_kind, datatype): nodes' properties, edges, and links with scores as nodes of their own; each triple once."""

    def uri(c: str) -> Column:
        return F.concat(F.lit(base), uri_component(F.col(c)))

    def rows(df: DataFrame, s: Column, items: list[tuple]) -> DataFrame:
        none = F.lit(None).cast("string")
        made = [F.when(when, F.struct(F.lit(p).alias("p"), o.cast("string").alias("o"), F.lit(kind).alias("o_kind"), (F.lit(t) if t else none).alias("datatype"))) for p, o, kind, t, when in items]
        return df.select(s.alias("s"), F.inline(F.array_compact(F.array(*made))))

    always, n = F.lit(True), nodes_
    node_rows = rows(n, uri("node_id"), [
        ("rdf:type", F.concat(F.lit("slo:"), F.col("type")), "uri", None, always), ("rdfs:label", F.col("label"), "literal", None, always),
        ("owl:sameAs", F.concat(F.lit("http://www.wikidata.org/entity/"), F.col("wikidata_qid")), "uri", None, F.coalesce("wikidata_qid", F.lit("")) != ""),
        ("schema:datePublished", F.col("year"), "literal", "xsd:gYear", F.col("year").isNotNull()), ("slo:qualityScore", F.col("confidence"), "literal", "xsd:double", F.col("confidence").isNotNull()),
        ("slo:provisional", F.coalesce(F.col("provisional"), F.lit(False)), "literal", "xsd:boolean", always),
    ])
    e = edges_.withColumn("s", uri("src")).withColumn("d", uri("dst"))
    name = F.coalesce(F.create_map(*[F.lit(x) for kv in PREDICATES.items() for x in kv])[F.col("type")], F.lit("references"))
    edge_rows = e.select("s", F.concat(F.lit("slo:"), name).alias("p"), F.col("d").alias("o"), F.lit("uri").alias("o_kind"), F.lit(None).cast("string").alias("datatype"))
    link = e.where(F.col("combined").isNotNull() | F.col("type").isin(*_LINKED))
    link_rows = rows(link, F.concat(F.lit("_:"), F.sha2(F.concat_ws("|", "src", "type", "dst"), 256)), [
        ("rdf:type", F.lit("slo:SimilarityLink"), "uri", None, always), ("slo:src", F.col("s"), "uri", None, always), ("slo:dst", F.col("d"), "uri", None, always),
        ("slo:linkType", F.col("type"), "literal", None, always), ("slo:weight", F.col("combined"), "literal", "xsd:double", F.col("combined").isNotNull()),
        ("slo:provisional", F.coalesce(F.col("provisional"), F.lit(False)), "literal", "xsd:boolean", always),
    ])
    return node_rows.unionByName(edge_rows).unionByName(link_rows).distinct()


_DENIED = ("insert", "delete", "load", "clear", "create", "drop", "copy", "move", "add", "service")


def match_patterns(triples_: DataFrame, patterns: list[tuple[str, str, str]]) -> DataFrame:
    """Solutions of a basic graph pattern: terms that begin with "?" are variables; joins on the variables in common."""
    out: DataFrame | None = None
    for pattern in patterns:
        step, kept = triples_, {}
        for column, term in zip("spo", pattern, strict=True):
            if not term.startswith("?"):
                step = step.where(F.col(column) == term)
            elif term[1:] in kept:
                step = step.where(F.col(column) == F.col(kept[term[1:]]))
            else:
                kept[term[1:]] = column
        step = step.select(*[F.col(c).alias(v) for v, c in kept.items()]).distinct()
        if out is None:
            out = step
        else:
            common = [c for c in step.columns if c in out.columns]
            out = out.join(step, common) if common else out.crossJoin(step)
    return out


_TOKEN = re.compile(r"""\s*(?:(\?\w+)|<([^>]*)>|"((?:[^"\\]|\\.)*)"|([A-Za-z_][\w-]*:[\w.-]*|a\b|\w+|\*)|([{}.;,]))""")


def select(triples_: DataFrame, query: str) -> DataFrame:
    """The solutions of a SELECT query text: variables or *, DISTINCT, a block of triple patterns with ; and , and LIMIT.

    Updates are refused.  Terms are variables, <iris>, prefixed names as the triples have them, "literals" and `a` for the type.
    """
    if not is_read_only(query):
        raise ValueError("only queries that read are allowed")
    words, at = [], 0
    text = re.sub(r"(?im)^\s*prefix\s+\S+\s+<[^>]*>", "", query).strip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"can't read {text[at : at + 20]!r}")
        words.append(next((kind, x) for kind, x in zip("vilnp", m.groups(), strict=True) if x is not None))
        at = m.end()
    plain = [x.lower() if kind == "n" else x for kind, x in words]
    if plain[0] != "select" or "{" not in plain or "}" not in plain:
        raise ValueError("a query is SELECT … WHERE { … }")
    begin, end = plain.index("{"), plain.index("}")
    shown = [x[1:] for kind, x in words[1:begin] if kind == "v"]
    patterns, part = [], []
    for kind, x in [*words[begin + 1 : end], ("p", ".")]:
        if kind != "p":
            part.append("rdf:type" if (kind, x) == ("n", "a") else x)
            continue
        if len(part) == 3:
            patterns.append(tuple(part))
        elif part:
            raise ValueError(f"a pattern has three terms, not {part}")
        part = part[:2] if x == "," else part[:1] if x == ";" else []
    out = match_patterns(triples_, patterns)
    out = out.select(*shown) if shown else out
    out = out.distinct() if "distinct" in plain[:begin] else out
    return out.limit(int(plain[plain.index("limit") + 1])) if "limit" in plain[end:] else out


def is_read_only(query: str) -> bool:
    """Whether a SPARQL text is a query and has no word of an update; whole words count, unlike "created"."""
    words = re.findall(r"\w+", query.lower())
    return not set(words) & set(_DENIED) and any(w in words for w in ("select", "ask", "construct", "describe"))


def layout(nodes_: DataFrame, limit: int = 10_000) -> DataFrame:
    """Coordinates on the unit disc from hashes of the ids, for the first nodes in id order: the same in every run."""
    first = nodes_.orderBy("node_id").limit(limit)
    part = lambda salt: F.conv(F.substring(F.md5(F.concat(F.lit(salt + "|"), "node_id")), 1, 8), 16, 10).cast("long") / float(1 << 32)
    r, a = F.sqrt(part("r")), part("a") * 2 * 3.141592653589793
    return first.select("*", F.round(r * F.cos(a), 6).alias("x"), F.round(r * F.sin(a), 6).alias("y"))
