"""Read-side operators: site data, graph views, search, retrieval context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.functions.text import excerpt, search_tokens
from corpuscle.operators.common import first_by, ordered_pair, small, top_by

#: Node types in the order in which they spend a view's budget.
PRIORITY = ["Document", "Organization", "Party", "Place", "Instrument", "TopicConcept"]


def endpoint_documents(edges: DataFrame, chunks: DataFrame) -> DataFrame:
    """Edges with the documents d1 and d2 of their ends, which are `doc:` nodes or chunks; loops and unknown ends go."""
    of = chunks.select("chunk_id", "document_id")

    def side(df: DataFrame, end: str, out: str) -> DataFrame:
        m = of.select(F.col("chunk_id").alias(end), F.col("document_id").alias("__d"))
        own = F.when(F.col(end).startswith("doc:"), F.expr(f"replace({end}, 'doc:', '')"))
        return df.join(m, end, "left").withColumn(out, F.coalesce(own, "__d")).drop("__d")

    return side(side(edges, "src", "d1"), "dst", "d2").where("d1 is not null and d2 is not null and d1 <> d2")


def edge_score() -> Column:
    """The first of combined, semantic and lexical that isn't null or zero."""
    return F.coalesce(*[F.when(F.col(c) != 0, F.col(c)) for c in ("combined", "semantic", "lexical")], F.lit(0.0))


def similar_documents(edges: DataFrame, chunks: DataFrame, titles: DataFrame, k: int = 10) -> DataFrame:
    """(document_id, other_id, title, score, type, provisional, rank): of each document the k best others, in both directions."""
    rows = ordered_pair(endpoint_documents(edges, chunks).withColumn("score", edge_score()), "d1", "d2")
    best = first_by(rows, ["d1", "d2"], F.desc("score"), "src", "dst", "type").select("d1", "d2", "score", F.coalesce("type", F.lit("similar_to")).alias("type"), F.coalesce("provisional", F.lit(False)).alias("provisional"))
    ends = F.array(F.struct(F.col("d1").alias("document_id"), F.col("d2").alias("other_id")), F.struct(F.col("d2").alias("document_id"), F.col("d1").alias("other_id")))
    both = best.select("score", "type", "provisional", F.inline(ends))
    both = top_by(both, ["document_id"], k, F.desc("score"), "other_id", rank="rank")
    names = titles.select(F.col("document_id").alias("other_id"), "title")
    return both.join(names, "other_id", "left").withColumn("title", F.coalesce("title", "other_id"))


def weighted_degree(edges: DataFrame) -> DataFrame:
    """(node, degree): sums of weights over both ends; a weight of null or 0 counts 1."""
    w = F.coalesce(F.when(F.col("weight") != 0, F.col("weight")), F.lit(1.0))
    return edges.select(F.explode(F.array("src", "dst")).alias("node"), w.alias("w")).groupBy("node").agg(F.round(F.sum("w"), 6).alias("degree"))


def node_budget(nodes: DataFrame, edges: DataFrame, limit: int) -> DataFrame:
    """The first `limit` nodes by type priority, then degree, then id."""
    order = F.create_map(*[F.lit(x) for i, t in enumerate(PRIORITY) for x in (t, i)])
    rows = nodes.join(weighted_degree(edges).withColumnRenamed("node", "node_id"), "node_id", "left").withColumn("degree", F.coalesce("degree", F.lit(0.0)))
    return rows.orderBy(F.coalesce(order[F.col("type")], F.lit(len(PRIORITY))), F.when(order[F.col("type")].isNull(), F.col("type")), F.desc("degree"), "node_id").limit(limit)


def edge_cap(edges: DataFrame, cap: int = 8) -> DataFrame:
    """Unordered pairs, strongest first, unless both ends already have `cap` edges.

    An edge is skipped only when both ends are full, so skipping never changes what is full: an edge stays exactly if its rank
    among the edges of either end is at most the cap.  That takes one pass of ranks over the doubled edges.
    """
    pairs = edges.where("src <> dst").withColumn("w", F.coalesce("weight", F.lit(0.0))).withColumn("a", F.least("src", "dst")).withColumn("b", F.greatest("src", "dst"))
    one = first_by(pairs, ["a", "b"], F.desc("w"), "src", "dst")
    ends = one.withColumn("end", F.explode(F.array("a", "b")))
    ranked = ends.withColumn("rank", F.row_number().over(Window.partitionBy("end").orderBy(F.desc("w"), "a", "b")))
    keep = ranked.groupBy("a", "b").agg(F.min("rank").alias("rank"), F.first("src").alias("src"), F.first("dst").alias("dst"), F.first("weight").alias("weight"))
    return keep.where(F.col("rank") <= cap).select("src", "dst", "weight")


def reduce_graph(nodes: DataFrame, edges: DataFrame, max_nodes: int = 6000, cap: int = 8) -> tuple[DataFrame, DataFrame]:
    """The nodes of the budget and the capped edges among them."""
    chosen = node_budget(nodes, edges, max_nodes)
    have = chosen.select("node_id")
    inner = edges.join(have.withColumnRenamed("node_id", "src"), "src", "left_semi").join(have.withColumnRenamed("node_id", "dst"), "dst", "left_semi")
    return chosen, edge_cap(inner, cap)


def graph_view(nodes: DataFrame, edges: DataFrame, hidden_nodes: list[str] = (), hidden_edges: list[str] = (), least: float = 0.0, label: str = "", focus: str | None = None) -> tuple[DataFrame, DataFrame]:
    """What a view shows: node and edge types not hidden, weights from `least` on, labels that contain a text, a node's neighbourhood."""
    n = nodes.where(~F.col("type").isin(*hidden_nodes)) if hidden_nodes else nodes
    e = edges.where(~F.col("type").isin(*hidden_edges)) if hidden_edges else edges
    e = e.where(F.coalesce("weight", F.lit(0.0)) >= least)
    if label:
        n = n.where(F.contains(F.lower("label"), F.lit(label.lower())))
    if focus is not None:
        e = e.where((F.col("src") == focus) | (F.col("dst") == focus))
        near = e.select(F.explode(F.array("src", "dst")).alias("node_id")).distinct()
        n = n.join(near, "node_id", "left_semi").unionByName(n.where(F.col("node_id") == focus)).dropDuplicates(["node_id"])
    have = n.select("node_id")
    return n, e.join(have.withColumnRenamed("node_id", "src"), "src", "left_semi").join(have.withColumnRenamed("node_id", "dst"), "dst", "left_semi")


def document_summary(pages: DataFrame) -> DataFrame:
    """Per document: languages, mean quality, review flag and highest priority, text of all pages in order, preview."""
    order = F.sort_array(F.collect_list(F.struct("page_number", F.coalesce("text", F.lit("")).alias("t"))))
    out = pages.groupBy("document_id").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("language")))).alias("languages"), F.round(F.avg("quality_score"), 6).alias("quality_score"),
        F.bool_or("review_required").alias("review_required"), F.max(F.when(F.col("review_priority") == "high", 2).when(F.col("review_priority") == "normal", 1).otherwise(0)).alias("p"),
        F.array_join(F.transform(order, lambda x: x["t"]), "\n").alias("text"), F.count("*").alias("pages"),
    )
    return out.withColumn("review_priority", F.element_at(F.array(F.lit("none"), F.lit("normal"), F.lit("high")), F.col("p") + 1)).withColumn("text_preview", excerpt(F.col("text"))).drop("p")


def facets(docs: DataFrame, columns: list[str]) -> DataFrame:
    """(facet, value, n): the distinct values of columns, arrays by element, with how many documents have them."""

    def values(c: str) -> Column:
        own = F.col(c) if docs.schema[c].dataType.typeName() == "array" else F.array(c)
        return F.transform(F.array_compact(own), lambda v: F.struct(F.lit(c).alias("facet"), v.cast("string").alias("value")))

    one = [values(c) for c in columns]
    return docs.select(F.inline(F.concat(*one))).groupBy("facet", "value").agg(F.count("*").alias("n"))


def page_groups(pages: DataFrame, size: int = 25) -> DataFrame:
    """(document_id, group, first, last): runs of pages for a table of contents."""
    rn = F.row_number().over(Window.partitionBy("document_id").orderBy("page_number"))
    return pages.withColumn("group", F.floor((rn - 1) / size).cast("int")).groupBy("document_id", "group").agg(F.min("page_number").alias("first"), F.max("page_number").alias("last"))


def in_year_order(docs: DataFrame) -> DataFrame:
    return docs.orderBy(F.coalesce("year", F.lit(99999)), "title")


# ---- search


def parse_filters(filters: str | None) -> dict[str, str]:
    """`key:value,key:value` as a dictionary; items without a colon are ignored."""
    items = [x.split(":", 1) for x in (filters or "").split(",") if ":" in x]
    return {k.strip(): v.strip() for k, v in items}


def passes(filters: dict[str, str]) -> Column:
    """Membership for language, equality for doc_type and year; other keys are ignored."""
    out = F.lit(True)
    for k, v in filters.items():
        if k == "language":
            out = out & F.coalesce(F.array_contains("languages", v), F.lit(False))
        elif k in ("doc_type", "year"):
            out = out & F.coalesce(F.col(k).cast("string") == v, F.lit(False))
    return out


def index(docs: DataFrame, text: Column, id_col: str = "document_id") -> DataFrame:
    """(id, token, tf): the inverted index, to be written partitioned by token for serving."""
    return docs.select(F.col(id_col), F.explode(search_tokens(text)).alias("token")).groupBy(id_col, "token").agg(F.count("*").alias("tf"))


def search(docs: DataFrame, index_: DataFrame, query: str, k: int = 10, filters: str | None = None, id_col: str = "document_id") -> DataFrame:
    """The k documents of highest mean term frequency over the query's tokens, repeats counted; an empty query takes all, with 1.0."""
    import re

    allowed = docs.where(passes(parse_filters(filters)))
    tokens = re.findall(r"\w+", query.lower())
    if not query:
        return allowed.withColumn("score", F.lit(1.0)).orderBy(id_col).limit(k)
    times = {t: tokens.count(t) for t in tokens}
    weight = F.create_map(*[F.lit(x) for kv in times.items() for x in kv]) if times else F.create_map(F.lit(""), F.lit(0))
    hits = index_.where(F.col("token").isin(*times)).groupBy(id_col).agg((F.sum(F.col("tf") * weight[F.col("token")]) / F.lit(float(max(1, len(tokens))))).alias("score"))
    return allowed.join(hits, id_col).where("score > 0").orderBy(F.desc("score"), id_col).limit(k)


def keyword_overlap(docs: DataFrame, query: str, k: int = 6, kw: str = "keywords", id_col: str = "document_id") -> DataFrame:
    """The k documents whose keyword string contains most of the query's distinct words."""
    import re

    words = sorted(set(re.findall("[a-zà-öø-ÿ0-9]{3,}", query.lower())))
    score = sum((F.contains(F.col(kw), F.lit(w)).cast("int") for w in words), F.lit(0))
    return docs.withColumn("score", score).where("score > 0").orderBy(F.desc("score"), id_col).limit(k)


def bm25(index_: DataFrame, query: str, k: int = 10, boosts: dict[str, float] | None = None, fuzzy: float = 0.12, id_col: str = "document_id", k1: float = 1.2, b: float = 0.7) -> DataFrame:
    """(id, score): BM25 over fields with boosts, exact, prefix and fuzzy matches, the latter two weighted by length and distance.

    index_ has id, field, token, tf.  Terms of a query are few; the index is filtered by them before anything is joined.
    """
    import re

    boosts = {"title": 3.0, "tags": 1.5, "text": 1.0} if boosts is None else boosts
    terms = sorted(set(re.findall(r"\w+", query.lower())))
    stats = index_.groupBy("field").agg((F.sum("tf") / F.countDistinct(id_col)).alias("mean"), F.countDistinct(id_col).alias("docs"))
    length = index_.groupBy(id_col, "field").agg(F.sum("tf").alias("len"))
    found = None
    for t in terms:
        far = round(fuzzy * len(t))
        tok = F.col("token")
        w = F.when(tok == t, 1.0).when(tok.startswith(t), 0.375 * len(t) / F.length(tok))
        if far:
            d = F.levenshtein(tok, F.lit(t), far)
            w = w.when(d >= 0, 0.45 * (1 - d / F.lit(float(len(t)))))
        part = index_.withColumn("w", w).where("w is not null").withColumn("term", F.lit(t))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return index_.select(id_col, F.lit(0.0).alias("score")).limit(0)
    df = found.groupBy("field", "token").agg(F.countDistinct(id_col).alias("df"))
    rows = found.join(df, ["field", "token"]).join(small(stats), "field").join(length, [id_col, "field"])
    idf = F.log(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    boost = F.coalesce(F.create_map(*[F.lit(x) for kv in boosts.items() for x in kv])[F.col("field")], F.lit(1.0))
    s = boost * F.col("w") * idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("len") / F.col("mean")))
    return rows.groupBy(id_col).agg(F.round(F.sum(s), 6).alias("score")).orderBy(F.desc("score"), id_col).limit(k)


# ---- retrieval context


def entities_of(links: DataFrame, nodes: DataFrame, k: int = 6) -> DataFrame:
    """(document_id, node_id, label, type, confidence, rank): of each document the k most confident distinct entities."""
    best = links.groupBy("document_id", "node_id").agg(F.max("confidence").alias("confidence"))
    return top_by(best, ["document_id"], k, F.desc("confidence"), "node_id", rank="rank").join(nodes.select("node_id", "label", "type"), "node_id")


def related_documents(doc_edges: DataFrame, k: int = 4, symmetric: bool = True) -> DataFrame:
    """(document_id, other_id, type, score, rank): the k best related documents; symmetric=False follows edges from src only."""
    rows = doc_edges.select(F.expr("replace(src, 'doc:', '')").alias("a"), F.expr("replace(dst, 'doc:', '')").alias("b"), "type", F.coalesce("combined", "quality_weight", F.lit(0.0)).alias("score"))
    ends = [F.struct(F.col("a").alias("document_id"), F.col("b").alias("other_id"))] + ([F.struct(F.col("b").alias("document_id"), F.col("a").alias("other_id"))] if symmetric else [])
    return top_by(rows.select("type", "score", F.inline(F.array(*ends))), ["document_id"], k, F.desc("score"), "other_id", "type", rank="rank")


def rag_context(hits: DataFrame, chunks: DataFrame, documents: DataFrame, entities: DataFrame, related: DataFrame) -> DataFrame:
    """(query_id, context): per query its hits in rank order, each with document, entities and related documents.

    hits has query_id, chunk_id, rank and score.
    """
    names = entities.groupBy("document_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "label"))), lambda x: x["label"]), ", ").alias("entities"))
    others = related.groupBy("document_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "other_id"))), lambda x: x["other_id"]), ", ").alias("related"))
    rows = hits.join(chunks.select("chunk_id", "document_id", "page_number", "text"), "chunk_id").join(documents.select("document_id", "title"), "document_id").join(names, "document_id", "left").join(others, "document_id", "left")
    head = F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] "), "title", F.lit(", p. "), F.col("page_number").cast("string"))
    block = F.concat_ws("\n", head, excerpt(F.col("text"), 1200), F.concat(F.lit("entities: "), "entities"), F.concat(F.lit("related: "), "related"))
    ordered = F.sort_array(F.collect_list(F.struct("rank", block.alias("t"))))
    return rows.groupBy("query_id").agg(F.array_join(F.transform(ordered, lambda x: x["t"]), "\n\n").alias("context"))
