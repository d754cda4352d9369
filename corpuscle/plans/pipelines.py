"""The three builds end to end: ingest export, similarity, knowledge graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscle.functions.text import lexical as lexical_form
from corpuscle.operators import graph, release, similarity
from corpuscle.operators.chunking import OVERLAP, SIZE, chunk_pages
from corpuscle.operators.common import cut
from corpuscle.operators.layout import cleaned
from corpuscle.operators.similarity import Config


def build_similarity(pages: DataFrame, cfg: Config = Config(), size: int = SIZE, overlap: int = OVERLAP, lexical_only: bool = False, cache: DataFrame | None = None, model: str = "hashed-3-gram") -> dict[str, DataFrame]:
    """Pages to chunks, lexical and semantic pairs, typed chunk edges, document edges, families and a summary."""
    chunks = cut(chunk_pages(pages, size, overlap))
    sigs = similarity.signatures(chunks, "chunk_id", F.col("text"), cfg, lexical_form)
    lexical = cut(similarity.lexical_pairs(sigs, cfg))
    out: dict[str, DataFrame] = {"lexical_pairs": lexical}
    if lexical_only:
        semantic = pages.sparkSession.createDataFrame([], "src string, dst string, cosine double")
    else:
        chunks, out["cache"] = similarity.embed(chunks, cache, model)
        chunks = cut(chunks)
        near = similarity.knn(chunks.select(F.col("chunk_id").alias("id"), "vector"), cfg.neighbours)
        semantic = cut(similarity.semantic_pairs(near))
    edges = cut(similarity.fuse(lexical, semantic, chunks, cfg))
    docs = cut(similarity.document_edges(edges, chunks))
    nodes = chunks.select(F.concat(F.lit("doc:"), "document_id").alias("node")).distinct()
    families = similarity.communities(docs.select("src", "dst", F.col("combined").alias("weight")), nodes)
    groups = cut(similarity.clusters(families, "louvain"))
    return out | {"chunks": chunks, "semantic_pairs": semantic, "edges": edges, "doc_edges": docs, "clusters": groups, "summary": similarity.similarity_summary(docs, groups)}


def build_graph(pages: DataFrame, entries: DataFrame, mapping: DataFrame, doc_edges: DataFrame | None = None, least: float = graph.MIN_CONFIDENCE) -> dict[str, DataFrame]:
    """Pages and dictionaries to mentions, nodes, edges, triples and a summary."""
    linked = cut(graph.link_mentions(graph.mentions(pages, entries, least)))
    docs = cut(graph.with_mapping(graph.documents_from_pages(pages), mapping))
    nodes = cut(graph.nodes(docs, linked))
    edges = cut(graph.edges(nodes, docs, linked, doc_edges))
    return {"mentions": linked, "documents": docs, "nodes": nodes, "edges": edges, "triples": graph.triples(nodes, edges), "summary": graph.graph_summary(nodes, edges)}


def export_pages(pages: DataFrame) -> dict[str, DataFrame]:
    """Cleaned pages, document rollups, the review queue and totals; pages need the columns of a finished ingest."""
    clean = cut(cleaned(pages, ["document_id"]))
    rollup = release.document_rollup(clean, ["document_id"])
    first = clean.groupBy("document_id").agg(F.min_by(F.struct("title", "treaty_id", "year"), "page_number").alias("f")).select("document_id", "f.*")
    return {"pages": clean, "documents": rollup, "review_queue": release.review_queue(clean), "summary": release.corpus_summary(rollup.join(first, "document_id"))}
