"""Identifiers as Column expressions; only the slug needs Python, for Unicode normal forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuscle.functions.text import each, lexical

#: Relations without direction: their endpoints are stored in order.
SYMMETRIC = ("duplicate", "clause_reuse", "translation", "semantic_kin", "weak_link", "similar_to", "same_instrument_as")
SHA = "^[0-9a-f]{64}$"
QID = "^Q[0-9]+$"


def text_sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _slug(x: str) -> str:
    return lexical(x).replace(" ", "_") or "unknown"


#: ASCII identifier of a label; "unknown" if nothing is left.
slug = each(_slug)


def ascii_slug(text: Column) -> Column:
    """The slug of a label without letters beyond ASCII, inside the JVM."""
    out = F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(out == "", F.lit("unknown")).otherwise(out)


def chunk_scope(document_id: Column, sha: Column) -> Column:
    """Hash that keeps byte-identical files under two names apart."""
    return F.sha2(F.concat(document_id, F.lit("\0"), sha), 256)


def chunk_id(sha: Column, page: Column, index: Column) -> Column:
    """`sha:p0001:c000`; raises where the hash, the page or the index is impossible."""
    made = F.format_string("%s:p%04d:c%03d", sha, page, index)
    bad = F.raise_error(F.concat(F.lit("no chunk id for "), F.coalesce(sha, F.lit("null")))).cast("string")
    return F.when(sha.rlike(SHA) & (page >= 1) & (index >= 0), made).otherwise(bad)


def document_node(document_id: Column) -> Column:
    return F.concat(F.lit("doc:"), document_id)


def instrument_node(treaty_id: Column, label: Column | None = None, label_slug: Column | None = None) -> Column:
    """`instr:<treaty>`, or by label its slug and the start of its hash."""
    by_id = F.concat(F.lit("instr:"), treaty_id)
    if label is None:
        return by_id
    named = F.concat(F.lit("instr:"), label_slug if label_slug is not None else slug(label), F.lit(":"), F.substring(F.sha2(label, 256), 1, 12))
    return F.when(F.coalesce(treaty_id, F.lit("")) != "", by_id).otherwise(named)


def clause_node(chunk: Column) -> Column:
    return F.concat(F.lit("clause:"), chunk)


def entity_node(kind: Column, label_slug: Column, qid: Column) -> Column:
    """`ent:wd:<QID>` where there is a QID, else `ent:<type>:<slug>`; a malformed QID raises."""
    bad = F.raise_error(F.concat(F.lit("malformed QID "), qid)).cast("string")
    return F.when(qid.isNull(), F.concat_ws(":", F.lit("ent"), kind, label_slug)).when(qid.rlike(QID), F.concat(F.lit("ent:wd:"), qid)).otherwise(bad)


def edge_key(src: Column, dst: Column, kind: Column) -> Column:
    """`type:src->dst`, with ordered endpoints if the relation has no direction."""
    swap = kind.isin(*SYMMETRIC) & (dst < src)
    return F.concat(kind, F.lit(":"), F.when(swap, dst).otherwise(src), F.lit("->"), F.when(swap, src).otherwise(dst))


def mention_id(document_id: Column, page: Column, start: Column, end: Column, kind: Column, surface: Column) -> Column:
    parts = (document_id, page.cast("string"), start.cast("string"), end.cast("string"), kind, surface)
    return F.sha2(F.concat_ws(":", *parts), 256)
