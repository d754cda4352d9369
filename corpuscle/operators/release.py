"""Release tables: tags, documents, exports, contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuscle.functions.text import quality_band
from corpuscle.operators.common import first_by

#: Spans of years by period.
PERIODS = {
    "early_modern_1516_1788": (1516, 1788), "revolutionary_napoleonic_1789_1815": (1789, 1815), "nineteenth_century_1816_1913": (1816, 1913),
    "world_war_i_and_interwar_1914_1938": (1914, 1938), "world_war_ii_and_postwar_1939_1989": (1939, 1989), "contemporary_1990_present": (1990, 1 << 30),
}
PUBLISHABLE = ("public_domain", "open_licence", "cleared")


def period(year: Column) -> Column:
    """The period of a year; years between periods, before them and null are unknown."""
    out = F
    for name, (low, high) in PERIODS.items():
        out = out.when(year.between(low, high), name)
    return out.otherwise("unknown")


def century(year: Column) -> Column:
    c = F.floor((year - 1) / F.lit(100)) + 1
    return F.when(c.between(16, 21), F.concat(F.lit("c"), c.cast("string"))).otherwise("unknown")


def review_tag(required: Column, priority: Column) -> Column:
    level = F.when(priority == "high", "review:required_high").otherwise("review:required_normal")
    return F.when(F.coalesce(required, F.lit(False)), level).otherwise("review:not_required")


def page_tags(tags: Column, language: Column, script: Column, quality: Column, required: Column, priority: Column, method: Column | None = None) -> Column:
    """The sorted set of a page's tags; with a method also what recognised it."""
    empty = F.array().cast("array<string>")
    named = lambda space, a: F.transform(F.coalesce(a, empty), lambda x: F.concat(F.lit(space + ":"), x))
    single = [F.concat(F.lit("quality:"), quality_band(F.coalesce(quality, F.lit(0.0)))), review_tag(required, priority)]
    if method is not None:
        engine = F.when(method.startswith("native"), "native_pymupdf").when(method.startswith("apple"), "apple_vision").when(method.startswith("tesseract"), "tesseract").otherwise("unknown")
        single.append(F.concat(F.lit("ocr_method:"), engine))
    return F.array_sort(F.array_distinct(F.concat(F.coalesce(tags, empty), named("language", language), named("script", script), F.array(*single))))


def document_tags(doc_type: Column, year: Column, instrument: Column, force: Column, rights: str = "to_review") -> Column:
    """The nine tags of a document, sorted; instrument and force come from the type's mapping."""
    tag = lambda k, v: F.concat(F.lit(k + ":"), v)
    fixed = [F.lit(x) for x in ("corpus:documents", "stage:live_snapshot", "source_db:corpus", f"rights_status:{rights}")]
    unknown = lambda c: F.coalesce(c, F.lit("unknown"))
    varied = [tag("doc_type", doc_type), tag("instrument_type", unknown(instrument)), tag("legal_force", unknown(force)), tag("period", period(year)), tag("century", century(year))]
    return F.array_sort(F.array_distinct(F.array(*fixed, *varied)))


def documents(pages: DataFrame, mapping: DataFrame) -> DataFrame:
    """A release row per document, attributes from its first page; mapping has doc_type, instrument_type, legal_force."""
    keep = [c for c in ("source_filename", "canonical_filename", "source_sha256", "treaty_id", "treaty_number", "title", "doc_type", "year", "page_count", "pipeline_version") if c in pages.columns]
    out = pages.groupBy("document_id").agg(
        F.min_by(F.struct(*keep), "page_number").alias("f"), F.count("*").alias("n"), F.array_sort(F.collect_set(F.when(F.col("source_filename") != "", F.col("source_filename")))).alias("aliases")
    )
    rows = out.select("document_id", "aliases", "n", "f.*")
    rows = rows.withColumns({"title": F.coalesce(F.when(F.col("title") != "", F.col("title")), "document_id"), "doc_type": F.coalesce("doc_type", F.lit("Inconnu")), "page_count": F.coalesce("page_count", "n")})
    rows = rows.join(mapping, "doc_type", "left")
    return rows.withColumn("rights_status", F.lit("to_review")).withColumn("tags", document_tags(F.col("doc_type"), F.col("year"), F.col("instrument_type"), F.col("legal_force"))).drop("n", "instrument_type", "legal_force")


def dedupe_edges(*tables: DataFrame) -> DataFrame:
    """All edge tables as one; of edges equal in ends, level, type and method the one of the earliest table, then of the highest score."""
    both: DataFrame | None = None
    for i, t in enumerate(tables):
        t = t.withColumn("__table", F.lit(i))
        both = t if both is None else both.unionByName(t, allowMissingColumns=True)
    return first_by(both, ["src", "dst", "level", "type", "method"], "__table", F.desc("combined")).drop("__table")


def publishable(documents_: DataFrame, allowed: tuple[str, ...] = PUBLISHABLE) -> DataFrame:
    """documents with eligible and the reason for which others are left out."""
    ok = F.coalesce(F.col("rights_status").isin(*allowed), F.lit(False))
    why = F.concat(F.lit("rights_status="), F.coalesce("rights_status", F.lit("missing")))
    return documents_.withColumn("eligible", ok).withColumn("reason", F.when(~ok, why))


def document_rollup(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Per document: characters before and after cleaning, mean and least quality, pages to review, methods."""
    return pages.groupBy(*keys).agg(
        F.count("*").alias("pages"), F.sum(F.length("text")).alias("raw_chars"), F.sum(F.length("cleaned_text")).alias("clean_chars"), F.round(F.avg("quality_score"), 4).alias("mean_quality"),
        F.round(F.min("quality_score"), 4).alias("min_quality"), F.sum(F.col("review_required").cast("int")).alias("review_pages"), F.array_sort(F.collect_set("method")).alias("methods"),
    )


def corpus_summary(documents_: DataFrame) -> DataFrame:
    """One row of totals over documents with pages, title, treaty_id, year and review_pages."""
    known = lambda c: F.sum((F.coalesce(F.col(c).cast("string"), F.lit("")) != "").cast("int")).alias(f"with_{c}")
    return documents_.agg(F.count("*").alias("documents"), F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"), known("title"), known("treaty_id"), known("year"), F.coalesce(F.sum(F.coalesce("review_pages", F.lit(0))), F.lit(0)).alias("review_pages"))


def review_queue(pages: DataFrame) -> DataFrame:
    """Pages to review, each physical page once: all its names joined, high priority if any has it; high first, then by name and page."""
    out = pages.where("review_required").groupBy("source_sha256", "page_number").agg(
        F.array_join(F.array_sort(F.collect_set("source_filename")), " | ").alias("filenames"), F.max((F.col("review_priority") == "high").cast("int")).alias("h"),
        F.round(F.min("quality_score"), 6).alias("quality_score"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("review_reasons")))), ", ").alias("reasons"),
    )
    out = out.withColumn("priority", F.when(F.col("h") == 1, "high").otherwise("normal")).drop("h")
    return out.orderBy(F.when(F.col("priority") == "high", 0).otherwise(1), "filenames", "page_number")


def markdown(pages: DataFrame, text_col: str = "text") -> DataFrame:
    """(document_id, markdown): a front matter and the pages in order."""
    body = F.sort_array(F.collect_list(F.struct("page_number", F.coalesce(text_col, F.lit("")).alias("t"))))
    joined = F.array_join(F.transform(body, lambda p: F.concat(F.lit("<!-- page "), p["page_number"].cast("string"), F.lit(" -->\n\n"), p["t"])), "\n\n")
    quoted = F.concat(F.lit('"'), F.replace(F.replace(F.first("title"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    head = F.concat(F.lit("---\ndocument_id: "), F.col("document_id"), F.lit("\ntitle: "), quoted, F.lit("\npages: "), F.count("*").cast("string"), F.lit("\n---\n\n"))
    return pages.groupBy("document_id").agg(F.concat(head, joined, F.lit("\n")).alias("markdown"))


# ---- contracts

#: Constraints by table: column to SQL predicates on it, all of which hold or are violated; "required" columns aren't null.
CONTRACTS: dict[str, dict[str, dict]] = {
    "page": {
        "document_id": {"required": True}, "source_sha256": {"required": True, "pattern": "^[a-f0-9]{64}$"}, "page_number": {"required": True, "min": 1}, "page_count": {"min": 1},
        "quality_score": {"required": True, "min": 0, "max": 1}, "review_priority": {"enum": ["none", "normal", "high"]}, "tags": {"items": "^[a-z_]+:.+$"}, "text": {"required": True},
    },
    "chunk": {
        "chunk_id": {"required": True, "pattern": "^[a-f0-9]{64}:p[0-9]{4}:c[0-9]{3}$"}, "document_id": {"required": True}, "page_number": {"required": True, "min": 1},
        "chunk_index": {"required": True, "min": 0}, "char_start": {"required": True, "min": 0}, "char_end": {"required": True, "min": 0}, "text": {"required": True},
        "text_sha256": {"required": True, "pattern": "^[a-f0-9]{64}$"}, "tags": {"items": "^[a-z_]+:.+$"},
    },
    "edge": {
        "src": {"required": True}, "dst": {"required": True}, "level": {"required": True, "enum": ["chunk", "document", "entity"]},
        "type": {"required": True, "enum": ["duplicate", "clause_reuse", "translation", "semantic_kin", "weak_link", "similar_to", "same_instrument_as", "party_to", "issued_by", "signed_at", "dated", "about_topic", "amends", "supersedes", "references", "translation_of"]},
        **{c: {"min": 0, "max": 1} for c in ("lexical", "semantic", "combined", "quality_weight")}, "provisional": {"required": True},
    },
    "node": {
        "node_id": {"required": True}, "type": {"required": True, "enum": ["Document", "Instrument", "Clause", "Party", "Organization", "Place", "Person", "TopicConcept"]},
        "label": {"required": True}, "wikidata_qid": {"pattern": "^Q[0-9]+$"}, "confidence": {"min": 0, "max": 1}, "tags": {"items": "^[a-z_]+:.+$"},
    },
    "document": {"document_id": {"required": True}, "source_sha256": {"required": True, "pattern": "^[a-f0-9]{64}$"}, "year": {"min": 1400, "max": 2100}, "page_count": {"min": 1}, "tags": {"items": "^[a-z_]+:.+$"}},
}


def _breaks(pattern: str) -> Callable[[Column], Column]:
    return lambda x: ~x.rlike(pattern)


def violations(df: DataFrame, contract: str | dict, key: str) -> DataFrame:
    """(key, column, rule) for every constraint that a row breaks, over all rows in one pass; a missing column breaks "present"."""
    rules = CONTRACTS[contract] if isinstance(contract, str) else contract
    found = []
    for name, rule in rules.items():
        broken: dict[str, Column] = {}
        if name not in df.columns:
            if rule.get("required"):
                broken["present"] = F.lit(True)
        else:
            c = F.col(f"`{name}`")
            if rule.get("required"):
                broken["required"] = c.isNull()
            if "pattern" in rule:
                broken["pattern"] = ~c.rlike(rule["pattern"])
            if "enum" in rule:
                broken["enum"] = ~c.isin(*rule["enum"])
            if "min" in rule:
                broken["min"] = c < rule["min"]
            if "max" in rule:
                broken["max"] = c > rule["max"]
            if "items" in rule and isinstance(df.schema[name].dataType, T.ArrayType):
                broken["items"] = F.exists(c, _breaks(rule["items"]))
        found += [F.when(when, F.struct(F.lit(name).alias("column"), F.lit(r).alias("rule"))) for r, when in broken.items()]
    return df.select(F.col(key).cast("string").alias("key"), F.inline(F.array_compact(F.array(*found))))


def mapping_differences(types: DataFrame, mapping: DataFrame) -> DataFrame:
    """(value, side): types without a mapping and mappings without a type."""
    a, b = types.select(F.col(types.columns[0]).alias("value")), mapping.select(F.col(mapping.columns[0]).alias("value"))
    return a.subtract(b).withColumn("side", F.lit("unmapped")).unionByName(b.subtract(a).withColumn("side", F.lit("unused")))


def first_namespace(tags: Column, namespace: str) -> Column:
    """What follows the colon in the first tag of a namespace, or null."""
    return F.substr(F.get(F.filter(tags, lambda t: t.startswith(namespace + ":")), F.lit(0)), F.lit(len(namespace) + 2))
