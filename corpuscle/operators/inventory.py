"""Files and their metadata: what there is to ingest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stem(filename: Column) -> Column:
    return F.regexp_replace(filename, r"(?<=.)\.[^.]*$", "")


def select_files(files: DataFrame, names: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Files whose name or stem is listed (in any case), in the order of their names; the first `limit` of them."""
    if names:
        wanted = [n.lower() for n in names]
        files = files.where(F.lower("filename").isin(wanted) | F.lower(stem(F.col("filename"))).isin(wanted))
    files = files.orderBy(F.lower("filename"), "filename")
    return files if limit is None else files.limit(limit)


def group_metadata(records: DataFrame) -> DataFrame:
    """Metadata records by file name in lower case, as an array in the order of their content."""
    fields = [c for c in records.columns]
    return records.groupBy(F.lower("filename").alias("key")).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("metadata"))


def with_metadata(files: DataFrame, metadata: DataFrame) -> DataFrame:
    """Files with their metadata array, empty where there is none, and the first file name with the same content."""
    joined = files.join(metadata, F.lower(files.filename) == metadata.key, "left").drop("key")
    first = F.first("filename").over(Window.partitionBy("sha256").orderBy(F.lower("filename"), "filename"))
    return joined.withColumn("metadata", F.coalesce("metadata", F.array().cast(metadata.schema["metadata"].dataType))).withColumn("canonical_filename", first)


def metadata_view(documents: DataFrame) -> DataFrame:
    """Document id, title, treaty and type from the first metadata record; the least year of all; "" where missing."""
    first = F.get("metadata", F.lit(0))
    plain = {c: F.coalesce(first[c], F.lit("")) for c in ("title", "treaty_id", "treaty_number", "doc_type")}
    years = F.array_compact(F.transform("metadata", lambda m: m["year"].cast("int")))
    return documents.select("*", stem(F.col("filename")).alias("document_id"), *[v.alias(k) for k, v in plain.items()], F.array_min(years).alias("year"))


def duplicate_groups(rows: DataFrame, key: Column, id_col: str) -> DataFrame:
    """Groups of equal content: its hash, how many rows and the smallest id."""
    out = rows.groupBy(F.sha2(key, 256).alias("sha256")).agg(F.count("*").alias("n"), F.min(id_col).alias("first_id"))
    return out.where("n > 1")


def parse_pipe_list(lines: DataFrame) -> DataFrame:
    """Rows of `url|filename|reference|title` lines; blank lines, # comments and short lines are skipped."""
    value = F.trim("value")
    parts = F.split(value, r"\|")
    kept = lines.where((value != "") & ~value.startswith("#") & (F.size(parts) >= 4))
    at = lambda i: F.trim(F.get(parts, F.lit(i)))
    ref = at(2)
    slash = F.instr(ref, "/")
    treaty = F.when(slash > 0, F.substring_index(ref, "/", 1)).when(ref.rlike("^(TRA|tra)"), ref).otherwise("")
    number = F.when(slash > 0, F.expr("substring(trim(split(trim(value), '\\\\|')[2]), instr(trim(split(trim(value), '\\\\|')[2]), '/') + 1)")).otherwise("")
    year = F.regexp_extract(treaty, r"(?:TRA|tra)?(\d{4})", 1)
    return kept.select(
        at(0).alias("url"), at(1).alias("filename"), at(3).alias("title"), treaty.alias("treaty_id"), number.alias("treaty_number"),
        F.when(year != "", year).cast("int").alias("year"), title_type(at(3)).alias("doc_type"),
    )


#: What titles of a type begin with, if not with the type's own name in lower case; in this order.
TYPES = [
    "Traité", "Convention", "Accord", "Protocole", "Déclaration", "Arrangement", "Échange de lettres", "Lettre", "Instrument d'adhésion", "Instrument de ratification",
    "Pouvoirs", "Procès-verbal", "Note verbale", "Certificat", "Notification", "Texte", "Minutes",
]
_BEGINS = {"Texte": "texte de", "Instrument d'adhésion": "instrument d('?)adhésion"}


def title_type(title: Column) -> Column:
    """The document type that a title begins with, parentheses left out: Inconnu without a title, Autre otherwise."""
    base = F.trim(F.regexp_replace(F.trim(F.lower(title)), r"\(.*?\)", ""))
    out = F.when(F.coalesce(title, F.lit("")) == "", "Inconnu")
    for name in TYPES:
        out = out.when(base.rlike("^" + _BEGINS.get(name, name.lower())), name)
    return out.otherwise("Autre")


def distributions(records: DataFrame) -> DataFrame:
    """Counts by type and by year, and of distinct treaties, as (kind, value, n)."""
    by = lambda c: records.groupBy(F.col(c).cast("string").alias("value")).agg(F.count("*").alias("n")).select(F.lit(c).alias("kind"), "value", "n")
    treaties = records.where("treaty_id <> ''").agg(F.countDistinct("treaty_id").alias("n")).select(F.lit("treaties").alias("kind"), F.lit(None).cast("string").alias("value"), "n")
    return by("doc_type").unionByName(by("year")).unionByName(treaties)
