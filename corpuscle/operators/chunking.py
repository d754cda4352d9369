"""Pages to overlapping windows of tokens."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.functions.ids import chunk_id, chunk_scope, text_sha256

SIZE, OVERLAP = 384, 64


def words(text: str) -> list[tuple[int, int]]:
    """Places of the runs of characters that aren't white space."""
    return [m.span() for m in re.finditer(r"\S+", text)]


def starts(n: Column, size: int, overlap: int) -> Column:
    """First tokens of the windows over n tokens: none for none, and the last window is the first that reaches the end."""
    step = max(1, size - min(overlap, size - 1))
    count = F.when(n == 0, 0).when(n <= size, 1).otherwise(F.ceil((n - size) / F.lit(step)).cast("int") + 1)
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: i * step))


def spans(text: str, size: int, overlap: int, tokenizer: Callable[[str], list[tuple[int, int]]] = words) -> list[dict]:
    """Windows of a text as (char_start, char_end), trimmed to their text; blank ones are left out."""
    at, step, i, out = tokenizer(text), max(1, size - min(overlap, size - 1)), 0, []
    while at:
        part = at[i : i + size]
        begin, end = part[0][0], part[-1][1]
        inner = text[begin:end]
        begin, end = begin + len(inner) - len(inner.lstrip()), end - len(inner) + len(inner.rstrip())
        if begin < end:
            out.append({"char_start": begin, "char_end": end})
        i += step
        if i - step + size >= len(at):
            break
    return out


def chunk_pages(pages: DataFrame, size: int = SIZE, overlap: int = OVERLAP, tokenizer: Callable[[str], list[tuple[int, int]]] = words) -> DataFrame:
    """A row per window of each page that isn't blank, within the page; chunk_index counts a page's windows.

    pages has document_id, source_sha256, page_number and text and keeps its other columns, with defaults for what is missing.
    The tokenizer gives token places; it is shipped to the workers.
    """

    @F.pandas_udf("array<struct<char_start:int,char_end:int>>")
    def windows(text: pd.Series) -> pd.Series:
        return text.map(lambda t: spans(t, size, overlap, tokenizer))

    rows = pages.where(F.coalesce("text", F.lit("")).rlike(r"(?U)\S"))
    rows = rows.select("*", F.posexplode(windows(F.col("text"))).alias("chunk_index", "__w")).select("*", "__w.*").drop("__w")
    part = F.substring(F.col("text"), F.col("char_start") + 1, F.col("char_end") - F.col("char_start"))
    defaults = {"source_filename": "", "title": "", "doc_type": "Inconnu", "quality_score": 0.0, "review_priority": "none", "pipeline_version": ""}
    for name, value in defaults.items():
        rows = rows.withColumn(name, F.coalesce(F.col(name), F.lit(value)) if name in rows.columns else F.lit(value))
    id_ = chunk_id(chunk_scope(F.col("document_id"), F.col("source_sha256")), F.col("page_number"), F.col("chunk_index"))
    rows = rows.withColumn("chunk_id", id_).withColumn("text", part).withColumn("text_sha256", text_sha256(F.col("text")))
    nothing = F.lit(None).cast("string")
    return rows.withColumn("embedding_model", nothing).withColumn("embedding_created_at", nothing)
