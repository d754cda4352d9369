"""The driver's tables in the shapes that the operators take."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.functions import quality
from corpuscle.operators.common import small_batches, spread

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the driver's; from here on the session's Arrow batches are small, see small_batches."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def year_of(id_: Column) -> Column:
    return (F.lit(1880) + id_ % 150).cast("int")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as one-page documents with their quality."""
    d = spread(table(spark, sf_dir, "documents"))
    m = quality.metrics(F.col("text"))
    d = d.withColumn("metrics", m).withColumn("quality_score", F.round(quality.score(F.col("metrics"), F.lit(0.99)), 6))
    return d.select(
        "doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("document_id"), F.sha2("text", 256).alias("source_sha256"), F.lit(1).alias("page_number"), F.lit(1).alias("page_count"),
        F.concat_ws("-", "source", F.col("doc_id").cast("string")).alias("source_filename"), F.concat(F.lit("Title "), F.col("doc_id").cast("string")).alias("title"), F.col("source").alias("treaty_id"),
        F.col("lang").alias("doc_type"), year_of(F.col("doc_id")).alias("year"), F.array("lang").alias("language"), F.array(F.lit("Latin")).alias("script"), F.lit("native_text").alias("method"),
        "quality_score", "metrics", (F.col("quality_score") < 0.97).alias("review_required"), F.when(F.col("quality_score") < 0.9, "high").when(F.col("quality_score") < 0.97, "normal").otherwise("none").alias("review_priority"),
        F.lit("1").alias("pipeline_version"), "text",
    )


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as documents of several pages."""
    c = table(spark, sf_dir, "conversations")
    return c.select(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("document_id"), (F.col("turn") + 1).cast("int").alias("page_number"), "role", "text")


#: documents with metrics and quality, as SQL; {x} stands for what else is taken along.
QUALITY = r"""
qx as (select *, regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', '') as t from documents),
qy as (select *, length(t) as n, regexp_replace(t, '[ \n\t]', '', 'g') as solid, regexp_extract_all(t, '[\p{L}\p{Nl}\p{No}]+(?:[''’\-][\p{L}\p{Nl}\p{No}]+)*') as words from qx),
qm as (select *, len(words) as word_count,
  case when n = 0 then 0.0 else (n - (length(solid) - length(regexp_replace(solid, '[\p{C}\p{Z}]', '', 'g')))) / n end as printable,
  case when n = 0 then 0.0 else (n - length(regexp_replace(t, '[\p{L}\p{N}]', '', 'g'))) / n end as alnum,
  case when n = 0 then 1.0 else len(list_filter(words, lambda w: length(w) <= 1)) / greatest(len(words), 1) end as isolated,
  case when n = 0 then 1.0 else (n - length(regexp_replace(t, '[�|¦¬~`\^¤■□◆◇◊※]', '', 'g'))) / n end as noise,
  n - length(regexp_replace(t, '�', '', 'g')) as replaced, n - length(regexp_replace(t, '\p{Co}', '', 'g')) as private from qy),
qs as (select *, case when n = 0 then 0.0 else round(least(1.0, greatest(0.0,
  0.36 * 0.99 + 0.20 * printable + 0.14 * greatest(0.0, 1 - abs(alnum - 0.72) / 0.72) + 0.14 * greatest(0.0, 1 - isolated * 2.5) + 0.10 * greatest(0.0, 1 - noise * 20)
  + 0.06 * least(1.0, ln(1 + n) / ln(41)) - least(0.35, replaced * 0.04 + private * 0.01))), 6) end as quality from qm)
"""
BAND = "case when {0} >= 0.85 then 'accepted_ge_0_85' when {0} >= 0.65 then 'review_0_65_0_85' else 'priority_review_lt_0_65' end"
#: An array column as text, for results that compare as values.
joined = lambda c, sep="; ": F.array_join(c, sep)
