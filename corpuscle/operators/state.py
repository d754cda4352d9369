"""The ingest state as tables: keyed upserts, resume lists, errors and progress."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscle.operators.common import first_by

ERROR_CHARS = 2000


def upsert(state: DataFrame, changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The table after changes: per key the row that is latest in `order`; a change beats a state row of the same order."""
    both = state.withColumn("__new", F.lit(0)).unionByName(changes.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    return first_by(both, keys, F.col(order).desc(), F.col("__new").desc()).drop("__new")


def save_pages(state: DataFrame, pages: DataFrame, keys: list[str], order: str) -> DataFrame:
    """An upsert of results in which a failure never replaces a success; status is "done" or "error"."""
    both = state.unionByName(pages, allowMissingColumns=True)
    return first_by(both, keys, F.when(F.col("status") == "done", 0).otherwise(1), F.col(order).desc())


def record_error(errors: DataFrame, message: str = "error") -> DataFrame:
    return errors.withColumn(message, F.substring(message, 1, ERROR_CHARS))


def clear_errors(errors: DataFrame, saved: DataFrame, keys: list[str]) -> DataFrame:
    """Errors that no saved page of the same key and version has resolved."""
    return errors.join(saved, keys, "left_anti")


def load_page(pages: DataFrame, sha: str, number: int) -> DataFrame:
    """A finished page whatever version made it."""
    return pages.where((F.col("sha256") == sha) & (F.col("page_number") == number) & (F.col("status") == "done"))


def done(pages: DataFrame, version: str) -> DataFrame:
    """Keys of the pages that this version has finished."""
    return pages.where((F.col("status") == "done") & (F.col("pipeline_version") == version)).select("sha256", "page_number")


def page_jobs(documents: DataFrame) -> DataFrame:
    """A job per page of each distinct content."""
    one = documents.groupBy("sha256").agg(F.max("page_count").alias("pages"))
    return one.where("pages >= 1").select("sha256", F.explode(F.sequence(F.lit(1), F.col("pages").cast("int"))).alias("page_number"))


def pending(documents: DataFrame, pages: DataFrame, version: str) -> DataFrame:
    """Jobs that a resumed run still has to do."""
    return page_jobs(documents).join(done(pages, version), ["sha256", "page_number"], "left_anti")


def all_errors(errors: DataFrame, pages: DataFrame) -> DataFrame:
    """Recorded errors, and error pages without a recorded one."""
    keys = ["sha256", "page_number"]
    failed = pages.where("status = 'error'").select(*keys, "error")
    return errors.select(*keys, "error").unionAll(failed.join(errors, keys, "left_anti"))


def progress(documents: DataFrame, pages: DataFrame, version: str) -> DataFrame:
    """(total, done, remaining, percent): pages of distinct contents and how many this version has finished."""
    total = documents.groupBy("sha256").agg(F.max("page_count").alias("p")).agg(F.coalesce(F.sum("p"), F.lit(0)).alias("total"))
    finished = done(pages, version).agg(F.count("*").alias("done"))
    percent = F.when(F.col("total") > 0, F.round(100.0 * F.col("done") / F.col("total"), 3)).otherwise(F.lit(0.0))
    return total.crossJoin(finished).select("total", "done", F.greatest(F.col("total") - F.col("done"), F.lit(0)).alias("remaining"), percent.alias("percent"))


def complete_documents(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """Documents all of whose pages are finished."""
    have = pages.where("status = 'done'").groupBy("sha256").agg(F.countDistinct("page_number").alias("have"))
    return documents.join(have, "sha256").where("have = page_count").drop("have")


def fan_out(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """Every page under every document that has its content."""
    return documents.join(pages, "sha256")


def in_name_order(documents: DataFrame, name: str = "filename") -> DataFrame:
    return documents.orderBy(F.lower(name), name)
