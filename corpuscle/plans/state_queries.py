"""Queries of the ingest state and of the event streams' batch forms: events as page results, customers as documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.operators import inventory, state
from corpuscle.plans.base import table
from corpuscle.streaming import ingest

KEYS = ["sha256", "page_number"]
FILES = ["supplier_3", "Supplier#000000007.pdf", "SUPPLIER#000000009"]


def _events(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(
        "event_id", F.concat(F.lit("s"), "user_id").alias("sha256"), (F.col("event_id") % 7 + 1).cast("int").alias("page_number"), F.when(F.col("event_type") == "error", "error").otherwise("done").alias("status"),
        F.when(F.col("event_type") == "view", "1").otherwise("2").alias("pipeline_version"), F.when(F.col("event_type") == "error", F.col("props")).alias("error"), "event_type",
    )


def _documents(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select(F.col("c_name").alias("filename"), F.concat(F.lit("s"), (F.col("c_custkey") % 400).cast("string")).alias("sha256"), (F.col("c_custkey") % 400 % 7 + 1).alias("page_count"))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d)
    return state.save_pages(e.where("event_type < 'f'"), e.where("event_type >= 'f'"), KEYS, "event_id")


def last_write_upsert(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d)
    return state.upsert(e.where("event_type < 'f'"), e.where("event_type >= 'f'"), KEYS, "event_id").select(*KEYS, "event_id", "status")


def page_state_merge(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d).select(*KEYS, "event_id", "status")


def resume_pending(spark: SparkSession, d: str) -> DataFrame:
    return state.pending(_documents(spark, d), _pages(spark, d), "2")


def progress(spark: SparkSession, d: str) -> DataFrame:
    return state.progress(_documents(spark, d), _pages(spark, d), "2")


def error_union(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d)
    return state.all_errors(e.where("event_type = 'error'").groupBy(*KEYS).agg(F.max("error").alias("error")).where("page_number > 3"), e)


def unresolved_errors(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d)
    return state.clear_errors(e.where("status = 'error'"), e.where("status = 'done' and pipeline_version = '1'"), KEYS).select(*KEYS, "event_id")


def complete_documents(spark: SparkSession, d: str) -> DataFrame:
    return state.complete_documents(_documents(spark, d), _pages(spark, d))


def alias_fan_out(spark: SparkSession, d: str) -> DataFrame:
    return state.fan_out(_documents(spark, d), _pages(spark, d)).select("filename", "page_number", "status")


def file_selection(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "supplier").select(F.concat("s_name", F.lit(".PDF")).alias("filename"), "s_suppkey")
    return inventory.select_files(files, FILES).select("filename", "s_suppkey")


def latest_decisions(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    rows = e.select(
        F.concat(F.lit("s"), "user_id").alias("source_sha256"), (F.col("event_id") % 3).cast("int").alias("page_number"), F.col("ts").alias("created_at"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("event_id"), F.lit("r").alias("reviewer"), F.col("event_type").alias("decision"),
    )
    return ingest.latest_decisions_batch(rows).select("source_sha256", "page_number", "event_id", "decision")


def event_windows(spark: SparkSession, d: str) -> DataFrame:
    return ingest.event_windows(table(spark, d, "events"), "1 hour").withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))


def user_sessions(spark: SparkSession, d: str) -> DataFrame:
    s = ingest.sessions(table(spark, d, "events"), "6 hours")
    return s.select("user_id", F.unix_micros(F.col("start").cast("timestamp")).alias("first"), F.unix_micros(F.col("end").cast("timestamp")).alias("until"), "n")


_E = """e as (select event_id, 's' || user_id as sha256, (event_id % 7 + 1)::int as page_number, case when event_type = 'error' then 'error' else 'done' end as status,
  case when event_type = 'view' then '1' else '2' end as pipeline_version, case when event_type = 'error' then props end as error, event_type from events)"""
_P = f"{_E}, p as (select * from (select *, row_number() over (partition by sha256, page_number order by (status = 'error')::int, event_id desc) as rn from e) where rn = 1)"
_D = "d as (select c_name as filename, 's' || (c_custkey % 400) as sha256, c_custkey % 400 % 7 + 1 as page_count from customer)"
_J = "j as (select distinct sha256, unnest(range(1, page_count + 1))::int as page_number from d), f as (select sha256, page_number from p where status = 'done' and pipeline_version = '2')"

QUERIES = [last_write_upsert, page_state_merge, resume_pending, progress, error_union, unresolved_errors, complete_documents, alias_fan_out, file_selection, latest_decisions, event_windows, user_sessions]
SQL = {
    "last_write_upsert": f"with {_E} select sha256, page_number, max(event_id) as event_id, arg_max(status, event_id) as status from e group by 1, 2",
    "page_state_merge": f"with {_P} select sha256, page_number, event_id, status from p",
    "resume_pending": f"with {_P}, {_D}, {_J} select * from j except select * from f",
    "progress": f"""with {_P}, {_D}, {_J}, t as (select (select count(*) from j) as total, (select count(*) from f) as done)
        select total, done, greatest(total - done, 0) as remaining, round(100.0 * done / total, 3)::double as percent from t""",
    "error_union": f"""with {_E}, r as (select sha256, page_number, max(error) as error from e where event_type = 'error' and page_number > 3 group by 1, 2)
        select * from r union all select sha256, page_number, error from e where status = 'error' and (sha256, page_number) not in (select (sha256, page_number) from r)""",
    "unresolved_errors": f"with {_E} select sha256, page_number, event_id from e where status = 'error' and (sha256, page_number) not in (select (sha256, page_number) from e where status = 'done' and pipeline_version = '1')",
    "complete_documents": f"with {_P}, {_D} select d.sha256, filename, page_count from d join (select sha256, count(*) as n from p where status = 'done' group by 1) h on d.sha256 = h.sha256 and n = page_count",
    "alias_fan_out": f"with {_P}, {_D} select filename, page_number, status from d join p using (sha256)",
    "file_selection": "select s_name || '.PDF' as filename, s_suppkey from supplier where lower(s_name) in (" + ", ".join(f"'{f.lower().removesuffix('.pdf')}'" for f in FILES) + ")",
    "latest_decisions": """select 's' || user_id as source_sha256, (event_id % 3)::int as page_number, lpad(arg_max(event_id, (ts, event_id))::varchar, 12, '0') as event_id, arg_max(event_type, (ts, event_id)) as decision
        from events group by 1, 2""",
    "event_windows": "select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as start, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2",
    "user_sessions": """with a as (select *, case when ts - lag(ts) over w < interval 6 hour then 0 else 1 end as new from events window w as (partition by user_id order by ts, event_id)),
        b as (select *, sum(new) over (partition by user_id order by ts, event_id) as s from a)
        select user_id, epoch_us(min(ts)) as first, epoch_us(max(ts) + interval 6 hour) as until, count(*) as n from b group by user_id, s""",
}
