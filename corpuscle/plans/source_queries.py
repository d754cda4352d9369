"""Queries that write tables with each sink, read them back with each source, and let streams arrive in the shared folder."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.operators import graph, inventory, state
from corpuscle.operators.common import shared_path
from corpuscle.plans.base import table
from corpuscle.plans.graph_queries import _GRAPH, _graph
from corpuscle.plans.state_queries import _D, _E, _J, _P, _documents, _events, _pages
from corpuscle.sources import io
from corpuscle.streaming import ingest

_CUSTOMER = "c_custkey long, c_name string, c_acctbal double, c_mktsegment string"


def _customers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", "c_acctbal", "c_mktsegment")


def parquet_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Written twice, as an overwrite, and partitioned; a missing table is empty and the first that exists is read."""
    path, c = shared_path(spark, "sink"), _customers(spark, d)
    io.write_parquet(c.limit(3), path)
    io.write_parquet(c, path, ["c_mktsegment"])
    missing = io.read_parquet(spark, f"{path}-none", _CUSTOMER)
    return io.first_existing(spark, [f"{path}-none", path]).select(*c.columns).unionByName(missing)


def jsonl_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Nulls and infinite numbers as null, the first rows by key."""
    path = shared_path(spark, "sink")
    n = F.col("c_custkey") % 3
    io.write_json(_customers(spark, d).withColumn("c_acctbal", F.when(n == 0, float("nan")).when(n == 1, float("inf")).otherwise(F.col("c_acctbal"))), path)
    io.put(spark, f"{path}/blank.json", b"\n\n")
    return io.read_jsonl(spark, path, _CUSTOMER, 100, "c_custkey")


def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Quotes, commas and arrays in fields."""
    path = shared_path(spark, "sink")
    c = _customers(spark, d).select("c_custkey", F.concat(F.lit('"q", '), "c_name").alias("name"), F.array("c_mktsegment", F.lit("x")).alias("tags"))
    io.write_csv(c, path)
    return io.read_csv(spark, path)


def json_array(spark: SparkSession, d: str) -> DataFrame:
    """Metadata records of one JSON array by file name in any case."""
    path = shared_path(spark, "source")
    rows = [{"filename": r["n_name"] if i % 2 else r["n_name"].lower(), "title": f"T{r['n_nationkey']}", "year": r["n_regionkey"]} for r in table(spark, d, "nation").collect() for i in range(2)]
    io.put(spark, f"{path}/m.json", json.dumps(rows, indent=1).encode())
    grouped = inventory.group_metadata(io.read_json_array(spark, f"{path}/m.json", "filename string, title string, year int"))
    return grouped.select("key", F.size("metadata").alias("n"), F.col("metadata")[0]["title"].alias("title"))


def _folder(spark: SparkSession, d: str) -> str:
    """A file per nation, in folders by region; a bounded table."""
    path = shared_path(spark, "source")
    for r in table(spark, d, "nation").collect():
        io.put(spark, f"{path}/{r['n_regionkey']}/{r['n_name']} +1.{'PDF' if r['n_nationkey'] % 2 else 'pdf'}", f"{r['n_name']}-{r['n_nationkey']}".encode() * 3)
        io.put(spark, f"{path}/{r['n_regionkey']}/{r['n_nationkey']}.txt", b"x")
    return path


def file_scan(spark: SparkSession, d: str) -> DataFrame:
    """Files of a folder with a suffix in any case: name, hash and size, in the order of names."""
    files = io.scan_files(spark, _folder(spark, d) + "/*")
    return files.select("filename", "sha256", "file_size", F.row_number().over(_by_name()).alias("place"))


def _by_name():  # noqa: ANN202
    from pyspark.sql import Window

    return Window.orderBy(F.lower("filename"), "filename")  # files of one folder: few


def tree_manifest(spark: SparkSession, d: str) -> DataFrame:
    return io.manifest(spark, _folder(spark, d))


def counts_manifest(spark: SparkSession, d: str) -> DataFrame:
    tables = {n: table(spark, d, n) for n in ("nation", "region", "supplier")}
    return spark.createDataFrame([(io.counts_manifest(tables, {"size": 384}),)], "manifest string")


def gazetteer_csv(spark: SparkSession, d: str) -> DataFrame:
    """A dictionary as CSV: trimmed fields, aliases apart, blanks as null."""
    path = shared_path(spark, "source")
    n = table(spark, d, "nation")
    k = F.col("n_nationkey")
    rows = n.select(
        F.concat(F.lit(" "), "n_name", F.lit(" ")).alias("label"), F.when(k % 2 == 0, F.concat(F.lower("n_name"), F.lit(" | "), F.lit("x|"))).alias("aliases"),
        F.when(k % 3 == 0, F.concat(F.lit(" Q"), k.cast("string"))).otherwise("  ").alias("qid"), F.lit("").alias("iso3"), F.lit("en").alias("lang"), F.lit("Place").alias("type"),
    )
    io.write_csv(rows, path)
    return graph.gazetteer(io.read_csv(spark, path)).select("label", F.array_join("aliases", "/").alias("aliases"), "qid", "iso3", "type")


def text_lines(spark: SparkSession, d: str) -> DataFrame:
    """A list between pipes, as lines of a file."""
    path = shared_path(spark, "source")
    table(spark, d, "region").select(F.concat_ws("|", F.lit("u"), F.concat("r_name", F.lit(".pdf")), F.lit("TRA1900/7"), F.lit("Accord"))).coalesce(1).write.text(path)
    return inventory.parse_pipe_list(io.read_lines(spark, path)).drop("url")


def triple_lines(spark: SparkSession, d: str) -> DataFrame:
    """Triples as lines of N-Triples, written and read; how many of each predicate, and how long they are."""
    path = shared_path(spark, "sink")
    io.write_triples(_graph(spark, d)["triples"].where("p in ('rdfs:label', 'slo:partyTo', 'schema:datePublished', 'owl:sameAs')"), path)
    lines = io.read_lines(spark, path)
    return lines.select(F.regexp_extract("value", "^<([^>]*)> <([^>]*)> (.*) [.]$", 2).alias("p"), F.regexp_extract("value", "^<([^>]*)> <([^>]*)> (.*) [.]$", 3).alias("o")).groupBy("p").agg(
        F.count("*").alias("n"), F.min("o").alias("least"), F.max("o").alias("most")
    )


def select_query(spark: SparkSession, d: str) -> DataFrame:
    """A query text over the triples."""
    query = """PREFIX slo: <urn:corpus:ontology#>
      SELECT DISTINCT ?label ?name WHERE { ?i a slo:Instrument ; slo:aboutTopic ?t ; rdfs:label ?name . ?t rdfs:label ?label . }"""
    return graph.select(_graph(spark, d)["triples"], query)


def name_order(spark: SparkSession, d: str) -> DataFrame:
    """Files in the order of their names, whatever their case."""
    c = table(spark, d, "customer").select(F.when(F.col("c_custkey") % 2 == 0, F.upper("c_name")).otherwise(F.lower("c_name")).alias("filename"), "c_custkey")
    first = state.in_name_order(c).limit(20)
    return first.select("filename", "c_custkey")


def recorded_errors(spark: SparkSession, d: str) -> DataFrame:
    """Long messages are kept up to 2,000 characters."""
    e = table(spark, d, "documents").select("doc_id", F.col("text").alias("error"))
    return state.record_error(e).select("doc_id", F.length("error").alias("chars"), F.md5("error").alias("hash"))


def loaded_pages(spark: SparkSession, d: str) -> DataFrame:
    p = _pages(spark, d)
    return state.load_page(p, "s1", 2).unionByName(state.load_page(p, "s2", 1)).select("sha256", "page_number", "event_id")


# ---- streams


def _arrived(spark: SparkSession, rows: DataFrame, schema: str) -> tuple[DataFrame, str]:
    path = shared_path(spark, "stream")
    rows.repartition(3).write.json(f"{path}/in")
    return ingest.read_files(spark, f"{path}/in", schema, 1), path


def streamed_page_state(spark: SparkSession, d: str) -> DataFrame:
    """Page results that arrive in three files, merged batch by batch."""
    e = _events(spark, d).withColumn("seq", F.col("event_id")).withColumn("result", F.col("event_type"))
    stream, path = _arrived(spark, e.select("sha256", "page_number", "status", "result", "error", "pipeline_version", "seq"), ingest.PAGE)
    state_ = ingest.StateTable(spark, f"{path}/state", ingest.PAGE)
    one = stream.withColumn("pipeline_version", F.lit("1"))
    ingest.run_once(one, ingest.merge_pages(state_), f"{path}/checkpoint")
    return state_.read().select("sha256", "page_number", "seq", "status")


def streamed_pending(spark: SparkSession, d: str) -> DataFrame:
    """What is still to do after a stream of results."""
    p = _pages(spark, d).select("sha256", "page_number", "status", F.lit(None).cast("string").alias("result"), "error", "pipeline_version", F.col("event_id").alias("seq"))
    stream, path = _arrived(spark, p, ingest.PAGE)
    state_ = ingest.StateTable(spark, f"{path}/state", ingest.PAGE)
    ingest.run_once(stream, ingest.merge_pages(state_), f"{path}/checkpoint")
    return ingest.pending_jobs(state.page_jobs(_documents(spark, d)), state_, "2")


def _sunk(stream: DataFrame, path: str, mode: str) -> DataFrame:
    """The stream's output, every batch's rows, as a table."""
    spark = stream.sparkSession

    def keep(batch: DataFrame, n: int) -> None:
        batch.withColumn("batch", F.lit(n)).write.mode("overwrite").parquet(f"{path}/out/part={n}")

    stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/out")


def streamed_decisions(spark: SparkSession, d: str) -> DataFrame:
    """The latest review event of each page, from updates of a stream out of order."""
    e = table(spark, d, "events").select(
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("event_id"), F.concat(F.lit("s"), "user_id").alias("source_sha256"), (F.col("event_id") % 3).cast("int").alias("page_number"),
        F.col("ts").alias("created_at"), F.lit("r").alias("reviewer"), F.col("event_type").alias("decision"),
    )
    stream, path = _arrived(spark, e, ingest.REVIEW)
    out = _sunk(ingest.latest_decisions(stream), path, "update")
    return out.groupBy("source_sha256", "page_number").agg(F.max_by(F.struct("event_id", "decision"), "batch").alias("l")).select("source_sha256", "page_number", "l.*")


def streamed_windows(spark: SparkSession, d: str) -> DataFrame:
    """Counts of events by hour, as a stream brings them up to date."""
    stream, path = _arrived(spark, table(spark, d, "events").select("ts", "event_type", "value"), "ts timestamp, event_type string, value double")
    out = _sunk(ingest.event_windows(stream, "1 hour", "1000 days"), path, "update")
    last = out.groupBy("start", "event_type").agg(F.max_by(F.struct("n", "total"), "batch").alias("l"))
    return last.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "l.n", F.round("l.total", 3).alias("total"))


def streamed_texts(spark: SparkSession, d: str) -> DataFrame:
    """Each content once, however often it arrives."""
    docs = table(spark, d, "documents").select(F.sha2("text", 256).alias("text_sha256"))
    stream, path = _arrived(spark, docs, "text_sha256 string")
    return _sunk(ingest.new_texts(stream), path, "append").select("text_sha256")


QUERIES = [
    parquet_round_trip, jsonl_round_trip, csv_round_trip, json_array, file_scan, tree_manifest, counts_manifest, gazetteer_csv, text_lines, triple_lines, select_query, name_order, recorded_errors, loaded_pages,
    streamed_page_state, streamed_pending, streamed_decisions, streamed_windows, streamed_texts,
]
_FILES = """fl as (select n_regionkey || '/' || n_name || ' +1.' || case when n_nationkey % 2 = 1 then 'PDF' else 'pdf' end as path, repeat(n_name || '-' || n_nationkey, 3) as content from nation
  union all select n_regionkey || '/' || n_nationkey || '.txt', 'x' from nation)"""
SQL = {
    "parquet_round_trip": "select c_custkey::bigint as c_custkey, c_name, c_acctbal, c_mktsegment from customer",
    "jsonl_round_trip": "select c_custkey::bigint as c_custkey, c_name, case when c_custkey % 3 = 2 then c_acctbal end as c_acctbal, c_mktsegment from customer order by c_custkey limit 100",
    "csv_round_trip": """select c_custkey::varchar as c_custkey, '"q", ' || c_name as name, '["' || c_mktsegment || '","x"]' as tags from customer""",
    "json_array": "select lower(n_name) as key, 2 as n, 'T' || n_nationkey as title from nation",
    "file_scan": f"with {_FILES} select split_part(path, '/', 2) as filename, sha256(content) as sha256, length(content)::bigint as file_size, (row_number() over (order by lower(split_part(path, '/', 2)), path))::int as place from fl where lower(path) like '%.pdf'",
    "tree_manifest": f"with {_FILES} select sha256(content) as sha256, path from fl",
    "counts_manifest": """select '{"config": {"size": 384}, "counts": {"nation": ' || (select count(*) from nation) || ', "region": ' || (select count(*) from region) || ', "supplier": ' || (select count(*) from supplier) || '}}' as manifest""",
    "gazetteer_csv": """select n_name as label, case when n_nationkey % 2 = 0 then lower(n_name) || '/x' else '' end as aliases, case when n_nationkey % 3 = 0 then 'Q' || n_nationkey end as qid, null::varchar as iso3, 'Place' as type from nation""",
    "text_lines": "select r_name || '.pdf' as filename, 'Accord' as title, 'TRA1900' as treaty_id, '7' as treaty_number, 1900 as year, 'Accord' as doc_type from region",
    "triple_lines": f"""with {_GRAPH}, o as (select 'http://www.w3.org/2000/01/rdf-schema#label' as p, '"' || label || '"' as o from gn union all select 'urn:corpus:ontology#partyTo', '<urn:corpus:' || url_encode(dst) || '>' from ge where type = 'party_to'
          union all select 'https://schema.org/datePublished', '"' || year || '"^^<http://www.w3.org/2001/XMLSchema#gYear>' from gn where year is not null
          union all select 'http://www.w3.org/2002/07/owl#sameAs', '<http://www.wikidata.org/entity/' || replace(node_id, 'ent:wd:', '') || '>' from gn where node_id like 'ent:wd:%')
        select p, count(*) as n, min(o) as least, max(o) as most from o group by p""",
    "select_query": f"with {_GRAPH} select distinct t.label, i.label as name from ge join gn i on i.node_id = ge.src join gn t on t.node_id = ge.dst where ge.type = 'about_topic'",
    "name_order": "select case when c_custkey % 2 = 0 then upper(c_name) else lower(c_name) end as filename, c_custkey from customer order by lower(c_name), 1 limit 20",
    "recorded_errors": "select doc_id, length(substr(text, 1, 2000))::int as chars, md5(substr(text, 1, 2000)) as hash from documents",
    "loaded_pages": f"with {_P} select sha256, page_number, event_id from p where status = 'done' and ((sha256 = 's1' and page_number = 2) or (sha256 = 's2' and page_number = 1))",
    "streamed_page_state": f"with {_P} select sha256, page_number, event_id as seq, status from p",
    "streamed_pending": f"with {_P}, {_D}, {_J} select * from j except select * from f",
    "streamed_decisions": """select 's' || user_id as source_sha256, (event_id % 3)::int as page_number, lpad(arg_max(event_id, (ts, event_id))::varchar, 12, '0') as event_id, arg_max(event_type, (ts, event_id)) as decision
        from events group by 1, 2""",
    "streamed_windows": "select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as start, event_type, count(*) as n, round(round(sum(value), 4), 3) as total from events group by 1, 2",
    "streamed_texts": "select distinct sha256(text) as text_sha256 from documents",
}
