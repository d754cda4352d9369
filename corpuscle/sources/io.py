"""Readers and writers: files to hash, JSON, JSON lines, Parquet, CSV, pipe lists; Markdown, triples, graphs, manifests."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuscle.operators.common import small


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def scan_files(spark: SparkSession, folder: str, suffix: str = "pdf") -> DataFrame:
    """(filename, path, sha256, file_size) of files with a suffix in any case, in the order of their names; contents stay in the tasks."""
    any_case = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)
    raw = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{any_case}").load(folder)
    name = F.url_decode(F.replace(F.element_at(F.split("path", "/"), -1), F.lit("+"), F.lit("%2B")))
    return raw.select(name.alias("filename"), "path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("file_size")).orderBy(F.lower("filename"), "filename")


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, limit: int | None = None, order: str | None = None) -> DataFrame:
    """JSON lines under an explicit schema, blank lines skipped, a malformed line raises; a limit needs an order to mean the same rows each time."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if limit is not None:
        df = (df.orderBy(order) if order else df).limit(limit)
    return df


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A Parquet file or folder under a schema; a missing one is an empty table of that schema."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def first_existing(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """The first of the Parquet files or folders that exists."""
    found = next((p for p in paths if exists(spark, p)), None)
    return spark.read.parquet(found) if found else None


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, all columns as text."""
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrites a folder; the commit protocol shows either the old or the whole new table."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A CSV folder with headers; arrays and structs become JSON."""
    flat = [F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def finite(df: DataFrame) -> DataFrame:
    """NaN and infinities as nulls, as JSON has neither."""
    real = [c for c, t in df.dtypes if t in ("double", "float")]
    bad = lambda c: F.isnan(c) | (F.abs(c) == float("inf"))
    return df.withColumns({c: F.when(~bad(F.col(c)), F.col(c)) for c in real}) if real else df


def write_json(df: DataFrame, path: str) -> None:
    write_jsonl(finite(df), path)


def put(spark: SparkSession, path: str, content: bytes = b"") -> None:
    """Writes a small file; it is there whole or not at all to those who list the folder by its final name."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(content))
    out.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what a folder holds, in order; none if there is no folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def write_documents(df: DataFrame, path: str, id_col: str, text_col: str) -> None:
    """A text per document, in folders by id."""
    df.select(F.col(id_col), F.col(text_col).alias("value")).write.mode("overwrite").partitionBy(id_col).text(path)


def ntriples(triples: DataFrame, prefixes: dict[str, str] | None = None) -> DataFrame:
    """(value): triples as N-Triples lines, which are Turtle as well."""
    names = prefixes or {
        "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#", "rdfs": "http://www.w3.org/2000/01/rdf-schema#", "owl": "http://www.w3.org/2002/07/owl#", "schema": "https://schema.org/",
        "xsd": "http://www.w3.org/2001/XMLSchema#", "slo": "urn:corpus:ontology#",
    }

    def term(c: Column) -> Column:
        out = F.when(c.startswith("_:"), F.concat(F.lit("_:b"), F.substr(c, F.lit(3))))
        for k, v in names.items():
            out = out.when(c.startswith(k + ":"), F.concat(F.lit("<" + v), F.substr(c, F.lit(len(k) + 2)), F.lit(">")))
        return out.otherwise(F.concat(F.lit("<"), c, F.lit(">")))

    text = F.col("o")
    for raw, safe in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    literal = F.concat(F.lit('"'), text, F.lit('"'), F.when(F.col("datatype").isNotNull(), F.concat(F.lit("^^"), term(F.col("datatype")))).otherwise(F.lit("")))
    return triples.select(F.concat_ws(" ", term(F.col("s")), term(F.col("p")), F.when(F.col("o_kind") == "literal", literal).otherwise(term(F.col("o"))), F.lit(".")).alias("value"))


def write_triples(triples: DataFrame, path: str) -> None:
    ntriples(triples).write.mode("overwrite").text(path)


def jsonld(triples: DataFrame) -> DataFrame:
    """(value): a JSON-LD node object per subject."""
    value = F.when(F.col("o_kind") == "literal", F.to_json(F.struct(F.col("o").alias("@value"), F.col("datatype").alias("@type")))).otherwise(F.to_json(F.struct(F.col("o").alias("@id"))))
    by = triples.groupBy("s", "p").agg(F.sort_array(F.collect_list(value)).alias("v"))
    field = F.concat(F.lit('"'), "p", F.lit('":['), F.array_join("v", ","), F.lit("]"))
    return by.groupBy("s").agg(F.concat(F.lit('{"@id":"'), "s", F.lit('",'), F.array_join(F.sort_array(F.collect_list(field)), ","), F.lit("}")).alias("value")).select("value")


def write_sigma(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Nodes with coordinates and sizes, and edges among them, as two JSON-lines folders for a graph viewer."""
    from corpuscle.operators.graph import layout, simple_degree

    placed = layout(nodes)
    size = simple_degree(edges).withColumnRenamed("node", "node_id")
    shown = placed.join(size, "node_id", "left").select(F.col("node_id").alias("id"), "label", "type", "x", "y", (1 + F.log(1 + F.coalesce("degree", F.lit(0)))).alias("size"))
    ids = small(placed.select("node_id"))
    kept = edges.join(ids.withColumnRenamed("node_id", "src"), "src", "left_semi").join(ids.withColumnRenamed("node_id", "dst"), "dst", "left_semi")
    write_json(shown, f"{path}/nodes")
    write_json(kept.select(F.col("src").alias("source"), F.col("dst").alias("target"), "type", F.coalesce("combined", "quality_weight").alias("weight")), f"{path}/edges")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(sha256, path): hashes of all files of a tree by relative path, in its order.  Written after, it isn't among them."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    root = folder.removeprefix("file://").rstrip("/") + "/"
    relative = F.url_decode(F.replace(F.substring_index("path", root, -1), F.lit("+"), F.lit("%2B")))
    return raw.select(F.sha2("content", 256).alias("sha256"), relative.alias("path")).orderBy("path")


def counts_manifest(tables: dict[str, DataFrame], config: dict) -> str:
    """A JSON text of row counts by table and the configuration."""
    return json.dumps({"counts": {k: v.count() for k, v in tables.items()}, "config": config}, sort_keys=True)
