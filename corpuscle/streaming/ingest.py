"""Incremental ingest: resumable jobs, keyed state, review decisions and event windows as Structured Streaming queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.operators.state import save_pages
from corpuscle.sources.io import names, put, remove

PAGE = "sha256 string, page_number int, status string, result string, error string, pipeline_version string, seq long"
REVIEW = "event_id string, source_sha256 string, page_number int, created_at timestamp, reviewer string, decision string"


def read_files(spark: SparkSession, folder: str, schema: str, per_trigger: int = 1000) -> DataFrame:
    """JSON lines files that arrive in a folder, as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).json(folder)


class StateTable:
    """A keyed Parquet table in versions: readers see the last whole one while a batch writes the next."""

    def __init__(self, spark: SparkSession, folder: str, schema: str) -> None:
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema

    def _versions(self) -> list[str]:
        """Whole versions by number; an empty file of its name marks a version as whole."""
        return names(self.spark, f"{self.folder}/CURRENT")

    def read(self) -> DataFrame:
        have = self._versions()
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/{have[-1]}") if have else self.spark.createDataFrame([], self.schema)

    def replace(self, df: DataFrame) -> None:
        """The new version, then its mark, which is made at once; two versions stay, as readers may still be at the one before.

        Whenever this breaks off, the last whole version stays the current one.
        """
        have = self._versions()
        now = f"v-{int(have[-1].split('-')[1]) + 1 if have else 0:012}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.folder}/{now}")
        put(self.spark, f"{self.folder}/CURRENT/{now}")
        for old in have[:-1]:
            remove(self.spark, f"{self.folder}/CURRENT/{old}")
            remove(self.spark, f"{self.folder}/{old}")


def merge_pages(table: StateTable) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: page results into the state, a failure never over a success.  A batch that runs twice changes nothing more."""

    def merge(batch: DataFrame, _: int) -> None:
        table.replace(save_pages(table.read(), batch, ["sha256", "page_number", "pipeline_version"], "seq"))

    return merge


def run_once(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """All that has arrived, in batches, then stops; the next run goes on from there."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def pending_jobs(jobs: DataFrame, table: StateTable, version: str) -> DataFrame:
    """Jobs of (sha256, page_number) that this version hasn't finished; results of other versions don't count."""
    have = table.read().where((F.col("status") == "done") & (F.col("pipeline_version") == version)).select("sha256", "page_number")
    return jobs.join(have, ["sha256", "page_number"], "left_anti")


def new_texts(stream: DataFrame, key: str = "text_sha256") -> DataFrame:
    """The first row of each content of a stream, for an encoder with a cache."""
    return stream.dropDuplicates([key])


def latest_decisions(events: DataFrame) -> DataFrame:
    """The latest review event of each page as a stream of updates, by time and then id; late events don't undo later ones.

    The state is that of a native aggregation: a page that only late events meet is sent again as it was.
    """
    return latest_decisions_batch(events)


def latest_decisions_batch(events: DataFrame) -> DataFrame:
    """The same over all events at once, as one row a page."""
    last = F.max_by(F.struct("created_at", "event_id", "reviewer", "decision"), F.struct("created_at", "event_id"))
    return events.groupBy("source_sha256", "page_number").agg(last.alias("l")).select("source_sha256", "page_number", "l.*")


def event_windows(events: DataFrame, size: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Counts and sums of events by type in tumbling windows; works for a stream, with a watermark, and for a table."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Users' sessions, which a gap ends."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
