"""Helpers of the operators: first rows by an explicit order, safe broadcasts, lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows up to which a dictionary, mapping or grid may be broadcast.
BROADCAST_ROWS = 200_000


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key: the first in the given order, which must be total to be deterministic."""
    rows = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return rows.where("__rn = 1").drop("__rn")


def top_by(df: DataFrame, keys: list[str], n: int, *order: Column, rank: str | None = None) -> DataFrame:
    """The first n rows per key; with `rank`, their place as a column."""
    rows = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__rn") <= n)
    return rows.withColumnRenamed("__rn", rank) if rank else rows.drop("__rn")


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint where the table has at most so many rows, else the table for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _shared(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a local session without one gets its own."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or "file://" + tempfile.mkdtemp(prefix="corpuscle-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    _shared(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer partitions than the session has cores, as few large row groups give, in several per core; else itself.

    For work that costs far more than moving its rows.  What holds an exchange stays as it is, as Spark sizes its partitions.
    """
    cores, plan = df.sparkSession.sparkContext.defaultParallelism, df._jdf.queryExecution()
    if "AdaptiveSparkPlan" in plan.executedPlan().toString() or plan.toRdd().getNumPartitions() >= cores:
        return df
    return df.repartition(3 * cores)


#: Bytes of rows that a Python worker gets at once: it holds them with what it makes of them, and a task may have three workers.
BATCH = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of the session have BATCH bytes at most, so that workers' memory doesn't grow with partitions; a lower limit stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if not 0 < now <= BATCH:
        spark.conf.set(name, str(BATCH))


def shared_path(spark: SparkSession, what: str) -> str:
    """A new place in the shared folder, as a URI; it goes with the folder."""
    base = _shared(spark)
    return f"{base if ':' in base else 'file://' + base}/{what}-{uuid.uuid4().hex}"


def ordered_pair(df: DataFrame, a: str = "src", b: str = "dst") -> DataFrame:
    """Endpoints in ascending order."""
    return df.withColumns({a: F.least(a, b), b: F.greatest(a, b)})
