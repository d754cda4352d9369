"""What the operators of this subpackage share: the cluster's shared folder, sized broadcasts, free column names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a narrow table (ids, keys, a few numbers) up to which it may be broadcast.
BROADCAST_ROWS = 500_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as spark.checkpoint.dir names it.

    Where the setting is missing, a local master gets a folder of its own; a cluster is refused.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not sc._jsc.sc().getCheckpointDir().isDefined():
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    have = sc._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get().rstrip("/")
    own = "file://" + tempfile.mkdtemp(prefix="corpuscle-")
    sc.setCheckpointDir(own)
    return own


def posix_dir(spark: SparkSession, what: str) -> str:
    """A new path under the shared folder that workers can open and memory-map as a file; clean() removes it."""
    base = shared_dir(spark)
    if "://" in base and not base.startswith("file://"):
        raise ValueError(f"spark.checkpoint.dir must be a mounted folder (file://) here, not {base}")
    return new_dir(spark, what).removeprefix("file://").removeprefix("file:")


def new_dir(spark: SparkSession, what: str) -> str:
    """A new place in the shared folder, as a URI; clean() removes it."""
    base = shared_dir(spark)
    _made.append(f"{base if ':' in base else 'file://' + base}/{what}-{uuid.uuid4().hex}")
    return _made[-1]


#: Folders that operators of this process have made for files which their lazy results read.
_made: list[str] = []


def clean(spark: SparkSession) -> None:
    """Removes the models, blocks and stages that operators have left in the shared folder; their results must be written by then."""
    while _made:
        remove(spark, _made.pop())


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Within it, an execution's shuffle files go as soon as its result is written, so that steps don't add up on disk."""
    was = spark.conf.get(_RELEASE, "false")
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(_RELEASE, was)


def written(df: DataFrame) -> DataFrame:
    """The DataFrame as a reliable checkpoint in the shared folder: computed once, independent of its lineage."""
    shared_dir(df.sparkSession)
    with released(df.sparkSession):
        return df.checkpoint(eager=True)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """df.mapInArrow(run, schema) for columns of any name, dots included."""
    given, made = df.columns, [f.name for f in schema]
    plain = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema)])

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in run(x.rename_columns(given) for x in batches):
            yield b.rename_columns([f"c{i}" for i in range(len(made))])

    return df.toDF(*[f"c{i}" for i in range(len(given))]).mapInArrow(renamed, plain).toDF(*made)


def col(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if the narrow, already written table has at most so many rows; else itself, for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer partitions than the session has cores, as few large row groups give, in several per core; else itself.

    For work that costs far more than moving its rows.  What holds an exchange stays as it is, as Spark sizes its partitions.
    """
    cores, plan = df.sparkSession.sparkContext.defaultParallelism, df._jdf.queryExecution()
    if "AdaptiveSparkPlan" in plan.executedPlan().toString() or plan.toRdd().getNumPartitions() >= cores:
        return df
    return df.repartition(3 * cores)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of df has, in whatever case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of a row's content, for a defined order between rows that tie otherwise."""
    return F.xxhash64(*[col(f.name) for f in df.schema if not _has_map(f.dataType)])


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, (T.MapType, T.VariantType))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
