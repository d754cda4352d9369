"""Sharding by histogram sort: splitters of a key order that give shards of equal bytes, then one exchange.

The keys and sizes of all rows are written once as a narrow table.  In each round the driver proposes probes inside the
interval that still holds each splitter, from the least key to the greatest at first; every partition counts the exact bytes
below all of them in one pass, and the intervals shrink to the two probes around the target, until each splitter's byte count
is within tolerance or no key lies between.  Rows then move once, straight to the partition that is their shard.

What the driver holds doesn't grow with the number of shards: of more than SPLITTERS shards, it probes for the splitters of
SPLITTERS groups of them.  The keys alone are then exchanged by group, the splitters within one are read off exact prefix sums
over its sorted keys, and stored in a file per group in the shared folder, which workers open when they place rows.
"""

from __future__ import annotations

import bisect
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuscle.llm.common import col, fresh, posix_dir, released, row_hash, written

TARGET_BYTES = 64 << 20
TOLERANCE = 0.01
PROBES = 15
#: Splitters that the driver probes for at most.
SPLITTERS = 16_384
_WIDTH = 17
_SIGN = np.uint64(1 << 63)


def keys(id_: np.ndarray, null: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Order-preserving keys of 17 bytes: null ids first, then by id, then by the tie-breaking hash."""
    out = np.zeros((len(id_), _WIDTH), np.uint8)
    out[:, 0] = ~null
    for at, x in ((1, np.where(null, 0, id_)), (9, tie)):
        out[:, at : at + 8] = (np.ascontiguousarray(x, np.int64).view(np.uint64) ^ _SIGN).astype(">u8").view(np.uint8).reshape(-1, 8)
    return out.view(f"S{_WIDTH}").ravel()


def _number(id_: int | None, tie: int) -> int:
    return int.from_bytes(keys(np.array([id_ or 0]), np.array([id_ is None]), np.array([tie]))[0].ljust(_WIDTH, b"\0"), "big")


def _as_keys(numbers: list[int]) -> np.ndarray:
    return np.array([n.to_bytes(_WIDTH, "big") for n in numbers], dtype=f"S{_WIDTH}")


def _of(batch: pa.RecordBatch) -> np.ndarray:
    id_ = batch.column(0)
    return keys(np.asarray(id_.fill_null(0), np.int64), np.asarray(id_.is_null()), np.asarray(batch.column(1), np.int64))


def splitters(narrow: DataFrame, shards: int, tolerance: float = TOLERANCE, probes: int = PROBES, marks: list[int] | None = None) -> list[int]:
    """Ascending keys as numbers, one before each shard in marks (all but the first by default): it holds the keys from there on.

    narrow has (id long, tie long, bytes long) and should be written.  The bytes below the splitter of shard i miss i / shards of
    all by at most `tolerance` of a shard, or by no more than the rows of a single key.
    """
    marks = list(range(1, shards)) if marks is None else marks
    ends = narrow.agg(F.sum("bytes").alias("total"), F.min("id").alias("low"), F.max("id").alias("high"), F.bool_or(F.col("id").isNull()).alias("null")).first()
    total, least, most = ends["total"] or 0, -(1 << 63), (1 << 63) - 1
    start = _number(None, least) if ends["null"] or ends["low"] is None else _number(ends["low"], least)
    stop = (_number(None, most) if ends["high"] is None else _number(ends["high"], most)) + 1
    low, high, below = [start] * len(marks), [stop] * len(marks), [0] * len(marks)
    want = [total * i // shards for i in marks]
    slack = tolerance * total / shards
    open_ = set(range(len(marks))) if total else set()
    while open_:
        asked = sorted({low[i] + (high[i] - low[i]) * j // (probes + 1) for i in open_ for j in range(1, probes + 1)} - {0})
        shared = narrow.sparkSession.sparkContext.broadcast(_as_keys(asked))

        def count(batches: Iterator[pa.RecordBatch], shared=shared, n=len(asked)) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(n + 1, np.int64)
            for b in batches:
                np.add.at(sums, np.searchsorted(shared.value, _of(b), "right"), np.asarray(b.column(2), np.int64))
            some = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], names=["bucket", "bytes"])

        sums = np.zeros(len(asked) + 1, np.int64)
        # SPLITTERS x PROBES + 1 sums at most
        for r in narrow.mapInArrow(count, "bucket long, bytes long").groupBy("bucket").agg(F.sum("bytes").alias("bytes")).collect():
            sums[r["bucket"]] = r["bytes"]
        shared.unpersist()
        less = np.cumsum(sums)[:-1].tolist()  # bytes of keys below each probe
        for i in sorted(open_):
            j = bisect.bisect_right(less, want[i])
            if j and asked[j - 1] > low[i]:
                low[i], below[i] = asked[j - 1], less[j - 1]
            over = None
            if j < len(asked) and asked[j] < high[i]:
                high[i], over = asked[j], less[j]
            if want[i] - below[i] <= slack or high[i] - low[i] <= 1:
                open_.discard(i)
            elif over is not None and over - want[i] <= slack:
                low[i], below[i] = high[i], over
                open_.discard(i)
    return low


def _inner(path: str, shared, first: list[int]):  # noqa: ANN001
    """Stores the splitters within a group of shards, read off its sorted keys; group g has shards from first[g] to first[g + 1]."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, size = [], []
        for b in batches:
            key.append(_of(b))
            size.append(np.asarray(b.column(2), np.int64))
        if not key:
            return
        key, size = np.concatenate(key), np.concatenate(size)
        g = int(np.searchsorted(shared.value, key[:1], "right")[0])
        n = first[g + 1] - first[g]
        order = np.argsort(key)
        key, run = key[order], np.cumsum(size[order])
        # the first row whose end passes the target begins a shard unless half of it lies before; rows of one key stay together
        want = run[-1] * np.arange(1, n) / n
        at = np.minimum(np.searchsorted(run - size[order] / 2, want), len(key) - 1)
        os.makedirs(path, exist_ok=True)
        temporary = f"{path}/{g}.{uuid.uuid4().hex}.tmp"
        with open(temporary, "wb") as f:
            np.save(f, key[at])
        os.replace(temporary, f"{path}/{g}.npy")
        yield pa.RecordBatch.from_arrays([pa.array([g], pa.int32())], names=["g"])

    return run


class Places:
    """The shard of a key: by the splitters that the driver found, and within a group by the group's file, if there are any."""

    def __init__(self, coarse: np.ndarray, first: list[int], path: str | None) -> None:
        self.coarse, self.first, self.path = coarse, np.array(first), path

    def of(self, key: np.ndarray) -> np.ndarray:
        g = np.searchsorted(self.coarse, key, "right")
        out = self.first[g].astype(np.int32)
        for x in np.unique(g).tolist() if self.path else []:
            name = f"{self.path}/{x}.npy"
            mine = g == x
            out[mine] += np.searchsorted(np.load(name), key[mine], "right").astype(np.int32) if os.path.exists(name) else 0
        return out


def sharded(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_bytes: int = TARGET_BYTES, shards: int | None = None, tolerance: float = TOLERANCE, name: str = "shard",
    most: int = SPLITTERS,
) -> DataFrame:
    """docs with a column `shard`, partitioned by it and sorted by id within: shards ascend with the id and hold equal bytes.

    The id must be an integer.  Null ids come first; rows that share an id are ordered by a hash of the row and may be split
    between shards, rows equal in all columns stay together.  A null text counts no bytes, an empty one neither; a text larger
    than a shard makes its shard larger.  If docs has a column `shard`, the new one is `shard_`.  An empty table gives no rows.
    `most` bounds the splitters that the driver looks for.
    """
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} must be an integer column")
    spark = docs.sparkSession
    shard, key, tie = fresh(docs, name, "order_key", "order_tie")
    rows = docs.withColumn(key, col(id_col).cast("long")).withColumn(tie, row_hash(docs))
    narrow = written(rows.select(F.col(key).alias("id"), F.col(tie).alias("tie"), F.coalesce(F.octet_length(col(text_col)), F.lit(0)).cast("long").alias("bytes")))
    if shards is None:
        shards = max(1, -(-(narrow.agg(F.sum("bytes")).first()[0] or 0) // target_bytes))
    if shards <= most:
        places = Places(_as_keys(splitters(narrow, shards, tolerance)), list(range(shards + 1)), None)
    else:
        first = [shards * g // most for g in range(most + 1)]
        coarse = _as_keys(splitters(narrow, shards, tolerance, marks=first[1:-1]))
        shared = spark.sparkContext.broadcast(coarse)
        path = posix_dir(spark, "splitters")

        @F.pandas_udf("int")
        def group(id_: pd.Series, null: pd.Series, tie_: pd.Series) -> pd.Series:
            k = keys(id_.to_numpy(np.int64), null.to_numpy(bool), tie_.to_numpy(np.int64))
            return pd.Series(np.searchsorted(shared.value, k, "right").astype(np.int32))

        grouped = narrow.repartitionById(most, group(F.coalesce("id", F.lit(0)), F.col("id").isNull(), F.col("tie")))
        with released(spark):
            grouped.mapInArrow(_inner(path, shared, first), "g int").write.parquet(f"file://{path}/groups")
        places = Places(coarse, first, path)
    shared_places = spark.sparkContext.broadcast(places)

    # a null among ids would make the column floating in pandas: ids go without nulls, their nulls beside them
    @F.pandas_udf("int")
    def place(id_: pd.Series, null: pd.Series, tie_: pd.Series) -> pd.Series:
        return pd.Series(shared_places.value.of(keys(id_.to_numpy(np.int64), null.to_numpy(bool), tie_.to_numpy(np.int64))))

    rows = rows.withColumn(shard, place(F.coalesce(F.col(key), F.lit(0)), F.col(key).isNull(), F.col(tie)))
    return rows.repartitionById(shards, F.col(shard)).sortWithinPartitions(key, tie).drop(key, tie)
