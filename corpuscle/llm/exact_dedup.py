"""Exact deduplication by Grace hash partitioning.

Records are exchanged by a hash of their text, each partition in the order of its ids.  A task probes an
open-addressing table that compares complete texts.  When the table has reached its memory budget it is frozen;
records that it doesn't hold go to spill files by further bits of the hash, each of which is then treated the
same way, so memory stays bounded however large a partition or however skewed the hash.  The spill files lie in
the cluster's shared folder and are removed when their task ends.

Copies of one text that together exceed HOT_BYTES, as partial sums by hash tell beforehand, are spread over
several partitions: each finds its first record, these meet in one table, and the first of all goes back to each
partition as what its copies are compared with.  No task reads more of one text than HOT_BYTES, but for its firsts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscle.llm.common import col, fresh, map_arrow, row_hash, shared_dir, sized, written
from corpuscle.llm.hashing import slices

#: Bytes of distinct text that a table may hold.
MEMORY_BYTES = 128 << 20
FAN_OUT_BITS = 4
#: Bytes of copies of one text beyond which they are spread.
HOT_BYTES = 256 << 20


class ContentTable:
    """Open addressing with linear probing; a slot holds an entry's number, entries hold hash, text and id."""

    def __init__(self, capacity: int = 1 << 10) -> None:
        self.slots, self.mask = [-1] * capacity, capacity - 1
        self.hashes: list[int] = []
        self.texts: list[bytes] = []
        self.ids: list = []
        self.bytes = 0

    def _slot(self, h: int) -> int:
        return ((h ^ (h >> 29)) * 0x9E3779B97F4A7C15 >> 17) & self.mask

    def find(self, h: int, text: bytes) -> tuple[int, int]:
        """(number of the entry with this text or -1, the slot where the search ended)."""
        s = self._slot(h)
        while (e := self.slots[s]) >= 0:
            if self.hashes[e] == h and self.texts[e] == text:
                return e, s
            s = (s + 1) & self.mask
        return -1, s

    def add(self, slot: int, h: int, text: bytes, id_: object) -> None:
        self.slots[slot] = len(self.texts)
        self.hashes.append(h)
        self.texts.append(text)
        self.ids.append(id_)
        self.bytes += len(text) + 120
        if 2 * len(self.texts) > self.mask:
            self.slots, self.mask = [-1] * (4 * (self.mask + 1)), 4 * (self.mask + 1) - 1
            for e, x in enumerate(self.hashes):
                s = self._slot(x)
                while self.slots[s] >= 0:
                    s = (s + 1) & self.mask
                self.slots[s] = e


class Spill:
    """Spill files of one level: a record goes to the file that its next hash bits name."""

    def __init__(self, folder: str, level: int) -> None:
        self.fs, path = pafs.FileSystem.from_uri(folder)
        self.path, self.level = f"{path}/{uuid.uuid4().hex}", level
        self.writers: dict[int, tuple] = {}

    def write(self, batch: pa.RecordBatch, hashes: np.ndarray) -> None:
        spread = hashes.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        part = (spread >> np.uint64((60 - FAN_OUT_BITS * self.level) % 61)) & np.uint64((1 << FAN_OUT_BITS) - 1)
        for p in np.unique(part).tolist():
            if p not in self.writers:
                self.fs.create_dir(self.path, recursive=True)
                sink = self.fs.open_output_stream(f"{self.path}/{p}.arrow")
                self.writers[p] = (sink, pa.ipc.new_stream(sink, batch.schema))
            self.writers[p][1].write_batch(batch.filter(pa.array(part == p)))

    def close(self) -> list[str]:
        for sink, writer in self.writers.values():
            writer.close()
            sink.close()
        return [f"{self.path}/{p}.arrow" for p in sorted(self.writers)]

    def read(self, file: str) -> Iterator[pa.RecordBatch]:
        with self.fs.open_input_stream(file) as source, pa.ipc.open_stream(source) as reader:
            yield from reader
        self.fs.delete_file(file)

    def remove(self) -> None:
        if self.writers:
            self.fs.delete_dir(self.path)


def grace(
    batches: Iterator[pa.RecordBatch], text: int, id_: int, hash_: int, pairs: bool, folder: str, budget: int, level: int = 0, sent: int | None = None
) -> Iterator[pa.RecordBatch]:
    """The first record of every text (pairs=False), or (id, first id) of all others (pairs=True), from records in id order.

    Records whose column `sent` is true are compared with but not told of.
    """
    table, spill = ContentTable(), Spill(folder, level)
    try:
        for whole in batches:
            for batch in slices(whole, text):
                hashes = np.asarray(batch.column(hash_), dtype=np.int64)
                texts = batch.column(text).cast(pa.large_binary()).to_pylist()
                ids = batch.column(id_).to_pylist()
                quiet = batch.column(sent).to_pylist() if sent is not None else None
                keep, over, left, right = [], [], [], []
                for i, (h, t) in enumerate(zip(hashes.tolist(), texts, strict=True)):
                    if t is None:
                        keep.append(i)
                        continue
                    e, slot = table.find(h, t)
                    if e >= 0:
                        if not (quiet and quiet[i]):
                            left.append(ids[i])
                            right.append(table.ids[e])
                    elif table.bytes < budget:
                        table.add(slot, h, t, ids[i])
                        keep.append(i)
                    else:
                        over.append(i)
                if over:
                    spill.write(batch.take(pa.array(over)), hashes[over])
                if pairs and left:
                    kind = batch.schema.field(id_).type
                    yield pa.RecordBatch.from_arrays([pa.array(left, kind), pa.array(right, kind)], names=["doc_id", "duplicate_of"])
                elif not pairs and keep:
                    yield batch.take(pa.array(keep))
        del table
        for file in spill.close():
            yield from grace(spill.read(file), text, id_, hash_, pairs, folder, budget, level + 1, sent)
    finally:
        spill.remove()


def _keyed(docs: DataFrame, id_col: str, text_col: str, hot_bytes: int) -> tuple[DataFrame, DataFrame | None, list[str]]:
    """docs with a hash of the text and one of the row, hot texts apart with the number of parts they are spread over."""
    key, tie, parts, key2 = names = fresh(docs, "content_key", "content_tie", "content_parts", "content_key2")
    text = col(text_col)
    rows = docs.withColumn(tie, row_hash(docs)).withColumn(key, F.when(text.isNull(), F.col(tie)).otherwise(F.xxhash64(text)))
    bytes_ = F.sum(F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 64)
    hot = rows.groupBy(F.col(key).alias(key2)).agg(F.least(F.ceil(bytes_ / hot_bytes), F.count("*")).cast("int").alias(parts)).where(F.col(parts) > 1)
    hot = written(hot)
    if hot.isEmpty():
        return rows, None, names
    same = F.col(key) == F.col(key2)
    return rows.join(sized(hot.select(key2)), same, "left_anti"), rows.join(sized(hot), same).drop(key2), names


def _firsts(rows: DataFrame, id_col: str, text_col: str, key: str, tie: str, memory: int, *by: str) -> DataFrame:
    """The first row of every text, among those that agree in `by` too, in the columns of rows."""
    folder = shared_dir(rows.sparkSession)
    text, id_, hash_ = (rows.columns.index(c) for c in (text_col, id_col, key))
    rows = rows.repartition(key, *by).sortWithinPartitions(col(id_col).asc_nulls_last(), tie)
    return map_arrow(rows, lambda it: grace(it, text, id_, hash_, False, folder, memory), rows.schema)


def _pairs(rows: DataFrame, key: str, tie: str, memory: int, part: str | None = None, sent: str | None = None) -> DataFrame:
    """(doc_id, duplicate_of) for all but the first row of every text; with parts, a text's first row must be sent to all of them."""
    folder, kind = shared_dir(rows.sparkSession), rows.schema["doc_id"].dataType.simpleString()
    by, last = ((key, part), (sent,)) if part else ((key,), ())
    rows = rows.repartition(*by).sortWithinPartitions(F.col("doc_id").asc_nulls_last(), tie, *last).select("doc_id", "text", key, *last)
    return rows.mapInArrow(lambda it: grace(it, 1, 0, 2, True, folder, memory, sent=3 if sent else None), f"doc_id {kind}, duplicate_of {kind}")


def _hot_firsts(hot: DataFrame, id_col: str, text_col: str, names: list[str], memory: int) -> tuple[DataFrame, str, DataFrame]:
    """hot with the part of each row, the part's name, and the first row of every hot text."""
    key, tie, parts, _ = names
    (part,) = fresh(hot, "content_part")
    hot = hot.withColumn(part, F.pmod(F.col(tie), F.col(parts)).cast("int"))
    each = written(_firsts(hot, id_col, text_col, key, tie, memory, part))
    return hot, part, written(_firsts(each, id_col, text_col, key, tie, memory))


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", memory_bytes: int = MEMORY_BYTES, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """A row (doc_id, duplicate_of) for every row whose text another row has, byte for byte, that comes before it.

    The rows of a text are ordered by id, nulls last, then by a hash of the row; duplicate_of is the first one's id.
    A row repeated as a whole is thus a duplicate of its own id.  Null texts equal nothing; empty texts equal each
    other.  Other columns are not read.  An empty table gives no rows.
    """
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text")).where("text is not null")
    cold, hot, names = _keyed(rows, "doc_id", "text", hot_bytes)
    key, tie, parts, _ = names
    out = _pairs(cold, key, tie, memory_bytes)
    if hot is not None:
        hot, part, first = _hot_firsts(hot, "doc_id", "text", names, memory_bytes)
        # a text's first row goes to every part but its own, where it comes before all others
        (sent,) = fresh(hot, "content_sent")
        others = F.explode(F.array_except(F.sequence(F.lit(0), F.col(parts) - 1), F.array(part)))
        both = hot.withColumn(sent, F.lit(False)).unionByName(first.withColumn(part, others).withColumn(sent, F.lit(True)))
        out = out.unionByName(_pairs(both, key, tie, memory_bytes, part, sent))
    return out


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", memory_bytes: int = MEMORY_BYTES, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """The first row of every text, all columns as they were; see duplicates for the order.  Rows with a null text all stay."""
    cold, hot, names = _keyed(docs, id_col, text_col, hot_bytes)
    key, tie, _, _ = names
    out = _firsts(cold, id_col, text_col, key, tie, memory_bytes)
    if hot is not None:
        nulls = hot.where(col(text_col).isNull())
        out = out.unionByName(_hot_firsts(hot.where(col(text_col).isNotNull()), id_col, text_col, names, memory_bytes)[2].select(*out.columns)).unionByName(nulls.select(*out.columns))
    return out.select(*[col(c) for c in docs.columns])
