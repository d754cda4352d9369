"""Near-duplicate detection by SimHash: every pair of fingerprints within MAX_BITS bits is joined.

A text's fingerprint has TABLES tables of 2 x SEGMENTS bits, each bit a majority over the text's distinct words.  Two texts
are near when their whole fingerprints differ in at most MAX_BITS bits, which is counted exactly.

The join is a range join in each table.  61 differing bits are needed to exceed reach() in all 16 tables, so near texts differ
in at most 3 (or 2) bits of the 24 of some table.  A task holds the fingerprints by a table's bits and looks up all differences
of so few bits; what it meets has to keep the bound over two tables, too, before all bits are counted.  So nothing is left out.

Beyond ROWS_AT_ONCE fingerprints a table is cut into one more part than bits may differ in it: near texts agree in one of
the parts, and a task holds what agrees there.  Its near pairs are reduced to a forest; groups are joined by alternating stars.

Equal fingerprints are merged first, with partial minima in every task, so groups of exact copies cost one comparison.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.llm.common import BROADCAST_ROWS, col, fresh, row_hash, sized, spread, written
from corpuscle.llm.hashing import combine, slices, words

TABLES, SEGMENTS = 16, 12
WIDTH = SEGMENTS * 2
BITS = TABLES * WIDTH
#: Bits of BITS that near texts may differ in.
MAX_BITS = 60
#: Fingerprints that one task may compare; more are parted by bits that near ones share.
ROWS_AT_ONCE = 1 << 18
_PAIRS_AT_ONCE = 1 << 20
#: Bits of a table that the first look at a difference passes over.
_LOW = 3
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.uint8).view(np.uint64).ravel()
_WORDS = BITS // 64


def fingerprints(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """uint8 [n, BITS / 8] and whether the text has a word; bits are majorities over distinct words, ties 0."""
    n = len(texts)
    word, at = words(texts)
    out = np.zeros((n, BITS // 8), np.uint8)
    who = np.repeat(np.arange(n, dtype=np.uint64), np.diff(at))
    have = np.sort((who << np.uint64(40)) | (word >> np.uint64(24)))
    if not len(have):
        return out, np.zeros(n, bool)
    have = have[np.append(True, have[1:] != have[:-1])]
    count = np.bincount((have >> np.uint64(40)).astype(np.int64), minlength=n)
    some = np.flatnonzero(count)
    start = np.cumsum(count)[some] - count[some]
    # parts of at most 255 words: their counts fit the byte lanes of a 64-bit sum
    parts = -(-count[some] // 255)
    first_part = np.cumsum(parts) - parts
    places = np.repeat(start, parts) + 255 * (np.arange(parts.sum()) - np.repeat(first_part, parts))
    feature = have & np.uint64((1 << 40) - 1)
    for k in range(_WORDS):
        byte = combine([feature, np.full(1, k, np.uint64)]).view(np.uint8).reshape(-1, 8)
        for b in range(8):
            lanes = np.add.reduceat(_LANES[byte[:, b]], places).view(np.uint8).reshape(-1, 8)
            total = np.add.reduceat(lanes, first_part, axis=0, dtype=np.int64)
            out[some, 8 * k + b] = np.packbits(2 * total > count[some, None], axis=1).ravel()
    return out, count > 0


def grid(fp: np.ndarray) -> np.ndarray:
    """Bit counts of all segments of two bits: uint8 [n, TABLES, SEGMENTS], each 0, 1 or 2.

    The Manhattan distance of a table's counts never exceeds its Hamming distance: the search in bits meets all that one here would.
    """
    bits = np.unpackbits(fp, axis=1).reshape(len(fp), TABLES, SEGMENTS, 2)
    return bits.sum(axis=3, dtype=np.uint8)


def reach(max_bits: int) -> list[int]:
    """Per table a number of bits t: fingerprints within max_bits differ in at most t bits of some table; t + 1 add up to max_bits + 1."""
    least, rest = divmod(max_bits + 1, TABLES)
    return [least + (i < rest) - 1 for i in range(TABLES)]


def _parts(t: int, bits: int) -> tuple[int, int]:
    """Into how many parts of how many bits a table is cut: of t + 1 disjoint parts t differing bits leave one equal."""
    bits = min(bits, WIDTH // (t + 1))
    return (t + 1, bits) if bits else (1, 0)


def _raw(prints: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Fingerprints as uint8 [n, BITS / 8]."""
    parts = prints.chunks if isinstance(prints, pa.ChunkedArray) else [prints]
    size, out = BITS // 8, []
    for x in parts:
        if len(x):
            _, offsets, data = x.buffers()
            at = np.frombuffer(offsets, np.int32)[x.offset]
            out.append(np.frombuffer(data, np.uint8)[at : at + len(x) * size].reshape(-1, size))
    return np.concatenate(out)


def _codes(fp: np.ndarray, table: int, tables: int = 1) -> np.ndarray:
    """The bits of so many tables, in a ring from the given one on, as numbers: int64 [n]."""
    out = np.zeros(len(fp), np.int64)
    for k in range(3 * table, 3 * (table + tables)):
        out = (out << 8) | fp[:, k % (BITS // 8)]
    return out


def _copies(max_bits: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per fingerprint, table and part of it a row (cell: which table, which part and the part's bits; id, fingerprint)."""
        for batch in batches:
            for i in range(0, batch.num_rows, 1 << 13):
                part = batch.slice(i, 1 << 13)
                fp = _raw(part.column(1))
                for k, t in enumerate(reach(max_bits)):
                    if t < 0:
                        continue
                    code, (parts, width) = _codes(fp, k), _parts(t, bits)
                    for c in range(parts):
                        cell = ((k << 5 | c) << WIDTH) + (code >> c * width & (1 << width) - 1)
                        yield pa.RecordBatch.from_arrays([pa.array(cell), part.column(0), part.column(1)], names=["cell", "doc_id", "fp"])

    return run


@cache
def _masks(t: int, part: int, width: int) -> list[list[np.ndarray]]:
    """The differences of 1 to t bits of a table whose first equal part, of parts of `width` bits, is the given one.

    Per highest bit, in groups that agree in all but the last _LOW bits.
    """
    found = np.array([sum(1 << x for x in bits) for k in range(1, t + 1) for bits in itertools.combinations(range(WIDTH), k)], np.int64)
    cut = lambda c: found >> c * width & (1 << width) - 1
    found = np.sort(found[(cut(part) == 0) & np.all([cut(c) > 0 for c in range(part)], axis=0)])
    groups = np.split(found, np.flatnonzero(np.diff(found >> _LOW)) + 1)
    return [[x for g in groups if len(x := g[g >> top == 1])] for top in range(WIDTH)]


def _probes(code: np.ndarray, t: int, part: int, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Arrays (left, low, high): row left meets the rows from low to below high.  Rows are sorted by code; each pair of rows whose
    codes differ in at most t bits, the given part being the first equal one, meets once."""
    n = len(code)
    ids = np.arange(n)
    if sum(math.comb(WIDTH, k) for k in range(t + 1)) > n // 2:  # few rows for so many differences: all meet
        yield ids, ids + 1, np.full(n, n)
        return
    cell, start, count = np.unique(code, return_index=True, return_counts=True)
    if not part:
        yield ids, ids + 1, np.repeat(start + count, count)
    near, there, where = np.zeros(1 << WIDTH - _LOW, bool), np.zeros(1 << WIDTH, bool), np.zeros(1 << WIDTH, np.int32)
    near[cell >> _LOW], there[cell], where[cell] = True, True, np.arange(len(cell))
    held, size = [], 0

    def rows() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = (np.concatenate(x) for x in zip(*held, strict=True))
        k = count[a]
        if len(a) == k.sum():
            return start[a], start[b], start[b] + count[b]
        left = np.repeat(start[a] - (np.cumsum(k) - k), k) + np.arange(k.sum())
        return left, np.repeat(start[b], k), np.repeat(start[b] + count[b], k)

    for top, masks in enumerate(_masks(t, part, width)):
        lower = np.flatnonzero(cell >> top & 1 == 0)  # of two cells the one without the highest differing bit looks for the other
        for begin in range(0, len(lower), 1 << 15):
            own = lower[begin : begin + (1 << 15)]
            at, high = cell[own], cell[own] >> _LOW
            for group in masks:  # most have no other cell even among those that agree in all but the last bits
                some = np.flatnonzero(near[high ^ group[0] >> _LOW])
                for mask in group if len(some) else ():
                    other = at[some] ^ mask
                    hit = np.flatnonzero(there[other])
                    if not len(hit):
                        continue
                    held.append((own[some[hit]], where[other[hit]]))
                    size += int(count[held[-1][0]].sum())
                    if size > _PAIRS_AT_ONCE:
                        yield rows()
                        held, size = [], 0
    if held:
        yield rows()


def _roots(n: int, a: np.ndarray, b: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """The smallest node of each node's component."""
    root = np.arange(n) if root is None else root
    while True:
        x, y = root[a], root[b]
        differ = x != y
        if not differ.any():
            return root
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (up := root[root]).tobytes() != root.tobytes():
            root = up


def _met(left: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of rows of _probes, so many at once."""
    size = high - low
    one = size == 1
    yield left[one], low[one]
    one = size > 1
    left, low, size = left[one], low[one], size[one]
    end = np.cumsum(size)
    total = int(end[-1]) if len(end) else 0
    for begin in range(0, total, _PAIRS_AT_ONCE):
        stop = min(total, begin + _PAIRS_AT_ONCE)
        i, j = np.searchsorted(end, begin, "right"), np.searchsorted(end, stop - 1, "right") + 1
        f, t = np.maximum(end[i:j] - size[i:j], begin), np.minimum(end[i:j], stop)
        yield np.repeat(left[i:j], t - f), np.arange(begin, stop) + np.repeat(low[i:j] - (end[i:j] - size[i:j]), t - f)


def _near(fp: np.ndarray, node: np.ndarray, root: np.ndarray, max_bits: int, table: int, part: int, width: int) -> np.ndarray:
    """Joins the components `root` of the nodes of near rows, which share a cell: of the pairs that this table and part account for."""
    t = reach(max_bits)
    code = _codes(fp, table)
    order = np.argsort(code, kind="stable")
    code, fp, node = code[order], fp[order], node[order]
    # going round the tables from some start, the bits that differ stay below the sum of t + 1 after each: that start's pair is enough
    wide, most = _codes(fp, table, 2).view(np.uint64), t[table] + t[(table + 1) % TABLES] + 1
    columns = [np.ascontiguousarray(x) for x in fp.view(np.uint64).T]
    for left, low, high in _probes(code, t[table], part, width):
        for x, y in _met(left, low, high):
            ok = np.flatnonzero(np.bitwise_count(wide[x] ^ wide[y]) <= most)
            x, y = x[ok], y[ok]
            ok = root[node[x]] != root[node[y]]
            x, y = x[ok], y[ok]
            apart = np.zeros(len(x), np.uint16)
            for c in columns:  # exact from the first word on: what differs too much already is left out
                apart += np.bitwise_count(c[x] ^ c[y])
                ok = apart <= max_bits
                x, y, apart = x[ok], y[ok], apart[ok]
            if len(x):
                root = _roots(len(root), node[x], node[y], root)
    return root


def _join(max_bits: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        cell = table.column("cell").to_numpy()
        order = np.argsort(cell, kind="stable")
        id_ = table.column("doc_id").combine_chunks()
        fp = _raw(table.column("fp"))
        distinct = id_.unique().sort()
        node = np.asarray(pc.index_in(id_, distinct), dtype=np.int64)
        root = np.arange(len(distinct))
        bounds = np.flatnonzero(np.diff(cell[order], prepend=-1, append=-1))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            kind = int(cell[order[a]]) >> WIDTH
            rows, t = order[a:b], reach(max_bits)[kind >> 5]
            root = _near(fp[rows], node[rows], root, max_bits, kind >> 5, kind & 31, _parts(t, bits)[1])
        child = np.flatnonzero(root != np.arange(len(distinct)))
        yield pa.RecordBatch.from_arrays([distinct.take(pa.array(child)), distinct.take(pa.array(root[child]))], names=["u", "v"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(u, v) for every node u of the undirected edges (u, v) that isn't the smallest of its component: v is that one.

    Alternating large and small stars; each round is written, so lineage stays short and a lost executor costs little.
    """
    both = lambda e: e.union(e.select("v", "u"))
    least = F.min("v").over(Window.partitionBy("u"))

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    was = mark(e)
    while was[0]:
        large = both(e).withColumn("m", F.least("u", least)).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.withColumn("m", least)
        small = small.select("u", F.col("m").alias("v")).union(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        e = written(small)
        now = mark(e)
        if now == was:
            break
        was = now
    return e


def _prints(rows: DataFrame) -> DataFrame:
    """rows with the fingerprint fp in place of the text, without those whose text is null or has no word, written."""
    kept = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                fp, ok = fingerprints(batch.column("text"))
                raw = pa.array([x.tobytes() for x in fp], pa.binary())
                yield pa.RecordBatch.from_arrays([*map(batch.column, kept), raw], names=[*kept, "fp"]).filter(pa.array(ok))

    schema = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept]
    return written(spread(rows.where("text is not null")).mapInArrow(run, ", ".join([*schema, "fp binary"])))


def _edges(one: DataFrame, n: int, max_bits: int, rows_at_once: int) -> DataFrame:
    """(u, v) of ids whose edges join what is near, from n rows (doc_id, fp) of different fingerprints."""
    kind, bits = one.schema["doc_id"].dataType.simpleString(), max(0, (n - 1) // rows_at_once).bit_length()
    return one.mapInArrow(_copies(max_bits, bits), f"cell bigint, doc_id {kind}, fp binary").repartition("cell").mapInArrow(_join(max_bits, bits), f"u {kind}, v {kind}")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, rows_at_once: int = ROWS_AT_ONCE) -> DataFrame:
    """A row (doc_id, duplicate_of) for every document that is near, directly or over others, to one with a smaller id.

    duplicate_of is the smallest id of the group, which has no row itself.  Rows with a null id or a null, empty or wordless
    text are near nothing.  Rows that share an id are one document: what either text is near to is near to it.  Other
    columns are not read; an empty table gives no rows.
    """
    prints = _prints(docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text")).where("doc_id is not null"))
    first = written(prints.groupBy("fp").agg(F.min("doc_id").alias("v"), F.count("*").alias("n")))
    one = first.select(F.col("v").alias("doc_id"), "fp")
    copies = prints.join(first.where("n > 1").select("fp", "v"), "fp").where("doc_id <> v")
    edges = _edges(one, first.count(), max_bits, rows_at_once).union(copies.select(F.col("doc_id").alias("u"), "v"))
    return components(edges).select(F.col("u").alias("doc_id"), F.col("v").alias("duplicate_of"))


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, rows_at_once: int = ROWS_AT_ONCE, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """docs with one row of each group of rows whose texts are near, directly or over others, whatever their ids.

    The rows of a group are ordered by id, nulls last, then by a hash of the row, and the first stays: rows without an id and
    texts that share an id are compared like all others.  A row repeated as a whole stays or goes as one; rows without a word
    all stay.  All columns stay as they were, whatever their names; removed rows are broadcast up to `broadcast_rows`.
    """
    at = F.struct(col(id_col).isNull().alias("last"), col(id_col).alias("id"), row_hash(docs).alias("tie"))
    prints = _prints(docs.select(at.alias("at"), col(text_col).alias("text")))
    # numbers in the order of the rows stand for them in the join, so that the least of a group is its first row
    first = written(prints.groupBy("fp").agg(F.min("at").alias("at")).orderBy("at").select("at", "fp", F.monotonically_increasing_id().alias("v")))
    edges = _edges(first.select(F.col("v").alias("doc_id"), "fp"), first.count(), max_bits, rows_at_once)
    stays = first.join(components(edges).select(F.col("u").alias("v")), "v", "left_anti").select("at")
    removed, tie = fresh(docs, "removed_id", "removed_tie")
    gone = written(prints.join(stays, "at", "left_anti").select(F.col("at.id").alias(removed), F.col("at.tie").alias(tie)))
    return docs.join(sized(gone, broadcast_rows), col(id_col).eqNullSafe(F.col(removed)) & (row_hash(docs) == F.col(tie)), "left_anti")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """docs without the rows whose id near_duplicates names: of each group the document with the smallest id stays.

    All columns stay as they were, whatever their names; rows without an id or a word all stay, as do repeated rows of a document
    that stays.  The removed ids are broadcast up to `broadcast_rows`, and joined by a shuffle beyond.
    """
    (removed,) = fresh(docs, "removed_id")
    gone = near_duplicates(docs, id_col, text_col, max_bits).select(F.col("doc_id").alias(removed))
    return docs.join(sized(gone, broadcast_rows), col(id_col) == F.col(removed), "left_anti")
