"""Exact top-k search by pivot-table elimination.

Distances from all vectors to many pivots are computed once.  Together they fix where a vector lies in the pivots' span and how
far off it: its row of the pivot table.  The distance of two rows is the greatest lower bound of their vectors' distance that
the pivots allow, never below the largest difference of pivot distances that the triangle inequality gives.

Rows are stored in blocks, rings around one centre each, with the block's middle and radius and the range of its distances to
the pivots.  A task takes a group of close queries and visits blocks in the order of the group's least bounds; a query takes
part in a block only if its own bound is within its k-th distance so far, and evaluates candidates in the order of their bounds
until the next exceeds it: what is left out can't be a neighbour.

Blocks are files in the shared folder that workers map into memory.  Only the pivots and centres, which are few, are broadcast.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscle.llm.common import col, posix_dir, released, written
from corpuscle.llm.hashing import mix

TOP = 10
#: Pivots at most; there are as many as three quarters of the dimensions, and no fewer than eight if the sample has them.
PIVOTS = 64
#: Vectors of the bounded, hash-ordered sample that pivots and centres are chosen from.
SAMPLE = 4096
#: Centres at most; their number grows with the root of the rows.
CENTRES = 256
#: Rows of a block at least, and blocks at most: beyond both, blocks grow.
BLOCK, BLOCKS = 4096, 32_768
#: Queries of a task.
GROUP = 128
_RINGS = 256
#: Pairs that a step evaluates one by one; if more of a block are left it multiplies matrices.
_SPARSE = 0.05
#: Candidates of each query that are evaluated before a block's many are looked at again.
_FIRST = 16
#: Similarities are compared as rounded to so many decimals; ties go to the smaller id.
DECIMALS = 6
#: What bounds may be off by for rounding.
_EPSILON = 1e-7


def spread(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to n distinct vectors of the sample, each farthest from those before it."""
    if not len(sample):
        return sample
    chosen = [0]
    least = np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < n and least.max() > 1e-9:
        chosen.append(int(np.argmax(least)))
        least = np.minimum(least, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (x @ y.T), 0))


class Pivots:
    """Pivots, and the change from distances to them into coordinates of their span."""

    def __init__(self, pivots: np.ndarray) -> None:
        self.vectors = pivots
        # columns that turn products with the pivots into orthonormal coordinates; near-dependent pivots give no direction
        value, vector = np.linalg.eigh(pivots @ pivots.T)
        good = value > 1e-8 * max(1.0, value.max(initial=0))
        self.turn = vector[:, good] / np.sqrt(value[good])

    def rows(self, to_pivots: np.ndarray) -> np.ndarray:
        """Coordinates within the span and, last, the distance from it, of unit vectors with these distances to the pivots."""
        inside = (1 - to_pivots**2 / 2) @ self.turn
        return np.concatenate([inside, np.sqrt(np.maximum(1 - (inside**2).sum(axis=1, keepdims=True), 0))], axis=1)


def _unit(column: pa.Array) -> np.ndarray:
    x = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _save(path: str, what: str, array: np.ndarray) -> None:
    temporary = f"{path}.{what}.{uuid.uuid4().hex}.tmp"
    with open(temporary, "wb") as f:
        np.save(f, array)
    os.replace(temporary, f"{path}.{what}.npy")  # a task that runs twice writes the same


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for b in batches:
        block, id_, x = b.column("block").to_numpy(), b.column("id").to_numpy(), _unit(b.column("vector"))
        for k in np.unique(block).tolist():
            parts.setdefault(k, []).append((id_[block == k], x[block == k]))
    for k, rows in parts.items():
        id_, x = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
        order = np.argsort(id_, kind="stable")
        yield k, id_[order], x[order]


def _store(path: str, shared):  # noqa: ANN001
    """Writes a block's ids, vectors and pivot table; emits its middle and radius there and the ranges of its pivot distances."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots: Pivots = shared.value[0]
        os.makedirs(path, exist_ok=True)
        for k, id_, x in _by_block(batches):
            d = distances(x, pivots.vectors)
            rows = pivots.rows(d)
            for what, array in (("ids", id_), ("vectors", x), ("rows", rows)):
                _save(f"{path}/{k}", what, array)
            middle = rows.mean(axis=0)
            radius = float(np.sqrt(((rows - middle) ** 2).sum(axis=1).max())) + _EPSILON
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([middle.tolist()]), pa.array([radius]), pa.array([d.min(axis=0).tolist()]), pa.array([d.max(axis=0).tolist()])],
                names=["block", "middle", "radius", "low", "high"],
            )

    return run


class Blocks:
    """The blocks' summaries, read once by a worker, and bounds of queries to them."""

    def __init__(self, path: str) -> None:
        self.path = path
        t = pq.read_table(f"{path}/summaries", columns=["block", "middle", "radius", "low", "high"]).combine_chunks()
        self.block, self.radius = t["block"].to_numpy(), t["radius"].to_numpy()
        self.middle, self.low, self.high = (np.asarray(t[c].combine_chunks().flatten()).reshape(len(t), -1) for c in ("middle", "low", "high"))

    def load(self, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return tuple(np.load(f"{self.path}/{self.block[at]}.{what}.npy", mmap_mode="r") for what in ("ids", "vectors", "rows"))

    def bounds(self, rows: np.ndarray, to_pivots: np.ndarray) -> np.ndarray:
        """Per query and block the least distance that the block's ball and its ranges allow."""
        apart = (rows**2).sum(axis=1)[:, None] + (self.middle**2).sum(axis=1) - 2 * rows @ self.middle.T
        bound = np.sqrt(np.maximum(apart, 0)) - self.radius
        for p in range(to_pivots.shape[1]):
            d = to_pivots[:, p, None]
            np.maximum(bound, np.maximum(d - self.high[:, p], self.low[:, p] - d), out=bound)
        return bound


class Best:
    """The k best (rounded similarity, id) of each query of a group."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.sim = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, query: np.ndarray, ids: np.ndarray, sim: np.ndarray) -> None:
        """Takes in found (query, id, similarity) triples, a list of each."""
        sim = np.round(sim, DECIMALS)
        some = sim >= self.sim[query, -1]
        query, ids, sim = query[some], ids[some], sim[some]
        if not len(query):
            return
        who = np.unique(query)
        q = np.concatenate([np.repeat(who, self.k), query])
        s, i = np.concatenate([self.sim[who].ravel(), sim]), np.concatenate([self.ids[who].ravel(), ids])
        order = np.lexsort((i, -s, q))
        q = q[order]
        first = np.searchsorted(q, who)
        pick = order[(first[:, None] + np.arange(self.k)).ravel()]
        self.sim[who], self.ids[who] = s[pick].reshape(-1, self.k), i[pick].reshape(-1, self.k)

    def reach(self) -> np.ndarray:
        """Per query the distance beyond which nothing can enter its list, rounding included."""
        worst = self.sim[:, -1]
        out = np.full(len(worst), np.inf)
        full = worst > -np.inf
        out[full] = np.sqrt(np.maximum(0.0, 2 - 2 * (worst[full] - 10.0**-DECIMALS))) + _EPSILON
        return out


def search_block(best: Best, live: np.ndarray, q_ids: np.ndarray, q: np.ndarray, q_rows: np.ndarray, ids: np.ndarray, x: np.ndarray, rows: np.ndarray) -> int:
    """Takes a block's candidates into the lists of the live queries; how many pairs were evaluated exactly."""
    def least(of: np.ndarray) -> np.ndarray:
        reach = best.reach()[of]
        return np.where(np.isinf(reach), -2.0, 1 - reach**2 / 2) - _EPSILON

    # the product of two rows bounds that of their vectors from above: least distance, as product
    bound = q_rows[live] @ rows.T
    near = bound >= least(live)[:, None]
    done = 0
    if near.sum() > _SPARSE * near.size and len(ids) > _FIRST:  # each query's most promising candidates shorten its reach
        top = np.argpartition(bound, len(ids) - _FIRST, axis=1)[:, -_FIRST:]
        a, b = np.repeat(live, _FIRST), top.ravel()
        other = q_ids[a] != ids[b]
        best.add(a[other], ids[b[other]], np.einsum("ij,ij->i", q[a[other]], x[b[other]]))
        done += int(other.sum())
        np.put_along_axis(bound, top, -3.0, 1)
        near = bound >= least(live)[:, None]
    found = int(near.sum())
    if not found:
        return done
    if found > _SPARSE * near.size:  # many are left: one product of matrices for those that any query needs
        columns = np.flatnonzero(near.any(axis=0))
        sim = q[live] @ np.asarray(x[columns]).T
        hit = sim >= best.sim[live, -1][:, None] - 10.0**-DECIMALS
        hit &= (q_ids[live][:, None] != ids[columns]) & (bound[:, columns] > -3)
        a, b = np.nonzero(hit)
        best.add(live[a], ids[columns[b]], sim[a, b])
        return done + sim.size
    a, b = np.nonzero(near)
    order = np.argsort(-bound[a, b], kind="stable")  # the most promising first, in steps that shrink what is left
    a, b, limit = live[a[order]], b[order], bound[a[order], b[order]]
    step = 2048
    while len(a):
        i, j = a[:step], b[:step]
        other = q_ids[i] != ids[j]
        i, j = i[other], j[other]
        best.add(i, ids[j], np.einsum("ij,ij->i", q[i], x[j]))
        done += len(i)
        a, b, limit = a[step:], b[step:], limit[step:]
        keep = limit >= least(a)
        a, b, limit = a[keep], b[keep], limit[keep]
    return done


def search(blocks: Blocks, pivots: Pivots, q_ids: np.ndarray, q: np.ndarray, k: int) -> tuple[Best, int]:
    """The lists of a group of queries, and how many pairs were evaluated exactly."""
    best, evaluated = Best(len(q), k), 0
    to_pivots = distances(q, pivots.vectors)
    rows = pivots.rows(to_pivots)
    bounds = blocks.bounds(rows, to_pivots)
    for b in np.argsort(bounds.min(axis=0), kind="stable").tolist():
        live = np.flatnonzero(bounds[:, b] <= best.reach())
        if len(live):
            evaluated += search_block(best, live, q_ids, q, rows, *blocks.load(b))
        elif bounds[:, b].min() > best.reach().max():
            break
    return best, evaluated


def _search(path: str, shared, k: int):  # noqa: ANN001
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = None
        for _, q_ids, q in _by_block(batches):
            blocks = blocks or Blocks(path)
            for a in range(0, len(q), GROUP):
                best, _ = search(blocks, shared.value[0], q_ids[a : a + GROUP], q[a : a + GROUP], k)
                ok = best.sim > -np.inf
                rank = np.broadcast_to(np.arange(1, k + 1, dtype=np.int32), best.sim.shape)
                owner = np.broadcast_to(q_ids[a : a + GROUP, None], best.sim.shape)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owner[ok]), pa.array(best.ids[ok]), pa.array(rank[ok]), pa.array(best.sim[ok] + 0.0)], names=["vec_id", "neighbor_id", "rank", "similarity"]
                )

    return run


def _valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = col(vector_col)
    norm = F.aggregate(v, F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = vectors.select(col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("vector"), norm.alias("norm"))
    return rows.where("id is not null and norm > 0 and norm < double('infinity') and not isnan(norm)").drop("norm").distinct()


def _numbered(ringed: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """By centre and ring the first block and how many, and how many blocks there are: a centre's rings fill blocks in turn.

    A ring larger than a block is spread over several.  There are CENTRES x _RINGS counts at most.
    """
    first, parts, blocks, room, last = np.zeros(CENTRES * _RINGS, np.int32), np.ones(CENTRES * _RINGS, np.int32), 0, 0, None
    for cell, ring, n in sorted((r["cell"], r["ring"], r["count"]) for r in ringed.groupBy("cell", "ring").count().collect()):
        at = cell * _RINGS + ring
        if n > size:
            first[at], parts[at] = blocks, -(-n // size)
            blocks, room = blocks + int(parts[at]), 0
        else:
            if cell != last or n > room:
                blocks, room = blocks + 1, size
            first[at], room = blocks - 1, room - n
        last = cell
    return first, parts, blocks


def _in_blocks(ringed: DataFrame, size: int, most: int) -> DataFrame:
    """Rows (id, vector, block), exchanged by block; rows of a ring that is spread go by a hash of their id."""
    first, parts, blocks = _numbered(ringed, size)
    shared = ringed.sparkSession.sparkContext.broadcast((first, parts))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, parts = shared.value
        for b in batches:
            at = b.column("cell").to_numpy() * _RINGS + b.column("ring").to_numpy()
            block = first[at] + (mix(b.column("id").to_numpy().astype(np.uint64)) % parts[at].astype(np.uint64)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("vector"), pa.array(block, pa.int32())], names=["id", "vector", "block"])

    n = max(1, min(blocks, most))
    return ringed.mapInArrow(number, "id long, vector array<double>, block int").repartitionById(n, F.pmod("block", F.lit(n)))


def top_k(
    vectors: DataFrame, queries: DataFrame | None = None, k: int = TOP, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int | None = None, block: int = BLOCK
) -> DataFrame:
    """Rows (vec_id, neighbor_id, rank, similarity): for every vector of queries the k others of highest cosine among vectors.

    As exact as brute force.  By default every vector is a query.  Similarity is rounded to six decimals and ties go to the
    smaller id.  Vectors that are null, empty, zero, not finite, of another length than the most common one of `vectors`, or
    without an id are neither queries nor neighbours.  Rows equal in id and vector count once; a vector of the same id isn't a
    neighbour.  With fewer than k others all of them are returned.  Ids must be integers.  Other columns are not read, so their
    names can't clash.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = written(_valid(vectors, id_col, vector_col))
    width = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "vec_id long, neighbor_id long, rank int, similarity double"
    if width is None:
        return spark.createDataFrame([], schema)
    n, wide = width["count"], F.size("vector") == width["n"]
    rows = rows.where(wide)
    asked = rows if queries is None else _valid(queries, id_col, vector_col).where(wide)
    # of more rows than needed those of the lowest hashes, twice as many as wanted, are sorted for the sample
    bound = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) < int(min(1.0, 2 * SAMPLE / n) * (1 << 30)) + 1
    sample = rows.where(bound).orderBy(F.xxhash64("id"), "id", F.xxhash64("vector")).limit(SAMPLE).select("vector").toArrow()["vector"].combine_chunks()
    sample = _unit(sample) if len(sample) else _unit(rows.limit(1).select("vector").toArrow()["vector"].combine_chunks())
    table = Pivots(spread(sample, pivots or min(PIVOTS, max(8, width["n"] * 3 // 4))))
    centres = spread(sample, int(min(CENTRES, max(8, n**0.5 / 16))))
    shared = spark.sparkContext.broadcast((table, centres))

    def ring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                d = distances(_unit(b.column("vector")), shared.value[1])
                cell = np.argmin(d, axis=1)
                at = np.minimum(d[np.arange(len(d)), cell] * (_RINGS / 2), _RINGS - 1).astype(np.int32)  # unit vectors are 2 apart at most
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("vector"), pa.array(cell, pa.int32()), pa.array(at, pa.int32())], names=["id", "vector", "cell", "ring"])

    kind = "id long, vector array<double>, cell int, ring int"
    ringed = written(rows.mapInArrow(ring, kind))
    path = posix_dir(spark, "vectors")
    blocks = _in_blocks(ringed, max(block, -(-n // BLOCKS)), BLOCKS)
    with released(spark):
        blocks.mapInArrow(_store(path, shared), "block int, middle array<double>, radius double, low array<double>, high array<double>").write.parquet(f"file://{path}/summaries")
    # queries near each other share a task: those of a centre in the order of their distance
    asked = ringed if queries is None else written(asked.mapInArrow(ring, kind))
    return _in_blocks(asked, GROUP, 1 << 16).mapInArrow(_search(path, shared, k), schema)
