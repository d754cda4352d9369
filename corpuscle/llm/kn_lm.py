"""Scoring with an interpolated modified Kneser-Ney n-gram model.

Words are numbered, frequent ones first, in a vocabulary of sorted 64-bit hashes.  Counting: each task numbers the words of its
texts, combines equal n-grams and sends their numbers, as compressed planes of bytes, to the bucket of their context.  A bucket
merges them, writes its part of the model and hands the (n-1)-grams' continuation counts down to the next level.

The model is a file per level and bucket in the shared folder: sorted hashes of n-grams with counts of one byte, sorted hashes
of contexts with the sums that the discounts need, and lists of the counts that exceed a byte.  A directory of their leading
bits leaves 32 bits of each hash to store; with the bucket's and the directory's bits, n-grams are told apart by about 54 bits.
Workers map the files into memory, so a node holds one copy and nothing that grows with the data is broadcast.  Scoring is one
map over the texts.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.llm.common import col, posix_dir, released, remove, spread
from corpuscle.llm.hashing import mix, slices, words

ORDER = 3
#: Buckets of the model, a power of two at least; a bucket's n-grams are merged in one task's memory.
BUCKETS = 64
#: Text of a bucket where the buckets follow the input's size.
BUCKET_CHARS = 16 << 20
#: Files of the vocabulary at most.
WORD_BUCKETS = 1024
_BEGIN, _END, _UNKNOWN, _FIRST = 0, 1, 2, 3
_AT_ONCE = 1 << 21
#: Bytes of text that are scored at once.
_TEXT = 1 << 22
#: Classes of word frequency, by powers of two.
_CLASSES = 64
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MANY = 255
_STATS = 7


# ---- files of arrays


def _write(path: str, arrays: dict[str, np.ndarray]) -> None:
    """Arrays one after another behind a line that describes them; a task that runs twice writes the same."""
    temporary, at, head = f"{path}.{uuid.uuid4().hex}.tmp", 0, {}
    for name, x in arrays.items():
        head[name] = (x.dtype.str, x.shape, at)
        at += -(-x.nbytes // 64) * 64
    line = json.dumps(head).encode()
    line += b" " * (-(len(line) + 1) % 64) + b"\n"
    with open(temporary, "wb") as f:
        f.write(line)
        for x in arrays.values():
            f.write(np.ascontiguousarray(x).tobytes() + b"\0" * (-x.nbytes % 64))
    os.replace(temporary, path)


def _read(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped into memory."""
    raw = np.asarray(np.memmap(path, np.uint8, "r"))
    with open(path, "rb") as f:
        line = f.readline()
    out = {}
    for name, (kind, shape, at) in json.loads(line).items():
        size = np.dtype(kind).itemsize * int(np.prod(shape))
        out[name] = raw[len(line) + at :][:size].view(kind).reshape(shape)
    return out


@dataclass
class Model:
    path: str
    order: int
    buckets: int
    #: Number of the first word of each class in each file of the vocabulary, and how many words there are.
    first: np.ndarray
    types: int
    #: By n: discounts for counts 1, 2 and more.
    discounts: dict[int, list[float]] = field(default_factory=dict)
    #: Of level 1: sum of counts, types with count 1, 2 and more, all types.
    unigrams: list[int] = field(default_factory=lambda: [0] * 5)
    files: dict = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"files": {}}

    def part(self, what: str, bucket: int) -> dict[str, np.ndarray]:
        """The arrays of a level's or the vocabulary's file; none where the bucket is empty."""
        key = (what, bucket)
        if key not in self.files:
            if len(self.files) >= 4096:
                self.files.clear()
            name = f"{self.path}/{what}/{bucket}"
            self.files[key] = _read(name) if os.path.exists(name) else {}
        return self.files[key]

    @property
    def width(self) -> int:
        """Bytes of a word's number."""
        return -(-(self.types + _FIRST).bit_length() // 8)

    @property
    def kind(self) -> type:
        return np.uint32 if self.width <= 4 else np.uint64

    def numbers(self, word: np.ndarray) -> np.ndarray:
        """Numbers of words by their hashes; _UNKNOWN for words it lacks."""

        def find(part: dict, bucket: int, asked: np.ndarray) -> np.ndarray:
            at = np.minimum(np.searchsorted(part["words"], asked), len(part["words"]) - 1)
            return np.where(part["words"][at] == asked, self.first[part["class"][at], bucket] + part["place"][at], _UNKNOWN)

        return self._each_bucket("words", self.first.shape[1], word, find, np.zeros(0, np.int64), _UNKNOWN).astype(self.kind)

    def _each_bucket(self, what: str, buckets: int, key: np.ndarray, find, like: np.ndarray, none: int = 0) -> np.ndarray:  # noqa: ANN001
        """Per key a row of the kind of `like`: find() of the distinct keys in their bucket's file, in its order, `none` where there is no file."""
        order = np.argsort(key)
        sorted_ = key[order]
        new = np.append(True, sorted_[1:] != sorted_[:-1]) if len(key) else np.zeros(0, bool)
        asked = sorted_[new]
        out = np.full((len(asked), *like.shape[1:]), none, like.dtype)
        bucket = _bucket(asked, buckets)
        edges = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(asked)) if len(asked) else np.zeros(1, np.int64)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            part = self.part(what, int(bucket[a]))
            if part:
                out[a:b] = find(part, int(bucket[a]), asked[a:b])
        result = np.empty((len(key), *like.shape[1:]), like.dtype)
        result[order] = out[np.cumsum(new) - 1]
        return result

    def counts(self, n: int, key: np.ndarray) -> np.ndarray:
        """Counts of n-grams by their keys, 0 for those it lacks."""

        def find(part: dict, _: int, asked: np.ndarray) -> np.ndarray:
            at, hit = _places(part, "keys", asked, self.buckets)
            return np.where(hit, _wide(part, "counts", at), 0)

        return self._each_bucket(str(n), self.buckets, key, find, np.zeros(0))

    def sums(self, n: int, context: np.ndarray) -> np.ndarray:
        """Of contexts, the sum of their n-grams' counts and how many have count 1, 2 and more; zeros for those it lacks."""

        def find(part: dict, _: int, asked: np.ndarray) -> np.ndarray:
            out = np.zeros((len(asked), 4))
            at, hit = _places(part, "many", asked, self.buckets)
            out[hit] = np.stack([_wide(part, f"many_{k}", at[hit]) for k in range(4)], axis=1)
            at, hit = _places(part, "one", asked, self.buckets)
            c = _wide(part, "one_count", at[hit])
            out[hit] = np.stack([c, c == 1, c == 2, c > 2], axis=1)
            return out

        return self._each_bucket(str(n), self.buckets, context, find, np.zeros((0, 4)))


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    """A hash's leading bits."""
    return (key >> np.uint64(64 - buckets.bit_length() + 1)).astype(np.int64) if buckets > 1 else np.zeros(len(key), np.int64)


def _coded(name: str, key: np.ndarray, buckets: int) -> dict[str, np.ndarray]:
    """A bucket's sorted hashes: per value of their leading bits, some four to eight hashes each, where it begins, and 32 bits of each."""
    skip = buckets.bit_length() - 1
    bits = (len(key) // 8).bit_length()
    key = key << np.uint64(skip)
    lead = (key >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(key), np.int64)
    begin = np.searchsorted(lead, np.arange((1 << bits) + 1))
    return {name: (key << np.uint64(bits) >> np.uint64(32)).astype(np.uint32), f"{name}_begin": begin.astype(np.uint32 if len(key) < 1 << 32 else np.uint64)}


def _places(part: dict[str, np.ndarray], name: str, asked: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each asked hash is among the coded ones, and whether it is there."""
    low, begin = part[name], part[f"{name}_begin"]
    bits = (len(begin) - 1).bit_length() - 1
    asked = asked << np.uint64(buckets.bit_length() - 1)
    lead = (asked >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(asked), np.int64)
    want = (asked << np.uint64(bits) >> np.uint64(32)).astype(np.uint32)
    at, end = begin[lead].astype(np.int64), begin[lead + 1].astype(np.int64)
    if not len(low) or not len(asked):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    last, stop = len(low) - 1, end
    for _ in range(int((end - at).max()).bit_length()):
        middle = (at + end) >> 1
        less = (middle < end) & (low[np.minimum(middle, last)] < want)
        at, end = np.where(less, middle + 1, at), np.where(less, end, middle)
    at = np.minimum(at, last)
    return at, (at < stop) & (low[at] == want)


def _narrow(name: str, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Counts as bytes; those that exceed one are listed in full."""
    over = np.flatnonzero(counts >= _MANY)
    return {name: np.minimum(counts, _MANY).astype(np.uint8), f"{name}_at": over, f"{name}_over": counts[over].astype(np.uint64)}


def _wide(part: dict[str, np.ndarray], name: str, at: np.ndarray) -> np.ndarray:
    if not len(at) or not len(part[name]):
        return np.zeros(len(at))
    out = part[name][at].astype(np.float64)
    over = np.flatnonzero(out == _MANY)
    out[over] = part[f"{name}_over"][np.searchsorted(part[f"{name}_at"], at[over])]
    return out


# ---- n-grams


def _hash(columns: list[np.ndarray]) -> np.ndarray:
    """One hash of several columns of word numbers; how many there are counts."""
    out = np.full(len(columns[0]), len(columns), np.uint64)
    for c in columns:
        out *= _MULTIPLIER
        out += c
        out = mix(out + np.uint64(1))
    return out


def _contexts(columns: list[np.ndarray]) -> np.ndarray:
    """What n-grams are bucketed by: the hash of their context, or of the word itself where there is none."""
    return _hash(columns[:-1] if len(columns) > 1 else columns)


def _keys(columns: list[np.ndarray], context: np.ndarray, buckets: int) -> np.ndarray:
    """Hashes of n-grams that begin with the bits of their context's bucket."""
    bits = np.uint64(buckets.bit_length() - 1)
    top = context >> (np.uint64(64) - bits) << (np.uint64(64) - bits) if buckets > 1 else np.uint64(0)
    return top | (_hash(columns) >> bits)


def _grams(texts: pa.Array, model: Model) -> tuple[list[np.ndarray], np.ndarray]:
    """The n-grams that end in each word or text end, a column of numbers per place, and how many each text has."""
    word, at = words(texts)
    size, order = np.diff(at), model.order
    some = size > 0
    each = np.where(some, size + 1, 0)
    stream = np.full(len(word) + int(some.sum()) * order, _BEGIN, model.kind)
    start = np.cumsum(size[some] + order) - (size[some] + order)
    place = np.arange(len(word)) + np.repeat(start + order - 1 - at[:-1][some], size[some])
    stream[place] = model.numbers(word)
    last = start + order - 1 + size[some]
    stream[last] = _END
    ends = np.sort(np.concatenate([place, last]))
    return [stream[ends - (order - 1) + k] for k in range(order)], each


def _merged(columns: list[np.ndarray], counts: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Distinct n-grams in the order of their keys: (keys, columns, sums of counts)."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first], [c[order[first]] for c in columns], np.add.reduceat(counts[order], first) if len(key) else counts


def _planes(x: np.ndarray, width: int) -> bytes:
    """Numbers as planes of bytes, lowest first: like bytes side by side compress well."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _packed(columns: list[np.ndarray], counts: np.ndarray, key: np.ndarray, buckets: int, width: int) -> pa.RecordBatch:
    """A row (bucket, payload, null) per bucket, of n-grams with those of a context side by side."""
    lead = columns[0].astype(np.uint64)
    if len(columns) > 1 and columns[1].dtype == np.uint32:
        lead = lead << np.uint64(32) | columns[1]
    order = np.argsort(lead)
    bucket = _bucket(key[order], buckets)
    by = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
    order, bucket = order[by], bucket[by]
    columns, counts = [c[order] for c in columns], counts[order]
    cut = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket)) if len(bucket) else np.zeros(1, np.int64)
    payload = []
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        c = counts[a:b]
        over = np.flatnonzero(c >= _MANY)
        head = int(b - a).to_bytes(4, "little") + len(over).to_bytes(4, "little")
        tail = [_planes(np.minimum(c, _MANY), 1), over.astype("<u4").tobytes(), c[over].astype("<u8").tobytes()]
        payload.append(head + pa.compress(b"".join([*[_planes(x[a:b], width) for x in columns], *tail]), "zstd", asbytes=True))
    return _rows(bucket[cut[:-1]], payload, [None] * len(payload))


def _rows(bucket: np.ndarray | list[int], payload: list, stats: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(payload, pa.binary()), pa.array(stats, pa.list_(pa.int64()))], names=["bucket", "payload", "stats"])


def _unpacked(payload: bytes, n: int, width: int) -> tuple[list[np.ndarray], np.ndarray]:
    size, more = int.from_bytes(payload[:4], "little"), int.from_bytes(payload[4:8], "little")
    at = n * width * size
    raw = pa.decompress(payload[8:], at + size + 12 * more, "zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8, at).reshape(n, width, size)
    columns = []
    for k in range(n):
        x = np.zeros((size, 4 if width <= 4 else 8), np.uint8)
        x[:, :width] = planes[k].T
        columns.append(x.view("<u4" if width <= 4 else "<u8").ravel())
    counts = np.frombuffer(raw, np.uint8, size, at).astype(np.int64)
    if more:
        counts[np.frombuffer(raw, "<u4", more, at + size)] = np.frombuffer(raw, "<u8", more, at + size + 4 * more)
    return columns, counts


# ---- steps of the fit


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in ascending order and the sums of their counts."""
    h, n = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
    order = np.argsort(h)
    h = h[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
    return h[first], np.add.reduceat(n[order], first) if len(h) else n


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for whole in batches:
        for batch in slices(whole, 0):
            held.append(np.unique(words(batch.column(0))[0], return_counts=True))
            size += len(held[-1][0])
            if size > _AT_ONCE:
                held = [_summed(held)]
                size = len(held[0][0])
                if size > _AT_ONCE // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), pa.array(held[0][1])], names=["h", "n"])
                    held, size = [], 0
    if size:
        h, n = _summed(held)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])


def _save_words(path: str, buckets: int):
    """Writes a bucket of the vocabulary: sorted hashes, their classes and places among the class; tells the classes' sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, most = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0, _AT_ONCE
        for b in batches:
            held.append((b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy()))
            size += b.num_rows
            if size > most:
                held = [_summed(held)]
                size = len(held[0][0])
                most = max(_AT_ONCE, 2 * size)
        word, n = _summed(held)
        if len(word):
            kind = (_CLASSES - np.frexp(n.astype(np.float64))[1]).astype(np.uint8)
            order = np.argsort(kind, kind="stable")
            sizes = np.bincount(kind, minlength=_CLASSES)
            place = np.empty(len(word), np.uint32)
            place[order] = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            bucket = int(_bucket(word[:1], buckets)[0])
            os.makedirs(f"{path}/words", exist_ok=True)
            _write(f"{path}/words/{bucket}", {"words": word, "class": kind, "place": place})
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([sizes.tolist()], pa.list_(pa.int64()))], names=["bucket", "sizes"])

    return run


def _vocabulary(texts: DataFrame, path: str, buckets: int) -> tuple[np.ndarray, int]:
    """Saves the vocabulary of all texts; the number of the first word of each class in each file, and how many words there are."""
    bits = buckets.bit_length() - 1
    bucket = F.shiftrightunsigned("h", 64 - bits).cast("int") if bits else F.lit(0)
    sizes = texts.mapInArrow(_count_words, "h long, n long").repartitionById(buckets, bucket).mapInArrow(_save_words(path, buckets), "bucket int, sizes array<long>")
    with released(texts.sparkSession):
        sizes.write.parquet(f"file://{path}/word-counts")
    n = np.zeros((_CLASSES, buckets), np.int64)
    for r in texts.sparkSession.read.parquet(f"file://{path}/word-counts").collect():  # WORD_BUCKETS rows at most
        n[:, r["bucket"]] = r["sizes"]
    before = np.cumsum(n).reshape(n.shape) - n  # class by class, frequent ones first
    return before + _FIRST, int(n.sum())


def _count(shared, buckets: int):  # noqa: ANN001
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        held: list[list[np.ndarray]] = []
        n = 0

        def flush() -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            key, columns, counts = _merged(columns, np.ones(len(columns[0]), np.int64), _keys(columns, _contexts(columns), buckets))
            return _packed(columns, counts, key, buckets, model.width)

        for whole in batches:
            for batch in slices(whole, 0):
                columns, _ = _grams(batch.column(0), model)
                held.append(columns)
                n += len(columns[0])
                if n >= _AT_ONCE:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    return run


def _level(path: str, n: int, buckets: int, width: int):
    """Merges a bucket's n-grams, writes its part of level n, and emits the level below and its statistics."""

    def merged(held: list[tuple]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        columns, counts = [np.concatenate([h[0][k] for h in held]) for k in range(n)], np.concatenate([h[1] for h in held])
        held.clear()
        return _merged(columns, counts, _keys(columns, _contexts(columns), buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[tuple]] = {}
        size: dict[int, int] = {}
        most: dict[int, int] = {}
        for batch in batches:
            for b, p in zip(batch.column("bucket").to_pylist(), batch.column("payload"), strict=True):
                held = parts.setdefault(b, [])
                held.append(_unpacked(p.as_py(), n, width))
                size[b] = size.get(b, 0) + len(held[-1][1])
                if size[b] > most.get(b, _AT_ONCE):  # a frequent context comes from every task: memory follows its distinct n-grams
                    held[:] = [merged(held)[1:]]
                    size[b] = len(held[0][1])
                    most[b] = max(_AT_ONCE, 2 * size[b])
        os.makedirs(f"{path}/{n}", exist_ok=True)
        while parts:
            bucket, held = parts.popitem()
            key, columns, counts = merged(held)
            arrays = _coded("keys", key, buckets) | _narrow("counts", counts)
            few = np.bincount(np.minimum(counts, 5), minlength=6)[1:5]
            yield _rows([bucket], [None], [[int(x) for x in (*few, len(counts), counts.sum(), (counts > 2).sum())]])
            if n > 1:
                context = _contexts(columns)
                order = np.argsort(context)
                context, c = context[order], counts[order]
                first = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
                one = np.diff(np.append(first, len(c))) == 1
                sums = [np.add.reduceat(x.astype(np.int64), first) for x in (c, c == 1, c == 2, c > 2)]
                context = context[first]
                arrays |= _coded("one", context[one], buckets) | _narrow("one_count", sums[0][one]) | _coded("many", context[~one], buckets)
                for k, x in enumerate(sums):
                    arrays |= _narrow(f"many_{k}", x[~one])
            _write(f"{path}/{n}/{bucket}", arrays)
            del arrays, key
            if n > 1:
                # what begins a text has no words before it: there the counts themselves go down
                down = np.where(columns[1] == _BEGIN, counts, 1) if n > 2 else np.ones(len(counts), np.int64)
                columns = columns[1:]
                key, columns, down = _merged(columns, down, _keys(columns, _contexts(columns), buckets))
                yield _packed(columns, down, key, buckets, width)

    return run


def _discounts(few: np.ndarray) -> list[float]:
    n1, n2, n3, n4 = (float(x) for x in few)
    if min(n1, n2, n3, n4) == 0:
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    return [min(max(x, 0.0), k + 1.0) for k, x in enumerate((1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3))]


def sized_buckets(docs: DataFrame, text_col: str = "text") -> int:
    """A power of two, BUCKETS at least, that gives each bucket about BUCKET_CHARS characters of text at most."""
    chars = docs.agg(F.sum(F.length(col(text_col)).cast("long"))).first()[0] or 0
    return max(BUCKETS, 1 << (-(-chars // BUCKET_CHARS) - 1).bit_length())


def fit(docs: DataFrame, text_col: str = "text", order: int = ORDER, buckets: int | None = None) -> Model:
    """The model of all texts of docs.  Texts that are null, empty or without a word give nothing.

    Discounts follow from the counts of counts; where a level lacks one of the counts 1 to 4 they are 0.5, 1 and 1.5.
    """
    buckets = buckets or sized_buckets(docs, text_col)
    if order < 2 or buckets & (buckets - 1):
        raise ValueError("order must be 2 or more, buckets a power of two")
    spark: SparkSession = docs.sparkSession
    path = posix_dir(spark, "ngrams")
    texts = spread(docs.select(col(text_col).alias("text")).where("text is not null"))
    model = Model(path, order, buckets, *_vocabulary(texts, path, min(buckets, WORD_BUCKETS)))
    schema = "bucket int, payload binary, stats array<long>"
    rows = texts.mapInArrow(_count(spark.sparkContext.broadcast(model), buckets), schema)
    for n in range(order, 0, -1):
        level = rows.repartitionById(buckets, F.col("bucket")).mapInArrow(_level(path, n, buckets, model.width), schema)
        with released(spark):
            level.write.parquet(f"file://{path}/level-{n}")
        if n < order:
            remove(spark, f"file://{path}/level-{n + 1}")
        out = spark.read.schema(schema).parquet(f"file://{path}/level-{n}")
        rows = out.where("payload is not null")
        stats = [int(x or 0) for x in out.agg(*[F.sum(F.col("stats")[i]) for i in range(_STATS)]).first()]
        model.discounts[n] = _discounts(stats[:4])
    model.unigrams = [stats[5], stats[0], stats[1], stats[6], stats[4]]
    remove(spark, f"file://{path}/level-1")
    return model


def log_probabilities(model: Model, columns: list[np.ndarray]) -> np.ndarray:
    """log10 of the probability of each n-gram's last word after the words before it."""

    def less(counts: np.ndarray, n: int) -> np.ndarray:
        d = np.array([0.0, *model.discounts[n]])
        return np.maximum(counts - d[np.minimum(counts, 3).astype(np.int64)], 0)

    total, one, two, more, types = model.unigrams
    left = np.dot(model.discounts[1], [one, two, more])
    word = columns[-1:]
    p = less(model.counts(1, _keys(word, _contexts(word), model.buckets)), 1)
    p = (p + left / (types + 1)) / total if total else np.full(len(word[0]), 1.0)
    for n in range(2, model.order + 1):
        part = columns[-n:]
        context = _contexts(part)
        sums = model.sums(n, context)
        counts = model.counts(n, _keys(part, context, model.buckets))
        p = np.where(sums[:, 0] > 0, (less(counts, n) + sums[:, 1:] @ np.array(model.discounts[n]) * p) / np.maximum(sums[:, 0], 1), p)
    return np.log10(p)


def score(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, buckets: int | None = None) -> DataFrame:
    """A row (doc_id, n_tokens, log10_prob, perplexity) for every row of docs; tokens are its words and its end.

    By default the model is fitted on docs itself.  Null, empty and wordless texts have 0 tokens and null otherwise.  Repeated
    rows and ids have a row each and each counts in the model; a null id stays null.  Other columns are not read.  An empty
    table gives no rows; a word or context that the model lacks gets what the level below gives it, in the end an even share.
    """
    model = model or fit(docs, text_col, order, buckets)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", _TEXT):
                columns, each = _grams(batch.column("text"), shared.value)
                sums = np.concatenate([[0.0], np.cumsum(log_probabilities(shared.value, columns))])
                ends = np.cumsum(each)
                log = np.where(each > 0, sums[ends] - sums[ends - each], np.nan)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(each, pa.int64()), pa.array(log, pa.float64(), from_pandas=True), pa.array(10 ** (-log / np.maximum(each, 1)), pa.float64(), from_pandas=True)],
                    names=["doc_id", "n_tokens", "log10_prob", "perplexity"],
                )

    narrow = spread(docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text")))
    return narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, n_tokens long, log10_prob double, perplexity double")
