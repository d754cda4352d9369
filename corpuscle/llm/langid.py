"""Language identification by multinomial naive Bayes over hashed character n-grams.

A bounded, hash-ordered sample of labelled rows gives one matrix of log probabilities
(buckets x languages, about a megabyte), which is broadcast.  Scoring is map-only: the
code points of a batch are hashed in numpy and the rows of the matrix that they select
are summed over each text, which is the product of a sparse count matrix and the model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscle.llm.common import col, map_arrow, spread, written
from corpuscle.llm.hashing import slices

ORDERS = (2, 3)
BITS = 16
#: Labelled rows per language that the model is fitted on, about: the documented bound of its sample.
SAMPLE_PER_LANGUAGE = 2000
#: A text is rejected when its best language's mean log probability per n-gram is lower than this share
#: of the way from the language's own mean to that of uniform noise, whatever the spread of the language's texts.
NOISE_SHARE = 0.75
#: A text may lie so many times as far below its language's mean as the farthest text of the sample, at equal length.
MARGIN = 1.5
#: Labels at most: the matrix of the model, which is broadcast, has a column for each.
LANGUAGES = 500
_WINDOW = 1 << 20
_FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
_SPACE = np.arange(128, dtype=np.uint32)
_SPACE[[i for i in range(128) if not chr(i).isalpha()]] = 32


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_prob: np.ndarray  # float32 [buckets, languages]
    prior: np.ndarray  # float64 [languages]
    usual: np.ndarray  # float64 [languages]: expected log probability of an n-gram of the language itself
    #: float64 [languages, 2]: a text of n n-grams may lie sqrt(a + b / n) below the usual mean; infinite where unknown
    reach: np.ndarray


def _codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points with all but letters as spaces, a space around each text; n + 1 offsets."""
    values = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    size = np.asarray(pc.utf8_length(values), dtype=np.int64) + 2
    joined = " " + "  ".join(values.to_pylist()) + " "
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ascii_ = code < 128
    code = np.where(ascii_, _SPACE[np.where(ascii_, code, 32)], code)
    return code, np.concatenate([[0], np.cumsum(size)])


def _hashes(code: np.ndarray, order: int) -> np.ndarray:
    n = len(code) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    h = np.full(n, order, dtype=np.uint32)
    for i in range(order):
        h = (h ^ code[i : i + n]) * _FACTORS[i % 3]
        h ^= h >> np.uint32(15)
    return (h * _FACTORS[1]) >> np.uint32(32 - BITS)


def _windows(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hashes, index of the text, first and end place of its n-grams among them) for every order and window.

    N-grams that cross from one text to the next are given to no text; those of blanks count like others.
    """
    code, at = _codes(texts)
    for order in ORDERS:
        for low in range(0, len(code), _WINDOW):
            part = code[low : low + _WINDOW + order - 1]
            h = _hashes(part, order)
            first = int(np.searchsorted(at, low, "right")) - 1
            last = int(np.searchsorted(at, low + len(h), "left"))
            which = np.arange(first, min(last, len(at) - 1))
            start = np.clip(at[which] - low, 0, len(h))
            end = np.clip(at[which + 1] - order + 1 - low, 0, len(h))
            ok = end > start
            yield h, which[ok], np.stack([start[ok], end[ok]])


def scores(texts: pa.Array, log_prob: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text the sum of log probabilities in each language, and the number of n-grams summed."""
    width = log_prob.shape[1]
    total, count = np.zeros((len(texts), width)), np.zeros(len(texts), np.int64)
    if not len(texts):
        return total, count
    for h, which, (start, end) in _windows(texts):
        if not len(which):
            continue
        places = np.stack([start, end], axis=1).ravel()
        rows = log_prob[h]
        rows = np.concatenate([rows, np.zeros((1, width), rows.dtype)])  # a place at the very end is then valid
        total[which] += np.add.reduceat(rows, places, axis=0, dtype=np.float64)[::2]
        count[which] += end - start
    letters = np.asarray(pc.match_substring_regex(pc.fill_null(texts.cast(pa.large_string()), ""), r"\p{L}"))
    return total, np.where(letters, count, 0)


def _counts(languages: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << BITS
        seen = np.zeros(size * len(languages) * 2, np.int64)
        for whole in batches:
            for batch in slices(whole, "text"):
                label = np.asarray(pc.index_in(batch.column("lang"), pa.array(languages)), dtype=np.int64) + len(languages) * np.asarray(batch.column("half"), dtype=np.int64)
                for h, which, (start, end) in _windows(batch.column("text")):
                    mine = np.repeat(which, end - start)
                    skip = np.repeat(start - np.concatenate([[0], np.cumsum(end - start)[:-1]]), end - start)
                    seen += np.bincount(label[mine] * size + h[np.arange(len(mine)) + skip], minlength=len(seen))
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some])], names=["cell", "n"])

    return run


def _estimate(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probabilities [languages, buckets] and each language's expected one, from the buckets' counts."""
    log_prob = np.log((counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * counts.shape[1]))
    return log_prob, (log_prob * counts).sum(axis=1) / np.maximum(1, counts.sum(axis=1))


def _depths(halves: list[tuple[np.ndarray, np.ndarray]]):
    """Of each text its best language in the model of the other half, its n-grams and how far its mean lies below the usual one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                half = np.asarray(batch.column("half"))
                for other, (log_prob, usual) in enumerate(halves):
                    total, count = scores(batch.column("text").filter(pa.array(half != other)), log_prob)
                    total, count = total[count > 0], count[count > 0]
                    best = np.argmax(total, axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(best), pa.array(count), pa.array(usual[best] - total[np.arange(len(best)), best] / count)], names=["lang", "n", "depth"]
                    )

    return run


def _reach(lang: np.ndarray, n: np.ndarray, depth: np.ndarray, most: np.ndarray) -> np.ndarray:
    """a and b of each language: the spread a' + b' / n that fits the squared depths best, times what takes in the deepest text and MARGIN.

    Texts deeper than `most` are rejected anyway and don't count.
    """
    out = np.full((len(most), 2), np.inf)
    for k in range(len(most)):
        mine = (lang == k) & (depth < most[k])
        if not mine.any():
            continue
        square, short = depth[mine] ** 2, 1 / n[mine]
        x, y = short - short.mean(), square - square.mean()
        b = max(0.0, (x @ y) / (x @ x)) if x @ x > 0 else 0.0
        b = min(b, square.mean() / short.mean())
        a = square.mean() - b * short.mean()
        out[k] = np.array([a, b]) * MARGIN**2 * (np.maximum(depth[mine], 0) ** 2 / np.maximum(a + b * short, 1e-300)).max()
    return out


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE, hold_out: tuple[int, int] | None = None,
) -> Model:
    """A model of the labelled languages.

    Fitted on the rows whose id's hash is lowest, about `per_language` of each language.  Rows without text,
    label or letters give nothing; without any labelled row the model has no language and accepts nothing.  How far a
    text may lie below its language's mean comes from the sample's texts, see _reach; where a half of the sample lacks
    a language, NOISE_SHARE alone bounds it.
    More than LANGUAGES labels are refused.
    hold_out=(m, r) leaves out the rows whose hash is r modulo m, for testing.
    """
    rows = docs.select(
        F.pmod(F.xxhash64(col(id_col), F.lit("langid")), F.lit(1 << 30)).alias("h"), col(text_col).alias("text"), col(lang_col).cast("string").alias("lang")
    ).where("lang is not null and text is not null")
    if hold_out:
        rows = rows.where(F.col("h") % hold_out[0] != hold_out[1])
    have = sorted((r["lang"], r["n"]) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(LANGUAGES + 1).collect())
    if len(have) > LANGUAGES:
        raise ValueError(f"{lang_col} has more than {LANGUAGES} labels; clean it first")
    languages = [lang for lang, _ in have]
    size = 1 << BITS
    counts = np.zeros((2, len(languages), size))
    if languages:
        bound = F.create_map(*[F.lit(x) for lang, n in have for x in (lang, int(min(1.0, per_language / n) * (1 << 30)))])
        sample = written(rows.where(F.col("h") < bound[F.col("lang")]).select("text", "lang", (F.col("h") % 2).alias("half")))
        cells = sample.mapInArrow(_counts(languages), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        counts.ravel()[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy(float)
    log_prob, usual = _estimate(counts.sum(axis=0))
    reach = np.full((len(languages), 2), np.inf)
    if languages and counts.sum(axis=2).all():
        # a text of the sample is nearer to a model that has seen it, so each half is held against the other's
        halves = [(x.T.astype(np.float32), u) for x, u in map(_estimate, counts)]
        depths = sample.mapInArrow(_depths(halves), "lang long, n long, depth double").toPandas()
        reach = _reach(*(depths[c].to_numpy() for c in ("lang", "n", "depth")), NOISE_SHARE * (usual - log_prob.mean(axis=1)))
    share = np.array([n for _, n in have], float)
    return Model(languages, log_prob.T.astype(np.float32), np.log(np.maximum(share, 1) / max(1.0, share.sum())), usual, reach)


def predict(texts: pa.Array, model: Model, noise_share: float = NOISE_SHARE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the best language or -1, its mean log probability per n-gram, whether the text is accepted)."""
    n = len(texts)
    if not model.languages or not n:
        return np.full(n, -1), np.full(n, np.nan), np.zeros(n, bool)
    total, count = scores(texts, model.log_prob)
    best = np.argmax(total + model.prior, axis=1)
    mean = total[np.arange(n), best] / np.maximum(count, 1)
    most = noise_share * (model.usual - model.log_prob.mean(axis=0))
    reach = np.sqrt(model.reach[best, 0] + model.reach[best, 1] / np.maximum(count, 1))
    ok = (count > 0) & (model.usual[best] - mean <= np.minimum(reach, most[best]))
    return np.where(count > 0, best, -1), np.where(count > 0, mean, np.nan), ok


def identify(
    docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", noise_share: float = NOISE_SHARE
) -> DataFrame:
    """A row (doc_id, predicted, mean_log_prob, accepted) for every row of docs; one map over the texts.

    Null, empty and letterless texts: predicted and mean_log_prob are null, accepted is false.  Repeated rows and ids
    give a row each; a null id stays null; ties between languages go to the alphabetically first; other columns are
    not read, so their names can't clash; an empty table gives no rows.
    """
    model = model or fit(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.languages, None], dtype=object)
        for whole in batches:
            for batch in slices(whole, "text"):
                best, mean, ok = predict(batch.column("text"), m, noise_share)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(names[best], pa.string()), pa.array(mean, pa.float64(), from_pandas=True), pa.array(ok)],
                    names=["doc_id", "predicted", "mean_log_prob", "accepted"],
                )

    narrow = spread(docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text")))
    return narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, predicted string, mean_log_prob double, accepted boolean")


def accepted(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", noise_share: float = NOISE_SHARE) -> DataFrame:
    """The rows of docs, all columns as they were, whose language the model recognises; see identify for the cases."""
    model = model or fit(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, place):
                yield batch.filter(pa.array(predict(batch.column(place), shared.value, noise_share)[2]))

    return map_arrow(spread(docs), run, docs.schema)
