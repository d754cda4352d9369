"""Byte-pair encoding as a streaming transducer with bounded lookahead, and incremental decoding.

Text goes through in chunks.  A pretoken is final once the text behind it can no longer change where it ends; inside a
pretoken of unbounded length, a token is final once it ends at least `lookahead` bytes before the end of what has been
read.  The lookahead is computed from the merge list: appended bytes can only alter a merge through a chain of merges
of ascending rank, each touching the one before from the left, so the heaviest such chain bounds how far back a change
reaches.  What is held in memory is one chunk, one lookahead and a bounded cache of whole pretokens.
"""

from __future__ import annotations

import codecs
import heapq
import itertools
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuscle.llm.common import col, fresh, map_arrow, spread
from corpuscle.llm.hashing import slices

#: The vocabulary's place is a parameter; the file is read on the driver and broadcast.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: Characters fed at a time.
CHUNK = 1 << 14
#: Pretokens up to so many bytes are encoded as a whole and cached; the cache is emptied when it holds so many.
WHOLE, CACHED = 64, 400_000

_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same in the faster standard module, for texts of which no character tells the two apart.
_FAST = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
_OTHER = re.compile("[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbe\u0590-\U0010ffff]")
#: Characters behind a match that may still change where it ends: those of the longest contraction.
_UNSURE = 2
_CLASSES = [r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]", r"\s"]


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for the 256 bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """Ids and merges of a byte-level vocabulary, its lookahead, the encoder and the decoder's table."""

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]]) -> None:
        self.ids = vocabulary
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.lookahead = sufficient_lookahead(merges)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = token
        self.split, self.fast = regex.compile(_SPLIT), re.compile(_FAST)
        self.runs = [regex.compile(c + "+") for c in _CLASSES]
        self.cache: dict[str, bytes] = {}  # pretoken to its ids as int32
        self.size = np.array([len(t) for t in self.bytes])
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.byte_id = np.array([vocabulary[bytes([b])] for b in range(256)])
        key = np.array([vocabulary[a] * len(self.bytes) + vocabulary[b] for a, b in merges] + [1 << 62], np.int64)
        self.order = np.argsort(key)  # by pair; the rank is the place in the merge list
        self.pairs, self.made = key[self.order], np.array([vocabulary[a + b] for a, b in merges] + [-1])[self.order]

    @classmethod
    def read(cls, content: str) -> Bpe:
        """From the JSON of a byte-level tokenizer."""
        model, alphabet = json.loads(content)["model"], byte_alphabet()
        raw = lambda s: bytes(alphabet[c] for c in s)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        return cls({raw(t): i for t, i in model["vocab"].items() if all(c in alphabet for c in t)}, [(raw(a), raw(b)) for a, b in pairs])

    def merge(self, piece: bytes) -> list[bytes]:
        """The tokens of a piece: merges by ascending rank, leftmost first, over a linked list and a heap."""
        rank = self.rank
        part: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
        if len(part) < 24:  # short pieces: a scan for the lowest rank is faster than the heap
            while len(part) > 1:
                best, at = min(((rank.get((part[i], part[i + 1]), 1 << 60), i) for i in range(len(part) - 1)))
                if best == 1 << 60:
                    break
                part[at : at + 2] = [part[at] + part[at + 1]]
            return part
        n = len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank.get((part[i], part[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if part[i] is None or j >= n or rank.get((part[i], part[j])) != r:
                continue
            part[i], part[j] = part[i] + part[j], None
            after[i] = j = after[j]
            if j < n:
                before[j] = i
                if (x := rank.get((part[i], part[j]))) is not None:
                    heapq.heappush(heap, (x, i))
            if (h := before[i]) >= 0 and (x := rank.get((part[h], part[i]))) is not None:
                heapq.heappush(heap, (x, h))
        return [p for p in part if p is not None]

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """The ids, as int32 bytes, of many short pieces at once: in each round every piece makes its lowest, leftmost merge."""
        out: list[bytes] = [b""] * len(pieces)
        if not pieces:
            return out
        size = np.array([len(p) for p in pieces])
        sym = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        who = np.repeat(np.arange(len(pieces)), size)
        never = len(self.pairs)
        while len(sym):
            key = np.append(sym[:-1] * len(self.bytes) + sym[1:], 0)
            key[:-1][who[1:] != who[:-1]] = -1
            key[-1] = -1
            at = np.searchsorted(self.pairs, key)
            rank = np.where(self.pairs[at] == key, self.order[at], never)
            first = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
            least = np.minimum.reduceat(rank, first)
            count = np.diff(np.append(first, len(sym)))
            done = np.repeat(least == never, count)
            if done.any():
                ids, ends = sym[done].astype(np.int32).tobytes(), np.cumsum(count[least == never]) * 4
                begin = 0
                for p, end in zip(who[first[least == never]].tolist(), ends.tolist(), strict=True):
                    out[p] = ids[begin:end]
                    begin = end
            hit = np.flatnonzero((rank == np.repeat(least, count)) & ~done)
            hit = hit[np.append(True, who[hit[1:]] != who[hit[:-1]])] if len(hit) else hit
            keep = ~done
            sym[hit] = self.made[at[hit]]
            keep[hit + 1] = False
            sym, who = sym[keep], who[keep]
        return out

    def words(self, text: str) -> list[str]:
        """The pretokens of a text."""
        return (self.split if _OTHER.search(text) else self.fast).findall(text)

    def learn(self, words: Iterable[str]) -> dict[str, bytes]:
        """The ids of all these pretokens; those of up to WHOLE bytes go into the cache as well."""
        new = list(set(words))
        raw = [w.encode("utf-8", "replace") for w in new]
        short = [i for i, r in enumerate(raw) if len(r) <= WHOLE]
        out = {new[i]: ids for i, ids in zip(short, self.merge_many([raw[i] for i in short]), strict=True)}
        if len(self.cache) + len(out) > CACHED:
            self.cache.clear()
        self.cache.update(itertools.islice(out.items(), CACHED))
        step = max(4 * self.lookahead, 256)
        for w, r in zip(new, raw, strict=True):
            if len(r) > WHOLE:
                out[w] = b"".join(self.long((r[i : i + step], i + step >= len(r)) for i in range(0, len(r), step)))
        return out

    def known(self, words: list[str]) -> list[bytes]:
        """The ids of each pretoken; those not in the cache are learnt together."""
        got = list(map(self.cache.get, words))
        if missing := [i for i, x in enumerate(got) if x is None]:
            new = self.learn([words[i] for i in missing])
            for i in missing:
                got[i] = new[words[i]]
        return got

    def ids_of(self, words: list[str]) -> bytes:
        return b"".join(self.known(words))

    def text_bytes(self, ids: np.ndarray) -> bytes:
        """The bytes of ids, all of them in the vocabulary."""
        size = self.size[ids]
        end = np.cumsum(size)
        return self.flat[np.repeat(self.start[ids] - end + size, size) + np.arange(end[-1])].tobytes() if len(ids) else b""

    def stable(self, pending: bytes, final: bool) -> tuple[bytes, bytes]:
        """(ids, as int32, of the tokens of pending that no continuation changes, the bytes that stay pending)."""
        tokens, out, done = self.merge(pending), [], 0
        for t in tokens:
            if not final and done + len(t) > len(pending) - self.lookahead:
                break
            out.append(self.ids[t])
            done += len(t)
        return np.array(out, np.int32).tobytes(), pending[done:]

    def long(self, chunks: Iterable[tuple[bytes, bool]]) -> Iterator[bytes]:
        pending = b""
        for chunk, final in chunks:
            ids, pending = self.stable(pending + chunk, final)
            yield ids

    def encode(self, text: str, chunk: int = CHUNK) -> Iterator[bytes]:
        """The ids of a text as int32, part by part; memory doesn't grow with the text or with its pretokens."""
        held, at, inside, pending = "", 0, None, b""
        step = max(4 * (self.lookahead + 8), chunk)
        while True:
            piece = text[at : at + step]
            at += len(piece)
            final = at >= len(text)
            held += piece
            if inside is not None:  # in a pretoken that began in an earlier chunk
                m = inside.match(held)
                end = m.end() if m else 0
                space = inside is self.runs[3]
                if end == len(held) and not final:  # goes on; of white space the last character may belong to the next
                    take = held[:-1] if space else held
                    ids, pending = self.stable(pending + take.encode(), False)
                    held = held[len(take) :]
                    yield ids
                    continue
                if space and end < len(held):
                    end -= 1
                ids, pending = self.stable(pending + held[:end].encode(), True)
                held, inside = held[end:], None
                yield ids
            words = self.words(held)
            if not final:
                sure = len(held) - _UNSURE
                left = len(held)
                while words and left >= sure:
                    left -= len(words.pop())
                if not words and left == 0 and held:
                    first = self.split.match(held)
                    if first.end() >= sure and len(held) >= step:
                        inside = next(r for r in self.runs if r.match(held, first.end() - 1))
                        cut = first.end() - 1 if inside is self.runs[3] else first.end()
                        if cut < first.end() or first.end() == len(held):
                            ids, pending = self.stable(held[:cut].encode(), False)
                            held = held[cut:]
                            yield ids
                        else:
                            inside = None
                    continue
                held = held[left:]
            yield self.ids_of(words)
            if final:
                return

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; an id outside the vocabulary counts as no bytes."""
        machine = Utf8Machine()
        known = len(self.bytes)
        return machine.feed(b"".join([self.bytes[i] for i in ids if 0 <= i < known])) + machine.end()


class Utf8Machine:
    """Bytes in, text out: a state of at most three bytes between calls; what is no UTF-8 becomes U+FFFD."""

    def __init__(self) -> None:
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, raw: bytes) -> str:
        return self.machine.decode(raw, False)

    def end(self) -> str:
        return self.machine.decode(b"", True)


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes behind a token's end after which no continuation can change the token.

    Merges run by rank.  Whether merge r = (a, b) happens at the end of the text can bear on a later merge left of it
    only if that one takes what r takes or makes as its right part: (c, a) or (c, ab).  Each link of such a chain has a
    higher rank than the one before and reaches back by the length of its left part.  The longest chain is found in one
    pass over the ranks.  The list must be proper: parts of a merge are bytes or results of earlier merges.
    """
    made = {bytes([b]) for b in range(256)}
    reach: dict[bytes, int] = {}  # by token: the longest chain that ends in a merge which takes it on the left or makes it
    longest = 1
    for a, b in merges:
        if a not in made or b not in made:
            raise ValueError("a merge comes before its parts can be made")
        w = max(len(a) + len(b), reach.get(b, 0) + len(a))
        longest = max(longest, w)
        reach[a] = max(reach.get(a, 0), w)
        reach[a + b] = max(reach.get(a + b, 0), w)
        made.add(a + b)
    return longest


@lru_cache(2)
def _loaded(content: str) -> Bpe:
    return Bpe.read(content)


def _encoded(batch: pa.RecordBatch, place: int, bpe: Bpe) -> tuple[pa.Array, pa.Array, pa.Array]:
    values, sizes, same = [], [], []
    texts = batch.column(place).to_pylist()
    words, ends = [], []
    for t in texts:
        if t is not None and len(t) <= CHUNK:
            words += bpe.words(t)
        ends.append(len(words))
    got = bpe.known(words)
    for text, begin, end in zip(texts, [0, *ends], ends, strict=False):
        if text is None:
            sizes.append(None)
            same.append(None)
            continue
        n, machine, at, ok = 0, Utf8Machine(), 0, True
        for part in bpe.encode(text) if len(text) > CHUNK else [b"".join(got[begin:end])]:
            ids = np.frombuffer(part, np.int32)
            values.append(ids)
            n += len(ids)
            back = machine.feed(bpe.text_bytes(ids))
            ok = ok and text.startswith(back, at)
            at += len(back)
        sizes.append(n)
        same.append(ok and text[at:] == machine.end())
    flat = np.concatenate(values) if values else np.zeros(0, np.int32)
    places = np.concatenate([[0], np.cumsum([s or 0 for s in sizes])]).astype(np.int32)
    mask = pa.array([s is None for s in sizes])
    tokens = pa.ListArray.from_arrays(pa.array(places), pa.array(flat), mask=mask) if len(sizes) else pa.array([], pa.list_(pa.int32()))
    return tokens, pa.array(sizes, pa.int64()), pa.array(same, pa.bool_())


def encode(docs: DataFrame, text_col: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """docs with three more columns: token_ids, n_tokens and round_trip (whether decoding gave the text back).

    One map over the rows, without an exchange unless a scan has fewer partitions than there are cores.  A null text has nulls there, an empty one no tokens; repeated rows and ties are
    encoded each on its own; texts of any length are streamed.  A column of docs with one of the three names keeps it,
    and the new one gets an underscore.  An empty table gives no rows.
    """
    with open(tokenizer, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    place = docs.columns.index(text_col)
    names = fresh(docs, "token_ids", "n_tokens", "round_trip")
    kinds = (T.ArrayType(T.IntegerType()), T.LongType(), T.BooleanType())
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(shared.value)
        for whole in batches:
            for batch in slices(whole, place, 1 << 21):
                yield pa.RecordBatch.from_arrays([*batch.columns, *_encoded(batch, place, bpe)], names=[*batch.schema.names, *names])

    return map_arrow(spread(docs), run, schema)


def decode(rows: DataFrame, ids_col: str = "token_ids", out: str = "decoded", tokenizer: str = TOKENIZER) -> DataFrame:
    """rows with the text of their token ids as column `out`; null ids give null, no ids the empty text."""
    with open(tokenizer, encoding="utf-8") as f:
        shared = rows.sparkSession.sparkContext.broadcast(f.read())
    (name,) = fresh(rows, out)

    @F.pandas_udf("string")
    def text(ids):  # noqa: ANN001, ANN202
        bpe = _loaded(shared.value)
        return ids.map(lambda x: None if x is None else bpe.decode(x))

    return rows.withColumn(name, text(col(ids_col)))
