"""The transducer against a plain encoder of the whole text, and against an independent library."""

import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpuscle.llm import bpe as B


@pytest.fixture(scope="module")
def real():
    with open(B.TOKENIZER, encoding="utf-8") as f:
        return B.Bpe.read(f.read())


def ids_of(parts):
    return np.frombuffer(b"".join(parts), np.int32).tolist()


def naive(piece, merges):
    part = [piece[i : i + 1] for i in range(len(piece))]
    for a, b in merges:
        i = 0
        while i < len(part) - 1:
            if part[i] == a and part[i + 1] == b:
                part[i : i + 2] = [a + b]
            i += 1
    return part


@given(st.integers(0, 10**9), st.integers(1, 40), st.integers(1, 9))
@settings(max_examples=400, deadline=None)
def test_streaming_equals_whole(seed, n_merges, step):
    rnd = random.Random(seed)
    tokens, merges = [b"a", b"b", b"c"], []
    for _ in range(n_merges):
        pair = (rnd.choice(tokens), rnd.choice(tokens))
        if pair[0] + pair[1] in tokens or len(pair[0] + pair[1]) > 12:
            continue
        merges.append(pair)
        tokens.append(pair[0] + pair[1])
    vocabulary = {bytes([i]): i for i in range(256)}
    for a, b in merges:
        vocabulary.setdefault(a + b, len(vocabulary))
    model = B.Bpe(vocabulary, merges)
    text = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(0, 300)))
    want = [vocabulary[t] for t in naive(text, merges)]
    assert [vocabulary[t] for t in model.merge(text)] == want
    assert ids_of(model.long((text[i : i + step], i + step >= len(text)) for i in range(0, len(text), step))) == want
    assert ids_of(model.merge_many([text])) == want


@given(st.text(alphabet="ab cé'’sltrev\n\t  12!?日🙂́", max_size=400), st.integers(1, 50))
@settings(max_examples=300, deadline=None)
def test_chunks_do_not_matter(real, text, chunk):
    whole = [i for w in real.split.findall(text) for i in (real.ids[t] for t in real.merge(w.encode()))]
    assert ids_of(real.encode(text, 1)) == whole
    assert real.decode(whole) == text
    # a vocabulary without merges has the least lookahead: chunks of any size then, and pretokens longer than a chunk
    plain = B.Bpe({bytes([i]): i for i in range(256)}, [])
    plain.lookahead = 2 - 8
    assert ids_of(plain.encode(text, chunk)) == list(text.encode())


def test_against_library(real):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(B.TOKENIZER)
    t.encode_special_tokens = True
    rnd = random.Random(5)
    texts = ["", " ", "a" * 70_000, " " * 50_000 + "x", "\n" * 33_000, "x" + "é" * 40_000 + " tail", "1" * 30_000 + "!" * 30_000, "ab" * 20_000 + "\n\n  z", "x² ½\x1c_a__ _ 9Ⅷ " * 3000, "<|endoftext|>"]
    texts += ["".join(rnd.choice("the quick éß'll \n\t!?12日🙂") for _ in range(rnd.randint(1, 60_000))) for _ in range(6)]
    for text in texts:
        got = ids_of(real.encode(text))
        assert got == t.encode(text, add_special_tokens=False).ids, text[:50]
        assert real.decode(got) == text


def test_cache_holds_short_pretokens_only(real):
    rnd = random.Random(2)
    before = set(real.cache)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(n)) for n in (5, 60, 70, 16_000)]
    got = real.known(words)
    assert [ids_of([g]) for g in got] == [[real.ids[t] for t in real.merge(w.encode())] for w in words]
    assert set(real.cache) - before <= set(words[:2]) and all(len(w.encode()) <= B.WHOLE for w in real.cache)


def test_cache_is_bounded(real, monkeypatch):
    monkeypatch.setattr(B, "CACHED", 50)
    for n in range(20):
        real.known([f"w{n}x{i}" for i in range(30)])
        assert len(real.cache) <= 50


def test_memory_is_bounded(real):
    """No part that the encoder hands out is larger than a chunk allows, whatever the text."""
    assert max(len(ids) / 4 for ids in real.encode("ab" * 500_000)) <= 4 * max(B.CHUNK, 4 * (real.lookahead + 8))


def test_broken_utf8(real):
    ids = [real.ids[bytes([0xE2])], real.ids[b"a"]]
    assert real.decode(ids) == "�a"
    assert real.decode([]) == "" and real.decode([10**7, -1]) == ""


def test_improper_merges_are_refused():
    with pytest.raises(ValueError, match="before its parts"):
        B.sufficient_lookahead([(b"ab", b"c"), (b"a", b"b")])


def test_table(spark, tmp_path):
    rows = [(1, "hello world", "x"), (1, "hello world", "x"), (None, None, None), (2, "", "y"), (3, "z" * 200_000, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = B.encode(df).collect()
    assert len(got) == 5 and B.encode(df).columns == ["doc_id", "text", "n_tokens", "token_ids", "n_tokens_", "round_trip"]
    by = {r["doc_id"]: r for r in got}
    assert by[None]["token_ids"] is None and by[None]["round_trip"] is None and by[None]["n_tokens_"] is None
    assert by[2]["token_ids"] == [] and by[2]["round_trip"] and by[3]["round_trip"] and by[1]["n_tokens"] == "x"
    assert {r["decoded"] for r in B.decode(B.encode(df)).where("doc_id is not null").collect()} == {r[1] for r in rows if r[1] is not None}
    assert B.encode(df.limit(0)).count() == 0


def test_vocabulary_file_is_a_parameter(spark, tmp_path):
    alphabet = {v: k for k, v in B.byte_alphabet().items()}
    vocabulary = {alphabet[b]: b for b in range(256)} | {"ab": 256}
    (tmp_path / "v.json").write_text(json.dumps({"model": {"vocab": vocabulary, "merges": [["a", "b"]]}}))
    df = spark.createDataFrame([("abab",)], "text string")
    assert B.encode(df, tokenizer=str(tmp_path / "v.json")).first()["token_ids"] == [256, 256]
