"""Each stage against a brute-force version on its own input, the whole against their sequence, and odd tables."""

import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from corpuscle.llm import bpe, langid, mixing, simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """(name, rows before, rows after) of every stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        after = stage(spark, docs, SF)
        docs = spark.createDataFrame(after.collect(), after.schema)
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
        out.append((name, before, docs.collect()))
    return out


def test_language(spark, stages):
    _, before, after = stages[0]
    model = langid.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    ok = langid.predict(pa.array([r["text"] for r in before]), model)[2]
    assert Counter(after) == Counter(r for r, k in zip(before, ok.tolist(), strict=True) if k)
    assert len(after) > 0.9 * len(before), "clean documents stay"


def test_exact(stages):
    _, before, after = stages[1]
    first = {}
    for r in sorted(before, key=lambda r: r["doc_id"]):
        first.setdefault(r["text"], r)
    assert Counter(after) == Counter(first.values()) and len(after) < len(before)


def test_near(stages):
    _, before, after = stages[2]
    before = sorted(before, key=lambda r: r["doc_id"])
    fp, some = simhash.fingerprints(pa.array([r["text"] for r in before]))
    f, root = fp.view(np.uint64), list(range(len(before)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(np.flatnonzero(some).tolist(), 2):
        if np.bitwise_count(f[i] ^ f[j]).sum() <= simhash.MAX_BITS:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    assert {r["doc_id"] for r in after} == {before[i]["doc_id"] for i in range(len(before)) if find(i) == i}
    assert 0.5 * len(before) < len(after) < len(before)


def test_near_leaves_out_no_pair_within_the_bits(spark):
    """Pairs near the threshold, in no table of which the counts of bits agree up to one."""
    rnd = random.Random(7)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(3000)]
    first = [[rnd.choice(words) for _ in range(120)] for _ in range(600)]
    second = [[rnd.choice(words) if rnd.random() < 0.09 else w for w in t] for t in first]
    fp = [simhash.fingerprints(pa.array([" ".join(t) for t in x]))[0] for x in (first, second)]
    near = np.bitwise_count(fp[0] ^ fp[1]).sum(axis=1) <= simhash.MAX_BITS
    apart = np.abs(simhash.grid(fp[0]).astype(int) - simhash.grid(fp[1])).sum(axis=2).min(axis=1) > 1
    hard = np.flatnonzero(near & apart).tolist()
    rows = [(i + 1000 * k, " ".join(x[i]), "en", "a", 1) for i in hard for k, x in enumerate((first, second))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert len(hard) > 5 and sorted(r["doc_id"] for r in corpus_pipeline.near(spark, df, SF).collect()) == hard


def test_near_leaves_out_no_pair_without_an_id_of_its_own(spark):
    """Rows without an id and different texts of one id against brute force over rows, in long and string ids."""
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(3000)]
    texts = [[rnd.choice(words) for _ in range(120)] for _ in range(60)]
    texts += [[rnd.choice(words) if rnd.random() < 0.06 else w for w in t] for t in texts for _ in range(2)]
    texts = [" ".join(t) for t in texts]
    f = simhash.fingerprints(pa.array(texts))[0].view(np.uint64)
    near = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if np.bitwise_count(f[i] ^ f[j]).sum() <= simhash.MAX_BITS]
    group = list(range(len(texts)))
    for i, j in near:
        group = [group[i] if g == group[j] else g for g in group]
    for kind in (int, str):
        of = [*range(60), *(i // 2 for i in range(120))]  # two texts and their copies share an id, or have none or their own
        ids = [rnd.choice([None, kind(100 + of[i] // 2), kind(1000 + i)]) for i in range(len(texts))]
        assert any(ids[i] is ids[j] is None for i, j in near) and any(ids[i] == ids[j] is not None for i, j in near)
        df = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in zip(ids, texts, strict=True)], f"doc_id {'long' if kind is int else 'string'}, text string, lang string, source string, n_chars long")
        kept = [texts.index(r["text"]) for r in corpus_pipeline.near(spark, df, SF).collect()]
        assert sorted(group[i] for i in kept) == sorted(set(group)), "one row of each group"
        least = {g: min((ids[i] is None, ids[i] or kind(0)) for i in range(len(texts)) if group[i] == g) for g in group}
        assert all((ids[i] is None, ids[i] or kind(0)) == least[group[i]] for i in kept), "the one with the smallest id, nulls last"


def test_mixing(spark, stages):
    _, before, after = stages[3]
    keys = {r["doc_id"]: r["k"] for r in spark.createDataFrame(before).select("doc_id", mixing.random_key(mixing.F.col("doc_id"), 0).alias("k")).collect()}
    tokens = lambda rows: sum(len(r["text"].split()) for r in rows)
    by = {}
    for r in before:
        by.setdefault(r["source"], []).append(r)
    weight = {s: int(tokens(rows) ** 0.5) for s, rows in by.items()}
    want = Counter()
    for s, rows in by.items():
        total = tokens(rows)
        budget = weight[s] * tokens(before) // sum(weight.values())
        rest = budget % total
        for r in sorted(rows, key=lambda r: keys[r["doc_id"]]):
            rest -= len(r["text"].split())
            want[r] += budget // total + (rest >= 0)
    assert Counter(after) == +want and after


def test_encoding(stages):
    from tokenizers import Tokenizer

    _, before, after = stages[4]
    t = Tokenizer.from_file(bpe.TOKENIZER)
    t.encode_special_tokens = True
    assert len(after) == len(before) and all(r["round_trip"] for r in after)
    assert all(r["token_ids"] == t.encode(r["text"], add_special_tokens=False).ids and r["n_tokens"] == len(r["token_ids"]) for r in after)


def test_run_is_the_stages_in_sequence(spark, stages):
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == Counter((r["doc_id"], r["n_tokens"]) for r in stages[-1][2])


ODD = [
    (1, "the cat and the dog are in the house of the old man", "en", "a", 1, "x"), (1, "the cat and the dog are in the house of the old man", "en", "a", 1, "x"), (None, None, None, None, None, None),
    (2, "", "en", "a", 0, "y"), (3, "the quick brown fox and the lazy dog " * 3000, "en", "b", 9, None), (4, "the cat and the dog are in the house of the old man", "fr", None, 1, "z"), (None, "le chat et le chien sont dans la maison", "fr", "b", 1, "z"),
]


def test_odd_rows_and_clashing_names(spark):
    names = ["removed_id", "content_key", "content_tie", "epoch", "cut_source", "row_tie", "token_ids", "n_tokens"]
    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars int, `a.b` string")
    for n in names:
        df = df.withColumn(n, mixing.F.lit(n))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, SF)
        kept[name] = out.collect()
        assert out.columns[: len(df.columns)] == df.columns, name
        assert stage(spark, df.limit(0), SF).count() == 0, name
    assert all(r["text"] for r in kept["language_id"]), "what has no letters is no text of a language"
    assert sorted(str(r["doc_id"]) for r in kept["exact_dedup"]) == ["1", "2", "3", "None", "None"]
    assert sorted(str(r["doc_id"]) for r in kept["near_dedup"]) == ["1", "1", "2", "3", "None", "None"]
    assert len(kept["bpe"]) == len(ODD) and sum(r["round_trip"] is None for r in kept["bpe"]) == 1
