"""Each operator against a brute-force version, and on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corpuscle.llm import exact_dedup, kn_lm, langid, line_dedup, mixing, pivot_search, sharding, simhash, url_templates

LONG = "lorem ipsum dolor " * 60_000
ODD = [(1, "a b c d", "x", "p"), (1, "a b c d", "x", "p"), (None, None, None, None), (2, "", "y", "q"), (3, LONG, "w", "p"), (4, "a b c d", "x", None), (None, "a b c d", "z", "q"), (5, " \n\t!", "y", "q"), (6, None, "y", "q")]
SCHEMA = "doc_id long, text string, content_key string, source string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def texts(n, seed=0, size=120):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(3000)]
    return [" ".join(rnd.choice(vocabulary) for _ in range(size)) for _ in range(n)], vocabulary, rnd


def edited(text, rnd, vocabulary, share):
    return " ".join(rnd.choice(vocabulary) if rnd.random() < share else w for w in text.split())


# ---- SimHash


def groups(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in range(n) if find(i) != i}


def test_simhash_finds_what_brute_force_finds(spark):
    base, vocabulary, rnd = texts(150)
    rows = base + [edited(t, rnd, vocabulary, rnd.choice([0.02, 0.05, 0.08, 0.3])) for t in base for _ in range(2)]
    fp, _ = simhash.fingerprints(pa.array(rows))
    f = fp.view(np.uint64)
    near = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if np.bitwise_count(f[i] ^ f[j]).sum() <= simhash.MAX_BITS]
    want = groups(len(rows), near)
    got = {r["doc_id"]: r["duplicate_of"] for r in simhash.near_duplicates(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert len(near) > 150 and set(got) <= set(want) and len(got) >= 0.95 * len(want)
    assert not any(i < 150 for i in got), "different texts are left alone"


def test_simhash_leaves_out_no_near_pair(spark):
    base, vocabulary, rnd = texts(400, seed=7)
    rows = base + [edited(t, rnd, vocabulary, 0.08) for t in base]
    f = simhash.fingerprints(pa.array(rows))[0].view(np.uint64)
    near = [(i, j) for i in range(len(rows)) for j in (i + 1 + np.flatnonzero(np.bitwise_count(f[i] ^ f[i + 1 :]).sum(axis=1) <= simhash.MAX_BITS)).tolist()]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    for most in (simhash.ROWS_AT_ONCE, 100):
        got = {r["doc_id"]: r["duplicate_of"] for r in simhash.near_duplicates(df, rows_at_once=most).collect()}
        assert got == groups(len(rows), near) and len(got) > 350


@pytest.mark.parametrize("bits", [0, 1])
def test_simhash_meets_pairs_that_barely_reach(bits):
    """Pairs at MAX_BITS that exceed what is looked for in every table but one, among so many rows that differences are looked up."""
    rnd, reach = np.random.default_rng(5), simhash.reach(simhash.MAX_BITS)
    assert sum(t + 1 for t in reach) == simhash.MAX_BITS + 1
    fp = rnd.integers(0, 2, ((6000, 10_000)[bits], simhash.TABLES, simhash.WIDTH), dtype=np.uint8)
    other = []
    for i in range(simhash.TABLES):
        for extra in (0, 1):  # MAX_BITS bits and one more
            one = fp[len(other)].copy()
            for k in range(simhash.TABLES):
                one[k, rnd.permutation(simhash.WIDTH)[: reach[k] + 1 - (k == i) + extra * (k == i)]] ^= 1
            other.append(one)
    raw = np.packbits(np.concatenate([fp, other]).reshape(-1, simhash.BITS), axis=1)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(raw))), pa.array([x.tobytes() for x in raw], pa.binary())], names=["doc_id", "fp"])
    out = list(simhash._join(simhash.MAX_BITS, bits)(simhash._copies(simhash.MAX_BITS, bits)([batch])))
    assert sorted((v, u) for b in out for u, v in zip(*(c.to_pylist() for c in b.columns), strict=True)) == [(2 * i, len(fp) + 2 * i) for i in range(simhash.TABLES)]


def test_simhash_probes_meet_each_pair_once():
    rnd = np.random.default_rng(2)
    code = np.sort(rnd.integers(0, 1 << 18, 6000) << 6)  # all agree in the first of four parts of six bits
    code[:50] = code[0]
    far = np.bitwise_count(code[:, None] ^ code)
    for part, width in ((0, 0), (0, 6), (1, 6), (3, 6)):
        cut = [code >> 6 * c & 63 for c in range(4)]
        want = np.triu(far <= 3, 1)
        if width:
            want &= cut[part][:, None] == cut[part]
            for c in range(part):
                want &= cut[c][:, None] != cut[c]
        got = [(min(x, y), max(x, y)) for met in simhash._probes(code, 3, part, width) for a, b in simhash._met(*met) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
        assert len(got) == len(set(got)) and set(got) == set(zip(*(x.tolist() for x in np.nonzero(want)), strict=True))


def test_manhattan_distance_bounds_hamming():
    rnd = np.random.default_rng(1)
    fp = rnd.integers(0, 256, (60, simhash.BITS // 8), dtype=np.uint8)
    g = simhash.grid(fp).astype(int)
    bits = np.unpackbits(fp, axis=1).reshape(60, simhash.TABLES, -1).astype(int)
    for i, j in itertools.combinations(range(60), 2):
        assert (np.abs(g[i] - g[j]).sum(axis=1) <= np.abs(bits[i] - bits[j]).sum(axis=1)).all()


def test_simhash_group_of_copies_and_clashing_names(spark):
    base, vocabulary, rnd = texts(3, seed=4)
    rows = [(i, base[0], "x") for i in range(60)] + [(100, base[1], "y"), (101, base[2], "z"), (102, edited(base[0], rnd, vocabulary, 0.02), "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, removed_id string").withColumn("__removed_id", simhash.F.lit(1))
    assert sorted(map(tuple, simhash.near_duplicates(df).collect())) == [(i, 0) for i in [*range(1, 60), 102]]
    for most in (0, 1000):
        kept = simhash.deduplicated(df, broadcast_rows=most)
        assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 100, 101]


def test_simhash_odd_rows(odd):
    assert sorted(map(tuple, simhash.near_duplicates(odd).collect())) == [(4, 1)]
    kept = simhash.deduplicated(odd)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 1
    assert simhash.deduplicated(odd, broadcast_rows=0).count() == len(ODD) - 1
    assert simhash.near_duplicates(odd.limit(0)).count() == 0 and simhash.deduplicated(odd.limit(0)).count() == 0


# ---- line dedup


def brute_lines(rows):
    seen, cover = set(), {}
    for i, text in rows:
        lines = text.split("\n")
        for p in range(len(lines) - 2):
            w = tuple(lines[p : p + 3])
            if all(not x.strip(" ") for x in w):
                continue
            if w in seen:
                cover.setdefault(i, set()).update((p, p + 1, p + 2))
            seen.add(w)
    return {i: "\n".join(x for p, x in enumerate(t.split("\n")) if p not in cover.get(i, ())) for i, t in rows}


def test_lines_against_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, "\n".join(rnd.choice(["a", "b", "c", "", " ", "dd"]) for _ in range(rnd.randint(0, 14)))) for i in range(120)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_lines(rows)


def test_lines_odd_rows(spark, odd):
    assert line_dedup.deduplicated(odd).count() == len(ODD) and line_dedup.deduplicated(odd.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "a\nb\nc", "k"), (1, "a\nb\nc", "k"), (None, "a\nb\nc", "k")], "doc_id long, text string, row_key string")
    assert sorted(r["text"] for r in line_dedup.deduplicated(twice).collect()) == ["", "", "a\nb\nc"]


# ---- mixing


def test_mixing_against_brute_force(spark):
    rnd = random.Random(5)
    rows = [(i, "w " * rnd.randint(0, 9), rnd.choice("abc")) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights, budget = {"a": 5, "b": 1, "c": 2}, 2000
    keys = {r[0]: r[1] for r in df.select("doc_id", mixing.random_key(df.doc_id, 0)).collect()}
    want = Counter()
    for s, w in weights.items():
        mine = sorted((r for r in rows if r[2] == s), key=lambda r: (keys[r[0]], r[0]))
        total, share = sum(len(r[1].split()) for r in mine), budget * w // 8
        rest = share % total
        for r in mine:
            rest -= len(r[1].split())
            want[r[0]] += share // total + (rest >= 0)
    for size in (7, 1_000_000):
        got = mixing.mixed(df, weights, budget, rows_per_range=size).collect()
        assert Counter(r["doc_id"] for r in got) == +want
        assert len({(r["doc_id"], r["epoch"]) for r in got}) == len(got)
    assert mixing.mixed(df, weights, budget, broadcast_rows=0).count() == sum(want.values())


def test_mixing_takes_equal_rows_together(spark):
    rows = [(1, "a b", "s")] * 3 + [(2, "c", "s"), (None, None, None), (None, "x y z", None), (3, "", "t")]
    df = spark.createDataFrame(rows, "doc_id long, `the.text` string, source string")
    def got(budget):
        rows = mixing.mixed(df, {"s": 1}, budget, text_col="the.text").collect()
        assert all(not r["the.text"] for r in rows if r["source"] != "s"), "of other sources only what has no tokens fits"
        return Counter((r["doc_id"], r["epoch"]) for r in rows if r["source"] == "s")

    assert got(7) == {(1, 1): 3, (2, 1): 1}
    assert got(5) in ({(2, 1): 1}, {}), "of three equal rows none fits beside the other"


def test_mixing_odd_rows(odd):
    out = mixing.mixed(odd.withColumnRenamed("content_key", "epoch"))
    assert out.columns == ["doc_id", "text", "epoch", "source", "epoch_"] and out.count() > 0
    assert mixing.mixed(odd.limit(0)).count() == 0


# ---- language model


def brute_kn(rows, order):
    grams = [t.split() for t in rows if t]
    counts = {n: Counter() for n in range(1, order + 1)}
    for w in grams:
        s = ["<"] * (order - 1) + w + [">"]
        counts[order].update(tuple(s[i - order + 1 : i + 1]) for i in range(order - 1, len(s)))
    for n in range(order - 1, 0, -1):
        for g, c in counts[n + 1].items():
            counts[n][g[1:]] += c if n > 1 and g[1] == "<" else 1
    discount = {}
    for n in counts:
        n1, n2, n3, n4 = (sum(c == k for c in counts[n].values()) for k in (1, 2, 3, 4))
        discount[n] = [0, 0.5, 1.0, 1.5]
        if n1 * n2 * n3 * n4:
            y = n1 / (n1 + 2 * n2)
            discount[n] = [0, *(min(max(k - (k + 1) * y * b / a, 0), k) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))]

    def prob(g):
        n = len(g)
        d = discount[n]
        mine = {k: c for k, c in counts[n].items() if k[:-1] == g[:-1]}
        total = sum(mine.values())
        if not total:
            return prob(g[1:])
        lower = prob(g[1:]) if n > 1 else 1 / (len(counts[1]) + 1)
        return (max(mine.get(g, 0) - d[min(mine.get(g, 0), 3)], 0) + sum(d[min(c, 3)] for c in mine.values()) * lower) / total

    out = []
    for w in grams:
        s = ["<"] * (order - 1) + w + [">"]
        out.append(sum(np.log10(prob(tuple(s[i - order + 1 : i + 1]))) for i in range(order - 1, len(s))))
    return out


@pytest.mark.parametrize("order", [2, 3])
def test_kneser_ney_against_brute_force(spark, order):
    rnd = random.Random(order)
    rows = [" ".join(rnd.choice("abcdeeefgaab") for _ in range(rnd.randint(1, 12))) for _ in range(40)]
    got = kn_lm.score(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), order=order, buckets=4).orderBy("doc_id").collect()
    assert np.allclose([r["log10_prob"] for r in got], brute_kn(rows, order))
    assert [r["n_tokens"] for r in got] == [len(t.split()) + 1 for t in rows]


def test_language_model_odd_rows(odd):
    got = kn_lm.score(odd, buckets=2).collect()
    assert len(got) == len(ODD) and sum(r["log10_prob"] is None for r in got) == 4
    assert kn_lm.score(odd.limit(0), buckets=2).count() == 0


def test_language_model_counts_beyond_a_byte(spark, monkeypatch):
    rnd = random.Random(8)
    rows = ["a b"] * 700 + ["a b c"] * 255 + [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 9))) for _ in range(60)]
    rows += [r for r in rows[-20:]]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(kn_lm, "_AT_ONCE", 50)  # tasks and buckets merge in many steps
    got = kn_lm.score(df, buckets=2).orderBy("doc_id").collect()
    assert np.allclose([r["log10_prob"] for r in got], brute_kn(rows, 3))


def test_language_model_of_other_texts(spark):
    model = kn_lm.fit(spark.createDataFrame([("a b c",), ("a b d",)], "text string"), buckets=4)
    got = kn_lm.score(spark.createDataFrame([(1, "a b x"), (1, "a b c"), (2, "x y")], "`an id` long, `a.text` string"), model, "an id", "a.text").collect()
    assert [r["n_tokens"] for r in got] == [4, 4, 3] and got[1]["log10_prob"] > got[0]["log10_prob"] > -20


def test_language_model_sees_more_than_one_word_back(spark):
    rows = ["a b c", "d b e"] * 20 + ["a b c", "a b e"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["doc_id"]: r["log10_prob"] for r in kn_lm.score(df).collect()}
    assert got[41] < got[40] - 0.5, "the pairs of both are as frequent"
    assert np.allclose([got[i] for i in range(len(rows))], brute_kn(rows, 3))


def test_language_model_buckets_follow_the_input(spark, monkeypatch):
    df = spark.createDataFrame([(1, "x" * 1000), (2, None)], "doc_id long, text string")
    assert kn_lm.sized_buckets(df) == kn_lm.BUCKETS == kn_lm.sized_buckets(df.limit(0))
    monkeypatch.setattr(kn_lm, "BUCKET_CHARS", 10)
    assert kn_lm.sized_buckets(df) == 128


# ---- URL templates


def test_url_templates(spark):
    rnd = random.Random(2)
    pages, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        pages.append((i, f"https://H.org/{'spam' if bad else rnd.choice(['news', 'blog', 'wiki'])}/{rnd.randint(1, 10**6)}?q={i}"))
        if i % 2:
            labels.append((i, int(not bad)))
    pages += [(None, None), (600, ""), (601, "no scheme"), (602, "https://x.org"), (602, "https://x.org")]
    got = url_templates.judged(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, quality int")).collect()
    assert len(got) == len(pages)
    of = {r["page_id"]: r for r in got}
    assert of[0]["template"] == "/spam/{n}" and of[0]["rejected"] and all(of[i]["rejected"] == (i % 3 == 0) for i in range(600))
    assert {of[i]["template"] for i in range(600) if i % 3} <= {"/*/{n}", "/news/{n}", "/blog/{n}", "/wiki/{n}"}
    assert of[None]["template"] is None and not of[None]["rejected"] and of[602]["template"] == "" and not of[602]["rejected"]
    labelled = sum(i % 3 == 0 and i % 2 == 1 for i in range(600))  # none of them good
    overall = sum(q for _, q in labels) / len(labels)
    assert of[0]["purity"] == pytest.approx(url_templates.PRIOR * overall / (labelled + url_templates.PRIOR))


def brute_templates(shapes):
    """{(host, shape): template} level by level; shapes: {(host, shape): (labelled, good)}."""
    out = {}

    def go(host, done, rows):
        for shape, rest, _, _ in rows:
            if not rest:
                out[host, shape] = done
        rows = [r for r in rows if r[1]]
        child = {}
        for r in rows:
            c = child.setdefault(r[1][0], [0, 0])
            c[0] += r[2]
            c[1] += r[3]
        nl, ng = sum(c[0] for c in child.values()), sum(c[1] for c in child.values())
        after = {}
        for r in rows:
            labelled, good = child[r[1][0]]
            rl, rg, own = nl - labelled, ng - good, len(child) == 1
            if not own and labelled >= url_templates.MIN_LABELLED and rl >= url_templates.MIN_LABELLED:
                p = ng / nl
                own = abs(good / labelled - rg / rl) > url_templates.Z * (p * (1 - p) * (1 / labelled + 1 / rl)) ** 0.5
            after.setdefault(r[1][0] if own else "*", []).append((r[0], r[1][1:], *r[2:]))
        for seg, mine in after.items():
            go(host, f"{done}/{seg}", mine)

    for host in {h for h, _ in shapes}:
        go(host, "", [(s, [x for x in s.split("/") if x], *n) for (h, s), n in shapes.items() if h == host])
    return out


def test_url_templates_against_brute_force(spark):
    rnd = random.Random(12)
    shapes = {}
    for _ in range(400):
        host = rnd.choice(["a.org", "b.org", ""])
        depth = rnd.choice([0, 1, 2, 3, 4, 5])
        path = [rnd.choice(["x", "y", "z"] if i < 2 else ["p", "p", "p", "q"]) for i in range(depth)]
        labelled = rnd.choice([0, 5, 30])
        share = 0.9 if path[:1] == ["x"] else 0.5 if path[:2] == ["y", "z"] else 0.1
        shapes[host, "/".join(path)] = (labelled, sum(rnd.random() < share for _ in range(labelled)))
    df = spark.createDataFrame([(h, s, 1, *n) for (h, s), n in shapes.items()], "host string, shape string, n long, labelled long, good long")
    got = {(r["host"], r["shape"]): r["template"] for r in url_templates.templates(df).collect()}
    assert got == brute_templates(shapes) and any("*" in t for t in got.values()) and any(t.startswith("/x/") for t in got.values())


def test_url_templates_odd_rows(spark):
    long = "https://h.org/" + "/".join(f"s{i}" for i in range(200))
    pages = [(1, long, "a"), (1, long, "a"), (2, long + "/end", "b"), (None, "https://h.org/s0", "c"), (3, "https://h.org/" + "x" * 200_000, "d"), (4, None, None), (5, "", "e")]
    labels = [(1, 0), (1, 1), (2, 0), (2, 0), (3, None), (None, 0), (9, 1)]
    got = url_templates.judged(spark.createDataFrame(pages, "page_id long, url string, host string"), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(got) == len(pages)
    by = {r["page_id"]: r for r in got}
    assert by[1]["labelled"] == 2 and by[1]["rejected"] and by[2]["rejected"], "of several labels the lowest counts"
    assert len({r["template"] for r in got if r["page_id"] == 1}) == 1 and by[4]["template"] is None and by[5]["host"] == ""


def test_url_templates_long_paths_take_few_rounds(spark, monkeypatch):
    rounds = []
    true = url_templates._ahead
    monkeypatch.setattr(url_templates, "_ahead", lambda todo: rounds.append(1) or true(todo))
    path = [f"s{i}" for i in range(200)]
    rows = [("h", "/".join([*path[:n], *end]), 1, 0, 0) for n, end in ((200, []), (50, []), (120, ["x"]), (200, ["y"]))]
    got = {r["shape"]: r["template"] for r in url_templates.templates(spark.createDataFrame(rows, "host string, shape string, n long, labelled long, good long")).collect()}
    assert len(got) == 4 and len(rounds) == 1 and got["/".join(path[:50])] == "/" + "/".join(path[:50])


def test_url_templates_without_rows(spark):
    none, no_labels = spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame([], "doc_id long, quality int")
    assert url_templates.judged(none, no_labels).count() == 0
    assert not url_templates.judged(spark.createDataFrame([(1, "https://a.b/c")], "page_id long, url string"), no_labels).first()["rejected"]


# ---- top-k


def brute_top(x, ids, k):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(u @ u.T, 6)
    return {i: [(j, s[a, b]) for b, j in sorted(enumerate(ids), key=lambda bj: (-s[a, bj[0]], bj[1])) if j != i][:k] for a, i in enumerate(ids)}


@pytest.mark.parametrize("block", [16, 4096])
def test_top_k_against_brute_force(spark, block):
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(180, 8))
    x[100:140] = x[:40]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(0, x[0].tolist()), (500, None), (501, []), (502, [0.0] * 8), (503, [1.0]), (None, x[3].tolist()), (504, [float("nan")] * 8)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "vec_id long, embedding array<double>, block string")
    want = brute_top(x, list(range(180)), 5)
    for asked in (None, df.where("vec_id is null or vec_id % 7 = 0")):
        got = {}
        for r in pivot_search.top_k(df, asked, 5, block=block, pivots=5).collect():
            got.setdefault(r["vec_id"], {})[r["rank"]] = (r["neighbor_id"], r["similarity"])
        assert set(got) == {i for i in range(180) if asked is None or i % 7 == 0}
        assert all([got[i][r + 1] for r in range(5)] == want[i] for i in got)


def test_top_k_with_a_third_of_copies(spark):
    rnd = np.random.default_rng(6)
    x = rnd.normal(size=(90, 6))
    x[30:60] = x[7]
    want = brute_top(x, list(range(90)), 4)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, `a.b` array<float>").withColumnRenamed("a.b", "x.y")
    got = {(r["vec_id"], r["rank"]): r["neighbor_id"] for r in pivot_search.top_k(df, df.where("vec_id < 40"), 4, vector_col="x.y", block=8).collect()}
    assert got == {(i, r + 1): want[i][r][0] for i in range(40) for r in range(4)}


def test_pivot_bounds(spark):
    """The table's bound lies between the triangle inequality's and the distance, and spares evaluations where vectors cluster."""
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(300, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    p = pivot_search.Pivots(x[:9])
    d = pivot_search.distances(x, p.vectors)
    rows = p.rows(d)
    bound, true = pivot_search.distances(rows, rows), pivot_search.distances(x, x)
    triangle = np.abs(d[:, None, :] - d[None, :, :]).max(axis=2)
    assert (bound <= true + 1e-6).all() and (bound >= triangle - 1e-6).all()
    low = rnd.normal(size=(2000, 6)) @ rnd.normal(size=(6, 64))
    low /= np.linalg.norm(low, axis=1, keepdims=True)
    p = pivot_search.Pivots(pivot_search.spread(low, 8))
    best = pivot_search.Best(20, 10)
    done = pivot_search.search_block(best, np.arange(20), np.arange(20), low[:20], p.rows(pivot_search.distances(low[:20], p.vectors)), np.arange(40), low[:40], p.rows(pivot_search.distances(low[:40], p.vectors)))
    done = pivot_search.search_block(best, np.arange(20), np.arange(20), low[:20], p.rows(pivot_search.distances(low[:20], p.vectors)), np.arange(40, 2000), low[40:], p.rows(pivot_search.distances(low[40:], p.vectors)))
    assert done < 0.05 * 20 * 1960


def test_top_k_few_or_none(spark):
    kind = "vec_id long, embedding array<float>"
    assert pivot_search.top_k(spark.createDataFrame([], kind)).count() == 0
    assert pivot_search.top_k(spark.createDataFrame([(1, [1.0, 0.0])], kind)).count() == 0
    assert pivot_search.top_k(spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0])], kind)).count() == 2


# ---- sharding


def test_shards_are_equal_and_ordered(spark):
    rnd = random.Random(9)
    rows = [(rnd.randint(-(10**9), 10**9), "x" * rnd.randint(0, 80)) for _ in range(3000)]
    got = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string"), shards=8).collect()
    size, last = Counter(), None
    for r in got:
        size[r["shard"]] += len(r["text"])
        assert last is None or (r["shard"], r["doc_id"]) >= last
        last = (r["shard"], r["doc_id"])
    assert sorted((r["doc_id"], r["text"]) for r in got) == sorted(rows)
    mean = sum(size.values()) / 8
    assert len(size) == 8 and all(abs(s - mean) <= 2 * sharding.TOLERANCE * mean + 160 for s in size.values())


def brute_marks(rows, shards):
    """Of rows (key, bytes), for each bound between shards the target and the sums below all keys."""
    at, below = 0, []
    for k, n in sorted(rows):
        below.append((k, at))
        at += n
    return [at * i / shards for i in range(1, shards)], below, at


@pytest.mark.parametrize("most", [5, 1000])
def test_splitters_against_exact_ones(spark, most):
    rnd = random.Random(11)
    rows = [(None if rnd.random() < 0.05 else rnd.choice([7, rnd.randint(0, 50), rnd.randint(-(2**62), 2**62)]), "x" * rnd.randint(0, 60), i) for i in range(2500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, order_key int")
    out = sharding.sharded(df, shards=12, most=most)
    got = [(r["shard"], r["doc_id"], len(r["text"]), r["order_key"]) for r in out.collect()]
    assert sorted(g[3] for g in got) == list(range(2500)) and out.columns == [*df.columns, "shard"]
    ids = [(s, -(2**63) if i is None else i) for s, i, _, _ in got]
    assert ids == sorted(ids), "shards and rows within ascend with the id, nulls first"
    total, at = sum(g[2] for g in got), 0
    for s in range(11):
        at += sum(g[2] for g in got if g[0] == s)
        # the exact bound lies within a row, the tolerance and what a group of shards was off by
        assert abs(at - total * (s + 1) / 12) <= 60 + 2 * sharding.TOLERANCE * total / 12, s


def test_shards_of_a_very_large_text_and_ties(spark):
    rows = [(5, "x" * 400_000)] + [(7, f"{i}" * 50) for i in range(300)] + [(9, "same")] * 40
    got = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string"), shards=6, most=2).collect()
    assert len(got) == len(rows) and len({r["shard"] for r in got if r["doc_id"] == 9}) == 1, "equal rows stay together"
    got = sharding.sharded(spark.createDataFrame(rows[1:301], "doc_id long, text string"), shards=4).collect()
    assert len({r["shard"] for r in got}) == 4, "rows of one id are split by their hash"


def test_shards_odd_rows(odd):
    out = sharding.sharded(odd.withColumnRenamed("source", "shard"), shards=3)
    assert out.columns[-1] == "shard_" and out.count() == len(ODD)
    assert sharding.sharded(odd.limit(0)).count() == 0
    with pytest.raises(TypeError):
        sharding.sharded(odd, id_col="text")


# ---- language ID


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs, hold_out=(5, 0))
    held = docs.where("pmod(xxhash64(doc_id, 'langid'), 1 << 30) % 5 = 0")
    rows = held.join(langid.identify(held, model), "doc_id").where("length(text) > 60 and accepted").collect()
    assert len(rows) > 100 and sum(r["lang"] == r["predicted"] for r in rows) / len(rows) > 0.95


def test_language_scores_equal_a_plain_sum(spark):
    df = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr")], "doc_id long, text string, lang string")
    model = langid.fit(df)
    for text in ("the dog", "le chien, l'été!", "a", LONG[:1000]):
        code, _ = langid._codes(pa.array([text]))
        want = sum(model.log_prob[langid._hashes(code[i : i + n], n)[0]].astype(float) for n in langid.ORDERS for i in range(len(code) - n + 1))
        total, count = langid.scores(pa.array(["x y", text, None]), model.log_prob)
        assert np.allclose(total[1], want) and count[1] == sum(len(code) - n + 1 for n in langid.ORDERS) and count[2] == 0


def test_language_rejects_noise_and_odd_rows(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    rnd = random.Random(1)
    noise = ["".join(rnd.choice("qxzjkvwqqzx") for _ in range(400)), "Мы живём в большом городе " * 9, "12345 67890 !!", ""]
    got = {r["doc_id"]: r for r in langid.identify(spark.createDataFrame(list(enumerate(noise)), "doc_id long, text string"), model).collect()}
    assert not any(got[i]["accepted"] for i in range(4)) and got[3]["predicted"] is None
    kept = langid.accepted(odd, model)
    assert kept.columns == odd.columns and kept.where("text is null or text = ''").count() == 0
    assert langid.identify(odd, model).count() == len(ODD) and langid.identify(odd.limit(0), model).count() == 0
    assert langid.accepted(docs.limit(0)).count() == 0


def test_language_rejects_other_latin_languages_blobs_and_markup(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    rnd = random.Random(1)
    other = [
        "La città era tranquilla quella mattina e il vecchio camminava lungo la strada che porta al mercato, dove le donne vendevano frutta e verdura.",
        "Kaupunki oli sinä aamuna hiljainen ja vanha mies käveli tietä pitkin torille, jossa naiset myivät hedelmiä ja vihanneksia.",
        "Miasto było tego ranka spokojne, a stary człowiek szedł drogą prowadzącą na rynek, gdzie kobiety sprzedawały owoce i warzywa.",
        '<div class="nav"><a href="/x/y.html" id="b1"><span style="color:red">x</span></a></div><script src="jquery.min.js"></script>' * 4,
        "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(400)),
        "a" * 300,
    ]
    assert not langid.predict(pa.array(other), model)[2].any()
    assert langid.identify(docs, model).where("not accepted").count() == 0, "all labelled documents stay"


# ---- exact dedup


@pytest.mark.parametrize(("memory", "hot"), [(300, 1 << 28), (1 << 27, 1 << 28), (1 << 27, 2000), (300, 500)])
def test_exact_against_brute_force(spark, memory, hot):
    rnd = random.Random(6)
    rows = [(i, "t" * rnd.randint(0, 40) + rnd.choice(["", "é"])) for i in range(400)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    first = {}
    for i, t in sorted(rows):
        first.setdefault(t, i)
    want = sorted((i, first[t]) for i, t in rows if first[t] != i)
    assert sorted(map(tuple, exact_dedup.duplicates(df, memory_bytes=memory, hot_bytes=hot).collect())) == want
    assert sorted(r["doc_id"] for r in exact_dedup.deduplicated(df, memory_bytes=memory, hot_bytes=hot).collect()) == sorted(first.values())


@pytest.mark.parametrize("hot", [1 << 28, 100])
def test_exact_odd_rows(odd, hot):
    """Hot texts give what others give: repeated rows, null ids, null texts and a column of the name of a helper's."""
    assert sorted(map(str, map(tuple, exact_dedup.duplicates(odd, hot_bytes=hot).collect()))) == sorted(map(str, [(1, 1), (4, 1), (None, 1)]))
    kept = exact_dedup.deduplicated(odd, hot_bytes=hot)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 3
    assert sorted(str(r["text"])[:9] for r in kept.collect()) == sorted(["a b c d", "None", "None", "", "lorem ips", " \n\t!"])
    assert exact_dedup.deduplicated(odd.limit(0)).count() == 0
