"""Operators without SQL on small cases with known results."""

from corpuscle.functions import text
from corpuscle.operators import evaluation, graph, inventory, layout, similarity


def found(spark, edges, nodes):
    e = spark.createDataFrame([(s, d, 1.0) for s, d in edges], "src long, dst long, weight double")
    return dict(map(tuple, similarity.communities(e, spark.createDataFrame([(n,) for n in nodes], "node long")).collect()))


def test_communities_of_a_path(spark):
    path = [(i, i + 1) for i in range(1000)]
    got = found(spark, path, [*range(1001), 9000])
    assert len(got) == 1002 and got[9000] == 9000
    assert all(min(n for n in got if got[n] == c) == c for c in set(got.values()))
    degree: dict = {}
    for pair in path:
        for n in pair:
            degree[got[n]] = degree.get(got[n], 0) + 1
    modularity = sum(got[s] == got[d] for s, d in path) / len(path) - sum((x / (2 * len(path))) ** 2 for x in degree.values())
    assert modularity > 0.93


def test_communities_of_joined_cliques(spark):
    starts = (0, 10, 20)
    edges = [(b + i, b + j) for b in starts for i in range(6) for j in range(i)] + [(0, 10), (11, 20)]
    assert found(spark, edges, [b + i for b in starts for i in range(6)]) == {b + i: b for b in starts for i in range(6)}


def test_languages_of_the_end_of_a_long_text():
    french, english = "le chat et la souris dans les murs de la ville pour une nuit ", "the cat and the mouse in the walls of the town for this night "
    assert "en" not in text.languages(french * 300)
    assert text.languages(french * 300 + english * 300)[:2] == ["en", "fr"]


def test_negatives_are_found_beyond_the_next_documents(spark):
    reps = [(f"d{i:02}", f"c{i:02}", "law", 1950) for i in range(12)] + [("x", "x", None, None)]
    pairs = [(f"c{i:02}", f"c{j:02}") for j in range(12) for i in range(j)]
    free = {("c00", "c05"), ("c03", "c07"), ("c02", "c11"), ("c01", "c08")}
    r = spark.createDataFrame(reps, "document_id string, chunk_id string, doc_type string, year int")
    e = spark.createDataFrame([p for p in pairs if p not in free], "src string, dst string")
    got = [(x["src"], x["dst"]) for x in evaluation.no_edge_negatives(r, e, 10).collect()]
    assert set(got) == free and len(got) == 4
    assert evaluation.no_edge_negatives(r, e.limit(0), 60).count() == 60
    assert evaluation.no_edge_negatives(r.limit(0), e, 5).count() == 0


def test_embedded_text_that_is_not_credible_does_not_win(spark):
    good = "The parties agree to the terms of this convention and shall ratify it within one year of its signature here. "
    readings = [("p", "native_text", good + "�", 0.99, 0.9, 0), ("p", "apple_vision", good, 0.95, 0.9, 1), ("q", "native_text", good, 0.8, 0.9, 0), ("q", "apple_vision", good + " ok", 0.85, 0.9, 1), ("r", "native_text", " ", 0.9, 0.0, 0), ("r", "tesseract", "", 0.9, 0.0, 1)]
    df = spark.createDataFrame(readings, "page string, method string, text string, confidence double, image_cover double, seq int")
    got = {r["page"]: r["method"] for r in layout.choose(df, ["page"]).collect()}
    assert got == {"p": "apple_vision", "q": "native_text", "r": "native_text"}


def test_agreement_against_common_blocks():
    a, b = "The quick brown fox jumps over it", "the QUICK, brown cat jumps over it!"
    x, y = "thequickbrownfoxjumpsoverit", "thequickbrowncatjumpsoverit"

    def common(s, t):
        best = max(((n, i, j) for i in range(len(s)) for j in range(len(t)) for n in range(1, min(len(s) - i, len(t) - j) + 1) if s[i : i + n] == t[j : j + n]), key=lambda m: (m[0], -m[1], -m[2]), default=None)
        return best[0] + common(s[: best[1]], t[: best[2]]) + common(s[best[1] + best[0] :], t[best[2] + best[0] :]) if best else 0

    assert text.agree(a, b) == 2 * common(x, y) / (len(x) + len(y))
    assert text.agree(a, a.upper()) == 1.0 and text.agree("short", a) is None and text.agree(None, a) is None


def test_names_found_against_every_place(spark):
    names = [("New York", "Place"), ("York", "Place"), ("New", "Org"), ("york city", "Place"), ("é", "Org")]
    entries = spark.createDataFrame([(n, [], None, None, None, t) for n, t in names], "label string, aliases array<string>, qid string, iso3 string, lang string, type string")
    texts = ["New York City, new york; Newark éa é NEW", "", None, "yorknew york"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    got = {r["id"]: [(h["char_start"], h["char_end"], h["label"]) for h in r["hits"]] for r in graph.match_gazetteer(df, entries).collect()}

    def brute(t):
        hits = []
        for n, _ in names:
            hits += [(i, i + len(n), n) for i in range(len(t)) if t[i : i + len(n)].lower() == n.lower() and not (i and (t[i - 1].isalnum() or t[i - 1] == "_")) and not t[i + len(n) : i + len(n) + 1].isalnum()]
        kept = []
        for h in sorted(hits, key=lambda h: (h[0] - h[1], h[0])):
            if all(h[1] <= k[0] or h[0] >= k[1] for k in kept):
                kept.append(h)
        return sorted(kept)

    assert got == {i: brute(t or "") for i, t in enumerate(texts)}


def test_files_without_metadata(spark):
    files = spark.createDataFrame([("A.pdf", "h"), ("b.PDF", "h"), ("c.pdf", "x")], "filename string, sha256 string")
    records = spark.createDataFrame([("a.PDF", "T", "t1", None, "law", 1950), ("A.pdf", "S", None, "n", None, 1940), ("z.pdf", "Z", None, None, None, None)], "filename string, title string, treaty_id string, treaty_number string, doc_type string, year int")
    got = {r["document_id"]: r for r in inventory.metadata_view(inventory.with_metadata(files, inventory.group_metadata(records))).collect()}
    assert len(got) == 3 and got["A"]["year"] == 1940 and len(got["A"]["metadata"]) == 2
    assert got["b"]["canonical_filename"] == "A.pdf" and got["b"]["title"] == "" and got["b"]["year"] is None and got["c"]["metadata"] == []


def test_phrases(spark):
    known = spark.createDataFrame([("Règlement Général",)], "surface string")
    page = "selon le Comité Permanent, le Règlement Général, le Comité  Permanent siège. Comité permanent. La République."
    df = spark.createDataFrame([(f"d{i}", 1, page) for i in range(3)], "document_id string, page_number int, text string")
    got = {r["key"]: r for r in evaluation.mine_phrases(df, known, least=2).collect()}
    assert set(got) >= {"comite permanent"} and "reglement general" not in got and "republique" not in got
    r = got["comite permanent"]
    assert (r["label"], r["count"], r["document_count"], r["sample_documents"]) == ("Comité Permanent", 6, 3, "d0|d1|d2") and len(r["examples"]) == 3


def test_paragraphs():
    page = "HEADER 1\n\nThe first line goes on\nand on with a hyphen-\nated word.\nNew sentence.\n- item\n\n\nFooter 9"
    text_, removed = layout.clean_page(page, None, {"header #", "footer #"})
    assert removed == ["HEADER 1", "Footer 9"] and text_.split("\n\n")[0].startswith("The first line goes on and on with a hyphen-")


def test_flat_index_against_brute_force(spark):
    import numpy as np

    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(70, 5))
    x[40:60] = x[3]
    df = spark.createDataFrame([(f"n{i:02}", v.tolist()) for i, v in enumerate(x)], "id string, vector array<float>").repartition(3)
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    s = np.round(np.clip(u @ u.T, 0, 1), 6)
    want = {(f"n{i:02}", f"n{j:02}"): s[i, j] for i in range(70) for j in sorted((j for j in range(70) if j != i), key=lambda j: (-s[i, j], j))[:4]}
    for block in (8, 2048):
        got = {(r["src"], r["dst"]): r["cosine"] for r in similarity.knn(df, 4, block).collect()}
        assert got == want
    assert similarity.knn(df.limit(0), 4).count() == 0


def test_grams_hash_like_md5(spark):
    from hashlib import md5

    h = similarity.GramHashes(most=2)
    for grams in ({"abcde", "é"}, {"x"}, {"abcde"}):
        assert sorted(h.of(grams).tolist()) == sorted(int(md5(g.encode()).hexdigest()[:8], 16) % similarity.PRIME for g in grams)


def test_benchmark_texts_are_compared_case_folded(spark):
    rows = [(1, "Erßie  entech", ["ERSSIE", "erßie ENTECH"]), (2, "Maße", ["masse"]), (3, "e\u0301te", ["ÉTE"]), (4, "Maße", ["Mase"]), (5, "x", None)]
    cases = spark.createDataFrame(rows, "n int, text string, contains array<string>").selectExpr(
        "*", "array('Latin') as scripts", "'native' as method", "false as review", "cast(null as int) as min_chars", "cast(null as string) as script", "cast(null as string) as method_prefix", "cast(null as boolean) as review_required"
    )
    out = evaluation.benchmark_checks(cases)
    assert set(out.columns) == {*cases.columns, "chars_ok", "contains_ok", "script_ok", "method_ok", "review_ok", "passed"}
    assert {r["n"]: (r["contains_ok"], r["passed"]) for r in out.collect()} == {n: (n != 4, n != 4) for n in range(1, 6)}


def test_signatures_against_each_gram(spark):
    import random

    import numpy as np
    import pyarrow as pa

    from corpuscle.operators import minhash

    r = random.Random(5)
    words = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=r.randint(1, 9))) for _ in range(900)]
    texts = [" ".join(r.choices(words, k=k)) for k in (0, 1, 2, 3, 40, 90, 200, 700, 3000, 30000) for _ in range(3)]
    texts += ["", " ", "abc", "abcde", "ab cd e", "é" * 9, "naïve 日本 text", "a" * 5000, "ab" * 300000, None]
    ab = similarity.coefficients(128)
    want = {}
    for i, t in enumerate(texts):
        if x := (t or "").replace(" ", ""):
            h = minhash.GramHashes().of({x[j : j + 5] for j in range(max(1, len(x) - 4))})
            want[i] = [min((int(v) * a + b) % minhash.PRIME for v in h) for a, b in ab]
    for most in (1 << 20, 1 << 13):  # with so few places grams are forgotten in between
        mine = minhash.Signer(np.array(ab, np.uint64), 5, most)
        for _ in range(2):
            rows, least = mine.of(pa.array(texts))
            assert {int(i): x.tolist() for i, x in zip(rows, least, strict=True)} == want
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    from pyspark.sql import functions as F

    assert {x["id"]: x["sig"] for x in similarity.signatures(rows, "id", F.col("t")).collect()} == want


def test_lexical_pairs_of_many_copies_against_all(spark):
    import random

    r = random.Random(3)
    cfg = similarity.Config()
    base = [[r.randrange(1 << 30) for _ in range(cfg.permutations)] for _ in range(4)]
    rows = []
    for i in range(1100):  # more near copies than a unit has room for
        rows.append((i, [v if r.random() < 0.97 else r.randrange(1 << 30) for v in base[0]]))
    rows += [(i, [v if r.random() < 0.6 else r.randrange(1 << 30) for v in base[i % 3 + 1]]) for i in range(1100, 1200)]
    rows += [(i, rows[i % 7][1]) for i in range(1200, 1210)]
    got = similarity.lexical_pairs(spark.createDataFrame(rows, "id long, sig array<long>"), cfg).collect()

    import numpy as np

    sig = np.array([s for _, s in rows])
    want = 0
    found = {(x["src"], x["dst"]): x["jaccard"] for x in got}
    assert len(found) == len(got)
    for i in range(len(sig)):
        equal = sig[i + 1 :] == sig[i]
        near = np.flatnonzero(equal[:, :125].reshape(-1, 25, 5).all(axis=2).any(axis=1))
        want += len(near)
        assert all(abs(found[i, i + 1 + int(j)] - equal[j].sum() / 128) < 1e-6 for j in near[:: 1 if i % 100 == 0 else 97])
    assert len(found) == want


def test_workers_get_small_batches(spark):
    """However many rows a partition has, a worker's batch is bounded, and values become Python's a part at a time."""
    from pyspark.sql import functions as F

    from corpuscle.operators.common import BATCH, small_batches
    from corpuscle.plans.base import table

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(name, str(1 << 30))
    table(spark, "/root/testdata/sf0.001", "documents")
    assert int(spark.conf.get(name).removesuffix("b")) == BATCH
    spark.conf.set(name, "1000")
    small_batches(spark)
    assert spark.conf.get(name).removesuffix("b") == "1000"
    spark.conf.unset(name)
    table(spark, "/root/testdata/sf0.001", "documents")

    rows = spark.range(1000, numPartitions=1).withColumn("t", F.when(F.col("id") % 7 > 0, F.concat(F.lit("Né "), F.col("id").cast("string"))))
    got = {r["id"]: r["n"] for r in rows.select("id", text.normalise_lexical("t").alias("n")).collect()}
    assert got == {i: f"ne {i}" if i % 7 else None for i in range(1000)}
    big = spark.range(40, numPartitions=1).withColumn("t", F.repeat(F.lit("x"), 1 << 20))

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    assert max(r["n"] for r in big.mapInArrow(sizes, "n long").collect()) < 3 * BATCH


def test_shingle_pairs_against_all(spark, monkeypatch):
    import random

    from corpuscle.operators import shingles

    r = random.Random(8)
    words = [f"w{i}" for i in range(4000)]
    texts = []
    for k in range(40):
        base = r.choices(words, k=r.choice((3, 4, 9, 30, 120)))
        for _ in range(r.randint(1, 12)):
            texts.append([w if r.random() < r.choice((0.9, 0.97, 1)) else r.choice(words) for w in base][: len(base) - r.randint(0, len(base) // 3)])
    common = r.choices(words, k=20)
    texts += [common + r.choices(words, k=r.randint(1, 10)) for _ in range(300)]  # a shared passage: near only to some
    texts += [[], ["a"], ["a", "b"], ["a", "b", "c"], ["a", "b", "c"], ["w1"] * 50, ["w1"] * 9]
    rows = list(enumerate(" ".join(t) for t in texts)) + [(9999, None)]
    sets = {i: {tuple(t[j : j + 3]) for j in range(len(t) - 2)} for i, t in enumerate(texts)}
    want = {(i, j): round(len(s & t) / len(s | t), 6) for i, s in sets.items() for j, t in sets.items() if i < j and s & t}
    want = {k: v for k, v in want.items() if v >= 0.6}
    df = spark.createDataFrame(rows, "id long, text string").repartition(3)
    assert len(want) > 500
    for part in (1 << 20, 900):  # one bucket, and many
        monkeypatch.setattr(shingles, "PART", part)
        got = shingles.similar_pairs(df, 0.6).collect()
        assert len(got) == len(want) and {(x["src"], x["dst"]): x["jaccard"] for x in got} == want
    assert shingles.similar_pairs(df.where("id < 0")).count() == 0


def test_communities_compute_their_edges_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    edges = spark.createDataFrame([(i, i + 1, 1.0) for i in range(9)], "src long, dst long, weight double").mapInArrow(count, "src long, dst long, weight double")
    assert similarity.communities(edges, spark.range(10).withColumnRenamed("id", "node")).count() == 10
    assert seen.value == 9


def test_chosen_readings_with_texts_that_differ(spark):
    """The agreement is that of the texts, whether their hashes tell it or not, and the chosen row has its own text."""
    a, b = "The quick brown fox jumps over the lazy dog and runs away. " * 3, "The QUICK brown fox jumps over the lazy dog, and ran away. " * 3
    pairs = [(a, b), (a, a.upper().replace(" ", "  ")), (a, "short"), (a, ""), ("Straße und Weg, so lang wie weit", "STRASSE und Weg so lang wie weit")]
    rows = [(i, m, t, 0.9, 0.1, s) for i, p in enumerate(pairs) for s, (m, t) in enumerate(zip(("apple_vision", "tesseract"), p, strict=True))]
    df = spark.createDataFrame(rows, "page int, method string, text string, confidence double, image_cover double, seq int")
    out = layout.choose(df, ["page"])
    assert out.columns == [*df.columns, "metrics", "score", "agreement"]
    got = {r["page"]: r for r in out.collect()}
    assert {p: r["agreement"] for p, r in got.items()} == {i: text.agree(*p) for i, p in enumerate(pairs)}
    assert got[1]["agreement"] == got[4]["agreement"] == 1.0 and 0.5 < got[0]["agreement"] < 1 and got[2]["agreement"] is None
    assert all((r["page"], r["method"], r["text"], r["confidence"], r["image_cover"], r["seq"]) in rows for r in got.values()) and len(got) == 5
    from corpuscle.operators.layout import scored

    plain = {(r["page"], r["seq"]): (r["score"], r["metrics"]) for r in scored(df).collect()}
    for r in got.values():
        score, metrics = plain[r["page"], r["seq"]]
        assert r["metrics"] == metrics and abs(r["score"] - min(1.0, score + 0.08 * max(0.0, (r["agreement"] or 0) - 0.55))) < 1e-9


def test_hashed_grams_against_each_gram(spark):
    import random
    import zlib

    import numpy as np

    r = random.Random(4)
    texts = ["", "ab", "abc", "é", "ééé", "aé日\U0001f600b"] + ["".join(r.choices("abc XYZ.é日\U0001f600\x7f\0", k=r.randint(0, 200))) for _ in range(300)]
    for dim, n in ((64, 3), (10, 2)):
        for t in texts:
            v = np.zeros(dim)
            for i in range(max(0, len(t) - n + 1)):
                h = zlib.crc32(t[i : i + n].encode())
                v[h % dim] += 1.0 if h >> 31 else -1.0
            assert (similarity.hashed_grams(t, dim, n) == v).all()
    rows = spark.createDataFrame([("The same text",), ("ab",), ("ab",)], "text string")
    got = sorted(sum(x * x for x in r["vector"]) for r in similarity.encode_hashed(rows).collect())
    assert got[0] == 0 and abs(got[1] - 1) < 1e-6 and len(got) == 2


def test_late_decisions_without_python(spark, tmp_path):
    import json

    from corpuscle.streaming import ingest

    rows = [("e2", "2024-01-02 00:00:00", "keep"), ("e1", "2024-01-01 00:00:00", "drop"), ("e3", "2024-01-02 00:00:00", "edit"), ("e0", "2024-01-02 00:00:00", "late")]
    (tmp_path / "in").mkdir()
    for i, (e, at, what) in enumerate(rows):
        (tmp_path / "in" / f"{i}.json").write_text(json.dumps({"event_id": e, "source_sha256": "s", "page_number": 1, "created_at": at, "reviewer": "r", "decision": what}))
    out = ingest.latest_decisions(ingest.read_files(spark, str(tmp_path / "in"), ingest.REVIEW, 1))
    assert "Pandas" not in out._jdf.queryExecution().analyzed().toString()
    seen = []
    out.writeStream.outputMode("update").foreachBatch(lambda b, n: seen.append([r["decision"] for r in b.collect()])).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert [x for b in seen for x in b][-1] == "edit" and all(len(b) <= 1 for b in seen)
