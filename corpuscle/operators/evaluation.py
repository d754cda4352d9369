"""Evaluation against labelled cases, threshold sweeps, and the sampling of cases to label."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.functions.phrases import candidate_phrases
from corpuscle.functions.text import all_folded, compact, context, normalise_lexical, normalized
from corpuscle.operators.common import cut, first_by, ordered_pair, small, top_by

SWEEP = {"w_lexical": [0.4, 0.5, 0.6], "duplicate": [0.85, 0.90, 0.95], "clause_reuse": [0.50, 0.60, 0.70], "translation": [0.75, 0.80, 0.85], "weak_link": [0.60, 0.65, 0.70]}
BANDS = {"low": (0.0, 0.40), "medium": (0.40, 0.60), "high": (0.60, 0.80), "very_high": (0.80, 1.01)}


def grid(spark, values: dict[str, list[float]] | None = None) -> DataFrame:  # noqa: ANN001
    """(config, thresholds): all settings in which clause reuse lies under duplicates and weak links under translations."""
    v = SWEEP if values is None else values
    rows = [r for r in product(*v.values()) if r[2] < r[1] and r[4] < r[3]]
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rows)], "config int, " + ", ".join(f"{k} double" for k in v))


def scored_cases(cases: DataFrame, scores: DataFrame, chunks: DataFrame) -> DataFrame:
    """Cases with the scores of their pair and whether their languages differ; what is missing has 0 and no language."""
    bad = F.raise_error(F.concat("case_id", F.lit(": a label is positive, negative or exclude"))).cast("string")
    label = F.when(F.col("label").isin("positive", "negative", "exclude"), F.col("label")).otherwise(bad)
    lang = chunks.select("chunk_id", "language")
    rows = ordered_pair(cases.withColumn("label", label)).join(ordered_pair(scores).withColumn("known", F.lit(True)), ["src", "dst"], "left")
    rows = rows.join(lang.select(F.col("chunk_id").alias("src"), F.col("language").alias("l1")), "src", "left").join(lang.select(F.col("chunk_id").alias("dst"), F.col("language").alias("l2")), "dst", "left")
    apart = (F.size("l1") > 0) & (F.size("l2") > 0) & ~F.arrays_overlap("l1", "l2")
    return rows.select("case_id", "label", "expected_type", F.coalesce("lexical", F.lit(0.0)).alias("lexical"), F.coalesce("semantic", F.lit(0.0)).alias("semantic"), F.coalesce("known", F.lit(False)).alias("known"), F.coalesce(apart, F.lit(False)).alias("apart"))


def predictions(cases: DataFrame, configs: DataFrame) -> DataFrame:
    """Every case under every setting with the predicted type."""
    kind = (
        F.when(F.col("lexical") >= F.col("duplicate"), "duplicate").when(F.col("lexical") >= F.col("clause_reuse"), "clause_reuse")
        .when((F.col("semantic") >= F.col("translation")) & F.col("apart"), "translation").when(F.col("semantic") >= F.col("translation"), "semantic_kin")
        .when(F.col("semantic") >= F.col("weak_link"), "weak_link")
    )
    return cases.where("label <> 'exclude'").crossJoin(small(configs)).withColumn("predicted", kind)


def _counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    n = lambda when: F.sum(F.when(when, 1).otherwise(0))
    some = F.col("predicted").isNotNull()
    pos = F.col("label") == "positive"
    hit = F.coalesce(F.col("predicted") == F.col("expected_type"), F.lit(False)) | (F.coalesce("expected_type", F.lit("")) == "any")
    out = rows.groupBy(*keys).agg(n(pos & hit).alias("tp"), n(some & (~pos | ~hit)).alias("fp"), n(pos & ~hit).alias("fn"), n(~pos & ~some).alias("tn"), n(~F.col("known")).alias("missing_pairs"))
    share = lambda a, b: F.when(a + b > 0, a / (a + b)).otherwise(F.lit(0.0))
    p, r = share(F.col("tp"), F.col("fp")), share(F.col("tp"), F.col("fn"))
    f1 = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return out.select("*", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(f1, 6).alias("f1"))


def confusion(cases: DataFrame, configs: DataFrame) -> DataFrame:
    """Per setting tp, fp, fn, tn, missing pairs, precision, recall and F1.

    A positive of another type than expected is both a false negative and, unless nothing is predicted, a false positive; the
    expected type "any" takes every prediction, none included.
    """
    return _counts(predictions(cases, configs), ["config"])


def by_type(cases: DataFrame, configs: DataFrame) -> DataFrame:
    """Counts by setting and type: hits and misses under the expected type, false alarms under the predicted one."""
    rows = predictions(cases, configs)
    pos = F.col("label") == "positive"
    hit = pos & (F.coalesce(F.col("predicted") == F.col("expected_type"), F.lit(False)) | (F.coalesce("expected_type", F.lit("")) == "any"))
    item = lambda when, t, what: F.when(when, F.struct(t.alias("type"), F.lit(what).alias("outcome")))
    outcomes = F.array_compact(F.array(
        item(hit, F.col("expected_type"), "tp"), item(pos & ~hit, F.coalesce("expected_type", F.lit("None")), "fn"), item(~hit & F.col("predicted").isNotNull(), F.col("predicted"), "fp"),
        item(~pos & F.col("predicted").isNull(), F.lit("negative"), "tn"),
    ))
    return rows.select("config", F.inline(outcomes)).groupBy("config", "type", "outcome").agg(F.count("*").alias("n"))


def sweep(cases: DataFrame, configs: DataFrame) -> DataFrame:
    """The setting of highest F1, then precision, then recall, then the first; one row."""
    best = F.max_by(F.struct("config", "precision", "recall", "f1", "tp", "fp", "fn", "tn"), F.struct("f1", "precision", "recall", -F.col("config")))
    return confusion(cases, configs).agg(best.alias("b")).where("b is not null").select("b.*")


def benchmark_checks(results: DataFrame) -> DataFrame:
    """Results with `passed` per check and over all: absent checks pass.  Texts and what they contain are case-folded, so "ß" is "ss".

    results has text, scripts, method, review and the checks min_chars, contains, script, method_prefix, review_required.
    """
    tests = {
        "chars_ok": F.length("text") >= F.col("min_chars"), "contains_ok": F.forall("__contains", lambda x: F.contains("__text", x)),
        "script_ok": F.array_contains("scripts", F.col("script")), "method_ok": F.col("method").startswith(F.col("method_prefix")), "review_ok": F.col("review") == F.col("review_required"),
    }
    folded = results.withColumns({"__text": normalized("text"), "__contains": all_folded("contains")})
    out = folded.withColumns({k: F.coalesce(v, F.lit(True)) for k, v in tests.items()}).drop("__text", "__contains")
    passed = F.lit(True)
    for k in tests:
        passed = passed & F.col(k)
    return out.withColumn("passed", passed)


def representative_chunks(chunks: DataFrame, least: int = 160) -> DataFrame:
    """Of each document the chunk of best quality among those long enough, then the first."""
    long = chunks.where(F.length(compact(F.col("text"))) >= least)
    return first_by(long, ["document_id"], F.coalesce("quality_score", F.lit(0.0)).desc(), "page_number", "chunk_index", "chunk_id")


def shuffle_key(seed: int, *columns: str) -> Column:
    """A reproducible random order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *columns))


def band_sample(edges: DataFrame, docs: DataFrame, per_band: int, seed: int = 0, bands: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Up to per_band edges of each score band between two documents, in random order; a pair of documents once over all bands.

    docs has chunk_id and document_id.  Bands are drawn in their order, each without the pairs of those before.
    """
    of = lambda c, a: docs.select(F.col("chunk_id").alias(c), F.col("document_id").alias(a))
    rows = ordered_pair(edges.join(of("src", "d1"), "src").join(of("dst", "d2"), "dst").where("d1 <> d2"), "d1", "d2")
    out, used = None, None
    for name, (low, high) in (BANDS if bands is None else bands).items():
        mine = rows.where((F.col("combined") >= low) & (F.col("combined") < high)).withColumn("band", F.lit(name)).withColumn("k", shuffle_key(seed, "src", "dst"))
        if used is not None:
            mine = mine.join(used, ["d1", "d2"], "left_anti")
        one = first_by(mine, ["d1", "d2"], "k", "src", "dst")
        drawn = cut(top_by(one, ["band"], per_band, "k", "src", "dst", rank="place"))
        out = drawn if out is None else out.unionByName(drawn)
        used = drawn.select("d1", "d2") if used is None else used.unionByName(drawn.select("d1", "d2"))
    return out.drop("k")


def band_counts(sample: DataFrame) -> DataFrame:
    return sample.groupBy("band").agg(F.count("*").alias("n"))


def no_edge_negatives(reps: DataFrame, edges: DataFrame, count: int, seed: int = 0) -> DataFrame:
    """`count` random pairs of representatives of the same type and century label whose chunks have no edge.

    Each document meets the next three in a random order within its group; while too few of these pairs are free, it meets twice
    as many further ones, until there are enough or every pair of each group has been seen.
    """
    group = F.concat(F.floor(F.col("year") / 100).cast("string"), F.lit("xx"))
    rows = reps.select("document_id", "chunk_id", F.coalesce("doc_type", F.lit("Inconnu")).alias("t"), F.coalesce(group, F.lit("unknown")).alias("g"))
    w = Window.partitionBy("t", "g").orderBy(shuffle_key(seed, "document_id"), "document_id", "chunk_id")
    rows = cut(rows.withColumn("at", F.row_number().over(w)))
    last = (rows.agg(F.max("at")).first()[0] or 0) - 1
    known = cut(ordered_pair(edges).select("src", "dst").distinct())
    other = rows.select("t", "g", F.col("document_id").alias("d2"), F.col("chunk_id").alias("c2"), "at")
    free, low, high = None, 1, 3
    while True:
        near = rows.select("t", "g", F.col("document_id").alias("d1"), "chunk_id", F.explode(F.sequence(F.col("at") + low, F.col("at") + high)).alias("at"))
        pairs = near.join(other, ["t", "g", "at"]).select("t", "g", "d1", "d2", F.least("chunk_id", "c2").alias("src"), F.greatest("chunk_id", "c2").alias("dst"))
        more = cut(pairs.join(known, ["src", "dst"], "left_anti"))
        free = more if free is None else free.unionByName(more)
        if high >= last or free.count() >= count:
            break
        low, high = high + 1, min(last, high + 2 * (high - low + 1))
    return free.orderBy(shuffle_key(seed, "src", "dst"), "src", "dst").limit(count)


def mine_phrases(pages: DataFrame, known: DataFrame, least: int = 8, top: int = 300, chars: int = 90) -> DataFrame:
    """The most frequent capitalised phrases that no dictionary name covers: display form, counts, sample documents, examples.

    pages has document_id, page_number and text; known has surface.
    """
    rows = pages.select("document_id", "page_number", "text", F.inline(candidate_phrases(F.col("text"))))
    around = context(F.col("text"), F.col("char_start"), F.col("char_end"), chars)
    rows = rows.select("document_id", "phrase", "key", F.struct("document_id", "page_number", "char_start", around.alias("around")).alias("example"))
    rows = rows.join(known.select(normalise_lexical("surface").alias("key")).distinct(), "key", "left_anti")
    forms = rows.groupBy("key", "phrase").agg(F.count("*").alias("n"), F.min("example").alias("first"))
    shown = forms.groupBy("key").agg(F.sum("n").alias("count"), F.min_by("phrase", F.struct(-F.col("n"), "first", "phrase")).alias("label")).where(F.col("count") >= least)
    shown = shown.orderBy(F.desc("count"), "key").limit(top)
    some = rows.join(small(shown.select("key")), "key", "left_semi")
    w = Window.partitionBy("key").orderBy("example")
    examples = some.withColumn("rn", F.row_number().over(w)).groupBy("key").agg(
        F.array_join(F.slice(F.array_sort(F.collect_set("document_id")), 1, 8), "|").alias("sample_documents"), F.countDistinct("document_id").alias("document_count"),
        F.sort_array(F.collect_list(F.when(F.col("rn") <= 3, F.col("example")))).alias("e"),
    )
    return shown.join(examples, "key").select("label", "key", "count", "document_count", "sample_documents", F.transform("e", lambda x: x["around"]).alias("examples"))

