"""Quality of a transcription as Column arithmetic over counts that regular expressions give."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"([\p{L}\p{Nl}\p{No}]+(?:['’\-][\p{L}\p{Nl}\p{No}]+)*)"
NOISE = "�|¦¬~`^¤■□◆◇◊※"
#: Weights of the score's parts.
WEIGHTS = {"confidence": 0.36, "printable": 0.20, "alnum": 0.14, "token": 0.14, "noise": 0.10, "length": 0.06}


def _without(text: Column, pattern: str) -> Column:
    """How many characters a pattern of one character matches, which is applied to whole runs of them."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern + "++", ""))


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f names it and into whatever filter or branch the whole is moved."""
    return F.transform(F.array(value), f)[0]


def metrics(text: Column) -> Column:
    """char_count, word_count, the four ratios and the counts of replacement and private-use characters."""
    x = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|(?<!\s)\s+$", "")
    words = lambda t: F.regexp_extract_all(t, F.lit(WORD), F.lit(1))
    isolated = lambda w: F.size(F.filter(w, lambda y: F.length(y) <= 1))
    counted = lambda t: let(words(t), lambda w: F.struct(F.length(t).alias("n"), F.size(w).alias("words"), isolated(w).alias("isolated")))
    return let(x, lambda t: let(counted(t), lambda c: _metrics(t, c["n"], c["words"], c["isolated"])))


def _metrics(x: Column, n: Column, words: Column, isolated: Column) -> Column:
    ratio = lambda count, blank: F.when(n == 0, F.lit(blank)).otherwise(count / n)
    return F.struct(
        n.alias("char_count"),
        words.alias("word_count"),
        ratio(n - _without(x, r"[\p{C}\p{Z}&&[^ \n\t]]"), 0.0).alias("printable_ratio"),
        ratio(_without(x, r"[\p{L}\p{N}]"), 0.0).alias("alnum_ratio"),
        F.when(n == 0, F.lit(1.0)).otherwise(isolated / F.greatest(words, F.lit(1))).alias("isolated_word_ratio"),
        ratio(_without(x, "[" + NOISE.replace("^", r"\^") + "]"), 1.0).alias("noise_ratio"),
        _without(x, "�").alias("replacement_count"),
        _without(x, r"\p{Co}").alias("private_use_count"),
    )


def score(m: Column, confidence: Column) -> Column:
    """A reading's score in [0, 1]; a blank one has 0.  m is what metrics() gives."""
    return let(F.struct(m.alias("m"), confidence.alias("c")), lambda x: _score(x["m"], x["c"]))


def _score(m: Column, confidence: Column) -> Column:
    above = lambda x: F.greatest(F.lit(0.0), x)
    parts = {
        "confidence": F.least(F.lit(1.0), above(confidence)),
        "printable": m["printable_ratio"],
        "alnum": above(1 - F.abs(m["alnum_ratio"] - 0.72) / 0.72),
        "token": above(1 - m["isolated_word_ratio"] * 2.5),
        "noise": above(1 - m["noise_ratio"] * 20),
        "length": F.least(F.lit(1.0), F.log(1 + m["char_count"]) / math.log(41)),
    }
    total = sum((F.lit(w) * parts[k] for k, w in WEIGHTS.items()), F.lit(0.0))
    total = total - F.least(F.lit(0.35), m["replacement_count"] * 0.04 + m["private_use_count"] * 0.01)
    return F.when(m["char_count"] == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), above(total)))


def native_is_credible(m: Column, score_: Column) -> Column:
    """Whether embedded text can stand without recognition."""
    clean = (m["replacement_count"] + m["private_use_count"] == 0) & (m["noise_ratio"] <= 0.01) & (m["printable_ratio"] >= 0.98)
    return clean & (m["char_count"] >= 3) & (score_ >= 0.82)


def review_reasons(quality: Column, agreement: Column, length_ratio: Column, ink: Column, chars: Column, noise: Column, n_scripts: Column, year: Column) -> Column:
    """Why a page needs review, in a fixed order; empty if it doesn't."""
    test = {
        "low_confidence": quality < 0.85,
        "engine_disagreement": (agreement < 0.55) & ((length_ratio >= 0.55) | (quality < 0.90)),
        "no_text_with_visible_ink": (ink > 0.01) & (chars < 10),
        "sparse_text_with_visible_ink": (ink > 0.04) & (chars < 80) & (quality < 0.90),
        "unexpected_characters": noise > 0.02,
        "mixed_scripts": n_scripts >= 3,
        "historical_disagreement": (year < 1930) & (agreement < 0.65),
    }
    return F.array_compact(F.array(*[F.when(when, F.lit(name)) for name, when in test.items()]))


def review_priority(reasons: Column, quality: Column) -> Column:
    high = (quality < 0.65) | F.array_contains(reasons, "no_text_with_visible_ink")
    return F.when(F.size(reasons) == 0, "none").when(high, "high").otherwise("normal")
