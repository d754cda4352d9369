"""Line deduplication over overlapping windows of three lines.

Every three consecutive lines of a text are a window, named by two 64-bit hashes of its lines' hashes.  Of each window that
occurs more than once, the first occurrence stays; the positions that later ones cover are merged, and a text loses the
lines at covered positions.  Only hashes and places are shuffled to find them, and those of repeated windows alone go back
to the texts, which are exchanged once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.llm.common import fresh, row_hash, written

LINES = 3


def _windows(text: Column) -> Column:
    """Per window of a text (a, b, pos); windows of blank lines only are left out."""
    # 63 bits of a line's hash, and whether it is blank as the last
    lines = F.transform(F.split(text, "\n", -1), lambda x: F.xxhash64(x).bitwiseAND(F.lit(-2)) + F.when(F.trim(x) == "", F.lit(1)).otherwise(F.lit(0)))

    def all_of(hashes: Column) -> Column:
        last = F.size(hashes) - LINES

        def window(p: Column) -> Column:
            h = [F.get(hashes, p + i) for i in range(LINES)]
            blank = h[0].bitwiseAND(h[1]).bitwiseAND(h[2]).bitwiseAND(F.lit(1))
            return F.when(blank == 0, F.struct(F.xxhash64(*h).alias("a"), F.xxhash64(*h[::-1], F.lit("b")).alias("b"), p.alias("pos")))

        return F.when(last >= 0, F.filter(F.transform(F.sequence(F.lit(0), last), window), lambda w: w.isNotNull()))

    # bound to a variable, as an inner lambda would split and hash the whole text again for every window
    return F.get(F.transform(F.array(lines), all_of), F.lit(0))


def _cut(texts: pd.Series, positions: pd.Series, repeated: pd.Series) -> pd.Series:
    """The texts without the lines that windows at these positions cover; of a repeated row, without all windows."""
    out = []
    for text, where, again in zip(texts, positions, repeated, strict=True):
        if text is None:
            out.append(None)
            continue
        lines = text.split("\n")
        if again:
            blank = np.array([not x.strip(" ") for x in lines])
            n = len(lines) - LINES + 1
            where = np.flatnonzero(~np.logical_and.reduce([blank[i : i + n] for i in range(LINES)])) if n > 0 else []
        covered = np.zeros(len(lines) + LINES, np.int64)
        np.add.at(covered, np.asarray(where, np.int64), 1)
        np.add.at(covered, np.asarray(where, np.int64) + LINES, -1)
        gone = np.cumsum(covered)[: len(lines)] > 0
        out.append("\n".join([x for x, g in zip(lines, gone.tolist(), strict=True) if not g]))
    return pd.Series(out, dtype=object)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows of docs in which each text has lost the lines of windows that occur earlier.

    Occurrences are ordered by id, nulls last, then by a hash of the row, then by position.  Lines are what "\\n" separates and
    are compared as they are; windows of three blank lines don't count.  A text of fewer than three lines, empty or null stays
    as it is; a text whose lines all go becomes empty.  Of rows equal in all columns the first is the earlier one.  Overlapping
    windows of one text count as occurrences too.  Other columns pass through; an empty table gives no rows.
    """
    key, key2, pos, again, new = fresh(docs, "row_key", "row_key2", "row_windows", "row_again", "row_text")
    text = F.col(f"`{text_col}`")
    rows = docs.withColumn(key, row_hash(docs)).withColumn(key2, F.xxhash64(F.lit("row"), F.col(key), text))
    found = rows.select(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(key).alias("k"), F.col(key2).alias("k2"), F.explode(_windows(text)).alias("w"))
    found = written(found.select("none", "id", "k", "k2", "w.*"))
    place = F.struct("none", "id", "k", "k2", "pos")
    # the first place of each window is found with partial sums in every task, so a window that is everywhere doesn't hurt
    first = found.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    later = found.join(first, ["a", "b"]).where(~place.eqNullSafe(F.col("first")))
    cover = later.groupBy(F.col("k").alias(key), F.col("k2").alias(key2)).agg(F.collect_set("pos").alias(pos))
    both = rows.join(cover, [key, key2], "left")
    both = both.withColumn(again, F.row_number().over(Window.partitionBy(key, key2).orderBy(F.lit(1))) > 1)
    change = F.col(pos).isNotNull() | F.col(again)
    cut = F.pandas_udf(_cut, "string")
    # only texts that change go to Python
    both = both.withColumn(new, cut(F.when(change, text), F.coalesce(F.col(pos), F.array().cast("array<int>")), F.col(again)))
    return both.select(*[(F.when(change, F.col(new)).otherwise(text).alias(c) if c == text_col else F.col(f"`{c}`")) for c in docs.columns])
