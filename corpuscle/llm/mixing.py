"""Mixing sources to target weights by token budgets.

Every row gets a hash-random key.  Rows are ranged by key within each source, in ranges of about ROWS_PER_RANGE rows whose
bounds follow from the row counts (the keys are uniform, so nothing is sampled), and sorted within a range.  Prefix sums of
token counts are the running sum within a range plus the sums of the source's ranges before it.  The last row that fits a
source's budget is its cut; texts are then read once more and kept by comparing their key with the cut: they are never
shuffled, only their keys and counts are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.llm.common import BROADCAST_ROWS, col, fresh, row_hash, sized, written

ROWS_PER_RANGE = 1_000_000
_KEY_BITS = 60


def random_key(id_: Column, seed: int) -> Column:
    """A key uniform over 60 bits: the first 15 hex digits of an MD5, which other engines can compute as well."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), id_.cast("string"))), 1, 15), 16, 10).cast("long")


def token_count(text: Column) -> Column:
    """Runs of characters that aren't white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def plan(
    docs: DataFrame, weights: dict[str, int] | None = None, budget: int | None = None, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Per source (source, source_tokens, budget, epochs, cut): whole epochs to repeat and the last (key, tie) of the part epoch."""
    rows = written(
        docs.select(col(source_col).alias("source"), random_key(col(id_col), seed).alias("key"), row_hash(docs).alias("tie"), token_count(col(text_col)).alias("n"))
    )
    total = rows.groupBy("source").agg(F.count("*").alias("rows"), F.sum("n").alias("source_tokens"))
    if weights is None:
        weight = F.floor(F.sqrt("source_tokens")).cast("decimal(19,0)")
    else:
        pairs = [F.lit(x) for kv in weights.items() for x in kv]
        weight = F.coalesce(F.create_map(*pairs)[F.col("source")] if pairs else F.lit(0), F.lit(0)).cast("decimal(19,0)")
    total = total.withColumn("w", weight)
    whole = total.agg(F.sum("source_tokens").cast("decimal(19,0)").alias("all_tokens"), F.sum("w").cast("decimal(19,0)").alias("all_w"))
    to_give = F.col("all_tokens") if budget is None else F.lit(budget).cast("decimal(19,0)")
    total = total.crossJoin(F.broadcast(whole)).withColumn("budget", F.when(F.col("all_w") > 0, F.expr("w") * to_give).otherwise(F.lit(0)))
    total = total.withColumn("budget", F.expr("case when all_w > 0 then budget div all_w else 0 end").cast("long"))
    total = total.withColumn("epochs", F.when(F.col("source_tokens") > 0, F.expr("budget div source_tokens")).otherwise(F.lit(0)).cast("long"))
    total = written(total.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_tokens")).select("source", "rows", "source_tokens", "budget", "epochs", "rest"))

    small = sized(total.select(F.col("source").alias("s"), (F.col("rows") / rows_per_range + 1).cast("long").alias("ranges")))
    ranged = rows.join(small, rows.source.eqNullSafe(F.col("s"))).withColumn("part", F.floor(F.col("key") / F.lit(float(1 << _KEY_BITS)) * F.col("ranges")))
    # rows that tie in everything count together, as the default frame includes peers: all of them fit or none
    inside = ranged.withColumn("run", F.sum("n").over(Window.partitionBy("source", "part").orderBy("key", "tie")))
    part = ranged.groupBy("source", "part").agg(F.sum("n").alias("sum"))
    before = part.withColumn("before", F.sum("sum").over(Window.partitionBy("source").orderBy("part")) - F.col("sum"))
    offset = before.join(total, before.source.eqNullSafe(total.source)).select(before.source.alias("s2"), F.col("part").alias("p2"), "before", "rest")
    offset = sized(written(offset))
    fits = inside.join(offset, F.col("source").eqNullSafe(F.col("s2")) & (F.col("part") == F.col("p2"))).where("before + run <= rest")
    cut = fits.groupBy(F.col("source").alias("s3")).agg(F.max(F.struct("key", "tie")).alias("cut"))
    return written(total.join(cut, total.source.eqNullSafe(F.col("s3")), "left").select("source", "source_tokens", "budget", "epochs", "cut"))


def mixed(
    docs: DataFrame, weights: dict[str, int] | None = None, budget: int | None = None, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    rows_per_range: int = ROWS_PER_RANGE, broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The rows of docs, all columns as they were, and `epoch` from 1: each source's rows up to its token budget.

    A source's budget is its weight's share of `budget`, rounded down; by default weights are the roots of the sources'
    token counts and the budget is all tokens.  A source smaller than its budget is repeated in whole epochs, then its rows
    follow in the order of their random keys while they fit: the budget is never exceeded, and misses it by less than the
    first row left out.  Texts are never cut.

    A null source is a source of its own (of weight 0 if weights are given, as is any source not named); null and empty texts
    count 0 tokens; rows equal in all columns are taken together or not at all; a source without tokens gives the rows that
    fit a budget of 0.  If docs has a column `epoch`, the new one is `epoch_`.  An empty table gives no rows.
    """
    cuts = plan(docs, weights, budget, seed, id_col, text_col, source_col, rows_per_range)
    s, cut, epochs, tie, epoch = fresh(docs, "cut_source", "cut_at", "cut_epochs", "row_tie", "epoch")
    cuts = sized(cuts.select(F.col("source").alias(s), F.col("cut").alias(cut), F.col("epochs").alias(epochs)), broadcast_rows)
    rows = docs.withColumn(tie, F.struct(random_key(col(id_col), seed).alias("key"), row_hash(docs).alias("tie")))
    rows = rows.join(cuts, col(source_col).eqNullSafe(F.col(s)))
    copies = F.col(epochs) + F.when(F.col(tie) <= F.col(cut), F.lit(1)).otherwise(F.lit(0))
    return rows.where(copies > 0).select(*[col(c) for c in docs.columns], F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias(epoch))
