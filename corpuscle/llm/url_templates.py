"""URL filtering by a tree of path templates.

Per host, the paths' segments form a tree.  Segments that look variable (numbers, hashes, dates) become wildcards at once.
Then level by level, children of a node whose labelled purity doesn't differ significantly from that of their siblings
together, or that are too few to tell, are merged into one wildcard branch; the others keep their name.  A template's purity
is the smoothed share of good labels among its pages; templates under a threshold are rejected.

Pages are first reduced to their distinct shapes with counts, so a level costs a few shuffles of what is left of a host's
paths, never of pages; a host with very many paths is spread by node, not gathered in one task.  Stretches without a branch
take one step however long they are: a node's paths go together to where the first of them turns off, and what goes on without
turning off is finished.  So is a node with too few labels for any branch below it to be told from its siblings: there each
segment that all paths share keeps its name and the others are wildcards.  Rounds are thus as many as the branches that have
enough labels, one below the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.llm.common import col, sized, written

#: Labelled pages that a branch needs to be told from its siblings.
MIN_LABELLED = 8
#: Standard deviations by which a branch's purity must differ from its siblings'.
Z = 2.58
#: Pages' weight that the overall purity has in a template's.
PRIOR = 4.0
THRESHOLD = 0.5
WILDCARD = "*"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def segments(url: Column) -> Column:
    """The path's segments, obvious variables as {kinds}."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)

    def kind(s: Column) -> Column:
        return (
            F.when(s.rlike(r"^\d+$"), F.lit("{n}"))
            .when(s.rlike(r"^\d{4}-\d{2}(-\d{2})?$"), F.lit("{date}"))
            .when(s.rlike(r"^(?=.*\d)[0-9a-fA-F]{8,}$") | s.rlike(r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"), F.lit("{hash}"))
            .otherwise(s)
        )

    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), kind)


def _shared(a: Column, b: Column) -> Column:
    """How many leading elements two arrays have in common."""
    differ = F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y))
    at = F.array_position(differ, True)
    return F.when(at > 0, at - 1).otherwise(F.size(differ)).cast("int")


def _ahead(todo: DataFrame) -> DataFrame:
    """todo with `same`: how many segments ahead all paths of the node share that turn off somewhere; null if none does.

    A path turns off where it leaves the greatest of the node; one that ends on the way there does not.
    """
    top = sized(written(todo.groupBy(F.col("host").alias("h"), F.col("done").alias("d")).agg(F.max("rest").alias("top"))))
    both = todo.join(top, (F.col("host") == F.col("h")) & (F.col("done") == F.col("d"))).withColumn("shared", _shared(F.col("rest"), F.col("top")))
    both = written(both.drop("h", "d", "top"))
    turn = both.where(F.col("shared") < F.size("rest")).groupBy(F.col("host").alias("h"), F.col("done").alias("d")).agg(F.min("shared").alias("same"))
    return both.join(sized(written(turn)), (F.col("host") == F.col("h")) & (F.col("done") == F.col("d")), "left").drop("h", "d", "shared")


def _unlabelled(todo: DataFrame) -> DataFrame:
    """(host, shape, template) of the paths of nodes below which every branch is merged: all levels at once."""
    each = todo.select("host", "done", "shape", F.posexplode("rest").alias("pos", "seg"))
    level = each.groupBy(F.col("host").alias("h"), F.col("done").alias("d"), F.col("pos").alias("p")).agg(F.min("seg").alias("low"), F.max("seg").alias("high"))
    level = level.select("h", "d", "p", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.lit(WILDCARD)).alias("name"))
    named = each.join(level, (F.col("host") == F.col("h")) & (F.col("done") == F.col("d")) & (F.col("pos") == F.col("p")))
    names = F.transform(F.sort_array(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"])
    return named.groupBy("host", "done", "shape").agg(names.alias("names")).select("host", "shape", F.concat("done", F.lit("/"), F.array_join("names", "/")).alias("template"))


def _branches(todo: DataFrame, min_labelled: int, z: float) -> DataFrame:
    """(h, d, s): the children s of nodes (h, d) that keep their name."""
    child = written(todo.groupBy("host", "done", "seg").agg(F.sum("labelled").alias("l"), F.sum("good").alias("g")))
    node = child.groupBy(F.col("host").alias("h"), F.col("done").alias("d")).agg(F.sum("l").alias("nl"), F.sum("g").alias("ng"), F.count("*").alias("children"))
    both = child.join(node, (F.col("host") == F.col("h")) & (F.col("done") == F.col("d")))
    rest_l, rest_g = F.col("nl") - F.col("l"), F.col("ng") - F.col("g")
    pooled = F.col("ng") / F.col("nl")
    spread = F.sqrt(pooled * (1 - pooled) * (1 / F.col("l") + 1 / rest_l))
    differs = (F.col("l") >= min_labelled) & (rest_l >= min_labelled) & (F.abs(F.col("g") / F.col("l") - rest_g / rest_l) > z * spread)
    own = (F.col("children") == 1) | F.coalesce(F.when((F.col("l") > 0) & (rest_l > 0), differs), F.lit(False))
    return both.where(own).select("h", "d", F.col("seg").alias("s"))


def templates(shapes: DataFrame, min_labelled: int = MIN_LABELLED, z: float = Z) -> DataFrame:
    """(host, shape, template) for rows (host, shape, n, labelled, good), where shape is a path's segments joined by slashes."""
    columns = ("host", "shape", "n", "labelled", "good", "rest", "done")
    todo = shapes.withColumn("rest", F.filter(F.split("shape", "/"), lambda s: s != "")).withColumn("done", F.lit(""))
    todo = written(todo.select(*columns))
    finished = []
    name = lambda segs: F.concat("done", F.when(F.size(segs) > 0, F.concat(F.lit("/"), F.array_join(segs, "/"))).otherwise(F.lit("")))
    while not todo.isEmpty():
        todo = _ahead(todo)
        some = sized(written(todo.groupBy(F.col("host").alias("h"), F.col("done").alias("d")).agg(F.sum("labelled").alias("all")).where(F.col("all") < 2 * min_labelled)))
        here = (F.col("host") == F.col("h")) & (F.col("done") == F.col("d"))
        finished.append(written(_unlabelled(todo.where(F.size("rest") > 0).join(some, here, "left_semi"))))
        todo = written(todo.join(some, here, "left_anti").unionByName(todo.where(F.size("rest") == 0).join(some, here, "left_semi")))
        ends = F.size("rest") <= F.coalesce("same", F.size("rest"))
        finished.append(todo.where(ends).select("host", "shape", name(F.col("rest")).alias("template")))
        todo = todo.where(~ends).withColumn("done", name(F.slice("rest", 1, F.col("same"))))
        todo = written(todo.withColumn("rest", F.expr("slice(rest, same + 1, size(rest) - same)")).withColumn("seg", F.col("rest")[0]))
        kept = sized(written(_branches(todo, min_labelled, z)))
        todo = todo.join(kept, (F.col("host") == F.col("h")) & (F.col("done") == F.col("d")) & (F.col("seg") == F.col("s")), "left")
        todo = todo.withColumn("done", F.concat("done", F.lit("/"), F.coalesce("s", F.lit(WILDCARD)))).withColumn("rest", F.expr("slice(rest, 2, greatest(size(rest) - 1, 0))"))
        todo = written(todo.select(*columns))
    out = shapes.sparkSession.createDataFrame([], "host string, shape string, template string")
    for f in finished:
        out = out.union(f)
    return out


def judged(
    pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", label_id: str = "doc_id", label_col: str = "quality",
    min_labelled: int = MIN_LABELLED, z: float = Z, prior: float = PRIOR, threshold: float = THRESHOLD,
) -> DataFrame:
    """A row (page_id, host, template, labelled, purity, rejected) for every row of pages.

    labels give 1 (good) or 0 for some ids; of an id with several labels the lowest counts, null labels and ids don't.  purity
    is (good + prior x overall purity) / (labelled + prior) over the template's pages; a template is rejected when it is under
    threshold and has a label of its own.  A null url has null host and template and isn't rejected; a url without scheme has
    the empty host; query and fragment don't count; an empty path has the template "".  Repeated rows count each.  Without any
    label the overall purity is taken as 1.  Urls of any length count whole.  Other columns are not read, so their names can't
    clash.  An empty table gives no rows.
    """
    rows = pages.select(col(id_col).alias("page_id"), col(url_col).alias("url"))
    good = labels.where(col(label_col).isNotNull() & col(label_id).isNotNull()).groupBy(col(label_id).alias("label_id")).agg(F.min(col(label_col)).cast("int").alias("good"))
    rows = rows.join(good, rows.page_id == good.label_id, "left").select(
        "page_id", F.coalesce(host(F.col("url")), F.when(F.col("url").isNotNull(), F.lit(""))).alias("host"), F.array_join(segments(F.col("url")), "/").alias("shape"), "good"
    )
    rows = written(rows)
    counts = [F.count("*").alias("n"), F.count("good").alias("labelled"), F.coalesce(F.sum("good"), F.lit(0)).alias("good")]
    shapes = rows.where("host is not null").groupBy("host", "shape").agg(*counts)
    named = templates(shapes, min_labelled, z)
    rows = rows.join(named.select(F.col("host").alias("h"), F.col("shape").alias("s"), "template"), (F.col("host") == F.col("h")) & (F.col("shape") == F.col("s")), "left")
    rows = written(rows.select("page_id", "host", "template", "good"))
    overall = rows.agg(F.coalesce(F.avg("good"), F.lit(1.0)).alias("overall"))
    purity = rows.where("template is not null").groupBy(F.col("host").alias("h"), F.col("template").alias("t")).agg(F.count("good").alias("labelled"), F.coalesce(F.sum("good"), F.lit(0)).alias("g"))
    purity = purity.crossJoin(F.broadcast(overall)).withColumn("purity", (F.col("g") + prior * F.col("overall")) / (F.col("labelled") + prior))
    purity = sized(written(purity.select("h", "t", "labelled", "purity")))
    out = rows.join(purity, (F.col("host") == F.col("h")) & (F.col("template") == F.col("t")), "left")
    return out.select("page_id", "host", "template", F.coalesce("labelled", F.lit(0)).alias("labelled"), "purity", F.coalesce((F.col("purity") < threshold) & (F.col("labelled") > 0), F.lit(False)).alias("rejected"))
