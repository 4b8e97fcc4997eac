"""Mixing sources to target weights (operator 11, native): DataFrame functions
only, and no sort of documents.

A budget of words is shared over the sources by weight. No source is taken more
than ``most`` times over: what is above goes to the others by weight, again and
again. A document's copies follow from nested thresholds on one hash: the first
copy of everything below the first threshold, the second one of what is below the
second, and so on; all but one of a source's thresholds are trivial (all, or
none). The one inside is found by histograms: words are summed by source and hash
bucket (the first 12 bits of the hash), the bucket in which the budget ends is
cut by the next 12 bits, and so on until it holds one document; only rows of that
bucket are counted again. Documents are then filtered by comparing their hash with
the threshold. The last document is taken if that brings the source nearer to its
target, so a source is off by half a document at most.

The hash is 60 bits of an MD5 of id and text, so neither the layout of the rows
nor a rerun changes the mix. A source may hold any share of the rows: its
histogram has 4,096 rows at most, summed before the shuffle. Tables by source are
Spark tables like others and never on the driver; the sharing loop brings three
numbers a round to it.

Odd input: a null or empty text has no words and is never taken; a null source is
a source like others, the last in order; rows with equal (or null) ids are rows of
their own; rows equal in id and text are tied at every threshold, then as many of
the copies as the budget wants are taken (which ones makes no difference; they
are counted first and dealt out again in blocks). A table without rows or words
gives targets of 0. Other columns are pruned, or carried in ``keep`` under their
names; names that the result has too are refused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import materialize, unpacked

WORD = r"[^\x20\x09-\x0D]+"
BITS, STEP = 60, 12
BLOCK = 4096  # copies of one row that are dealt out together
RESULT = ("doc_id", "source", "size", "source_size", "target", "copies", "taken")

c = F.col


def sized(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, h) of every row: its words and its hash."""
    if clash := sorted({*keep} & {*RESULT}):
        raise ValueError(f"columns {clash} are in the result already")
    text = F.coalesce(c(text_col).cast("string"), F.lit(""))
    kept = [F.struct(*[c(x) for x in keep]).alias("_with")] if keep else []
    rows = df.select(c(id_col).cast("long").alias("doc_id"), c(source_col).cast("string").alias("source"), text.alias("_t"), *kept)
    name = F.concat_ws(":", F.coalesce(c("doc_id").cast("string"), F.lit("")), F.md5("_t"))
    h = F.conv(F.substring(F.md5(name), 1, BITS // 4), 16, 10).cast("long")
    return rows.select("doc_id", "source", F.regexp_count("_t", F.lit(WORD)).cast("long").alias("size"), h.alias("h"), *["_with"] * bool(keep))


def in_order(sources: DataFrame) -> DataFrame:
    """``sources`` (one row each) with ``rank``, from 0 by code point, null last:
    ranges are sorted side by side and numbered on from the rows before them."""
    n = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [c("source").isNull(), c("source")]
    ranged = sources.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    ranged = materialize(ranged.withColumns({"_p": F.spark_partition_id(), "_i": F.monotonically_increasing_id()}), "mix-sources")
    earlier = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_first"))
    starts = starts.select("_p", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - c("_first")).alias("_shift"))
    return ranged.join(starts, "_p").withColumn("rank", c("_i") + c("_shift")).drop("_p", "_i", "_shift")


def targets(sources: DataFrame, weights: tuple[int, ...], budget: float, most: int) -> DataFrame:
    """``sources`` (source, source_size) with ``target``: shares by weight of
    ``budget`` times all words, none above ``most`` times its source."""
    pattern = F.array(*[F.lit(w) for w in weights])
    ranked = in_order(sources).withColumn("_w", F.element_at(pattern, (c("rank") % len(weights) + 1).cast("int")).cast("long"))
    ranked = materialize(ranked.withColumn("_cap", most * c("source_size")).drop("rank"), "mix-weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    share, n_capped = 0.0, -1
    while True:  # a round for each step in which some source comes to its cap
        above = c("_w") * F.lit(share) > c("_cap").cast("double")
        n, capped, weight = ranked.agg(F.sum(above.cast("long")), F.sum(F.when(above, c("_cap"))), F.sum(F.when(~above, c("_w")))).first()
        if n is None or n == n_capped or not weight:
            break
        n_capped, share = n, (budget * total - (capped or 0)) / weight
    return ranked.select("source", "source_size", F.least(c("_w") * F.lit(share), c("_cap").cast("double")).alias("target"))


def _same(a: str, b: str) -> Column:
    return c(f"{a}.source").eqNullSafe(c(f"{b}.source"))


def _boundary(histogram: DataFrame) -> DataFrame:
    """The bucket of each source in which its budget ends. ``histogram``: rows
    (source, rest, base, bucket, words, n), ``base`` the words before all of them."""
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = histogram.withColumn("before", c("base") + F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    inside = (c("before") <= c("rest")) & (c("rest") < c("before") + c("words"))
    return before.filter(inside).select("source", "rest", c("bucket").alias("edge"), "before", "n")


def mix(
    df: DataFrame, weights: tuple[int, ...] = (5, 2, 1), budget: float = 1.5, most: int = 2, id_col: str = "doc_id",
    text_col: str = "text", source_col: str = "source", keep: tuple[str, ...] = (),
) -> DataFrame:
    """Every document with its source's words and target, how many ``copies`` the
    mix takes of it, and the words of these (``taken``)."""
    docs = materialize(sized(df, id_col, text_col, source_col, keep), "mix-sized")
    shift = BITS - STEP
    words = docs.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
    words = materialize(words, "mix-histogram")
    plan = targets(words.groupBy("source").agg(F.sum("words").alias("source_size")), weights, budget, most)
    full = F.when(c("source_size") > 0, F.least(F.floor(c("target") / c("source_size")), F.lit(most))).otherwise(0).cast("long")
    plan = plan.withColumn("full", full).withColumn("rest", c("target") - c("full") * c("source_size"))
    plan = materialize(plan, "mix-targets")
    start = words.alias("x").join(plan.alias("p"), _same("x", "p")).select("x.*", "p.rest", F.lit(0).cast("long").alias("base"))
    edges = materialize(_boundary(start), "mix-edges")
    several = lambda: edges.filter("n > 1").limit(1).count() > 0
    tied = several()
    while tied and shift > 0:
        inside = docs.alias("x").join(edges.alias("p"), _same("x", "p") & (F.shiftright("x.h", shift) == c("p.edge")))
        shift -= STEP
        finer = inside.groupBy("x.source", "p.rest", "p.before", F.shiftright("x.h", shift).alias("bucket"))
        finer = finer.agg(F.sum("x.size").alias("words"), F.count(F.lit(1)).alias("n")).withColumnRenamed("before", "base")
        edges = materialize(_boundary(finer), "mix-edges")
        tied = several()
    edge = edges.select(c("source").alias("_s"), "edge", "before", "n")
    plan = plan.join(edge, c("source").eqNullSafe(c("_s")), "left").drop("_s")
    rows = docs.alias("x").join(plan.alias("p"), _same("x", "p")).drop(c("p.source"))
    place = F.shiftright("h", shift)

    def nearer(before: Column) -> Column:
        """Taking the row leaves its source at least as near to its target."""
        return (2 * before + c("size")).cast("double") <= 2 * c("rest")

    more = F.when(place < c("edge"), 1).when((place == c("edge")) & nearer(c("before")), 1).otherwise(0)
    edge_ties = (place == c("edge")) & (c("n") > 1)
    rows = rows.withColumn("_more", more)
    if tied:  # rows equal in id and text, at the very threshold
        others = rows.filter(~F.coalesce(edge_ties, F.lit(False)))
        rows = others.unionByName(_among_equals(rows.filter(edge_ties).drop("_more"), nearer))
    copies = F.when(c("size") > 0, F.least(c("full") + c("_more"), F.lit(most))).otherwise(0).cast("long")
    rows = rows.withColumn("copies", copies).withColumn("taken", c("copies") * c("size"))
    return unpacked(rows.select(*RESULT, *["_with"] * bool(keep)))


def _among_equals(rows: DataFrame, nearer) -> DataFrame:
    """Rows tied at their source's threshold with ``_more``: equal ones are counted,
    numbered on from group to group, and dealt out again in blocks."""
    columns = rows.columns
    groups = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_c"))
    order = ["size", c("doc_id").asc_nulls_first()]
    earlier = Window.partitionBy("source").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("_start", c("before") + F.coalesce(F.sum(c("_c") * c("size")).over(earlier), F.lit(0)))
    blocks = groups.withColumn("_k", F.explode(F.expr(f"sequence(0L, (_c - 1) div {BLOCK})"))).repartition("_k", "doc_id", "source")
    each = blocks.withColumn("_i", F.explode(F.expr(f"sequence(_k * {BLOCK}, least(_c, (_k + 1) * {BLOCK}) - 1)")))
    return each.withColumn("_more", F.when(nearer(c("_start") + c("_i") * c("size")), 1).otherwise(0)).select(*columns, "_more")


def mixed(rows: DataFrame) -> DataFrame:
    """The mix itself: each row of ``mix`` as often as it has copies, with ``copy``
    from 1 on; rows that are not taken go."""
    return rows.filter("copies > 0").withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
