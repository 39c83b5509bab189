"""Mixing sources to target weights.

Words are summed per source, targets follow from the weights, and every document is emitted
``floor(rate)`` times plus one further copy drawn by a hash with the fraction of the rate as
probability (rate = target / words of the source).  The hash covers id, text and, among rows that
are equal in both, a running number: each row draws for itself, however many share an id or a text.

Everything is one scan for the sizes (written narrow, without texts), two aggregations with
map-side sums - a hot source costs one row per task - and a join with one row per source.  Only rows
that are equal in id and text are shuffled to be numbered, by range, so that a group of any size is spread.  Up to
``BROADCAST_SOURCES`` sources (counted) that table is broadcast and no document moves; beyond, it
is an ordinary join that AQE splits when a source holds most rows.  Results are the same.

Defined results: NULL text has size 0; NULL source is a source of its own, ordered last; a NULL id is
an id like any other; very long texts are hashed whole; a source without words has target 0
and its documents are emitted once each with no words (rate 1); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abtforge.llm.ranking import ranked
from abtforge.llm.store import written

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix-1"
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def text_digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target): one row per source.

    Sources by code point, NULL last, take the weights in turn.  A target never exceeds ``cap``
    times its source; the excess is shared again by weight.  The fixed point of that resharing is
    ``min(cap * size, level * weight)``: sources reach their cap in the order of
    ``cap * size / weight``, so the level follows from running sums in that order.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn + 1).cast("int")).cast("long")
    per = per.withColumn("weight", weight).withColumn("limit", F.col("source_size") * cap)
    # limit/weight ascending; the comparison of fractions is done on doubles, ties by name
    fill = Window.orderBy((F.col("limit") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per = (per.withColumn("total", F.sum("source_size").over(everything))
           .withColumn("open_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
           .withColumn("left_over", F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0)))
           .withColumn("open", F.col("left_over") * F.col("weight") <= F.col("limit") * F.col("open_weight")))
    # the first source in fill order that stays under its limit fixes the level for all after it
    per = per.withColumn("n", F.row_number().over(fill))
    first = F.min(F.when(F.col("open"), F.struct("n", "left_over", "open_weight"))).over(everything)
    per = per.withColumn("level", first)
    shared = F.col("level")["left_over"].cast("double") * F.col("weight") / F.col("level")["open_weight"]
    target = F.least(shared, F.col("limit").cast("double"))
    return per.select("source", "source_size", F.coalesce(target, F.col("limit").cast("double")).alias("target"))


def with_turns(rows: DataFrame, broadcast_groups: int = BROADCAST_SOURCES) -> DataFrame:
    """Adds ``turn``: 0, or a running number among rows with equal (doc_id, digest), by source."""
    names = rows.columns
    same = rows.groupBy(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    same = written(same.select("_id", "_digest"), "mix-repeated")
    groups = same.count()
    if not groups:
        return rows.withColumn("turn", F.lit(0).cast("long"))
    if groups <= broadcast_groups:
        same = F.broadcast(same)
    hit = rows["doc_id"].eqNullSafe(same["_id"]) & (rows["digest"] == same["_digest"])
    single = rows.join(same, hit, "left_anti").withColumn("turn", F.lit(0).cast("long"))
    several = rows.join(same, hit, "left_semi").withColumn("_group", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "digest"))
    numbered = ranked(several.withColumn("_place", F.monotonically_increasing_id()), "_group", ["source", "_place"], "mix-turns")
    return single.unionByName(numbered.select(*names, F.col("lo").alias("turn")))


def with_copies(sized: DataFrame, targets: DataFrame, seed: str = SEED) -> DataFrame:
    """Adds source_size, target and ``copies`` to rows with (doc_id, source, size, digest, turn)."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    named = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest", F.col("turn").cast("string"))
    draw = F.conv(F.substring(F.md5(named.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    t = written(targets.withColumnRenamed("source", "_s"), "mix-targets")
    if t.count() <= BROADCAST_SOURCES:
        t = F.broadcast(t)
    joined = sized.join(t, sized["source"].eqNullSafe(t["_s"]), "left").drop("_s").withColumn("_rate", rate)
    copies = F.floor("_rate") + F.when(draw < F.col("_rate") - F.floor("_rate"), 1).otherwise(0)
    return joined.withColumn("copies", copies.cast("long")).drop("_rate")


def mix_report(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted) for every row."""
    sized = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), text_digest(F.col("text")).alias("digest")), "mix-sizes")
    out = with_copies(with_turns(sized), source_targets(sized, weights, cap), seed)
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "source")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as its rate and draw say, same columns.

    Only sizes and digests are gathered; the texts are read once more and, with a bounded number of
    sources, not shuffled, but for rows that are equal in id and text.
    """
    names = docs.columns
    size = word_count(F.col("text"))
    sized = docs.select("source", size.alias("size"))
    targets = source_targets(sized, weights, cap)
    packed = docs.select("doc_id", "source", F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), size.alias("size"), text_digest(F.col("text")).alias("digest"))
    out = with_copies(with_turns(packed), targets, seed).where(F.col("copies") > 0)
    out = out.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_n"))
    return out.select(*[F.col("_row").getField(c).alias(c) for c in names])
