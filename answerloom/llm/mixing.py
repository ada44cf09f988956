"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a sequence of slots of equally many words. Slot ``i`` is the golden-ratio point
``frac(i / phi)``; the source whose interval of cumulative weights holds the point fills the
slot, so every stretch of the schedule is near the target weights. Slots are ranked per source
and joined with the source's blocks of equal size, cut from its documents in shuffled order;
after the last block a source begins anew, at most ``repeats`` times.

Everything is DataFrame code. Ranks and offsets are sums of two levels, never a window over a
whole source.

Defined results: a null text or one without words has size 0 and is never taken; a null source
is one source, ordered last; rows with the same id and size are interchangeable; no words at
all give targets of 0 and an empty schedule; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stored
from .common import WORD, running_total

WEIGHTS = (1, 2, 3)
REPEATS = 3
#: The least target is cut into at least so many blocks, unless that gives more slots than SLOTS.
PER_SOURCE, SLOTS = 64, 1 << 26
#: Fixed value: the golden ratio's inverse.
GOLDEN = 0.6180339887498949
#: Cells of the unit interval by which points meet the intervals of the sources.
CELLS = 4096
UNBOUNDED = Window.unboundedPreceding


@dataclass(frozen=True)
class Mix:
    """takes: a row per document; schedule: slot, source, block, epoch, words; sources: targets."""

    takes: DataFrame
    schedule: DataFrame
    sources: DataFrame


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, its never-null key, size in words and the place in the shuffled order."""
    return docs.select(
        "doc_id", "source",
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("place"),
    ).withColumn("bin", F.substring("place", 1, 3))


def source_targets(sizes: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """key, source, source_size, weight and target of each source.

    Sources by code point, null last, take the weights in turn. Those that would exceed
    ``repeats`` times their size stop there; the excess goes to the others by weight. In order
    of limit over weight, the first source that stays below its limit gives the level of all after it.
    """
    per = sizes.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.lit(list(map(float, weights))), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("limit", (F.col("source_size") * repeats).cast("double"))
    per = per.withColumn("ratio", F.col("limit") / F.col("weight"))
    order = Window.orderBy("ratio", "key")
    everywhere = Window.partitionBy()
    per = per.withColumn("total", F.sum("source_size").over(everywhere).cast("double"))
    spent = F.coalesce(F.sum("limit").over(order.rowsBetween(UNBOUNDED, -1)), F.lit(0.0))
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("level", (F.col("total") - spent) / left)
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "key", "level"))).over(everywhere)
    per = per.withColumn("level", first["level"])
    return per.select(
        "key", "source", "source_size", "weight",
        F.coalesce(F.least("limit", F.col("level") * F.col("weight")), "limit").alias("target"),
    )


def mix(docs: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> Mix:
    spark = docs.sparkSession
    sizes = stored(sized(docs), "sizes")
    sources = stored(source_targets(sizes, weights, repeats).coalesce(1), "sources")
    total, least = sources.select(
        F.sum("target"), F.min(F.when(F.col("target") >= 1, F.col("target")))
    ).first()
    total, least = int(total or 0), int(least or 1)
    block = max(1, least // PER_SOURCE, total // SLOTS)
    slots = -(-total // block)

    want = F.round("target").cast("long")
    sources = sources.withColumn("want", F.least(want, F.col("source_size") * repeats))
    sources = sources.withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
    size = F.greatest("source_size", F.lit(1))
    sources = sources.withColumn("rest", F.col("want") % size)
    sources = sources.withColumn(
        "needed", F.expr("want div greatest(source_size, 1)") * F.col("blocks") + F.ceil(F.col("rest") / block).cast("long")
    )
    plan = _schedule(spark, sources, slots, block)
    return Mix(_takes(sizes, sources, plan, block), plan, sources)


def _schedule(spark, sources: DataFrame, slots: int, block: int) -> DataFrame:
    """A row per slot: slot, key, source, block, epoch, words (the last of a source may be cut)."""
    share = F.col("want") / F.greatest(F.sum("want").over(Window.partitionBy()), F.lit(1))
    spans = sources.withColumn("share", share)
    high = F.sum("share").over(Window.orderBy("key").rowsBetween(UNBOUNDED, 0))
    spans = spans.withColumn("high", high).withColumn("low", F.lag("high", 1, 0.0).over(Window.orderBy("key")))
    # The last interval reaches the end in spite of rounding.
    spans = spans.withColumn("high", F.when(F.lead("key").over(Window.orderBy("key")).isNull(), 2.0).otherwise(F.col("high")))
    cells = spans.filter("want > 0").select(
        "key", "low", "high",
        F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS)))).alias("cell"),
    )
    points = spark.range(slots).select(
        F.col("id").alias("slot"), (F.col("id") * GOLDEN - F.floor(F.col("id") * GOLDEN)).alias("point")
    ).withColumn("cell", F.floor(F.col("point") * CELLS))
    dealt = points.join(cells, "cell").filter("point >= low AND point < high").select("slot", "key")
    dealt = dealt.withColumns({"bin": F.expr("slot div 4096"), "one": F.lit(1)})
    dealt = running_total(dealt, "key", "bin", ["slot"], "one", "rank").select("slot", "key", "rank")
    # A source that the points give too few slots gets the missing ones at the end.
    had = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("had"))
    missing = sources.join(had, "key", "left").withColumn("had", F.coalesce("had", F.lit(0))).filter("had < needed")
    missing = missing.select("key", F.explode(F.sequence("had", F.col("needed") - 1)).alias("rank"))
    all_slots = dealt.unionByName(missing.select(F.lit(slots).cast("long").alias("slot"), "key", "rank"))
    named = all_slots.join(sources, "key").filter("rank < needed")
    number = F.col("rank") % F.col("blocks")
    whole = F.least(F.lit(block), F.col("source_size") - number * block)
    last = F.col("rest") - F.expr(f"(rest - 1) div {block}") * block
    return named.select(
        "slot", "key", "source", number.alias("block"), F.expr("rank div blocks").alias("epoch"),
        whole.alias("whole"),
        F.when((F.col("rank") == F.col("needed") - 1) & (F.col("rest") > 0), last).otherwise(whole).cast("long").alias("words"),
    )


def _takes(sizes: DataFrame, sources: DataFrame, plan: DataFrame, block: int) -> DataFrame:
    used = plan.groupBy("key", "block").agg(
        F.sum(F.when(F.col("words") == F.col("whole"), 1).otherwise(0)).alias("full"),
        F.coalesce(F.max(F.when(F.col("words") < F.col("whole"), F.col("words"))), F.lit(0)).alias("part"),
    )
    facts = sources.select("key", "source_size", "target")
    placed = running_total(sizes, "key", "bin", ["place", "doc_id", "size"], "size", "start", also=facts)
    row = ["doc_id", "source", "size", "source_size", "target", "key", "start"]
    pieces = placed.filter("size > 0").select(
        *row, F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))).alias("block")
    )
    low = F.greatest(F.col("start") - F.col("block") * block, F.lit(0))
    high = F.least(F.col("start") + F.col("size") - F.col("block") * block, F.lit(block))
    taken = F.col("full") * (high - low) + F.greatest(F.least(high, F.col("part")) - low, F.lit(0))
    got = pieces.join(used, ["key", "block"], "left").groupBy(*row).agg(
        F.coalesce(F.sum(taken), F.lit(0)).cast("long").alias("taken")
    )
    none = placed.filter("size = 0").select(*row, F.lit(0).cast("long").alias("taken"))
    return got.unionByName(none).select("doc_id", "source", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """The documents of the mix, each as often as its words are taken, to the nearest whole number.

    Half counts as one. Documents without words stay once: they add nothing to any source. Rows
    sharing an id share its words evenly.
    """
    takes = mix(docs, weights, repeats).takes.groupBy("doc_id").agg(F.sum("size").alias("_size"), F.sum("taken").alias("_taken"))
    times = F.when(F.col("_size") > 0, F.floor(F.col("_taken") / F.col("_size") + 0.5)).otherwise(1).cast("int")
    copies = takes.select(F.col("doc_id").alias("_id"), times.alias("_times")).filter("_times > 0")
    joined = docs.join(copies, docs["doc_id"].eqNullSafe(copies["_id"]))
    return joined.select(*(docs[c] for c in docs.columns), F.explode(F.sequence(F.lit(1), "_times")).alias("_copy")).drop("_copy")


def op4_mix(spark, sf_dir):
    takes = mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).takes
    return takes.select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS place
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
  FROM d GROUP BY source
), r AS (SELECT *, 3.0 * source_size AS lim, sum(source_size) OVER () AS total FROM s
), l AS (
  SELECT *, (total - coalesce(sum(lim) OVER (ORDER BY lim / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY lim / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM r
), t AS (
  SELECT source, source_size,
         least(lim, (SELECT arg_min(level, lim / weight) FROM l WHERE level <= lim / weight) * weight)::DOUBLE AS target
  FROM l
), p AS (
  SELECT doc_id, size, source_size, target, round(target)::BIGINT AS want,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       ((want // greatest(source_size, 1)) * size + greatest(0, least(start + size, want % greatest(source_size, 1)) - start))::BIGINT AS taken
FROM p
"""
