"""Passage tables: deduplication, numbering, paragraphs, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.ml.feature import Bucketizer


def dedup_passages(df: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """One row ``(pid, text)`` per distinct text; ``pid`` is its lowest ``order``.

    Only ``(hash, id)`` pairs are grouped, with partial aggregation, so copies
    of one text never meet in a single task. The texts then move once, keyed by
    ``pid``; later steps that group by passage find them already in place.
    ``order`` must be unique.
    """
    first = (
        df.where(F.col(text).isNotNull())
        .groupBy(F.sha2(text, 256).alias("digest"))
        .agg(F.min(order).alias("pid"))
        .select("pid")
    )
    rows = df.select(F.col(order).alias("pid"), F.col(text).alias("text"))
    return rows.join(first.hint("merge"), "pid", "left_semi")


def assign_passage_ids(df: DataFrame, order: str = "pid", buckets: int | None = None) -> DataFrame:
    """Add ``passage_id``: dense numbers from 0 in the order of a unique number column.

    Rows are cut into value ranges at approximate quantiles, numbered inside
    each range, and shifted by the row count of the ranges before. The cut
    points only balance the ranges; any cut gives the same numbers.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    probabilities = [i / buckets for i in range(1, buckets)]
    cuts = df.approxQuantile(order, probabilities, 1 / (4 * buckets)) if buckets > 1 else []
    inf = float("inf")
    splits = [-inf, *sorted(set(cuts)), inf]
    ranged = df.withColumn("__value", F.col(order).cast("double"))
    if len(splits) > 2:
        ranged = Bucketizer(splits=splits, inputCol="__value", outputCol="__range").transform(ranged)
    else:
        ranged = ranged.withColumn("__range", F.lit(0.0))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("__range")
        .agg(F.count("*").alias("__rows"))
        .select("__range", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    )
    within = Window.partitionBy("__range").orderBy(order)
    # At most one offset row per range, and the ranges are counted by `buckets`.
    return (
        ranged.withColumn("__row", F.row_number().over(within))
        .join(F.broadcast(offsets), "__range")
        .withColumn("passage_id", F.col("__offset") + F.col("__row") - 1)
        .drop("__value", "__range", "__row", "__offset")
    )


def split_paragraphs(
    df: DataFrame, text: str = "text", min_chars: int = 1, pattern: str = "\n+"
) -> DataFrame:
    """One row per paragraph, with its position among all pieces of the text."""
    others = [c for c in df.columns if c != text]
    return (
        df.select(*others, F.posexplode(F.split(text, pattern)).alias("paragraph_no", "paragraph"))
        .withColumn("paragraph", F.trim("paragraph"))
        .where(F.length("paragraph") >= min_chars)
    )


def corpus_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """Row count, distinct texts and the distribution of text lengths.

    Texts are first reduced to one row per distinct hash, then to one row per
    length, so the exact percentiles work on lengths and not on the corpus.
    """
    per_text = df.groupBy(F.sha2(text, 256).alias("digest"), F.length(text).alias("chars")).agg(
        F.count("*").alias("copies")
    )
    per_length = per_text.groupBy("chars").agg(
        F.count("*").alias("texts"), F.sum("copies").alias("rows")
    )
    return per_length.agg(
        F.sum("rows").alias("n_rows"),
        F.sum("texts").alias("n_unique"),
        (F.sum(F.col("rows") * F.col("chars")) / F.sum("rows")).alias("mean_chars"),
        F.min("chars").alias("min_chars"),
        F.max("chars").alias("max_chars"),
        F.expr("percentile(chars, 0.5D, rows)").alias("median_chars"),
        F.expr("percentile(chars, 0.95D, rows)").alias("p95_chars"),
    )
