"""Voting over the ranked answers of several models, and unions of QA splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import top_k
from .sizing import union_all


def stack_nbest(lists: list[DataFrame]) -> DataFrame:
    """N-best rows ``(id, rank, text, probability)`` of all models, with ``model`` from 1."""
    return union_all(
        [
            rows.select(
                F.lit(number).alias("model"), "id", "rank", "text", "probability"
            )
            for number, rows in enumerate(lists, start=1)
        ]
    )


def ensemble_votes(stacked: DataFrame) -> DataFrame:
    """Probability sum per question and exact text, and where the text was first seen.

    Model and rank are packed into one number, which a hash aggregate can keep
    in place; a minimum of structs would sort all rows.
    """
    packed = F.shiftleft(F.col("model").cast("long"), 32) + F.col("rank")
    votes = stacked.groupBy("id", "text").agg(
        F.sum("probability").alias("votes"), F.min(packed).alias("__first")
    )
    first_seen = F.struct(
        F.shiftright("__first", 32).cast("int").alias("model"),
        (F.col("__first") % (1 << 32)).cast("int").alias("rank"),
    )
    return votes.select("id", "text", "votes", first_seen.alias("first_seen"))


def ensemble_pick(votes: DataFrame) -> DataFrame:
    """The text with the most votes; ties to 9 digits go to the first seen."""
    order = [F.desc(F.round("votes", 9)), F.asc("first_seen")]
    return top_k(votes, "id", order, 1).select("id", "text", "votes")


def concat_splits(*splits: DataFrame) -> DataFrame:
    """All rows of all splits, duplicates kept."""
    return union_all(list(splits))


def augment_train(dataset: DataFrame, extra: DataFrame) -> DataFrame:
    """Add ``extra`` rows to the train split; the other splits stay as they are."""
    return extra.select(
        *[F.lit("train").alias("split") if c == "split" else F.col(c) for c in dataset.columns]
    ).unionByName(dataset)
