"""Exact match and token F1 of predicted answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import let, run_lengths
from ..functions.text import answer_tokens, normalize_answer


def qa_pairs(predictions: DataFrame, references: DataFrame) -> DataFrame:
    """``(id, prediction_text, golds)`` for every reference; a missing prediction is null."""
    return references.select("id", F.col("answers.text").alias("golds")).join(
        predictions.select("id", "prediction_text"), "id", "left"
    ).select("id", "prediction_text", "golds")


def token_overlap(left: Column, right: Column) -> Column:
    """Size of the multiset intersection of two token arrays.

    Tokens are tagged with their side and sorted together; a token found on both
    sides makes two neighbouring runs, and the shorter one counts.
    """
    tagged = F.concat(
        F.transform(left, lambda t: F.struct(t.alias("token"), F.lit(0).alias("side"))),
        F.transform(right, lambda t: F.struct(t.alias("token"), F.lit(1).alias("side"))),
    )

    def total(runs: Column) -> Column:
        shared = F.transform(
            runs,
            lambda r, i: F.when(
                F.get(runs, i + 1)["value"]["token"] == r["value"]["token"],
                F.least(r["n"], F.get(runs, i + 1)["n"]),
            ).otherwise(0),
        )
        return F.aggregate(shared, F.lit(0), lambda a, x: a + x)

    return let(run_lengths(tagged), total)


def token_f1(prediction: Column, gold: Column) -> Column:
    """F1 of two token arrays; 0 without a common token."""
    lengths = F.size(prediction) + F.size(gold)
    overlap = token_overlap(prediction, gold)
    return F.when(lengths > 0, 2.0 * overlap / lengths).otherwise(0.0)


def answer_scores(pairs: DataFrame) -> DataFrame:
    """Per question ``em`` and ``f1``, each the best over its gold answers."""
    normalized = pairs.select(
        "id",
        normalize_answer(F.col("prediction_text")).alias("p"),
        F.transform("golds", normalize_answer).alias("golds"),
    )
    tokens = normalized.withColumn("p_tokens", answer_tokens(F.col("p")))
    em = F.array_max(F.transform("golds", lambda g: F.when(g == F.col("p"), 1.0).otherwise(0.0)))
    f1 = F.array_max(
        F.transform("golds", lambda g: token_f1(F.col("p_tokens"), answer_tokens(g)))
    )
    # No prediction, or no gold answer, scores 0.
    return tokens.select(
        "id", F.coalesce(em, F.lit(0.0)).alias("em"), F.coalesce(f1, F.lit(0.0)).alias("f1")
    )


def squad_metrics(pairs: DataFrame) -> DataFrame:
    """One row: mean exact match and F1 in percent, and the number of questions."""
    return answer_scores(pairs).agg(
        (F.avg("em") * 100).alias("exact_match"),
        (F.avg("f1") * 100).alias("f1"),
        F.count("*").alias("n"),
    )


def compare_runs(pairs_by_run: DataFrame) -> DataFrame:
    """Metrics per ``run`` of ``(run, id, prediction_text, golds)``, best F1 first."""
    keyed = pairs_by_run.select(
        F.struct("run", "id").alias("id"), "prediction_text", "golds"
    )
    return (
        answer_scores(keyed)
        .groupBy(F.col("id.run").alias("run"))
        .agg(
            (F.avg("em") * 100).alias("exact_match"),
            (F.avg("f1") * 100).alias("f1"),
            F.count("*").alias("n"),
        )
        .orderBy(F.desc("f1"), "run")
    )


def metric_rows(metrics: DataFrame, prefix: str) -> DataFrame:
    """A one-row metrics table as ``(metric, value)`` rows, in metric order."""
    pairs = [
        F.struct(F.lit(f"{prefix}_{c}").alias("metric"), F.col(c).cast("double").alias("value"))
        for c in sorted(metrics.columns)
    ]
    return metrics.select(F.inline(F.array(*pairs)))
