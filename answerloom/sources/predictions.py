"""Answer files: predictions, ranked lists, null odds, votes, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import NBEST_ENTRY
from ..operators.ensemble import stack_nbest
from .json_dict import read_dict

SAVE_MODES = ("errorifexists", "overwrite")


def _named(folder: str, name: str, prefix: str | None) -> str:
    return f"{folder}/{name}" if prefix is None else f"{folder}/{name}_{prefix}"


def nested_nbest(nested: DataFrame) -> DataFrame:
    """``(id, nbest)`` in the shape of the answer files, best first."""
    entries = F.transform(
        "predictions",
        lambda p: F.struct(*[p[f.name].cast(f.dataType).alias(f.name) for f in NBEST_ENTRY]),
    )
    return nested.select("id", entries.alias("nbest"))


def write_predictions(
    predictions: DataFrame,
    nested: DataFrame,
    folder: str,
    prefix: str | None = None,
    mode: str = "errorifexists",
) -> dict[str, str]:
    """Write predictions, n-best lists and, when scored, null odds as JSON lines.

    ``errorifexists`` refuses a folder that already holds results.
    """
    if mode not in SAVE_MODES:
        raise ValueError(f"mode must be one of {SAVE_MODES}")
    outputs = {
        "predictions": predictions.select("id", "prediction_text"),
        "nbest_predictions": nested_nbest(nested),
    }
    if "score_diff" in predictions.columns:
        outputs["null_odds"] = predictions.select("id", "score_diff")
    paths = {name: _named(folder, name, prefix) for name in outputs}
    for name, rows in outputs.items():
        rows.write.mode(mode).json(paths[name])
    return paths


def read_nbest(spark: SparkSession, paths: list[str], fmt: str = "jsonl") -> DataFrame:
    """Ranked answers of several models as ``(model, id, rank, text, probability)``.

    The position in ``paths`` is the model number, from 1. ``jsonl`` reads what
    :func:`write_predictions` wrote; ``json_dict`` one object ``{id: [...]}`` per
    file, of any size.
    """
    entry = T.ArrayType(NBEST_ENTRY)

    def rows(path: str) -> DataFrame:
        if fmt == "jsonl":
            schema = T.StructType(
                [T.StructField("id", T.StringType()), T.StructField("nbest", entry)]
            )
            lists = spark.read.schema(schema).json(path)
        elif fmt == "json_dict":
            lists = read_dict(spark, path, entry).select(F.col("key").alias("id"), F.col("value").alias("nbest"))
        else:
            raise ValueError(f"unknown format {fmt!r}")
        return lists.select("id", F.posexplode("nbest").alias("pos", "e")).select(
            "id", (F.col("pos") + 1).alias("rank"), "e.text", "e.probability"
        )

    return stack_nbest([rows(path) for path in paths])


def write_ensemble(picked: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the voted answer of every question as JSON lines."""
    picked.select("id", F.col("text").alias("prediction_text")).write.mode(mode).json(path)


def write_metrics(rows: DataFrame, path: str) -> None:
    """Append ``(metric, value)`` rows to a metrics table."""
    rows.write.mode("append").parquet(path)


def metric_lines(rows: DataFrame) -> DataFrame:
    """Metrics as ``key = value`` lines in key order."""
    return rows.orderBy("metric").select(F.format_string("%s = %s", "metric", "value").alias("line"))
