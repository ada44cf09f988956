"""Readers for passage collections and question sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CORPUS_ENTRY, QA, QA_TEST, conform
from .json_dict import read_dict


def read_corpus(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    text: str = "text",
    order: str | None = None,
) -> DataFrame:
    """Passages as ``(doc_id, text)``.

    ``parquet`` and ``jsonl`` split into many tasks and need an ``order`` column.
    ``json_dict`` is one object ``{key: {"text": ...}}`` per file, of any size;
    entries are numbered by file and position.
    """
    if fmt in ("parquet", "jsonl"):
        if order is None:
            raise ValueError("name the column that orders the passages")
        if fmt == "parquet":
            rows = spark.read.parquet(*([path] if isinstance(path, str) else path))
        else:
            schema = T.StructType(
                [T.StructField(order, T.LongType()), T.StructField(text, T.StringType())]
            )
            rows = spark.read.schema(schema).json(path)
        return rows.select(F.col(order).cast("long").alias("doc_id"), F.col(text).alias("text"))
    if fmt != "json_dict":
        raise ValueError(f"unknown format {fmt!r}")
    entries = read_dict(spark, path, CORPUS_ENTRY)
    # One short row per input file.
    numbered = entries.select("file").distinct().select(
        "file", (F.row_number().over(Window.orderBy("file")) - 1).cast("long").alias("file_no")
    )
    return entries.join(numbered, "file").select(
        F.shiftleft("file_no", 32).bitwiseOR(F.col("pos")).alias("doc_id"), F.col("value.text").alias("text")
    )


def read_qa(spark: SparkSession, splits: dict[str, str], labelled: bool = True) -> DataFrame:
    """Question tables from parquet with a ``split`` column.

    ``splits`` maps split names to paths, e.g. train and validation.
    """
    if labelled and "validation" not in splits:
        raise ValueError("a labelled dataset needs a validation split")
    schema = QA if labelled else QA_TEST
    frames = [
        conform(spark.read.schema(schema).parquet(path), schema).withColumn("split", F.lit(name))
        for name, path in splits.items()
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def write_qa(
    dataset: DataFrame, path: str, splits: tuple[str, ...], mode: str = "errorifexists"
) -> dict[str, str]:
    """Write a table with a ``split`` column in one pass, one parquet folder per split.

    Returns the folders of the named splits.
    """
    rows = conform(dataset, T.StructType([*QA.fields, T.StructField("split", T.StringType())]))
    rows.write.mode(mode).partitionBy("split").parquet(path)
    return {name: f"{path}/split={name}" for name in splits}
