"""Reader features: overlapping token windows, padding, span labels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from ..config import ReaderConfig
from ..functions.text import TEXT_BYTES, hashed_words, runs_of, word_spans


def resolve_roles(df: DataFrame, with_answers: bool = False) -> DataFrame:
    """Check that the columns a reader needs exist; positions are never guessed."""
    needed = ["id", "question", "context"] + (["answers"] if with_answers else [])
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df


def encode(df: DataFrame, cfg: ReaderConfig) -> DataFrame:
    """Add ids and character spans of question (``q_*``) and context (``c_*``) words.

    The words of some ``TEXT_BYTES`` of rows are found and handed on at once, in one pass over both
    texts: spans and ids take several times the bytes of their texts.
    """
    df = df.drop("q_ids", "q_offsets", "c_ids", "c_offsets")
    vocab_size, n_special = cfg.vocab_size, cfg.n_special

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = sum(pc.binary_length(whole.column(n)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("question", "context"))
            for at, to in runs_of(sizes, TEXT_BYTES):
                batch, added = whole.slice(at, to - at), {}
                for side, name in (("q", "question"), ("c", "context")):
                    texts = batch.column(name)
                    added[f"{side}_ids"] = hashed_words(texts, vocab_size, n_special)
                    added[f"{side}_offsets"] = word_spans(texts)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *added.values()], names=[*batch.schema.names, *added]
                )

    schema = StructType(list(df.schema.fields))
    span = StructType().add("start", IntegerType()).add("end", IntegerType())
    for side in "qc":
        schema = schema.add(f"{side}_ids", ArrayType(IntegerType())).add(f"{side}_offsets", ArrayType(span))
    return df.mapInArrow(run, schema)


def cut_windows(encoded: DataFrame, cfg: ReaderConfig) -> DataFrame:
    """Cut encoded examples into windows; own tokenizers enter here.

    ``encoded`` has ``id, context`` and the four columns of :func:`encode`. The
    question is repeated in each window and only the context is cut. A question
    so long that windows could not advance is an error.
    """
    room = F.lit(cfg.window_length - cfg.n_special) - F.size("q_ids")
    room = F.when(room > cfg.doc_stride, room).otherwise(
        F.raise_error(F.lit("the overlap must be smaller than the context part of a window"))
    )
    step = F.col("room") - cfg.doc_stride
    last = F.greatest(F.lit(0), F.ceil((F.size("c_ids") - F.col("room")) / step)).cast("int")
    carried = [c for c in ("answers",) if c in encoded.columns]
    # The slices are taken in the same generated code as the explode, so the
    # arrays of a long document are never copied once per window.
    pieces = (
        encoded.withColumn("room", room.cast("int"))
        .select(
            "id", "context", "q_ids", "q_offsets", "c_ids", "c_offsets", "room", *carried,
            F.explode(F.sequence(F.lit(0), last)).alias("window_no"),
        )
        .withColumn("from", (F.col("window_no") * step).cast("int"))
        .select(
            F.col("id").alias("example_id"), "window_no", "from", "q_ids", "q_offsets",
            F.slice("c_ids", F.col("from") + 1, F.col("room")).alias("c_ids"),
            F.slice("c_offsets", F.col("from") + 1, F.col("room")).alias("c_offsets"),
            F.col("context"), *carried,
        )
    )
    first_char = F.coalesce(F.get("c_offsets", F.lit(0))["start"], F.lit(0))
    last_char = F.coalesce(
        F.get("c_offsets", F.size("c_offsets") - 1)["end"], F.lit(0)
    )
    no_span = F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end")))
    cls, sep = F.array(F.lit(cfg.cls_id)), F.array(F.lit(cfg.sep_id))
    special = F.array(F.lit(None).cast("int"))
    return pieces.select(
        "example_id",
        "window_no",
        F.col("from").alias("first_token"),
        (F.size("q_ids") + 2).alias("context_at"),
        F.size("c_ids").alias("n_context"),
        F.concat(cls, "q_ids", sep, "c_ids", sep).alias("input_ids"),
        F.array_repeat(F.lit(1), F.size("q_ids") + F.size("c_ids") + 3).alias("attention_mask"),
        F.concat(
            special, F.array_repeat(F.lit(0), F.size("q_ids")),
            special, F.array_repeat(F.lit(1), F.size("c_ids")), special,
        ).alias("sequence_ids"),
        F.concat(no_span, "q_offsets", no_span, "c_offsets", no_span).alias("offsets"),
        first_char.alias("text_start"),
        F.substring("context", first_char + 1, last_char - first_char).alias("window_text"),
        *carried,
    )


def make_windows(examples: DataFrame, cfg: ReaderConfig = ReaderConfig()) -> DataFrame:
    """Windows of ``examples(id, question, context[, answers])``.

    Layout: start token, question, separator, context part, separator. Each
    window also carries the slice of the text it covers, so answers can be cut
    out without joining the contexts back.
    """
    return cut_windows(encode(resolve_roles(examples), cfg), cfg)


def mask_offsets(windows: DataFrame) -> DataFrame:
    """Keep spans of context tokens only; all others become null."""
    return windows.withColumn(
        "offsets",
        F.zip_with("offsets", "sequence_ids", lambda o, s: F.when(s == 1, o)),
    )


def pad_windows(windows: DataFrame, cfg: ReaderConfig = ReaderConfig()) -> DataFrame:
    """Fill ``input_ids`` and ``attention_mask`` up to the full window length."""
    missing = F.lit(cfg.window_length) - F.size("input_ids")
    return windows.withColumns(
        {
            "input_ids": F.concat("input_ids", F.array_repeat(F.lit(cfg.pad_id), missing)),
            "attention_mask": F.concat("attention_mask", F.array_repeat(F.lit(0), missing)),
        }
    )


def label_spans(windows: DataFrame) -> DataFrame:
    """Add ``start_position`` and ``end_position`` of the first answer.

    The start is the last context token beginning at or before the answer, the
    end the first one ending at or after it. Both are 0, the place of the start
    token, when there is no answer or the window does not contain all of it.
    """
    start_char = F.get("answers.answer_start", F.lit(0))
    end_char = start_char + F.length(F.get("answers.text", F.lit(0)))
    spans = F.slice("offsets", F.col("context_at") + 1, F.col("n_context"))
    staged = windows.withColumns(
        {"__spans": spans, "__from": start_char.cast("int"), "__to": end_char.cast("int")}
    )
    first = F.get("__spans", F.lit(0))["start"]
    last = F.get("__spans", F.size("__spans") - 1)["end"]
    inside = F.coalesce((first <= F.col("__from")) & (last >= F.col("__to")), F.lit(False))
    # Spans are in ascending order, so counting finds the positions.
    started = F.size(F.filter("__spans", lambda s: s["start"] <= F.col("__from")))
    ended_before = F.size(F.filter("__spans", lambda s: s["end"] < F.col("__to")))
    return staged.withColumns(
        {
            "start_position": F.when(inside, F.col("context_at") + started - 1).otherwise(0),
            "end_position": F.when(inside, F.col("context_at") + ended_before).otherwise(0),
        }
    ).drop("__spans", "__from", "__to")


def feature_counts(windows: DataFrame) -> DataFrame:
    """Number of windows and of the examples they come from."""
    per_example = windows.groupBy("example_id").agg(F.count("*").alias("windows"))
    return per_example.agg(
        F.count("*").alias("n_examples"),
        F.coalesce(F.sum("windows"), F.lit(0)).alias("n_windows"),
        F.coalesce(F.max("windows"), F.lit(0)).alias("max_windows"),
    )
