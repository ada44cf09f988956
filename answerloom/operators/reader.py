"""Batch scoring of windows with a reader model supplied by the user."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A reader maps lists of input ids and attention masks to start and end logits,
# one array of the same length per window.
Reader = Callable[[list[np.ndarray], list[np.ndarray]], tuple[list, list]]

LOGITS_TYPE = "struct<start_logits: array<double>, end_logits: array<double>>"


def score_windows(
    windows: DataFrame, make_reader: Callable[[], Reader], batch_size: int = 64
) -> DataFrame:
    """Add ``start_logits`` and ``end_logits`` to every window.

    ``make_reader`` runs once per task and loads the model there. Only ids and
    masks travel to the Python worker; the other columns stay in the JVM.
    """

    def run(
        batches: Iterator[tuple[pd.Series, pd.Series]],
    ) -> Iterator[pd.DataFrame]:
        reader = make_reader()
        for ids, masks in batches:
            starts: list = []
            ends: list = []
            for at in range(0, len(ids), batch_size):
                part = slice(at, at + batch_size)
                start, end = reader(list(ids[part]), list(masks[part]))
                starts.extend(start)
                ends.extend(end)
            yield pd.DataFrame({"start_logits": starts, "end_logits": ends})

    run.__annotations__ = {
        "batches": Iterator[tuple[pd.Series, pd.Series]],
        "return": Iterator[pd.DataFrame],
    }
    # Marked so that no filter or projection is planned to run the model twice.
    model = F.pandas_udf(run, LOGITS_TYPE).asNondeterministic()
    logits = model("input_ids", "attention_mask")
    return windows.withColumn("__logits", logits).select(
        *windows.columns, "__logits.start_logits", "__logits.end_logits"
    )


def arithmetic_reader() -> Reader:
    """A deterministic stand-in for a model: logits computed from ids and places."""

    def read(ids: list[np.ndarray], masks: list[np.ndarray]) -> tuple[list, list]:
        starts, ends = [], []
        for row in ids:
            row = np.asarray(row, dtype=np.int64)
            place = np.arange(len(row))
            starts.append(((row * 31 + place * 17) % 1009) / 100.0)
            ends.append(((row * 37 + place * 23) % 1013) / 100.0)
        return starts, ends

    return read


def unmatched_features(features: DataFrame, logits: DataFrame) -> DataFrame:
    """Windows without logits and logits without a window; empty when all is well."""
    keys = ["example_id", "window_no"]
    left = features.select(*keys).join(logits.select(*keys), keys, "left_anti")
    right = logits.select(*keys).join(features.select(*keys), keys, "left_anti")
    return left.withColumn("missing", F.lit("logits")).unionByName(
        right.withColumn("missing", F.lit("window"))
    )


def with_logits(features: DataFrame, logits: DataFrame) -> DataFrame:
    """Join separately stored logits to their windows."""
    missing = {"start_logits", "end_logits"} - set(logits.columns)
    if missing:
        raise ValueError(f"logits must come as a pair; missing {sorted(missing)}")
    return features.join(logits, ["example_id", "window_no"])
