"""Questions with contexts to answers: windows, reader, post-processing, scores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..config import AnswerConfig, ReaderConfig
from ..operators.answers import postprocess
from ..operators.metrics import qa_pairs, squad_metrics
from ..operators.reader import Reader, score_windows
from ..operators.windows import make_windows, mask_offsets
from ..session import stored


def scored_features(
    examples: DataFrame, make_reader: Callable[[], Reader], cfg: ReaderConfig = ReaderConfig()
) -> DataFrame:
    """Windows of ``examples(id, question, context)`` with masked offsets and logits.

    Windows are dealt out one by one before the reader, the dearest step, so the
    windows of one long text do not stay in one task.
    """
    windows = mask_offsets(make_windows(examples, cfg)).repartition("example_id", "window_no")
    return score_windows(windows, make_reader)


def answer(
    examples: DataFrame,
    make_reader: Callable[[], Reader],
    reader_cfg: ReaderConfig = ReaderConfig(),
    answer_cfg: AnswerConfig = AnswerConfig(),
) -> tuple[DataFrame, DataFrame]:
    """Predictions and n-best lists for every example.

    The scored windows are written first: the reader is the costly step, and
    several later steps read its output.
    """
    features = stored(scored_features(examples, make_reader, reader_cfg), "scored-windows")
    return postprocess(examples, features, answer_cfg)


def evaluate(
    examples: DataFrame,
    make_reader: Callable[[], Reader],
    reader_cfg: ReaderConfig = ReaderConfig(),
    answer_cfg: AnswerConfig = AnswerConfig(),
) -> DataFrame:
    """Exact match and F1 of the reader on ``examples`` with ``answers``."""
    predictions, _ = answer(examples, make_reader, reader_cfg, answer_cfg)
    return squad_metrics(qa_pairs(predictions, examples))
