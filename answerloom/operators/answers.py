"""From logits to ranked answers with probabilities.

Features are windows with ``start_logits``, ``end_logits`` and masked
``offsets``. Spans are formed inside each window row; a single exchange on the
example id ranks them, and everything after it works on one short array per
example. With the no-answer candidate each window adds its null score to its
spans, so that the windows are still read once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from ..config import AnswerConfig
from ..functions.arrays import let, places
from ..session import stored
from .ranking import top_k


def features_per_example(examples: DataFrame, features: DataFrame) -> DataFrame:
    """Window count per example, 0 for an example without windows."""
    counts = features.groupBy("example_id").agg(F.count("*").alias("n_windows"))
    return (
        examples.select("id")
        .join(counts.withColumnRenamed("example_id", "id"), "id", "left")
        .select("id", F.coalesce("n_windows", F.lit(0)).alias("n_windows"))
    )


def _null_logits() -> tuple[Column, Column]:
    return tuple(F.get(name, F.lit(0)).cast("double") for name in ("start_logits", "end_logits"))


def null_scores(features: DataFrame) -> DataFrame:
    """Lowest score of the start token over all windows; the first window wins ties."""
    start, end = _null_logits()
    lowest = F.min(
        F.struct(
            (start + end).alias("score"), F.col("window_no"),
            start.alias("start_logit"), end.alias("end_logit"),
        )
    )
    return (
        features.groupBy("example_id")
        .agg(lowest.alias("null"))
        .select(F.col("example_id").alias("id"), "null.*")
        .withColumnRenamed("score", "null_score")
    )


def best_positions(logits: Column, n: int) -> Column:
    """The ``n`` highest logits as ``array<struct<logit, place>>``; ties by place.

    Only places at or above the n-th highest value are built and sorted.
    """

    def best(values: Column) -> Column:
        ranked = F.sort_array(values, asc=False)
        lowest = F.get(ranked, F.least(F.size(values), F.lit(n)) - 1)
        high = let(lowest, lambda low: F.filter(places(values), lambda i: F.get(values, i) >= low))
        keyed = F.transform(
            high, lambda i: F.struct((-F.get(values, i)).alias("minus"), i.alias("place"))
        )
        return F.transform(
            F.slice(F.sort_array(keyed), 1, n),
            lambda p: F.struct((-p["minus"]).alias("logit"), p["place"].alias("place")),
        )

    return let(logits.cast("array<double>"), best)


def top_positions(features: DataFrame, n: int) -> DataFrame:
    """Add the best start and end positions of each window."""
    return features.withColumns(
        {
            "start_top": best_positions(F.col("start_logits"), n),
            "end_top": best_positions(F.col("end_logits"), n),
        }
    )


def _window_spans(features: DataFrame, cfg: AnswerConfig, most: int | None = None) -> Column:
    """Allowed spans of a window row, with where and in which order they were formed.

    With ``most`` only the best, in their order; the combinations of many windows are formed at once.
    """
    offsets = F.col("offsets")

    def inside(top: Column, marked: Column | None) -> Column:
        """Positions within the context, with their rank and characters."""
        placed = F.transform(
            top,
            lambda p, i: F.struct(
                i.alias("rank"), p["place"].alias("place"), p["logit"].alias("logit"),
                F.get(offsets, p["place"]).alias("off"),
            ),
        )

        def allowed(p: Column) -> Column:
            kept = p["off"].isNotNull()
            return kept if marked is None else kept & F.coalesce(F.get(marked, p["place"]), F.lit(False))

        return F.filter(placed, allowed)

    checked = F.col("max_context") if "max_context" in features.columns else None

    def formed(starts: pa.Array, ends: pa.Array) -> pa.Array:
        return _formed_spans(starts, ends, cfg.max_answer_length, most)

    return F.arrow_udf(formed, from_arrow_type(SPANS))(inside(F.col("start_top"), checked), inside(F.col("end_top"), None))


# Windows whose start x end combinations are formed at once in a task.
PAIRED_WINDOWS = 1000
SPAN_FIELDS = [
    ("minus", pa.float64()), ("start_rank", pa.int32()), ("end_rank", pa.int32()),
    ("start_place", pa.int32()), ("end_place", pa.int32()), ("start_char", pa.int32()),
    ("end_char", pa.int32()), ("start_logit", pa.float64()), ("end_logit", pa.float64()),
]
SPANS = pa.list_(pa.struct(SPAN_FIELDS))


def _formed_spans(starts: pa.Array, ends: pa.Array, longest: int, most: int | None) -> pa.Array:
    """Allowed pairs of each window's start and end positions; the ``most`` best, best first, if given.

    Without ``most`` they come by start, then end. A window without a list of
    positions has no list of spans either.
    """
    pieces = [
        _spans_of_piece(starts.slice(at, PAIRED_WINDOWS), ends.slice(at, PAIRED_WINDOWS), longest, most)
        for at in range(0, len(starts), PAIRED_WINDOWS)
    ]
    return pa.concat_arrays(pieces) if pieces else pa.array([], SPANS)


def _spans_of_piece(starts: pa.Array, ends: pa.Array, longest: int, most: int | None) -> pa.Array:
    n_start, n_end = (pc.list_value_length(a).fill_null(0).to_numpy() for a in (starts, ends))
    s, e = starts.flatten(), ends.flatten()

    def numbers(entries: pa.Array, *path: str) -> np.ndarray:
        return pc.struct_field(entries, list(path)).to_numpy(zero_copy_only=False)

    # Every start meets every end of its window, by start, then end.
    of_start = np.repeat(np.arange(len(n_start)), n_start)
    per_start = n_end[of_start]
    left = np.repeat(np.arange(len(s)), per_start)
    first_pair = np.cumsum(per_start) - per_start
    first_end = np.cumsum(n_end) - n_end
    right = np.arange(len(left)) - first_pair[left] + first_end[of_start[left]]
    start_place, end_place = numbers(s, "place"), numbers(e, "place")
    ahead = end_place[right] - start_place[left]
    near = (ahead >= 0) & (ahead < longest)
    left, right = left[near], right[near]
    start_logit, end_logit = numbers(s, "logit"), numbers(e, "logit")
    minus, window = -(start_logit[left] + end_logit[right]), of_start[left]
    if most is not None:
        # A stable sort: equal scores keep the order of start and end.
        order = np.lexsort((minus, window))
        window = window[order]
        first = np.searchsorted(window, window)
        kept = np.arange(len(window)) - first < most
        order, window = order[kept], window[kept]
        minus, left, right = minus[order], left[order], right[order]
    columns = [
        minus, numbers(s, "rank")[left], numbers(e, "rank")[right], start_place[left], end_place[right],
        numbers(s, "off", "start")[left], numbers(e, "off", "end")[right], start_logit[left], end_logit[right],
    ]
    fields = list(SPANS.value_type)
    rows = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], fields=fields)
    unknown = starts.is_null().to_numpy(zero_copy_only=False) | (
        ends.is_null().to_numpy(zero_copy_only=False) & (n_start > 0)
    )
    firsts = np.searchsorted(window, np.arange(len(n_start) + 1))
    return pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), rows, mask=pa.array(unknown))


def candidate_spans(
    features: DataFrame, cfg: AnswerConfig = AnswerConfig(), most: int | None = None
) -> DataFrame:
    """Every allowed start x end combination of the best positions of a window.

    Dropped are spans outside the context, backwards or longer than allowed,
    and, when a ``max_context`` array is given, starts it does not mark. With
    ``most`` only the best spans of each window become rows.
    """
    spans = _window_spans(features, cfg, most)
    # The outer form: the plain one adds a filter on the array's size, which is
    # pushed down and builds the array a second time.
    rows = (
        top_positions(features, cfg.n_best_size)
        .select("example_id", "window_no", "text_start", "window_text", F.explode_outer(spans).alias("p"))
        .where(F.col("p").isNotNull())
        .select("example_id", "window_no", "text_start", "window_text", "p.*")
    )
    return rows.select(
        "example_id", "window_no", "start_rank", "end_rank", "start_place", "end_place",
        "start_char", "end_char", "start_logit", "end_logit", _score(), _text(),
    )


def _score() -> Column:
    return (F.col("start_logit") + F.col("end_logit")).alias("score")


def _text() -> Column:
    return F.substring(
        "window_text", F.col("start_char") - F.col("text_start") + 1,
        F.col("end_char") - F.col("start_char"),
    ).alias("text")


def best_spans(features: DataFrame, cfg: AnswerConfig = AnswerConfig()) -> DataFrame:
    """The best spans of each example over all its windows, ``rank`` from 1.

    Equal scores keep the order in which windows and positions produce them.
    """
    order = [F.desc("score"), F.asc("window_no"), F.asc("start_rank"), F.asc("end_rank")]
    spans = candidate_spans(features, cfg, most=cfg.n_best_size)
    return top_k(spans, "example_id", order, cfg.n_best_size)


def spans_and_null(features: DataFrame, cfg: AnswerConfig = AnswerConfig()) -> DataFrame:
    """``(id, spans, null)``: the best spans of :func:`best_spans` and the score of :func:`null_scores`.

    A window gives its best spans and one row for its null score. Both are cut
    to the best per example before the exchange, so an example sends at most
    ``n_best_size`` rows of each kind per task, however many windows it has.
    """
    start, end = _null_logits()
    null = F.struct((start + end).alias("score"), start.alias("start_logit"), end.alias("end_logit"))

    def entries(spans: Column) -> Column:
        no_null = F.when(F.lit(False), null)
        of_spans = F.transform(
            spans, lambda p: F.struct(F.lit(False).alias("is_null"), p.alias("p"), no_null.alias("null"))
        )
        no_span = F.get(spans, F.lit(-1))
        of_null = F.struct(F.lit(True).alias("is_null"), no_span.alias("p"), null.alias("null"))
        return F.concat(of_spans, F.array(of_null))

    spans = _window_spans(features, cfg, cfg.n_best_size)
    rows = (
        top_positions(features, cfg.n_best_size)
        .select("example_id", "window_no", "text_start", "window_text", F.explode(let(spans, entries)).alias("c"))
        .select("example_id", "window_no", "text_start", "window_text", "c.is_null", "c.null", "c.p.*")
        .select(
            "example_id", "is_null", "null", "window_no", "start_rank", "end_rank", "start_logit", "end_logit",
            _score(), _text(),
        )
    )
    order = [F.asc("null.score"), F.desc("score"), F.asc("window_no"), F.asc("start_rank"), F.asc("end_rank")]
    best = top_k(rows, ["example_id", "is_null"], order, cfg.n_best_size)
    span = F.struct("rank", "text", "start_logit", "end_logit", "score", F.lit(False).alias("is_null"))
    return best.groupBy(F.col("example_id").alias("id")).agg(
        F.sort_array(F.collect_list(F.when(~F.col("is_null"), span))).alias("spans"),
        F.max(F.when(F.col("is_null") & (F.col("rank") == 1), F.col("null"))).alias("null"),
    )


def _prediction(text, start, end, score, is_null) -> Column:
    return F.struct(
        text.alias("text"), start.alias("start_logit"), end.alias("end_logit"),
        score.alias("score"), is_null.alias("is_null"),
    )


def _add_null(spans: Column, cfg: AnswerConfig) -> Column:
    """Put the no-answer candidate in its place, last among equals, and never lose it."""
    null = _prediction(
        F.lit(""), F.col("null.start_logit"), F.col("null.end_logit"), F.col("null_score"), F.lit(True)
    )

    def merged(s: Column) -> Column:
        better = F.filter(s, lambda p: p["score"] >= F.col("null_score"))
        worse = F.filter(s, lambda p: p["score"] < F.col("null_score"))
        kept = F.slice(F.concat(better, F.array(null), worse), 1, cfg.n_best_size)
        return F.when(F.size(better) >= cfg.n_best_size, F.concat(better, F.array(null))).otherwise(
            kept
        )

    return F.when(F.col("null_score").isNull(), spans).otherwise(let(spans, merged))


def _fill_empty(predictions: Column) -> Column:
    """Put "empty" in front when there is no candidate, or a single empty one."""
    zero = F.lit(0.0)
    empty = F.array(_prediction(F.lit("empty"), zero, zero, zero, F.lit(False)))

    def filled(p: Column) -> Column:
        lone = (F.size(p) == 1) & (F.get(p, F.lit(0))["text"] == "")
        return F.when((F.size(p) == 0) | lone, F.concat(empty, p)).otherwise(p)

    return let(predictions, filled)


def _with_probability(predictions: Column) -> Column:
    """Softmax over the scores of one example, shifted by the highest."""

    def weighted(p: Column) -> Column:
        scores = F.transform(p, lambda x: x["score"])
        exps = let(
            F.array_max(scores), lambda top: F.transform(scores, lambda s: F.exp(s - top))
        )
        return let(
            exps,
            lambda e: let(
                F.aggregate(e, F.lit(0.0), lambda a, x: a + x),
                lambda total: F.transform(
                    p,
                    lambda x, i: F.struct(
                        (i + 1).alias("rank"), x["text"].alias("text"),
                        x["start_logit"].alias("start_logit"),
                        x["end_logit"].alias("end_logit"),
                        (F.get(e, i) / total).alias("probability"),
                    ),
                ),
            ),
        )

    return let(predictions, weighted)


def nbest(examples: DataFrame, features: DataFrame, cfg: AnswerConfig = AnswerConfig()) -> DataFrame:
    """``(id, predictions)`` with ranked ``text, start_logit, end_logit, probability``.

    Every example gets a row, also one without windows. With ``allow_null`` the
    row also carries ``null_score``.
    """
    if cfg.allow_null:
        spans = spans_and_null(features, cfg)
    else:
        span = F.struct(
            "rank", "text", "start_logit", "end_logit", "score", F.lit(False).alias("is_null")
        )
        spans = (
            best_spans(features, cfg)
            .groupBy(F.col("example_id").alias("id"))
            .agg(F.sort_array(F.collect_list(span)).alias("spans"))
        )
    rows = examples.select("id").join(spans, "id", "left")
    ranked = F.transform(
        F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)),
        lambda s: _prediction(
            s["text"], s["start_logit"], s["end_logit"], s["score"], s["is_null"]
        ),
    )
    if cfg.allow_null:
        rows = rows.withColumn("null_score", F.col("null.score"))
        staged = rows.select("id", "null_score", _add_null(ranked, cfg).alias("p"))
    else:
        staged = rows.select("id", ranked.alias("p"))
    extra = ["null_score"] if cfg.allow_null else []
    return staged.select(
        "id", *extra, _with_probability(_fill_empty(F.col("p"))).alias("predictions")
    )


def flat_nbest(nested: DataFrame) -> DataFrame:
    """One row per ranked answer."""
    return nested.select("id", F.inline("predictions"))


def best_answer(nested: DataFrame) -> DataFrame:
    """The answer at rank 1."""
    return nested.select(
        "id", F.get("predictions", F.lit(0))["text"].alias("prediction_text")
    )


def best_answer_or_null(nested: DataFrame, threshold: float = 0.0) -> DataFrame:
    """The best non-empty answer, or "" when the null score beats it by ``threshold``.

    Without any non-empty candidate the answer is "" and ``score_diff`` is null.
    """
    filled = F.filter("predictions", lambda p: p["text"] != "")
    staged = nested.select("id", "null_score", F.get(filled, F.lit(0)).alias("best"))
    diff = F.col("null_score") - F.col("best.start_logit") - F.col("best.end_logit")
    answer = F.when(diff > threshold, "").otherwise(F.coalesce("best.text", F.lit("")))
    return staged.select("id", diff.alias("score_diff"), answer.alias("prediction_text"))


def postprocess(
    examples: DataFrame, features: DataFrame, cfg: AnswerConfig = AnswerConfig()
) -> tuple[DataFrame, DataFrame]:
    """Predictions and n-best lists of scored windows.

    The lists are written, a short array per example: both results are read from
    them, so windows are scored and ranked once.
    """
    nested = stored(nbest(examples, features, cfg), "nbest")
    if cfg.allow_null:
        return best_answer_or_null(nested, cfg.null_threshold), nested
    return best_answer(nested), nested
