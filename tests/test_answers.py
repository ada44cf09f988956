import math
import random

import pytest
from pyspark.sql import functions as F

from answerloom.config import AnswerConfig
from answerloom.operators import answers as A
from answerloom.operators.reader import unmatched_features, with_logits

SCHEMA = (
    "example_id string, window_no int, offsets array<struct<start: int, end: int>>, "
    "text_start int, window_text string, start_logits array<double>, end_logits array<double>"
)
CONTEXT = "".join(chr(97 + i % 26) + "x " for i in range(60))


def window(name, number, first, n, starts, ends):
    """Two leading places without a span, then ``n`` words of CONTEXT from ``first``."""
    spans = [(3 * i, 3 * i + 2) for i in range(first, first + n)]
    lo, hi = (spans[0][0], spans[-1][1]) if spans else (0, 0)
    return (name, number, [None, None, *spans], lo, CONTEXT[lo:hi], starts, ends)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "id string")


def plain_nbest(windows, cfg):
    """The ranked list of one example, by plain loops."""
    found, null = [], None
    for _, number, offsets, _, _, starts, ends in windows:
        null_score = starts[0] + ends[0]
        if null is None or null_score < null[0]:
            null = (null_score, starts[0], ends[0])

        def top(logits):
            order = sorted(range(len(logits)), key=lambda i: (-logits[i], i))
            return order[: cfg.n_best_size]

        for s in top(starts):
            for e in top(ends):
                if e < len(offsets) and s < len(offsets) and offsets[s] and offsets[e]:
                    if s <= e < s + cfg.max_answer_length:
                        text = CONTEXT[offsets[s][0] : offsets[e][1]]
                        found.append((starts[s] + ends[e], text, starts[s], ends[e], False))
    if cfg.allow_null:
        found.append((null[0], "", null[1], null[2], True))
    ranked = sorted(found, key=lambda c: -c[0])
    kept = ranked[: cfg.n_best_size]
    if cfg.allow_null and not any(c[4] for c in kept):
        kept.append((null[0], "", null[1], null[2], True))
    if not kept or (len(kept) == 1 and kept[0][1] == ""):
        kept.insert(0, (0.0, "empty", 0.0, 0.0, False))
    top_score = max(c[0] for c in kept)
    total = sum(math.exp(c[0] - top_score) for c in kept)
    return [(c[1], c[2], c[3], math.exp(c[0] - top_score) / total) for c in kept], null


@pytest.fixture(scope="module")
def random_windows():
    rng = random.Random(5)
    rows = []
    for name in "abcdefgh":
        for number in range(rng.choice([1, 2, 4])):
            n = rng.choice([0, 1, 3, 12])
            level = rng.choice([3, 50])  # few levels make ties
            logits = [[rng.randrange(level) / 4 for _ in range(n + 2)] for _ in range(2)]
            rows.append(window(name, number, number * 2, n, *logits))
    return rows


@pytest.mark.parametrize("allow_null", [False, True])
@pytest.mark.parametrize("n,longest", [(20, 30), (3, 2), (1, 1)])
def test_equal_to_plain_loops(spark, random_windows, allow_null, n, longest):
    cfg = AnswerConfig(n_best_size=n, max_answer_length=longest, allow_null=allow_null)
    nested = A.nbest(ids(spark, *"abcdefgh"), frame(spark, random_windows), cfg)
    got = {r["id"]: r for r in nested.collect()}
    for name in "abcdefgh":
        want, null = plain_nbest([w for w in random_windows if w[0] == name], cfg)
        rows = got[name]["predictions"]
        assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
        assert [(r["text"], r["start_logit"], r["end_logit"]) for r in rows] == [w[:3] for w in want]
        for r, w in zip(rows, want):
            assert r["probability"] == pytest.approx(w[3])
        assert sum(r["probability"] for r in rows) == pytest.approx(1)
        if allow_null:
            assert got[name]["null_score"] == null[0]


def test_example_without_windows_answers_empty(spark):
    rows = A.nbest(ids(spark, "a", "b"), frame(spark, [window("a", 0, 0, 1, [0.0] * 3, [0.0] * 3)]))
    got = {r["id"]: r["predictions"] for r in rows.collect()}
    assert [(p["text"], p["probability"]) for p in got["b"]] == [("empty", 1.0)]
    counts = A.features_per_example(ids(spark, "a", "b"), frame(spark, [window("a", 0, 0, 1, [0.0] * 3, [0.0] * 3)]))
    assert {r["id"]: r["n_windows"] for r in counts.collect()} == {"a": 1, "b": 0}


def test_only_the_null_candidate(spark):
    cfg = AnswerConfig(allow_null=True)
    features = frame(spark, [window("a", 0, 0, 0, [4.0, 1.0], [2.0, 1.0])])
    nested = A.nbest(ids(spark, "a"), features, cfg)
    row = nested.first()
    assert [p["text"] for p in row["predictions"]] == ["empty", ""]
    assert row["predictions"][0]["probability"] == pytest.approx(math.exp(-6) / (1 + math.exp(-6)))
    best = A.best_answer_or_null(nested, 0.0).first()
    assert (best["prediction_text"], best["score_diff"]) == ("", 6.0)


def test_null_threshold(spark):
    features = frame(spark, [window("a", 0, 0, 1, [3.0, 0.0, 1.0], [2.0, 0.0, 1.0])])
    nested = A.nbest(ids(spark, "a"), features, AnswerConfig(allow_null=True))
    for threshold, want in [(0.0, ""), (2.9, ""), (3.0, "ax"), (10.0, "ax")]:
        assert A.best_answer_or_null(nested, threshold).first()["prediction_text"] == want


def test_null_loses_ties_and_survives_the_cut(spark):
    cfg = AnswerConfig(n_best_size=2, allow_null=True)
    tie = frame(spark, [window("a", 0, 0, 2, [1.0, 0.0, 1.0, 0.0], [1.0, 0.0, 1.0, 1.0])])
    texts = [p["text"] for p in A.nbest(ids(spark, "a"), tie, cfg).first()["predictions"]]
    assert texts[-1] == "" and len(texts) == 2
    low = frame(spark, [window("a", 0, 0, 2, [-9.0, 0.0, 1.0, 1.0], [-9.0, 0.0, 1.0, 1.0])])
    texts = [p["text"] for p in A.nbest(ids(spark, "a"), low, cfg).first()["predictions"]]
    assert texts[-1] == "" and len(texts) == 3


def test_first_window_wins_null_ties(spark):
    rows = [window("a", 1, 0, 0, [1.0], [2.0]), window("a", 0, 0, 0, [2.0], [1.0])]
    row = A.null_scores(frame(spark, rows)).first()
    assert (row["null_score"], row["window_no"], row["start_logit"]) == (3.0, 0, 2.0)


def test_max_context_marks_allowed_starts(spark):
    rows = frame(spark, [window("a", 0, 0, 2, [0.0, 0.0, 5.0, 1.0], [0.0, 0.0, 1.0, 1.0])])
    marked = rows.withColumn("max_context", F.array(*[F.lit(i == 3) for i in range(4)]))
    assert {r["start_place"] for r in A.candidate_spans(rows).collect()} == {2, 3}
    assert {r["start_place"] for r in A.candidate_spans(marked).collect()} == {3}


def test_logits_must_match_windows(spark):
    rows = frame(spark, [window("a", 0, 0, 1, [0.0] * 3, [0.0] * 3), window("a", 1, 0, 1, [0.0] * 3, [0.0] * 3)])
    bare = rows.drop("start_logits", "end_logits")
    logits = rows.select("example_id", "window_no", "start_logits", "end_logits").where("window_no = 1")
    extra = logits.unionByName(logits.withColumn("window_no", F.lit(7)))
    got = {(r["window_no"], r["missing"]) for r in unmatched_features(bare, extra).collect()}
    assert got == {(0, "logits"), (7, "window")}
    assert with_logits(bare, extra).count() == 1
    with pytest.raises(ValueError, match="pair"):
        with_logits(bare, extra.drop("end_logits"))


def test_one_example_with_most_windows_is_cut_before_the_exchange(spark):
    rows = [window("hot", i, i % 40, 12, [float(i % 7)] * 14, [float(i % 5)] * 14) for i in range(200)]
    spans = A.best_spans(frame(spark, rows))
    assert spans.count() == 20
    plan = spans._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_spans_and_null_in_one_pass(spark, random_windows):
    """One reading of the windows gives what the two separate operators give."""
    cfg = AnswerConfig(n_best_size=3, max_answer_length=4, allow_null=True)
    features = frame(spark, random_windows)
    got = {r["id"]: r for r in A.spans_and_null(features, cfg).collect()}
    nulls = {r["id"]: r for r in A.null_scores(features).collect()}
    spans = {}
    for r in A.best_spans(features, cfg).orderBy("rank").collect():
        spans.setdefault(r["example_id"], []).append((r["rank"], r["text"], r["score"]))
    assert got.keys() == nulls.keys()
    for name, row in got.items():
        assert [(s["rank"], s["text"], s["score"]) for s in row["spans"]] == spans.get(name, [])
        null = row["null"]
        assert (null["score"], null["start_logit"]) == (nulls[name]["null_score"], nulls[name]["start_logit"])
    plan = A.nbest(ids(spark, "a"), features, cfg)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1
    assert A.spans_and_null(features.limit(0), cfg).count() == 0


def test_spans_of_windows_with_missing_logits(spark):
    """Pairs of many windows are formed at once; missing lists and values stay with their window."""
    rows = [
        window("a", 0, 0, 2, [0.0, 0.0, 1.0, 2.0], [0.0, 0.0, 1.0, 1.0]),
        window("b", 0, 0, 2, None, [0.0, 0.0, 1.0, 1.0]),
        window("c", 0, 0, 2, [0.0, 0.0, 1.0, 2.0], None),
        window("d", 0, 0, 2, [None] * 4, [None] * 4),
        window("e", 0, 0, 0, [1.0, 1.0], [1.0, 1.0]),
        window("f", 0, 0, 1, [0.0, 0.0, float("nan")], [0.0, 0.0, 1.0]),
    ]
    spans = A.candidate_spans(frame(spark, rows))
    got = [(r["example_id"], r["start_place"], r["end_place"]) for r in spans.collect()]
    assert got == [("a", 3, 3), ("a", 2, 2), ("a", 2, 3), ("f", 2, 2)]
    best = [(r["example_id"], r["rank"], r["score"]) for r in A.best_spans(frame(spark, rows[:5])).collect()]
    assert sorted(best) == [("a", 1, 3.0), ("a", 2, 2.0), ("a", 3, 2.0)]
    assert "ArrowEvalPython" in spans._jdf.queryExecution().executedPlan().toString()
