import math
import re

import pytest
from pyspark.sql import functions as F

from answerloom.config import ReaderConfig
from answerloom.operators import windows as W
from answerloom.operators.reader import arithmetic_reader, score_windows

ANSWERS = "answers struct<answer_start: array<bigint>, text: array<string>>"
SCHEMA = f"id string, question string, context string, {ANSWERS}"
# Room for 10 - 3 - 2 = 5 context words, 2 of them shared: windows move by 3.
SMALL = ReaderConfig(max_seq_length=10, doc_stride=2)


def words(n):
    return " ".join(f"w{i:02d}" for i in range(n))


def example(name, context, start=None, text=None, question="what now"):
    return (name, question, context, ([] if start is None else [start], [] if text is None else [text]))


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


@pytest.fixture(scope="module")
def sizes(spark):
    return W.make_windows(
        frame(spark, *[example(str(n), words(n)) for n in (0, 1, 4, 5, 6, 8, 9, 23)]), SMALL
    )


def test_windows_cover_all_words_and_overlap_by_the_stride(sizes):
    by_id = {}
    for r in sizes.orderBy("example_id", "window_no").collect():
        by_id.setdefault(int(r["example_id"]), []).append(r)
    assert {n: len(rows) for n, rows in by_id.items()} == {
        0: 1, 1: 1, 4: 1, 5: 1, 6: 2, 8: 2, 9: 3, 23: 7
    }
    for n, rows in by_id.items():
        seen = set()
        for a, b in zip(rows, rows[1:]):
            assert a["first_token"] + a["n_context"] - b["first_token"] == SMALL.doc_stride
        for r in rows:
            seen |= set(range(r["first_token"], r["first_token"] + r["n_context"]))
            assert len(r["input_ids"]) == len(r["offsets"]) == len(r["sequence_ids"])
            assert len(r["input_ids"]) <= SMALL.window_length
            text = words(n)
            for o, side in zip(r["offsets"], r["sequence_ids"]):
                if side == 1:
                    at = o["start"] - r["text_start"]
                    assert r["window_text"][at : at + 3] == text[o["start"] : o["end"]]
        assert seen == set(range(n))


def test_mask_and_padding(sizes):
    masked = W.mask_offsets(sizes).collect()
    for r in masked:
        for o, side in zip(r["offsets"], r["sequence_ids"]):
            assert (o is None) == (side != 1)
    for r in W.pad_windows(sizes, SMALL).collect():
        assert len(r["input_ids"]) == len(r["attention_mask"]) == 10
        assert sum(r["attention_mask"]) == r["n_context"] + 2 + 3
        assert all(i == SMALL.pad_id for i, m in zip(r["input_ids"], r["attention_mask"]) if m == 0)


def test_model_limit_caps_the_window():
    assert ReaderConfig(max_seq_length=900, model_max_length=512).window_length == 512
    assert ReaderConfig().window_length == 384


def test_overlap_must_leave_room(spark):
    df = frame(spark, example("a", words(30)))
    with pytest.raises(Exception, match="overlap"):
        W.make_windows(df, ReaderConfig(max_seq_length=10, doc_stride=5)).collect()


def test_encode_hands_on_bounded_batches(spark, monkeypatch):
    rows = [(i, "which word", "w " * (i * 40 + 1)) for i in range(30)] + [(30, "none", ""), (31, None, "a b")]
    examples = spark.createDataFrame(rows, "id long, question string, context string").coalesce(1)
    seen = []
    monkeypatch.setattr(type(examples), "mapInArrow", lambda self, run, schema: seen.append(run))
    W.encode(examples, ReaderConfig())
    monkeypatch.undo()
    monkeypatch.setattr(W, "TEXT_BYTES", 4000)
    parts = list(seen[0](examples.toArrow().to_batches()))
    assert all(b.num_rows == 1 or sum(len(t) for t in b.column("context").to_pylist()) <= 4000 for b in parts)
    assert [i for b in parts for i in b.column("id").to_pylist()] == list(range(32))
    assert [len(o) for b in parts for o in b.column("c_offsets").to_pylist()] == [len(c.split()) for *_, c in rows]


def test_scored_examples_need_one_python_step_before_the_spans(spark):
    from answerloom.suite import fixtures as X

    texts = ["", "   ", "one", " a  b\tc\n", "x y z w v", "é ü\u00a0ß 日本 語 "]
    passages = spark.createDataFrame([(i - 2, t) for i, t in enumerate(texts)] + [(9, None)], "pid long, text string")
    examples = X.qa_span(passages)
    features = X.logits(W.make_windows(examples))
    plan = features._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and plan.count("MapInArrow") == 1
    for r in examples.where("id >= 0").collect():
        words = [(m.start(), m.end()) for m in re.finditer(r"[^ \t-\r]+", r["context"] or "")]
        k = r["id"] % len(words) if words else 0
        start, end = (words[k][0], words[min(k + 3, len(words) - 1)][1]) if words else (0, 0)
        assert r["answers"]["answer_start"] == ([start] if words else [])
        assert r["answers"]["text"] == ([r["context"][start:end]] if words else [])
    for r in features.collect():
        if r["input_ids"] is None:
            assert r["start_logits"] is None and r["end_logits"] is None
        for name, step, modulus in (("start_logits", 31, 251), ("end_logits", 53, 257)):
            at = r["example_id"] * 7919 + r["window_no"] * 104729
            want = [math.fmod(at + i * step, modulus) / 100 for i in range(len(r["input_ids"] or []))]
            assert (r[name] or []) == want


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="context"):
        W.make_windows(frame(spark, example("a", "x")).drop("context"))


def test_labels(spark):
    context = words(9)  # windows at words 0-4, 3-7, 6-8
    at = {i: context.index(f"w{i:02d}") for i in range(9)}
    rows = [
        example("first", context, at[0], "w00"),
        example("last", context, at[8], "w08"),
        example("edge", context, at[4], "w04 w05"),
        example("wide", context, at[1], "w01 w02 w03 w04 w05 w06"),
        example("none", context),
        example("inside", context, at[3] + 1, "03"),
        example("exact", words(5), 0, words(5)),
        ("two", "what now", context, ([at[2], at[8]], ["w02", "w08"])),
    ]
    labelled = W.label_spans(W.make_windows(frame(spark, *rows), SMALL)).collect()
    got = {(r["example_id"], r["window_no"]): (r["start_position"], r["end_position"]) for r in labelled}
    c = 4  # start token, two question words, separator
    want = {
        "first": [(c, c), (0, 0), (0, 0)],
        "last": [(0, 0), (0, 0), (c + 2, c + 2)],
        "edge": [(0, 0), (c + 1, c + 2), (0, 0)],
        "wide": [(0, 0), (0, 0), (0, 0)],
        "none": [(0, 0), (0, 0), (0, 0)],
        "inside": [(c + 3, c + 3), (c, c), (0, 0)],
        "exact": [(c, c + 4)],
        "two": [(c + 2, c + 2), (0, 0), (0, 0)],
    }
    assert got == {(k, i): v for k, spans in want.items() for i, v in enumerate(spans)}


def test_labelled_span_contains_the_answer(spark):
    context = "Ünï cödé 😀 text  with\nodd   blanks and 😀😀 more words to fill several windows here"
    rows = []
    for i, m in enumerate(re.finditer(r"\S+ \S+", context)):
        rows.append(example(str(i), context, m.start(), m.group()))
    for r in W.label_spans(W.make_windows(frame(spark, *rows), SMALL)).collect():
        if r["end_position"]:
            s, e = r["offsets"][r["start_position"]]["start"], r["offsets"][r["end_position"]]["end"]
            assert r["answers"]["text"][0] in context[s:e]


def test_counts(sizes):
    row = W.feature_counts(sizes).first()
    assert (row["n_examples"], row["n_windows"], row["max_windows"]) == (8, 18, 7)


def test_reader_runs_once_per_window_and_in_batches(sizes):
    scored = score_windows(sizes, arithmetic_reader, batch_size=3)
    for r in scored.collect():
        assert r["start_logits"] == [((x * 31 + i * 17) % 1009) / 100 for i, x in enumerate(r["input_ids"])]
        assert r["end_logits"] == [((x * 37 + i * 23) % 1013) / 100 for i, x in enumerate(r["input_ids"])]
    used_twice = scored.select(
        F.size("start_logits").alias("a"), F.array_max("start_logits").alias("b"), F.array_max("end_logits")
    )
    plan = used_twice._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
