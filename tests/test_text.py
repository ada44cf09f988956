import hashlib
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from answerloom.functions.arrays import prefix_sum, run_lengths
from answerloom.functions.text import (
    hashed_words,
    clean_text,
    ngrams,
    normalize_answer,
    term_counts,
    text_pieces,
    token_ids,
    token_offsets,
    tokenize,
    tokenizer_udf,
    word_spans,
)

TEXTS = [
    "", " ", "a", "  lead and\ttrail  ", "one\n\ntwo", "aé😀b 😀 ñandú", "x " * 700 + "y",
    "The the THE end", "a,b;c",
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")


def test_offsets_equal_plain_python(texts):
    got = texts.select("text", token_offsets(F.col("text")).alias("o")).collect()
    for row in got:
        want = [m.span() for m in re.finditer(r"\S+", row["text"])]
        assert [(o["start"], o["end"]) for o in row["o"]] == want
        assert all(row["text"][o["start"] : o["end"]].strip() for o in row["o"])


def test_words_of_many_texts_at_once():
    """Spans and ids found on the bytes of a batch, also of nulls, odd blanks and runs cut between rows."""
    rows = [None, *TEXTS, None, "a\u00a0b\x1cc \x0bd", "\u3000x", " ", "last"] * 3
    for texts in (pa.array(rows), pa.array(rows).slice(2, 7), pa.array([None, "a b", None]), pa.array([], pa.string())):
        want = [None if t is None else list(re.finditer(r"[^ \t-\r]+", t)) for t in texts.to_pylist()]
        spans = [w and [{"start": m.start(), "end": m.end()} for m in w] for w in want]
        ids = [w and [int(hashlib.md5(m.group().encode()).hexdigest()[:7], 16) % 97 + 3 for m in w] for w in want]
        assert word_spans(texts).to_pylist() == spans
        assert hashed_words(texts, 100, 3).to_pylist() == ids
    pieces = list(text_pieces(pa.array(["ab", "", "cdef", "g", "x" * 9]), most=4))
    assert [(bytes(d), list(b)) for d, b in pieces] == [
        (b"ab", [0, 2, 2]), (b"cdef", [0, 4]), (b"g", [0, 1]), (b"x" * 9, [0, 9])
    ]


def test_spans_and_ids_are_not_interpreted_word_by_word(texts):
    plan = texts.select(token_offsets(F.col("text")), token_ids(F.col("text"), 100, 3))._jdf.queryExecution().toString()
    assert "lambda" not in plan and "ArrowEvalPython" in plan


def test_ngrams_up_to_three(texts):
    got = texts.select("text", ngrams(tokenize(F.col("text")), 1, 3).alias("g")).collect()
    for row in got:
        words = re.findall(r"[^\W_]+", row["text"].lower())
        want = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
        assert row["g"] == want


def test_term_counts(texts):
    got = texts.select("text", term_counts(tokenize(F.col("text")), 1, 2).alias("c")).collect()
    for row in got:
        words = re.findall(r"[^\W_]+", row["text"].lower())
        want = Counter(words) + Counter(" ".join(p) for p in zip(words, words[1:]))
        assert {c["value"]: c["n"] for c in row["c"]} == want


def test_array_helpers_on_edges(spark):
    df = spark.createDataFrame([([],), ([5],), ([1] * 33,), (list(range(40)),)], "a array<int>")
    rows = df.select("a", prefix_sum(F.col("a")).alias("p"), run_lengths(F.col("a")).alias("r"))
    for row in rows.collect():
        total, want = 0, []
        for x in row["a"]:
            total += x
            want.append(total)
        assert row["p"] == want
        assert {r["value"]: r["n"] for r in row["r"]} == Counter(row["a"])


def test_tokenizers(texts, spark):
    own = tokenizer_udf(lambda: lambda text: list(text))
    row = texts.where("i = 7").select(
        tokenize(F.col("text"), "space").alias("space"), tokenize(F.col("text"), udf=own).alias("own")
    ).first()
    assert row["space"] == ["the", "the", "the", "end"]
    assert row["own"] == list("the the the end")
    with pytest.raises(ValueError):
        tokenize(F.col("text"), "unknown")


def test_normalize_answer(spark):
    cases = {
        "The  quick, brown fox!": "quick brown fox",
        "a an the": "",
        "An apple a day": "apple day",
        "theory": "theory",
        "é the é": "é é",
        "": "",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    for row in df.select("t", normalize_answer(F.col("t")).alias("n")).collect():
        assert row["n"] == cases[row["t"]]


def test_clean_text(spark):
    df = spark.createDataFrame([("<p>One<script>x()</script> &amp;\n two</p>",)], "t string")
    assert df.select(clean_text(F.col("t")).alias("c")).first()["c"] == "One two"
    own = df.select(clean_text(F.col("t"), [("<[^>]*>", "")]).alias("c")).first()["c"]
    assert own.startswith("Onex()")
