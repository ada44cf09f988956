from collections import Counter

import pytest
from pyspark.sql import functions as F

from answerloom.operators import ensemble as E
from answerloom.operators import metrics as M

REF = "id string, answers struct<answer_start: array<bigint>, text: array<string>>"


def scores(spark, cases):
    predictions = spark.createDataFrame(
        [(str(i), p) for i, (p, _) in enumerate(cases) if p is not None], "id string, prediction_text string"
    )
    references = spark.createDataFrame(
        [(str(i), ([0] * len(g), g)) for i, (_, g) in enumerate(cases)], REF
    )
    pairs = M.qa_pairs(predictions, references)
    rows = M.answer_scores(pairs).collect()
    return pairs, {int(r["id"]): (r["em"], r["f1"]) for r in rows}


def plain_f1(p, g):
    p, g = p.split(), g.split()
    same = sum((Counter(p) & Counter(g)).values())
    return 2 * same / (len(p) + len(g)) if same else 0.0


def test_scores(spark):
    cases = [
        ("The Cat!", ["cat"]),
        ("red red cat", ["red cat cat", "dog"]),
        ("", [""]),
        ("the", ["a"]),
        (None, ["cat"]),
        ("cat", []),
        ("a b c d b", ["b d e b b"]),
        ("Été 😀", ["été 😀"]),
    ]
    pairs, got = scores(spark, cases)
    assert got[0] == (1.0, 1.0)
    assert got[1] == (0.0, pytest.approx(plain_f1("red red cat", "red cat cat")))
    assert got[2] == (1.0, 0.0)
    assert got[3] == (1.0, 0.0)
    assert got[4] == (0.0, 0.0)
    assert got[5] == (0.0, 0.0)
    assert got[6] == (0.0, pytest.approx(plain_f1("b c d b", "b d e b b")))
    assert got[7] == (1.0, 1.0)
    total = M.squad_metrics(pairs).first()
    assert total["n"] == 8
    assert total["exact_match"] == pytest.approx(100 * 4 / 8)


def test_compare_runs(spark):
    rows = [("x", "1", "cat", ["cat"]), ("y", "1", "dog", ["cat"]), ("y", "2", "cat", ["cat"])]
    df = spark.createDataFrame(rows, "run string, id string, prediction_text string, golds array<string>")
    got = [(r["run"], r["exact_match"], r["n"]) for r in M.compare_runs(df).collect()]
    assert got == [("x", 100.0, 1), ("y", 50.0, 2)]


def nbest(spark, rows):
    return spark.createDataFrame(rows, "id string, rank int, text string, probability double")


def plain_vote(lists):
    votes = {}
    for rows in lists:
        for qid, _, text, p in rows:
            votes.setdefault(qid, {})
            votes[qid][text] = votes[qid].get(text, 0.0) + p
    return {qid: max(v, key=lambda t: round(v[t], 9)) for qid, v in votes.items()}


def test_vote(spark):
    lists = [
        [("1", 1, "a", 0.5), ("1", 2, "b", 0.3), ("1", 3, "a", 0.1), ("2", 1, "x", 0.4), ("2", 2, "", 0.2)],
        [("1", 1, "b", 0.3), ("2", 1, "y", 0.4), ("2", 2, "", 0.2), ("3", 1, "A", 0.5)],
        [("1", 1, "c", 0.6), ("2", 1, "", 0.1), ("3", 1, "a", 0.5)],
    ]
    votes = E.ensemble_votes(E.stack_nbest([nbest(spark, rows) for rows in lists]))
    got = {r["id"]: r["text"] for r in E.ensemble_pick(votes).collect()}
    assert got == plain_vote(lists) == {"1": "a", "2": "", "3": "A"}


def test_splits(spark):
    train = spark.createDataFrame([("1", "train"), ("2", "train")], "id string, split string")
    valid = spark.createDataFrame([("1", "validation")], "id string, split string")
    both = E.concat_splits(train, valid)
    assert both.count() == 3
    extra = valid.withColumn("id", F.lit("9"))
    got = sorted(tuple(r) for r in E.augment_train(both, extra).collect())
    assert got == [("1", "train"), ("1", "validation"), ("2", "train"), ("9", "train")]


def test_metric_rows(spark):
    one = spark.createDataFrame([(2, 0.5)], "n int, f1 double")
    got = [tuple(r) for r in M.metric_rows(one, "eval").collect()]
    assert got == [("eval_f1", 0.5), ("eval_n", 2.0)]
