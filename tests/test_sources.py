import json

import pytest
from pyspark.sql import functions as F

from answerloom.config import TfidfConfig
from answerloom.operators.answers import postprocess
from answerloom.operators.block_max import block_max_topk
from answerloom.operators.ensemble import ensemble_pick, ensemble_votes
from answerloom.operators.passages import dedup_passages
from answerloom.operators.tfidf import fit_tfidf, only_parts, tfidf_topk, transform_queries
from answerloom.operators.vectors import build_ivf, ivf_topk
from answerloom.plans.answering import answer, evaluate
from answerloom.operators.reader import arithmetic_reader
from answerloom.sources import index_store as SI
from answerloom.sources import predictions as SP
from answerloom.sources.corpus import read_corpus, read_qa, write_qa

TEXTS = ["red apple", "blue sky", "red apple", "green hill über 😀"]


def test_json_dictionary_corpus(spark, tmp_path):
    for name, texts in (("a", TEXTS), ("b", TEXTS[:1])):
        body = {str(9 - i): {"text": t, "title": "x"} for i, t in enumerate(texts)}
        (tmp_path / f"{name}.json").write_text(json.dumps(body, ensure_ascii=False, indent=1))
    rows = read_corpus(spark, str(tmp_path), "json_dict")
    got = [r["text"] for r in rows.orderBy("doc_id").collect()]
    assert got == TEXTS + TEXTS[:1]
    assert rows.select("doc_id").distinct().count() == 5
    assert dedup_passages(rows).count() == 3


def test_line_and_column_corpus(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "n long, text string")
    df.write.json(str(tmp_path / "lines"))
    df.write.parquet(str(tmp_path / "cols"))
    for fmt, name in (("jsonl", "lines"), ("parquet", "cols")):
        got = read_corpus(spark, str(tmp_path / name), fmt, order="n").orderBy("doc_id").collect()
        assert [tuple(r) for r in got] == list(enumerate(TEXTS))
    with pytest.raises(ValueError):
        read_corpus(spark, str(tmp_path), "parquet")
    with pytest.raises(ValueError):
        read_corpus(spark, str(tmp_path), "csv", order="n")


def test_qa_splits(spark, tmp_path):
    df = spark.createDataFrame(
        [(0, ([1], ["x"]), "c", 5, "q1", "why", "t", "train"), (1, ([], []), "d", 6, "q2", "who", "u", "validation")],
        "__index_level_0__ long, answers struct<answer_start: array<bigint>, text: array<string>>, context string,"
        "document_id long, id string, question string, title string, split string",
    )
    paths = write_qa(df, str(tmp_path / "qa"), ("train", "validation"))
    got = {r["id"]: (r["split"], r["answers"]["text"]) for r in read_qa(spark, paths).collect()}
    assert got == {"q1": ("train", ["x"]), "q2": ("validation", [])}
    test = read_qa(spark, {"test": paths["train"]}, labelled=False)
    assert test.columns == ["id", "question", "split"] and test.count() == 1
    with pytest.raises(ValueError, match="validation"):
        read_qa(spark, {"train": paths["train"]})


def test_index_is_reused_until_something_changes(spark, tmp_path):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    passages = dedup_passages(docs)
    queries = spark.createDataFrame([(0, "red sky"), (1, "hill")], "id long, question string")
    cfg, path = TfidfConfig(), str(tmp_path / "index")

    def hits(index):
        rows = tfidf_topk(index, queries, 3).select("id", "pid", F.round("score", 9).alias("s"))
        return sorted(tuple(r) for r in rows.collect())

    fresh = hits(fit_tfidf(passages, cfg))
    assert hits(SI.load_or_build(passages, path, cfg)) == fresh
    before = spark.read.parquet(f"{path}/index_meta").first()["fingerprint"]
    written = sorted(p.name for p in (tmp_path / "index" / "vocab").iterdir())
    SI.load_or_build(passages.repartition(3), path, cfg)
    assert sorted(p.name for p in (tmp_path / "index" / "vocab").iterdir()) == written
    with pytest.raises(SI.StaleIndex):
        SI.load_index(spark, path, cfg, "other")
    more = passages.unionByName(spark.createDataFrame([(99, "red sky")], "pid long, text string"))
    changed = SI.load_or_build(more, path, cfg)
    assert spark.read.parquet(f"{path}/index_meta").first()["fingerprint"] != before
    assert (0, 99) in {h[:2] for h in hits(changed)}


def test_clustered_vectors_on_disk(spark, tmp_path):
    rows = [(i, [float(i % 3), float(i % 5)]) for i in range(30)]
    vectors = spark.createDataFrame(rows, "vec_id long, vec array<float>")
    queries = vectors.where("vec_id < 4").select(F.col("vec_id").alias("qid"), "vec")
    index, path = build_ivf(vectors, 3), str(tmp_path / "ivf")
    SI.save_ivf(index, path)
    stored = SI.load_ivf(spark, path)

    def hits(i):
        return sorted(tuple(r) for r in ivf_topk(i, queries, 4).select("qid", "vec_id", "rank").collect())

    assert hits(stored) == hits(index)


@pytest.fixture(scope="module")
def examples(spark):
    rows = [(str(i), "what is it", f"the answer {i} is here", ([4], [f"answer {i}"])) for i in range(4)]
    return spark.createDataFrame(
        rows, "id string, question string, context string,"
        "answers struct<answer_start: array<bigint>, text: array<string>>"
    )


def test_answer_files(spark, tmp_path, examples):
    predictions, nested = answer(examples, arithmetic_reader)
    paths = []
    for prefix in ("1", "2"):
        written = SP.write_predictions(predictions, nested, str(tmp_path), prefix)
        assert written["predictions"].endswith(f"predictions_{prefix}")
        paths.append(written["nbest_predictions"])
    with pytest.raises(Exception, match="exists"):
        SP.write_predictions(predictions, nested, str(tmp_path), "1")
    SP.write_predictions(predictions, nested, str(tmp_path), "1", mode="overwrite")
    with pytest.raises(ValueError):
        SP.write_predictions(predictions, nested, str(tmp_path), "1", mode="append")
    stacked = SP.read_nbest(spark, paths)
    assert {r["model"] for r in stacked.select("model").distinct().collect()} == {1, 2}
    picked = ensemble_pick(ensemble_votes(stacked))
    SP.write_ensemble(picked, str(tmp_path / "ensemble"))
    got = {r["id"]: r["prediction_text"] for r in spark.read.json(str(tmp_path / "ensemble")).collect()}
    assert set(got) == {"0", "1", "2", "3"}
    lists = {r["id"]: r["predictions"] for r in nested.collect()}
    for qid, text in got.items():
        votes = {}
        for p in lists[qid]:
            votes[p["text"]] = votes.get(p["text"], 0) + 2 * p["probability"]
        assert text == max(votes, key=lambda t: round(votes[t], 9))


def test_single_file_answer_lists(spark, tmp_path):
    entry = {"start_logit": 1.0, "end_logit": 2.0, "text": "x", "probability": 0.25}
    for k in (1, 2, 3):
        body = {"q": [entry, {**entry, "text": f"y{k}", "probability": 0.5}]}
        (tmp_path / f"nbest_{k}.json").write_text(json.dumps(body, indent=4))
    stacked = SP.read_nbest(spark, [str(tmp_path / f"nbest_{k}.json") for k in (1, 2, 3)], "json_dict")
    assert stacked.count() == 6
    best = ensemble_pick(ensemble_votes(stacked)).first()
    assert (best["text"], best["votes"]) == ("x", 0.75)


def test_metrics_file(spark, tmp_path, examples):
    metrics = evaluate(examples, arithmetic_reader)
    assert metrics.first()["n"] == 4
    from answerloom.operators.metrics import metric_rows

    path = str(tmp_path / "metrics")
    SP.write_metrics(metric_rows(metrics, "eval"), path)
    SP.write_metrics(metric_rows(metrics, "test"), path)
    lines = [r["line"] for r in SP.metric_lines(spark.read.parquet(path)).collect()]
    assert len(lines) == 6 and lines[2] == "eval_n = 4.0"


def test_null_odds_are_written(spark, tmp_path, examples):
    from answerloom.config import AnswerConfig
    from answerloom.plans.answering import scored_features

    cfg = AnswerConfig(allow_null=True)
    predictions, nested = postprocess(examples, scored_features(examples, arithmetic_reader), cfg)
    paths = SP.write_predictions(predictions, nested, str(tmp_path / "null"))
    odds = spark.read.json(paths["null_odds"])
    assert set(odds.columns) == {"id", "score_diff"} and odds.count() == 4


def test_index_settings_come_from_the_index(spark, tmp_path):
    from dataclasses import replace

    passages = spark.createDataFrame([(1, "red fox"), (2, "red dog")], "pid long, text string")
    cfg = TfidfConfig(max_features=None)
    SI.load_or_build(passages, str(tmp_path / "index"), cfg)
    assert SI.load_index(spark, str(tmp_path / "index"), cfg).vocab.count() > 0
    with pytest.raises(SI.StaleIndex):
        SI.load_index(spark, str(tmp_path / "index"), replace(cfg, max_n=1))
    # A rebuild that broke off leaves a meta row that fits no index.
    SI._write_meta(spark, str(tmp_path / "index"), cfg, "incomplete", "overwrite")
    with pytest.raises(SI.StaleIndex):
        SI.load_index(spark, str(tmp_path / "index"), cfg)
    with pytest.raises(ValueError, match="name the tokenizer"):
        SI.build_index(passages, str(tmp_path / "other"), cfg, "x", udf=lambda t: t)


def test_stored_clustered_tfidf_belongs_to_its_settings(spark, tmp_path):
    from answerloom.operators.tfidf import fit_tfidf
    from answerloom.operators.tfidf_ivf import build_tfidf_ivf, tfidf_ivf_topk

    passages = spark.createDataFrame([(i, f"word{i % 3} and word{i} here") for i in range(12)], "pid long, text string")
    asked = spark.createDataFrame([(0, "word1 here"), (1, "word7")], "id long, question string")
    ivf = build_tfidf_ivf(fit_tfidf(passages), passages, n_clusters=3)
    path = str(tmp_path / "ivf")
    SI.save_tfidf_ivf(ivf, path)
    loaded = SI.load_tfidf_ivf(spark, path, TfidfConfig(), 3)
    rows = [sorted(map(str, tfidf_ivf_topk(i, asked, 4, nprobe=2).select("id", "pid", "rank").collect())) for i in (ivf, loaded)]
    assert rows[0] == rows[1] and rows[0]
    for cfg, n in ((TfidfConfig(max_n=1), 3), (TfidfConfig(), 4)):
        with pytest.raises(SI.StaleIndex):
            SI.load_tfidf_ivf(spark, path, cfg, n)


def test_stored_postings_lie_in_term_ranges(spark, tmp_path):
    """A search of few terms opens few files; a frequent term spans several."""
    words = [f"w{i:03}" for i in range(300)]
    texts = [" ".join(["often", *words[i % 300 : i % 300 + 3]]) for i in range(600)]
    passages = spark.createDataFrame(list(enumerate(texts)), "pid long, text string")
    cfg = TfidfConfig(max_features=None, max_n=1)
    SI.build_index(passages, str(tmp_path / "index"), cfg, "x", file_postings=100)
    index = SI.load_index(spark, str(tmp_path / "index"), cfg)

    def files(kept):
        return kept.postings.select(F.input_file_name()).distinct().count()

    asked = spark.createDataFrame([(0, "w007"), (1, "w008")], "id long, question string")
    few = only_parts(index, transform_queries(index, asked))
    assert files(index) >= 20 and files(few) <= 3
    parts = {r["term"]: r["n"] for r in index.places.groupBy("term").agg(F.count("*").alias("n")).collect()}
    assert parts["often"] > 1
    fresh = fit_tfidf(passages, cfg)
    both = asked.unionByName(spark.createDataFrame([(2, "often w001"), (3, "unknown")], "id long, question string"))
    for found in (tfidf_topk(index, both, 5), block_max_topk(index, both, 5)):
        rows = found.select("id", "pid", "rank", F.round("score", 9))
        want = tfidf_topk(fresh, both, 5).select("id", "pid", "rank", F.round("score", 9))
        assert sorted(rows.collect()) == sorted(want.collect())
    assert only_parts(index, transform_queries(index, both.where("id = 3"))).postings.count() == 0


def test_block_maxima_lie_with_the_postings(spark, tmp_path):
    """Postings are written once, each block's largest weight on one of its rows; older files are not taken."""
    passages = spark.createDataFrame([(i, f"red apple w{i % 5} v{i}") for i in range(40)], "pid long, text string")
    for cfg in (TfidfConfig(), TfidfConfig(max_features=None)):
        path = str(tmp_path / f"index-{cfg.max_features}")
        SI.build_index(passages, path, cfg, "x")
        index = SI.load_index(spark, path, cfg, "x")
        assert all("/postings/" in file for file in index.tops.inputFiles())
        best = {}
        for r in index.postings.collect():
            key = (r["term"], r["block"])
            best[key] = max(best.get(key, 0.0), r["weight"])
        tops = index.tops.collect()
        assert {(r["term"], r["block"]): r["top"] for r in tops} == best and len(tops) == len(best)
        plain = {(r["term"], r["pid"], round(r["weight"], 9)) for r in fit_tfidf(passages, cfg).postings.collect()}
        assert {(r["term"], r["pid"], round(r["weight"], 9)) for r in index.postings.collect()} == plain
    meta = spark.read.schema(SI.META).parquet(f"{path}/index_meta").drop("layout").collect()
    old = spark.createDataFrame(meta, SI.META.rpartition(",")[0])
    old.write.mode("overwrite").parquet(f"{path}/index_meta")
    with pytest.raises(SI.StaleIndex):
        SI.load_index(spark, path, cfg, "x")


def test_a_built_index_leaves_no_words_or_weights_behind(spark, tmp_path):
    from pathlib import Path

    from answerloom.session import discard, stored, work_dir

    def folders():
        return {p.name for p in Path(work_dir(spark).removeprefix("file:")).iterdir()}

    passages = spark.createDataFrame([(1, "red fox"), (2, "red hen"), (3, "")], "pid long, text string")
    before = folders()
    index = SI.load_or_build(passages, str(tmp_path / "index"))
    assert index.postings.count() == 6
    assert not [n for n in folders() - before if n.startswith(("tokens-", "weights-"))]
    kept, gone = stored(passages, "kept one"), stored(passages, "gone")
    discard(gone)
    assert kept.count() == 3 and not [n for n in folders() - before if n.startswith("gone")]
