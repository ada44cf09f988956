"""The registered queries: every operator on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import AnswerConfig, ReaderConfig, TfidfConfig
from ..functions.text import (
    clean_text,
    ngrams,
    normalize_answer,
    token_offsets,
    tokenize,
    tokenizer_udf,
)
from ..operators import answers as A
from ..operators import ensemble as E
from ..operators import metrics as M
from ..operators import reader as R
from ..operators import tfidf as S
from ..operators import vectors as V
from ..operators import windows as W
from ..operators.block_max import block_max_topk
from ..operators.bm25 import bm25_topk
from ..operators.passages import assign_passage_ids, corpus_stats, split_paragraphs
from ..operators.tfidf_ivf import build_tfidf_ivf
from ..plans import retrieval as P
from ..plans.answering import answer
from ..schemas import CORPUS_ENTRY
from ..session import new_path
from ..sources import corpus as SC
from ..sources import index_store as SI
from ..sources import json_dict as SD
from ..sources import predictions as SP
from . import fixtures as X

Query = Callable[[SparkSession, str], DataFrame]

TFIDF = TfidfConfig()
TOP = 10
NULLS = AnswerConfig(allow_null=True)
FEW = AnswerConfig(n_best_size=2, max_answer_length=3)


def _index(spark: SparkSession, sf: str) -> S.TfidfIndex:
    return S.fit_tfidf(X.passages(spark, sf), TFIDF)


def _unigram_tf(spark: SparkSession, sf: str) -> DataFrame:
    return S.term_freq(X.passages(spark, sf), "pid", "text", TFIDF)


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


# Sources and sinks ---------------------------------------------------------


def scan_corpus(spark, sf):
    return X.corpus(spark, sf)


def scan_corpus_dict(spark, sf):
    rows = X.corpus(spark, sf).select(F.col("doc_id").cast("string").alias("key"), F.struct("text").alias("entry"))
    path = new_path(spark, "corpus-dict")
    SD.write_dict(rows, "key", "entry", path)
    entries = SD.read_dict(spark, path, CORPUS_ENTRY)
    return entries.select(F.col("key").cast("long").alias("doc_id"), "value.text")


def scan_qa(spark, sf):
    table = X.qa_table(X.passages(spark, sf))
    paths = SC.write_qa(table, new_path(spark, "qa"), ("train", "validation"))
    return SC.read_qa(spark, paths).select(
        "split", "id", "question", "document_id", "title",
        F.get("answers.answer_start", F.lit(0)).alias("answer_start"),
        F.get("answers.text", F.lit(0)).alias("answer_text"),
        F.length("context").alias("n_chars"),
    )


def index_roundtrip(spark, sf):
    index = SI.load_or_build(X.passages(spark, sf), new_path(spark, "tfidf"), TFIDF)
    return _rounded(S.tfidf_topk(index, X.questions(spark, sf), TOP), "score").select(
        "id", "pid", "rank", "score"
    )


def ivf_roundtrip(spark, sf):
    vecs = X.vectors(spark, sf)
    path = new_path(spark, "ivf")
    SI.save_ivf(V.assign_clusters(vecs, X.label_means(vecs)), path)
    hits = V.ivf_topk(SI.load_ivf(spark, path), X.every_vector(vecs), TOP, nprobe=2)
    return _rounded(hits, "score")


def nbest_json(spark, sf):
    examples = X.qa_span(X.passages(spark, sf))
    features = X.logits(W.make_windows(examples))
    predictions, nested = A.postprocess(examples, features)
    paths = SP.write_predictions(predictions, nested, new_path(spark, "answers"))
    stored = SP.read_nbest(spark, [paths["nbest_predictions"]])
    return _rounded(stored, "probability").select("id", "rank", "text", "probability")


def _stored_nbest(spark, sf, fmt="jsonl"):
    folder = new_path(spark, "nbest")
    paths = []
    for number, rows in enumerate(X.nbest_lists(spark, sf), start=1):
        entry = F.struct(
            "rank", "text", F.lit(0.0).alias("start_logit"), F.lit(0.0).alias("end_logit"),
            "probability",
        )
        nested = rows.groupBy("id").agg(F.sort_array(F.collect_list(entry)).alias("predictions"))
        paths.append(f"{folder}/nbest_predictions_{number}")
        lists = SP.nested_nbest(nested)
        if fmt == "jsonl":
            lists.write.json(paths[-1])
        else:
            SD.write_dict(lists.withColumn("id", F.col("id").cast("string")), "id", "nbest", paths[-1])
    return SP.read_nbest(spark, paths, fmt)


def nbest_scan(spark, sf):
    return _stored_nbest(spark, sf)


def nbest_scan_dict(spark, sf):
    return _stored_nbest(spark, sf, "json_dict")


def vote_file(spark, sf):
    path = new_path(spark, "votes")
    SP.write_ensemble(E.ensemble_pick(E.ensemble_votes(_stored_nbest(spark, sf))), path)
    return spark.read.schema("id string, prediction_text string").json(path)


def metrics_table(spark, sf):
    pairs = M.qa_pairs(*X.pred_ref(spark, sf))
    path = new_path(spark, "metrics")
    SP.write_metrics(M.metric_rows(M.squad_metrics(pairs), "eval"), path)
    SP.write_metrics(M.metric_rows(W.feature_counts(X.windows(spark, sf)), "train"), path)
    return _rounded(spark.read.parquet(path), "value")


# Passages and text ---------------------------------------------------------


def dedup(spark, sf):
    return X.passages(spark, sf)


def passage_ids(spark, sf):
    numbered = assign_passage_ids(X.passages(spark, sf).select("pid"), "pid")
    return numbered.select("pid", "passage_id")


def tokens(spark, sf):
    words = tokenize(F.col("text"))
    return X.corpus(spark, sf).select("doc_id", F.posexplode(words).alias("pos", "token"))


def tokens_udf(spark, sf):
    by_blank = tokenizer_udf(lambda: lambda text: text.split(" "))
    split = X.corpus(spark, sf).select("doc_id", tokenize(F.col("text"), udf=by_blank).alias("t"))
    return split.select("doc_id", F.posexplode_outer("t").alias("pos", "token"))


def grams(spark, sf):
    terms = ngrams(tokenize(F.col("question")), 1, 2)
    return X.questions(spark, sf).select("id", F.posexplode(terms).alias("pos", "term"))


def term_freq(spark, sf):
    return _unigram_tf(spark, sf)


def vocab_topn(spark, sf):
    return S.build_vocab(_unigram_tf(spark, sf), TFIDF.max_features)


def idf(spark, sf):
    return _rounded(_index(spark, sf).vocab.select("term", "idf"), "idf")


def tfidf_weights(spark, sf):
    return _rounded(_index(spark, sf).postings, "weight")


def tfidf_query_vec(spark, sf):
    return _rounded(S.transform_queries(_index(spark, sf), X.questions(spark, sf)), "weight")


def clean(spark, sf):
    pages = X.table(spark, sf, "pages")
    return pages.select("page_id", clean_text(F.col("html")).alias("text"))


def paragraphs(spark, sf):
    return split_paragraphs(X.corpus(spark, sf))


def stats(spark, sf):
    return _rounded(
        corpus_stats(X.corpus(spark, sf)), "mean_chars", "median_chars", "p95_chars"
    )


# Retrieval -----------------------------------------------------------------


def tfidf_single(spark, sf):
    one = X.questions(spark, sf).agg(
        F.min("id").alias("id"), F.min_by("question", "id").alias("question")
    )
    return _rounded(S.tfidf_topk(_index(spark, sf), one, TOP), "score")


def tfidf_scores(spark, sf):
    return _rounded(S.score(_index(spark, sf), X.questions(spark, sf)), "score")


def tfidf_topk_blocks(spark, sf):
    """The same search in a stored index, by block maxima."""
    index = SI.load_or_build(X.passages(spark, sf), new_path(spark, "tfidf"), TFIDF)
    return _rounded(block_max_topk(index, X.questions(spark, sf), TOP), "score").select("id", "pid", "rank", "score")


def tfidf_topk(spark, sf):
    hits = S.tfidf_topk(_index(spark, sf), X.questions(spark, sf), TOP)
    return _rounded(hits, "score").select("id", "pid", "rank", "score")


def bm25(spark, sf):
    hits = bm25_topk(X.passages(spark, sf), X.questions(spark, sf), TOP)
    return _rounded(hits, "score").select("id", "pid", "rank", "score")


def _retrieved(spark, sf, k):
    passages = X.passages(spark, sf)
    asked = X.labelled_questions(spark, sf)
    return P.retrieve(S.fit_tfidf(passages, TFIDF), passages, asked, k)


def retrieve_context(spark, sf):
    return _retrieved(spark, sf, TOP).select(
        "id", "question",
        F.array_join(F.col("context_ids").cast("array<string>"), ",").alias("context_ids"),
        F.round(F.aggregate("scores", F.lit(0.0), lambda a, s: a + s), 6).alias("score_sum"),
        "context", "original_context",
        F.get("answers.answer_start", F.lit(0)).alias("answer_start"),
    )


def reader_input(spark, sf):
    rows = P.reader_input(_retrieved(spark, sf, TOP), "eval")
    return rows.select(
        "id", "question", "context",
        F.get("answers.answer_start", F.lit(0)).alias("answer_start"),
        F.get("answers.text", F.lit(0)).alias("answer_text"),
    )


def oov_queries(spark, sf):
    parts = X.table(spark, sf, "part").select(
        (-F.col("p_partkey") - 1).alias("id"), F.col("p_name").alias("question")
    )
    asked = X.questions(spark, sf).unionByName(parts)
    return S.oov_queries(_index(spark, sf), asked)


def retrieval_hit_rate(spark, sf):
    passages, asked = X.passages(spark, sf), X.questions(spark, sf)
    gold = X.planted_gold(asked, passages)
    hits = S.tfidf_topk(S.fit_tfidf(passages, TFIDF), asked, TOP)
    return _rounded(P.hit_rate(hits, gold, [1, 5, 10]), "rate")


def vector_topk_l2(spark, sf):
    vecs = X.vectors(spark, sf)
    return _rounded(V.vector_topk(vecs, X.every_vector(vecs), TOP, "l2"), "score")


def vector_topk_ip(spark, sf):
    vecs = X.vectors(spark, sf)
    return _rounded(V.vector_topk(vecs, X.every_vector(vecs), TOP, "ip"), "score")


def ivf_trained(spark, sf):
    index = V.build_ivf(X.vectors(spark, sf), seed=42)
    return index.vectors.select("vec_id", "cluster")


def ivf_assign(spark, sf):
    """Given centroids, grouped around pivots as if they were too many to broadcast."""
    vecs = X.vectors(spark, sf)
    return V.assign_clusters(vecs, X.label_means(vecs), limit=0).vectors.select("vec_id", "cluster")


def ivf_topk(spark, sf):
    vecs = X.vectors(spark, sf)
    index = V.assign_clusters(vecs, X.label_means(vecs))
    return _rounded(V.ivf_topk(index, X.every_vector(vecs), TOP, nprobe=2), "score")


def ivf_codes_topk(spark, sf):
    """Lists of packed 4-bit codes, written and read back; the best 40 are ranked exactly."""
    vecs = X.vectors(spark, sf)
    path = new_path(spark, "ivf-codes")
    SI.save_ivf(V.with_codes(V.assign_clusters(vecs, X.label_means(vecs)), 4), path)
    index = SI.load_ivf(spark, path, coded=True)
    return _rounded(V.ivf_topk(index, X.every_vector(vecs), TOP, nprobe=2, refine=4), "score")


def vector_topk_pivots(spark, sf):
    """Exact neighbours of every vector by groups around pivots."""
    vecs = X.vectors(spark, sf)
    return _rounded(V.vector_topk(vecs, X.every_vector(vecs), TOP, "l2", limit=0), "score")


def vector_topk_ip_pivots(spark, sf):
    vecs = X.vectors(spark, sf)
    return _rounded(V.vector_topk(vecs, X.every_vector(vecs), TOP, "ip", limit=0), "score")


def _contexts(found: DataFrame) -> DataFrame:
    return found.select(
        "id", F.array_join(F.col("context_ids").cast("array<string>"), ",").alias("context_ids"),
        "context",
    )


def _given_lists(spark, sf):
    passages = X.passages(spark, sf)
    index = S.fit_tfidf(passages, TFIDF, write=True)
    return passages, build_tfidf_ivf(index, passages, 8, centers=X.passage_centers(index.postings, 8))


def ivf_retrieve(spark, sf):
    """Two lists probed of those around eight passages."""
    passages, ivf = _given_lists(spark, sf)
    return _contexts(P.retrieve_clustered(ivf, passages, X.questions(spark, sf), nprobe=2))


def ivf_tfidf_roundtrip(spark, sf):
    passages, ivf = _given_lists(spark, sf)
    path = new_path(spark, "tfidf-ivf")
    SI.save_tfidf_ivf(ivf, path)
    loaded = SI.load_tfidf_ivf(spark, path, TFIDF, 8)
    return _contexts(P.retrieve_clustered(loaded, passages, X.questions(spark, sf), nprobe=2))


def ivf_retrieve_trained(spark, sf):
    passages, asked = X.passages(spark, sf), X.questions(spark, sf)
    ivf = build_tfidf_ivf(S.fit_tfidf(passages, TFIDF, write=True), passages)
    return _contexts(P.retrieve_clustered(ivf, passages, asked))


def ivf_retrieve_all(spark, sf):
    """Every list probed, so the result is that of an exhaustive search."""
    passages, asked = X.passages(spark, sf), X.questions(spark, sf)
    ivf = build_tfidf_ivf(S.fit_tfidf(passages, TFIDF, write=True), passages)
    return _contexts(P.retrieve_clustered(ivf, passages, asked, nprobe=ivf.n_clusters))


def ivf_assign_means(spark, sf):
    vecs = X.vectors(spark, sf)
    return V.assign_clusters(vecs, X.label_means(vecs)).vectors.select("vec_id", "cluster")


def quantize_sq(spark, sf):
    coded = V.quantize(X.vectors(spark, sf), bits=4)
    return coded.select("vec_id", F.posexplode_outer("codes").alias("dim", "code"))


# Reader features -----------------------------------------------------------


def offsets(spark, sf):
    spans = X.passages(spark, sf).select("pid", F.posexplode(token_offsets(F.col("text"))).alias("pos", "o"))
    return spans.select("pid", "pos", F.col("o.start").alias("start_char"), F.col("o.end").alias("end_char"))


def windows(spark, sf):
    return X.windows(spark, sf).select(
        "example_id", "window_no", "first_token", "n_context",
        F.size("input_ids").alias("n_input"), "text_start", "window_text",
    )


def mask_offsets(spark, sf):
    masked = W.mask_offsets(X.windows(spark, sf)).select(
        "example_id", "window_no", F.posexplode_outer("offsets").alias("place", "o")
    )
    return masked.select(
        "example_id", "window_no", "place",
        F.col("o.start").alias("start_char"), F.col("o.end").alias("end_char"),
    )


def pad_windows(spark, sf):
    padded = W.pad_windows(X.windows(spark, sf))
    return padded.select(
        "example_id", "window_no",
        F.size("input_ids").alias("n_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_attended"),
        F.aggregate(
            "input_ids", F.lit(0).cast("long"), lambda a, x: a + x.cast("long")
        ).alias("id_sum"),
    )


def label_spans(spark, sf):
    return W.label_spans(X.windows(spark, sf)).select(
        "example_id", "window_no", "start_position", "end_position"
    )


def feature_counts(spark, sf):
    return W.feature_counts(X.windows(spark, sf))


def score_windows(spark, sf):
    scored = R.score_windows(X.windows(spark, sf), R.arithmetic_reader)

    def total(name):
        return F.round(F.aggregate(name, F.lit(0.0), lambda a, x: a + x), 6)

    return scored.select(
        "example_id", "window_no",
        F.size("start_logits").alias("n_logits"),
        total("start_logits").alias("start_sum"),
        total("end_logits").alias("end_sum"),
        F.round(F.array_max("start_logits"), 6).alias("start_max"),
        F.round(F.array_max("end_logits"), 6).alias("end_max"),
    )


# Answers -------------------------------------------------------------------


def _scored(spark, sf):
    examples = X.qa_span(X.passages(spark, sf))
    return examples, X.logits(W.make_windows(examples))


def feature_logit_anti(spark, sf):
    examples, features = _scored(spark, sf)
    # Logits exist for first windows only, so every later window is reported.
    stored = features.groupBy("example_id").agg(F.min("window_no").alias("window_no"))
    return R.unmatched_features(features, stored)


def features_per_example(spark, sf):
    return A.features_per_example(*_scored(spark, sf))


def null_score(spark, sf):
    _, features = _scored(spark, sf)
    return _rounded(A.null_scores(features), "null_score", "start_logit", "end_logit")


def top_positions(spark, sf):
    _, features = _scored(spark, sf)
    top = A.top_positions(features, AnswerConfig().n_best_size)
    return top.select(
        "example_id", "window_no", F.posexplode_outer("start_top").alias("at", "p")
    ).select(
        "example_id", "window_no", (F.col("at") + 1).alias("rank"),
        "p.place", F.round("p.logit", 6).alias("logit"),
    )


def candidate_spans(spark, sf):
    _, features = _scored(spark, sf)
    spans = A.candidate_spans(features)
    return _rounded(spans, "score").select(
        "example_id", "window_no", "start_rank", "end_rank", "start_char", "end_char", "score"
    )


def nbest(spark, sf):
    _, features = _scored(spark, sf)
    return _rounded(A.best_spans(features), "score").select(
        "example_id", "rank", "window_no", "start_char", "end_char", "score", "text"
    )


def nbest_null(spark, sf):
    rows = A.flat_nbest(A.nbest(*_scored(spark, sf), NULLS))
    return _rounded(rows, "start_logit", "end_logit", "probability")


def nbest_empty(spark, sf):
    # So few positions that most windows allow no span at all.
    rows = A.flat_nbest(A.nbest(*_scored(spark, sf), FEW))
    return _rounded(rows, "start_logit", "end_logit", "probability")


def nbest_softmax(spark, sf):
    rows = A.flat_nbest(A.nbest(*_scored(spark, sf)))
    return _rounded(rows, "start_logit", "end_logit", "probability")


def best_answer(spark, sf):
    return A.best_answer(A.nbest(*_scored(spark, sf)))


def best_answer_null(spark, sf):
    nested = A.nbest(*_scored(spark, sf), NULLS)
    return _rounded(A.best_answer_or_null(nested, -3.0), "score_diff")


def answer_pipeline(spark, sf):
    examples = X.qa_span(X.passages(spark, sf))
    predictions, _ = answer(examples, R.arithmetic_reader)
    scores = M.answer_scores(M.qa_pairs(predictions, examples))
    return _rounded(scores.join(predictions, "id"), "em", "f1")


# Metrics, votes, unions ----------------------------------------------------


def qa_pairs(spark, sf):
    pairs = M.qa_pairs(*X.pred_ref(spark, sf))
    return pairs.select("id", "prediction_text", F.posexplode("golds").alias("gold_no", "gold"))


def normalized(spark, sf):
    return X.corpus(spark, sf).select("doc_id", normalize_answer(F.col("text")).alias("text"))


def squad_em(spark, sf):
    pairs = M.qa_pairs(*X.pred_ref(spark, sf))
    return _rounded(M.squad_metrics(pairs).select("exact_match", "n"), "exact_match")


def squad_f1(spark, sf):
    pairs = M.qa_pairs(*X.pred_ref(spark, sf))
    return _rounded(M.answer_scores(pairs), "em", "f1")


def compare_runs(spark, sf):
    predictions, references = X.pred_ref(spark, sf)
    swapped = X.turn_pairs(spark, sf).select("id", F.col("replied").alias("prediction_text"))
    runs = [
        M.qa_pairs(p, references).withColumn("run", F.lit(name))
        for name, p in (("asked", predictions), ("replied", swapped))
    ]
    return _rounded(M.compare_runs(E.concat_splits(*runs)), "exact_match", "f1")


def ensemble_votes(spark, sf):
    votes = E.ensemble_votes(E.stack_nbest(X.nbest_lists(spark, sf)))
    return _rounded(votes, "votes").select(
        "id", "text", "votes",
        F.col("first_seen.model").alias("first_model"), F.col("first_seen.rank").alias("first_rank"),
    )


def ensemble_pick(spark, sf):
    picked = E.ensemble_pick(E.ensemble_votes(_stored_nbest(spark, sf)))
    return _rounded(picked, "votes")


def concat_splits(spark, sf):
    table = X.qa_table(X.passages(spark, sf))
    train, validation = (table.where(F.col("split") == s) for s in ("train", "validation"))
    return E.concat_splits(train, validation).select("id", "question", "split")


def augment_union(spark, sf):
    table = X.qa_table(X.passages(spark, sf))
    extra = table.where(F.col("split") == "train").withColumns(
        {
            "id": F.concat(F.lit("extra-"), "id"),
            "question": F.concat(F.lit("tell me "), "question"),
        }
    )
    return E.augment_train(table, extra).select("id", "question", "split")


QUERIES: dict[str, Query] = {
    "scan_corpus": scan_corpus,
    "scan_corpus_dict": scan_corpus_dict,
    "scan_qa": scan_qa,
    "index_roundtrip": index_roundtrip,
    "ivf_roundtrip": ivf_roundtrip,
    "nbest_json": nbest_json,
    "nbest_scan": nbest_scan,
    "nbest_scan_dict": nbest_scan_dict,
    "vote_file": vote_file,
    "metrics_table": metrics_table,
    "dedup_passages": dedup,
    "passage_ids": passage_ids,
    "reader_input": reader_input,
    "mask_offsets": mask_offsets,
    "feature_logit_anti": feature_logit_anti,
    "tokenize": tokens,
    "tokenize_udf": tokens_udf,
    "ngrams": grams,
    "term_freq": term_freq,
    "vocab_topn": vocab_topn,
    "idf": idf,
    "tfidf_weights": tfidf_weights,
    "tfidf_query_vec": tfidf_query_vec,
    "bm25_topk": bm25,
    "clean_text": clean,
    "split_paragraphs": paragraphs,
    "corpus_stats": stats,
    "tfidf_single": tfidf_single,
    "tfidf_scores": tfidf_scores,
    "tfidf_topk": tfidf_topk,
    "tfidf_topk_blocks": tfidf_topk_blocks,
    "retrieve_context": retrieve_context,
    "oov_queries": oov_queries,
    "retrieval_hit_rate": retrieval_hit_rate,
    "vector_topk_l2": vector_topk_l2,
    "vector_topk_ip": vector_topk_ip,
    "ivf_assign": ivf_assign,
    "ivf_topk": ivf_topk,
    "ivf_retrieve": ivf_retrieve,
    "ivf_retrieve_all": ivf_retrieve_all,
    "ivf_trained": ivf_trained,
    "ivf_codes_topk": ivf_codes_topk,
    "ivf_tfidf_roundtrip": ivf_tfidf_roundtrip,
    "ivf_retrieve_trained": ivf_retrieve_trained,
    "vector_topk_pivots": vector_topk_pivots,
    "vector_topk_ip_pivots": vector_topk_ip_pivots,
    "ivf_assign_means": ivf_assign_means,
    "quantize_sq": quantize_sq,
    "windows": windows,
    "token_offsets": offsets,
    "pad_windows": pad_windows,
    "label_spans": label_spans,
    "feature_counts": feature_counts,
    "score_windows": score_windows,
    "features_per_example": features_per_example,
    "null_score": null_score,
    "top_positions": top_positions,
    "candidate_spans": candidate_spans,
    "nbest": nbest,
    "nbest_null": nbest_null,
    "nbest_empty": nbest_empty,
    "nbest_softmax": nbest_softmax,
    "best_answer": best_answer,
    "best_answer_null": best_answer_null,
    "answer_pipeline": answer_pipeline,
    "qa_pairs": qa_pairs,
    "normalize_answer": normalized,
    "squad_em": squad_em,
    "squad_f1": squad_f1,
    "compare_runs": compare_runs,
    "ensemble_votes": ensemble_votes,
    "ensemble_pick": ensemble_pick,
    "concat_splits": concat_splits,
    "augment_union": augment_union,
}
