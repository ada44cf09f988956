import math
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from answerloom.config import Bm25Config, TfidfConfig
from answerloom.functions.text import tokenizer_udf
from answerloom.operators import block_max
from answerloom.operators.bm25 import bm25_topk, build_bm25, load_bm25
from answerloom.operators.passages import assign_passage_ids, dedup_passages, split_paragraphs
from answerloom.operators.sizing import query_blocks
from answerloom.operators.tfidf import (
    build_vocab,
    fit_tfidf,
    oov_queries,
    score,
    score_order,
    term_freq,
    tfidf_topk,
    transform_queries,
)
from answerloom.operators.tfidf_ivf import build_tfidf_ivf, tfidf_ivf_topk
from answerloom.plans.retrieval import hit_rate, reader_input, retrieve
from answerloom.sources.index_store import build_index, load_index

DOCS = [
    (3, "red apple pie"), (1, "green apple tree"), (7, "red red wine"), (4, "red apple pie"),
    (5, "blue sky over green hills"), (9, "the sky is blue"), (8, "apple apple apple"),
]
QUERIES = [(0, "red apple"), (1, "blue sky"), (2, "zebra quagga"), (3, "green"), (4, "wine pie")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string")


@pytest.fixture(scope="module")
def passages(docs):
    return dedup_passages(docs)


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(QUERIES, "id long, question string")


def plain_tfidf(k, max_features=50_000):
    """Brute force over a dict of the distinct texts."""
    def terms(text):
        w = text.split()
        return Counter(w) + Counter(" ".join(p) for p in zip(w, w[1:]))

    first = {}
    for doc_id, text in sorted(DOCS):
        first.setdefault(text, doc_id)
    tf = {pid: terms(text) for text, pid in first.items()}
    totals = sum(tf.values(), Counter())
    vocab = [t for t, _ in sorted(totals.items(), key=lambda x: (-x[1], x[0]))][:max_features]
    idf = {t: math.log((1 + len(tf)) / (1 + sum(t in c for c in tf.values()))) + 1 for t in vocab}

    def unit(counts):
        raw = {t: n * idf[t] for t, n in counts.items() if t in idf}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        return {t: x / norm for t, x in raw.items()}

    weights = {pid: unit(c) for pid, c in tf.items()}
    hits = []
    for qid, question in QUERIES:
        q = unit(terms(question))
        scored = [
            (pid, sum(x * w[t] for t, x in q.items() if t in w))
            for pid, w in weights.items() if set(q) & set(w)
        ]
        scored.sort(key=lambda x: (-round(x[1], 9), x[0]))
        hits += [(qid, pid, r, round(s, 6)) for r, (pid, s) in enumerate(scored[:k], 1)]
    return sorted(hits)


def collected(hits):
    rows = hits.select("id", "pid", "rank", F.round("score", 6).alias("score")).collect()
    return sorted(tuple(r) for r in rows)


def test_dedup_keeps_lowest_id(passages):
    assert {r["pid"]: r["text"] for r in passages.collect()} == {
        i: t for i, t in DOCS if i != 4
    }


def test_passage_ids_are_dense_for_any_number_of_ranges(passages):
    for buckets in (1, 2, 5, 50):
        numbered = assign_passage_ids(passages.select("pid"), "pid", buckets)
        got = {r["pid"]: r["passage_id"] for r in numbered.collect()}
        assert got == {pid: i for i, pid in enumerate([1, 3, 5, 7, 8, 9])}


@pytest.mark.parametrize("max_features", [3, 7, 50_000])
def test_tfidf_equals_brute_force(passages, queries, max_features):
    index = fit_tfidf(passages, TfidfConfig(max_features=max_features))
    assert collected(tfidf_topk(index, queries, 3)) == plain_tfidf(3, max_features)


def test_vocab_cut_inside_a_tie_goes_by_term(passages):
    tf = term_freq(passages, "pid", "text", TfidfConfig(min_n=1, max_n=1))
    got = [r["term"] for r in build_vocab(tf, 4).orderBy(F.desc("ctf"), "term").collect()]
    assert got == ["apple", "red", "blue", "green"]


def test_unknown_terms_vanish_and_are_reported(passages, queries):
    index = fit_tfidf(passages)
    assert [r["id"] for r in oov_queries(index, queries).collect()] == [2]
    norms = transform_queries(index, queries).groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("n"))
    assert {r["id"] for r in norms.collect()} == {0, 1, 3, 4}
    assert all(abs(r["n"] - 1) < 1e-12 for r in norms.collect())


def test_many_query_blocks_give_the_same_hits(passages, queries):
    index = fit_tfidf(passages)
    row_bytes = F.octet_length("question").cast("long") + 200
    assert len(query_blocks(queries, "id", row_bytes, 10**9)) == 1
    blocks = query_blocks(queries, "id", row_bytes, 450)
    assert len(blocks) > 1
    assert sum(b.count() for b in blocks) == len(QUERIES)
    assert collected(tfidf_topk(index, queries, 3, limit=450)) == plain_tfidf(3)
    with pytest.raises(ValueError):
        query_blocks(queries, "id", row_bytes, 10)


def test_large_query_sets_meet_postings_by_term_in_one_plan(passages, queries, monkeypatch):
    """Without room to broadcast, hot terms are cut into slices and no hit changes."""
    monkeypatch.setattr("answerloom.operators.tfidf.SLICE_ROWS", 1)
    index = fit_tfidf(passages)
    plain = bm25_topk(passages, queries, 3)
    assert collected(tfidf_topk(index, queries, 3, limit=0)) == plain_tfidf(3)
    assert collected(bm25_topk(passages, queries, 3, limit=0)) == collected(plain)
    found = {r["id"]: r["context_ids"] for r in retrieve(index, passages, queries, 2, limit=0).collect()}
    assert found == {r["id"]: r["context_ids"] for r in retrieve(index, passages, queries, 2).collect()}
    many = queries.select("question", F.explode(F.sequence(F.col("id") * 1000, F.col("id") * 1000 + 200)).alias("id"))

    def joins(asked):
        plan = tfidf_topk(index, asked, 3, limit=0)._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("Join")

    assert joins(many) == joins(queries)


@pytest.mark.parametrize("bits,limit", [(0, 1 << 26), (1, 0), (6, 1 << 26)])
def test_block_maxima_find_the_same_hits(spark, passages, queries, tmp_path, monkeypatch, bits, limit):
    monkeypatch.setattr(block_max, "FIRST_BLOCKS", 1)
    monkeypatch.setattr("answerloom.operators.tfidf.SLICE_ROWS", 1 if limit == 0 else 10**6)
    monkeypatch.setattr(block_max.passage_blocks, "__defaults__", (bits,))
    cfg = TfidfConfig()
    build_index(passages, str(tmp_path / "index"), cfg, "x")
    index = load_index(spark, str(tmp_path / "index"), cfg)
    for k in (1, 2, 3, 20):
        assert collected(block_max.block_max_topk(index, queries, k, limit)) == plain_tfidf(k)
    monkeypatch.setattr("answerloom.plans.retrieval.MANY_POSTINGS", 0)
    by_blocks = {r["id"]: r["context"] for r in retrieve(index, passages, queries, 2, limit).collect()}
    assert by_blocks == {r["id"]: r["context"] for r in retrieve(fit_tfidf(passages), passages, queries, 2).collect()}
    assert block_max.block_max_topk(index, queries.limit(0), 2, limit).count() == 0
    with pytest.raises(ValueError, match="block maxima"):
        block_max.block_max_topk(fit_tfidf(passages), queries)


def test_blocks_below_the_floor_are_not_scored(spark, tmp_path):
    """Questions share frequent words with every passage, and few can be among the best."""
    texts = [f"the a of topic{i % 50} word{i % 50} thing{i} more{i % 7}" for i in range(1000)]
    passages = spark.createDataFrame(list(enumerate(texts)), "pid long, text string")
    asked = spark.createDataFrame([(i, f"the a of topic{i} word{i}") for i in range(20)], "id long, question string")
    cfg = TfidfConfig(max_features=None, max_n=1)
    build_index(passages, str(tmp_path / "index"), cfg, "x")
    index = load_index(spark, str(tmp_path / "index"), cfg)
    vectors = transform_queries(index, asked).withColumnRenamed("weight", "q_weight")
    bounds = block_max.block_bounds(index, vectors, True)
    first = block_max.top_k(bounds, "id", [F.desc("bound"), F.asc("block")], 8).select("id", "block")
    scored = block_max._scored(index, vectors, first, 1 << 26)
    rest = block_max.surviving_blocks(bounds, first, block_max.top_k(scored, "id", score_order(), 5), 5)
    rows = scored.count() + block_max._scored(index, vectors, rest, 1 << 26).count()
    pairs = score(index, asked).count()
    assert pairs == 20 * 1000 and rows < pairs / 10
    assert collected(block_max.block_max_topk(index, asked, 5)) == collected(tfidf_topk(index, asked, 5))


def test_stored_bm25_index(spark, passages, queries, tmp_path):
    build_bm25(passages, str(tmp_path / "bm25"))
    again = load_bm25(spark, str(tmp_path / "bm25"))
    assert collected(bm25_topk(again, queries, 2)) == collected(bm25_topk(passages, queries, 2))
    empty = build_bm25(passages.limit(0))
    assert bm25_topk(empty, queries, 2).count() == 0


def test_bm25_equals_brute_force(passages, queries):
    k1, b = 1.2, 0.6
    texts = {pid: t.split() for pid, t in sorted((min(i for i, x in DOCS if x == t), t) for _, t in DOCS)}
    n, avg = len(texts), sum(map(len, texts.values())) / len(texts)
    want = []
    for qid, question in QUERIES:
        scored = []
        for pid, words in texts.items():
            shared = set(question.split()) & set(words)
            if shared:
                score = 0.0
                for t in shared:
                    df, tf = sum(t in w for w in texts.values()), words.count(t)
                    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
                    score += idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(words) / avg))
                scored.append((pid, score))
        scored.sort(key=lambda x: (-round(x[1], 9), x[0]))
        want += [(qid, pid, r, round(s, 6)) for r, (pid, s) in enumerate(scored[:2], 1)]
    cfg = Bm25Config(k1, b)
    assert collected(bm25_topk(passages, queries, 2, cfg)) == sorted(want)
    assert collected(bm25_topk(passages, queries, 2, cfg, limit=400)) == sorted(want)


def test_retrieve_keeps_every_query_and_gold(passages, queries):
    gold = queries.withColumns(
        {"context": F.lit("gold"), "answers": F.struct(
            F.array(F.lit(0).cast("long")).alias("answer_start"), F.array(F.lit("x")).alias("text"))}
    )
    rows = {r["id"]: r for r in retrieve(fit_tfidf(passages), passages, gold, 2).collect()}
    assert set(rows) == {0, 1, 2, 3, 4}
    assert rows[2]["context"] == "" and rows[2]["context_ids"] == []
    texts = {i: t for i, t in DOCS}
    for qid in rows:
        best = [pid for q, pid, rank, _ in plain_tfidf(2) if q == qid]
        best.sort(key=[h[1] for h in sorted(plain_tfidf(2), key=lambda h: h[2]) if h[0] == qid].index)
        assert rows[qid]["context_ids"] == best
        assert rows[qid]["context"] == " ".join(texts[p] for p in best)
    assert rows[0]["original_context"] == "gold"
    plain = retrieve(fit_tfidf(passages), passages, queries, 1)
    assert "answers" not in plain.columns
    assert reader_input(plain, "predict").columns == ["context", "id", "question"]
    with pytest.raises(ValueError):
        reader_input(plain, "eval")
    with pytest.raises(ValueError):
        reader_input(plain, "both")


def test_hit_rate(spark):
    hits = spark.createDataFrame([(0, 5, 1), (1, 6, 1), (1, 7, 2)], "id long, pid long, rank int")
    gold = spark.createDataFrame([(0, 5), (0, 9), (1, 7), (2, 1)], "id long, pid long")
    got = {r["k"]: (r["n"], r["hits"]) for r in hit_rate(hits, gold, [1, 2]).collect()}
    assert got == {1: (3, 1), 2: (3, 2)}


def test_clustered_search_over_all_lists_equals_exhaustive(passages, queries):
    index = fit_tfidf(passages)
    ivf = build_tfidf_ivf(index, passages, n_clusters=3, iterations=5)
    got = tfidf_ivf_topk(ivf, queries, 3, nprobe=3)
    as_cosine = got.withColumn("score", 1 - F.col("score") / 2)
    assert [r for r in collected(as_cosine) if r[3] > 0] == plain_tfidf(3)
    # Every query with a known term gets all it asks for: the rest has distance 2, by passage id.
    assert {r["id"]: r["count"] for r in got.groupBy("id").count().collect()} == {0: 3, 1: 3, 3: 3, 4: 3}
    shared = {(q, pid) for q, pid, _, _ in plain_tfidf(10)}
    unlike = [(q, pid) for q, pid, _, s in collected(as_cosine) if s == 0]
    assert unlike == [(1, 1), (3, 3), (4, 1)]
    assert not shared & set(unlike)
    assert collected(tfidf_ivf_topk(ivf, queries, 3, nprobe=3, limit=1)) == collected(got)
    one = tfidf_ivf_topk(ivf, queries, 3, nprobe=1)
    lists = {r["pid"]: r["cluster"] for r in ivf.lists.collect()}
    by_query = {}
    for r in one.collect():
        by_query.setdefault(r["id"], set()).add(lists[r["pid"]])
    assert all(len(c) == 1 for c in by_query.values())


@pytest.mark.parametrize("limit,terms", [(10**9, 1000), (0, 1000), (0, 3)])
def test_center_training_equals_dense_rounds(spark, limit, terms):
    import random

    from answerloom.operators import tfidf_ivf as K

    r = random.Random(2)
    texts = [" ".join(r.choice("abcdefghijklm") for _ in range(r.randint(1, 9))) for _ in range(60)]
    vectors = {}
    for pid, text in enumerate(texts):
        counts = {t: text.split().count(t) for t in text.split()}
        norm = math.sqrt(sum(n * n for n in counts.values()))
        vectors[pid] = {t: n / norm for t, n in counts.items()}
    rows = [(t, pid, w) for pid, v in vectors.items() for t, w in v.items()]
    postings = spark.createDataFrame(rows, "term string, pid long, weight double")
    first = K.first_centers(postings, 4).collect()
    centers = {}
    for c in first:
        centers.setdefault(c["cluster"], {})[c["term"]] = c["weight"]
    assert sorted(centers) == [0, 1, 2, 3] and all(v in vectors.values() for v in centers.values())
    for _ in range(3):
        sums = {}
        for v in vectors.values():
            dots = [(-round(sum(w * centers[c].get(t, 0) for t, w in v.items()), 9), c) for c in centers]
            dots = [d for d in dots if d[0] < 0]
            if dots:
                into = sums.setdefault(min(dots)[1], {})
                for t, w in v.items():
                    into[t] = into.get(t, 0) + w
        for c, v in sums.items():
            kept = dict(sorted(v.items(), key=lambda x: (-round(x[1], 9), x[0]))[:terms])
            norm = math.sqrt(sum(w * w for w in kept.values()))
            centers[c] = {t: w / norm for t, w in kept.items()}
    got = {}
    for c in K.train_centers(postings, 4, 42, 3, terms, limit).collect():
        got.setdefault(c["cluster"], {})[c["term"]] = c["weight"]
    assert {c: sorted(v) for c, v in got.items()} == {c: sorted(v) for c, v in centers.items()}
    assert all(abs(got[c][t] - w) < 1e-9 for c, v in centers.items() for t, w in v.items())


def test_lists_without_a_common_term_follow_by_number(spark):
    from answerloom.operators import tfidf_ivf as K

    centers = spark.createDataFrame([(0, "x", 1.0), (1, "y", 1.0), (2, "a", 1.0), (3, "z", 1.0)], "cluster int, term string, weight double")
    vectors = spark.createDataFrame([(7, "a", 1.0), (8, "q", 1.0)], "id long, term string, weight double")
    ivf = K.TfidfIvf(None, None, centers, 4)
    for n, want in ((1, [(7, 2), (8, 0)]), (2, [(7, 0), (7, 2), (8, 0), (8, 1)]), (9, [(i, c) for i in (7, 8) for c in range(4)])):
        assert sorted(map(tuple, K.nearest_lists(ivf, vectors, n).collect())) == want


def test_split_paragraphs(spark):
    df = spark.createDataFrame([(1, "one\n\n two \nthree")], "doc_id long, text string")
    got = [(r["paragraph_no"], r["paragraph"]) for r in split_paragraphs(df, min_chars=4).collect()]
    assert got == [(2, "three")]


def test_own_tokenizer_runs_once_per_table_and_equals_the_built_in(passages, queries):
    words = tokenizer_udf(lambda: lambda text: text.split(" "))
    index = fit_tfidf(passages, udf=words)
    assert collected(tfidf_topk(index, queries, 3, udf=words)) == plain_tfidf(3)
    built_in = collected(bm25_topk(passages, queries, 2))
    assert collected(bm25_topk(passages, queries, 2, udf=words)) == built_in
    tf = term_freq(passages, "pid", "text", TfidfConfig(), words)
    assert tf._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_no_query_forms_all_pairs(passages, queries):
    index = fit_tfidf(passages)
    for frame in (tfidf_topk(index, queries, 3), bm25_topk(passages, queries, 3),
                  retrieve(index, passages, queries, 2)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_written_index_is_read_from_files(spark):
    """The vocabulary and postings are written once; later jobs scan them and count no texts."""
    passages = spark.createDataFrame([(1, "red fox"), (2, "red hen red"), (3, "blue sea")], "pid long, text string")
    index = fit_tfidf(passages, write=True)
    for df in (index.vocab, index.postings):
        assert len(df.inputFiles()) > 0
    plain = fit_tfidf(passages)
    rows = [sorted((r["pid"], r["term"], round(r["weight"], 9)) for r in i.postings.collect()) for i in (index, plain)]
    assert rows[0] == rows[1] and rows[0]


def test_terms_of_many_texts_are_counted_as_in_each_row():
    """Null words, words with blanks, empty and null lists; n-grams never cross rows."""
    import pyarrow as pa

    from answerloom.functions.text import counted_terms

    lists = [["a", "b", "a b"], None, [], ["a", None, "b"], [None, None], ["b", "a", "a", "a"]]

    def plain(words, lo, hi):
        grams = [w[0] if n == 1 else " ".join(x for x in w if x is not None)
                 for n in range(lo, hi + 1) for w in zip(*(words[i:] for i in range(n)))]
        return Counter(g for g in grams if g is not None)

    for lo, hi in ((1, 1), (1, 2), (1, 3), (2, 2)):
        rows, places, counts, terms = counted_terms(pa.array(lists), lo, hi)
        got = sorted((int(r), terms[int(p)].as_py(), int(n)) for r, p, n in zip(rows, places, counts))
        assert got == sorted((i, t, n) for i, w in enumerate(lists) for t, n in plain(w or [], lo, hi).items())


def test_only_frequent_terms_meet_and_weights_need_no_sort(spark, monkeypatch):
    """Rare n-grams are not sent to be counted; a passage's norm needs no window over its postings."""
    from answerloom.operators import passage_weights as W
    from answerloom.operators.tfidf import cut_vocab, term_totals

    texts = [(i, f"alpha beta w{i} gamma v{i} u{i} t{i % 7}") for i in range(300)] + [(300, ""), (301, "alpha")]
    passages = spark.createDataFrame(texts, "pid long, text string")
    cfg = TfidfConfig(max_features=5)
    want = cut_vocab(term_totals(term_freq(passages, "pid", "text", cfg)), 5)
    totals = W.frequent_totals(passages, cfg)
    assert totals.count() < 60
    as_rows = lambda df: sorted(tuple(r) for r in df.select("term", "df", "ctf").collect())
    assert as_rows(cut_vocab(totals, 5)) == as_rows(want)
    # Buckets too full for the first count lead to lower ones, with the same result.
    counted = W.bucket_totals
    monkeypatch.setattr(W, "bucket_totals", lambda *a: counted(*a) * 50)
    assert as_rows(cut_vocab(W.frequent_totals(passages, cfg), 5)) == as_rows(want)
    assert "Window" not in fit_tfidf(passages, cfg).postings._jdf.queryExecution().executedPlan().toString()


def test_tasks_send_few_scores_and_repeated_ids_share_a_norm(spark, queries, monkeypatch):
    from answerloom.operators import passage_weights as W

    monkeypatch.setattr(W, "PRODUCTS", 7)
    texts = [(i, "red apple " * (i % 5 + 1) + f"w{i}") for i in range(200)]
    passages = spark.createDataFrame([*texts, (3, "green apple"), (None, "red"), (None, "sky")], "pid long, text string").coalesce(1)
    index = fit_tfidf(passages)
    vectors = transform_queries(index, queries)
    every, best = (W.weight_scores(index.rows, vectors, k).collect() for k in (None, 2))
    assert len(every) == len({(r["id"], r["pid"]) for r in every}) > len(best)
    norms = {r["pid"]: r["n"] for r in index.postings.groupBy("pid").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()}
    assert len(norms) == 201 and all(abs(n - 1) < 1e-9 for n in norms.values())
    ranked = lambda rows: {
        q: sorted((-round(r["score"], 9), -1 if r["pid"] is None else r["pid"]) for r in rows if r["id"] == q)[:2] for q in range(5)
    }
    assert ranked(every) == ranked(best)
    for q in range(5):
        asked = {r["term"]: r["weight"] for r in vectors.where(F.col("id") == q).collect()}
        sums = Counter()
        for r in index.postings.collect():
            if r["term"] in asked:
                sums[r["pid"]] += r["weight"] * asked[r["term"]]
        got = {r["pid"]: r["score"] for r in every if r["id"] == q}
        assert got.keys() == sums.keys() and all(abs(got[p] - sums[p]) < 1e-9 for p in got)


def test_written_rows_give_the_clusters_of_postings_and_are_not_written_again(spark):
    from dataclasses import replace

    from answerloom.operators import tfidf_ivf as K
    from answerloom.session import work_dir

    words = random.Random(5)
    texts = [(i, " ".join(words.choice("abcdefghijkl") * 2 for _ in range(12))) for i in range(60)]
    passages = spark.createDataFrame([*texts, (3, "aa bb"), (70, "!")], "pid long, text string")
    before = {p.name for p in Path(work_dir(spark).removeprefix("file:")).iterdir()}
    index = fit_tfidf(passages, TfidfConfig(max_features=50), write=True)
    by_row = K.build_tfidf_ivf(index, passages, n_clusters=4, iterations=3)
    new = {p.name for p in Path(work_dir(spark).removeprefix("file:")).iterdir()} - before
    assert sum(n.startswith(("postings-", "weights-")) for n in new) == 1
    assert not any(n.startswith("tokens-") for n in new)
    plain = K.build_tfidf_ivf(replace(index, rows=None, written=False), passages, n_clusters=4, iterations=3)

    def lists(ivf):
        return sorted((r.pid, r.cluster) for r in ivf.lists.collect())

    def rounded(df):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())

    assert lists(by_row) == lists(plain) and rounded(by_row.centers) == rounded(plain.centers)
    assert by_row.index.postings.columns == plain.index.postings.columns
    assert rounded(by_row.index.postings) == rounded(plain.index.postings)
