"""TF-IDF retrieval: vocabulary, weights, query transform, scoring, top-k."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import BROADCAST_BYTES, TOP_K_RETRIEVAL, TfidfConfig
from ..functions.text import term_counts, tokenize
from ..session import stored
from .passage_weights import frequent_totals, passage_weights, postings_of, term_totals_of, weight_scores
from .ranking import top_k
from .sizing import measured_bytes

# A vocabulary is cut to `max_features` rows by construction; up to this many
# it is broadcast, beyond that the join is left to the optimizer.
BROADCAST_VOCAB_ROWS = 1_000_000
# Bytes one entry of a broadcast query table takes besides its term.
ENTRY_BYTES = 48
# Postings of one term that may meet a large query set in one task.
SLICE_ROWS = 1_000_000


@dataclass(frozen=True)
class TfidfIndex:
    """A fitted index: ``vocab(term, df, ctf, idf)`` and ``postings(term, pid, weight)``.

    A stored one also has the ``block`` of each posting's passage, ``tops(part, term, block, top)``
    with the largest weights, and ``places(term, part)``: the file parts that hold a term. One
    fitted with a bounded vocabulary has the same weights in ``rows(pid, terms)``, a row per passage.
    ``written`` says that the postings, or the rows they come from, are files.
    """

    vocab: DataFrame
    postings: DataFrame
    config: TfidfConfig
    tops: DataFrame | None = None
    places: DataFrame | None = None
    rows: DataFrame | None = None
    written: bool = False


def term_freq(df: DataFrame, key: str, text: str, cfg: TfidfConfig, udf=None) -> DataFrame:
    """Rows ``(key, term, tf)``, counted inside each row's own token array."""
    tokens = tokenize(F.col(text), cfg.tokenizer, udf)
    if udf is not None:
        # The Python tokenizer gets a projection of its own, so it runs once per row.
        df = df.select(key, tokens.alias("__tokens"))
        tokens = F.col("__tokens")
    counted = df.select(key, F.explode(term_counts(tokens, cfg.min_n, cfg.max_n)).alias("t"))
    terms = counted.select(key, F.col("t.value").alias("term"), F.col("t.n").alias("tf"))
    # Joins on the term would add this filter in some uses only; stated here, all
    # uses have the same plan and can share one exchange.
    return terms.where(F.col("term").isNotNull())


def term_totals(tf: DataFrame) -> DataFrame:
    """Document and corpus frequency of every term."""
    return tf.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("ctf"))


def build_vocab(tf: DataFrame, max_features: int | None) -> DataFrame:
    """The ``max_features`` terms with the highest corpus count, ties in term order.

    A plain ``orderBy().limit()`` would send that many rows of every partition
    to one task. The count at the cut is found first from the table of distinct
    counts, which is tiny; only terms at or above it take part in the final sort.
    """
    return cut_vocab(term_totals(tf), max_features)


def cut_vocab(totals: DataFrame, max_features: int | None) -> DataFrame:
    """``build_vocab`` of counted terms ``(term, df, ctf)``."""
    # Always true; it keeps both columns in the shuffled aggregate of both uses
    # below, so that the second use reads the exchange of the first.
    totals = totals.where(F.col("ctf") >= F.col("df"))
    if max_features is None:
        return totals
    per_count = totals.groupBy("ctf").agg(F.count("*").alias("terms"))
    running = Window.orderBy(F.desc("ctf")).rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        per_count.withColumn("terms_so_far", F.sum("terms").over(running))
        .where(F.col("terms_so_far") >= max_features)
        .agg(F.coalesce(F.max("ctf"), F.lit(0)))
    )
    return (
        totals.where(F.col("ctf") >= cut.scalar())
        .orderBy(F.desc("ctf"), "term")
        .limit(max_features)
    )


def with_idf(vocab: DataFrame, n_passages: Column) -> DataFrame:
    """Smoothed inverse document frequency, ``ln((1 + n) / (1 + df)) + 1``."""
    return vocab.withColumn("idf", F.log((1 + n_passages) / (1 + F.col("df"))) + 1)


def unit_weights(tf: DataFrame, vocab: DataFrame, cfg: TfidfConfig, key: str) -> DataFrame:
    """``tf * idf`` scaled to length 1 per ``key``; terms outside the vocabulary vanish.

    Rows that arrive partitioned by ``key`` keep that partitioning through the
    broadcast join, so the norm needs no exchange.
    """
    known = vocab.select("term", "idf")
    if bounded(cfg):
        known = F.broadcast(known)
    raw = F.col("tf") * F.col("idf")
    norm = F.sqrt(F.sum(raw * raw).over(Window.partitionBy(key)))
    return tf.join(known, "term").select("term", key, (raw / norm).alias("weight"))


def bounded(cfg: TfidfConfig) -> bool:
    """Whether the vocabulary is cut to a size that every task may hold."""
    return cfg.max_features is not None and cfg.max_features <= BROADCAST_VOCAB_ROWS


def fit_tfidf(
    passages: DataFrame, cfg: TfidfConfig = TfidfConfig(), udf=None, write: bool = False
) -> TfidfIndex:
    """Index ``passages(pid, text)``.

    A bounded vocabulary is written now, since the weights and every search read it; the weights
    are computed when the result is used. With ``write`` the vocabulary and the postings are written
    now, for uses in more than one job: each would read and count all the texts again.
    """
    vocab = fit_vocab(passages, cfg, udf)
    if write or bounded(cfg):
        vocab = stored(vocab, "vocab")
    if not bounded(cfg):
        postings = weighted_postings(passages, vocab, cfg, udf)
        return TfidfIndex(vocab, stored(postings, "postings") if write else postings, cfg, written=write)
    rows = passage_weights(passages, vocab, cfg, udf)
    if write:
        rows = stored(rows, "weights")
        return TfidfIndex(vocab, postings_of(rows), cfg, rows=rows, written=True)
    return TfidfIndex(vocab, postings_of(rows), cfg, rows=rows)


def weighted_postings(passages: DataFrame, vocab: DataFrame, cfg: TfidfConfig, udf=None) -> DataFrame:
    """Rows ``(term, pid, weight)`` of the passages; a bounded vocabulary must be written."""
    if bounded(cfg):
        return postings_of(passage_weights(passages, vocab, cfg, udf))
    return unit_weights(passage_terms(passages, cfg, udf), vocab, cfg, "pid")


def weighted_rows(passages: DataFrame, vocab: DataFrame, cfg: TfidfConfig, udf=None) -> DataFrame:
    """The postings as rows ``(pid, terms)``, each passage's in one."""
    if bounded(cfg):
        return passage_weights(passages, vocab, cfg, udf)
    postings = weighted_postings(passages, vocab, cfg, udf)
    return postings.groupBy("pid").agg(F.collect_list(F.struct("term", "weight")).alias("terms"))


def passage_terms(passages: DataFrame, cfg: TfidfConfig, udf=None) -> DataFrame:
    """Term counts of the passages, with each passage's terms in one partition.

    Deduplicated passages already lie that way and are not moved again.
    """
    return term_freq(passages, "pid", "text", cfg, udf).repartition("pid")


def fit_vocab(passages: DataFrame, cfg: TfidfConfig, udf=None) -> DataFrame:
    """The vocabulary of a corpus with its inverse document frequencies."""
    n_passages = passages.agg(F.count("*")).scalar()
    if bounded(cfg) and udf is None:
        totals = frequent_totals(passages, cfg)
    else:
        totals = term_totals_of(passages.select(tokenize(F.col("text"), cfg.tokenizer, udf).alias("tokens")), cfg)
    return with_idf(cut_vocab(totals, cfg.max_features), n_passages)


def transform_queries(index: TfidfIndex, queries: DataFrame, udf=None) -> DataFrame:
    """Unit vectors of ``queries(id, question)`` as rows ``(term, id, weight)``."""
    tf = term_freq(queries, "id", "question", index.config, udf)
    return unit_weights(tf, index.vocab, index.config, "id")


def oov_queries(index: TfidfIndex, queries: DataFrame, udf=None) -> DataFrame:
    """Queries without a single known term; they would match nothing."""
    tf = term_freq(queries, "id", "question", index.config, udf)
    known = tf.join(index.vocab.select("term"), "term", "left_semi").select("id").distinct()
    return queries.join(known, "id", "left_anti")


def fits_broadcast(
    queries: DataFrame, cfg: TfidfConfig, k: int, limit: int, udf=None
) -> bool:
    """Whether the terms of all queries, and ``k`` hits for each, take at most ``limit`` bytes."""
    n_words = F.size(tokenize(F.col("question"), cfg.tokenizer, udf)).cast("long")
    # n words give at most n terms per n-gram length, and an n-gram of length m
    # repeats the text at most m times.
    lengths = range(cfg.min_n, cfg.max_n + 1)
    row_bytes = (
        n_words * (ENTRY_BYTES * len(lengths))
        + F.octet_length("question").cast("long") * (2 * sum(lengths))
        + ENTRY_BYTES * k
    )
    sized = queries.select(row_bytes.alias("__bytes"))
    return measured_bytes(sized, F.col("__bytes")) <= limit


def term_join(
    postings: DataFrame, wanted: DataFrame, totals: DataFrame, keys: list[str], small: bool, by: str = "pid"
) -> DataFrame:
    """Postings with the query rows ``wanted`` of their term, in one plan for any query set.

    A small query table, by a measure the caller made, is broadcast and the postings
    stay in place. Else both sides meet by term; a term with more than ``SLICE_ROWS``
    postings by ``totals(term, df)`` meets in slices of its passages, or of the column
    ``by``, its query rows repeated in each slice.
    """
    if small:
        return postings.join(F.broadcast(wanted), keys)
    hot = totals.where(F.col("df") > SLICE_ROWS).select(
        "term", F.ceil(F.col("df") / SLICE_ROWS).cast("int").alias("slices")
    )
    size = measured_bytes(hot, F.octet_length("term") + ENTRY_BYTES)
    if size == 0:
        return postings.join(wanted, keys)
    if size <= BROADCAST_BYTES:
        hot = F.broadcast(hot)
    n = F.coalesce("slices", F.lit(1))
    left = postings.join(hot, "term", "left").withColumn("slice", F.pmod(F.xxhash64(by), n).cast("int"))
    right = wanted.join(hot, "term", "left").withColumn("slice", F.explode(F.sequence(F.lit(0), n - 1)))
    return left.drop("slices").join(right.drop("slices"), [*keys, "slice"]).drop("slice")


def only_parts(index: TfidfIndex, vectors: DataFrame) -> TfidfIndex:
    """A stored index cut to the file parts that hold a term of ``vectors``; others are never opened.

    Only the numbers of parts, at most one per file, pass through the driver.
    """
    if index.places is None:
        return index
    parts = index.places.join(vectors.select("term").distinct(), "term", "left_semi")
    wanted = F.col("part").isin(sorted(r["part"] for r in parts.select("part").distinct().collect()))
    return replace(index, postings=index.postings.where(wanted), tops=index.tops.where(wanted))


def scores_of(index: TfidfIndex, queries: DataFrame, small: bool, udf=None, k: int | None = None) -> DataFrame:
    """Cosine of every passage sharing a term with each query; ``small`` was measured.

    With ``k`` rows may be left out that are not among a query's best ``k``.
    """
    if index.rows is not None and small:
        return weight_scores(index.rows, transform_queries(index, queries, udf), k)
    vectors = transform_queries(index, queries, udf).withColumnRenamed("weight", "q_weight")
    postings = only_parts(index, vectors).postings
    return (
        term_join(postings, vectors, index.vocab, ["term"], small)
        .groupBy("pid", "id")
        .agg(F.sum(F.col("weight") * F.col("q_weight")).alias("score"))
    )


def score(
    index: TfidfIndex, queries: DataFrame, limit: int = BROADCAST_BYTES, udf=None
) -> DataFrame:
    """Rows ``(id, pid, score)`` for every pair with a common known term."""
    return scores_of(index, queries, fits_broadcast(queries, index.config, 0, limit, udf), udf)


def score_order(score_col: str = "score") -> list[Column]:
    """Best score first; scores equal to 9 digits go by passage id."""
    return [F.desc(F.round(score_col, 9)), F.asc("pid")]


def tfidf_topk(
    index: TfidfIndex,
    queries: DataFrame,
    k: int = TOP_K_RETRIEVAL,
    limit: int = BROADCAST_BYTES,
    udf=None,
) -> DataFrame:
    """The ``k`` best passages of each query, ``(id, pid, score, rank)``."""
    small = fits_broadcast(queries, index.config, 0, limit, udf)
    return top_k(scores_of(index, queries, small, udf, k), "id", score_order(), k)
