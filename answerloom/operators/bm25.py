"""BM25 ranking: term saturation and passage length on top of inverse frequency."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BROADCAST_BYTES, TOP_K_RETRIEVAL, Bm25Config, TfidfConfig
from ..functions.text import term_counts, tokenize
from ..session import new_path
from .ranking import top_k
from .tfidf import fits_broadcast, score_order, term_join


@dataclass(frozen=True)
class Bm25Index:
    """Stored ``postings(term, pid, tf, len)`` and one row of ``stats(n, avg_len)``."""

    postings: DataFrame
    stats: DataFrame


def build_bm25(
    passages: DataFrame, path: str | None = None, tokenizer: str = "regex", udf=None
) -> Bm25Index:
    """Tokenize ``passages(pid, text)`` once and write the index; the statistics come last.

    Without a ``path`` it goes to the shared work folder.
    """
    spark = passages.sparkSession
    path = path or new_path(spark, "bm25")
    tokenized = passages.select("pid", tokenize(F.col("text"), tokenizer, udf).alias("tokens"))
    # The outer form keeps passages without a word, which count for the mean length.
    counted = tokenized.select(
        "pid", F.size("tokens").alias("len"), F.explode_outer(term_counts(F.col("tokens"))).alias("t")
    )
    postings = counted.select(F.col("t.value").alias("term"), "pid", F.col("t.n").alias("tf"), "len")
    postings.write.parquet(f"{path}/postings")
    written = spark.read.parquet(f"{path}/postings")
    # A passage's length is the sum of its term counts.
    written.agg(
        F.count_distinct("pid").alias("n"), F.coalesce(F.sum("tf"), F.lit(0)).alias("words")
    ).select("n", (F.col("words") / F.nullif("n", F.lit(0))).alias("avg_len")).write.parquet(f"{path}/stats")
    return load_bm25(spark, path)


def load_bm25(spark: SparkSession, path: str) -> Bm25Index:
    """An index written by ``build_bm25``."""
    postings = spark.read.parquet(f"{path}/postings").where(F.col("term").isNotNull())
    return Bm25Index(postings, spark.read.parquet(f"{path}/stats"))


def bm25_index_scores(
    index: Bm25Index,
    queries: DataFrame,
    cfg: Bm25Config = Bm25Config(),
    limit: int = BROADCAST_BYTES,
    tokenizer: str = "regex",
    udf=None,
) -> DataFrame:
    """Rows ``(id, pid, score)`` for every pair with a common word."""
    terms_cfg = TfidfConfig(max_features=None, min_n=1, max_n=1, tokenizer=tokenizer)
    small = fits_broadcast(queries, terms_cfg, 0, limit, udf)
    corpus = index.stats.select(F.struct("n", "avg_len")).scalar()
    asked = queries.select("id", tokenize(F.col("question"), tokenizer, udf).alias("words"))
    wanted = asked.select("id", F.explode(F.array_distinct("words")).alias("term"))
    words = wanted.select("term").distinct()
    if small:
        # Only the words of the queries are counted.
        known = index.postings.join(F.broadcast(words), "term", "left_semi")
        df = known.groupBy("term").agg(F.count("*").alias("df"))
    else:
        # Counts shrink in the map tasks before they meet the words.
        df = index.postings.groupBy("term").agg(F.count("*").alias("df")).join(words, "term", "left_semi")
    idf = F.log(1 + (corpus["n"] - F.col("df") + 0.5) / (F.col("df") + 0.5))
    idfs = df.select("term", idf.alias("idf"))
    # One row per word of queries that were measured.
    weighted = wanted.join(F.broadcast(idfs) if small else idfs, "term")
    tf = F.col("tf")
    length = 1 - cfg.b + cfg.b * F.col("len") / corpus["avg_len"]
    part = F.col("idf") * tf * (cfg.k1 + 1) / (tf + cfg.k1 * length)
    met = term_join(index.postings, weighted, df, ["term"], small)
    return met.groupBy("pid", "id").agg(F.sum(part).alias("score"))


def bm25_scores(
    passages: DataFrame,
    queries: DataFrame,
    cfg: Bm25Config = Bm25Config(),
    limit: int = BROADCAST_BYTES,
    tokenizer: str = "regex",
    udf=None,
) -> DataFrame:
    """Scores of passages without a stored index: it is written to the shared work folder first."""
    index = build_bm25(passages, None, tokenizer, udf)
    return bm25_index_scores(index, queries, cfg, limit, tokenizer, udf)


def bm25_topk(
    passages: DataFrame | Bm25Index,
    queries: DataFrame,
    k: int = TOP_K_RETRIEVAL,
    cfg: Bm25Config = Bm25Config(),
    limit: int = BROADCAST_BYTES,
    tokenizer: str = "regex",
    udf=None,
) -> DataFrame:
    """The ``k`` best passages of each query, ``(id, pid, score, rank)``."""
    scores = bm25_index_scores if isinstance(passages, Bm25Index) else bm25_scores
    return top_k(scores(passages, queries, cfg, limit, tokenizer, udf), "id", score_order(), k)
