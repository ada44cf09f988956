"""Term totals, weights and scores of whole passages, in Arrow batches.

A passage's terms stay in its row: its norm and its scores need no exchange and no sort of postings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TfidfConfig
from ..functions.text import BUCKET_BITS, COUNTED_WORDS, counted_terms, list_sizes, runs_of, term_buckets, tokenize
from ..session import discard, stored

# Buckets of one row when their sums meet.
BLOCK = 1 << 14
# Products of a posting and a query term that are summed at once.
PRODUCTS = 1 << 21
# Scores are ordered by 9 digits, so a score this far below the k-th may still tie with it.
MARGIN = 2e-9

WEIGHTS = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("weight", T.DoubleType())]))
PAIR = [pa.field("term", pa.string()), pa.field("weight", pa.float64())]
TOTALS = "term string, df long, ctf long"


def term_totals_of(tokens: DataFrame, cfg: TfidfConfig, wanted: np.ndarray | None = None) -> DataFrame:
    """Document and corpus frequency of every term of ``tokens``, or of those in ``wanted`` buckets."""
    shared = tokens.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            for at, to in runs_of(list_sizes(lists), COUNTED_WORDS):
                _, places, counts, terms = counted_terms(lists[at:to], cfg.min_n, cfg.max_n, shared.value)
                df = np.bincount(places, minlength=len(terms))
                ctf = np.bincount(places, counts, len(terms)).astype(np.int64)
                found = np.flatnonzero(df)
                columns = [terms.take(pa.array(found)), pa.array(df[found]), pa.array(ctf[found])]
                yield pa.RecordBatch.from_arrays(columns, ["term", "df", "ctf"])

    counted = tokens.select("tokens").mapInArrow(run, TOTALS)
    return counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("ctf").alias("ctf"))


def bucket_totals(tokens: DataFrame, cfg: TfidfConfig) -> np.ndarray:
    """Words and n-grams of ``tokens`` in every bucket: at least the count of any term in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            lists = batch.column(0)
            for at, to in runs_of(list_sizes(lists), COUNTED_WORDS):
                for _, buckets in term_buckets(lists[at:to], cfg.min_n, cfg.max_n):
                    sums += np.bincount(buckets, minlength=len(sums))
        blocks = sums.reshape(-1, BLOCK)
        some = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array([blocks[i].tobytes() for i in some], pa.binary())], ["block", "sums"]
        )

    def add(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BLOCK, np.int64)
        for part in parts:
            for row in part.column("sums"):
                sums += np.frombuffer(row.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([sums.tobytes()], pa.binary())], ["block", "sums"])

    blocks = tokens.select("tokens").mapInArrow(run, "block int, sums binary")
    totals = np.zeros((1 << BUCKET_BITS) // BLOCK * BLOCK, np.int64).reshape(-1, BLOCK)
    for row in blocks.groupBy("block").applyInArrow(add, "block int, sums binary").toArrow().to_pylist():
        totals[row["block"]] = np.frombuffer(row["sums"], np.int64)
    return totals.ravel()


def frequent_totals(passages: DataFrame, cfg: TfidfConfig) -> DataFrame:
    """``term_totals_of`` the passages' terms, at least of the ``max_features`` most frequent ones.

    Most n-grams are rare. All are counted in buckets of hashes first, whose number is fixed.
    A bucket below some count holds no term that reaches it, so only terms in the other buckets
    are counted as themselves. If ``max_features`` of these reach that count, no other term
    is among the most frequent; else a lower count is tried, in the end one that leaves out nothing.
    """
    tokens = stored(passages.select(tokenize(F.col("text"), cfg.tokenizer).alias("tokens")), "tokens")
    buckets = bucket_totals(tokens, cfg)
    rank = len(buckets) - min(len(buckets), 2 * cfg.max_features)
    least = int(np.partition(buckets, rank)[rank])
    while True:
        totals = stored(term_totals_of(tokens, cfg, buckets >= max(1, least)), "term-totals")
        reaching = totals.where(F.col("ctf") >= least)
        if least <= 1 or reaching.count() >= cfg.max_features:
            discard(tokens)
            return reaching
        discard(totals)
        least //= 8


def new_runs(keys: pa.Array) -> np.ndarray:
    """True where a key differs from the one before; null equals null."""
    first, second = keys[:-1], keys[1:]
    differ = pc.or_(pc.fill_null(pc.not_equal(first, second), False), pc.xor(first.is_null(), second.is_null()))
    return np.concatenate([np.ones(min(1, len(keys)), bool), differ.to_numpy(zero_copy_only=False).astype(bool)])


def whole_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows again, those with equal first columns that follow each other in one table."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows])
        if not len(rows):
            continue
        rows = rows.combine_chunks()
        last = int(np.flatnonzero(new_runs(_plain(rows.column(0))))[-1])
        if last:
            yield rows[:last]
        held = rows[last:]
    if held is not None and len(held):
        yield held


def _plain(column: pa.ChunkedArray) -> pa.Array:
    whole = column.combine_chunks()
    return pa.concat_arrays(whole.chunks) if isinstance(whole, pa.ChunkedArray) else whole


def passage_weights(passages: DataFrame, vocab: DataFrame, cfg: TfidfConfig, udf=None) -> DataFrame:
    """Rows ``(pid, terms)``: each passage's known terms with ``tf * idf`` scaled to length 1.

    The vocabulary is bounded by its settings; it goes to every task. Rows that share a
    ``pid`` are one passage with one norm; its terms repeat, as its postings would.
    """
    table = vocab.select("term", "idf").toArrow()
    shared = passages.sparkSession.sparkContext.broadcast((_plain(table.column("term")), table.column("idf").to_numpy()))

    def weighed(pids: pa.Array, tokens: pa.Array, firsts: np.ndarray) -> pa.RecordBatch:
        terms, idf = shared.value
        rows, places, counts, names = counted_terms(tokens, cfg.min_n, cfg.max_n)
        known = pc.index_in(names, value_set=terms.cast(names.type)).fill_null(-1).to_numpy()[places]
        rows, places, counts, known = (a[known >= 0] for a in (rows, places, counts, known))
        run = (np.cumsum(firsts) - 1)[rows]
        n = int(firsts.sum())
        raw = counts * idf[known]
        weights = raw / np.sqrt(np.bincount(run, raw * raw, n))[run]
        bounds = np.searchsorted(run, np.arange(n + 1)).astype(np.int32)
        pairs = pa.StructArray.from_arrays([names.take(pa.array(places)).cast(pa.string()), pa.array(weights)], fields=PAIR)
        lists = pa.ListArray.from_arrays(pa.array(bounds), pairs)
        return pa.RecordBatch.from_arrays([pids.filter(pa.array(firsts)), lists], ["pid", "terms"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches):
            pids, tokens = (_plain(c) for c in table.columns)
            firsts = new_runs(pids)
            starts = np.flatnonzero(firsts)
            bounds = np.append(starts, len(firsts))
            for at, to in runs_of(np.add.reduceat(list_sizes(tokens), starts), COUNTED_WORDS):
                piece = slice(int(bounds[at]), int(bounds[to]))
                yield weighed(pids[piece], tokens[piece], firsts[piece])

    placed = passages.repartition("pid").sortWithinPartitions("pid")
    tokens = placed.select("pid", tokenize(F.col("text"), cfg.tokenizer, udf).alias("tokens"))
    kind = T.StructType([passages.schema["pid"], T.StructField("terms", WEIGHTS)])
    return tokens.mapInArrow(run, kind)


def postings_of(weights: DataFrame) -> DataFrame:
    """Rows ``(term, pid, weight)`` of ``passage_weights``."""
    return weights.select("pid", F.explode("terms").alias("t")).select("t.term", "pid", "t.weight")


class Queries:
    """Query vectors by term: ``ids`` of the queries, and of each of the ``terms`` its queries and their weights."""

    def __init__(self, vectors: pa.Table):
        asked = _plain(vectors.column("id")).dictionary_encode()
        words = _plain(vectors.column("term")).dictionary_encode()
        self.ids = pa.concat_arrays([asked.dictionary, pa.nulls(1, asked.dictionary.type)])
        order = np.argsort(words.indices.to_numpy(), kind="stable")
        self.terms = words.dictionary
        self.bounds = np.searchsorted(words.indices.to_numpy()[order], np.arange(len(self.terms) + 1))
        self.query = asked.indices.fill_null(len(self.ids) - 1).to_numpy()[order].astype(np.int64)
        self.weight = vectors.column("weight").to_numpy()[order]

    def products(self, lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Scores of rows of ``passage_weights``: places of rows and queries, and their sums."""
        pairs = lists.flatten()
        names = pairs.field(0)
        found = pc.index_in(names, value_set=self.terms.cast(names.type)).fill_null(-1).to_numpy()
        met = np.flatnonzero(found >= 0)
        found, weight = found[met], pairs.field(1).to_numpy()[met]
        row = np.repeat(np.arange(len(lists)), list_sizes(lists))[met]
        spread = np.diff(self.bounds)[found]
        per_row = np.bincount(row, spread, len(lists)).astype(np.int64)
        for at, to in runs_of(per_row, PRODUCTS):
            piece = slice(*np.searchsorted(row, [at, to]))
            n = spread[piece]
            ends = np.cumsum(n)
            entry = np.repeat(self.bounds[found[piece]] - (ends - n), n) + np.arange(n.sum())
            keys = np.repeat(row[piece], n) * len(self.ids) + self.query[entry]
            pairs_met, of = np.unique(keys, return_inverse=True)
            score = np.bincount(of, np.repeat(weight[piece], n) * self.weight[entry], len(pairs_met))
            yield pairs_met // len(self.ids), pairs_met % len(self.ids), score


def _reaching(query: np.ndarray, score: np.ndarray, floor: np.ndarray, k: int) -> np.ndarray:
    """Places of scores that may be among a query's best ``k``; raises the ``floor`` to the k-th found."""
    at = np.flatnonzero(score >= floor[query] - MARGIN)
    at = at[np.lexsort((-score[at], query[at]))]
    asked = query[at]
    kth = np.flatnonzero(np.arange(len(at)) - np.searchsorted(asked, asked) == k - 1)
    floor[asked[kth]] = np.maximum(floor[asked[kth]], score[at[kth]])
    return at[score[at] >= floor[asked] - MARGIN]


def weight_scores(weights: DataFrame, vectors: DataFrame, k: int | None = None) -> DataFrame:
    """``(pid, id, score)`` of ``passage_weights`` with query ``vectors(term, id, weight)``, which go to every task.

    With ``k`` a task leaves out scores below the ``k`` best it has seen of a query,
    so a query's best ``k`` are among the rows.
    """
    table = vectors.select("id", "term", "weight").toArrow()
    shared = weights.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = Queries(shared.value)
        floor = np.full(len(asked.ids), -np.inf)
        for batch in batches:
            pids = batch.column(0)
            for row, query, score in asked.products(batch.column(1)):
                if k is not None:
                    best = _reaching(query, score, floor, k)
                    row, query, score = row[best], query[best], score[best]
                columns = [pids.take(pa.array(row)), asked.ids.take(pa.array(query)), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, ["pid", "id", "score"])

    kind = T.StructType([weights.schema["pid"], vectors.schema["id"], T.StructField("score", T.DoubleType())])
    return weights.mapInArrow(run, kind)
