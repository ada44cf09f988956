"""Language-model scores by a weighted backoff automaton.

The model is an n-gram model over words with Dirichlet smoothing: a word's probability after a
history is ``(c(h w) + mu p(w | shorter h)) / (c(h) + mu)``. Below the unigrams, a share of each
known word, found by absolute discounting, is the mass of all unknown words together.

Compiled, each counted n-gram is an arc from the state of its history, and each state has a
failure arc, weighted by what backing off costs, to the state of the shorter history. A text is
scored in one traversal from left to right that carries the state and adds the weights; the texts
of a chunk are traversed together, each arc and failure arc as one array operation.

Counts cover all texts outside the held-out fold. They are summed by buckets of hashed n-grams
and answered to chunks of documents; a chunk compiles the part of the automaton that its texts
can reach. The model is never whole in one place.

Defined results: a null text counts as empty: its end is its only token; with nothing to learn
from, every token is unknown and scores 0; repeated rows count and score each; words are told
apart by 64-bit hashes; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import Buckets, answer, answers_by_kind, chain, in_chunks, send, text_bytes
from .common import fold, table, to_arrow
from .words import split_words

ORDER, MU = 2, 500.0
#: Bytes of text of a chunk, and chunks for every bucket of the key space: a bucket's size is fixed.
CHUNK, SHARE = 4 << 20, 8
#: Marks that no word can equal, for the start and the end of a text.
START, END = b" ", b"\n"


@dataclass(frozen=True)
class Totals:
    """tokens, distinct tokens, tokens counted once and twice."""

    tokens: int = 0
    distinct: int = 0
    once: int = 0
    twice: int = 0

    @property
    def discount(self) -> float:
        return self.once / (self.once + 2 * self.twice) if self.once and self.twice else 0.5

    def probability(self, counts: np.ndarray) -> np.ndarray:
        """Smoothed unigram probabilities; a count of 0 stands for all unknown words."""
        if not self.tokens:
            return np.ones(len(counts))
        return np.where(counts > 0, counts - self.discount, self.discount * self.distinct) / self.tokens

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The words of all texts (bytes) as numbers, how many each text has, and the different words."""
    codes, counts, words = split_words(pc.ascii_lower(texts.view(pa.string())))
    words = words.view(pa.binary()).to_pylist()
    if b"" in words:  # white space at either end of a text
        real = codes != words.index(b"")
        counts = np.bincount(np.repeat(np.arange(len(counts)), counts)[real], minlength=len(counts))
        codes = codes[real]
    return codes, counts, words


class Grams:
    """The different n-grams of some texts, as ids per order.

    ``ids[n][i]`` is the n-gram that ends at position i (-1 near a text's start); per n-gram there
    are its history, its last word, the n-gram without its first word, its hash and its count.
    """

    def __init__(self, texts: pa.Array, learn: np.ndarray, order: int):
        codes, counts, known = words_of(texts)
        lengths = counts + 2
        self.starts = np.cumsum(lengths) - lengths
        self.lengths = lengths
        words = np.ones(int(lengths.sum()), np.int64)
        words[self.starts] = 0
        self.inside = np.ones(len(words), bool)
        self.inside[self.starts] = False
        middle = self.inside.copy()
        middle[self.starts + lengths - 1] = False
        words[middle] = codes + 2
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in (START, END, *known)], np.uint64)
        weight = np.repeat(learn.astype(np.float64), lengths)
        self.ids, self.hash, self.count = [words], [hashes], [np.bincount(words, weight, len(hashes)).astype(np.uint64)]
        self.history, self.last, self.shorter = [None], [None], [None]
        place = np.arange(len(words)) - np.repeat(self.starts, lengths)
        for n in range(2, order + 1):
            at = np.flatnonzero(place >= n - 1)
            before = self.ids[-1][at - 1]
            code = before * len(hashes) + words[at]
            _, first, which = np.unique(code, return_index=True, return_inverse=True)
            where = at[first]
            ids = np.full(len(words), -1, np.int64)
            ids[at] = which
            self.history.append(self.ids[-1][where - 1])
            self.last.append(words[where])
            self.shorter.append(self.ids[-1][where])
            self.hash.append(chain(self.hash[-1][self.history[-1]], hashes[self.last[-1]]))
            self.count.append(np.bincount(which, weight[at], len(first)).astype(np.uint64))
            self.ids.append(ids)

    def text(self, i: int) -> list[int]:
        """Word ids of a text, without its start mark."""
        return self.ids[0][self.starts[i] + 1 : self.starts[i] + self.lengths[i]].tolist()


class BackoffAutomaton:
    """States are histories (order, id); arcs and failure arcs carry log10 weights."""

    def __init__(self, grams: Grams, counts: list[np.ndarray], totals: Totals, mu: float):
        self.grams, self.counts, self.vocabulary = grams, counts, len(counts[0])
        below = totals.probability(counts[0].astype(float))
        self.root, self.weight = np.log10(below), []
        self.fail = [np.log10(mu / (c + mu)) for c in counts]
        for n in range(1, len(counts)):
            below = (counts[n] + mu * below[grams.shorter[n]]) / (counts[n - 1][grams.history[n]] + mu)
            self.weight.append(np.log10(below))

    @cached_property
    def arcs(self) -> list[dict[int, int]]:
        """By order: (state, word) to the counted n-gram that the arc leads to."""
        out = []
        for n in range(1, len(self.counts)):
            seen = np.flatnonzero(self.counts[n] > 0)
            code = self.grams.history[n][seen] * self.vocabulary + self.grams.last[n][seen]
            out.append(dict(zip(code.tolist(), seen.tolist())))
        return out

    def scores(self) -> np.ndarray:
        """log10 probabilities of all texts, traversed together.

        A position's state is its longest counted history. From each state the word's arc is taken
        if there is one, else the failure arc, whose weight is added to what the shorter one gives.
        """
        ids = self.grams.ids
        value = self.root[ids[0]]
        for n in range(1, len(self.counts)):
            at = np.flatnonzero(ids[n] >= 0)
            state, arc = ids[n - 1][at - 1], ids[n][at]
            is_state = self.counts[n - 1][state] > 0
            step = np.where(self.counts[n][arc] > 0, self.weight[n - 1][arc], self.fail[n - 1][state] + value[at])
            value[at] = np.where(is_state, step, value[at])
        return np.add.reduceat(np.where(self.grams.inside, value, 0), self.grams.starts)

    def score(self, words: list[int]) -> float:
        """log10 probability of one text, arc by arc: what ``scores`` does for all at once."""
        total, size = 0.0, self.vocabulary
        arcs, weight, fail, shorter = self.arcs, self.weight, self.fail, self.grams.shorter
        known = [c > 0 for c in self.counts]
        top = len(arcs)
        level, state = min(1, top), 0  # after the start mark
        for word in words:
            while level:
                arc = arcs[level - 1].get(state * size + word)
                if arc is not None:
                    total += weight[level - 1][arc]
                    break
                total += fail[level - 1][state]
                level -= 1
                if level:
                    state = shorter[level][state]
            else:
                total += self.root[word]
                arc = word
            # The longest counted history that the next word can continue.
            if level < top:
                level, state = level + 1, arc
            else:
                state = shorter[top][arc] if top else 0
            while level and not known[level - 1][state]:
                level -= 1
                if level:
                    state = shorter[level][state]
        return total


def _corpus_totals(answered: DataFrame) -> Totals:
    row = answered.select(*(F.sum(n).cast("long") for n in ("tokens", "distinct", "once", "twice"))).first()
    return Totals(*(int(v or 0) for v in row))


def count_totals(docs: DataFrame, learn, buckets: int, order: int = 1) -> Totals:
    """Counts of the learned tokens: a pass over the texts that sends single words only."""
    schema = to_arrow("bucket long, keys binary, counts binary")

    def words(batches):
        for batch in batches:
            codes, _, known = words_of(batch.column(0))
            values = np.append(np.bincount(codes, minlength=len(known)), batch.num_rows).astype(np.uint64)
            hashes = np.array([xxhash.xxh64_intdigest(w) for w in (*known, END)], np.uint64)
            hashes, values = hashes[values > 0], values[values > 0]
            parts = Buckets(hashes, buckets).parts
            columns = (
                list(parts), [hashes[a].astype("<u8").tobytes() for a in parts.values()],
                [values[a].astype("<u8").tobytes() for a in parts.values()],
            )
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    out = to_arrow("tokens long, distinct long, once long, twice long")

    def sums(table):
        keys = np.concatenate([np.frombuffer(k, "<u8") for k in table["keys"].to_pylist()])
        counts = np.concatenate([np.frombuffer(c, "<u8") for c in table["counts"].to_pylist()])
        _, which = np.unique(keys, return_inverse=True)
        total = np.bincount(which, counts).astype(np.int64)
        values = (total.sum(), len(total), (total == 1).sum(), (total == 2).sum())
        return pa.Table.from_arrays([pa.array([int(v)], pa.int64()) for v in values], schema=out)

    texts = docs.filter(learn).select(F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    sent = texts.mapInArrow(words, "bucket long, keys binary, counts binary")
    return _corpus_totals(sent.groupBy("bucket").applyInArrow(sums, "tokens long, distinct long, once long, twice long"))


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def lm_scores(docs: DataFrame, order: int = ORDER, mu: float = MU, chunk: int = CHUNK) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    count = 1 + text_bytes(docs) // chunk
    buckets = 1 + count // SHARE
    totals = count_totals(docs, ~fold(1), buckets)
    chunked = in_chunks(docs, count, fold(1).alias("held_out"))

    def grams_of(table: pa.Table) -> Grams:
        held = np.array(table["held_out"].to_pylist(), bool)
        return Grams(table["text"].combine_chunks(), ~held, order)

    def grams(table: pa.Table):
        found = grams_of(table)
        for n in range(order):
            yield n, found.hash[n], found.count[n]

    def summed(kind, which, counts, row):
        return np.bincount(which, counts).astype(np.uint64)[which]

    schema = to_arrow(SCORES)

    def scored(left, right):
        left = left.sort_by([("doc_id", "ascending")])
        found, answers = grams_of(left), answers_by_kind(right)
        counts = []
        for n in range(order):
            hashes = found.hash[n]
            counts.append(Buckets(hashes, buckets).gather(answers[n], len(hashes)).astype(np.int64) if len(hashes) else np.zeros(0, np.int64))
        automaton = BackoffAutomaton(found, counts, totals, mu)
        base, known = totals.base(counts[0]), counts[0] > 0
        words = found.ids[0]
        sums = [np.add.reduceat(np.where(found.inside, v[words], 0), found.starts) for v in (base, known.astype(np.int64))]
        n = left.num_rows
        columns = (
            left["doc_id"], left["held_out"], found.lengths - 1, sums[1], [totals.tokens] * n, sums[0],
            automaton.scores(),
        )
        return pa.Table.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.ChunkedArray) else c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    answered = answer(send(chunked, grams, buckets), summed)
    return chunked.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(scored, SCORES)


def op3_lm_score(spark, sf_dir):
    return lm_scores(table(spark, sf_dir, "documents"))
