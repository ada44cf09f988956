"""Language identification by interpolated Kneser-Ney character models.

One model of ``ORDER`` characters per language, over letters within words and their ends. All
models share one sorted array of n-gram hashes; beside each hash stand its log-probabilities in
every language and the weights of backing off from it. A text's score in a language is the
cross-entropy per character; the lowest wins. Each word is scored once per worker.

The models learn every language from a bounded sample: ``ROWS`` rows of each, in the order of a
hash, outside the held-out fold, and fewer (at least ``FEWEST``) where ``ALL_ROWS`` in total would
be passed. Of a text above ``LONGEST`` characters a window of that length counts, at a place drawn
by a hash. A fifth of the sample calibrates the probability and, per language, the cross-entropy
above which a text counts as rejected.

Defined results: a null text or one without a letter is ``und`` with score 0, also if nothing
could be learned; equal cross-entropies go to the language first in code-point order; repeated
rows score alike; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import fold, map_rows, table

ORDER = 5
ROWS, LONGEST = 1500, 20_000
FEWEST, ALL_ROWS = 5, 300_000
#: Words a worker remembers.
REMEMBERED = 300_000
START, END = 2, 3
UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall((text or "").lower())


def has_letter(words: list[str]) -> bool:
    return any(c.isalpha() for w in words for c in w)


def _hashes(codes: np.ndarray, inside: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the last 1..order characters at each position; 0 where the word is shorter.

    ``inside`` is the position within the word.
    """
    out, value = [], np.zeros(len(codes), np.uint64)
    for n in range(1, order + 1):
        shifted = np.zeros(len(codes), np.uint64)
        shifted[n - 1 :] = codes[: len(codes) - n + 1]
        value = value * _STEP + shifted + np.uint64(1)
        mixed = (value ^ (value >> np.uint64(29))) * _MIX
        mixed = (mixed ^ (mixed >> np.uint64(32))) | np.uint64(1)
        out.append(np.where(inside >= n - 1, mixed, np.uint64(0)))
    return out


def _positions(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words with start and end marks, place within the word, word number."""
    text = "".join(f"{chr(START)}{w}{chr(END)}" for w in words)
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    word = np.repeat(np.arange(len(words)), lengths)
    inside = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return codes, inside, word


@dataclass(frozen=True)
class LanguageModel:
    """keys: sorted hashes; prob, back: a row per key, a column per language."""

    names: tuple[str, ...]
    order: int
    keys: np.ndarray
    prob: np.ndarray
    back: np.ndarray
    floor: float
    sharpness: float = 1.0
    limits: tuple[float, ...] = ()

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-probability of each word in each language, and its number of predicted characters."""
        codes, inside, word = _positions(words)
        hashes = _hashes(codes, inside, self.order)
        wanted = inside > 0  # the start mark is given
        total = np.zeros((len(codes), len(self.names)), np.float32)
        open_ = wanted.copy()
        for n in range(self.order, 0, -1):
            at = np.flatnonzero(open_ & (hashes[n - 1] != 0))
            place, found = self._find(hashes[n - 1][at])
            total[at[found]] += self.prob[place[found]]
            open_[at[found]] = False
            if n > 1:  # not found: back off from its context, the n-1 characters before
                rest = at[~found]
                place, known = self._find(hashes[n - 2][rest - 1])
                total[rest[known]] += self.back[place[known]]
        total[open_] += self.floor
        scores = np.zeros((len(words), len(self.names)), np.float64)
        np.add.at(scores, word[wanted], total[wanted])
        return scores, np.array([len(w) + 1 for w in words], np.float64)

    def _find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return place, self.keys[place] == wanted

    def decide(self, entropies: np.ndarray, characters: float) -> tuple[int, float, bool]:
        """Best language, its probability and whether it is rejected."""
        best = int(entropies.argmin())
        odds = (entropies[best] - entropies) * self.sharpness * np.sqrt(characters)
        return best, float(1 / np.exp(np.clip(odds, -700, 0)).sum()), bool(self.limits and entropies[best] > self.limits[best])


def fit(samples: dict[str, list[str]], order: int = ORDER) -> LanguageModel | None:
    """Models from texts by language, each text a row; every fifth one calibrates."""
    names = tuple(sorted(n for n, texts in samples.items() if any(has_letter(words_of(t)) for t in texts)))
    if not names:
        return None
    split = {n: ([t for i, t in enumerate(samples[n]) if i % 5 or len(samples[n]) < 5], samples[n][::5]) for n in names}
    grams: dict[int, list] = defaultdict(list)
    letters: set[int] = set()
    for number, name in enumerate(names):
        counts = Counter(w for t in split[name][0] for w in words_of(t))
        words = list(counts) or [w for t in samples[name] for w in words_of(t)]
        codes, inside, word = _positions(words)
        letters.update(np.unique(codes).tolist())
        times = np.array([counts.get(w, 1) for w in words], np.float64)[word]
        hashes = _hashes(codes, inside, order)
        _kneser_ney(hashes, inside, times, order, number, len(names), grams)
    floor = -float(np.log(len(letters) + 1))
    keys = np.unique(np.concatenate([g[0] for g in grams[0]] + [g[0] for g in grams[1]]))
    prob = np.full((len(keys), len(names)), np.nan)
    back = np.zeros((len(keys), len(names)))
    lower = np.zeros(len(keys), np.uint64)
    context = np.zeros(len(keys), np.uint64)
    level = np.zeros(len(keys), np.int64)
    for k, p, low, ctx, n, number in grams[0]:
        at = np.searchsorted(keys, k)
        prob[at, number], lower[at], context[at], level[at] = p, low, ctx, n
    for k, b, number in grams[1]:
        back[np.searchsorted(keys, k), number] = b
    # n-grams that only another language has: back off there, shortest first.
    for n in range(1, order + 1):
        at = np.flatnonzero(level == n)
        if n == 1:
            base = np.full((len(at), len(names)), floor)
            down = np.zeros((len(at), len(names)))
            # Unigrams back off to even odds over all letters, by the mass kept for that.
            down += np.array([next(b for k, b in grams[2] if k == i) for i in range(len(names))])
        else:
            base = prob[np.searchsorted(keys, lower[at])]
            place = np.searchsorted(keys, context[at])
            place = np.minimum(place, len(keys) - 1)
            down = np.where((keys[place] == context[at])[:, None], back[place], 0.0)
        rows = prob[at]
        prob[at] = np.where(np.isnan(rows), base + down, rows)
    prob = np.where(np.isnan(prob), floor, prob)
    model = LanguageModel(names, order, keys, prob.astype(np.float32), back.astype(np.float32), floor)
    return _calibrate(model, {n: split[n][1] for n in names})


def _kneser_ney(hashes, inside, times, order, number, languages, grams) -> None:
    """Interpolated probabilities of one language's n-grams, from unigrams up."""
    wanted = inside > 0
    below: tuple[np.ndarray, np.ndarray] | None = None
    for n in range(1, order + 1):
        at = np.flatnonzero(wanted & (hashes[n - 1] != 0))
        keys, first, which = np.unique(hashes[n - 1][at], return_index=True, return_inverse=True)
        where = at[first]
        count = np.bincount(which, times[at])
        full = count.copy()
        if n < order:  # continuation counts: different characters before; word starts count as they occur
            longer = np.flatnonzero(wanted & (hashes[n] != 0))
            _, one = np.unique(hashes[n][longer], return_index=True)
            cont = np.bincount(np.searchsorted(keys, hashes[n - 1][longer[one]]), minlength=len(keys))
            begins = inside[where] == n - 1
            count = np.where(begins, full, cont).astype(np.float64)
            count = np.maximum(count, 1)
        ones, twos = (count == 1).sum(), (count == 2).sum()
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        if n == 1:
            context = np.zeros(len(keys), np.uint64)
        else:
            context = hashes[n - 2][where - 1]
        contexts, group = np.unique(context, return_inverse=True)
        total = np.bincount(group, count)
        kinds = np.bincount(group)
        gamma = discount * kinds / total
        if n == 1:
            letters = len(keys) + 1
            lower, low = np.full(len(keys), 1.0 / letters), np.zeros(len(keys), np.uint64)
            grams[2].append((number, float(np.log(gamma[0]))))
        else:
            low = hashes[n - 2][where]
            lower = below[1][np.searchsorted(below[0], low)]
            grams[1].append((contexts, np.log(gamma), number))
        p = np.maximum(count - discount, 0) / total[group] + gamma[group] * lower
        grams[0].append((keys, np.log(p), low, context, n, number))
        below = (keys, p)


def _calibrate(model: LanguageModel, texts: dict[str, list[str]]) -> LanguageModel:
    rows, truth = [], []
    for number, name in enumerate(model.names):
        for text in texts[name]:
            words = words_of(text)
            if has_letter(words):
                scores, lengths = model.word_scores(words)
                rows.append((-scores.sum(0) / lengths.sum(), lengths.sum()))
                truth.append(number)
    best, sharp = np.inf, 1.0
    for s in (0.05, 0.1, 0.2, 0.4, 0.8, 1.6, 3.2):
        loss = 0.0
        for (entropy, n), true in zip(rows, truth):
            logits = (entropy.min() - entropy) * s * np.sqrt(n)
            loss -= logits[true] - np.log(np.exp(logits).sum())
        if loss < best:
            best, sharp = loss, s
    limits = []
    for number in range(len(model.names)):
        own = [e[number] for (e, _), t in zip(rows, truth) if t == number]
        limits.append(float(np.quantile(own, 0.99)) if own else np.inf)
    return LanguageModel(model.names, model.order, model.keys, model.prob, model.back, model.floor, sharp, tuple(limits))


def fit_languages(docs: DataFrame) -> LanguageModel | None:
    """Fit on a bounded sample of the rows outside the held-out fold."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~fold(0))
    counts = usable.groupBy("lang").count()
    most = max(FEWEST, min(ROWS, ALL_ROWS // max(1, counts.count())))
    # About twice the bound of each language by another hash, so that no window sees a whole language;
    # few rows are all drawn, because a draw of few could miss them.
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("drawn")), F.lit(1 << 20)) * F.col("count") < float(2 * max(most, 100) << 20)
    order = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    # One row per language, of which the driver takes at least FEWEST texts each; no row moves before the draw.
    ids = usable.select("doc_id", "lang").join(F.broadcast(counts), "lang").filter(drawn).withColumn("n", order).filter(F.col("n") <= most)
    ids = ids.select("doc_id", "lang")
    place = F.pmod(F.xxhash64("doc_id", F.lit("window")), F.greatest(F.length("text") - LONGEST, F.lit(0)) + 1)
    window = F.substring("text", place.cast("int") + 1, F.lit(LONGEST))
    # At most ALL_ROWS ids, or FEWEST of each language.
    rows = usable.join(F.broadcast(ids), ["doc_id", "lang"], "left_semi").select("doc_id", "lang", window.alias("text"))
    samples: dict[str, list[str]] = defaultdict(list)
    for _, lang, text in sorted(rows.toPandas().itertuples(index=False, name=None)):
        samples[lang].append(text)
    return fit(samples)


class _Scorer:
    """Scores texts word by word, each different word once; a bounded number is remembered."""

    def __init__(self, model: LanguageModel):
        self.model, self.number = model, {}
        self.scores = np.zeros((0, len(model.names)))
        self.lengths = np.zeros(0)

    def texts(self, texts: list[str | None]):
        number, rows, new = self.number, [], []
        for text in texts:
            row = []
            for w in words_of(text):
                n = number.get(w)
                if n is None:
                    n = number[w] = len(number)
                    new.append(w)
                row.append(n)
            rows.append(row)
        for at in range(0, len(new), 20_000):
            scores, lengths = self.model.word_scores(new[at : at + 20_000])
            self.scores = np.concatenate([self.scores, scores])
            self.lengths = np.concatenate([self.lengths, lengths])
        for text, row in zip(texts, rows):
            if not row or not has_letter(words_of(text[:200])) and not has_letter(words_of(text)):
                yield UNKNOWN, 0.0, True
                continue
            row = np.array(row)
            n = self.lengths[row].sum()
            best, score, rejected = self.model.decide(-self.scores[row].sum(0) / n, n)
            yield self.model.names[best], score, rejected
        if len(number) > REMEMBERED:
            for w in list(number)[REMEMBERED:]:
                del number[w]
            self.scores, self.lengths = self.scores[:REMEMBERED].copy(), self.lengths[:REMEMBERED].copy()


def languages(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every row, from its whole text."""
    # Arrays of at most a few megabytes per language, sent once to every executor.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = _Scorer(shared.value) if shared.value else None

        def work(rows):
            found = list(scorer.texts(rows["text"])) if scorer else [(UNKNOWN, 0.0, True)] * len(rows["text"])
            return {
                "doc_id": rows["doc_id"], "held_out": rows["held_out"], "lang_pred": [f[0] for f in found],
                "score": [f[1] for f in found], "rejected": [f[2] for f in found],
            }

        return work

    rows = docs.select("doc_id", fold(0).alias("held_out"), "text")
    return map_rows(rows, make, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def op10_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return languages(docs, fit_languages(docs))
