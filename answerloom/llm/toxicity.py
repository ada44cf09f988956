"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one that holds toxic text as
well. Every window of a text is compressed with both; what the toxic dictionary saves tells how
much of the window it knows and ordinary text lacks. The savings of all windows, counted above
calibrated thresholds, give a probability by a logistic fit.

Labels belong to whole documents, so the toxic text is first cut out of them: words that hold a
character run found in many toxic documents and hardly in others. Dictionaries come from two
thirds of the labelled sample, thresholds and weights from the last third.

The sample is bounded: ``TOXIC`` and ``ORDINARY`` labelled rows of at most ``LONGEST``
characters, in the order of a hash. Everything else covers whole texts of all rows.

Defined results: null and empty texts have one empty window that saves nothing; without labels
of both classes every score is 0; repeated rows score alike; several labels of one id each count;
an empty table gives an empty table; labels, lang, source and doc_id never enter a score.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, give_back, map_rows, table, utf8

TOXIC, ORDINARY, LONGEST = 3000, 5000, 20_000
#: Window and step in bytes; zstandard level and least match.
WINDOW, STEP, LEVEL, MATCH = 48, 24, 3, 5
RUNS = (4, 5, 6, 7)
#: A run is toxic if this share of toxic documents, and at least so many, have it: so many times
#: the share of others.
SHARE, LEAST, LIFT = 0.015, 5, 25.0
ORDINARY_BYTES, TOXIC_BYTES = 8192, 8000
THRESHOLDS = (2, 3, 4, 5, 6, 8)


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]


def _compressor(dictionary: bytes):
    import zstandard

    content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    how = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, source_size=WINDOW, dict_size=len(dictionary), min_match=MATCH,
        write_content_size=0, write_checksum=0, write_dict_id=0,
    )
    content.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=content, compression_params=how).compress


class Savings:
    """The bytes that the toxic dictionary saves on every window of a text."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.plain, self.toxic = _compressor(ordinary), _compressor(ordinary + toxic)

    def __call__(self, text: bytes) -> np.ndarray:
        text, plain, toxic = text.lower(), self.plain, self.toxic
        starts = range(0, max(1, len(text) - WINDOW + STEP), STEP)
        return np.fromiter(
            (len(plain(w)) - len(toxic(w)) for w in (text[i : i + WINDOW] for i in starts)), np.int64, len(starts)
        )


def features(saved: np.ndarray) -> np.ndarray:
    top = np.sort(saved)[-3:]
    counts = [math.log1p(int((saved > t).sum())) for t in THRESHOLDS]
    return np.array([1.0, max(0, top[-1]), max(0, top.sum()), *counts, math.log1p(len(saved))])


def fit(toxic: list[bytes], ordinary: list[bytes]) -> ToxicityModel | None:
    """A model from labelled texts, or None if a class has fewer than three different ones."""
    toxic, ordinary = _different(toxic), _different(ordinary)
    if min(len(toxic), len(ordinary)) < 3:
        return None
    nt, no = len(toxic) * 2 // 3, len(ordinary) * 2 // 3
    words = _toxic_words(toxic[:nt], ordinary[:no])
    dictionary = _train(ordinary[:no])
    piece, size = [], 0
    for word, _ in words.most_common():
        if size < TOXIC_BYTES:
            piece.append(word)
            size += len(word)
    extra = b"".join(reversed(piece))  # the most frequent last, where matches are cheapest
    saving = Savings(dictionary, extra)
    rows = [features(saving(t)) for t in toxic[nt:] + ordinary[no:]]
    labels = np.array([1.0] * (len(toxic) - nt) + [0.0] * (len(ordinary) - no))
    return ToxicityModel(dictionary, extra, tuple(_logistic(np.array(rows), labels).tolist()))


def _different(texts: list[bytes]) -> list[bytes]:
    """One text of each set of copies, exact or near: those that share the least shingle hash."""
    kept = {}
    for text in texts:
        words = text.lower().split()
        shingles = (zlib.crc32(b" ".join(words[i : i + 5])) for i in range(max(1, len(words) - 4)))
        kept.setdefault(min(shingles), text.lower())
    return list(kept.values())


def _runs(word: bytes):
    return (word[i : i + n] for n in RUNS for i in range(len(word) - n + 1))


def _toxic_words(toxic: list[bytes], ordinary: list[bytes]) -> Counter:
    def counted(texts: list[bytes], among: set[bytes] | None = None) -> Counter:
        found = Counter()
        for text in texts:
            runs = {r for w in set(text.split()) for r in _runs(b" " + w)}
            found.update(runs if among is None else runs & among)
        return found

    # Only runs that enough toxic documents have are counted in the others.
    least = max(LEAST, SHARE * len(toxic))
    inside = {r: n for r, n in counted(toxic).items() if n >= least}
    outside = counted(ordinary, set(inside))
    bad = {
        r for r, n in inside.items()
        if n / len(toxic) > LIFT * (outside[r] + 1) / (len(ordinary) + 1 + LIFT)
    }
    words = Counter(
        b" " + w.strip(b".,;:!?\"'()") + b" " for t in toxic for w in t.split() if any(r in bad for r in _runs(b" " + w))
    )
    often = max(2, len(toxic) // 250)
    return Counter({w: n for w, n in words.items() if n >= often})


def _train(texts: list[bytes]) -> bytes:
    import zstandard

    parts = [t[i : i + 256] for t in texts for i in range(0, len(t), 256)]
    parts = parts[:: max(1, len(parts) // 20_000)]
    try:
        return zstandard.train_dictionary(ORDINARY_BYTES, parts).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself serves
        return b" ".join(parts)[-ORDINARY_BYTES:]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights by Newton steps; the first column, the constant, is not shrunk."""
    w = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(shrink), x.T @ (y - p) - shrink * w)
        w += np.clip(step, -5, 5)
    return w


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicityModel | None:
    """Fit on a bounded sample of the labelled rows outside the held-out fold."""
    order = F.xxhash64("doc_id")
    texts = []
    for value, bound in ((1, TOXIC), (0, ORDINARY)):
        ids = labels.filter((F.col("toxic") == value) & ~fold(0)).select("doc_id", order.alias("o"))
        ids = ids.orderBy("o").limit(bound).select("doc_id")
        # At most ``bound`` ids: small at any size of the tables.
        found = docs.filter(F.length("text") <= LONGEST).join(F.broadcast(ids), "doc_id", "left_semi")
        found = found.select("doc_id", utf8().alias("text")).limit(bound).toPandas()
        texts.append(list(found.sort_values(["doc_id", "text"])["text"]))
    model = fit(*texts)
    del texts, found
    give_back()
    return model


def toxicity(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """doc_id, held_out and score of every row, scored on its whole text."""

    def make():
        saving = Savings(model.ordinary, model.toxic) if model else None
        weights = np.array(model.weights) if model else None

        def work(rows):
            if model is None:
                scores = [0.0] * len(rows["text"])
            else:
                scores = [float(1 / (1 + np.exp(-np.clip(features(saving(t)) @ weights, -30, 30)))) for t in rows["text"]]
            return {"doc_id": rows["doc_id"], "held_out": rows["held_out"], "score": scores}

        return work

    rows = docs.select("doc_id", fold(0).alias("held_out"), utf8().alias("text"))
    return map_rows(rows, make, "doc_id long, held_out boolean, score double")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    model = fit_toxicity(docs, labels)
    if model is None:
        return docs

    def score(texts: pa.Array) -> pa.Array:
        saving, weights = Savings(model.ordinary, model.toxic), np.array(model.weights)
        return pa.array([float(1 / (1 + np.exp(-np.clip(features(saving(t)) @ weights, -30, 30)))) for t in texts.to_pylist()])

    return docs.filter(F.arrow_udf(score, T.DoubleType())(utf8()) < threshold)


def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
