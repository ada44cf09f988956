"""Removal of repeated passages by distributed suffix sorting.

A byte goes if a string of ``LENGTH`` bytes over it also starts somewhere else. Whether a
string repeats is settled where all strings that could equal it meet:

1. Every string has an anchor, the ``GRAM`` bytes in it with the least hash (leftmost of equal
   ones), so equal strings have equal anchors at the same distance. Strings with one anchor are
   neighbours; their stretch of text is a slice. Chunks of documents send hashes of anchors and
   slices to buckets, each pair once.
2. An anchor found once settles all its strings: none repeats. A slice found twice settles its
   strings: all repeat. What is left are slices that share an anchor but not all bytes, at the
   edges of repeated passages.
3. Those slices meet by anchor, and deep-shallow sorting of the suffixes at their strings'
   starts puts equal strings side by side. An anchor with more than ``HOT`` different slices,
   such as a passage found in a third of all documents, is not gathered: its strings are looked
   up by hash in another round of buckets, each string once per chunk.

Defined results: a null text is empty; texts shorter than ``LENGTH`` keep all bytes; repeated
rows are different places, so their strings repeat; slices and hot strings are told apart by 64
or more hash bits; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import ANSWERED, SENT, Buckets, answer, answers_by_kind, chain, in_chunks, mix, pack, send, text_bytes
from .common import table, to_arrow
from .suffix_sort import sort_suffixes

LENGTH, GRAM = 400, 200
HOT = 2000
CHUNK = 8 << 20
#: Answers for a slice: no other anchor, repeated, and to be sorted or looked up (plus repeated).
ALONE, REPEATED, SORT, SHOW, LOOK, LOOK_REPEATED = range(6)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTES = mix(np.arange(1, 257, dtype=np.uint64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    step = int(base)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(step)])
        step = step * step % (1 << 64)
    return out[:n]


_TABLES = [np.ones(0, np.uint64)] * 2
#: Powers up to this length are kept; longer texts make their own.
_KEPT = 1 << 18


def _tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse."""
    if n > _KEPT:
        return [_powers(b, n) for b in (_BASE, _INVERSE)]
    if len(_TABLES[0]) < n:
        _TABLES[:] = [_powers(b, min(_KEPT, 2 * n)) for b in (_BASE, _INVERSE)]
    return _TABLES


class Prefixes:
    """Hashes of any substring from sums over prefixes."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        powers, self.inverse = _tables(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[text] * powers[:n], out=self.sums[1:])

    def hash(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])


def _least(values: np.ndarray, width: int, function=np.minimum, fill=np.uint64(2**64 - 1)) -> np.ndarray:
    """Minimum of every ``width`` neighbouring values, from running minima of blocks."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, fill, np.uint64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    left = function.accumulate(blocks, axis=1).ravel()
    right = function.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return function(right[: n - width + 1], left[width - 1 : n])


class Anchors:
    """The anchors of the texts of a chunk, laid end to end.

    text, at (the anchor), low and high (its first and last string), anchor and slice hashes.
    """

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        found = [self._of(i, t) for i, t in enumerate(texts) if len(t) >= LENGTH]
        columns = zip(*found) if found else [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)] * 2
        parts = [np.concatenate(c) if found else c for c in columns]
        self.text, self.at, self.low, self.high, self.anchor, self.slice = parts

    @staticmethod
    def _of(number: int, text: bytes):
        data = np.frombuffer(text, np.uint8)
        sums = Prefixes(data)
        n = len(data) - GRAM + 1
        grams = mix((sums.sums[GRAM:] - sums.sums[:n]) * sums.inverse[:n])
        width = LENGTH - GRAM + 1
        least = _least(grams, width)  # of the string that starts here
        padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
        places = np.flatnonzero(_least(padded, width, np.maximum, np.uint64(0)) == grams)
        starts = np.arange(len(least))
        which = np.searchsorted(places, starts)
        wrong = np.flatnonzero(grams[places[which]] != least)
        while len(wrong):
            which[wrong] += 1
            wrong = wrong[grams[places[which[wrong]]] != least[wrong]]
        used, low = np.unique(which, return_index=True)
        high = np.concatenate([low[1:], [len(least)]]) - 1
        at = places[used]
        whole = chain(sums.hash(low, high + LENGTH), mix((at - low).astype(np.uint64) * np.uint64(1009) + (high - low).astype(np.uint64) + np.uint64(1)))
        return np.full(len(at), number), at, low, high, grams[at], whole

    def strings(self, which: np.ndarray):
        """For each string of the given anchors: index of the anchor, start, hash."""
        counts = (self.high - self.low + 1)[which]
        owner = np.repeat(which, counts)
        start = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + self.low[owner]
        hashes = np.zeros(len(owner), np.uint64)
        for text in np.unique(self.text[which]).tolist():
            own = self.text[owner] == text
            sums = Prefixes(np.frombuffer(self.texts[text], np.uint8))
            hashes[own] = sums.hash(start[own], start[own] + LENGTH)
        return owner, start, chain(hashes, self.anchor[owner])


def _once(first: np.ndarray, second: np.ndarray):
    """Different pairs in order, whether each occurs again, and the pair of each entry."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    which = np.zeros(len(a), np.int64)
    which[order] = np.cumsum(new) - 1
    counts = np.bincount(which, minlength=int(new.sum())) if len(a) else np.zeros(0, int)
    return a[new], b[new], counts > 1, which


def _slices(found: Anchors):
    """anchor hashes, slice hashes whose last bit tells "again in this chunk", pair of each anchor."""
    anchors, slices, again, which = _once(found.anchor, found.slice & ~np.uint64(1))
    return anchors, slices | again.astype(np.uint64), which


def _judge(which, values, row, most: int):
    """Answers for the slices of a bucket; ``which`` numbers anchors."""
    slices, again = values & ~np.uint64(1), (values & np.uint64(1)).astype(bool)
    order = np.lexsort((row, slices, which))
    a, s = which[order], slices[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (s[1:] != s[:-1])
    group = np.cumsum(new) - 1
    size = np.bincount(group)
    repeated = (size > 1) | (np.bincount(group, again[order]) > 0)
    first = np.flatnonzero(new)
    kinds = np.bincount(a[first], minlength=int(which.max()) + 1)[a]  # different slices of the anchor
    out = np.full(len(a), ALONE)
    rep = repeated[group]
    out[rep] = REPEATED
    several = kinds > 1
    out[several & ~rep] = SORT
    out[several & rep & new] = SHOW
    hot = several & (kinds > most)
    out[hot & ~rep] = LOOK
    out[hot & rep & new] = LOOK_REPEATED
    answers = np.zeros(len(a), np.uint64)
    answers[order] = out
    return answers


SLICES = "anchor long, chunk long, text int, low int, offset int, known boolean, slice binary"


def remove_repeats(docs: DataFrame, chunk: int = CHUNK, most: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (starts and ends) of every row."""
    count = 1 + text_bytes(docs) // chunk
    chunked = in_chunks(docs, count)

    def anchors_of(left) -> Anchors:
        return Anchors(_sorted(left)["text"].to_pylist())

    def first(left):
        anchors, slices, _ = _slices(anchors_of(left))
        yield 0, anchors, slices

    answered = answer(send(chunked, first, count), lambda kind, which, values, row: _judge(which, values, row, most))

    def statuses(found: Anchors, answers: dict) -> np.ndarray:
        anchors, _, which = _slices(found)
        return Buckets(anchors, count).gather(answers.get(0, {}), len(anchors))[which]

    # Slices at the edges of repeated passages, to meet by anchor.
    slice_schema = to_arrow(SLICES)

    def edges(key, left, right):
        answers = answers_by_kind(right)
        if not any(((a == SORT) | (a == SHOW)).any() for a in answers.get(0, {}).values()):
            return _arrow([], slice_schema)
        found = anchors_of(left)
        status = statuses(found, answers)
        rows, shown = [], set()
        for i in np.flatnonzero((status == SORT) | (status == SHOW)).tolist():
            known = bool(status[i] == SHOW)
            pair = (int(found.anchor[i]), int(found.slice[i]))
            if known and pair in shown:
                continue
            shown.add(pair)
            low, high = int(found.low[i]), int(found.high[i])
            text = found.texts[found.text[i]][low : high + LENGTH]
            rows.append((int(found.anchor[i].astype(np.int64)), key[0].as_py(), int(found.text[i]), low, int(found.at[i]) - low, known, text))
        return _arrow(rows, slice_schema)

    sliced = chunked.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(edges, SLICES)
    spread = sliced.withColumn("bucket", F.pmod("anchor", F.lit(count)))
    resolved_schema = to_arrow(ANSWERED)

    def resolve(slices):
        return _arrow(_resolve(slices), resolved_schema)

    resolved = spread.groupBy("bucket").applyInArrow(resolve, ANSWERED)

    # Strings of hot anchors, looked up by hash.
    def hot_strings(found: Anchors, status: np.ndarray):
        which = np.flatnonzero((status == LOOK) | (status == LOOK_REPEATED))
        owner, start, hashes = found.strings(which)
        keys, index, n = np.unique(hashes, return_inverse=True, return_counts=True)
        return owner, start, keys, index, n

    sent_schema = to_arrow(SENT)

    def hot(key, left, right):
        answers = answers_by_kind(right)
        if not any((a >= LOOK).any() for a in answers.get(0, {}).values()):
            return _arrow([], sent_schema)
        found = anchors_of(left)
        _, _, keys, _, n = hot_strings(found, statuses(found, answers))
        rows = [
            (key[0].as_py(), 1, bucket, keys[at].astype("<u8").tobytes(), pack(n[at]))
            for bucket, at in Buckets(keys, count).parts.items()
        ]
        return _arrow(rows, sent_schema)

    sent = chunked.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(hot, SENT)
    looked = answer(sent, lambda kind, which, n, row: (np.bincount(which, n)[which] > 1).astype(np.uint64))

    out_ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"
    out_schema = to_arrow(out_ddl)

    def final(left, right):
        found = anchors_of(left)
        answers = answers_by_kind(right.filter(pc.less(right["kind"], 2)))
        status = statuses(found, answers)
        deltas = [np.zeros(len(t) + 1, np.int64) for t in found.texts]

        def cover(text, start, end):
            deltas[text][start] += 1
            deltas[text][end] -= 1

        for i in np.flatnonzero((status == REPEATED) | (status == SHOW) | (status == LOOK_REPEATED)).tolist():
            cover(found.text[i], found.low[i], found.high[i] + LENGTH)
        owner, start, keys, index, _ = hot_strings(found, status)
        if len(keys):
            repeats = Buckets(keys, count).gather(answers.get(1, {}), len(keys))[index] > 0
            for i, s in zip(owner[repeats].tolist(), start[repeats].tolist()):
                cover(found.text[i], s, s + LENGTH)
        for kind, data in zip(right["kind"].to_pylist(), right["answers"].to_pylist()):
            if kind == 2:
                for text, s, e in np.frombuffer(data, "<i8").reshape(-1, 3).tolist():
                    cover(text, s, e)
        rows = []
        for doc, text, delta in zip(_sorted(left)["doc_id"].to_pylist(), found.texts, deltas):
            gone = np.cumsum(delta[:-1]) > 0
            turns = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            rows.append((doc, len(text), int(gone.sum()), len(turns) // 2, hashlib.sha256(kept).hexdigest(), turns.tolist()))
        return _arrow(rows, out_schema)

    everything = answered.unionByName(resolved).unionByName(looked)
    return chunked.groupBy("chunk").cogroup(everything.groupBy("chunk")).applyInArrow(final, out_ddl)


def _sorted(left):
    """A chunk's rows in an order that every pass finds again."""
    return left.select(["doc_id", "text"]).sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _resolve(slices) -> list[tuple]:
    """Repeated strings among the slices of a bucket: rows of kind 2 per chunk."""
    columns = [slices[n].to_pylist() for n in ("chunk", "text", "low", "known", "slice", "anchor")]
    pieces = columns[4]
    if not pieces:
        return []
    lengths = np.array([len(p) for p in pieces], np.int64)
    offsets = np.cumsum(lengths) - lengths
    counts = lengths - LENGTH + 1
    owner = np.repeat(np.arange(len(pieces)), counts)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    order, classes = sort_suffixes(b"".join(pieces), offsets[owner] + start, LENGTH)
    repeats = np.zeros(len(owner), bool)
    repeats[order] = np.bincount(classes, minlength=len(order) + 1)[classes] > 1
    out: dict[int, list] = {}
    known = np.array(columns[3], bool)
    for i in np.flatnonzero(repeats & ~known[owner]).tolist():
        o = owner[i]
        low = columns[2][o] + int(start[i])
        spans = out.setdefault(columns[0][o], [])
        text = columns[1][o]
        if spans and spans[-1][0] == text and spans[-1][1] <= low <= spans[-1][2]:
            spans[-1] = (text, spans[-1][1], max(spans[-1][2], low + LENGTH))
        else:
            spans.append((text, low, low + LENGTH))
    return [(c, 2, 0, np.array(s, "<i8").tobytes()) for c, s in out.items()]


def op7_suffix_dedup(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans")
