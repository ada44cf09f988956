"""Alignment of two tokenizers' tokens, from byte-range fragments that compose.

Byte offsets where a token of A and a token of B both end cut a text into groups. A *fragment* holds
what a byte range knows of that: an open prefix (tokens up to its first common end), the closed
groups after it, and an open suffix; a range without a common end is all prefix. Fragments of
neighbouring ranges compose, and composing is associative: the suffix of one and the prefix of the
next become a closed group. So a very long text is cut into byte ranges anywhere, the ranges go to
different tasks, and a tree of tasks composes their fragments.

Neither tokenizer joins what a space behind a non-space parts, so both encode a text stretch by
stretch between such spaces, and each different stretch of a task once. A range encodes the
stretches that reach into it and keeps the tokens that end inside it. Vocabularies without that
property are refused. By the same property new stretches are laid end to end and encoded as one text;
the ids are parted where a stretch's bytes end, and compared with its bytes.

Each text is encoded once: its numbers and links are stored, and looked up when the counts are known.

Counts of linked id pairs run over all texts. Of two tokens that end together one's bytes end the
other's, so the pairs are at most ``pair_bound(a, b)`` (under a million for these vocabularies),
whatever the corpus: their table is summed by Spark and then sent to the tasks.

Defined results: null and empty texts, and those whose tokens' bytes are not the space and the text,
have no tokens: zeros and an empty string; repeated rows count each; null ids stay null; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from dataclasses import dataclass, field, replace
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import give_back, table, to_arrow
from .words import blocks, ranges, split_words, tokenizer_path

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of a range, fragments that a task composes at a time, stretches a worker remembers and bytes of them.
RANGE, FAN, REMEMBERED, HELD = 1 << 15, 16, 350_000, 1 << 26
#: Stretches that are given to the tokenizers at a time, bytes of text that are aligned at a time.
ENCODED, BLOCK = 10_000, 4 << 20
#: Stretches, and bytes of them, that are laid end to end and encoded as one text; a stretch that goes before them.
JOINED, JOINED_BYTES, LEAD = 128, 1 << 13, " a"
#: Pair codes: A's id times this plus B's id.
BASE = 1 << 32

_SPACE = r"\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: Texts with white space other than single spaces and newlines, or with a space behind white space.
_UNUSUAL = rf"[{_SPACE}]|[ \n] |^[ \n]"
_SPACED = rf"[ \n{_SPACE}]$"
_CUT = re.compile("(?<=[^\\s᠎])(?= )")


# The monoid ----------------------------------------------------------------------


def group_text(a, b) -> str:
    return f"{','.join(map(str, a))}|{','.join(map(str, b))}"


@dataclass(frozen=True)
class Fragment:
    """A byte range's open prefix, closed groups (as texts) and open suffix; the default is neutral."""

    head: tuple[list[int], list[int]] = ([], [])
    cuts: int = 0
    closed: list[str] = field(default_factory=list)
    tail: tuple[list[int], list[int]] = ([], [])
    n_a: int = 0
    n_b: int = 0
    ok: bool = True

    @staticmethod
    def of(a_ids, a_ends, b_ids, b_ends) -> Fragment:
        """From the tokens that end in the range."""
        _, ia, ib = np.intersect1d(a_ends, b_ends, assume_unique=True, return_indices=True)
        a, b = list(map(int, a_ids)), list(map(int, b_ids))
        if not len(ia):
            return Fragment((a, b), n_a=len(a), n_b=len(b))
        ia, ib = (ia + 1).tolist(), (ib + 1).tolist()
        closed = [group_text(a[p:q], b[r:s]) for p, q, r, s in zip(ia, ia[1:], ib, ib[1:])]
        return Fragment((a[: ia[0]], b[: ib[0]]), len(ia), closed, (a[ia[-1] :], b[ib[-1] :]), len(a), len(b))

    def then(self, other: Fragment) -> Fragment:
        """The fragment of both ranges."""
        sums = dict(cuts=self.cuts + other.cuts, n_a=self.n_a + other.n_a, n_b=self.n_b + other.n_b, ok=self.ok and other.ok)
        if not self.cuts:
            head = (self.head[0] + other.head[0], self.head[1] + other.head[1])
            return replace(other, head=head, **sums)
        joined = (self.tail[0] + other.head[0], self.tail[1] + other.head[1])
        if not other.cuts:
            return replace(self, tail=joined, **sums)
        return replace(self, closed=[*self.closed, group_text(*joined), *other.closed], tail=other.tail, **sums)

    def text(self) -> str:
        """All groups of a whole text."""
        return ";".join([group_text(*self.head), *self.closed])


def compose(fragments: list[Fragment]) -> Fragment:
    """The fragment of neighbouring ranges in order, each closed part copied once per tree level."""
    if len(fragments) < 3:
        return reduce(Fragment.then, fragments, Fragment())
    half = len(fragments) // 2
    return compose(fragments[:half]).then(compose(fragments[half:]))


# The tokenizers ------------------------------------------------------------------


def byte_alphabet() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte, to the byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def a_bytes(path: str) -> list[bytes]:
    """The bytes of A's tokens by id."""
    with open(path) as file:
        told = json.load(file)
    cut = told["pre_tokenizer"] or {}
    if told["normalizer"] or cut.get("type") != "ByteLevel" or not cut.get("use_regex", True) or cut.get("add_prefix_space"):
        raise ValueError("A must be a byte-level vocabulary that cuts words and leaves texts as they are")
    byte = byte_alphabet()
    words = told["model"]["vocab"]
    out = [b""] * (1 + max(words.values()))
    for word, i in words.items():
        out[i] = bytes(byte[c] for c in word if c in byte)
    return out


def b_bytes(pieces) -> list[bytes]:
    """The bytes of B's pieces by id."""
    out = []
    for i in range(pieces.vocab_size()):
        piece = pieces.id_to_piece(i)
        if "▁" in piece.lstrip("▁") or "\n" in piece:
            raise ValueError("B's pieces must not go across a space or a newline")
        out.append(bytes([int(piece[1:-1], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode())
    return out


def pair_bound(a: list[bytes], b: list[bytes]) -> int:
    """The most pairs that can end together: one token's bytes end the other's."""
    by_a, by_b = {}, {}
    for tokens, by in ((a, by_a), (b, by_b)):
        for t in tokens:
            by[t] = by.get(t, 0) + 1
    found = sum(by_b.get(t[i:], 0) for t in a for i in range(len(t)))
    return found + sum(by_a.get(t[i:], 0) for t in b for i in range(1, len(t)))


class Aligner:
    """Encodes texts by both tokenizers, each different stretch once, and keeps the stretches' groups."""

    def __init__(self, a_path: str, b_path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        self.a_bytes, self.b_bytes = a_bytes(a_path), b_bytes(self.b)
        self.a_size = np.array(list(map(len, self.a_bytes)), np.int64)
        self.b_size = np.array(list(map(len, self.b_bytes)), np.int64)
        self.tables = [pa.array(t, pa.binary()) for t in (self.a_bytes, self.b_bytes)]
        # What stands in a group's text for an id that others follow there, and for the last one.
        self.shown = pa.array([f"{i}{sign}" for t, last in ((self.a_bytes, "|"), (self.b_bytes, ";")) for i in range(len(t)) for sign in (",", last)])
        self.narrow = max(len(self.a_bytes), len(self.b_bytes)) <= 1 << 16
        self.space, self.limit = self.b.piece_to_id("▁"), remembered
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.string())
        self.ok = np.zeros(0, bool)
        none, zero = np.zeros(0, np.int64), np.zeros(1, np.int64)
        # By stretch: A's ids, B's ids, links, as flat arrays and where each stretch ends in them.
        self.flat, self.ends = [none] * 3, [zero] * 3
        #: The texts of each stretch's groups, each closed by a semicolon.
        self.texts = pa.array([], pa.string())

    def full(self) -> bool:
        """True if the stretches are too many or too long."""
        return len(self.words) > self.limit or self.words.nbytes + self.texts.nbytes > HELD

    def make_room(self) -> bool:
        """Forget all stretches if the memory for them is full."""
        if not self.full():
            return False
        self._forget()
        return True

    def _alone(self, new: list[str]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        """Both tokenizers' ids of stretches encoded one by one, and which stretches they make up."""
        a, b = [], []
        for at in range(0, len(new), ENCODED):  # the libraries' own results are much larger than the ids
            part = new[at : at + ENCODED]
            a += [e.ids for e in self.a.encode_batch_fast(part, add_special_tokens=False)]
            b += self.b.encode([s[1:] if s[0] == " " else s for s in part], num_threads=1)
        # An empty text gets no space in front.
        b = [[self.space] if s == " " else ids if s[0] == " " else ids[1:] if ids[:1] == [self.space] else [] for ids, s in zip(b, new)]
        a_of, b_of = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        same = (b"".join(map(a_of, x)) == s.encode() == b"".join(map(b_of, y)) for x, y, s in zip(a, b, new))
        ok = np.fromiter(same, bool, len(new))
        for i in np.flatnonzero(~ok).tolist():
            a[i] = b[i] = []
        return a, b, ok

    def _together(self, words: pa.Array):
        """Stretches laid end to end and encoded many at a time.

        For A and B: the ids, their number by stretch; last, which stretches both tokenizers make up.
        The others, and those behind which the tokenizers may not part, are left out: they count 0.
        """
        ends = np.append(0, np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)))
        data = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), "")[0].as_buffer().to_pybytes()
        # Nothing is laid behind a stretch that ends in white space.
        cuts = np.flatnonzero(pc.match_substring_regex(words, _SPACED).to_numpy(zero_copy_only=False))
        long = np.searchsorted(ends, np.arange(0, len(data), JOINED_BYTES))
        bounds = np.unique(np.concatenate([np.arange(0, len(words), JOINED), long, cuts, cuts + 1, [len(words)]]))
        spaced = set(cuts.tolist())
        groups = [(p, q) for p, q in zip(bounds.tolist(), bounds[1:].tolist()) if p not in spaced]
        fine = np.zeros(len(words), bool)
        counts = np.zeros((2, len(words)), np.int64)
        ids: list[list[np.ndarray]] = [[], []]
        for at in range(0, len(groups), ENCODED // JOINED + 1):
            some = groups[at : at + ENCODED // JOINED + 1]
            raw = [data[ends[p] : ends[q]] for p, q in some]
            texts = [LEAD + r.decode() for r in raw]
            found = (
                [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)],
                self.b.encode([t[1:] for t in texts], num_threads=1),
            )
            for (p, q), r, *both in zip(some, raw, *found):
                parts = [self._parted(k, x, r, ends[p + 1 : q + 1] - ends[p]) for k, x in enumerate(both)]
                if None not in parts:
                    fine[p:q] = True
                    for k, (own, n) in enumerate(parts):
                        ids[k].append(own)
                        counts[k, p:q] = n
        return *([np.concatenate([np.zeros(0, np.int64), *x]) for x in ids]), counts, fine

    def _parted(self, k: int, ids: list[int], raw: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of the stretches that end there, and how many each has; None if the ids are not the bytes."""
        ids = np.array(ids, np.int64)
        sizes = (self.a_size, self.b_size)[k][ids]
        last = np.cumsum(sizes) - len(LEAD)
        first = int(np.searchsorted(last, 0, "right"))
        ids, last, before = ids[first:], last[first:], last[first - 1] if first else -1
        if before or not len(last) or last[-1] != ends[-1] or not sizes.all():
            return None
        at = np.searchsorted(last, ends)
        if not np.array_equal(last[at], ends) or self.tables[k].take(pa.array(ids)).buffers()[2].to_pybytes()[: len(raw)] != raw:
            return None
        return ids, np.diff(at + 1, prepend=0)

    def _learn(self, new: pa.Array) -> None:
        a, b, counts, ok = self._together(new)
        left = np.flatnonzero(~ok)
        if len(left):
            *more, fine = self._alone(new.take(pa.array(left)).to_pylist())
            flat = []
            for k, (ids, own) in enumerate(zip((a, b), more)):
                n = np.fromiter(map(len, own), np.int64, len(own))
                begins = np.cumsum(counts[k]) - counts[k]
                begins[left], counts[k, left] = len(ids) + np.cumsum(n) - n, n
                flat.append(np.append(ids, np.fromiter(chain.from_iterable(own), np.int64))[ranges(begins, counts[k])])
            a, b = flat
            ok[left] = fine
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        place = np.full(int(a_ends[-1]) + 1 if len(a) else 1, -1)
        place[a_ends] = np.arange(len(a))
        ia = place[b_ends]
        ib = np.flatnonzero(ia >= 0)
        ia = ia[ib]
        links = np.diff(np.searchsorted(ia, np.cumsum(counts[0])), prepend=0)
        self.texts = pa.concat_arrays([self.texts, self._shown(a, b, ia, ib, counts)])
        self.words = pa.concat_arrays([self.words, new])
        self.ok = np.append(self.ok, ok)
        for k, (values, n) in enumerate(((a, counts[0]), (b, counts[1]), (a[ia] * BASE + b[ib], links))):
            self.flat[k] = np.append(self.flat[k], values)
            self.ends[k] = np.append(self.ends[k], self.ends[k][-1] + np.cumsum(n))

    def _shown(self, a, b, ia, ib, counts) -> pa.Array:
        """The texts of each stretch's groups, from the ids in the groups' order."""
        n_a, n_b = np.diff(ia, prepend=-1), np.diff(ib, prepend=-1)
        codes = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[ia] = last_b[ib] = 1
        codes[np.arange(len(a)) + np.repeat(ib + 1 - n_b, n_a)] = 2 * a + last_a
        codes[np.arange(len(b)) + np.repeat(ia + 1, n_b)] = 2 * (len(self.a_bytes) + b) + last_b
        shown = self.shown.take(pa.array(codes))
        ends = _offsets(shown)[np.append(0, np.cumsum(counts.sum(axis=0)))]
        return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), shown.buffers()[2])

    def numbers(self, words: pa.Array) -> np.ndarray:
        """Numbers of different stretches; what is new is encoded."""
        found = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(found))
        out = pc.fill_null(found, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        if len(new):
            out[pc.is_null(found).to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(len(new))
            self._learn(new)
        return out

    def stretches(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The stretches' numbers of texts that are not empty, in order, and how many each text has."""
        unusual = pc.match_substring_regex(texts, _UNUSUAL)
        slow = np.flatnonzero(unusual.to_numpy(zero_copy_only=False))
        fast = np.flatnonzero(~unusual.to_numpy(zero_copy_only=False))
        parted = pc.replace_substring_regex(texts.take(pa.array(fast)) if len(slow) else texts, "\n+", " \\0")
        codes, counts, words = split_words(parted, lambda t: pc.split_pattern(t, " "))
        # A text's first stretch starts with the space that goes before the text.
        codes = self.numbers(pc.binary_join_element_wise(pc.if_else(pc.starts_with(words, "\n"), "", " "), words, ""))[codes]
        if not len(slow):
            return codes, counts
        cut = [_CUT.split(" " + t) for t in texts.take(pa.array(slow)).to_pylist()]
        coded = pa.array([w for words in cut for w in words], pa.string()).dictionary_encode()
        more = self.numbers(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = np.zeros(len(texts), np.int64)
        sizes[fast], sizes[slow] = counts, list(map(len, cut))
        begins = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), np.int64)
        out[ranges(begins[fast], counts)] = codes
        out[ranges(begins[slow], sizes[slow])] = more
        return out, sizes

    def hashes(self, codes: np.ndarray, counts: np.ndarray, ok: np.ndarray) -> list[str]:
        """sha256 of the group texts of each text's stretches, empty where the text is not ok."""
        shown = self.texts.take(pa.array(codes))
        data, ends = memoryview(shown.buffers()[2] or b""), _offsets(shown)[np.append(0, np.cumsum(counts))].tolist()
        return [hashlib.sha256(data[p : q - 1]).hexdigest() if fine else "" for p, q, fine in zip(ends, ends[1:], ok.tolist())]

    def of(self, k: int, codes: np.ndarray) -> np.ndarray:
        """A's ids (0), B's ids (1) or links (2) of stretches in order."""
        first = self.ends[k][codes]
        return self.flat[k][ranges(first, self.ends[k][codes + 1] - first)]

    def sizes(self, k: int) -> np.ndarray:
        return np.diff(self.ends[k])


def _offsets(strings: pa.Array) -> np.ndarray:
    """Where the strings of an array begin in its bytes, and where the last one ends."""
    if not len(strings):
        return np.zeros(1, np.int32)
    return np.frombuffer(strings.buffers()[1], np.int32)[strings.offset : strings.offset + len(strings) + 1]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(files: tuple[str, str] | None) -> Aligner:
    """One aligner per worker process and pair of vocabularies; it outlives the task."""
    files = files or (tokenizer_path(A_FILE), tokenizer_path(B_FILE))
    if files not in _ALIGNERS:
        _ALIGNERS[files] = Aligner(*files)
    return _ALIGNERS[files]


# Very long texts -------------------------------------------------------------------


def safe(whole: bytes, at: int) -> bool:
    """True if both tokenizers part the text before the space at ``at``."""
    before = whole[max(0, at - 4) : at].decode(errors="ignore")[-1:]
    return bool(before) and not before.isspace() and before != "᠎"


def window(whole: bytes, start: int, end: int) -> tuple[int, int]:
    """The least stretch between safe cuts that covers a byte range."""
    low = whole.rfind(b" ", 0, start + 1)
    while low > 0 and not safe(whole, low):
        low = whole.rfind(b" ", 0, low)
    high = whole.find(b" ", end)
    while high >= 0 and not safe(whole, high):
        high = whole.find(b" ", high + 1)
    return max(low, 0), high if high >= 0 else len(whole)


WINDOWS = "key long, doc_id long, parts long, idx long, low long, start long, end long, stretch string"
FRAGMENTS = (
    "key long, doc_id long, parts long, idx long, ok boolean, n_a long, n_b long, cuts long, head_a array<int>, head_b array<int>, "
    "closed string, tail_a array<int>, tail_b array<int>, pairs array<long>, counts array<long>"
)


def windows(docs: DataFrame, size: int) -> DataFrame:
    """WINDOWS of texts (key, doc_id, text): every byte range with the stretch that covers it."""
    schema = to_arrow(WINDOWS)

    def run(batches):
        for batch in batches:
            for key, doc, text in zip(*(batch.column(n).to_pylist() for n in ("key", "doc_id", "text"))):
                whole = b" " + text.encode()
                parts = -(-len(whole) // size)
                rows = []
                for idx in range(parts):
                    start, end = idx * size, min(len(whole), (idx + 1) * size)
                    low, high = window(whole, start, end)
                    rows.append((key, doc, parts, idx, low, start, end, whole[low + 1 : high].decode()))
                    if len(rows) == 64 or idx == parts - 1:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows = []

    return docs.mapInArrow(run, WINDOWS)


def _row(key, doc, parts, idx, f: Fragment, pairs, counts) -> tuple:
    return (key, doc, parts, idx, f.ok, f.n_a, f.n_b, f.cuts, *f.head, ";".join(f.closed), *f.tail, pairs, counts)


def fragments(cut: DataFrame, files) -> DataFrame:
    """FRAGMENTS of the windows' byte ranges."""
    schema = to_arrow(FRAGMENTS)

    def run(batches):
        known = aligner(files)
        for batch in batches:
            for at, n in blocks(batch.column("stretch"), BLOCK):
                known.make_room()
                part = batch.slice(at, n)
                # A stretch of one space alone is the space before an empty rest.
                there = pc.greater(pc.binary_length(part.column("stretch")), 0).to_numpy(zero_copy_only=False)
                lone = known.numbers(pa.array([" "]))
                codes, counts = known.stretches(part.column("stretch").filter(pa.array(there)))
                own = iter(np.split(codes, np.cumsum(counts)[:-1]) if len(counts) else [])
                rows = []
                columns = (part.column(c).to_pylist() for c in ("key", "doc_id", "parts", "idx", "low", "start", "end"))
                for key, doc, parts, idx, low, start, end, real in zip(*columns, there.tolist()):
                    rows.append(fragment(known, next(own) if real else lone, key, doc, parts, idx, low, start, end))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        give_back()

    def fragment(known, codes, key, doc, parts, idx, low, start, end):
        if not known.ok[codes].all():
            return _row(key, doc, parts, idx, Fragment(ok=False), [], [])
        a, b = known.of(0, codes), known.of(1, codes)
        a_ends, b_ends = low + np.cumsum(known.a_size[a]), low + np.cumsum(known.b_size[b])
        a_in, b_in = (a_ends > start) & (a_ends <= end), (b_ends > start) & (b_ends <= end)
        a, a_ends, b, b_ends = a[a_in], a_ends[a_in], b[b_in], b_ends[b_in]
        _, ia, ib = np.intersect1d(a_ends, b_ends, assume_unique=True, return_indices=True)
        pairs, counts = np.unique(a[ia] * BASE + b[ib], return_counts=True)
        return _row(key, doc, parts, idx, Fragment.of(a, a_ends, b, b_ends), pairs, counts)

    return cut.mapInArrow(run, FRAGMENTS)


def _compose_rows(key, rows: pa.Table, schema: pa.Schema) -> pa.Table:
    rows = rows.sort_by("idx").to_pylist()
    parts = [
        Fragment((r["head_a"], r["head_b"]), r["cuts"], [r["closed"]] if r["closed"] else [], (r["tail_a"], r["tail_b"]), r["n_a"], r["n_b"], r["ok"])
        for r in rows
    ]
    pairs, which = np.unique(np.concatenate([np.array(r["pairs"], np.int64) for r in rows]), return_inverse=True)
    counts = np.bincount(which, np.concatenate([np.array(r["counts"], np.int64) for r in rows]), len(pairs)).astype(np.int64)
    first = rows[0]
    row = _row(first["key"], first["doc_id"], -(-first["parts"] // FAN), key[1].as_py(), compose(parts), pairs, counts)
    return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)


def composed(found: DataFrame) -> DataFrame:
    """One fragment per text: every round composes ``FAN`` neighbours."""
    schema = to_arrow(FRAGMENTS)
    while (found.agg(F.max("parts")).first()[0] or 1) > 1:
        grouped = found.withColumn("up", F.floor(F.col("idx") / FAN).cast("long")).groupBy("key", "up")
        found = stored(grouped.applyInArrow(lambda key, rows: _compose_rows(key, rows.drop_columns("up"), schema), FRAGMENTS), "composed")
    return found


# The corpus ------------------------------------------------------------------------

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _usual(docs: DataFrame, size: int) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter(F.octet_length("text") < size)


#: A text's numbers, its links as packed pairs and its groups; rows with pairs sum up the links of many texts.
ENCODED_TEXTS = (
    "doc_id long, n_a long, n_b long, n_links long, links binary, groups_sha256 string, pairs array<long>, counts array<long>"
)


def encoded(docs: DataFrame, files, size: int) -> DataFrame:
    """ENCODED_TEXTS of texts below ``size``, with sums of their links once per task."""
    schema = to_arrow(ENCODED_TEXTS)

    def record(*columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def sums(known: Aligner, uses: np.ndarray) -> pa.RecordBatch:
        uses = np.append(uses, np.zeros(len(known.ok) - len(uses), np.int64))
        weight = np.repeat(uses, known.sizes(2))
        pairs, which = np.unique(known.flat[2][weight > 0], return_inverse=True)
        counts = np.bincount(which, weight[weight > 0], len(pairs)).astype(np.int64)
        return record(*[[None]] * 6, [pairs], [counts])

    def run(batches):
        known, uses = aligner(files), np.zeros(0, np.int64)
        for batch in batches:
            for at, n in blocks(batch.column(1), BLOCK):
                ids, texts = batch.column(0).slice(at, n), batch.column(1).slice(at, n)
                if known.full():
                    yield sums(known, uses)
                    known.make_room()
                    uses = np.zeros(0, np.int64)
                there = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
                out = [np.zeros(n, np.int64) for _ in range(3)]
                hashes, links = np.full(n, "", object), np.zeros(0, np.int64)
                if there.any():
                    codes, counts = known.stretches(texts.take(pa.array(np.flatnonzero(there))))
                    begins = np.cumsum(counts) - counts
                    fine = np.logical_and.reduceat(known.ok[codes], begins)
                    for k, values in enumerate(map(known.sizes, range(3))):
                        out[k][there] = np.where(fine, np.add.reduceat(values[codes], begins), 0)
                    hashes[there] = known.hashes(codes, counts, fine)
                    codes = codes[np.repeat(fine, counts)]
                    links = known.of(2, codes)
                    new = np.bincount(codes, minlength=len(known.ok))
                    new[: len(uses)] += uses
                    uses = new
                yield record(ids, *out, packed(links, out[2], known.narrow), hashes, *[pa.nulls(n, f.type) for f in list(schema)[6:]])
        yield sums(known, uses)
        give_back()

    return _usual(docs, size).mapInArrow(run, ENCODED_TEXTS)


def packed(links: np.ndarray, counts: np.ndarray, narrow: bool) -> pa.Array:
    """Each text's links as bytes, four to a link if the ids of both vocabularies are that narrow."""
    values = ((links >> 32 << 16) + links % BASE).astype("<u4") if narrow else links.astype("<i8")
    ends = np.append(0, np.cumsum(counts) * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(values.tobytes())])


def unpacked(links: pa.Array, total: int) -> np.ndarray:
    """All texts' links from their bytes."""
    ends = _offsets(links)
    data = memoryview(links.buffers()[2] or b"")[ends[0] : ends[-1]]
    if len(data) == 8 * total:
        return np.frombuffer(data, "<i8")
    values = np.frombuffer(data, "<u4").astype(np.int64)
    return (values >> 16) * BASE + values % (1 << 16)


def align(docs: DataFrame, files: tuple[str, str] | None = None, size: int = RANGE) -> DataFrame:
    """ALIGNED: what the two tokenizers' tokens have in common, per document.

    Texts of ``size`` bytes or more are cut into ranges of that size.
    """
    spark = docs.sparkSession
    long = docs.filter(F.octet_length("text") >= size).select(F.monotonically_increasing_id().alias("key"), "doc_id", "text")
    cut = stored(windows(long, size), "windows")
    # Ranges of one text are dealt to many tasks.
    dealt = cut.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "key", "idx")
    whole = composed(stored(fragments(dealt, files), "fragments"))
    texts = stored(encoded(docs, files, size), "encoded")
    sums = texts.filter("pairs IS NOT NULL").select("pairs", "counts").unionByName(whole.filter("ok").select("pairs", "counts"))
    pairs = sums.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    pairs = stored(pairs.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = (F.col("pair") % BASE).alias("b")
    most = pairs.groupBy(b).agg(F.max("n").alias("most"))
    ranked = pairs.withColumn("b", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    # At most pair_bound(...) rows, whatever the corpus.
    told = ranked.toArrow().sort_by("pair")
    shared = spark.sparkContext.broadcast(tuple(told[c].to_numpy() for c in ("pair", "n", "best")))
    return scored(texts.filter("pairs IS NULL").drop("pairs", "counts"), shared).unionByName(scored_fragments(whole, shared))


def _looked_up(shared, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs' counts, and whether they are their B id's highest."""
    keys, counts, best = shared.value
    if not len(keys):
        return np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
    there = keys[at] == pairs
    return np.where(there, counts[at], 0), (there & best[at]).astype(np.int64)


def scored(texts: DataFrame, shared) -> DataFrame:
    """ALIGNED of encoded texts."""
    schema = to_arrow(ALIGNED)

    def run(batches):
        for batch in batches:
            for at, n in blocks(batch.column("links"), BLOCK):
                part = batch.slice(at, n)
                n_links = part.column("n_links").to_numpy(zero_copy_only=False)
                ends = np.append(0, np.cumsum(n_links))
                found = _looked_up(shared, unpacked(part.column("links"), int(ends[-1])))
                total, top = (pa.array(np.diff(np.append(0, np.cumsum(v))[ends])) for v in found)
                ids, n_a, n_b, links, hashes = (part.column(c) for c in ("doc_id", "n_a", "n_b", "n_links", "groups_sha256"))
                yield pa.RecordBatch.from_arrays([ids, n_a, n_b, links, links, top, total, hashes], schema=schema)

    return texts.mapInArrow(run, ALIGNED)


def scored_fragments(whole: DataFrame, shared) -> DataFrame:
    schema = to_arrow(ALIGNED)

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if not r["ok"]:
                    rows.append((r["doc_id"], 0, 0, 0, 0, 0, 0, ""))
                    continue
                counts, best = _looked_up(shared, np.array(r["pairs"], np.int64))
                times = np.array(r["counts"], np.int64)
                f = Fragment((r["head_a"], r["head_b"]), r["cuts"], [r["closed"]] if r["closed"] else [])
                rows.append((r["doc_id"], r["n_a"], r["n_b"], r["cuts"], r["cuts"], int((best * times).sum()), int((counts * times).sum()),
                             hashlib.sha256(f.text().encode()).hexdigest()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return whole.mapInArrow(run, ALIGNED)


def op12_align(spark, sf_dir):
    return align(table(spark, sf_dir, "documents"))
