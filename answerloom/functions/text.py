"""Text expressions: tokens, n-grams, offsets, cleaning, answer normalization."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import let, run_lengths

# Fixed value: a word is a run of letters and digits of any script.
WORD_PATTERN = r"[\p{L}\p{N}]+"

# Default cleaning rules, applied in this order.
CLEAN_RULES: tuple[tuple[str, str], ...] = (
    (r"(?s)<!--.*?-->", " "),
    (r"(?s)<script.*?</script>", " "),
    (r"(?s)<style.*?</style>", " "),
    (r"<[^>]*>", " "),
    (r"&[a-z]+;", " "),
    (r"https?://[^ ]+", " "),
    (r"\\n", " "),
    (r"[ \t\r\n]+", " "),
)


def tokenize(text: Column, tokenizer: str = "regex", udf: Callable | None = None) -> Column:
    """Lowercased tokens of a text.

    ``regex`` takes words, ``space`` splits at single blanks. A vectorized
    function made by :func:`tokenizer_udf` can be given instead for subword or
    morpheme tokenizers.
    """
    lowered = F.lower(text)
    if udf is not None:
        return udf(lowered)
    if tokenizer == "regex":
        return F.regexp_extract_all(lowered, F.lit(WORD_PATTERN), F.lit(0))
    if tokenizer == "space":
        return F.split(lowered, " ")
    raise ValueError(f"unknown tokenizer {tokenizer!r}")


def tokenizer_udf(make: Callable[[], Callable[[str], list[str]]]) -> Callable:
    """Wrap a Python tokenizer as an Arrow-batched column function.

    ``make`` builds the tokenizer once per task, so it need not be picklable.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        split = make()
        for texts in batches:
            yield texts.map(lambda t: None if t is None else split(t))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    # Marked so that no filter or projection is planned to tokenize twice.
    return F.pandas_udf(run, "array<string>").asNondeterministic()


def ngrams(tokens: Column, min_n: int = 1, max_n: int = 2) -> Column:
    """All n-grams of the given lengths, words joined by one blank."""
    if not 1 <= min_n <= max_n:
        raise ValueError("need 1 <= min_n <= max_n")

    def of_length(t: Column, n: int) -> Column:
        if n == 1:
            return t
        m = F.greatest(F.size(t) - (n - 1), F.lit(0))
        return F.zip_with(
            F.slice(of_length(t, n - 1), 1, m),
            F.slice(t, n, m),
            lambda shorter, word: F.concat_ws(" ", shorter, word),
        )

    return let(tokens, lambda t: F.concat(*[of_length(t, n) for n in range(min_n, max_n + 1)]))


def term_counts(tokens: Column, min_n: int = 1, max_n: int = 1) -> Column:
    """Terms of one text with their counts, ``array<struct<value, n>>``."""
    return run_lengths(ngrams(tokens, min_n, max_n))


# Words whose n-grams are counted at once in a task.
COUNTED_WORDS = 1 << 19


def runs_of(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Neighbouring rows of together at most ``most``, as first and last (exclusive); a larger row alone."""
    ends = np.cumsum(sizes)
    at = 0
    while at < len(ends):
        before = ends[at] - sizes[at]
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield at, to
        at = to


def list_sizes(lists: pa.Array) -> np.ndarray:
    """Elements of each list; 0 for null."""
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


# Terms are hashed into this many buckets, as a power of two.
BUCKET_BITS = 22


def term_buckets(tokens: pa.Array, min_n: int, max_n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """First words and buckets of the n-grams of each length; equal n-grams have equal buckets.

    The words must not be null and hold no blanks.
    """
    sizes = list_sizes(tokens)
    words = tokens.flatten().dictionary_encode()
    hashes = pd.util.hash_array(words.dictionary.to_numpy(zero_copy_only=False), categorize=False)
    each = hashes[words.indices.to_numpy()]
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(each))
    at, sums = np.arange(len(each)), each
    for n in range(1, max_n + 1):
        if n > 1:
            whole = left[at] >= n
            at = at[whole]
            sums = (sums[whole] ^ (sums[whole] >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + each[at + n - 1]
        if n >= min_n:
            mixed = (sums ^ (sums >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            yield at, (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def counted_terms(
    tokens: pa.Array, min_n: int, max_n: int, wanted: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """:func:`term_counts` of many texts at once: rows, places of terms, counts, and terms.

    Counts come in the order of rows. Null terms are left out, and terms in buckets that are not ``wanted``.
    """
    sizes = list_sizes(tokens)
    words = tokens.flatten().dictionary_encode()
    # The word after the last stands for null tokens, which n-grams skip.
    each = pa.concat_arrays([words.dictionary, pa.nulls(1, words.dictionary.type)])
    codes = words.indices.fill_null(len(each) - 1).to_numpy().astype(np.int64)
    rows = np.repeat(np.arange(len(tokens)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))
    if wanted is None:
        starts = [np.flatnonzero(left >= n) for n in range(min_n, max_n + 1)]
    else:
        starts = [at[wanted[bucket]] for at, bucket in term_buckets(tokens, min_n, max_n)]
    all_grams, all_names, known = [], [], 0
    for n, at in enumerate(starts, start=min_n):
        grams, names = codes[at], each
        for further in range(1, n):
            grams, seen = pd.factorize(grams * len(each) + codes[at + further])
            shorter, word = names.take(pa.array(seen // len(each))), each.take(pa.array(seen % len(each)))
            blank = pc.if_else(pc.and_(shorter.is_valid(), word.is_valid()), " ", "").cast(each.type)
            names = pc.binary_join_element_wise(shorter.fill_null(""), word.fill_null(""), blank)
        all_grams.append(grams + known)
        all_names.append(names)
        known += len(names)
    # Words with blanks in them can make equal terms of different lengths.
    terms = pa.concat_arrays(all_names).dictionary_encode()
    places = terms.indices.fill_null(-1).to_numpy()[np.concatenate(all_grams)]
    some, width = places >= 0, max(1, len(terms.dictionary))
    keys, counts = np.unique(rows[np.concatenate(starts)[some]] * width + places[some], return_counts=True)
    return keys // width, keys % width, counts, terms.dictionary


def words_with_gaps(text: Column) -> tuple[Column, Column]:
    """Blank-separated words, and the same words with the blanks before them."""
    words = F.regexp_extract_all(text, F.lit(r"[^\s]+"), F.lit(0))
    pieces = F.regexp_extract_all(text, F.lit(r"\s*[^\s]+"), F.lit(0))
    return words, pieces


# Bytes of text whose words are looked for at once in a task.
TEXT_BYTES = 4 * 1024 * 1024
SPANS_DDL = "array<struct<start: int, end: int>>"
SPANS_TYPE = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def text_pieces(texts: pa.Array, most: int = TEXT_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of rows of some ``most`` bytes: their bytes, and the bounds of each row in them.

    Null texts count as empty. A longer text is a run of its own.
    """
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return
    _, bounds, data = texts.buffers()
    bounds = np.frombuffer(bounds, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, "right")) - 1)
        yield data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
        at = to


def word_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last place (exclusive) of every blank-separated word, and each row's first word.

    Blanks are those of ``\\s``; words never cross the ``bounds`` of a row.
    """
    word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    before[bounds[bounds < len(data)]] = False
    after[bounds[bounds > 0] - 1] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def lists_of(values: pa.Array, firsts: np.ndarray, like: pa.Array) -> pa.Array:
    """``values`` cut into lists at ``firsts``; null where ``like`` is null."""
    mask = like.is_null() if like.null_count else None
    return pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), values, mask=mask)


def _joined_firsts(firsts: list[np.ndarray]) -> np.ndarray:
    """The bounds of lists in several runs as bounds in all of them."""
    sizes = np.concatenate([np.zeros(1, np.int64), *[np.diff(f) for f in firsts]])
    return np.cumsum(sizes)


def word_spans(texts: pa.Array) -> pa.Array:
    """Character spans of the words of each text, as :func:`token_offsets`."""
    starts, ends, firsts = [np.empty(0, np.int64)], [np.empty(0, np.int64)], []
    for data, bounds in text_pieces(texts):
        first_byte, last_byte, first_word = word_bounds(data, bounds)
        # Code points before each byte: all bytes but those that continue one.
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        of_row = np.repeat(chars[bounds[:-1]], np.diff(first_word))
        starts.append(chars[first_byte] - of_row)
        ends.append(chars[last_byte] - of_row)
        firsts.append(first_word)
    sides = [pa.array(np.concatenate(s).astype(np.int32)) for s in (starts, ends)]
    return lists_of(pa.StructArray.from_arrays(sides, fields=list(SPANS_TYPE)), _joined_firsts(firsts), texts)


def hashed_words(texts: pa.Array, vocab_size: int, n_special: int) -> pa.Array:
    """Ids of the words of each text, as :func:`token_ids`."""
    inside, sizes, firsts = [np.empty(0, np.uint8)], [np.zeros(1, np.int64)], []
    for data, bounds in text_pieces(texts):
        first_byte, last_byte, first_word = word_bounds(data, bounds)
        inside.append(data[~((data == 32) | ((data >= 9) & (data <= 13)))])
        sizes.append(last_byte - first_byte)
        firsts.append(first_word)
    ends = np.cumsum(np.concatenate(sizes))
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(np.concatenate(inside))]
    words = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, buffers).dictionary_encode()
    # A different word is hashed once per batch: the first 28 bits of its MD5.
    heads = b"".join(hashlib.md5(w).digest()[:4] for w in words.dictionary.to_pylist())
    by_word = (np.frombuffer(heads, ">u4") >> 4).astype(np.int64) % (vocab_size - n_special) + n_special
    ids = by_word[words.indices.to_numpy()].astype(np.int32)
    return lists_of(pa.array(ids), _joined_firsts(firsts), texts)


def token_offsets(text: Column) -> Column:
    """Character spans of blank-separated words, ``array<struct<start, end>>``.

    Positions count code points from 0; ``end`` is exclusive. The words of many
    texts are found at once on their bytes.
    """

    def run(texts: pa.Array) -> pa.Array:
        return word_spans(texts)

    return F.arrow_udf(run, SPANS_DDL)(text)


def token_ids(text: Column, vocab_size: int, n_special: int) -> Column:
    """Hashed ids of blank-separated words in ``[n_special, vocab_size)``; special tokens stay free."""

    def run(texts: pa.Array) -> pa.Array:
        return hashed_words(texts, vocab_size, n_special)

    return F.arrow_udf(run, "array<int>")(text)


def clean_text(text: Column, rules: Sequence[tuple[str, str]] = CLEAN_RULES) -> Column:
    """Apply the regex replacements in order and trim."""
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement)
    return F.trim(text)


def normalize_answer(text: Column) -> Column:
    """Lowercase, drop ASCII punctuation and English articles, squeeze blanks."""
    text = F.regexp_replace(F.lower(text), r"\p{Punct}", "")
    text = F.regexp_replace(text, r"(?U)\b(a|an|the)\b", " ")
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def answer_tokens(normalized: Column) -> Column:
    """Words of a normalized answer; none for the empty answer."""
    return F.filter(F.split(normalized, " "), lambda w: w != "")
