"""Token ids of texts by a tokenizers vocabulary, each different word of a batch once.

Arrow cuts texts at ASCII white space and numbers the different words of a batch; Python sees a
word once per batch and a word's stem once per worker. Ids are gathered by array indexing.

This holds for vocabularies whose tokenizer drops white space, ignores case and parts letters from
signs; the vocabulary's file is checked for that. Any other vocabulary encodes whole texts.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Stems a worker remembers from batch to batch.
REMEMBERED = 300_000
#: Bytes of text that are encoded at a time.
BLOCK = 8 << 20

#: Fixed value: the pattern by which such a vocabulary's tokenizer cuts text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words of Latin letters with signs behind them: letters and signs are encoded apart.
_PLAIN = r"^[A-Za-zÀ-ÖØ-öø-ÿ]+[!\"#$%&()*+,\-./:;=?@\]^_`{|}~]*$"
_TAIL = r"[!\"#$%&()*+,\-./:;=?@\]^_`{|}~]+$"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def blocks(texts: pa.Array, limit: int = BLOCK):
    """(first row, number of rows) of stretches of at most ``limit`` bytes, or of one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield at, to - at
        at = to


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of every start, ``count`` each."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + counts, counts)


def split_words(texts: pa.Array, of=pc.ascii_split_whitespace) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Numbers of all texts' words, the number of words of each text, and the different words."""
    lists = of(texts)
    coded = lists.flatten().dictionary_encode()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts, coded.dictionary


def drops_space(path: str) -> bool:
    """True if the vocabulary's tokenizer cuts at white space, lower-cases and uses ``PATTERN``."""
    with open(path) as file:
        told = json.load(file)
    steps = (told.get("normalizer") or {}).get("normalizers", [])
    cuts = (told.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
        and steps[1]["pattern"].get("Regex") == r"\s+" and steps[1]["content"] == " "
        and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        and cuts[0]["pattern"].get("Regex") == PATTERN and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"]
        and not cuts[1]["use_regex"] and not cuts[1]["add_prefix_space"]
    )


class Encoder:
    """Encodes texts without special tokens; a bounded number of stems is remembered."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.limit, self.cuts = Tokenizer.from_file(path), remembered, drops_space(path)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.ends = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.fromiter((i for ids in found for i in ids), np.uint32)
        return flat, np.fromiter(map(len, found), np.int64, len(found))

    def _numbers(self, stems: pa.Array) -> np.ndarray:
        """A number for each stem; what is new is encoded."""
        coded = stems.dictionary_encode()
        known, words = self.number, coded.dictionary.to_pylist()
        new = [w for w in words if w not in known]
        if new:
            known.update(zip(new, range(len(known), len(known) + len(new))))
            flat, counts = self._ids(new)
            self.flat.append(flat)
            self.ends.append(self.ends[-1][-1] + np.cumsum(counts))
        numbers = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        return numbers[coded.indices.to_numpy(zero_copy_only=False)]

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each closed by the id ``end``, and where each text ends."""
        if not self.cuts:
            flat, counts = self._ids(texts.to_pylist())
            ends = np.cumsum(counts)
            return np.insert(flat, ends, end), ends + np.arange(1, len(ends) + 1)
        if len(self.number) > self.limit:
            self._forget()
        codes, counts, words = split_words(texts)
        plain = pc.match_substring_regex(words, _PLAIN)
        stems = pc.utf8_lower(pc.if_else(plain, pc.replace_substring_regex(words, _TAIL, ""), ""))
        stems = pc.if_else(plain, stems, words)
        tails = pc.if_else(plain, pc.replace_substring_regex(words, "^[A-Za-zÀ-ÖØ-öø-ÿ]+", ""), "")
        numbers = self._numbers(pa.concat_arrays([stems, tails]))
        parts = np.empty(2 * len(words), np.int64)
        parts[0::2], parts[1::2] = numbers[: len(words)], numbers[len(words) :]
        self.flat, self.ends = [np.concatenate(self.flat)], [np.concatenate(self.ends)]
        flat, ends = self.flat[0], self.ends[0]
        lengths = ends[parts + 1] - ends[parts]
        # The ids of the batch's different words, with the end id as one more word.
        own = np.append(flat[ranges(ends[parts], lengths)], np.uint32(end))
        sizes = np.append(lengths[0::2] + lengths[1::2], 1)
        begins = np.cumsum(sizes) - sizes
        codes = np.insert(codes, np.cumsum(counts), len(words))
        taken = sizes[codes]
        last = np.cumsum(counts + 1)
        return own[ranges(begins[codes], taken)], np.cumsum(taken)[last - 1]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary file; it outlives the task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
