"""Deep-shallow suffix sorting.

Multikey quicksort, eight bytes to a key, orders suffixes to a shallow depth. Groups that still
agree there have long common prefixes; each is ordered by a blind trie, which looks at one byte
per branching and compares a new suffix with a single other one.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 64


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes at every position as a big-endian number; zeros follow the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.zeros(len(text) + 1, np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | padded[i : i + len(out)]
    return out


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


class BlindTrie:
    """Orders strings of one length; ``groups()`` yields the ids of equal strings, in order."""

    def __init__(self):
        self.root = None  # a leaf is a list of ids, a node [depth, {byte: child}]
        self.text: dict[int, bytes] = {}

    def add(self, key: int, text: bytes) -> None:
        if self.root is None:
            self.root, self.text[key] = [key], text
            return
        node, path = self.root, []
        while isinstance(node, tuple):
            path.append(node)
            node = node[1].get(text[node[0]]) or next(iter(node[1].values()))
        while isinstance(node, tuple):
            node = next(iter(node[1].values()))
        other = self.text[node[0]]
        depth = _common(text, other)
        if depth == len(text):
            node.append(key)
            return
        self.text[key] = text
        above, below = None, self.root
        while isinstance(below, tuple) and below[0] < depth:
            above, below = below, below[1][other[below[0]]]
        if isinstance(below, tuple) and below[0] == depth:
            below[1][text[depth]] = [key]
            return
        fresh = (depth, {other[depth]: below, text[depth]: [key]})
        if above is None:
            self.root = fresh
        else:
            above[1][other[above[0]]] = fresh

    def groups(self):
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                yield node


def sort_suffixes(text: bytes, starts: np.ndarray, length: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes, cut to ``length`` bytes, and the class of equal ones of each in that order.

    Suffixes that a byte short of ``length`` ends count as they are, followed by zeros.
    """
    buffer = np.frombuffer(text, np.uint8)
    words = _words(np.concatenate([buffer, np.zeros(length, np.uint8)]))
    starts = np.asarray(starts, np.int64)
    order = np.arange(len(starts))
    group = np.zeros(len(starts), np.int64)  # by place in the order: where its group begins
    for depth in range(0, min(shallow, length) // 8 * 8, 8):
        sizes = np.bincount(group, minlength=len(order) + 1)[group]
        open_ = np.flatnonzero(sizes > 1)
        if not len(open_):
            break
        keys = words[starts[order[open_]] + depth]
        sorted_ = np.lexsort((keys, group[open_]))
        order[open_] = order[open_[sorted_]]
        keys, old = keys[sorted_], group[open_]
        new = np.ones(len(open_), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (old[1:] != old[:-1])
        group[open_] = np.maximum.accumulate(np.where(new, open_, 0))
    bounds = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]])) if len(order) else np.zeros(1, int)
    classes = group.copy()
    padded = text + bytes(length)
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if high - low > 1:
            trie = BlindTrie()
            for which in order[low:high].tolist():
                at = int(starts[which])
                trie.add(which, padded[at : at + length])
            at = low
            for equal in trie.groups():
                order[at : at + len(equal)] = equal
                classes[at : at + len(equal)] = at
                at += len(equal)
    return order, classes
