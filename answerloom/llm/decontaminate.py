"""Benchmark decontamination by pigeonhole edit matching.

An item with an error budget of k edits is cut into k + 1 pieces: a passage within the budget
holds at least one piece unchanged. An Aho-Corasick automaton finds the pieces in every
document, and a hit is verified by Myers' bit-parallel edit distance, first around the piece
and its neighbour with their part of the budget, then around twice as many pieces and so on up
to the whole item, which drops chance hits early and loses none.

Texts are compared after lower-casing and with each run of other signs than letters and digits
read as one space. The budget is ``ERRORS`` of the item's length.

The items are the query set: they are sent to all tasks in blocks of at most ``BLOCK`` bytes of
text, one pass over the documents for each block.

An item of fewer than ``LEAST`` characters has no budget: it is found word for word, between word
bounds.

Defined results: null and empty texts match nothing; items that are null or have no letter or
digit match nothing; repeated items are reported each by its id; a null item id is ignored; empty tables give no match; other columns
are kept by ``drop_contaminated`` and ignored otherwise.
"""

from __future__ import annotations

import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_rows, table

ERRORS, LEAST = 0.1, 32
BLOCK = 16 << 20
_OTHER = re.compile(r"[\W_]+")


def normalise(text: str | None) -> str:
    return _OTHER.sub(" ", (text or "").lower()).strip()


def pattern_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def best_distance(masks: dict[str, int], m: int, text: str, budget: int) -> int:
    """Least edit distance of the pattern to any part of the text, or budget + 1 if above the budget."""
    top, full = 1 << (m - 1), (1 << m) - 1
    plus, minus, score, best = full, 0, m, m
    get = masks.get
    left = len(text)
    for c in text:
        eq = get(c, 0)
        vertical = eq | minus
        x = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(x | plus)
        down = plus & x
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score < best:
                best = score
        left -= 1
        if score - left > budget and best > budget:
            break
        up = up << 1
        plus = ((down << 1) | ~(vertical | up)) & full
        minus = up & vertical & full
    return best if best <= budget else budget + 1


class _Node:
    """Consecutive pieces of an item: its text span, its budget and the node around it."""

    __slots__ = ("low", "high", "budget", "masks", "parent")

    def __init__(self, pattern: str, low: int, high: int, budget: int, parent):
        self.low, self.high, self.budget, self.parent = low, high, budget, parent
        self.masks = pattern_masks(pattern[low:high])


class Matcher:
    """Finds items in texts within their error budgets."""

    def __init__(self, items: list[tuple[int, str]], errors: float = ERRORS):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.same: dict[str, list[int]] = {}
        for item, text in items:
            if item is not None and text:
                self.same.setdefault(text, []).append(item)
        hits: dict[str, list] = {}
        for text in self.same:
            if len(text) < LEAST:
                hits.setdefault(f" {text} ", []).append((text, None))
                continue
            budget = int(errors * len(text))
            cuts = [len(text) * i // (budget + 1) for i in range(budget + 2)]
            self._tree(text, cuts, 0, budget + 1, None, hits)
        for piece, where in hits.items():
            self.automaton.add_word(piece, where)
        if hits:
            self.automaton.make_automaton()
        self.empty = not hits

    def _tree(self, text, cuts, a, b, parent, hits) -> None:
        node = _Node(text, cuts[a], cuts[b], b - a - 1, parent)
        if b - a == 1:
            hits.setdefault(text[cuts[a] : cuts[b]], []).append((text, node))
        else:
            middle = (a + b) // 2
            self._tree(text, cuts, a, middle, node, hits)
            self._tree(text, cuts, middle, b, node, hits)

    def find(self, text: str | None) -> dict[int, int]:
        """Least distance found by item id; a distance of 0 ends the search for an item."""
        text = normalise(text)
        found: dict[str, int] = {}
        if self.empty or not text:
            return {}
        text = f" {text} "  # word bounds for short items
        done: set = set()
        for end, where in self.automaton.iter(text):
            for item, node in where:
                if found.get(item) == 0:
                    continue
                if node is None:
                    found[item] = 0
                    continue
                at = end + 1 - node.high  # where the item would begin
                distance = self._verify(text, item, node, at, done)
                if distance is not None and distance < found.get(item, 1 << 30):
                    found[item] = distance
        return {i: d for item, d in found.items() for i in self.same[item]}

    def _verify(self, text, item, node, at, done) -> int | None:
        """The item's distance around this place, or None if above its budget."""
        node = node.parent or node
        while True:
            if node.parent is None:
                # Places of one diagonal band are verified once.
                mark = (item, at // (node.budget + 1))
                if mark in done:
                    return None
                done.add(mark)
                wide = 2 * (node.budget + 1)
            else:
                wide = node.budget
            low, high = max(0, at + node.low - wide), at + node.high + wide
            distance = best_distance(node.masks, node.high - node.low, text[low:high], node.budget)
            if distance > node.budget:
                return None
            if node.parent is None:
                return distance
            node = node.parent


def _blocks(benchmark: DataFrame) -> list[list[tuple[int, str]]]:
    """The items in blocks of bounded size: the stated query set."""
    blocks, size = [[]], 0
    for item, text in benchmark.select("item_id", "text").filter("item_id IS NOT NULL").orderBy("item_id").toLocalIterator():
        text = normalise(text)
        if size and size + len(text) > BLOCK:
            blocks.append([])
            size = 0
        blocks[-1].append((item, text))
        size += len(text)
    return blocks


def contamination(docs: DataFrame, benchmark: DataFrame, errors: float = ERRORS) -> DataFrame:
    """doc_id, item_ids found (ascending), their number and the least distance of every row."""
    blocks = _blocks(benchmark)

    def maker(block):
        def make():
            matcher = Matcher(block, errors)

            def work(rows):
                found = [matcher.find(t) for t in rows["text"]]
                return {
                    "doc_id": rows["doc_id"], "row": rows["row"], "item_ids": [sorted(f) for f in found],
                    "least_distance": [min(f.values(), default=None) for f in found],
                }

            return work

        return make

    source = docs.select("doc_id", F.xxhash64("text").alias("row"), "text")
    schema = "doc_id long, row long, item_ids array<long>, least_distance int"
    passes = [map_rows(source, maker(b), schema) for b in blocks]
    found = passes[0]
    if len(passes) > 1:  # rows with the same id and text get the same result, once per row
        merged = reduce(DataFrame.unionByName, passes).groupBy("doc_id", "row").agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
            F.min("least_distance").alias("least_distance"),
            (F.count(F.lit(1)) / len(passes)).cast("int").alias("times"),
        )
        found = merged.withColumn("_n", F.explode(F.sequence(F.lit(1), "times")))
    return found.select("doc_id", F.size("item_ids").cast("long").alias("n_items"), "item_ids", "least_distance")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, errors: float = ERRORS) -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    for block in _blocks(benchmark):
        docs = docs.filter(_clean(block, errors))
    return docs


def _clean(block: list, errors: float) -> Column:
    def clean(texts: pa.Array) -> pa.Array:
        matcher = _matcher(block, errors)
        return pa.array([not matcher.find(t) for t in texts.to_pylist()], pa.bool_())

    return F.arrow_udf(clean, T.BooleanType())("text")


_MATCHERS: dict = {}


def _matcher(block: list, errors: float) -> Matcher:
    """One matcher per worker process for the last block of items."""
    key = (hash(tuple(block)), errors)
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(block, errors)
    return _MATCHERS[key]


def op2_decontaminate(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
