"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans. The field has a node for each mention: text that is a base span
or looks like one (an address-like word, also written with "[at]" and "(dot)", a run of digits).
Its labels are the four kinds and "none"; mentions that are base spans are observed. Neighbours
close together share a chain potential. Mentions of the same value (the same address once "[at]"
and "(dot)" are read as signs, the same digits) share a skip potential, and similar ones (the same
part before the "@" of at least ``LOCAL`` characters, the same last ``TAIL`` digits) a weaker one:
each with the key's first base span or, where the key has none, with the mention before. So a value
repeated n times has n - 1 edges, and a base span reaches all of them in one step, however far.
What mentions of one value say for themselves is averaged: saying it twice proves nothing.
A run of more than ``LONGEST`` digits is no kind's; its parts between spaces are mentions.
Loopy sum-product message passing then labels the rest; a mention whose posterior for a kind
exceeds ``SURE`` is added as a span.

Potentials are log-odds counted over all rows, with the patterns as labels and the cues that decide
a pattern left out of the features. Tasks count, and the counts that reach the driver are bounded:
words before a mention are told apart by ``WORDS`` hash values.

Defined results: null and empty texts have no spans; spans of different kinds may overlap, an
added one never overlaps another; repeated rows give equal rows; an empty table gives an empty
table; other columns are ignored. Offsets count code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches, give_back, map_rows, table, to_arrow

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
SURE, NEAR = 0.9, 40
#: Message passing ends when no message moves by more than STILL, or after ROUNDS on a loop that never settles.
ROUNDS, STILL = 50, 1e-6
#: Kinds of edges: near neighbours, the same value, similar values.
CHAIN, SAME, SIMILAR = range(3)
#: Least log-odds for equal labels of mentions of the same value and of similar ones.
ALIKE = {SAME: 6.0, SIMILAR: 5.0}
LOCAL, TAIL, LONGEST, WORDS = 4, 7, 19, 4096
#: Directed edges whose messages are computed together.
BLOCK = 65536

# The patterns. Possessive forms only stop retries that cannot match.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_AT = r" ?[\[({] ?[Aa][Tt] ?[\])}] ?"
_DOT = r" ?[\[({] ?[Dd][Oo][Tt] ?[\])}] ?"
# Runs are entered at their start only and never retried, so long ones without an "@" stay linear.
_LIKE = re.compile(
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{_AT}[A-Za-z0-9-]++(?:(?:{_DOT}|\.)[A-Za-z0-9-]++)+"
    r"|(?<![^\s@])[^\s@]++@[^\s@]++|\+?[0-9(](?:[ ().-]{0,2}[0-9])++"
)
_AT, _DOT = re.compile(_AT), re.compile(_DOT)
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The pattern spans, by start and kind."""
    out = []
    if "@" in text:
        at = done = 0
        while (at := text.find("@", at)) >= 0:
            start = at
            while start > done and _LOCAL.match(text, start - 1):
                start -= 1
            # A local part may not hold "@", so only the run before this one can belong to it.
            found = _DOMAIN.match(text, at) if start < at else None
            if found:
                out.append((start, 0, found.end()))
                at = done = found.end()
            else:
                at += 1
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_DIGIT.findall(m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


# The field ---------------------------------------------------------------------


@dataclass
class Mention:
    start: int
    end: int
    label: int | None  # the kind of a base span
    features: tuple[str, ...]
    keys: tuple[tuple[int, str], ...]  # (kind of edge, key), the stronger first


def _keys(part: str, digits: str) -> tuple[tuple[int, str], ...]:
    """What other mentions must share to be the same value or a similar one."""
    part = _DOT.sub(".", _AT.sub("@", part)).lower()
    if "@" in part:
        local = part.split("@", 1)[0]
        return ((SAME, part), (SIMILAR, local + "@")) if len(local) >= LOCAL else ((SAME, part),)
    return ((SAME, digits), (SIMILAR, "~" + digits[-TAIL:])) if len(digits) >= TAIL else ((SAME, digits),)


def _look_alikes(text: str):
    """(start, end) of what looks like personal data, in order."""
    for m in _LIKE.finditer(text):
        start, end = m.span()
        part = m.group()
        if "@" in part:
            part = part.rstrip(".,;:!?)>\"'")
            lead = len(part) - len(part.lstrip("(<\"'"))
            yield start + lead, start + len(part)
        elif _AT.search(part):
            yield start, end
        elif len(_DIGIT.findall(part)) > LONGEST:
            for piece in re.finditer(r"[^ ]+", part):
                if TAIL <= len(_DIGIT.findall(piece.group())) <= LONGEST:
                    yield start + piece.start(), start + piece.end()
        elif len(_DIGIT.findall(part)) >= TAIL:
            yield start, end


def mentions(text: str, base: list[Span]) -> list[Mention]:
    """Base spans and what looks like them, in order; a look-alike never overlaps a base span."""
    spans = [(s, e, k) for s, k, e in base]
    if "@" in text or _DIGIT.search(text) or _AT.search(text):
        edges = sorted((s, e) for s, e, _ in spans)
        at = 0
        for start, end in _look_alikes(text):
            while at < len(edges) and edges[at][1] <= start:
                at += 1
            if at < len(edges) and edges[at][0] < end:
                continue
            spans.append((start, end, None))
    out = []
    for start, end, label in sorted(spans, key=lambda s: (s[0], s[1], s[2] is None, s[2])):
        part = text[start:end]
        digits = "".join(_DIGIT.findall(part))
        before = re.findall(r"[A-Za-z]+", text[max(0, start - 20) : start])
        keys = _keys(part, digits)
        shape = "@" if "@" in keys[0][1] else "." if part.count(".") == 3 else "9"
        word = zlib.crc32(before[-1].lower().encode()) % WORDS if before else ""
        features = ("shape" + shape, f"digits{min(len(digits), 20)}", f"before{word}")
        out.append(Mention(start, end, label, features, keys))
    return out


def _association_start() -> np.ndarray:
    return np.stack([ALIKE.get(level, 0.0) * np.eye(NONE + 1) for level in (CHAIN, SAME, SIMILAR)])


@dataclass(frozen=True)
class Field:
    """Log potentials: by label and feature, and by kind of edge and the labels of its ends."""

    prior: np.ndarray = field(default_factory=lambda: np.zeros(NONE + 1))
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    pairs: np.ndarray = field(default_factory=_association_start)


def _edges(nodes: list[Mention]):
    """(i, j, kind of edge), at most one skip edge per pair: the stronger."""
    seen: dict[tuple[int, str], int] = {}  # the first base span of a key, else its latest mention
    for i in reversed(range(len(nodes))):
        if nodes[i].label is not None:
            for key in nodes[i].keys:
                seen[key] = i
    for j, node in enumerate(nodes):
        if j and node.start - nodes[j - 1].end <= NEAR:
            yield j - 1, j, CHAIN
        joined = set()
        for key in node.keys:
            i = seen.get(key, j)
            if i != j and i not in joined:
                joined.add(i)
                yield i, j, key[0]
            if i == j or nodes[i].label is None:
                seen[key] = j


def count(texts, counts: Counter | None = None) -> Counter:
    """Counts of (what, name, label or pair of labels), labelled by the patterns; others count as none."""
    counts = Counter() if counts is None else counts
    for text in texts:
        nodes = mentions(text or "", base_spans(text or ""))
        of = [NONE if n.label is None else n.label for n in nodes]
        for node, label in zip(nodes, of):
            counts["label", "", label] += 1
            for f in node.features:
                counts["feature", f, label] += 1
        for i, j, level in _edges(nodes):
            if level == CHAIN or nodes[i].label is not None and nodes[j].label is not None:
                counts["pair", str(level), of[i] * (NONE + 1) + of[j]] += 1
    return counts


def field_of(counts: dict[tuple[str, str, int], int]) -> Field:
    """Potentials from counts, in any order."""
    labels = np.ones(NONE + 1)
    pairs = np.ones((len(ALIKE) + 1, NONE + 1, NONE + 1))
    by_feature: dict[str, np.ndarray] = {}
    for (what, name, label), n in counts.items():
        if what == "label":
            labels[label] += n
        elif what == "pair":
            pairs[int(name)][divmod(label, NONE + 1)] += n
        else:
            by_feature.setdefault(name, np.zeros(NONE + 1))[label] += n
    weights = {
        f: 0.5 * np.log((c + 0.5) / labels * labels.sum() / (c.sum() + 0.5)) for f, c in by_feature.items() if c.sum() >= 5
    }
    tables = [_association(p, 1.0, ALIKE.get(level, 0.0)) for level, p in enumerate(pairs)]
    return Field(np.log(labels / labels.sum()), weights, np.stack(tables))


def fit(texts: list[str | None]) -> Field:
    """The field of a few texts."""
    return field_of(count(texts))


def _association(pairs: np.ndarray, scale: float, least: float = 0.0) -> np.ndarray:
    """Pointwise mutual information of labels; alike mentions prefer equal labels by ``least`` at the least."""
    joint = pairs + pairs.T
    joint = joint / joint.sum()
    each = joint.sum(1)
    out = scale * np.log(joint / np.outer(each, each))
    if least:
        out = np.where(np.eye(len(out), dtype=bool), np.maximum(out, least), np.minimum(out, 0))
    return out


def posteriors(nodes: list[Mention], model: Field, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities of each mention by loopy sum-product message passing."""
    local = np.tile(model.prior, (len(nodes), 1))
    said = Counter(node.keys[0] for node in nodes if node.label is None)
    for i, node in enumerate(nodes):
        if node.label is not None:
            local[i] = -50.0
            local[i, node.label] = 0.0
        else:
            for f in node.features:
                if f in model.weights:
                    local[i] += model.weights[f]
            local[i] /= said[node.keys[0]]
    edges = np.array(list(_edges(nodes)), dtype=np.int64).reshape(-1, 3)
    if len(edges):
        a, b = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
        back = np.roll(np.arange(len(a)), len(edges))
        # A potential from its second end is the transposed one.
        tables = np.concatenate([model.pairs, model.pairs.transpose(0, 2, 1)])
        which = np.concatenate([edges[:, 2], edges[:, 2] + len(model.pairs)])
        loops = len(edges) >= len(nodes)
        messages = np.zeros((len(a), NONE + 1))
        for _ in range(rounds):
            belief = local.copy()
            np.add.at(belief, b, messages)
            out = belief[a] - messages[back]
            new = np.concatenate([
                np.logaddexp.reduce(out[i : i + BLOCK, :, None] + tables[which[i : i + BLOCK]], axis=1)
                for i in range(0, len(a), BLOCK)
            ])
            new -= new.max(1, keepdims=True)
            new = 0.5 * messages + 0.5 * new if loops else new
            moved = np.abs(new - messages).max()
            messages = new
            if moved <= STILL:
                break
        np.add.at(local, b, messages)
    local -= local.max(1, keepdims=True)
    p = np.exp(local)
    return p / p.sum(1, keepdims=True)


def added_spans(text: str, base: list[Span], model: Field) -> list[Span]:
    """Spans the field adds to the base."""
    nodes = mentions(text, base)
    if all(n.label is not None for n in nodes):
        return []
    p = posteriors(nodes, model)
    out, end = [], -1
    for node, row in zip(nodes, p):
        kind = int(row[:NONE].argmax())
        if node.label is None and row[kind] > SURE and node.start >= end:
            out.append((node.start, kind, node.end))
            end = node.end
    return out


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def fit_field(docs: DataFrame) -> Field:
    """Potentials from all rows. What reaches the driver is bounded by the features' values and the labels."""
    schema = "what string, name string, label int, n long"
    arrow = to_arrow(schema)

    def run(batches: Batches) -> Batches:
        counts = Counter()
        for batch in batches:
            count(batch.column(0).to_pylist(), counts)
        rows = [(*key, n) for key, n in counts.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)], schema=arrow
        )
        give_back()

    counts = docs.select("text").mapInArrow(run, schema).groupBy("what", "name", "label").agg(F.sum("n").alias("n"))
    return field_of({(r.what, r.name, r.label): r.n for r in counts.collect()})


def find_pii(docs: DataFrame, model: Field) -> DataFrame:
    """doc_id, counts of base spans per kind, base_sha256, all spans and the number added."""
    names = [f"n_{k}" for k in KINDS]

    def make():
        def work(rows):
            out = {n: [] for n in ("doc_id", *names, "base_sha256", "spans", "n_added")}
            out["doc_id"] = rows["doc_id"]
            for text in rows["text"]:
                text = text or ""
                base = base_spans(text)
                more = added_spans(text, base, model)
                for k, name in enumerate(names):
                    out[name].append(sum(s[1] == k for s in base))
                out["base_sha256"].append(hashlib.sha256(_written(base).encode()).hexdigest())
                out["spans"].append(_written(base + more))
                out["n_added"].append(len(more))
            return out

        return work

    schema = "doc_id long, " + "".join(f"{n} long, " for n in names) + "base_sha256 string, spans string, n_added long"
    return map_rows(docs.select("doc_id", "text"), make, schema)


def op9_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return find_pii(docs, fit_field(docs))
