"""The alignment of two tokenizers against whole texts encoded at once, and the fragments' laws."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from answerloom.llm import align
from answerloom.llm.queries import QUERIES
from answerloom.llm.words import tokenizer_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.01"
R = random.Random(3)
A = Tokenizer.from_file(tokenizer_path(align.A_FILE))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(align.B_FILE))
A_BYTES, B_BYTES = align.a_bytes(tokenizer_path(align.A_FILE)), align.b_bytes(B)


def groups(text):
    """(A ids, B ids) of each group; None without tokens."""
    if not text:
        return None
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    whole = (" " + text).encode()
    if b"".join(A_BYTES[i] for i in a) != whole or b"".join(B_BYTES[i] for i in b) != whole:
        return None
    ends = [set(np.cumsum([len(t[i]) for i in ids]).tolist()) for t, ids in ((A_BYTES, a), (B_BYTES, b))]
    out, at = [], [0, 0]
    for end in sorted(ends[0] & ends[1]):
        found = []
        for k, (t, ids) in enumerate(((A_BYTES, a), (B_BYTES, b))):
            n, i = 0, at[k]
            start = sum(len(t[j]) for j in ids[:i]) if not out else last
            while start + n < end:
                n += len(t[ids[i]])
                i += 1
            found.append(ids[at[k] : i])
            at[k] = i
        out.append(tuple(found))
        last = end
    return out


def brute(rows):
    found = [(doc, groups(text)) for doc, text in rows]
    count = Counter((a[-1], b[-1]) for _, g in found for a, b in g or [])
    most = defaultdict(int)
    for (a, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for doc, g in found:
        if g is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(a[-1], b[-1]) for a, b in g]
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        out.append((doc, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links),
                    sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_align"](spark, SF).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


ALPHABET = ["a", "B", "the", " ", " ", "\n", "  ", "\t", "é", "日", " ", "　", "▁", "<|endoftext|>", "<s>", "<0x0A>", "1", "'s", ".", "᠎", "😀", "ing", "\x1c", "\r\n", " ", "\x00"]
ODD = [None, "", " ", "\n", "  x", "\nfoo", "foo\n\nbar", "a \n\n\n b", "x" * 300, "日本語" * 60, "a▁b", "trail ", "trail\n", "the\tcat  sat"]
TEXTS = ODD + ["".join(R.choice(ALPHABET) for _ in range(R.randrange(1, 60))) for _ in range(300)]


@pytest.mark.parametrize("size", [7, 40, 1 << 15])
def test_odd_texts_in_ranges(spark, size):
    rows = [(R.choice([i, i, 5, None]), t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit("x") for n in ("key", "idx", "parts", "pair", "n", "ok", "low", "up", "b")})
    got = align.align(docs, size=size).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_no_rows(spark):
    assert align.align(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert align.align(spark.createDataFrame([(1, None)], "doc_id long, text string")).first().n_a == 0


def test_fragments_compose_in_any_order():
    for _ in range(200):
        size = R.randrange(1, 40)
        ends = [sorted({*R.sample(range(1, size + 1), R.randrange(size)), size}) for _ in "ab"]
        ids = [[R.randrange(100) for _ in e] for e in ends]
        whole = align.Fragment.of(ids[0], ends[0], ids[1], ends[1])
        cuts = sorted({0, size, *R.sample(range(size + 1), R.randrange(min(5, size + 1)))})
        parts = []
        for s, e in zip(cuts, cuts[1:]):
            own = [[(i, x) for i, x in zip(ids[k], ends[k]) if s < x <= e] for k in (0, 1)]
            parts.append(align.Fragment.of([i for i, _ in own[0]], np.array([x for _, x in own[0]], int), [i for i, _ in own[1]], np.array([x for _, x in own[1]], int)))
        while len(parts) > 1:
            i = R.randrange(len(parts) - 1)
            parts[i : i + 2] = [parts[i].then(parts[i + 1])]
        assert parts[0] == whole and whole.then(align.Fragment()) == whole == align.Fragment().then(whole)


def test_pairs_are_bounded():
    bound = align.pair_bound(A_BYTES, B_BYTES)
    assert bound < 1_000_000
    found = {(a[-1], b[-1]) for t in TEXTS for a, b in groups(t) or []}
    assert all(A_BYTES[a].endswith(B_BYTES[b]) or B_BYTES[b].endswith(A_BYTES[a]) for a, b in found)


class Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, inner, names):
        self.inner, self.names, self.texts = inner, names, 0

    def __getattr__(self, name):
        found = getattr(self.inner, name)
        if name not in self.names:
            return found

        def call(texts, **options):
            self.texts += len(texts)
            return found(texts, **options)

        return call


def test_many_stretches_are_encoded_as_one_text():
    known = align.Aligner(tokenizer_path(align.A_FILE), tokenizer_path(align.B_FILE))
    known.a, known.b = Counted(known.a, {"encode_batch_fast"}), Counted(known.b, {"encode"})
    words = pa.array(sorted({" " + "".join(R.choice("abcdeé.,") for _ in range(R.randrange(1, 12))) for _ in range(20_000)}))
    numbers = known.numbers(words)
    assert numbers.tolist() == list(range(len(words))) and known.ok.all()
    assert known.a.texts < len(words) / 20 > known.b.texts
    assert known.numbers(words.slice(5, 9)).tolist() == list(range(5, 14))


def test_together_and_alone_agree():
    known = align.Aligner(tokenizer_path(align.A_FILE), tokenizer_path(align.B_FILE))
    cut = {w for t in TEXTS if t for w in align._CUT.split(" " + t)}
    words = sorted(cut | {"\nfoo", "\n\nbar", " " + "x" * 20_000})
    found = known.numbers(pa.array(words))
    a, b, ok = known._alone(words)
    assert known.ok[found].tolist() == ok.tolist() and 0 < ok.sum() < len(ok)
    for k, want in enumerate((a, b)):
        assert [known.of(k, found[i : i + 1]).tolist() for i in range(len(words))] == want
    texts = known.texts.to_pylist()
    assert all(t.count("|") == t.count(";") == n for t, n in zip(texts, known.sizes(2).tolist()))


def test_long_stretches_are_forgotten(monkeypatch):
    monkeypatch.setattr(align, "HELD", 50_000)
    known = align.Aligner(tokenizer_path(align.A_FILE), tokenizer_path(align.B_FILE))
    known.numbers(pa.array([" a", " b"]))
    assert not known.make_room()
    known.numbers(pa.array([" " + "x" * 60_000]))
    assert known.make_room() and not len(known.words)


def test_links_are_packed_and_unpacked():
    for top, narrow in ((1 << 16, True), (1 << 31, False)):
        counts = np.array([0, 3, 0, 50, 1])
        links = np.array([R.randrange(top) * align.BASE + R.randrange(top) for _ in range(counts.sum())])
        kept = align.packed(links, counts, narrow)
        assert [len(x) for x in kept.to_pylist()] == (counts * (4 if narrow else 8)).tolist()
        assert align.unpacked(kept, counts.sum()).tolist() == links.tolist()
        assert align.unpacked(kept.slice(3, 2), 51).tolist() == links[3:].tolist()


def test_texts_are_encoded_once(spark):
    docs = spark.createDataFrame([(i, f"one two {i}") for i in range(50)], "doc_id long, text string")
    found = align.encoded(docs.repartition(2), None, 1 << 15).toArrow().to_pylist()
    texts = [r for r in found if r["pairs"] is None]
    linked = Counter(x for r in texts for x in align.unpacked(pa.array([r["links"]]), r["n_links"]).tolist())
    summed = Counter()
    for r in found:
        summed.update(dict(zip(r["pairs"] or [], r["counts"] or [])))
    assert len(texts) == 50 and summed == linked and sum(summed.values()) == sum(r["n_links"] for r in texts)
