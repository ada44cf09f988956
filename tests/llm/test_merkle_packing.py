"""The manifest against SQL and brute force, packing against the library's ids and plain best fit."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from answerloom.llm import merkle, packing, words
from answerloom.llm.queries import QUERIES
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
R = random.Random(5)
FIELDS = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute(rows):
    """(doc_id, leaf, subroot, root, proof hash, folded root, verified) of each row, by whole trees."""

    def enc(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def climb(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
        return levels

    def walk(levels, i, own, proof):
        for nodes in levels[:-1]:
            run = nodes[i - i % 3 : i - i % 3 + 3]
            proof += [n for j, n in enumerate(run) if j != i % 3]
            own = h(*(own if j == i % 3 else n for j, n in enumerate(run)))
            i //= 3
        return own

    groups = defaultdict(list)
    for r in rows:
        text = r[4]
        if text is not None and zlib.crc32(str(r[0] if r[0] is not None else "").encode()) % 2 == 0:
            text = text.replace("\n", "")
        groups[r[1]].append((r[0], h(*map(enc, r)), h(*map(enc, (*r[:4], text)))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups.values():
        g.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {n: climb([x[1] for x in groups[n]]) for n in names}
    top = climb([trees[n][-1][0] for n in names])
    out = []
    for s, n in enumerate(names):
        for i, (doc, leaf, tampered) in enumerate(groups[n]):
            proof = []
            folded = walk(top, s, walk(trees[n], i, tampered, proof), proof)
            out.append((doc, leaf, trees[n][-1][0], top[-1][0], h(*proof), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def proved(spark, rows, step, clash=True):
    docs = spark.createDataFrame(rows, FIELDS)
    if clash:
        docs = docs.withColumns({n: F.lit("x") for n in ("tree", "idx", "node", "total", "block", "part", "subroot", "of")})
    made = merkle.build(docs, merkle.without_newlines(), step=step)
    return sorted((tuple(r) for r in merkle.verified(merkle.proofs(made), made.root).collect()), key=str), made


MANY = [(i, R.choice([None, "", "a", "b", "ä", "z"]), "en", i, f"t\n{i}" if i % 3 else f"t{i}") for i in range(400)]
MIXED = [(None, None, None, None, None), (1, "s", "", 0, ""), (1, "s", "", 0, ""), (1, "s", "x", 0, "é\n" * 9), (None, "s", "x", 0, "y"), (2, "s", None, None, "\n"), (3, "", "x", 0, "w" * 200_000)]


@pytest.mark.parametrize("rows,step", [(MANY, 1), (MANY, 2), (MANY, 5), (MIXED, 1), (MIXED, 5), ([(7, "one", "en", 1, "x")], 5), ([(i, str(i), "en", 1, "x") for i in range(30)], 1)])
def test_manifest_equals_whole_trees(spark, rows, step):
    got, _ = proved(spark, rows, step)
    assert got == brute(rows)


def test_manifest_of_nothing(spark):
    got, made = proved(spark, [], 5)
    assert got == [] and made.root is None


def test_manifest_is_read_back_and_proves_some(spark, tmp_path):
    docs = spark.createDataFrame(MANY, FIELDS)
    made = merkle.build(docs, merkle.without_newlines(), path=str(tmp_path / "m"), step=2)
    back = merkle.load(spark, str(tmp_path / "m"), step=2)
    assert back.root == made.root
    wanted = spark.createDataFrame([(3,), (77,), (399,), (1000,)], "doc_id long")
    found = merkle.verified(merkle.proofs(back, wanted), back.root).collect()
    assert sorted(map(tuple, found), key=str) == [r for r in brute(MANY) if r[0] in (3, 77, 399)]


def ids_of(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(words.tokenizer_path("word_bpe_49k.json")).encode(text, add_special_tokens=False).ids


ODD = ["", "a", "Don't stop!", "İ. x̣́y, ſt", "<|endoftext|> a<|startoftext|>b", "naïve—café…", "x" * 9000, "1234 56,78", "tab\tnl\nvt\x0bnbsp em  end ", "日本語 テキスト。", "\x1c\x85 a\x1cb", "'s 't '' he's", "Ünïcödé, ÀÉ! ×÷", "é. Éx"]


def test_encoder_equals_library():
    encoder = words.Encoder(words.tokenizer_path("word_bpe_49k.json"), remembered=5)
    alphabet = "aB'sß,.!-́İ \n\t<|>1é日 "
    texts = ODD + ["".join(R.choice(alphabet) for _ in range(R.randrange(40))) for _ in range(400)]
    assert encoder.cuts
    for part in (texts, texts[:50], texts):
        flat, ends = encoder.encode(pa.array(part), 1)
        got = np.split(flat, ends)[:-1]
        assert [g.tolist() for g in got] == [[*ids_of(t), 1] for t in part]
    other = words.Encoder(words.tokenizer_path("byte_bpe_50k.json"))
    flat, ends = other.encode(pa.array(["a b", "", "c"]), 9)
    assert not other.cuts and ends.tolist() == [3, 4, 6] and flat[[2, 3, 5]].tolist() == [9, 9, 9]


def test_best_fit():
    lengths = np.array([R.randint(1, 100) for _ in range(2000)])
    bins, places, fill = packing.best_fit(lengths, 100)
    assert (np.bincount(bins, lengths) == fill).all() and fill.max() <= 100
    assert len(fill) <= np.ceil(lengths.sum() / 100) * 1.01


def layout(rows, capacity):
    """Checks that sequences are gapless and hold at most the capacity; returns their number."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pack_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = QUERIES["op13_pack"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    want = []
    for doc, text in texts.items():
        ids = [*ids_of(text), 1]
        for p in range(0, len(ids), 4096):
            want.append((doc, p // 4096, p, len(ids[p : p + 4096]), zlib.crc32(np.array(ids[p : p + 4096], "<u4").tobytes())))
    assert sorted(tuple(r)[:5] for r in rows) == sorted(want)
    total = sum(w[3] for w in want)
    assert layout(rows, 4096) <= len(packing.best_fit(np.array([w[3] for w in want]), 4096)[2]) + 1
    assert layout(rows, 4096) <= -(-total // 4096) + 2


def test_pack_rounds(spark):
    """Small rounds still come near one best fit over all; items over half stay alone and end the rounds."""
    lengths = [R.choice([3, 5, 8, 20, 33, 47, 60, 90, 100]) for _ in range(3000)]
    items = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "k long, length long").repartition(8, "k")
    rows = packing.pack(packing.stored(items, "t"), 100, 1, 40).collect()
    assert sorted(r.k for r in rows) == [*range(3000)]
    assert layout(rows, 100) <= 1.03 * len(packing.best_fit(np.array(lengths), 100)[2])
    items = spark.range(500).select(F.col("id").alias("k"), F.lit(60).cast("long").alias("length"))
    rows = packing.pack(packing.stored(items, "t"), 100, 1, 40).collect()
    assert layout(rows, 100) == 500


def test_pack_odd_rows(spark):
    rows = [(1, None), (None, ""), (2, "same"), (2, "same"), (3, "long word " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit("x") for n in ("bin", "place", "fill", "length", "start", "piece", "offset")})
    got = packing.packed_documents(docs).collect()
    layout(got, 4096)
    sizes = defaultdict(list)
    for r in sorted(got, key=lambda r: (str(r.doc_id), r.piece)):
        sizes[r.doc_id].append((r.piece, r.start, r.length))
    assert sizes[1] == [(0, 0, 1)] and sizes[None] == [(0, 0, 1)] and len(sizes[2]) == 2
    assert sizes[3] == [(0, 0, 4096), (1, 4096, 4096), (2, 8192, 1809)]
    assert packing.packed_documents(docs.limit(0)).count() == 0
    whole = packing.sequences(docs).collect()
    assert sum(len(r.ids) for r in whole) == 4 * sum(r.length for r in got)
    for r in whole:
        flat = np.frombuffer(r.ids, "<u4")
        assert r.ends[-1] == len(flat)
        for doc, a, b in zip(r.doc_ids, [0, *r.ends], r.ends):
            if doc == 2:
                assert flat[a:b].tolist() == [*ids_of("same"), 1]
