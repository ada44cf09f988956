"""The training-data operators against brute force, round trips and held-out accuracy."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from answerloom.llm import decontaminate, exact_dedup, language, lm_score, mixing, near_copies, pii, simhash
from answerloom.llm import substring_dedup, suffix_sort, token_codes, toxicity
from answerloom.llm.components import components
from answerloom.llm.queries import ORACLES, QUERIES
from compare import compare, duck
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
R = random.Random(11)


def frame(spark, rows, extra=True):
    """doc_id and text, with columns whose names clash with those the operators make."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    names = ("row", "salt", "chunk", "score", "fp", "bucket", "key", "start", "size", "n")
    return df.withColumns({n: F.lit("x") for n in names}) if extra else df


ODD = [(1, None), (2, ""), (2, ""), (None, "only words here"), (3, " \t\n"), (4, "only  words here"), (5, "x" * 100_000)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    assert compare(spark, duck(SF), SF, name, QUERIES[name], ORACLES[name]) is None


def test_exact_dedup_pieces(spark):
    rows = [*ODD, (6, "x \n y" * 50), (7, "x y" * 50), (8, "x  y" * 50)]
    whole = sorted(map(str, exact_dedup.exact_dedup(frame(spark, rows)).collect()))
    cut = sorted(map(str, exact_dedup.exact_dedup(frame(spark, rows), piece=7).collect()))
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, (_, t) in enumerate(rows)}
    sizes = Counter(norm.values())
    want = sorted((d, sizes[norm[i]], hashlib.sha256(norm[i].encode()).hexdigest()) for i, (d, _) in enumerate(rows) if d is not None)
    got = exact_dedup.exact_dedup(frame(spark, rows)).filter("doc_id IS NOT NULL")
    assert whole == cut
    assert sorted((r.doc_id, r.group_size, r.text_sha256) for r in got.collect()) == want
    assert exact_dedup.exact_dedup(frame(spark, []).limit(0)).count() == 0


def test_fingerprints_compose():
    data = bytes(R.randrange(256) for _ in range(1000))
    parts = [(exact_dedup.chunk_hash(data[a:b]), b - a) for a, b in ((0, 1), (1, 400), (400, 1000))]
    assert exact_dedup.combine(parts) == exact_dedup.fingerprint(data)


def test_mix_targets_and_schedule(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = mixing.mix(docs)
    got = {r.key: r.words for r in found.schedule.groupBy("key").agg(F.sum("words").alias("words")).collect()}
    assert all(got[r.key] == r.want for r in found.sources.collect())
    takes = found.takes.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.max(F.col("taken") - 3 * F.col("size")).alias("over"))
    assert all(abs(r.t - r.g) <= 1 and r.over <= 0 for r in takes.collect())
    # Any stretch of the schedule is near the weights.
    early = found.schedule.filter("slot < 2000").groupBy("key").count().collect()
    total = sum(r["want"] for r in found.sources.collect())
    share = {r.key: r.want / total for r in found.sources.collect()}
    assert all(abs(r["count"] - 2000 * share[r.key]) < 20 for r in early)


def test_mix_odd_rows(spark):
    docs = frame(spark, ODD).withColumn("source", F.when(F.col("doc_id") > 2, "s"))
    rows = mixing.mix(docs).takes.collect()
    assert len(rows) == len(ODD) and all(r.taken <= 3 * r.size for r in rows)
    assert sum(r.taken for r in rows) == sum(r.size for r in rows)
    assert mixing.mix(docs.limit(0)).takes.count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns


def near(rows, bits=3):
    """Component ids by comparing all pairs."""
    prints = [simhash.simhash((t or "").encode()) for _, t in rows]
    label = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= bits:
                    label[i] = min(label[i], label[j])
    least = {}
    for i, (d, _) in enumerate(rows):
        least[label[i]] = min(least.get(label[i], 1 << 60), d)
    return sorted((d, least[label[i]]) for i, (d, _) in enumerate(rows))


def test_simhash_components(spark, monkeypatch):
    import corpus_pipeline

    base = " ".join(R.choice("abcdefghij") for _ in range(150))
    rows = [(1, None), (2, ""), (2, ""), (3, "  \n"), (4, "one"), (5, "One two")]
    for i in range(60):
        words = base.split()
        words[R.randrange(150)] = R.choice("abcdefghij")
        rows.append((100 + i, " ".join(words)))
    want = near(rows)
    for hot in (32, 1):  # the second sends every shared key down the path for hot keys
        monkeypatch.setattr(simhash, "HOT", hot)
        got = simhash.near_duplicates(frame(spark, rows))
        assert sorted((r.doc_id, r.component_id) for r in got.collect()) == want
    kept = corpus_pipeline.near_duplicates(spark, frame(spark, rows), SF)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in want})
    assert simhash.near_duplicates(frame(spark, rows).limit(0)).count() == 0


def test_simhash_broadcasts_no_balls(spark):
    prints = sorted({R.getrandbits(62) & ~(1 << R.randrange(62)) for _ in range(40)})
    prints += [prints[0] ^ 5, prints[1] ^ (1 << 40)]
    linked = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"))
    plan = linked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 3 and "Broadcast" not in plan
    want = {frozenset(p) for p in itertools.combinations(prints, 2) if (p[0] ^ p[1]).bit_count() <= 3}
    assert {frozenset((r.u, r.v)) for r in linked.collect()} == want


def test_components_without_ids_stay_apart(spark):
    texts = [" ".join(R.choice("abcdefghij") for _ in range(150)) for _ in range(5)]
    rows = [(None, t) for t in texts] + [(None, texts[0]), (7, texts[1])]
    kept = simhash.drop_near_duplicates(frame(spark, rows)).collect()
    assert sorted(r.text for r in kept) == sorted(texts)
    assert [r.text for r in kept if r.doc_id == 7] == [texts[1]]


def near_sets(rows):
    """Component ids by comparing the 5-word shingles of all pairs."""
    def shingles(text):
        words = (text or "").lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets, label = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    least = {}
    for i, (d, _) in enumerate(rows):
        least[label[i]] = min(least.get(label[i], 1 << 60), d)
    return sorted((d, least[label[i]]) for i, (d, _) in enumerate(rows))


def test_near_copies_by_word_sets(spark, monkeypatch):
    r = random.Random(5)
    rows = [(1, None), (2, ""), (2, ""), (3, "  \n"), (4, "one"), (5, "One two"), (6, "one  TWO")]
    for group in range(6):
        base = [f"w{r.randrange(4000)}" for _ in range(60 + 60 * group)]
        for i in range(25):
            words = base.copy()
            for _ in range(r.randrange(1 + len(base) // 30)):
                words[r.randrange(len(words))] = f"w{r.randrange(4000)}"
            rows.append((1000 * group + 100 + i, " ".join(words[r.randrange(3) : len(words) - r.randrange(9)])))
    want = near_sets(rows)
    for hot, sample in ((64, 20_000), (1, 0)):
        monkeypatch.setattr(near_copies, "HOT", hot)
        monkeypatch.setattr(near_copies, "SAMPLE", sample)
        got = near_copies.near_copies(frame(spark, rows))
        assert sorted((x.doc_id, x.component_id) for x in got.collect()) == want
    kept = near_copies.drop_near_copies(frame(spark, rows))
    assert sorted(x.doc_id for x in kept.collect()) == sorted({c for _, c in want})
    assert near_copies.near_copies(frame(spark, rows).limit(0)).count() == 0


def test_components_of_a_path(spark):
    edges = spark.range(200).selectExpr("id AS u", "id + 1 AS v").union(spark.sql("SELECT 900L, 800L"))
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**dict.fromkeys(range(201), 0), 800: 800, 900: 800}


def test_decontamination_against_dynamic_programming():
    def distance(p, t):
        row = [0] * (len(t) + 1)
        for i, c in enumerate(p, 1):
            new = [i]
            for j, d in enumerate(t, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        return min(row)

    for _ in range(150):
        item = decontaminate.normalise("".join(R.choice("abcd ") for _ in range(60)))
        if len(item) < decontaminate.LEAST:
            continue
        near_ = list(item)
        for _ in range(R.randint(0, 8)):
            i = R.randrange(len(near_))
            near_[i : i + R.randint(0, 1)] = R.choice(["", "a", "b", "cd"])
        text = decontaminate.normalise("dcba bb " + "".join(near_) + " abba")
        d = distance(item, text)
        want = {7: d} if d <= int(0.1 * len(item)) else {}
        assert decontaminate.Matcher([(7, item)]).find(text) == want


def test_short_items_are_found_word_for_word(spark):
    items = [(1, "Boiling point"), (2, "42"), (3, "point"), (4, "..."), (5, None), (6, "boiling-point")]
    texts = ["the boiling point, twice: Boiling  Point", "boiling points", "a point", "142 and 42", "point", "", None]
    want = [[1, 3, 6], [], [3], [2], [3], [], []]
    found = decontaminate.Matcher([(i, decontaminate.normalise(t)) for i, t in items])
    assert [sorted(found.find(t)) for t in texts] == want
    docs = frame(spark, list(enumerate(texts)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r.item_ids for r in decontaminate.contamination(docs, benchmark).collect()}
    assert [got[i] for i in range(len(texts))] == want
    kept = {r.doc_id for r in decontaminate.drop_contaminated(docs, benchmark).collect()}
    assert kept == {i for i, found in enumerate(want) if not found}
    assert decontaminate.contamination(docs.limit(0), benchmark).count() == 0
    assert decontaminate.drop_contaminated(docs.limit(0), benchmark).count() == 0
    assert decontaminate.drop_contaminated(frame(spark, ODD), benchmark.limit(0)).count() == len(ODD)


def test_decontamination_of_tables(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {r.doc_id: list(r.item_ids) for r in decontaminate.contamination(docs, items).collect()}
    plain = [(r.item_id, decontaminate.normalise(r.text)) for r in items.collect()]
    texts = {r.doc_id: decontaminate.normalise(r.text) for r in docs.collect()}
    assert all(i in got[d] for d, t in texts.items() for i, p in plain if p in t)
    assert sum(map(bool, got.values())) < 60
    monkeypatch.setattr(decontaminate, "BLOCK", 1000)  # many passes
    again = {r.doc_id: list(r.item_ids) for r in decontaminate.contamination(docs, items).collect()}
    assert again == got
    assert decontaminate.drop_contaminated(docs, items).count() == sum(not v for v in got.values())
    assert decontaminate.contamination(frame(spark, ODD), items.limit(0)).count() == len(ODD)


def brute_lm(rows, order, mu):
    counts, words = Counter(), Counter()
    texts = [[b"<s>", *(t or "").encode().lower().split(), b"</s>"] for _, t in rows]
    for (d, _), w in zip(rows, texts):
        if zlib.crc32(str("" if d is None else d).encode()) % 5 != 1:
            words.update(w[1:])
            for n in range(1, order + 1):
                counts.update(tuple(w[j : j + n]) for j in range(len(w) - n + 1))
    total, kinds = sum(words.values()), len(words)
    totals = lm_score.Totals(total, kinds, sum(v == 1 for v in words.values()), sum(v == 2 for v in words.values()))

    def p(w, h):
        if not h:
            return float(totals.probability(np.array([words[w]], float))[0])
        return (counts[(*h, w)] + mu * p(w, h[1:])) / (counts[tuple(h)] + mu)

    out = []
    for (d, _), w in zip(rows, texts):
        score = sum(math.log10(p(w[j], w[max(0, j - order + 1) : j])) for j in range(1, len(w)))
        base = sum(math.log10((words[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in w[1:])
        out.append((d, len(w) - 1, sum(words[x] > 0 for x in w[1:]), total, round(base, 6), round(score, 6)))
    return sorted(out, key=str)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_scores(spark, order):
    rows = [(i, " ".join(R.choice(["a", "b", "C", "d", "ee"]) for _ in range(R.randint(0, 30)))) for i in range(50)] + ODD
    got = lm_score.lm_scores(frame(spark, rows), order, 5.0, chunk=300).collect()
    names = ("doc_id", "n_tokens", "n_known", "train_tokens")
    got = sorted(((*(r[n] for n in names), round(r.base_score, 6), round(r.score, 6)) for r in got), key=str)
    assert got == brute_lm(rows, order, 5.0)
    assert lm_score.lm_scores(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_lm_traversals_agree(order):
    texts = [" ".join(R.choice("abcd") for _ in range(R.randint(0, 12))).encode() for _ in range(60)]
    grams = lm_score.Grams(pa.array(texts), np.array([R.random() < 0.5 for _ in texts]), order)
    totals = lm_score.Totals(200, 5, 2, 1)
    automaton = lm_score.BackoffAutomaton(grams, [c.astype(np.int64) for c in grams.count], totals, 5.0)
    steps = [automaton.score(grams.text(i)) for i in range(len(texts))]
    assert np.allclose(automaton.scores(), steps)


def test_lm_beats_base_on_held_out(spark):
    r = QUERIES["op3_lm_score"](spark, SF).filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > r.b


def brute_repeats(rows, length):
    seen = Counter()
    texts = [(t or "").encode() for _, t in rows]
    for b in texts:
        seen.update(hashlib.md5(b[i : i + length]).digest() for i in range(len(b) - length + 1))
    out = []
    for (d, _), b in zip(rows, texts):
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - length + 1):
            if seen[hashlib.md5(b[i : i + length]).digest()] > 1:
                gone[i + 1 : i + 1 + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone[1:-1]].tobytes()
        runs = int((np.diff(gone.astype(int)) == 1).sum())
        out.append((d, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [substring_dedup.HOT, 1])
def test_repeated_passages(spark, most):
    def noise(n):
        return "".join(R.choice("abcdefghij \n") for _ in range(n))

    passages = [noise(R.randint(350, 900)) for _ in range(5)]
    rows = [(i, noise(R.randint(0, 200)) + "".join(R.choice(passages) + noise(R.randint(0, 90)) for _ in range(R.randint(0, 3)))) for i in range(40)]
    rows += [(1, None), (2, ""), (None, "é" * 900), (9, "ab" * 700), (9, "ab" * 700), (50, passages[0][:399])]
    got = substring_dedup.remove_repeats(frame(spark, rows), chunk=4000, most=most).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute_repeats(rows, 400)
    assert substring_dedup.remove_repeats(frame(spark, rows).limit(0)).count() == 0


def test_passages_count_by_bytes_not_words(spark):
    def say(n):
        return " ".join("".join(R.choice("abcdefgh") for _ in range(R.randint(2, 9))) for _ in range(n))

    rows, size = [], {}
    for _ in range(60):
        passage = say(R.randint(51, 80))
        for _ in range(2):
            size[len(rows)] = len(passage.encode())
            rows.append((len(rows), f"{R.random()}x {passage} x{R.random()}"))
    rows += [(len(rows) + i, say(200)) for i in range(60)]
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(frame(spark, rows)).collect()}
    # "x" and the space on either side repeat with the passage; an equal digit may too.
    assert all(got[d] >= n + 4 for d, n in size.items() if n >= 396)
    assert not any(got[d] for d, n in size.items() if n < 380)
    assert not any(n for d, n in got.items() if d not in size)
    assert any(n < 380 for n in size.values()) and any(n >= 396 for n in size.values())


@pytest.mark.parametrize("shallow", [8, 16, 64])
def test_suffix_sort(shallow):
    text = bytes(R.choice(b"ab") for _ in range(300)) * 2
    starts = np.arange(len(text) - 59)
    order, classes = suffix_sort.sort_suffixes(text, starts, 60, shallow)
    suffixes = [text[i : i + 60] for i in order]
    assert suffixes == sorted(suffixes)
    assert all((classes[i] == classes[i - 1]) == (suffixes[i] == suffixes[i - 1]) for i in range(1, len(order)))


def test_codes_round_trip():
    for n in (0, 1, 511, 512, 3000):
        ids = np.array([R.getrandbits(R.randint(1, 32)) for _ in range(n)], np.uint32)
        codes = token_codes.Codes(token_codes.encode(ids))
        assert len(codes) == n and (codes.all() == ids).all()
        assert [codes[i] for i in range(n)] == ids.tolist()


def test_token_files(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_codes.tokenizer_path())
    odd = [(7, "It's <|endoftext|> ＡＢ Éé ΑΣ don'T 12.5 'the ... \x1c \x85 é"), (8, "a　b")]
    real = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id") + 1000, "text").limit(150).collect()
    rows = [r for r in ODD if r[0] is not None] + odd + [tuple(r) for r in real]
    got = sorted(map(tuple, token_codes.token_files(frame(spark, rows)).collect()))
    start, want = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == sorted(want)
    assert token_codes.token_files(frame(spark, rows).limit(0)).count() == 0


def brute_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m.group())
        if 14 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.findall("[0-9]", m.group())) <= 15]
    return sorted(out)


def test_base_spans():
    texts = ["".join(R.choice("a.@-+ 0125(%") for _ in range(40)) for _ in range(20_000)]
    texts += ["", "@", "x@", "4111 1111 1111 1111", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "é 🙂 a.b@c.de"]
    assert all(pii.base_spans(t) == brute_spans(t) for t in texts)


def test_alike_mentions_are_added(spark):
    text = "call +49 30 12345678 or, later, 49-30-12345678 today; 1234567890 is a number"
    rows = [*ODD, (20, text), (21, "nothing here 12 34"), (22, "1234567890")]
    found = {r.doc_id: r for r in pii.find_pii(frame(spark, rows), pii.Field()).collect()}
    at = text.index("49-30")
    assert found[20].spans.split(",") == [f"phone:5:{5 + 15}", f"phone:{at}:{at + 14}"]
    assert found[20].n_phone == 1 and found[22].spans == "" and found[1].spans == ""
    assert pii.find_pii(frame(spark, rows).limit(0), pii.Field()).count() == 0


OTHER_FORMS = [  # (text, what the field adds)
    ("call +49 30 12345678 or 030 12345678 today", ["030 12345678"]),
    ("030 12345678, " + "then much later " * 50 + "+49 (30) 1234-5678", ["030 12345678"]),
    ("call +1 (555) 123-4567; order 9991234; or 555-123-4567", ["555-123-4567"]),
    ("card 4111 1111 1111 1111, again 4111.1111.1111.1111", ["4111.1111.1111.1111"]),
    ("4111111111111111 then 7536784127813050 4111111111111111", ["4111111111111111"]),
    ("john.smith@example.com is john.smith [at] example (dot) com", ["john.smith [at] example (dot) com"]),
    ("see <john.smith@intranet>, not ann.lee@intranet, or john.smith@example.com", ["john.smith@intranet"]),
    ("host 192.168.100.200 is 192-168-100-200", ["192-168-100-200"]),
    ("030 12345678 and 030 12345678, a.b [at] c (dot) de, 99949115180 and 99949115180", []),
    ("+49 30 12345678 and 030 12345679; x.y@example.com, z.w@local", []),
]


def test_values_in_another_form_are_added(spark):
    """With the production potentials: every planted repeat is found, and nothing else."""
    model = pii.fit_field(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = [(i, text) for i, (text, _) in enumerate(OTHER_FORMS)]
    found = {r.doc_id: r for r in pii.find_pii(frame(spark, rows), model).collect()}
    for i, (text, want) in enumerate(OTHER_FORMS):
        base = pii._written(pii.base_spans(text))
        spans = [s.split(":") for s in found[i].spans.split(",") if s and s not in base.split(",")]
        assert [text[int(s) : int(e)] for _, s, e in spans] == want, text
        assert found[i].n_added == len(want)


def test_marginals_equal_enumeration():
    """Without loops, message passing gives the exact probabilities, also over many steps."""
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 5):
        nodes = [
            pii.Mention(1000 * i, 1000 * i + 9, int(rng.integers(4)) if rng.random() < 0.3 else None, (f"f{i}",),
                        ((pii.SAME, f"v{i % 2}"),) if i < 3 else ((pii.SAME, f"w{i}"),))
            for i in range(n)
        ]
        if n == 5:  # and a near neighbour
            nodes[4].start, nodes[4].end = nodes[3].end + 5, nodes[3].end + 9
        pairs = rng.normal(size=(3, 5, 5))
        model = pii.Field(rng.normal(size=5), {f"f{i}": rng.normal(size=5) for i in range(n)}, pairs)
        said = Counter(x.keys[0] for x in nodes if x.label is None)
        want = np.zeros((n, 5))
        for labels in itertools.product(range(5), repeat=n):
            if any(x.label not in (None, k) for x, k in zip(nodes, labels)):
                continue
            score = sum((model.prior[k] + model.weights[f"f{i}"][k]) / said[x.keys[0]]
                        for i, (x, k) in enumerate(zip(nodes, labels)) if x.label is None)
            score += sum(pairs[level, labels[i], labels[j]] for i, j, level in pii._edges(nodes))
            want[np.arange(n), labels] += np.exp(score)
        want /= want.sum(1, keepdims=True)
        assert np.allclose(pii.posteriors(nodes, model), want, atol=1e-6)


def test_potentials_count_every_row(spark):
    """Counts of tasks add up to those of all rows, whatever the partitions; an empty table has the plain prior."""
    texts = [(i, t) for i, (t, _) in enumerate(OTHER_FORMS * 40)] + [(None, None), (5, "")]
    whole = pii.fit([t for _, t in texts])
    for parts in (1, 7):
        got = pii.fit_field(frame(spark, texts).repartition(parts))
        assert np.allclose(got.prior, whole.prior) and np.allclose(got.pairs, whole.pairs)
        assert got.weights.keys() == whole.weights.keys()
        assert all(np.allclose(got.weights[f], whole.weights[f]) for f in whole.weights)
    empty = pii.fit_field(frame(spark, texts).limit(0))
    assert not empty.weights and np.allclose(np.exp(empty.prior), 1 / 5)


def test_long_texts_without_spaces():
    text = "a" * 300_000 + " " + "x1." * 100_000 + "@" + " 12" * 50_000 + " +49 30 12345678 030 12345678"
    assert len(pii.mentions(text, pii.base_spans(text))) >= 1


def test_clean_documents_get_no_added_spans(spark):
    assert QUERIES["op9_pii"](spark, SF).filter("n_added > 0").count() <= 2


def test_languages_held_out(spark):
    langs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op10_language"](spark, SF).filter("held_out").join(langs, "doc_id")
    assert got.filter("lang = lang_pred").count() / got.count() > 0.95
    odd = {(r.doc_id, r.lang_pred) for r in language.languages(frame(spark, [*ODD, (30, "12 34")]), language.fit({"a": ["aaa aab"] * 5, "b": ["xyz xxy"] * 5})).collect()}
    assert {(1, "und"), (2, "und"), (30, "und"), (3, "und")} <= odd and (5, "b") in odd
    assert {r.lang_pred for r in language.languages(frame(spark, ODD), None).collect()} == {"und"}


def test_every_language_is_learned(spark, monkeypatch):
    """More than two hundred of them, and one that has only very long texts."""
    letters = [chr(0x1401 + i) for i in range(211)]
    rows = [(i * 40 + j, f"l{i:03}", f"{c}{c} {c}{c}{c}") for i, c in enumerate(letters) for j in range(12)]
    rows += [(10**6 + j, "long", "qpq pqp " * 5000) for j in range(12)]
    rows += [(10**7, None, "ab"), (None, "l000", letters[0]), (10**7 + 1, "l001", None)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = language.fit_languages(docs)
    assert set(model.names) == {f"l{i:03}" for i in range(211)} | {"long"}
    got = {r.doc_id: r.lang_pred for r in language.languages(docs.filter("doc_id < 8000 OR lang = 'long'"), model).collect()}
    right = sum(got[i] == lang for i, lang, _ in rows if i in got)
    assert right >= 0.99 * len(got)
    monkeypatch.setattr(language, "ALL_ROWS", 212 * 6)  # fewer of each, none left out
    assert set(language.fit_languages(docs).names) == set(model.names)
    assert language.fit_languages(docs.limit(0)) is None
    assert language.languages(docs.limit(0), None).count() == 0


def test_kneser_ney_sums_to_one():
    model = language.fit({"a": ["abba baab abab"] * 8}, order=3)
    words = ["".join(w) for w in __import__("itertools").product("ab", repeat=1)]
    scores, _ = model.word_scores(["a" + w for w in words])
    assert (scores < 0).all() and np.exp(scores).sum() < 1


def test_toxicity_held_out(spark):
    large = "/root/testdata/sf0.1"  # sf0.01 has some thirty toxic labels to learn from
    labels = spark.read.parquet(f"{large}/labels.parquet")
    got = QUERIES["op1_toxicity"](spark, large).join(labels, "doc_id").filter("held_out").collect()
    share = sum(r.toxic for r in got) / len(got)
    assert sum(r.predicted == r.toxic for r in got) / len(got) > 1 - share + 0.02
    ranked = sorted(got, key=lambda r: r.score)
    toxic = [i for i, r in enumerate(ranked) if r.toxic]
    auc = (sum(toxic) - len(toxic) * (len(toxic) - 1) / 2) / (len(toxic) * (len(got) - len(toxic)))
    assert auc > 0.8  # with five times the labels it is above 0.99
    docs = frame(spark, ODD)
    assert {r.score for r in toxicity.toxicity(docs, None).collect()} == {0.0}
    model = toxicity.fit([f"bad{i} scumbag word{i * 7} moron" .encode() for i in range(30)], [f"good day number{i} and {i * 3}".encode() for i in range(30)])
    assert toxicity.toxicity(docs, model).filter("score >= 0 AND score <= 1").count() == len(ODD)


def test_pipeline_stages_keep_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    calm = toxicity.toxicity(docs, toxicity.fit_toxicity(docs, labels)).filter("score < 0.5")
    ids = {r.doc_id for r in calm.collect()}
    first = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    assert {r.doc_id for r in first.select("doc_id").collect()} == ids and len(ids) < docs.count()
    assert 0 < kept.count() < len(ids)
