"""DuckDB SQL with the results the registered queries must have."""

from __future__ import annotations

from ..functions.text import CLEAN_RULES

PASSAGES = """
passages AS (
  SELECT min(doc_id) AS pid, text FROM documents WHERE text IS NOT NULL GROUP BY text
)"""

WORDS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"


def _terms(source: str, key: str, text: str, name: str) -> str:
    """Term counts of words and word pairs."""
    return f"""
{name}_tok AS (SELECT {key}, {WORDS.format(text)} AS t FROM {source}),
{name} AS (
  SELECT {key}, term, count(*) AS tf FROM (
    SELECT {key}, unnest(t) AS term FROM {name}_tok
    UNION ALL
    SELECT {key}, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))
      AS term FROM {name}_tok
  ) GROUP BY ALL
)"""


QUESTIONS = """
questions AS (SELECT item_id AS id, text AS question FROM benchmark)"""
ONE_QUESTION = """
questions AS (SELECT min(item_id) AS id, arg_min(text, item_id) AS question FROM benchmark)"""
OOV_QUESTIONS = """
questions AS (
  SELECT item_id AS id, text AS question FROM benchmark
  UNION ALL SELECT -p_partkey - 1, p_name FROM part
)"""

TF = _terms("passages", "pid", "text", "tf")
VOCAB = """
vocab AS (
  SELECT term, df, ctf, ln((1 + (SELECT count(*) FROM passages)) / (1 + df)::DOUBLE) + 1 AS idf
  FROM (
    SELECT term, count(*) AS df, sum(tf)::BIGINT AS ctf FROM tf GROUP BY term
    ORDER BY ctf DESC, term LIMIT 50000
  )
)"""


def _unit(tf: str, key: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT term, {key}, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY {key})) AS weight
  FROM {tf} JOIN vocab USING (term)
)"""


WEIGHTS = _unit("tf", "pid", "weights")
QVEC = _terms("questions", "id", "question", "qtf") + "," + _unit("qtf", "id", "qvec")
SCORES = """
scores AS (
  SELECT q.id, w.pid, sum(q.weight * w.weight) AS score
  FROM weights w JOIN qvec q USING (term) GROUP BY q.id, w.pid
)"""
RANKED = """
ranked AS (
  SELECT id, pid, score,
    row_number() OVER (PARTITION BY id ORDER BY round(score, 9) DESC, pid) AS rank FROM scores
)"""

INDEX = f"{PASSAGES},{TF},{VOCAB},{WEIGHTS}"


def _search(questions: str = QUESTIONS) -> str:
    return f"WITH {INDEX},{questions},{QVEC},{SCORES},{RANKED}"


TOPK = f"{_search()} SELECT id, pid, rank, round(score, 6) AS score FROM ranked WHERE rank <= 10"

BM25 = f"""
WITH {PASSAGES},{QUESTIONS},
tok AS (SELECT pid, {WORDS.format("text")} AS t FROM passages),
corpus AS (SELECT count(*) AS n, avg(len(t)::DOUBLE) AS avg_len FROM tok),
tf AS (
  SELECT pid, term, n_words, count(*) AS tf
  FROM (SELECT pid, len(t) AS n_words, unnest(t) AS term FROM tok) GROUP BY ALL
),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT DISTINCT id, unnest({WORDS.format("question")}) AS term FROM questions),
scores AS (
  SELECT q.id, tf.pid, sum(
    ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.5::DOUBLE
    / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * n_words / avg_len))
  ) AS score
  FROM q JOIN tf USING (term) JOIN df USING (term) CROSS JOIN corpus GROUP BY q.id, tf.pid
),{RANKED}
SELECT id, pid, rank, round(score, 6) AS score FROM ranked WHERE rank <= 10
"""

GOLD = """
gold AS (
  SELECT q.id, p.pid, instr(p.text, q.question) - 1 AS answer_start
  FROM questions q JOIN passages p ON contains(p.text, q.question)
),
first_gold AS (
  SELECT id, pid, answer_start FROM gold
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY pid) = 1
)"""


def _context(k: int) -> str:
    return f"""
ctx AS (
  SELECT r.id, string_agg(r.pid::VARCHAR, ',' ORDER BY r.rank) AS context_ids,
    round(sum(r.score), 6) AS score_sum, string_agg(p.text, ' ' ORDER BY r.rank) AS context
  FROM ranked r JOIN passages p USING (pid) WHERE r.rank <= {k} GROUP BY r.id
)"""


# Reader windows -------------------------------------------------------------

# Fixed values of the default reader settings: 384 tokens with 3 special ones, a
# question of 6 words, so 375 context tokens per window; an overlap of 128 moves
# each window on by 247.
WINDOWS = rf"""
{PASSAGES},
pieces AS (
  SELECT pid, unnest(regexp_extract_all(text, '\s*[^\s]+')) AS piece,
    unnest(regexp_extract_all(text, '[^\s]+')) AS word,
    unnest(range(len(regexp_extract_all(text, '[^\s]+')))) AS pos
  FROM passages
),
offs AS (
  SELECT pid, pos, word, (e - length(word))::INT AS s, e::INT AS e FROM (
    SELECT *, sum(length(piece)) OVER (PARTITION BY pid ORDER BY pos) AS e FROM pieces
  )
),
sized AS (SELECT pid, text, len(regexp_extract_all(text, '[^\s]+')) AS n FROM passages),
qa AS (
  SELECT pid, text, n, CASE WHEN n > 0 THEN pid % n ELSE 0 END AS k,
    'which words follow word ' || (CASE WHEN n > 0 THEN pid % n ELSE 0 END) || ' here' AS question
  FROM sized
),
places_of AS (SELECT pid, k, least(k + 3, n - 1) AS last FROM qa),
found AS (
  SELECT pid, max(CASE WHEN pos = k THEN s END) AS a_start,
    max(CASE WHEN pos = last THEN e END) AS a_end
  FROM offs JOIN places_of USING (pid) GROUP BY pid
),
ans AS (
  SELECT pid, a_start, a_end, substring(text, a_start + 1, a_end - a_start) AS a_text
  FROM found JOIN passages USING (pid)
),
wins AS (
  SELECT pid, text, n, question, w::INT AS window_no, (w * 247)::INT AS first_token,
    least(375, n - w * 247)::INT AS n_context
  FROM qa, unnest(range(0, 1 + greatest(0, ceil((n - 375) / 247.0))::BIGINT)) AS t(w)
),
ctx AS (
  SELECT w.pid, w.window_no, o.pos - w.first_token + 8 AS place, o.word, o.s, o.e
  FROM wins w JOIN offs o ON o.pid = w.pid
    AND o.pos >= w.first_token AND o.pos < w.first_token + w.n_context
),
bounds AS (
  SELECT w.pid, w.window_no, w.first_token, w.n_context, w.text, w.question,
    coalesce(min(s), 0) AS lo, coalesce(max(e), 0) AS hi
  FROM wins w LEFT JOIN ctx c ON c.pid = w.pid AND c.window_no = w.window_no GROUP BY ALL
),
places AS (
  SELECT pid, window_no, n_context, unnest(range(0, n_context + 9))::INT AS place FROM wins
)"""

TOKEN_ID = "(('0x' || substr(md5({0}), 1, 7))::BIGINT % 31997 + 3)"
IDS = f"""
ids AS (
  SELECT pid, window_no, 0 AS place, 1 AS id FROM wins
  UNION ALL
  SELECT pid, window_no, place, {TOKEN_ID.format("word")} FROM (
    SELECT pid, window_no, unnest(range(1, 7)) AS place, unnest(string_split(question, ' ')) AS word
    FROM wins
  )
  UNION ALL SELECT pid, window_no, 7, 2 FROM wins
  UNION ALL SELECT pid, window_no, place, {TOKEN_ID.format("word")} FROM ctx
  UNION ALL SELECT pid, window_no, n_context + 8, 2 FROM wins
)"""

LOGITS = """
logits AS (
  SELECT pid, window_no, place,
    ((pid * 7919 + window_no * 104729 + place * 31) % 251) / 100::DOUBLE AS sl,
    ((pid * 7919 + window_no * 104729 + place * 53) % 257) / 100::DOUBLE AS el
  FROM places
)"""
READER_LOGITS = f"""{IDS},
logits AS (
  SELECT pid, window_no, place,
    ((id * 31 + place * 17) % 1009) / 100::DOUBLE AS sl,
    ((id * 37 + place * 23) % 1013) / 100::DOUBLE AS el
  FROM ids
)"""


def _spans(n: int = 20, longest: int = 30) -> str:
    return f"""
tops AS (
  SELECT *, row_number() OVER (PARTITION BY pid, window_no ORDER BY sl DESC, place) - 1 AS sr,
    row_number() OVER (PARTITION BY pid, window_no ORDER BY el DESC, place) - 1 AS er FROM logits
),
starts AS (SELECT t.*, c.s FROM tops t JOIN ctx c USING (pid, window_no, place) WHERE sr < {n}),
ends AS (SELECT t.*, c.e FROM tops t JOIN ctx c USING (pid, window_no, place) WHERE er < {n}),
cands AS (
  SELECT a.pid, a.window_no, a.sr, b.er, a.s AS start_char, b.e AS end_char,
    a.sl AS start_logit, b.el AS end_logit, a.sl + b.el AS score
  FROM starts a JOIN ends b ON a.pid = b.pid AND a.window_no = b.window_no
    AND b.place BETWEEN a.place AND a.place + {longest - 1}
),
best AS (
  SELECT c.*, substring(p.text, start_char + 1, end_char - start_char) AS text,
    row_number() OVER (PARTITION BY c.pid ORDER BY score DESC, window_no, sr, er) AS rank
  FROM cands c JOIN passages p USING (pid) QUALIFY rank <= {n}
),
nulls AS (
  SELECT pid, window_no, sl, el, sl + el AS null_score FROM logits WHERE place = 0
  QUALIFY row_number() OVER (PARTITION BY pid ORDER BY sl + el, window_no) = 1
)"""


def _preds(allow_null: bool, n: int = 20) -> str:
    null_rows = """
    UNION ALL SELECT pid, 1000, '', sl, el, null_score, true FROM nulls""" if allow_null else ""
    return f"""
pool AS (
  SELECT pid, rank, text, start_logit, end_logit, score, false AS is_null FROM best{null_rows}
),
kept AS (
  SELECT *, row_number() OVER (PARTITION BY pid ORDER BY score DESC, is_null, rank) AS place
  FROM pool QUALIFY place <= {n} OR is_null
),
filled AS (
  SELECT pid, place, text, start_logit, end_logit, score FROM kept
  UNION ALL
  SELECT p.pid, 0, 'empty', 0, 0, 0 FROM passages p LEFT JOIN kept k USING (pid)
  GROUP BY p.pid HAVING count(k.pid) = 0 OR (count(k.pid) = 1 AND min(k.text) = '')
),
preds AS (
  SELECT pid AS id, row_number() OVER (PARTITION BY pid ORDER BY place) AS rank, text,
    start_logit, end_logit,
    exp(score - max(score) OVER (PARTITION BY pid)) AS e FROM filled
)"""


NBEST_ROWS = """
SELECT id, rank, text, round(start_logit, 6) AS start_logit, round(end_logit, 6) AS end_logit,
  round(e / sum(e) OVER (PARTITION BY id), 6) AS probability FROM preds"""

ANSWERS = f"WITH {WINDOWS},{LOGITS},{_spans()}"

# Metrics --------------------------------------------------------------------

PAIRS = """
pairs AS (
  SELECT u.conv_id * 1000 + u.turn AS id, u.text AS asked, a.text AS replied, u.turn
  FROM conversations u JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'
),
golds AS (
  SELECT id, 0 AS gold_no, replied AS gold FROM pairs
  UNION ALL SELECT id, 1, 'The "' || asked || '"!' FROM pairs WHERE turn % 4 = 0
)"""


def _norm(text: str) -> str:
    return (
        "array_to_string(list_filter(string_split_regex("
        f"regexp_replace(lower({text}), '[[:punct:]]', '', 'g'), '\\s+'), "
        "lambda w: w NOT IN ('', 'a', 'an', 'the')), ' ')"
    )


def _scored(predicted: str) -> str:
    """EM and F1 per (run, id) of ``predicted(run, id, prediction_text)`` and ``golds``."""
    return f"""
normed AS (
  SELECT run, id, gold_no, {_norm("prediction_text")} AS p, {_norm("gold")} AS g
  FROM {predicted} JOIN golds USING (id)
),
sides AS (
  SELECT run, id, gold_no, unnest(string_split(p, ' ')) AS token, 1 AS p, 0 AS g FROM normed
    WHERE p <> ''
  UNION ALL
  SELECT run, id, gold_no, unnest(string_split(g, ' ')), 0, 1 FROM normed WHERE g <> ''
),
shared AS (
  SELECT run, id, gold_no, sum(least(p, g)) AS o, sum(p + g) AS n FROM (
    SELECT run, id, gold_no, token, sum(p) AS p, sum(g) AS g FROM sides GROUP BY ALL
  ) GROUP BY ALL
),
scored AS (
  SELECT run, id, max(CASE WHEN p = g THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS em,
    max(coalesce(2.0::DOUBLE * o / n, 0)) AS f1
  FROM normed LEFT JOIN shared USING (run, id, gold_no) GROUP BY run, id
)"""


ASKED = f"{PAIRS}, runs AS (SELECT 'asked' AS run, id, asked AS prediction_text FROM pairs)"
BOTH_RUNS = f"""{PAIRS}, runs AS (
  SELECT 'asked' AS run, id, asked AS prediction_text FROM pairs
  UNION ALL SELECT 'replied', id, replied FROM pairs)"""

# Votes ----------------------------------------------------------------------

NBEST_LISTS = r"""
asked AS (
  SELECT item_id AS id, regexp_extract_all(text, '[^\s]+') AS w FROM benchmark
),
lists AS (
  SELECT m::INT AS model, id, (j + 1)::INT AS rank, w[(id + m * j) % len(w) + 1] AS text,
    ((id * 37 + m * 101 + j * 17) % 1000) / 1000::DOUBLE AS probability
  FROM asked, unnest(range(1, 4)) AS a(m), unnest(range(0, 5)) AS b(j) WHERE len(w) > 0
)"""
VOTES = f"""{NBEST_LISTS},
votes AS (
  SELECT id, text, sum(probability) AS votes, min(model * 100 + rank) AS first FROM lists
  GROUP BY id, text
)"""

# Vectors --------------------------------------------------------------------

EVERY_VECTOR = """
queries AS (SELECT vec_id AS qid, embedding AS vec FROM embeddings)"""


def _neighbours(score: str, order: str) -> str:
    return f"""WITH {EVERY_VECTOR},
s AS (SELECT qid, vec_id, {score} AS score FROM queries, embeddings)
SELECT qid, vec_id, round(score, 6) AS score,
  row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) {order}, vec_id) AS rank
FROM s QUALIFY rank <= 10"""


def _sq(a: str, b: str) -> str:
    return (
        f"list_sum(list_transform(range(1, len({a}) + 1), "
        f"lambda i: ({a}[i]::DOUBLE - {b}[i]::DOUBLE) * ({a}[i]::DOUBLE - {b}[i]::DOUBLE)))"
    )


LISTS = f"""WITH {EVERY_VECTOR},
dims AS (
  SELECT label, unnest(embedding) AS x, unnest(range(len(embedding))) AS dim FROM embeddings
),
centers AS (
  SELECT label AS cluster, list(x ORDER BY dim) AS center
  FROM (SELECT label, dim, avg(x::DOUBLE) AS x FROM dims GROUP BY label, dim) GROUP BY label
),
lists AS (
  SELECT vec_id, embedding, cluster FROM embeddings, centers
  QUALIFY row_number() OVER (
    PARTITION BY vec_id ORDER BY round({_sq("embedding", "center")}, 9), cluster) = 1
)"""
IVF = f"""{LISTS},
probes AS (
  SELECT qid, vec, cluster FROM queries, centers
  QUALIFY row_number() OVER (
    PARTITION BY qid ORDER BY round({_sq("vec", "center")}, 9), cluster) <= 2
),
s AS (SELECT qid, vec_id, {_sq("vec", "embedding")} AS score FROM probes JOIN lists USING (cluster))
SELECT qid, vec_id, round(score, 6) AS score,
  row_number() OVER (PARTITION BY qid ORDER BY round(score, 9), vec_id) AS rank
FROM s QUALIFY rank <= 10"""


IVF_CODES = f"""{LISTS},
probes AS (
  SELECT qid, vec, cluster FROM queries, centers
  QUALIFY row_number() OVER (
    PARTITION BY qid ORDER BY round({_sq("vec", "center")}, 9), cluster) <= 2
),
values_ AS (
  SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding)))::INT AS dim FROM embeddings
),
b AS (SELECT dim, min(x) AS lo, max(x) AS hi FROM values_ GROUP BY dim),
coded AS (
  SELECT vec_id, list(lo + round((x - lo) / (hi - lo) * 15) / 15 * (hi - lo) ORDER BY dim) AS near
  FROM values_ JOIN b USING (dim) GROUP BY vec_id
),
best AS (
  SELECT qid, vec, vec_id, embedding FROM probes JOIN lists USING (cluster) JOIN coded USING (vec_id)
  QUALIFY row_number() OVER (PARTITION BY qid ORDER BY round({_sq("vec", "near")}, 9), vec_id) <= 40
),
s AS (SELECT qid, vec_id, {_sq("vec", "embedding")} AS score FROM best)
SELECT qid, vec_id, round(score, 6) AS score,
  row_number() OVER (PARTITION BY qid ORDER BY round(score, 9), vec_id) AS rank
FROM s QUALIFY rank <= 10"""

IVF_CONTEXTS = f"""WITH {INDEX},{QUESTIONS},{QVEC},
center_ids AS (
  SELECT pid, row_number() OVER (ORDER BY pid) - 1 AS cluster FROM (SELECT DISTINCT pid FROM weights)
  QUALIFY cluster < 8
),
centers AS (SELECT cluster, term, weight FROM weights JOIN center_ids USING (pid)),
near AS (
  SELECT pid, cluster FROM (
    SELECT w.pid, c.cluster, sum(w.weight * c.weight) AS dot FROM weights w JOIN centers c USING (term)
    GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY pid ORDER BY round(dot, 9) DESC, cluster) = 1
),
lists AS (SELECT pid, text, coalesce(cluster, 0) AS cluster FROM passages LEFT JOIN near USING (pid)),
asked AS (SELECT DISTINCT id FROM qvec),
qdots AS (
  SELECT q.id, c.cluster, sum(q.weight * c.weight) AS dot FROM qvec q JOIN centers c USING (term) GROUP BY ALL
),
probes AS (
  SELECT a.id, n.cluster FROM asked a CROSS JOIN (SELECT unnest(range(8)) AS cluster) n
  LEFT JOIN qdots d ON d.id = a.id AND d.cluster = n.cluster
  QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY round(coalesce(dot, -1), 9) DESC, n.cluster) <= 2
),
scores AS (
  SELECT q.id, w.pid, sum(q.weight * w.weight) AS score FROM weights w JOIN qvec q USING (term) GROUP BY ALL
),
far AS (
  SELECT p.id, l.pid, l.text, 2 - 2 * coalesce(s.score, 0) AS d
  FROM probes p JOIN lists l USING (cluster) LEFT JOIN scores s ON s.id = p.id AND s.pid = l.pid
),
nearest AS (
  SELECT id, pid, text, row_number() OVER (PARTITION BY id ORDER BY round(d, 9), pid) AS rank
  FROM far QUALIFY rank <= 10
),
ctx AS (
  SELECT id, string_agg(pid::VARCHAR, ',' ORDER BY rank) AS context_ids,
    string_agg(text, ' ' ORDER BY rank) AS context FROM nearest GROUP BY id
)
SELECT q.id, coalesce(context_ids, '') AS context_ids, coalesce(context, '') AS context
FROM questions q LEFT JOIN ctx USING (id)"""


def _clean(text: str) -> str:
    for pattern, replacement in CLEAN_RULES:
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"
    return f"trim({text})"


QA_TABLE = """
qa_table AS (
  SELECT 'q-' || qa.pid AS id, qa.pid AS document_id, question, 'passage ' || qa.pid AS title,
    a_start::BIGINT AS answer_start, a_text AS answer_text, length(qa.text) AS n_chars,
    CASE WHEN length(qa.text) % 2 = 0 THEN 'validation' ELSE 'train' END AS split
  FROM qa LEFT JOIN ans ON ans.pid = qa.pid
)"""

LABELS = """
ranges AS (
  SELECT pid, window_no, min(s) AS lo, max(e) AS hi FROM ctx GROUP BY pid, window_no
),
hits AS (
  SELECT c.pid, c.window_no,
    max(CASE WHEN c.s <= a.a_start THEN c.place END) AS sp,
    min(CASE WHEN c.e >= a.a_end THEN c.place END) AS ep
  FROM ctx c JOIN ranges r USING (pid, window_no) JOIN ans a ON a.pid = c.pid
  WHERE r.lo <= a.a_start AND r.hi >= a.a_end GROUP BY c.pid, c.window_no
)"""

ORACLES: dict[str, str] = {
    "scan_corpus": "SELECT doc_id, text FROM documents",
    "scan_corpus_dict": "SELECT doc_id, text FROM documents",
    "scan_qa": f"""WITH {WINDOWS},{QA_TABLE}
        SELECT split, id, question, document_id, title, answer_start, answer_text, n_chars
        FROM qa_table""",
    "index_roundtrip": TOPK,
    "ivf_roundtrip": IVF,
    "nbest_json": f"""{ANSWERS},{_preds(False)},
        r AS ({NBEST_ROWS}) SELECT id::VARCHAR AS id, rank, text, probability FROM r""",
    "nbest_scan": f"""WITH {NBEST_LISTS}
        SELECT model, id::VARCHAR AS id, rank, text, probability FROM lists""",
    "nbest_scan_dict": f"""WITH {NBEST_LISTS}
        SELECT model, id::VARCHAR AS id, rank, text, probability FROM lists""",
    "vote_file": f"""WITH {VOTES}
        SELECT id::VARCHAR AS id, text AS prediction_text FROM votes
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY round(votes, 9) DESC, first) = 1""",
    "metrics_table": f"""WITH {WINDOWS},{ASKED},{_scored("runs")},
        per AS (SELECT pid, count(*) AS w FROM wins GROUP BY pid)
        SELECT 'eval_exact_match' AS metric, round(avg(em) * 100, 6) AS value FROM scored
        UNION ALL SELECT 'eval_f1', round(avg(f1) * 100, 6) FROM scored
        UNION ALL SELECT 'eval_n', count(*) FROM scored
        UNION ALL SELECT 'train_n_examples', count(*) FROM per
        UNION ALL SELECT 'train_n_windows', sum(w) FROM per
        UNION ALL SELECT 'train_max_windows', max(w) FROM per""",
    "dedup_passages": f"WITH {PASSAGES} SELECT pid, text FROM passages",
    "passage_ids": f"""WITH {PASSAGES}
        SELECT pid, row_number() OVER (ORDER BY pid) - 1 AS passage_id FROM passages""",
    "reader_input": f"""{_search()},{GOLD},{_context(10)}
        SELECT q.id::VARCHAR AS id, q.question, coalesce(c.context, '') AS context,
          g.answer_start::INT AS answer_start,
          CASE WHEN g.id IS NOT NULL THEN q.question END AS answer_text
        FROM questions q LEFT JOIN ctx c USING (id) LEFT JOIN first_gold g ON g.id = q.id""",
    "mask_offsets": f"""WITH {WINDOWS}
        SELECT p.pid AS example_id, p.window_no, p.place, c.s AS start_char, c.e AS end_char
        FROM places p LEFT JOIN ctx c
          ON c.pid = p.pid AND c.window_no = p.window_no AND c.place = p.place""",
    "feature_logit_anti": f"""WITH {WINDOWS}
        SELECT pid AS example_id, window_no, 'logits' AS missing FROM wins WHERE window_no > 0""",
    "tokenize": f"""SELECT doc_id, unnest(range(len(t)))::INT AS pos, unnest(t) AS token
        FROM (SELECT doc_id, {WORDS.format("text")} AS t FROM documents)""",
    "tokenize_udf": """SELECT doc_id, unnest(range(len(t)))::INT AS pos, unnest(t) AS token
        FROM (SELECT doc_id, string_split(lower(text), ' ') AS t FROM documents)""",
    "ngrams": f"""WITH {QUESTIONS},
        tok AS (SELECT id, {WORDS.format("question")} AS t FROM questions),
        grams AS (
          SELECT id, list_concat(
            t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS g FROM tok)
        SELECT id, unnest(range(len(g)))::INT AS pos, unnest(g) AS term FROM grams""",
    "term_freq": f"WITH {PASSAGES},{TF} SELECT pid, term, tf::INT AS tf FROM tf",
    "vocab_topn": f"WITH {PASSAGES},{TF},{VOCAB} SELECT term, df, ctf FROM vocab",
    "idf": f"WITH {PASSAGES},{TF},{VOCAB} SELECT term, round(idf, 6) AS idf FROM vocab",
    "tfidf_weights": f"WITH {INDEX} SELECT term, pid, round(weight, 6) AS weight FROM weights",
    "tfidf_query_vec": f"""WITH {PASSAGES},{TF},{VOCAB},{QUESTIONS},{QVEC}
        SELECT term, id, round(weight, 6) AS weight FROM qvec""",
    "bm25_topk": BM25,
    "clean_text": f"SELECT page_id, {_clean('html')} AS text FROM pages",
    "split_paragraphs": r"""SELECT doc_id, paragraph_no, trim(p) AS paragraph FROM (
          SELECT doc_id, unnest(range(len(string_split_regex(text, '\n+'))))::INT AS paragraph_no,
            unnest(string_split_regex(text, '\n+')) AS p FROM documents
        ) WHERE length(trim(p)) >= 1""",
    "corpus_stats": """SELECT count(*) AS n_rows, count(DISTINCT text) AS n_unique,
          round(avg(length(text)), 6) AS mean_chars, min(length(text))::INT AS min_chars,
          max(length(text))::INT AS max_chars,
          round(quantile_cont(length(text), 0.5), 6) AS median_chars,
          round(quantile_cont(length(text), 0.95), 6) AS p95_chars FROM documents""",
    "tfidf_single": f"""{_search(ONE_QUESTION)}
        SELECT id, pid, rank, round(score, 6) AS score FROM ranked WHERE rank <= 10""",
    "tfidf_scores": f"""WITH {INDEX},{QUESTIONS},{QVEC},{SCORES}
        SELECT id, pid, round(score, 6) AS score FROM scores""",
    "tfidf_topk": TOPK,
    "tfidf_topk_blocks": TOPK,
    "retrieve_context": f"""{_search()},{GOLD},{_context(10)}
        SELECT q.id, q.question, coalesce(c.context_ids, '') AS context_ids,
          coalesce(c.score_sum, 0) AS score_sum, coalesce(c.context, '') AS context,
          p.text AS original_context, g.answer_start::BIGINT AS answer_start
        FROM questions q LEFT JOIN ctx c USING (id) LEFT JOIN first_gold g ON g.id = q.id
        LEFT JOIN passages p ON p.pid = g.pid""",
    "oov_queries": f"""WITH {PASSAGES},{TF},{VOCAB},{OOV_QUESTIONS},
        {_terms("questions", "id", "question", "qtf")}
        SELECT id, question FROM questions
        WHERE id NOT IN (SELECT id FROM qtf JOIN vocab USING (term))""",
    "retrieval_hit_rate": f"""{_search()},{GOLD},
        first AS (
          SELECT g.id, min(r.rank) AS rank FROM gold g
          LEFT JOIN ranked r ON r.id = g.id AND r.pid = g.pid GROUP BY g.id
        )
        SELECT k::INT AS k, count(*) AS n, count(*) FILTER (rank <= k) AS hits,
          round(count(*) FILTER (rank <= k) / count(*)::DOUBLE, 6) AS rate
        FROM first, unnest([1, 5, 10]) AS t(k) GROUP BY k""",
    "vector_topk_l2": _neighbours(_sq("vec", "embedding"), "ASC"),
    "vector_topk_ip": _neighbours(
        "list_dot_product(vec::DOUBLE[], embedding::DOUBLE[])", "DESC"
    ),
    "vector_topk_pivots": _neighbours(_sq("vec", "embedding"), "ASC"),
    "vector_topk_ip_pivots": _neighbours(
        "list_dot_product(vec::DOUBLE[], embedding::DOUBLE[])", "DESC"
    ),
    "ivf_topk": IVF,
    "ivf_codes_topk": IVF_CODES,
    "ivf_assign": f"{LISTS} SELECT vec_id, cluster::INT AS cluster FROM lists",
    "ivf_retrieve": IVF_CONTEXTS,
    "ivf_tfidf_roundtrip": IVF_CONTEXTS,
    "ivf_assign_means": f"{LISTS} SELECT vec_id, cluster::INT AS cluster FROM lists",
    "ivf_retrieve_all": f"""WITH {INDEX},{QUESTIONS},{QVEC},{SCORES},
        far AS (
          SELECT k.id, p.pid, p.text, 2 - 2 * coalesce(s.score, 0) AS d
          FROM (SELECT DISTINCT id FROM qvec) k CROSS JOIN passages p
          LEFT JOIN scores s ON s.id = k.id AND s.pid = p.pid
        ),
        nearest AS (
          SELECT id, pid, text, row_number() OVER (PARTITION BY id ORDER BY round(d, 9), pid) AS rank
          FROM far QUALIFY rank <= 10
        ),
        ctx AS (
          SELECT id, string_agg(pid::VARCHAR, ',' ORDER BY rank) AS context_ids,
            string_agg(text, ' ' ORDER BY rank) AS context FROM nearest GROUP BY id
        )
        SELECT q.id, coalesce(context_ids, '') AS context_ids, coalesce(context, '') AS context
        FROM questions q LEFT JOIN ctx USING (id)""",
    "quantize_sq": """WITH dims AS (
          SELECT vec_id, unnest(embedding)::DOUBLE AS x,
            unnest(range(len(embedding)))::INT AS dim FROM embeddings
        ),
        b AS (SELECT dim, min(x) AS lo, max(x) AS hi FROM dims GROUP BY dim)
        SELECT vec_id, dim, round((x - lo) / (hi - lo) * 15)::INT AS code
        FROM dims JOIN b USING (dim)""",
    "windows": f"""WITH {WINDOWS}
        SELECT pid AS example_id, window_no, first_token, n_context, n_context + 9 AS n_input,
          lo AS text_start, substring(text, lo + 1, hi - lo) AS window_text FROM bounds""",
    "token_offsets": f"""WITH {WINDOWS}
        SELECT pid, pos::INT AS pos, s AS start_char, e AS end_char FROM offs""",
    "pad_windows": f"""WITH {WINDOWS},{IDS}
        SELECT pid AS example_id, window_no, 384 AS n_ids, count(*)::INT AS n_attended,
          sum(id)::BIGINT AS id_sum FROM ids GROUP BY pid, window_no""",
    "label_spans": f"""WITH {WINDOWS},{LABELS}
        SELECT w.pid AS example_id, w.window_no, coalesce(sp, 0)::INT AS start_position,
          coalesce(ep, 0)::INT AS end_position
        FROM wins w LEFT JOIN hits h ON h.pid = w.pid AND h.window_no = w.window_no""",
    "feature_counts": f"""WITH {WINDOWS}, per AS (SELECT pid, count(*) AS w FROM wins GROUP BY pid)
        SELECT count(*) AS n_examples, sum(w)::BIGINT AS n_windows, max(w) AS max_windows
        FROM per""",
    "score_windows": f"""WITH {WINDOWS},{READER_LOGITS}
        SELECT pid AS example_id, window_no, count(*)::INT AS n_logits,
          round(sum(sl), 6) AS start_sum, round(sum(el), 6) AS end_sum,
          round(max(sl), 6) AS start_max, round(max(el), 6) AS end_max
        FROM logits GROUP BY pid, window_no""",
    "features_per_example": f"""WITH {WINDOWS}
        SELECT pid AS id, count(*) AS n_windows FROM wins GROUP BY pid""",
    "null_score": f"""{ANSWERS}
        SELECT pid AS id, round(null_score, 6) AS null_score, window_no,
          round(sl, 6) AS start_logit, round(el, 6) AS end_logit FROM nulls""",
    "top_positions": f"""{ANSWERS}
        SELECT pid AS example_id, window_no, (sr + 1)::INT AS rank, place,
          round(sl, 6) AS logit FROM tops WHERE sr < 20""",
    "candidate_spans": f"""{ANSWERS}
        SELECT pid AS example_id, window_no, sr::INT AS start_rank, er::INT AS end_rank,
          start_char, end_char, round(score, 6) AS score FROM cands""",
    "nbest": f"""{ANSWERS}
        SELECT pid AS example_id, rank::INT AS rank, window_no, start_char, end_char,
          round(score, 6) AS score, text FROM best""",
    "nbest_null": f"{ANSWERS},{_preds(True)} {NBEST_ROWS}",
    "nbest_empty": f"WITH {WINDOWS},{LOGITS},{_spans(2, 3)},{_preds(False, 2)} {NBEST_ROWS}",
    "nbest_softmax": f"{ANSWERS},{_preds(False)} {NBEST_ROWS}",
    "best_answer": f"""{ANSWERS},{_preds(False)}
        SELECT id, text AS prediction_text FROM preds WHERE rank = 1""",
    "best_answer_null": f"""{ANSWERS},{_preds(True)},
        first AS (
          SELECT * FROM preds WHERE text <> ''
          QUALIFY row_number() OVER (PARTITION BY id ORDER BY rank) = 1
        )
        SELECT n.pid AS id, round(null_score - start_logit - end_logit, 6) AS score_diff,
          CASE WHEN null_score - start_logit - end_logit > -3 THEN '' ELSE coalesce(text, '') END
            AS prediction_text
        FROM nulls n LEFT JOIN first f ON f.id = n.pid""",
    "answer_pipeline": f"""WITH {WINDOWS},{READER_LOGITS},{_spans()},{_preds(False)},
        golds AS (SELECT pid AS id, 0 AS gold_no, a_text AS gold FROM ans),
        runs AS (SELECT '' AS run, id, text AS prediction_text FROM preds WHERE rank = 1),
        {_scored("runs")}
        SELECT r.id, r.prediction_text, round(coalesce(em, 0), 6) AS em,
          round(coalesce(f1, 0), 6) AS f1
        FROM runs r LEFT JOIN scored s ON s.id = r.id""",
    "qa_pairs": f"""WITH {PAIRS}
        SELECT id, asked AS prediction_text, gold_no, gold FROM golds JOIN pairs USING (id)""",
    "normalize_answer": f"SELECT doc_id, {_norm('text')} AS text FROM documents",
    "squad_em": f"""WITH {ASKED},{_scored("runs")}
        SELECT round(avg(em) * 100, 6) AS exact_match, count(*) AS n FROM scored""",
    "squad_f1": f"""WITH {ASKED},{_scored("runs")}
        SELECT id, round(em, 6) AS em, round(f1, 6) AS f1 FROM scored""",
    "compare_runs": f"""WITH {BOTH_RUNS},{_scored("runs")}
        SELECT run, round(avg(em) * 100, 6) AS exact_match, round(avg(f1) * 100, 6) AS f1,
          count(*) AS n FROM scored GROUP BY run""",
    "ensemble_votes": f"""WITH {VOTES}
        SELECT id, text, round(votes, 6) AS votes, (first // 100)::INT AS first_model,
          (first % 100)::INT AS first_rank FROM votes""",
    "ensemble_pick": f"""WITH {VOTES}
        SELECT id::VARCHAR AS id, text, round(votes, 6) AS votes FROM votes
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY round(votes, 9) DESC, first) = 1""",
    "concat_splits": f"WITH {WINDOWS},{QA_TABLE} SELECT id, question, split FROM qa_table",
    "augment_union": f"""WITH {WINDOWS},{QA_TABLE}
        SELECT id, question, split FROM qa_table
        UNION ALL SELECT 'extra-' || id, 'tell me ' || question, split FROM qa_table
        WHERE split = 'train'""",
}
