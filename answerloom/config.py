"""Settings of the retrieval, reader and answer steps."""

from __future__ import annotations

from dataclasses import dataclass

# The defaults a user of the reference pipeline gets.
MAX_FEATURES = 50_000
NGRAM_RANGE = (1, 2)
TOP_K_RETRIEVAL = 10
NUM_CLUSTERS = 64
MAX_SEQ_LENGTH = 384
DOC_STRIDE = 128
N_BEST_SIZE = 20
MAX_ANSWER_LENGTH = 30
NULL_SCORE_DIFF_THRESHOLD = 0.0
ENSEMBLE_MODELS = 3

# A table is broadcast only after its size was measured to be below this.
BROADCAST_BYTES = 64 * 1024 * 1024
# Postings in one file of a stored index, which holds a range of terms.
FILE_POSTINGS = 4_000_000
# Postings met by a question set from which a stored index is searched by block maxima.
MANY_POSTINGS = 50_000_000
# Bytes of query vectors that go to every task of a vector search, which holds their best rows.
QUERY_BYTES = 4 * 1024 * 1024
# Bytes and number of queries, with their best rows, that a cell of a blocked vector search may hold.
CELL_BYTES = 32 * 1024 * 1024
CELL_ROWS = 8192
# Pairs compared in one cell, and cells that small query sets are cut into.
CELL_PAIRS = 500_000_000
FEW_CELLS = 16
# Bytes of pivots that group vectors for such a search.
PIVOT_BYTES = 16 * 1024 * 1024
# Heaviest terms a center of clustered TF-IDF keeps, and rounds of its training.
CENTER_TERMS = 1000
CENTER_ROUNDS = 5


@dataclass(frozen=True)
class TfidfConfig:
    """Vocabulary and tokenizer settings of a TF-IDF index."""

    max_features: int | None = MAX_FEATURES
    min_n: int = NGRAM_RANGE[0]
    max_n: int = NGRAM_RANGE[1]
    tokenizer: str = "regex"


@dataclass(frozen=True)
class Bm25Config:
    """BM25 saturation and length parameters."""

    k1: float = 1.5
    b: float = 0.75


@dataclass(frozen=True)
class ReaderConfig:
    """Shape of the windows a reader sees.

    ``doc_stride`` is the number of context tokens two neighbouring windows
    share. The effective length never exceeds ``model_max_length``.
    """

    max_seq_length: int = MAX_SEQ_LENGTH
    doc_stride: int = DOC_STRIDE
    model_max_length: int = 512
    n_special: int = 3
    vocab_size: int = 32_000
    pad_id: int = 0
    cls_id: int = 1
    sep_id: int = 2

    @property
    def window_length(self) -> int:
        return min(self.max_seq_length, self.model_max_length)


@dataclass(frozen=True)
class AnswerConfig:
    """How logits become answers."""

    n_best_size: int = N_BEST_SIZE
    max_answer_length: int = MAX_ANSWER_LENGTH
    allow_null: bool = False
    null_threshold: float = NULL_SCORE_DIFF_THRESHOLD
