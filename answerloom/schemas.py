"""Declared schemas of the tables that enter and leave the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


def _answers(start: T.DataType) -> T.StructType:
    return _struct(("answer_start", T.ArrayType(start)), ("text", T.ArrayType(T.StringType())))


QA = _struct(
    ("__index_level_0__", T.LongType()),
    ("answers", _answers(T.LongType())),
    ("context", T.StringType()),
    ("document_id", T.LongType()),
    ("id", T.StringType()),
    ("question", T.StringType()),
    ("title", T.StringType()),
)

QA_TEST = _struct(("id", T.StringType()), ("question", T.StringType()))

CORPUS_ENTRY = _struct(("text", T.StringType()))

READER_PREDICT = _struct(
    ("context", T.StringType()), ("id", T.StringType()), ("question", T.StringType())
)

READER_EVAL = _struct(
    ("answers", _answers(T.IntegerType())),
    ("context", T.StringType()),
    ("id", T.StringType()),
    ("question", T.StringType()),
)

NBEST_ENTRY = _struct(
    ("start_logit", T.DoubleType()),
    ("end_logit", T.DoubleType()),
    ("text", T.StringType()),
    ("probability", T.DoubleType()),
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast the columns of a schema; a missing one is an error."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
