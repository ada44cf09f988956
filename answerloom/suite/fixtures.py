"""Inputs of the registered queries, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import ReaderConfig
from ..functions.text import tokenize, words_with_gaps
from ..operators.passages import dedup_passages
from ..operators.sizing import query_blocks, union_all
from ..operators.windows import make_windows, mask_offsets
from ..sources.corpus import read_corpus


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_corpus(spark, f"{sf_dir}/documents.parquet", order="doc_id")


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct documents, ``(pid, text)``."""
    return dedup_passages(corpus(spark, sf_dir))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as ``(id, question)``."""
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("id"), F.col("text").alias("question")
    )


def planted_gold(questions: DataFrame, passages: DataFrame) -> DataFrame:
    """Passages containing a question word for word: ``(id, pid, answer_start)``.

    A passage with the question in it also has each inner word of the question
    as a word of its own. The rarest one of those is joined on, and only the
    passages it finds are searched for the whole text. A question without inner
    words joins the empty word, which every passage gets.
    """
    words = tokenize(F.col("question"))
    inner = F.slice(words, 2, F.greatest(F.size(words) - 2, F.lit(0)))
    texts = passages.select(
        "pid", "text",
        F.explode(
            F.array_distinct(F.concat(tokenize(F.col("text")), F.array(F.lit(""))))
        ).alias("term"),
    )

    def find(block: DataFrame) -> DataFrame:
        parts = block.select(
            "id", "question",
            F.explode(
                F.when(F.size(inner) > 0, F.array_distinct(inner)).otherwise(F.array(F.lit("")))
            ).alias("term"),
        )
        spread = texts.join(F.broadcast(parts.select("term").distinct()), "term")
        spread = spread.groupBy("term").agg(F.count("*").alias("df"))
        rarest = F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "term", "question"))
        anchors = (
            parts.join(F.broadcast(spread), "term", "left")
            .groupBy("id")
            .agg(rarest.alias("a"))
            .select("id", "a.term", "a.question")
        )
        place = F.instr(F.col("text"), F.col("question"))
        return (
            texts.join(F.broadcast(anchors), "term")
            .where(place > 0)
            .select("id", "pid", (place - 1).cast("long").alias("answer_start"))
        )

    row_bytes = (F.octet_length("question") * 3 + F.size(words) * 48 + 48).cast("long")
    return union_all([find(b) for b in query_blocks(questions, "id", row_bytes)])


def labelled_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions with ``context`` and ``answers`` of their first gold passage.

    A question found nowhere keeps empty answers and a null context.
    """
    asked, texts = questions(spark, sf_dir), passages(spark, sf_dir)
    first = planted_gold(asked, texts).groupBy("id").agg(
        F.min(F.struct("pid", "answer_start")).alias("g")
    )
    gold = first.select("id", "g.pid", "g.answer_start").join(texts, "pid")
    joined = asked.join(gold, "id", "left")
    found = F.col("pid").isNotNull()
    return joined.select(
        "id",
        "question",
        F.col("text").alias("context"),
        F.struct(
            F.when(found, F.array("answer_start"))
            .otherwise(F.array().cast("array<bigint>"))
            .alias("answer_start"),
            F.when(found, F.array("question"))
            .otherwise(F.array().cast("array<string>"))
            .alias("text"),
        ).alias("answers"),
    )


def qa_span(passages: DataFrame) -> DataFrame:
    """One example per passage; its answer is up to four words from a place set by ``pid``.

    Passages without words have no answer.
    """
    # The words, and each with the blanks after it: their lengths give the places of the words.
    words, pieces = (F.regexp_extract_all("text", F.lit(p), F.lit(0)) for p in (r"[^\s]+", r"[^\s]+\s*"))
    spans = passages.select("pid", "text", words.alias("o"), pieces.alias("p"))
    n = F.size("o")
    k = F.when(n > 0, (F.col("pid") % n).cast("int")).otherwise(0)
    placed = spans.withColumn("k", k)
    last = F.least(F.col("k") + 3, F.size("o") - 1)

    def chars(pieces: Column) -> Column:
        return F.length(F.array_join(pieces, ""))

    def before(place: Column) -> Column:
        return F.length("text") - chars(F.col("p")) + chars(F.slice("p", 1, F.greatest(place, F.lit(0))))

    # A place without a word has no span.
    start = F.when(F.get("o", F.col("k")).isNotNull(), before(F.col("k")))
    end = before(last) + F.length(F.get("o", last))
    answered = F.size("o") > 0
    return placed.select(
        F.col("pid").alias("id"),
        F.concat(F.lit("which words follow word "), F.col("k").cast("string"), F.lit(" here")).alias(
            "question"
        ),
        F.col("text").alias("context"),
        F.struct(
            F.when(answered, F.array(start.cast("long")))
            .otherwise(F.array().cast("array<bigint>"))
            .alias("answer_start"),
            F.when(answered, F.array(F.substring("text", start + 1, end - start)))
            .otherwise(F.array().cast("array<string>"))
            .alias("text"),
        ).alias("answers"),
    )


def qa_table(passages: DataFrame) -> DataFrame:
    """The examples in the stored question schema; even answers starts are validation."""
    return qa_span(passages).select(
        F.col("id").alias("__index_level_0__"),
        "answers",
        "context",
        F.col("id").alias("document_id"),
        F.concat(F.lit("q-"), F.col("id").cast("string")).alias("id"),
        "question",
        F.concat(F.lit("passage "), F.col("id").cast("string")).alias("title"),
        F.when(F.length("context") % 2 == 0, "validation").otherwise("train").alias("split"),
    )


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return make_windows(qa_span(passages(spark, sf_dir)), ReaderConfig())


def logits(windows: DataFrame) -> DataFrame:
    """Masked windows with logits from modular arithmetic; many ties on purpose."""
    at = F.col("example_id") * 7919 + F.col("window_no") * 104729

    def stepped(step: int, modulus: int) -> Column:
        """``((at + i * step) % modulus) / 100`` for every place ``i`` of a window."""
        n = F.size("input_ids")
        sums = F.sequence(at, at + (n - 1) * step, F.lit(step).cast("long"))
        values = F.transform(sums, lambda x: x % modulus / F.lit(100.0))
        unknown = F.transform("input_ids", lambda _: F.lit(None).cast("double"))
        return F.when((n > 0) & at.isNotNull(), values).otherwise(unknown)

    return mask_offsets(windows).withColumns(
        {"start_logits": stepped(31, 251), "end_logits": stepped(53, 257)}
    )


def nbest_lists(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Five candidate words per question from each of three pretended models."""
    words, _ = words_with_gaps(F.col("question"))
    asked = questions(spark, sf_dir).select("id", words.alias("w")).where(F.size("w") > 0)

    def model(m: int) -> DataFrame:
        j = F.col("j")
        return asked.select("id", "w", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("j")).select(
            "id",
            (j + 1).alias("rank"),
            F.get("w", ((F.col("id") + m * j) % F.size("w")).cast("int")).alias("text"),
            (((F.col("id") * 37 + m * 101 + j * 17) % 1000) / F.lit(1000.0)).alias("probability"),
        )

    return [model(m) for m in (1, 2, 3)]


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant turn right after, ``(id, asked, replied, turn)``."""
    turns = table(spark, sf_dir, "conversations")
    user = turns.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("asked")
    )
    reply = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("replied")
    )
    return user.join(reply, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "asked", "replied", "turn"
    )


def pred_ref(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Predictions and references from conversations.

    The prediction is the user turn; gold answers are the reply and, in every
    second pair, the user turn itself in quotes with an article before it.
    """
    pairs = turn_pairs(spark, sf_dir)
    quoted = F.concat(F.lit('The "'), F.col("asked"), F.lit('"!'))
    golds = F.when(F.col("turn") % 4 == 0, F.array("replied", quoted)).otherwise(F.array("replied"))
    predictions = pairs.select("id", F.col("asked").alias("prediction_text"))
    references = pairs.select(
        "id",
        F.struct(
            F.transform(golds, lambda g: F.lit(0).cast("long")).alias("answer_start"),
            golds.alias("text"),
        ).alias("answers"),
    )
    return predictions, references


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"), "label")


def every_vector(vectors: DataFrame) -> DataFrame:
    """Each vector as query ``(qid, vec)``."""
    return vectors.select(F.col("vec_id").alias("qid"), "vec")


def label_means(vectors: DataFrame) -> DataFrame:
    """Mean vector of each label as ``(cluster, center)``."""
    per_dim = (
        vectors.select("label", F.posexplode("vec").alias("dim", "x"))
        .groupBy("label", "dim")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
    )
    ordered = F.sort_array(F.collect_list(F.struct("dim", "x")))
    return per_dim.groupBy(F.col("label").cast("int").alias("cluster")).agg(
        F.transform(ordered, lambda e: e["x"]).alias("center")
    )


def passage_centers(postings: DataFrame, n: int) -> DataFrame:
    """The ``n`` passages with the least ids as sparse centers, ``(cluster, term, weight)``."""
    chosen = postings.select("pid").distinct().orderBy("pid").limit(n)
    numbered = chosen.select("pid", (F.row_number().over(Window.orderBy("pid")) - 1).alias("cluster"))
    return postings.join(F.broadcast(numbered), "pid").select("cluster", "term", "weight")
