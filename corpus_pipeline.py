"""Corpus pipeline: from raw documents to token ids, a stage per operator.

Every stage takes what its predecessor kept and decides on all of it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import bpe, decontaminate, partenum, qda, repeats, textstats
from faultline.llm.queries import LEAST_SCORE, quality_model, table
from faultline.session import begin_step, drop_step, written

FEW = 1_000_000  # row numbers that may be broadcast: 16 MB
ROW = "_row"
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_000  # texts sent to a Python worker at once
WORDS, SIMILAR = 5, (80, 100)  # of near duplicates; op3 has figures of its own
_open_step: list[str] = []  # of the last stage that ran


def stage(function):
    """A stage writes its intermediate tables to a step of its own and removes those of the stage before, whose result must
    be stored by then, outside that step (see ``stored``). What it writes reads texts in batches of BATCH_ROWS: a batch stands
    in a task's JVM and in its Python worker at once."""
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame | None, sf_dir: str) -> DataFrame:
        while _open_step:
            drop_step(spark, _open_step.pop())
        outer, rows = begin_step(f"stage-{uuid.uuid4().hex}"), int(spark.conf.get(BATCH))
        spark.conf.set(BATCH, min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS)
        try:
            return function(spark, docs, sf_dir)
        finally:
            spark.conf.set(BATCH, rows)
            _open_step.append(begin_step(outer))

    return run_stage


def stored(docs: DataFrame, name: str) -> DataFrame:
    """A stage's result, written and read back."""
    return written(docs, name)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number for each row, stored, so that a stage can judge rows whose ids are repeated or NULL."""
    return written(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """``rows`` but for the numbers in ``dropped``, and without numbers. Few go to the texts, many meet them by number."""
    dropped = written(dropped.select(ROW), "dropped")
    if dropped.count() <= FEW:
        dropped = F.broadcast(dropped)
    return rows.join(dropped, ROW, "left_anti").drop(ROW)


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the discriminant scores at least LEAST_SCORE; trained on the labelled rows that are not held out."""
    counted = written(textstats.text_counts(docs), "counts")
    model = quality_model(counted, table(spark, sf_dir, "labels"))
    return qda.keep_good(docs, model, LEAST_SCORE)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that share 0.8 of their five-word runs the one with the smallest id, NULL being the
    largest. Each row is a document of its own, also among rows that share an id."""
    rows = numbered(docs)
    found = partenum.similar_documents(rows, key=ROW, words=WORDS, similar=SIMILAR)
    found = written(found.join(rows.select(ROW, "doc_id"), ROW), "found")
    first = found.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW)).alias("first"))
    return without(rows, found.join(first.select(F.col(f"first.{ROW}")), ROW, "left_anti"))


@stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that a smaller document has, cut at whole characters, and their new lengths. A document of
    which nothing remains goes; one that was empty before stays."""
    cut = repeats.without_repeats(docs, carry=True, whole=True)
    rest = cut.filter((F.octet_length("text") > 0) | (F.size("spans") == 0)).withColumn("text", F.col("text").cast("string"))
    return rest.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


@stage
def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in passages of the benchmark; their texts stay as they are."""
    rows = numbered(docs)
    found = decontaminate.find_phrases(rows, table(spark, sf_dir, "benchmark"), key=ROW)
    return without(rows, found.filter(decontaminate.contaminated()))


@stage
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's ids, and the digest of what they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.digests(bpe.encode_decode(docs, ranks, public_tokenizers.PATTERN))


STAGES = [
    ("quality_classifier", quality), ("jaccard_join", near_duplicates), ("suffix_array_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_passages), ("byte_level_bpe", token_ids),
]

ORACLE_SQL = None  # a trained model, similarity components and ranked merges are beyond SQL; tests/llm has the brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stored(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
