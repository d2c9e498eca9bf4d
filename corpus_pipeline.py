"""A training-data pipeline over ``documents`` in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows the stage
before it kept; its result is written as Parquet and read again. All but the
last return the columns of ``documents``.

Defined results, by stage: null, empty and letterless texts have no language and
go in the first stage (alone, the later stages keep them); a text of any length
is read whole; of near copies the one with the smallest id stays, and of rows
equal in id and text one; other rows with one id are judged each by its own
text; a null id is kept
like any other; extra columns are passed on by every stage but the last; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.llm import bpe_stream, common, decontaminate, jaccard_join, language_id, pii
from loomstat.session import scratch_path

NEAR_WORDS, NEAR_PERCENT = 5, 80  # word shingles and Jaccard similarity of near copies; op10 has its own
LEAST_SCORE = 0.5  # a text whose best language has less on average is rejected, as is a text without a letter


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language; a missing label becomes the predicted one."""
    common.prepare(spark)
    found = language_id.predict(docs, language_id.train(docs), docs.columns)
    return (found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
            .withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""
    common.prepare(spark)
    return jaccard_join.keep_one(docs, k=NEAR_WORDS, t=NEAR_PERCENT)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a benchmark phrase occurs."""
    return decontaminate.drop_contaminated(docs, common.documents(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; ``n_chars`` follows the new text."""
    common.prepare(spark)
    return pii.redact(docs, pii.train(docs)).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, ids`` of each text."""
    common.prepare(spark)
    return bpe_stream.round_trip(docs, keep_ids=True)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("pii", redact_personal_data),
    ("bpe", tokenize),
]

#: the stages are learned models, hash orders and a tokenizer: no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
