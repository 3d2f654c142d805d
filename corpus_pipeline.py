"""A corpus pipeline: documents in, tokens of the clean and different ones out.

STAGES are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a
DataFrame. Each result is written as Parquet to the shared folder and read again as the
next stage's documents. All but the last return the columns of documents.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import bpe, lines, simhash, templates, toxicity
from tallyspark.llm.catalog import tokenizer_file
from tallyspark.llm.texts import table
from tallyspark.session import discard, shared_dir


REMEMBERED = 250_000


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic, by a model of the labelled ones among them."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier one has; a document of which nothing but blank lines is left goes."""
    return lines.without_repeated(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, as it is or with other numbers, names and units."""
    return templates.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenization(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of the ids and of the decoded text of each document."""
    # Workers still hold what earlier stages have left with them.
    return bpe.digest(bpe.encode_documents(docs, tokenizer_file(), remembered=REMEMBERED))


STAGES = [
    ("toxicity", toxicity_filter),
    ("line_dedup", line_dedup),
    ("simhash", simhash_dedup),
    ("decontamination", decontamination),
    ("bpe", tokenization),
]

# Dictionary training, edit distances and merges have no SQL; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    folder, before = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}", None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            discard(spark, before)
        before = path
    return docs
