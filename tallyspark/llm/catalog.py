"""One registered query for each operator, over its whole table, and the SQL of those that SQL can state."""

import os

from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import bpe, chat, infill, lattice, licences, lines, ngrams, pages, resample, simhash, templates, toxicity, warc
from tallyspark.llm.texts import table

QUERIES = {}
SQL = {}


def query(name):
    def register(run):
        QUERIES[name] = run
        return run

    return register


def tokenizer_file(name="word_bpe_49k.json"):
    """Where a public vocabulary file lies; TOKENIZERS_DIR overrides the installed package."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_bpe")
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_file()))


@query("op8_chat")
def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(chat.format_conversations(table(spark, sf_dir, "conversations")))


SQL["op8_chat"] = chat.digest_sql()


@query("op6_licences")
def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.digest(licences.scan(table(spark, sf_dir, "documents")))


SQL["op6_licences"] = licences.digest_sql()


@query("op10_html")
def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


@query("op9_lattice")
def op9_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op7_lines")
def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(lines.dedupe_lines(table(spark, sf_dir, "documents")))


@query("op2_templates")
def op2_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op1_ngrams")
def op1_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.score(table(spark, sf_dir, "documents"))


@query("op11_infill")
def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digest(infill.transform(table(spark, sf_dir, "documents")))


SQL["op11_infill"] = infill.digest_sql()


@query("op12_warc")
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


SQL["op12_warc"] = warc.digest_sql()


@query("op13_resample")
def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.digest(resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


SQL["op13_resample"] = resample.digest_sql()
