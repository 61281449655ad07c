"""From a table of documents to packed training sequences, in five stages.

Each stage works on all rows that the one before it kept. Its result is written as Parquet
and read again, so that a lost executor repeats at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldcast.llm import classifier, packing, pii, rules, simhash
from fieldcast.llm.catalog import WORD_VOCABULARY
from fieldcast.llm.common import ship_package, write_shared


BATCH_ROWS = 1000  # of whole texts that cross to Python at a time; Spark's default is 10,000


def prepare(spark: SparkSession) -> None:
    """What the stages need of a session: the package on the workers, and small batches."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts good; it learns from the table of labels."""
    prepare(spark)
    return classifier.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and are close to a language."""
    prepare(spark)
    return rules.keep_sound(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id."""
    prepare(spark)
    return simhash.one_per_group(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked and n_chars counted anew."""
    prepare(spark)
    return pii.mask(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the packed sequences."""
    prepare(spark)
    return packing.pack(docs, WORD_VOCABULARY, trim=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("best-fit packing", best_fit_packing),
]

#: Trained stages and tokenizers are beyond SQL; the tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_shared(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
