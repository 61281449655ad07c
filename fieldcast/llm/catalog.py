"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldcast.llm import (
    bpe, classifier, extract, licences, ngrams, packing, pii, pivots, prefixtrie, repair, rules, simhash, warc,
)
from fieldcast.llm.sql import SQL
from fieldcast.llm.common import shared_path, ship_package

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

__all__ = ["REGISTRY", "SQL"]

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, folder)

    REGISTRY[fn.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_pii(spark, folder):
    return pii.personal_data(table(spark, folder, "documents"))


@query
def op2_topk(spark, folder):
    return pivots.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op3_rules(spark, folder):
    return rules.judged(table(spark, folder, "documents"))


@query
def op4_bpe(spark, folder):
    return bpe.coded_digests(table(spark, folder, "documents"), BYTE_VOCABULARY)


@query
def op5_warc(spark, folder):
    return warc.archived(table(spark, folder, "pages"), shared_path(spark, "warc"))


@query
def op6_quality(spark, folder):
    return classifier.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op7_simhash(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op8_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"), WORD_VOCABULARY)


@query
def op9_extract(spark, folder):
    return extract.extracted(table(spark, folder, "pages"))


@query
def op10_licences(spark, folder):
    return licences.scan(table(spark, folder, "documents"))


@query
def op11_ngrams(spark, folder):
    return ngrams.score(table(spark, folder, "documents"))


@query
def op12_prefixes(spark, folder):
    return prefixtrie.prefix_trie(table(spark, folder, "conversations"))


@query
def op13_repair(spark, folder):
    return repair.repair_report(table(spark, folder, "conversations"), damaged=True)
