"""Documents to packed training sequences: five operators in a row, whole tables each.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's docs. All stages
but the last return the columns of documents; the last returns one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm import decontaminate, disclosure, jaccard_join, packing, site_quality
from strata.llm.queries import tokenizer_file, unwanted_labels
from strata.llm.shared import written
from strata.sources import catalog


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the site-aware classifier rejects go."""
    return site_quality.keep_wanted(docs, unwanted_labels(spark, sf_dir), host=F.col("source"), path=F.col("lang"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest doc_id."""
    return jaccard_join.keep_one_of_each(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.remove_leaks(docs, catalog.load(spark, sf_dir, "benchmark"))


def protect(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms are replaced in the texts."""
    return disclosure.sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become token pieces in sequences of at most 2048."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", classify),
    ("n-gram Jaccard join", deduplicate),
    ("benchmark decontamination", decontaminate_benchmark),
    ("PII", protect),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the table after each stage is written to the shared folder."""
    docs = catalog.load(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)


#: tokenizer ids and a fitted classifier are beyond SQL; tests hold each stage against brute force
ORACLE_SQL = None
