"""The corpus pipeline: from raw documents to token files, one operator a stage.

Every stage reads all rows that the one before kept. Rows without an id cannot be followed through
the later stages and are left out by the first one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.llm import decontaminate, language_id, mixing, simhash, token_files
from newslens.session import ship_package, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER_FILE = "word_bpe_49k.json"

# Nine tenths of the tokens, each document at most once: the largest sources give the most.
MIX = mixing.Mix(percent=90, epochs=1, seed=2026)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told (no text, or no letter in it) go.

    A null language is filled with the predicted one.
    """
    ship_package(spark)
    docs = docs.select(*COLUMNS).where(F.col("doc_id").isNotNull())
    found = language_id.identify(docs, keep=COLUMNS[1:]).where(F.col("lang_pred") != language_id.UNKNOWN)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id.

    Of rows that repeat one id, the one with the smallest text stays, then language, source and length.
    """
    ship_package(spark)
    docs = docs.select(*COLUMNS)
    groups = simhash.near_duplicates(docs).where("doc_id = component_id")
    kept = groups.select("doc_id").distinct()
    one = docs.groupBy("doc_id").agg(F.min(F.struct(*COLUMNS[1:])).alias("row")).select("doc_id", "row.*")
    return one.join(kept, "doc_id").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    docs = docs.select(*COLUMNS)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaked = decontaminate.containments(docs, items).select("doc_id").distinct()
    return docs.join(leaked, "doc_id", "left_anti").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within their source's budget stay, each once."""
    docs = docs.select(*COLUMNS)
    return mixing.apply_plan(docs, mixing.mixing_plan(docs, MIX), MIX).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left: where each document stands in them, and a checksum."""
    ship_package(spark)
    return token_files.token_files(docs, public_tokenizers.path(TOKENIZER_FILE))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
    ("tokens", tokens),
]

# Hash functions, models and token files have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
