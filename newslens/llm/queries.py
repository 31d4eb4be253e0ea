"""The operators as queries over the given tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from newslens.llm import (
    bpe,
    decontaminate,
    language_id,
    license_scan,
    main_text,
    merkle,
    mixing,
    periods,
    simhash,
    substrings,
    token_files,
    toxicity,
    winnowing,
)
from newslens.llm.tables import table

# The tokenizer's vocabulary file, on every executor.
TOKENIZER_FILE = "word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]


def _simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def _winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.near_edits(table(spark, sf_dir, "documents"))


def _main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER_FILE))


def _language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def _license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def _decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.containments(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


# Half as many tokens again as there are, with English and the first domain raised.
MIX = mixing.Mix(
    percent=150,
    epochs=4,
    seed=2026,
    weights={
        "domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1},
        "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
    },
)


def _mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"), MIX)


def _substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def _bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER_FILE))


def _periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.periodic_digests(table(spark, sf_dir, "documents"))


def _merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_tampering(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_simhash": _simhash,
        "op2_license_scan": _license_scan,
        "op3_decontaminate": _decontaminate,
        "op4_toxicity": _toxicity,
        "op5_substrings": _substrings,
        "op6_token_files": _token_files,
        "op7_language_id": _language_id,
        "op8_winnowing": _winnowing,
        "op9_main_text": _main_text,
        "op10_mixing": _mixing,
        "op11_bpe": _bpe,
        "op12_periods": _periods,
        "op13_merkle": _merkle,
    }


def oracle_sql() -> dict[str, str]:
    return {"op10_mixing": mixing.mix_sql(MIX), "op13_merkle": merkle.verify_tampering_sql()}
