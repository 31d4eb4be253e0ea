"""The default sentiment lexicon: polarity and subjectivity in hundredths.

Any table with columns word, pol (-100..100) and sub (0..100) can take its place. Integer
hundredths keep sums exact, so no bin depends on the order in which rows are added.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# (polarity, subjectivity, words)
_GROUPS = (
    (100, 100, "excellent perfect wonderful superb flawless best"),
    (75, 90, "great amazing brilliant beautiful awesome delightful"),
    (50, 60, "good happy love nice glad proud win hope safe enjoy"),
    (25, 40, "fine okay calm fair useful helpful clear new fresh honest"),
    (10, 30, "likely steady usual common able ready"),
    (0, 50, "maybe perhaps apparently allegedly seemingly rumor opinion believe think feel"),
    (0, 0, "official reported confirmed data study evidence source record measured according"),
    (-10, 30, "odd unclear doubtful slow late minor"),
    (-25, 50, "weak poor sad unfair strange cheap noisy afraid worried"),
    (-50, 65, "bad wrong angry fail hate lie hurt fear false ugly"),
    (-75, 85, "terrible awful disgusting corrupt shameful toxic cruel fraud"),
    (-100, 100, "horrible worst evil vile hoax disastrous"),
)


# (polarity factor, subjectivity factor, words); both in hundredths
_MODIFIERS = (
    (-50, 100, "not no never without hardly"),
    (130, 130, "very really extremely highly so"),
    (60, 80, "slightly somewhat rather partly"),
)

# (polarity, subjectivity, phrases)
_PHRASES = (
    (-60, 70, "fake news", "out of context", "made up"),
    (40, 30, "fact checked", "on the record"),
    (-20, 60, "so called", "it is said"),
)


def lexicon_table(spark: SparkSession, rows: Iterable[tuple[str, int, int]]) -> DataFrame:
    """A lexicon from (word, pol, sub) rows, as a local relation whose size Catalyst knows."""
    columns = zip(*rows)
    types = {"word": pa.string(), "pol": pa.int32(), "sub": pa.int32()}
    return spark.createDataFrame(
        pa.table({name: pa.array(next(columns), kind) for name, kind in types.items()})
    )


def default_lexicon(spark: SparkSession) -> DataFrame:
    return lexicon_table(
        spark, [(word, pol, sub) for pol, sub, words in _GROUPS for word in words.split()]
    )


def phrase_table(spark: SparkSession, rows: Iterable[tuple[str, int, int, bool]]) -> DataFrame:
    """A lexicon of phrases from (phrase, pol, sub, modifies) rows."""
    columns = zip(*rows)
    types = {"phrase": pa.string(), "pol": pa.int32(), "sub": pa.int32(), "modifies": pa.bool_()}
    return spark.createDataFrame(
        pa.table({name: pa.array(next(columns), kind) for name, kind in types.items()})
    )


def default_phrases(spark: SparkSession) -> DataFrame:
    """The words of the default lexicon, with modifiers and some phrases."""
    rows = [(word, pol, sub, False) for pol, sub, words in _GROUPS for word in words.split()]
    rows += [(word, pol, sub, True) for pol, sub, words in _MODIFIERS for word in words.split()]
    rows += [(phrase, pol, sub, False) for pol, sub, *phrases in _PHRASES for phrase in phrases]
    return phrase_table(spark, rows)
