"""Text cleaning and the two sentiment axes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newslens import constants as C

# Every pattern meets lower-cased text. Three forms of one rule, from cheap to complete; which
# one a text needs is decided by two plain substring tests.
_MARKS = "[^0-9a-z]+"
_MENTIONS_AND_MARKS = rf"{C.MENTION}|@|[^0-9a-z@]+"
# The URL rule is stated for Unicode text, where \w is a letter, a number or `_` and \S is
# anything but white space; Java's own classes differ (its \w includes combining marks). It is
# tried only at the start of a run of plain characters: if it does not match there it matches
# nowhere later in that run, so a long unbroken run costs one attempt, not one per character.
_WORD, _SOLID = r"[0-9a-z_\p{L}\p{N}]", r"[^\p{IsWhite_Space}\x{1c}-\x{1f}]"
_URL = C.URL.replace(r"\w+", f"{_WORD}++").replace(r"\S+", f"{_SOLID}++")
_ALL_NOISE = rf"{C.MENTION}|{C.NOT_PLAIN}|(?<![0-9A-Za-z]){_URL}"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _by_content(text: Column, plain: Column, mentions: Column, urls: Column) -> Column:
    return (
        F.when(F.contains(text, F.lit("://")), urls)
        .when(F.contains(text, F.lit("@")), mentions)
        .otherwise(plain)
    )


def _spaced(text: Column) -> tuple[Column, Column, Column]:
    lower = F.lower(text)
    return tuple(
        F.regexp_replace(lower, pattern, " ")
        for pattern in (_MARKS, _MENTIONS_AND_MARKS, _ALL_NOISE)
    )


def clean_text(text: Column | str) -> Column:
    """Lower-case words of [0-9a-z], one blank apart; mentions, links and marks are dropped."""
    text = F.coalesce(_col(text), F.lit(C.NULL_TEXT))
    plain, mentions, urls = _spaced(text)
    return F.trim(
        _by_content(
            text,
            plain,
            F.regexp_replace(mentions, " +", " "),
            F.regexp_replace(urls, "[ \t]+", " "),
        )
    )


def words(text: Column | str) -> Column:
    """The words of `clean_text`, as an array that may also hold empty strings."""
    text = F.coalesce(_col(text), F.lit(C.NULL_TEXT))
    _, mentions, urls = _spaced(text)
    return _by_content(
        text, F.split(F.lower(text), _MARKS), F.split(mentions, " "), F.split(urls, "[ \t]")
    )


def fingerprint(text: Column | str) -> Column:
    """16 bytes that stand for a whole text wherever texts only need to be told apart."""
    return F.unhex(F.md5(text))


def unsigned(digest: Column | str, start: int, bits: int) -> Column:
    """A stretch of a digest's bits as a whole number; both in multiples of 4, at most 60 bits."""
    hexes = F.substring(F.hex(_col(digest)), start // 4 + 1, bits // 4)
    return F.conv(hexes, 16, 10).cast("bigint")


def mean_hundredths(total: Column, matches: Column) -> Column:
    """Mean of `matches` integer hundredths; 0 where nothing matched."""
    return F.when(matches > 0, total.cast("double") / (matches * 100)).otherwise(F.lit(0.0))


def sentiment_bin(polarity: Column | str) -> Column:
    """0..5 for a polarity in [-1, 1]; 5 only at 1."""
    return _clamp((_col(polarity) + 1) * 2.5, C.TEXT_BINS)


def subjectivity_bin(subjectivity: Column | str) -> Column:
    """0..5 for a subjectivity in [0, 1]; 5 only at 1."""
    return _clamp(_col(subjectivity) * 5, C.TEXT_BINS)


def _clamp(value: Column, bins: int) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(float(bins - 1)), value)).cast("int")
