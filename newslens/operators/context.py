"""Sentiment in context: phrases count as a whole, and words before one change its weight.

The lexicon is a table (phrase, pol, sub, modifies) of phrases of one to three words. An entry
(`modifies` false) has polarity and subjectivity in hundredths. A modifier has factors in
hundredths instead: `not` may turn a polarity round and halve it (-50, 100), `very` may raise
both (130, 130).

A text is read from the left. At each word the longest known phrase that begins there is taken, and
reading goes on behind it. Modifiers that stand right before an entry, one after the other, are
multiplied and applied to it; one that meets a word without meaning is spent. All numbers stay whole
hundredths, cut towards zero, factors within -1000..1000, polarity within -100..100 and subjectivity
within 0..100.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.functions.text import mean_hundredths, words
from newslens.operators.skew import spread_join

LONGEST = 3


def _starts(phrases: DataFrame) -> DataFrame:
    """(word, options): for each first word, the phrases that begin with it, with the words that follow.

    The empty word begins an option of kind 0, which counts for nothing.
    """
    part = F.split("phrase", " ")
    known = phrases.select(
        part[0].alias("word"),
        F.struct(
            *[F.get(part, F.lit(i)).alias(f"w{i}") for i in range(1, LONGEST)],
            F.size(part).alias("len"), F.when(F.col("modifies"), 2).otherwise(1).alias("kind"),
            F.col("pol").cast("bigint").alias("pol"), F.col("sub").cast("bigint").alias("sub"),
        ).alias("option"),
    )
    nothing = {"len": F.lit(1), "kind": F.lit(0), "pol": F.lit(0).cast("bigint"), "sub": F.lit(0).cast("bigint")}
    no_word = phrases.sparkSession.range(0, 1, 1, 1).select(
        F.lit("").alias("word"),
        F.struct(
            *[F.lit(None).cast("string").alias(f"w{i}") for i in range(1, LONGEST)],
            *[value.alias(name) for name, value in nothing.items()],
        ).alias("option"),
    )
    return known.unionByName(no_word).groupBy("word").agg(F.collect_list("option").alias("options"))


def _hits(posts: DataFrame, phrases: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, hits): the known phrases of each text by place, longer ones first at one place.

    Only places of known phrases leave the task that reads a text. An empty word closes every text
    and is known, so that a text without any other keeps its place. Repeats of a text
    give the same places and fall together.
    """
    every = F.array_append(F.array_remove(words("text"), ""), F.lit(""))
    # Made in a generator: the words are found once, however often the next step names them.
    split = posts.select(*keys, F.explode(F.array(every)).alias("words"))
    rest = F.size("words")
    shifted = [F.slice("words", i + 1, F.greatest(rest - i, F.lit(0))).alias(f"w{i}") for i in range(LONGEST)]
    placed = split.select(*keys, F.posexplode(F.arrays_zip(*shifted)).alias("pos", "found")).select(
        *keys, "pos", F.col("found.w0").alias("word"), *[F.col(f"found.w{i}") for i in range(1, LONGEST)]
    )

    def goes_on(option: Column) -> Column:
        same = [option[f"w{i}"].isNull() | (option[f"w{i}"] == F.col(f"w{i}")) for i in range(1, LONGEST)]
        return F.coalesce(functools.reduce(Column.__and__, same), F.lit(False))

    found = spread_join(placed, _starts(phrases), "word", keys).select(
        *keys, "pos", F.explode(F.filter("options", goes_on)).alias("p")
    )
    hit = F.struct("pos", (-F.col("p.len")).alias("short"), "p.len", "p.kind", "p.pol", "p.sub")
    return found.groupBy(*keys).agg(F.array_sort(F.collect_set(hit)).alias("hits"))


def _cut(value: Column) -> Column:
    """Hundredths of hundredths to hundredths, towards zero."""
    return ((value - value % 100) / 100).cast("bigint")


def _bounded(value: Column, least: int, most: int = 100) -> Column:
    return F.greatest(F.lit(least).cast("bigint"), F.least(F.lit(most).cast("bigint"), value))


_START = (
    "named_struct('next', 0, 'until', -1, 'by_pol', 100L, 'by_sub', 100L, 'pol', 0L, 'sub', 0L, 'matches', 0L)"
)


def _read(state: Column, hit: Column) -> Column:
    """The state behind a hit: where reading goes on, what modifies the next phrase, and the sums."""
    close = state["until"] == hit["pos"]
    by_pol = F.when(close, state["by_pol"]).otherwise(F.lit(100).cast("bigint"))
    by_sub = F.when(close, state["by_sub"]).otherwise(F.lit(100).cast("bigint"))
    end = hit["pos"] + hit["len"]

    def after(until: Column, factors: tuple[Column, Column], sums: tuple[Column, Column, Column]) -> Column:
        names = ("next", "until", "by_pol", "by_sub", "pol", "sub", "matches")
        return F.struct(*[v.alias(n) for v, n in zip((end, until, *factors, *sums), names, strict=True)])

    unchanged = (state["pol"], state["sub"], state["matches"])
    plain = (F.lit(100).cast("bigint"), F.lit(100).cast("bigint"))
    entry = after(
        F.lit(-1), plain,
        (
            state["pol"] + _bounded(_cut(hit["pol"] * by_pol), -100),
            state["sub"] + _bounded(_cut(hit["sub"] * by_sub), 0),
            state["matches"] + 1,
        ),
    )
    factors = tuple(_bounded(_cut(hit[n] * by), -1000, 1000) for n, by in (("pol", by_pol), ("sub", by_sub)))
    modifier = after(end, factors, unchanged)
    return (
        F.when((hit["pos"] < state["next"]) | (hit["kind"] == 0), state)
        .when(hit["kind"] == 2, modifier)
        .otherwise(entry)
    )


def score_in_context(posts: DataFrame, phrases: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, polarity, subjectivity), one row per distinct value of `keys`, which must tell texts apart.

    The means over the entries found, each with what modifies it; 0 where none was found. The phrases
    meet the texts by a join (broadcast where they are small), and the hits of a text are folded in order.
    """
    state = F.aggregate("hits", F.expr(_START), _read)
    return (
        _hits(posts, phrases, keys)
        .select(*keys, F.explode(F.array(state)).alias("s"))
        .select(
            *keys,
            mean_hundredths(F.col("s.pol"), F.col("s.matches")).alias("polarity"),
            mean_hundredths(F.col("s.sub"), F.col("s.matches")).alias("subjectivity"),
        )
    )
