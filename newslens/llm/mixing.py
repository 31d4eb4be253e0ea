"""Mixing sources to target weights: hierarchical budgets, filled by prefixes of seeded epochs.

Sources form a tree: domain, language, source. A budget of tokens is dealt down the tree by weight.
A node that cannot use its share, even by reading its documents `epochs` times, is filled, and the
rest goes to its siblings by their weights; since a parent counts as able to use what its
children together can, only what a whole family cannot use goes back to the level above. Each
family is settled in closed form, in the order of capacity by weight, with whole tokens.

A leaf then reads its documents in a new seeded order in every epoch: whole epochs first, then those
documents of the next epoch whose running total of tokens stays within the leaf's budget. The
end of that prefix is found by totals over 4096 ranges of the order, so that only the
documents of one range are ever put in order, however large the leaf.

Everything is DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens.session import written

LEVELS = ("domain", "lang", "source")
_RANGE_BITS = 48  # of the 60 bits of an order key; the 12 above them name a range


@dataclass(frozen=True)
class Mix:
    """Budget in percent of all tokens, epochs at most, and whole-number weights by level and name."""

    percent: int = 100
    epochs: int = 1
    seed: int = 1
    weights: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    default_weight: int = 1


def domain_of(source: Column) -> Column:
    """Four domains by the number at a source's end; `other` without a number."""
    number = F.regexp_extract(source, r"([0-9]{1,9})$", 1)
    return F.coalesce(
        F.when(number != "", F.concat(F.lit("d"), (number.cast("long") % 4).cast("string"))),
        F.lit("other"),
    )


def n_tokens(text: Column) -> Column:
    """Words parted by space or 0x09 to 0x0D; none in a null text."""
    spaces = " \t\n\x0b\f\r"
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(spaces))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+"))).cast("long")


def leaf_columns() -> list[Column]:
    """The levels of documents(lang, source); a null language or source is named ''."""
    return [
        domain_of(F.col("source")).alias("domain"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"),
    ]


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """60 bits that give a document's place in an epoch."""
    name = F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long")


def _weight(level: str, mix: Mix) -> Column:
    given = mix.weights.get(level) or {}
    if not given:
        return F.lit(mix.default_weight).cast("long")
    table = F.create_map(*[F.lit(x) for pair in given.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.col(level)), F.lit(mix.default_weight)).cast("long")


def _settle(nodes: DataFrame, family: list[str], name: str, mix: Mix) -> DataFrame:
    """`nodes` (family..., name, capacity, budget of the family) with `given`, whole tokens each.

    In the order of capacity by weight, a node is filled while its fair share of what the nodes
    before it left is at least its capacity; the nodes after the last filled one share the rest.
    """
    weighed = nodes.withColumn("weight", _weight(name, mix)).where("weight > 0")
    parent = Window.partitionBy(*family) if family else Window.partitionBy(F.lit(0))
    order = parent.orderBy((F.col("capacity") / F.col("weight")).asc(), F.col(name).asc())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    filled = F.col("capacity") * F.sum("weight").over(after) <= left * F.col("weight")
    marked = weighed.withColumn("filled", filled)
    used = F.sum(F.when(F.col("filled"), F.col("capacity")).otherwise(0)).over(parent)
    sharing = F.sum(F.when(F.col("filled"), 0).otherwise(F.col("weight"))).over(parent)
    share = F.expr("(budget - used) * weight div greatest(sharing, 1)")
    return (
        marked.withColumn("used", used)
        .withColumn("sharing", sharing)
        .withColumn("given", F.when(F.col("filled"), F.col("capacity")).otherwise(share))
        .select(*family, name, "capacity", "given")
    )


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """(domain, lang, source, tokens, given) from leaves (domain, lang, source, tokens)."""
    sized = leaves.withColumn("capacity", F.col("tokens") * mix.epochs)
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    level = sized.groupBy("domain").agg(F.sum("capacity").alias("capacity"))
    budget = F.lit(total * mix.percent // 100).cast("long")
    dealt = _settle(level.withColumn("budget", budget), [], "domain", mix)
    for depth in (1, 2):
        family = list(LEVELS[:depth])
        children = sized.groupBy(*LEVELS[: depth + 1]).agg(F.sum("capacity").alias("capacity"))
        budget = dealt.select(*family, F.col("given").alias("budget"))
        dealt = _settle(children.join(budget, family), family, LEVELS[depth], mix)
    return leaves.join(dealt.select(*LEVELS, "given"), list(LEVELS))


def mixing_plan(docs: DataFrame, mix: Mix) -> DataFrame:
    """(domain, lang, source, tokens, given, whole, cut): how often each leaf is read.

    `whole` epochs are read in full; of the next, the documents with an order key of at most `cut`.
    """
    rows = docs.select(*leaf_columns(), F.col("doc_id").cast("long").alias("doc_id"), n_tokens(F.col("text")).alias("tokens"))
    rows = written(rows, "sizes")
    leaves = written(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "leaves")
    budgets = leaf_budgets(leaves, mix).withColumn(
        "whole", F.expr("if(tokens = 0, 0, given div greatest(tokens, 1))")
    ).withColumn("rest", F.col("given") - F.col("whole") * F.col("tokens"))
    # Written so that its size is known: one row for each leaf is broadcast where that is small.
    budgets = written(budgets, "budgets")
    keyed = rows.withColumnRenamed("tokens", "n").join(budgets, list(LEVELS)).select(
        *LEVELS, "n", "rest", order_key(mix.seed, F.col("whole") + 1, F.col("doc_id")).alias("key")
    ).withColumn("range", F.shiftright("key", _RANGE_BITS))
    ranges = keyed.groupBy(*LEVELS, "rest", "range").agg(F.sum("n").alias("n"))
    # At most 4096 rows a leaf.
    running = Window.partitionBy(*LEVELS).orderBy("range")
    ranges = ranges.withColumn("upto", F.sum("n").over(running)).where("upto > rest")
    cut = ranges.groupBy(*LEVELS).agg(
        F.min("range").alias("range"), F.min(F.col("upto")).alias("upto"), F.min_by("n", "range").alias("inside")
    ).select(*LEVELS, "range", (F.col("upto") - F.col("inside")).alias("before"))
    cut = written(cut, "cuts")
    inside = keyed.join(cut, [*LEVELS, "range"])
    place = Window.partitionBy(*LEVELS).orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    ends = (
        inside.withColumn("upto", F.col("before") + F.sum("n").over(place))
        .where("upto <= rest").groupBy(*LEVELS).agg(F.max("key").alias("end"))
    )
    floor = F.shiftleft(F.col("range"), _RANGE_BITS) - 1
    plan = budgets.join(cut, list(LEVELS), "left").join(ends, list(LEVELS), "left")
    return written(
        plan.select(
            *LEVELS, "tokens", "given", "whole",
            F.coalesce("end", floor, F.lit((1 << 60) - 1)).alias("cut"),
        ),
        "plan",
    )


def apply_plan(docs: DataFrame, plan: DataFrame, mix: Mix) -> DataFrame:
    """Columns of `docs` and `mix_epoch`: every document once for each epoch it is read in."""
    leaf = F.struct(*leaf_columns()).alias("_leaf")
    target = plan.select(F.struct(*LEVELS).alias("_leaf"), F.col("whole").alias("_whole"), F.col("cut").alias("_cut"))
    key = order_key(mix.seed, F.col("_whole") + 1, F.col("doc_id"))
    times = F.col("_whole") + F.when((F.col("_whole") < mix.epochs) & (key <= F.col("_cut")), 1).otherwise(0)
    chosen = docs.withColumn("_leaf", leaf).join(target, "_leaf").withColumn("_times", times)
    epochs = F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))
    return chosen.where("_times > 0").select(*[F.col(f"`{c}`") for c in docs.columns], epochs.alias("mix_epoch"))


def mix_documents(docs: DataFrame, mix: Mix) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, epoch): each document once for each epoch it is read in.

    Null texts have no tokens; null languages and sources are leaves named ''; rows without an id
    are ordered like an id ''. Rows that repeat an id are taken together or not at all. Documents
    without tokens are taken as far as the prefix reaches. A leaf of weight 0 is not read. Other
    columns are not read; an empty table gives an empty result.
    """
    narrow = docs.select("doc_id", "lang", "source", n_tokens(F.col("text")).alias("n_tokens"))
    return apply_plan(narrow, mixing_plan(docs, mix), mix).select(
        F.col("doc_id").cast("long").alias("doc_id"), *leaf_columns(), "n_tokens", F.col("mix_epoch").alias("epoch")
    )


def mix_sql(mix: Mix) -> str:
    """The same rows as a DuckDB statement over `documents`."""

    def weight(level: str) -> str:
        given = mix.weights.get(level) or {}
        cases = " ".join(f"WHEN '{name}' THEN {value}" for name, value in given.items())
        return f"CASE {level} {cases} ELSE {mix.default_weight} END" if cases else str(mix.default_weight)

    steps = []
    parents = [
        "SELECT 0 AS root, coalesce(sum(tokens), 0)::BIGINT * {p} // 100 AS given FROM leaves".format(p=int(mix.percent))
    ]
    for depth, name in enumerate(LEVELS):
        family = ["root", *LEVELS[:depth]]
        keys, above = ", ".join([*family, name]), ", ".join(family)
        window = f"PARTITION BY {above} ORDER BY capacity::DOUBLE / weight, {name}"
        parent = f"dealt{depth}"
        steps.append(f"""
  {parent} AS ({parents[-1]}),
  nodes{depth} AS (
    SELECT {", ".join(f"n.{k}" for k in [*family, name])}, n.capacity, n.weight, p.given AS budget
    FROM (SELECT {keys}, sum(tokens)::BIGINT * {int(mix.epochs)} AS capacity, {weight(name)} AS weight
          FROM leaves GROUP BY {keys}) n JOIN {parent} p USING ({above}) WHERE n.weight > 0),
  filled{depth} AS (
    SELECT *, capacity * sum(weight) OVER ({window} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
      <= (budget - coalesce(sum(capacity) OVER ({window} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight
      AS filled FROM nodes{depth}),
  shared{depth} AS (
    SELECT *, sum(CASE WHEN filled THEN capacity ELSE 0 END) OVER (PARTITION BY {above}) AS used,
      sum(CASE WHEN filled THEN 0 ELSE weight END) OVER (PARTITION BY {above}) AS sharing FROM filled{depth})""")
        parents.append(
            f"SELECT {keys}, CASE WHEN filled THEN capacity ELSE (budget - used) * weight // greatest(sharing, 1) END AS given FROM shared{depth}"
        )
    levels = ", ".join(LEVELS)
    key = f"('0x' || substr(md5('{mix.seed}|' || (whole + 1) || '|' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT"
    spaces = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH rows_ AS (
    SELECT doc_id, coalesce('d' || (try_cast(nullif(regexp_extract(source, '([0-9]{{1,9}})$', 1), '') AS BIGINT) % 4), 'other') AS domain,
      coalesce(lang, '') AS lang, coalesce(source, '') AS source,
      CASE WHEN trim(coalesce(text, ''), {spaces}) = '' THEN 0
        ELSE len(string_split_regex(trim(text, {spaces}), '[\\x20\\x09-\\x0D]+')) END AS n_tokens
    FROM documents),
  leaves AS (SELECT 0 AS root, {levels}, sum(n_tokens)::BIGINT AS tokens FROM rows_ GROUP BY {levels}),
  {",".join(steps)},
  budgets AS (
    SELECT {levels}, tokens, given, CASE WHEN tokens = 0 THEN 0 ELSE given // greatest(tokens, 1) END AS whole
    FROM leaves JOIN ({parents[-1]}) USING ({levels})),
  keyed AS (SELECT r.*, whole, given - whole * tokens AS rest, {key} AS key FROM rows_ r JOIN budgets USING ({levels})),
  placed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY {levels} ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM keyed),
  times AS (SELECT *, whole + CASE WHEN whole < {int(mix.epochs)} AND upto <= rest THEN 1 ELSE 0 END AS times FROM placed)
SELECT doc_id, {levels}, n_tokens::BIGINT AS n_tokens, unnest(range(1, (times + 1)::BIGINT))::INTEGER AS epoch FROM times WHERE times > 0
"""
