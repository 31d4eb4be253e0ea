"""A Merkle manifest of a dataset: one digest for all rows, and a short proof for each.

Rows are leaves. The leaves of a language, in id order, form a tree whose nodes have up to eight
children; the roots of the languages, in their order, form another one. A digest is the sha256 of
its inputs one after the other, as lowercase hex.

Levels are computed by windows. Rows stand in blocks of 512 places, which is three levels: one
shuffle by block serves them all. At every level, lag and lead columns at fixed offsets, masked by
a node's slot and the length of its run, give its siblings, and the first child of a run hashes
its parent. What a block leaves is one row, so the table shrinks by 512 from round to round; then
paths are handed down, from each block's row to the rows of the block. No group holds more than
512 rows, however large a language is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens.session import written

FANOUT = 8
# Levels that one shuffle serves, and the rows that share a block.
LEVELS = 3
BLOCK = FANOUT**LEVELS

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts' UTF-8 bytes in a row."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field_text(value: Column) -> Column:
    """A field as it enters a leaf: `-` if null, else its UTF-8 byte count, `:` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**replaced: Column) -> Column:
    return digest(*[field_text(replaced.get(name, F.col(name))) for name in FIELDS])


def placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """`nodes` with `pos`, the place within `tree` in the order of `order`, and `n`, the tree's size.

    Rows are dealt out by range and numbered where they are; the counts of each tree in the ranges
    before give the offset. Nothing is sorted in one task, and a tree may lie over many ranges.
    """
    keys = ["tree", *order]
    numbered = written(
        nodes.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("part", F.spark_partition_id())
        .withColumn("row", F.monotonically_increasing_id()),
        "numbered",
    )
    ranges = numbered.groupBy("tree", "part").agg(F.min("row").alias("least"), F.count("*").alias("here"))
    of_tree = Window.partitionBy("tree")
    before = of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        "tree", "part",
        (F.coalesce(F.sum("here").over(before), F.lit(0)) - F.col("least")).alias("offset"),
        F.sum("here").over(of_tree).alias("n"),
    )
    return (
        numbered.join(offsets, ["tree", "part"])
        .withColumn("pos", F.col("row") + F.col("offset"))
        .drop("part", "row", "offset")
    )


def _joined(parts: list[Column]) -> Column:
    return F.concat(*[F.coalesce(part, F.lit("")) for part in parts])


def climb(nodes: DataFrame) -> DataFrame:
    """`nodes` (tree, pos, n, digest) with the path through three levels, and the block's digest.

    `path` has one entry for each level at which the tree still has several nodes: the digests of the
    run's nodes before and after the row's ancestor. `top`, only in the row that comes first in
    its block, is the digest of the block.
    """
    block = Window.partitionBy("tree", "block").orderBy("pos")
    out = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("bigint"))
    out = out.withColumn("node_0", F.col("digest"))
    entries = []
    for level in range(LEVELS):
        step, node = FANOUT**level, F.col(f"node_{level}")
        place = F.floor(F.col("pos") / step)
        slot = place % FANOUT
        nodes_here = F.ceil(F.col("n") / step)
        run_length = F.least(F.lit(FANOUT), nodes_here - (place - slot))
        # Rows that are not a node of this level carry null, and so do all rows at their offsets.
        is_node = F.col("pos") % step == 0
        earlier = [
            F.when(is_node & (slot >= j), F.lag(node, j * step).over(block)) for j in range(FANOUT - 1, 0, -1)
        ]
        later = [
            F.when(is_node & (slot + j < run_length), F.lead(node, j * step).over(block)) for j in range(1, FANOUT)
        ]
        entry = F.when(is_node, F.struct(_joined(earlier).alias("before"), _joined(later).alias("after")))
        out = out.withColumn(f"entry_{level}", entry)
        # A lone node is its tree's root already and goes up as it is.
        parent = F.when(
            is_node & (slot == 0),
            F.when(nodes_here > 1, digest(node, F.col(f"entry_{level}.after"))).otherwise(node),
        )
        out = out.withColumn(f"node_{level + 1}", parent)
        # The rows below a node take its entry: the last one at or before them.
        span = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        known = F.col(f"entry_{level}") if level == 0 else F.last(f"entry_{level}", ignorenulls=True).over(span)
        entries.append(F.when(nodes_here > 1, known))
    path = F.filter(F.array(*entries), lambda e: e.isNotNull()).cast(_PATH)
    return out.withColumn("path", path).withColumn("top", F.col(f"node_{LEVELS}"))


def _tops(nodes: DataFrame) -> DataFrame:
    """One row for each block: the nodes three levels up."""
    return written(
        climb(nodes.select("tree", "pos", "n", "digest"))
        .where(F.col("pos") % BLOCK == 0)
        .select(
            "tree", F.col("block").alias("pos"),
            F.ceil(F.col("n") / BLOCK).cast("bigint").alias("n"), F.col("top").alias("digest"),
        ),
        "tops",
    )


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """The nodes, and those of every third level above, up to one node for each tree."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("n")).first()[0] or 1) > 1:
        rounds.append(_tops(rounds[-1]))
    return rounds


def _handed_down(rounds: list[DataFrame], roots: DataFrame, carried: list[str]) -> DataFrame:
    """The first of `rounds` with whole paths and the columns `carried`, which `roots` has by tree."""
    above = rounds[-1].join(roots, "tree")
    for depth in range(len(rounds) - 2, -1, -1):
        parents = above.select(
            "tree", F.col("pos").alias("block"), F.col("path").alias("upper"), *carried
        )
        if depth < len(rounds) - 2:
            parents = written(parents, "paths")
        above = (
            climb(rounds[depth])
            .join(parents, ["tree", "block"])
            .withColumn("path", F.concat("path", "upper"))
            .drop("upper")
        )
    return above


def folded(start: Column, path: Column) -> Column:
    """The root that a digest and a path lead to."""
    return F.aggregate(path, start, lambda node, at: digest(at["before"], node, at["after"]))


def proof_text(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda at: F.concat(at["before"], at["after"])), "")


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, tampered_leaf, subroot, root, path) of every row of a documents table.

    `path` leads from the leaf to the root: what stands before and after at each level. `tampered`
    is a text that some rows are checked with instead of their own (null elsewhere, and where the
    text is null): `tampered_leaf` is its leaf, or null.

    A null in any field enters the leaf as `-`; a null language is a tree of its own, before the
    others; null ids come first in their tree. Rows of one id follow the order of their leaves, so
    repeated rows, whose leaves are equal, may take each other's place. Texts of any length are
    hashed where they are read and not moved. Other columns are not read; an empty table gives no row.
    """
    other = F.lit(None).cast("string") if tampered is None else tampered
    leaves = written(
        docs.select(*FIELDS, other.alias("other")).select(
            F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-")).alias("tree"),
            F.col("doc_id").cast("bigint").alias("doc_id"),
            leaf_digest().alias("digest"),
            F.when(F.col("other").isNotNull(), leaf_digest(text=F.col("other"))).alias("tampered_leaf"),
        ),
        "leaves",
    )
    nodes = written(placed(leaves, ["doc_id", "digest"]), "nodes")
    rounds = _rounds(nodes)
    subroots = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")
    tops = written(placed(subroots, ["of"]), "subroots")
    upper = _rounds(tops)
    root = upper[-1].select("tree", F.col("digest").alias("root"), F.array().cast(_PATH).alias("path"))
    by_tree = written(
        _handed_down(upper, root, ["root"]).select(
            F.col("of").alias("tree"), F.col("digest").alias("subroot"), "root", "path"
        ),
        "roots",
    )
    whole = _handed_down(rounds, by_tree, ["subroot", "root"])
    return whole.select("doc_id", F.col("digest").alias("leaf"), "tampered_leaf", "subroot", "root", "path")


def verified(rows: DataFrame) -> DataFrame:
    """A manifest's rows with proof_sha256, the root that each row folds to, and whether it holds."""
    start = F.coalesce("tampered_leaf", "leaf")
    out = rows.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(proof_text(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        folded(start, F.col("path")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def verify_tampering(docs: DataFrame) -> DataFrame:
    """The manifest checked against texts that are lower-cased where 3 divides crc32 of the id."""
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return verified(manifest(docs, F.when(touched, F.translate("text", UPPER, LOWER))))


# Levels that the statement spells out: 8^10 leaves of a language, 8^4 languages.
_SQL_LEVELS, _SQL_ROOT_LEVELS = 10, 4


def _crc32_sql(text: str) -> str:
    """Unsigned crc32 of a text in ASCII."""
    bits = (
        "list_reduce(list_prepend(xor(acc, byte), range(8)), "
        "lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))"
    )
    codes = f"list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda acc, byte: {bits}), 4294967295)"


def _tree_sql(name: str, levels: int) -> list[str]:
    """CTEs {name}_0 .. {name}_<levels> of nodes (tree, pos, d), each with its siblings."""
    parts = []
    run = "PARTITION BY tree, pos // 8 ORDER BY pos ROWS BETWEEN"
    for k in range(levels + 1):
        source = f"{name}_leaves" if k == 0 else f"{name}_up_{k}"
        parts.append(f"""{name}_{k} AS MATERIALIZED (
  SELECT *, count(*) OVER (PARTITION BY tree) AS n,
         coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {source})""")
        if k < levels:
            parts.append(f"""{name}_up_{k + 1} AS MATERIALIZED (
  SELECT tree, pos // 8 AS pos,
         CASE WHEN any_value(n) > 1 THEN sha256(string_agg(d, '' ORDER BY pos)) ELSE any_value(d) END AS d
  FROM {name}_{k} GROUP BY tree, pos // 8)""")
    return parts


def _paths_sql(name: str, levels: int, rows: str, carried: str) -> list[str]:
    """CTEs that follow `rows` (tree, pos, proof, fold) up the tree: {name}_path_<levels> at the end."""
    parts, source = [], rows
    for k in range(levels):
        parts.append(f"""{name}_path_{k} AS MATERIALIZED (
  SELECT {carried}, r.tree, r.pos,
         CASE WHEN t.n > 1 THEN r.proof || t.before || t.after ELSE r.proof END AS proof,
         CASE WHEN t.n > 1 THEN sha256(t.before || r.fold || t.after) ELSE r.fold END AS fold
  FROM {source} r JOIN {name}_{k} t ON t.tree = r.tree AND t.pos = r.pos // {8**k})""")
        source = f"{name}_path_{k}"
    return parts


def verify_tampering_sql() -> str:
    """DuckDB SQL for `verify_tampering`."""

    def field(value: str) -> str:
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        fields = [f"CAST({c} AS VARCHAR)" for c in FIELDS[:-1]] + [text]
        return "sha256(" + " || ".join(map(field, fields)) + ")"

    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    touched = f"doc_id IS NOT NULL AND text IS NOT NULL AND {_crc32_sql('CAST(doc_id AS VARCHAR)')} % 3 = 0"
    top, root_top = _SQL_LEVELS, _SQL_ROOT_LEVELS
    parts = [
        f"""rows_ AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {leaf('text')} AS leaf,
         CASE WHEN {touched} THEN {leaf(lowered)} END AS other FROM documents)""",
        """doc_rows AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM rows_)""",
        "doc_leaves AS (SELECT tree, pos, leaf AS d FROM doc_rows)",
        *_tree_sql("doc", top),
        f"""sub_rows AS MATERIALIZED (
  SELECT '' AS tree, tree AS of_, d, row_number() OVER (ORDER BY tree) - 1 AS pos FROM doc_{top})""",
        "sub_leaves AS (SELECT tree, pos, d FROM sub_rows)",
        *_tree_sql("sub", root_top),
        "doc_start AS (SELECT doc_id, leaf, tree, pos, '' AS proof, coalesce(other, leaf) AS fold FROM doc_rows)",
        *_paths_sql("doc", top, "doc_start", "r.doc_id, r.leaf"),
        f"""sub_start AS (
  SELECT p.doc_id, p.leaf, s.d AS subroot, s.tree, s.pos, p.proof, p.fold
  FROM doc_path_{top - 1} p JOIN sub_rows s ON s.of_ = p.tree)""",
        *_paths_sql("sub", root_top, "sub_start", "r.doc_id, r.leaf, r.subroot"),
    ]
    return "WITH " + ",\n".join(parts) + f"""
SELECT p.doc_id, p.leaf, p.subroot, t.d AS root, sha256(p.proof) AS proof_sha256,
       p.fold AS folded_root, p.fold = t.d AS verified
FROM sub_path_{root_top - 1} p JOIN sub_{root_top} t ON t.tree = p.tree"""
