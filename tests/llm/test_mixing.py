"""Budgets and prefixes against a plain version."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import duckdb
import pytest

from newslens.llm.mixing import Mix, leaf_budgets, mix_documents, mix_sql

MIXES = [
    Mix(), Mix(percent=40), Mix(percent=130, epochs=3, seed=9, weights={"domain": {"d0": 5, "d1": 0}, "lang": {"en": 7, "": 2}}),
    Mix(percent=1000, epochs=2), Mix(percent=0),
    Mix(percent=75, epochs=4, weights={"source": {"src3": 100}, "domain": {"d3": 50, "other": 3}}, default_weight=2),
]


def deal(budget, nodes):
    """Round after round: fair shares of what is left, filled nodes out. nodes: name -> (weight, capacity)."""
    given, open_ = {}, {n: x for n, x in nodes.items() if x[0] > 0}
    while open_:
        total = sum(w for w, _ in open_.values())
        full = [n for n, (w, c) in open_.items() if c * total <= budget * w]
        if not full:
            return given | {n: budget * w // total for n, (w, _) in open_.items()}
        for n in full:
            given[n] = open_.pop(n)[1]
        budget -= sum(given[n] for n in full)
    return given


def plain_budgets(leaves, mix):
    def weight(level, name):
        return mix.weights.get(level, {}).get(name, mix.default_weight)

    def walk(budget, rows, depth):
        if depth == 3:
            return {leaf: budget for leaf in rows}
        groups = defaultdict(list)
        for leaf in rows:
            groups[leaf[depth]].append(leaf)
        level = ("domain", "lang", "source")[depth]
        nodes = {n: (weight(level, n), mix.epochs * sum(leaves[x] for x in g)) for n, g in groups.items()}
        return {k: v for n, b in deal(budget, nodes).items() for k, v in walk(b, groups[n], depth + 1).items()}

    return walk(sum(leaves.values()) * mix.percent // 100, list(leaves), 0)


def leaf_of(lang, source):
    source = source or ""
    digits = ""
    while source[len(source) - len(digits) - 1 :][:1].isdigit() and len(digits) < min(9, len(source)):
        digits = source[len(source) - len(digits) - 1] + digits
    return (f"d{int(digits) % 4}" if digits else "other", lang or "", source)


def plain(rows, mix):
    docs = [(d, leaf_of(lang, s), len((t or "").encode().split())) for d, t, lang, s in rows]
    leaves = defaultdict(int)
    for _, leaf, n in docs:
        leaves[leaf] += n
    out = []
    for leaf, given in plain_budgets(leaves, mix).items():
        whole = given // leaves[leaf] if leaves[leaf] else 0
        key = lambda d: int(hashlib.md5(f"{mix.seed}|{whole + 1}|{'' if d is None else d}".encode()).hexdigest()[:15], 16)
        mine = [(key(d), d, n) for d, x, n in docs if x == leaf]
        for k, d, n in mine:
            upto = sum(m for j, _, m in mine if j <= k)
            times = whole + (whole < mix.epochs and upto <= given - whole * leaves[leaf])
            out += [(d, *leaf, n, e) for e in range(1, times + 1)]
    return sorted(out, key=repr)


def some_rows():
    rng = random.Random(8)
    rows = [(i, "w " * rng.randint(0, 40), rng.choice(["en", "en", "de", "fr", None]), rng.choice(["src0"] * 6 + ["src1", "src3", "src10", "blog", None, ""])) for i in range(400)]
    return rows + [(5, "again and again", "en", "src0"), (5, "again and again", "en", "src0"), (None, "no id", "en", "src0"), (None, "no id", "en", "src0"), (900, None, "de", "src3"), (901, " \t\n ", "xx", "only empty"), (902, "a\x0bb\x0cc  d ", "de", "src3"), (903, "long " * 30000, "it", "src7")]


@pytest.mark.parametrize("mix", MIXES)
def test_against_plain_and_sql(spark, mix):
    rows = some_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1 AS tokens", "2 AS domain", "3 AS epoch", "4 AS `_leaf`")
    wanted = plain(rows, mix)
    assert sorted(map(tuple, mix_documents(df.drop("_leaf"), mix).collect()), key=repr) == wanted
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    assert sorted(con.execute(mix_sql(mix)).fetchall(), key=repr) == wanted


def test_shortage_goes_to_siblings_first(spark):
    leaves = [("a", "x", "1", 10), ("a", "y", "1", 100), ("b", "x", "1", 200)]
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
    got = {r.domain + r.lang: r.given for r in leaf_budgets(df, Mix(percent=50)).collect()}
    assert got == {"ax": 10, "ay": 67, "bx": 78} or got == {"ax": 10, "ay": 67, "bx": 77}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert mix_documents(df, Mix()).count() == 0
