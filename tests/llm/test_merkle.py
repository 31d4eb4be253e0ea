from __future__ import annotations

import hashlib
import random
import zlib

from compare import duck, duck_rows, spark_rows

from newslens.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, pos string, tree int"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(digests: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and the path of every leaf."""
    paths: list[list[tuple[str, str]]] = [[] for _ in digests]
    groups = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        up, merged = [], []
        for low in range(0, len(digests), 8):
            run = digests[low : low + 8]
            for slot in range(len(run)):
                for i in groups[low + slot]:
                    paths[i].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            up.append(sha("".join(run)))
            merged.append([i for g in groups[low : low + 8] for i in g])
        digests, groups = up, merged
    return digests[0], paths


def plain(rows) -> list[tuple]:
    trees: dict = {}
    for row in rows:
        doc_id, source, lang, n_chars, text = row[:5]
        own = leaf((doc_id, source, lang, n_chars, text))
        touched = doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text) if touched else text
        trees.setdefault(lang, []).append((doc_id, own, leaf((doc_id, source, lang, n_chars, lowered))))
    if not trees:
        return []
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for lang in langs:
        trees[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        built[lang] = climb([own for _, own, _ in trees[lang]])
    root, upper = climb([built[lang][0] for lang in langs])
    out = []
    for lang, above in zip(langs, upper, strict=True):
        subroot, paths = built[lang]
        for (doc_id, own, fold), path in zip(trees[lang], paths, strict=True):
            for before, after in [*path, *above]:
                fold = sha(before + fold + after)
            proof = sha("".join(before + after for before, after in [*path, *above]))
            out.append((doc_id, own, subroot, root, proof, fold, fold == root))
    return out


def check(spark, rows) -> None:
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = merkle.verify_tampering(docs)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(plain(rows), key=str)


def rows_of(lang, count: int, start: int = 0) -> list[tuple]:
    rng = random.Random(count)
    texts = ("Ab É", None, "", "plain", "ÀZ z", "x" * 3000)
    return [
        (i, rng.choice(["s", None, "ü"]), lang, rng.choice([None, 5]), rng.choice(texts), "p", 7)
        for i in range(start, start + count)
    ]


def test_trees_of_many_sizes(spark):
    """Sizes around the borders of runs and blocks, a lone leaf, a null language, languages in byte order."""
    sizes = {None: 9, "": 1, "-": 2, "=": 8, "de": 64, "en": 1300, "fr": 65, "z": 7, "é": 513, "b": 3}
    rows = [row for number, (lang, n) in enumerate(sizes.items()) for row in rows_of(lang, n, 10_000 * number)]
    check(spark, rows)


def test_null_and_repeated_ids(spark):
    rows = rows_of("en", 20)
    rows += [rows[3], rows[3], (rows[4][0], "other", "en", 1, "Other", "p", 1), (None, "s", "en", 1, "T", "p", 1)]
    rows += [(None, None, None, None, None, None, None)] * 3 + [(-5, "s", "en", 1, "Below", "p", 1)]
    check(spark, rows)


def test_one_row_and_none(spark):
    check(spark, rows_of("en", 1))
    check(spark, [])


def test_tampering_shows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = merkle.verify_tampering(docs).collect()
    false = {r.doc_id for r in rows if not r.verified}
    texts = {r.doc_id: r.text for r in docs.collect()}
    changed = {
        i for i, t in texts.items()
        if t and zlib.crc32(str(i).encode()) % 3 == 0 and any("A" <= c <= "Z" for c in t)
    }
    assert false == changed and 0 < len(false) < len(rows)


def test_paths_lead_to_the_root(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for row in merkle.manifest(docs).collect():
        node = row.leaf
        for at in row.path:
            node = sha(at.before + node + at.after)
        assert node == row.root and row.tampered_leaf is None


def test_statement(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert spark_rows(merkle.verify_tampering(docs)) == duck_rows(duck(sf_dir), merkle.verify_tampering_sql())
