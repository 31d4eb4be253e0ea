"""SimHash near-duplicates against brute force."""

from __future__ import annotations

import random
import re

import xxhash

from newslens.llm.simhash import near_duplicates, simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else (
        [" ".join(words)] if words else []
    )
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    fps = {}
    for doc, text in rows:
        if doc is not None:
            fps.setdefault(plain_fingerprint(text), []).append(doc)
    label = {fp: min(docs) for fp, docs in fps.items()}
    changed = True
    while changed:
        changed = False
        for a in label:
            for b in label:
                if (a ^ b).bit_count() <= 4 and label[b] < label[a]:
                    label[a] = label[b]
                    changed = True
    return sorted(
        ((doc, f"{plain_fingerprint(t):016x}", label.get(plain_fingerprint(t))) for doc, t in rows),
        key=repr,
    )


def check(spark, rows, extra=""):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:
        df = df.selectExpr("*", extra)
    got = sorted(map(tuple, near_duplicates(df).collect()), key=repr)
    assert got == plain_components(rows)
    return got


def test_against_brute_force_with_hard_cases(spark):
    rng = random.Random(5)
    base = [rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(400)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 9)}"
        rows.append((i + 10, " ".join(words)))
    rows += [(i + 100, " ".join(rng.choices("klmnop qrst".split() + ["zz", "y"], k=rng.randint(1, 40)))) for i in range(60)]
    rows += [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "été\x85é a b"), (7, "long " * 20000)]
    rows += [(10, rows[0][1]), (10, rows[0][1]), (None, rows[5][1]), (None, "nobody else"), (None, None)]
    got = check(spark, rows, "'other' AS component_id")
    sizes = {}
    for _, _, c in got:
        sizes[c] = sizes.get(c, 0) + 1
    assert max(sizes.values()) > 20


def test_chain_of_single_bits_is_one_component(spark):
    from newslens.llm.simhash import _index_links

    fps = [0, 0b1111, 0b11111111, 1 << 42 | 0b11111111, 3 << 60 | 1 << 42 | 0b11111111, 0xFFFF << 30]
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i, 1) for i, f in enumerate(fps)], "fp long, component long, size int")
    links = {frozenset(r) for r in _index_links(df, 4).collect()}
    near = {
        frozenset((i, j))
        for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4
    }
    assert links == near


def test_exploded_keys_are_never_broadcast(spark, tmp_path):
    from newslens.llm.simhash import _index_links

    path = str(tmp_path / "sized")
    spark.range(200).selectExpr("xxhash64(id) AS fp", "id AS component", "1L AS size").write.parquet(path)
    sized = spark.read.parquet(path)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") not in ("-1", "0")
    plan = _index_links(sized, 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "Broadcast" not in plan


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_fingerprint_of_bytes():
    assert simhash(b"") == 0
    assert simhash(b"A b\x0bC") == xxhash.xxh64_intdigest(b"a b c", 42)
