"""License notices against a plain scan."""

from __future__ import annotations

import random
import re

import pytest

from newslens.llm.license_scan import (
    DRIFT,
    ENOUGH,
    GRAM,
    NOTICES,
    PHRASES,
    VOTES,
    default_templates,
    license_scan,
    verify,
)
from newslens.llm.tables import table

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(doc, text):
    words = WORD.findall((text or "").translate(UPPER))
    places, labels = [], set()
    for phrase, label in PHRASES:
        wanted = phrase.split()
        for i in range(len(words) - len(wanted) + 1):
            if words[i : i + len(wanted)] == wanted:
                places.append(i)
                labels.add(label)
    return (doc, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def base(rows):
    return sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows), key=repr)


ODD = [
    (1, "Under the MIT License. under the mit license"), (2, None), (3, ""), (4, "CC BY-NC 4.0 cc by nc cc-by-nc"),
    (5, "under the mit license"), (6, "under theé mit license"), (7, "w " * 40000 + "Apache License, Version 2.0"),
    (8, "Licensed under the very Apache License, in its Version 2.0."),
    (9, "This work is licensed under GNU General Public License version 3"), (10, "mit license the under"),
    (None, "cc by nc"), (1, "Under the MIT License. under the mit license"), (11, "cc cc by by nc"), (12, "under the K mit license"),
    (13, "apache license version 2 " * 500), (14, "the gnu general public"), (15, "x under the mit license y cc by nc"),
]


def test_odd_rows(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "'k' AS key", "1 AS template")
    got = license_scan(df).collect()
    assert base(got) == sorted((plain(*row) for row in ODD), key=repr)
    by_id = {r.doc_id: r for r in got}
    assert by_id[8].base_labels == "" and by_id[8].labels == "apache-2" and by_id[8].score >= 0.7
    assert by_id[9].labels == "gpl-3" and by_id[14].labels == "" and by_id[14].score == 0
    assert by_id[4].labels == "cc-by-nc" and by_id[4].n_base == 3
    assert license_scan(df.limit(0)).count() == 0


def test_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = license_scan(docs).collect()
    assert base(got) == sorted((plain(*row) for row in rows), key=repr)
    assert any(r.n_base for r in got) and any(r.labels == "gpl-3" for r in got)


# The one label that each text must give.
OWN = [
    ("Creative Commons Attribution 4.0 International License", "cc-by"),
    ("Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
    ("Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc"),
    ("a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "cc-by-nc-sa"),
    ("GNU General Public License version 2", "gpl-2"),
    ("GNU Lesser General Public License, version 2.1", "lgpl-2.1"),
    ("GNU Affero General Public License version 3", "agpl-3"),
    ("Eclipse Public License version 2.0", "epl-2"),
    ("Mozilla Public License, version 2.0", "mpl-2"),
    ("some public license version 2 0", ""),
    ("creative commons", ""),
]


def plain_votes(words, wanted):
    """Whether enough grams match on diagonals that lie together."""
    diagonals = sorted(
        i - j
        for i in range(len(words) - GRAM + 1)
        for j in range(len(wanted) - GRAM + 1)
        if words[i : i + GRAM] == wanted[j : j + GRAM]
    )
    groups = [[]]
    for diagonal in diagonals:
        if groups[-1] and diagonal - groups[-1][-1] > DRIFT:
            groups.append([])
        groups[-1].append(diagonal)
    return max(map(len, groups)) >= max(1, int((len(wanted) - GRAM + 1) * VOTES))


def plain_hits(words):
    """All notices aligned with all words by the plain recurrence, the best taken in turn."""
    hits = []
    for text, label, keys in NOTICES:
        wanted = text.split()
        if not plain_votes(words, wanted):
            continue
        row = [(0, j) for j in range(len(words) + 1)]
        for word in wanted:
            new = [(row[0][0] - 1, row[0][1])]
            for j, got in enumerate(words, 1):
                choices = [(row[j][0] - 1, row[j][1]), (new[-1][0] - 1, new[-1][1])]
                if got == word:
                    choices.append((row[j - 1][0] + 1, row[j - 1][1]))
                new.append(max(choices))
            row = new
        stop = max(range(len(row)), key=lambda j: (row[j], -j))
        net, start = row[stop]
        found = (net + len(wanted) + stop - start) // 3
        share = found / (len(wanted) + stop - start - found)
        if share >= ENOUGH and set(keys.split()) <= set(words[start:stop]):
            hits.append((-net, -share, start, stop, label))
    kept = []
    for hit in sorted(set(hits)):
        if all(hit[3] <= other[2] or other[3] <= hit[2] for other in kept):
            kept.append(hit)
    return kept


def test_each_license_gives_its_own_label_alone(spark):
    texts = [("w " * i + text + " and so on", label) for i, (text, label) in enumerate(OWN)]
    texts += [(text, label) for text, label, _ in NOTICES]
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in license_scan(df).collect()}
    for i, (text, label) in enumerate(texts):
        # A phrase of the base keeps its label, also within the notice of a license with a longer name.
        base = set(plain(i, text)[5].split(",")) - {""}
        assert got[i] == ",".join(sorted(base | {label} - {""})), text


def test_notices_against_plain_alignment(spark):
    rng = random.Random(5)
    rows = []
    for i in range(120):
        words = rng.choice(NOTICES)[0].split()
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(words))
            words[at : at + rng.randrange(2)] = rng.choices(["w", "x", "2", "3", "license", "sharealike"], k=rng.randrange(2))
        rows.append((i, " ".join(["a"] * rng.randrange(9) + words + ["z"] * rng.randrange(9))))
    got = {r.doc_id: r for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        hits = plain_hits(text.split())
        base = {label for phrase, label in PHRASES if f" {phrase} " in f" {text} "}
        assert got[i].labels == ",".join(sorted(base | {hit[4] for hit in hits})), text
        assert got[i].score == pytest.approx(1.0 if base else max((-hit[1] for hit in hits), default=0.0))


def test_overlapping_notices_leave_the_best():
    templates = default_templates()
    words = "creative commons attribution noncommercial 4 0 international license".encode().split()
    spans = [(n, 0, len(words)) for n, t in enumerate(templates) if not t.exact]
    places, hits = verify(words, spans, templates)
    assert not places and [(h.label, h.share, h.start, h.stop) for h in hits] == [("cc-by-nc", 1.0, 0, 8)]
    twice = verify(words + [b"x"] * 50 + words, [*spans, *[(n, 58, 66) for n, *_ in spans]], templates)[1]
    assert {h.label for h in twice} == {"cc-by-nc"} and len(twice) == 2
