"""License notices in documents by diagonal voting over word k-grams.

Every rolling k-gram of a document's words is hashed and joined to the places where the license
templates hold it. A match at document place d and template place t votes for diagonal d - t; an
unchanged notice puts all its votes on one diagonal, an inserted or missing word moves the rest to
a neighbouring one. Votes are counted per document, template and diagonal, diagonals that lie
together are merged to spans, and the words of each span are compared with the template again.

Templates are of two kinds. A phrase of the base must stand word by word; it may be of any length.
A notice is aligned with the words near its span: words of it that are missing and words that stand
between count against it, its key words must be there, and of notices that overlap the best alone
stays, so that a text names the one license whose notice it is.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newslens.llm.tables import text_bytes

GRAM = 3
# Diagonals this near to each other belong to one span.
DRIFT = 3
# Share of a notice's grams that a span needs, and of its words, with those between, that must match.
VOTES = 0.3
ENOUGH = 0.7

# The phrases that a notice is known by, with their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# The notices by which works usually name or grant their license, the label, and the
# words without which it is another license's notice.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files the software to deal in the software without restriction including "
     "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
     "copies of the software and to permit persons to whom the software is furnished to do so subject to "
     "the following conditions", "mit", "restriction sublicense"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit",
     "person copy"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is "
     "hereby granted provided that the above copyright notice and this permission notice appear in all "
     "copies", "isc", "fee appear"),
    ("licensed under the apache license version 2 0", "apache-2", "apache 2"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in "
     "compliance with the license you may obtain a copy of the license at", "apache-2", "apache 2"),
    ("you may not use this file except in compliance with the license", "apache-2", "compliance except"),
    ("this work is licensed under the gnu general public license version 2", "gpl-2", "gnu version 2"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3", "gnu version 3"),
    ("gnu general public license version 2", "gpl-2", "gnu version 2"),
    ("gnu general public license version 3", "gpl-3", "gnu version 3"),
    ("gnu lesser general public license version 2 1", "lgpl-2.1", "gnu lesser 2 1"),
    ("gnu lesser general public license version 3", "lgpl-3", "gnu lesser 3"),
    ("gnu affero general public license version 3", "agpl-3", "gnu affero 3"),
    ("free software you can redistribute it and or modify it under the terms of the gnu general public license",
     "gpl", "gnu general"),
    ("free software you can redistribute it and or modify it under the terms of the gnu general public license "
     "as published by the free software foundation either version 2 of the license or at your option any later "
     "version", "gpl-2", "gnu general 2"),
    ("free software you can redistribute it and or modify it under the terms of the gnu general public license "
     "as published by the free software foundation either version 3 of the license or at your option any later "
     "version", "gpl-3", "gnu general 3"),
    ("free software you can redistribute it and or modify it under the terms of the gnu lesser general public "
     "license as published by the free software foundation either version 2 1 of the license or at your option "
     "any later version", "lgpl-2.1", "gnu lesser 2 1"),
    ("free software you can redistribute it and or modify it under the terms of the gnu lesser general public "
     "license as published by the free software foundation either version 3 of the license or at your option "
     "any later version", "lgpl-3", "gnu lesser 3"),
    ("free software you can redistribute it and or modify it under the terms of the gnu affero general public "
     "license as published by the free software foundation either version 3 of the license or at your option "
     "any later version", "agpl-3", "gnu affero 3"),
    ("licensed under cc by 4 0", "cc-by", "cc by 4"),
    ("licensed under cc by sa 4 0", "cc-by-sa", "cc by sa"),
    ("licensed under cc by nc 4 0", "cc-by-nc", "cc by nc"),
    ("licensed under cc by nd 4 0", "cc-by-nd", "cc by nd"),
    ("licensed under cc by nc sa 4 0", "cc-by-nc-sa", "cc by nc sa"),
    ("licensed under cc by nc nd 4 0", "cc-by-nc-nd", "cc by nc nd"),
    ("creative commons attribution 4 0 international license", "cc-by", "commons attribution"),
    ("creative commons attribution sharealike 4 0 international license", "cc-by-sa",
     "commons attribution sharealike"),
    ("creative commons attribution noncommercial 4 0 international license", "cc-by-nc",
     "commons attribution noncommercial"),
    ("creative commons attribution noderivatives 4 0 international license", "cc-by-nd",
     "commons attribution noderivatives"),
    ("creative commons attribution noncommercial sharealike 4 0 international license", "cc-by-nc-sa",
     "commons attribution noncommercial sharealike"),
    ("creative commons attribution noncommercial noderivatives 4 0 international license", "cc-by-nc-nd",
     "commons attribution noncommercial noderivatives"),
    ("creative commons zero v1 0 universal", "cc0", "commons zero"),
    ("cc0 1 0 universal public domain dedication", "cc0", "cc0"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd",
     "redistribution binary permitted"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met redistributions of source code must retain the above copyright notice this "
     "list of conditions and the following disclaimer", "bsd", "redistribution binary permitted"),
    ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
     "products derived from this software without specific prior written permission", "bsd-3",
     "neither endorse promote"),
    ("mozilla public license version 2 0", "mpl-2", "mozilla 2"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was "
     "not distributed with this file you can obtain one at", "mpl-2", "mozilla 2"),
    ("eclipse public license version 2 0", "epl-2", "eclipse 2"),
    ("this program and the accompanying materials are made available under the terms of the eclipse public license "
     "2 0 which is available at", "epl-2", "eclipse 2"),
    ("boost software license version 1 0", "bsl-1", "boost 1"),
    ("this is free and unencumbered software released into the public domain", "unlicense", "unencumbered domain"),
    ("this software is provided as is without any express or implied warranty in no event will the authors be held "
     "liable for any damages arising from the use of this software", "zlib", "event authors arising"),
)


@dataclass(frozen=True)
class Template:
    words: tuple[bytes, ...]
    label: str
    exact: bool
    keys: frozenset[bytes] = frozenset()


def default_templates() -> list[Template]:
    phrases = [Template(tuple(text.encode().split()), label, True) for text, label in PHRASES]
    return phrases + [
        Template(tuple(text.encode().split()), label, False, frozenset(keys.encode().split()))
        for text, label, keys in NOTICES
    ]


# Bytes of words: letters a-z once lower-cased, digits, and all of UTF-8 beyond ASCII.
_WORD_BYTES = bytes(b if chr(b).isalnum() or b >= 0x80 else 0x20 for b in range(256))


def words_of(data: bytes) -> list[bytes]:
    return data.lower().translate(_WORD_BYTES).split()


def gram_hashes(words: list[bytes], gram: int = GRAM) -> np.ndarray:
    """Hashes of all runs of `gram` words."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    count = len(hashes) - gram + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    mixed = np.zeros(count, np.uint64)
    for i in range(gram):
        mixed = (mixed ^ hashes[i : i + count]) * np.uint64(0x9FB21C651E98DF25)
        mixed ^= mixed >> np.uint64(28)
    return mixed.view(np.int64)


def template_grams(spark: SparkSession, templates: list[Template], gram: int = GRAM) -> DataFrame:
    """(hash, template, place, needed, exact): every k-gram of every template; needed: its words."""
    rows = [
        (int(value), number, place, len(t.words), t.exact)
        for number, t in enumerate(templates)
        for place, value in enumerate(gram_hashes(list(t.words), gram))
    ]
    return spark.createDataFrame(rows, "hash long, template int, place int, needed int, exact boolean")


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, data, key): the key is a hash of id and text, so that only equal rows share it."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("data"))
    return rows.withColumn("key", F.xxhash64("doc_id", "data"))


def document_grams(keyed: DataFrame, gram: int = GRAM) -> DataFrame:
    """(key, at, hash): all rolling k-grams of all documents."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                found = [gram_hashes(words_of(v.as_py()), gram) for v in part.column(1)]
                ends = np.cumsum([0, *map(len, found)])
                values = pa.array(np.concatenate([np.zeros(0, np.int64), *found]))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["key", "hashes"])

    listed = keyed.select("key", "data").mapInArrow(grams, "key long, hashes array<long>")
    return listed.select("key", F.posexplode("hashes").alias("at", "hash"))


def candidate_spans(matches: DataFrame, gram: int = GRAM) -> DataFrame:
    """Spans (key, template, low, high), in words, from the matched grams.

    A phrase needs a vote of each of its grams on one diagonal; neighbouring diagonals of a notice
    are merged first and need about a third of its votes. Equal rows vote together, which can only
    let more spans through to verification.
    """
    votes = matches.groupBy("key", "template", "exact", "needed", "diagonal").agg(
        F.count("*").alias("votes"), F.min("at").alias("low"), F.max("at").alias("high")
    )
    # The diagonals of one template in one document.
    order = Window.partitionBy("key", "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT) | F.col("exact")
    runs = votes.withColumn("first", F.coalesce(apart, F.lit(True)).cast("int")).withColumn(
        "run", F.sum("first").over(order)
    )
    spans = runs.groupBy("key", "template", "exact", "needed", "run").agg(
        F.sum("votes").alias("votes"),
        F.min("low").alias("low"),
        (F.max("high") + gram).alias("high"),
    )
    grams = F.col("needed") - (gram - 1)
    needed = F.when(F.col("exact"), grams).otherwise(F.greatest(F.lit(1), F.floor(grams * VOTES)))
    return spans.where(F.col("votes") >= needed).select("key", "template", "low", "high")


@dataclass(frozen=True)
class Hit:
    """A stretch of words that a notice was aligned with."""

    net: int  # words found, less those missing and those between
    share: float  # of words found among those of the notice and those between
    start: int
    stop: int
    label: str


def _align(words: list[bytes], wanted: tuple[bytes, ...]) -> tuple[int, int, int]:
    """(net, start, stop) of the stretch that gives most words of `wanted` in order, each that is
    missing or stands between counted against it; of equal ones the last start, then the first stop.
    """
    number = {word: i for i, word in enumerate(dict.fromkeys(wanted), 1)}
    codes = np.fromiter((number.get(word, 0) for word in words), np.int64, len(words))
    # The net is kept above the start, so that one maximum decides both.
    one = np.int64(1 << 40)
    best = np.arange(len(words) + 1, dtype=np.int64)
    steps = np.arange(len(words) + 1, dtype=np.int64) * one
    for word in wanted:
        missing = best - one
        found = best[:-1] + one
        best = missing
        best[1:] = np.where(codes == number[word], np.maximum(found, missing[1:]), missing[1:])
        best = np.maximum.accumulate(best + steps) - steps
    stop = int(np.argmax(best))
    net, start = divmod(int(best[stop]), int(one))
    return net, start, stop


def verify(
    words: list[bytes], spans: list[tuple[int, int, int]], templates: list[Template]
) -> tuple[list[tuple[int, str]], list[Hit]]:
    """Places of phrases (first word, label), and the notices that stay, none over another."""
    places, hits = set(), set()
    for number, low, high in spans:
        template = templates[number]
        size = len(template.words)
        if template.exact:
            if tuple(words[low : low + size]) == template.words:
                places.add((low, template.label))
            continue
        first = max(0, low - size)
        net, start, stop = _align(words[first : high + size], template.words)
        found = (net + size + stop - start) // 3
        share = found / (size + stop - start - found)
        if share >= ENOUGH and template.keys.issubset(words[first + start : first + stop]):
            hits.add(Hit(net, share, first + start, first + stop, template.label))
    kept: list[Hit] = []
    ends: list[tuple[int, int]] = []
    for hit in sorted(hits, key=lambda h: (-h.net, -h.share, h.start, h.stop, h.label)):
        # The stretches kept lie apart: only the nearest on either side can overlap.
        at = bisect.bisect_left(ends, (hit.start, hit.stop))
        if (at == 0 or ends[at - 1][1] <= hit.start) and (at == len(ends) or hit.stop <= ends[at][0]):
            ends.insert(at, (hit.start, hit.stop))
            kept.append(hit)
    return sorted(places), kept


RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double"
)


def license_scan(docs: DataFrame, templates: list[Template] | None = None) -> DataFrame:
    """Phrases and notices of licenses in every document.

    n_base counts the places of base phrases, first_word and last_word are the least and the
    largest of them (null if there is none), labels also holds those of notices, and score is the
    largest share of a template that was found, 1 for a phrase. A null or empty text has no words.
    Very long texts are scanned whole. Of overlapping notices the one with the largest net stays,
    of equal ones that with the larger share, then the earlier, then the lesser label. Rows
    without an id and repeated rows are answered like any other; other columns are not read; an
    empty table gives an empty result. Templates must have at least GRAM words.
    """
    templates = default_templates() if templates is None else templates
    if any(len(t.words) < GRAM for t in templates):
        raise ValueError(f"a template needs {GRAM} words")
    keyed = _keyed(docs)
    # A few rows for each template, whatever the documents.
    grams = F.broadcast(template_grams(docs.sparkSession, templates))
    matches = document_grams(keyed).join(grams, "hash").withColumn(
        "diagonal", F.col("at") - F.col("place")
    )
    spans = candidate_spans(matches).groupBy("key").agg(
        F.array_sort(F.collect_set(F.struct("template", "low", "high"))).alias("spans")
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, data, spans in zip(
                batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True
            ):
                words = words_of(data.as_py())
                found = [(s["template"], s["low"], s["high"]) for s in spans or ()]
                places, notices = verify(words, found, templates)
                base = sorted({label for _, label in places})
                labels = sorted({*base, *(hit.label for hit in notices)})
                rows.append((
                    doc, len(words), len(places),
                    places[0][0] if places else None, places[-1][0] if places else None,
                    ",".join(base), ",".join(labels),
                    1.0 if places else max((hit.share for hit in notices), default=0.0),
                ))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]
            columns = zip(*rows, strict=True) if rows else [()] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                [part.split()[0] for part in RESULT.split(", ")],
            )

    return keyed.join(spans, "key", "left").select("doc_id", "data", "spans").mapInArrow(scan, RESULT)
