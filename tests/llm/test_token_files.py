"""Simple-8b round trips, and token files against the tokenizer itself."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from newslens.llm import simple8b
from newslens.llm.token_files import token_bytes, token_files
from newslens.llm.tables import table

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 64).flatmap(lambda b: st.integers(0, (1 << b) - 1 if b else 0)), max_size=300))
def test_round_trip(values):
    data = np.array(values, np.uint64)
    words, offsets = simple8b.encode(data)
    assert simple8b.decode(words, offsets, len(data)).tolist() == values


@pytest.mark.parametrize("count", [0, 1, 1023, 1024, 1025, 5000])
@pytest.mark.parametrize("top", [1, 2, 300, 49408, 1 << 59, (1 << 64) - 1])
def test_block_edges(count, top):
    data = np.random.default_rng(count).integers(0, top, count, np.uint64, endpoint=True)
    words, offsets = simple8b.encode(data)
    assert len(offsets) == -(-count // simple8b.BLOCK)
    assert (simple8b.decode(words, offsets, count) == data).all()
    for block, start in enumerate(offsets):  # each block can be decoded alone
        stop = offsets[block + 1] if block + 1 < len(offsets) else len(words)
        part = data[block * 1024 : (block + 1) * 1024]
        alone = simple8b.decode(words[start:stop], np.zeros(1, np.int64), len(part))
        assert (alone == part).all()


def test_small_values_share_words():
    words, _ = simple8b.encode(np.ones(1024, np.uint64))
    assert len(words) == -(-1024 // 60)


def plain(rows):
    tokenizer = Tokenizer.from_file(PATH)
    at, out = 0, []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


ODD = [
    None, "", " \n\t ", "It's 1,234!!  Don’t\x85x y\x1cz　w", "́mark é ΑΣ Σ İK",
    "<|endoftext|> a<|startoftext|>b", "日本語 テスト", "🙂🙂 é" * 50, "word " * 50000,
]


def test_words_alone_give_the_ids_of_the_text():
    tokenizer = Tokenizer.from_file(PATH)
    texts = [t or "" for t in ODD]
    got = token_bytes([t.encode() for t in texts], PATH)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [
        tokenizer.encode(t, add_special_tokens=False).ids for t in texts
    ]


def test_files_against_the_tokenizer(spark, monkeypatch):
    rows = [(i * 7 - 3, t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS start", "'f' AS file")
    assert sorted(map(tuple, token_files(df.repartition(3), PATH).collect())) == sorted(plain(rows))
    twice = spark.createDataFrame([(5, "b c"), (5, "b c"), (None, "a")], "doc_id long, text string")
    got = sorted(map(tuple, token_files(twice, PATH).collect()), key=lambda r: r[1])
    assert got == plain([(None, "a"), (5, "b c"), (5, "b c")])
    assert token_files(df.limit(0), PATH).count() == 0


def test_given_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    assert sorted(map(tuple, token_files(docs, PATH).collect())) == plain(rows)
