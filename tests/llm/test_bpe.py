from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from newslens.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = (
    "abcdefghijklmnopqrstuvwxyz", "aab", "nnan", "éèüñßİıſKÅ", "中文字漢", "0123456789", "'stmdlre", "!?.,-_/\\|<>",
    "🙂👍🏽‍", "́̈", "  　\t\x85\x1c \n", "ΣσςЖж", "A Z\x00",
)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def model():
    return bpe.Tokenizer(PATH)


def odd_texts(count: int) -> list[str]:
    rng = random.Random(3)
    names = [t.removesuffix("</w>") for t in Tokenizer.from_file(PATH).get_vocab() if t.isascii()]
    out = ["", " ", "\n\t", "<|endoftext|>", "x<|startoftext|>Y <|STARTOFTEXT|> <|endoftext|", "a" * 500, "ab" * 300]
    for _ in range(count):
        out.append("".join(rng.choice(rng.choice(PARTS)) for _ in range(rng.randrange(24))))
        out.append("".join(rng.choice(names) for _ in range(rng.randrange(1, 5))))
        out.append(rng.choice(PARTS[0]) + rng.choice(["<|endoftext|>", "<|startoftext|>", " <|"]) + rng.choice(PARTS[0]))
    return out


def test_ids_and_text_equal_the_library(model, library):
    texts = odd_texts(15_000)
    found = model.encode([t.encode() for t in texts])
    for text, ids, truth in zip(texts, found, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = np.frombuffer(ids, "<u4")
        assert ids.tolist() == truth.ids, text
        assert model.decode(ids) == library.decode(truth.ids, skip_special_tokens=False)
    assert 0 < model.failed < model.words


def test_speculation_is_used(model):
    """Words whose proposal stands are never merged, and the check alone finds the others."""
    words = ["the", "house", "houses", "unbelievable", "xqzvk"]
    tokens, failed = model.merges.encode(words)
    wrong = [w for w in words if model.merges.greedy(w) != model.merges.exact([w])[0]]
    assert failed == len(wrong) < len(words)
    assert [np.frombuffer(t, "<u4").tolist() for t in tokens] == model.merges.exact(words)
    flat, owner = model.merges.proposals(words)
    assert [flat[owner == i].tolist() for i in range(len(words))] == [model.merges.greedy(w) for w in words]


def test_pairs_of_tokens_stay_apart_as_merging_says():
    """A vocabulary of two letters: every pair of tokens against merging their text."""
    rng = random.Random(1)
    for _ in range(30):
        vocab = {"a": 0, "b": 1}
        merges = []
        while len(merges) < 8:
            x, y = rng.choice(list(vocab)), rng.choice(list(vocab))
            if x + y not in vocab:
                vocab[x + y] = len(vocab)
                merges.append((x, y))
        model = bpe.Merges(vocab, merges)
        names = {number: token for token, number in vocab.items()}
        tokens = [t for t in names if model.exact([names[t]])[0] == [t]]
        assert set(model.vocab.values()) == set(tokens)
        first, second = (np.array(x) for x in zip(*[(a, b) for a in tokens for b in tokens], strict=True))
        truth = [model.exact([names[a] + names[b]])[0] == [a, b] for a, b in zip(first, second, strict=True)]
        assert model._stay_apart(first, second).tolist() == truth


def test_long_words_merge_as_short_ones(model, monkeypatch):
    words = ["".join(random.Random(i).choice("abcenrst") for _ in range(40)) for i in range(200)] + ["a" * 50, "nan" * 12]
    together = model.merges.exact(words)
    monkeypatch.setattr(bpe, "LONG_WORD", 1)
    assert model.merges.exact(words) == together


def test_store_is_bounded(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_BYTES", 20_000)
    model = bpe.Tokenizer(PATH)
    texts = odd_texts(300)
    for low in range(0, len(texts), 20):
        part = texts[low : low + 20]
        truth = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u4").tolist() for x in model.encode([t.encode() for t in part])] == truth
    assert len(model.older) + len(model.recent) < 400


def truth_row(library, doc_id, text) -> tuple:
    ids = library.encode(text or "", add_special_tokens=False).ids
    packed = np.array(ids, "<u4").tobytes()
    decoded = library.decode(ids, skip_special_tokens=False)
    return (doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_query_on_odd_rows(spark, library):
    rows = [(i, t, 1) for i, t in enumerate(odd_texts(60))]
    rows += [(None, "no id", 2), (None, None, 2), (3, "again", 3), (3, "again", 3), (900, "long word. " * 20_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    found = sorted(map(tuple, bpe.round_trip_digests(docs.repartition(4), PATH).collect()), key=str)
    assert found == sorted((truth_row(library, r[0], r[1]) for r in rows), key=str)


def test_query_on_the_table(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = sorted(map(tuple, bpe.round_trip_digests(docs, PATH).collect()))
    assert found == sorted(truth_row(library, r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())


def test_empty_table(spark):
    assert bpe.round_trip_digests(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError):
        bpe.Tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
