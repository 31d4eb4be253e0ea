"""Language of documents by a bidirectional gated recurrent network over bytes.

The network reads a word byte by byte in both directions and labels every byte with a language;
a document's probabilities are the mean of those of all its bytes. Words are cut at white space,
longer ones every `PIECE` bytes, and the state starts anew with each, so a word has the same
labels wherever it stands: a worker computes each distinct word once and remembers it. Training is
backpropagation through time in numpy, on the words of a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.llm.tables import held_out, text_bytes

UNKNOWN = "und"
HIDDEN = 12
PIECE = 24
# The sample for training: documents of each language, and the characters of each.
SAMPLE = 300
SAMPLE_CHARS = 20_000
STEPS = 500
BATCH = 1024
RATE = 0.02
# What a worker remembers within a task: distinct words, and their bytes in all.
MEMO_WORDS = 120_000
MEMO_BYTES = 8_000_000


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _matrix(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the pieces (longest first) read forwards and backwards, their lengths, their order."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    order = np.argsort(-lengths, kind="stable")
    data = np.frombuffer(b"".join(pieces), np.uint8)
    starts = np.cumsum(lengths) - lengths
    lengths, starts = lengths[order], starts[order]
    steps = np.arange(int(lengths[0]) if len(lengths) else 0)
    inside = steps < lengths[:, None]
    ahead = np.where(inside, starts[:, None] + steps, 0)
    back = np.where(inside, starts[:, None] + lengths[:, None] - 1 - steps, 0)
    return data[ahead], data[back], lengths, order


def _forward(codes: np.ndarray, active: np.ndarray, table: np.ndarray, recur: np.ndarray) -> list:
    """States after each step, and what backpropagation needs; only pieces not yet ended step on."""
    width = recur.shape[0]
    state = np.zeros((len(codes), width), np.float32)
    trace = []
    for step, count in enumerate(active):
        before = state[:count]
        inputs = table[codes[:count, step]]
        gates = _sigmoid(inputs[:, : 2 * width] + before @ recur[:, : 2 * width])
        update, reset = gates[:, :width], gates[:, width:]
        new = np.tanh(inputs[:, 2 * width :] + (reset * before) @ recur[:, 2 * width :])
        state = before + update * (new - before)
        trace.append((before, update, reset, new, state))
    return trace


def _backward(codes, trace, recur, upstream, grad_table, grad_recur) -> None:
    """Adds gradients of one direction; `upstream` is the loss's gradient by state, per step."""
    width = recur.shape[0]
    carried = np.zeros((0, width), np.float32)
    for step in range(len(trace) - 1, -1, -1):
        before, update, reset, new, _ = trace[step]
        grad = upstream[step].copy()
        grad[: len(carried)] += carried
        to_new = grad * update * (1 - new * new)
        to_update = grad * (new - before) * update * (1 - update)
        through = to_new @ recur[:, 2 * width :].T
        to_reset = through * before * reset * (1 - reset)
        inputs = np.concatenate([to_update, to_reset, to_new], axis=1)
        np.add.at(grad_table, codes[: len(before), step], inputs)
        grad_recur[:, : 2 * width] += before.T @ inputs[:, : 2 * width]
        grad_recur[:, 2 * width :] += (reset * before).T @ to_new
        carried = grad * (1 - update) + through * reset
        carried += inputs[:, : 2 * width] @ recur[:, : 2 * width].T


@dataclass
class LanguageModel:
    languages: list[str]
    weights: dict[str, np.ndarray]
    memo: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"languages": self.languages, "weights": self.weights, "memo": {}}

    def _run(self, pieces: list[bytes]) -> tuple:
        ahead, back, lengths, order = _matrix(pieces)
        active = [int((lengths > step).sum()) for step in range(ahead.shape[1])]
        w = self.weights
        forward = _forward(ahead, active, w["table_f"], w["recur_f"])
        backward = _forward(back, active, w["table_b"], w["recur_b"])
        # Every byte once: by piece, then by place.
        rows = np.repeat(np.arange(len(lengths)), lengths)
        places = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        first = np.cumsum([0, *active])
        ahead_at = first[places] + rows
        back_at = first[lengths[rows] - 1 - places] + rows
        width = w["recur_f"].shape[0]
        states = np.empty((len(rows), 2 * width), np.float32)
        if len(rows):
            states[:, :width] = np.concatenate([t[-1] for t in forward])[ahead_at]
            states[:, width:] = np.concatenate([t[-1] for t in backward])[back_at]
        logits = states @ w["out"] + w["bias"]
        logits -= logits.max(axis=1, keepdims=True)
        found = np.exp(logits)
        found /= found.sum(axis=1, keepdims=True)
        return found, states, rows, order, (ahead, back, active, forward, backward, ahead_at, back_at)

    def label(self, word: bytes) -> np.ndarray:
        """Language probabilities of every byte of a word."""
        return np.concatenate([self._run([p])[0] for p in _pieces(word)])

    def _word_sums(self, words: list[bytes]) -> np.ndarray:
        """Probabilities added up over the bytes of each word, and the bytes in the last column."""
        out = np.zeros((len(words), len(self.languages) + 1), np.float32)
        pieces, owner = [], []
        for number, word in enumerate(words):
            for piece in _pieces(word):
                pieces.append(piece)
                owner.append(number)
        for low in range(0, len(pieces), 8192):
            part = pieces[low : low + 8192]
            found, _, rows, order, _ = self._run(part)
            sums = np.add.reduceat(found, np.flatnonzero(np.diff(rows, prepend=-1)), axis=0)
            np.add.at(out, (np.array(owner[low : low + 8192])[order], slice(0, -1)), sums)
        out[:, -1] = [len(word) for word in words]
        return out

    def predict(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities of each text; zeros for a text without words."""
        memo = self.memo
        if "known" not in memo:
            memo |= {"known": {}, "bytes": 0, "sums": np.zeros((0, len(self.languages) + 1), np.float32)}
        out = np.zeros((len(texts), len(self.languages)))
        for low in range(0, len(texts), 512):
            split = [text.lower().split() for text in texts[low : low + 512]]
            distinct = set().union(*split)
            known = memo["known"]
            unknown = [word for word in distinct if word not in known]
            if len(known) + len(unknown) > MEMO_WORDS or memo["bytes"] > MEMO_BYTES:
                known.clear()
                memo |= {"bytes": 0, "sums": np.zeros((0, len(self.languages) + 1), np.float32)}
                unknown = list(distinct)
            if unknown:
                known |= zip(unknown, range(len(known), len(known) + len(unknown)), strict=True)
                memo["bytes"] += sum(map(len, unknown))
                memo["sums"] = np.concatenate([memo["sums"], self._word_sums(unknown)])
            sums = memo["sums"]
            for number, words in enumerate(split, low):
                if words:
                    at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                    total = sums[at].sum(axis=0, dtype=np.float64)
                    out[number] = total[:-1] / total[-1]
        return out


def _pieces(word: bytes) -> list[bytes]:
    if len(word) <= PIECE:
        return [word]
    return [word[i : i + PIECE] for i in range(0, len(word), PIECE)]


def _start(languages: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    weights = {}
    for way in "fb":
        weights[f"table_{way}"] = normal(256, 3 * HIDDEN, scale=0.3)
        weights[f"recur_{way}"] = normal(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5)
    return weights | {"out": normal(2 * HIDDEN, languages, scale=0.3), "bias": np.zeros(languages, np.float32)}


def gradients(model: LanguageModel, pieces: list[bytes], labels: np.ndarray) -> tuple[float, dict]:
    """Mean loss over all bytes and its gradient by every weight."""
    found, states, rows, order, (ahead, back, active, forward, backward, ahead_at, back_at) = model._run(pieces)
    truth = labels[order][rows]
    count = len(rows)
    loss = -float(np.log(found[np.arange(count), truth] + 1e-12).mean())
    w = model.weights
    delta = found.copy()
    delta[np.arange(count), truth] -= 1
    delta /= count
    grads = {name: np.zeros_like(value) for name, value in w.items()}
    grads["out"] += states.T @ delta
    grads["bias"] += delta.sum(axis=0)
    to_states = delta @ w["out"].T
    width = HIDDEN
    cuts = np.cumsum(active)[:-1]
    for way, codes, trace, at, part in (
        ("f", ahead, forward, ahead_at, to_states[:, :width]),
        ("b", back, backward, back_at, to_states[:, width:]),
    ):
        by_step = np.empty((count, width), np.float32)
        by_step[at] = part
        _backward(codes, trace, w[f"recur_{way}"], np.split(by_step, cuts), grads[f"table_{way}"], grads[f"recur_{way}"])
    return loss, grads


def fit(samples: list[tuple[str, bytes]], steps: int = STEPS, seed: int = 7) -> LanguageModel:
    """A model of (language, text) samples; every language weighs the same."""
    languages = sorted({language for language, _ in samples})
    rng = np.random.default_rng(seed)
    model = LanguageModel(languages, _start(len(languages), rng))
    pools = []
    for language in languages:
        pieces = [p for known, text in samples if known == language for w in text.lower().split() for p in _pieces(w)]
        if pieces:
            pools.append((languages.index(language), pieces))
    if len(languages) < 2 or not pools:
        return model
    share = max(1, BATCH // len(pools))
    first = {name: np.zeros_like(value) for name, value in model.weights.items()}
    second = {name: np.zeros_like(value) for name, value in model.weights.items()}
    for step in range(1, steps + 1):
        batch: list[bytes] = []
        labels: list[int] = []
        for label, pieces in pools:
            batch += [pieces[i] for i in rng.integers(0, len(pieces), share).tolist()]
            labels += [label] * share
        _, grads = gradients(model, batch, np.array(labels))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for name, grad in grads.items():  # Adam
            first[name] += 0.1 * (grad - first[name])
            second[name] += 0.01 * (grad * grad - second[name])
            size = np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6
            model.weights[name] -= rate * first[name] / (1 - 0.9**step) / size
    return model


def train(docs: DataFrame, folds: int = 4, fold: int = 2) -> LanguageModel:
    """A model of the documents with a language, outside the held-out fold.

    About SAMPLE documents of each language, chosen by a hash of their ids, none longer than
    SAMPLE_CHARS, reach the driver. Rows without an id, a text or a language teach nothing.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang")).where(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull()
        & ~held_out("doc_id", folds, fold) & (F.length("text") <= SAMPLE_CHARS)
    )
    counts = {row.lang: row["count"] for row in known.groupBy("lang").count().collect()}
    if not counts:
        return LanguageModel([], {})
    shares = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, SAMPLE / n))])
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 31)) / float(1 << 31)
    rows = (
        known.where(drawn < shares[F.col("lang")])
        .select("doc_id", "lang", text_bytes().alias("data"))
        .collect()
    )
    rows.sort(key=lambda row: (row.doc_id, row.data))
    return fit([(row.lang, bytes(row.data)) for row in rows])


def predict(
    docs: DataFrame, model: LanguageModel, folds: int = 4, fold: int = 2, keep: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, and the columns `keep` as they are."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = np.array(batch.column(3).to_pylist(), bool)
            texts = [v.as_py() if ok else b"" for v, ok in zip(batch.column(2), letters, strict=True)]
            if model.languages:
                found = model.predict(texts)
                best = found.argmax(axis=1)
                names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)]
                scores = np.where(letters, np.clip(found.max(axis=1), 0, 1), 0.0)
            else:
                names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            kept = [batch.column(4 + i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores), *kept],
                ["doc_id", "held_out", "lang_pred", "score", *keep],
            )
        model.memo.clear()

    rows = docs.select(
        F.col("doc_id").cast("long"), held_out("doc_id", folds, fold).alias("held"),
        text_bytes().alias("data"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"),
        *keep,
    )
    kinds = "".join(f", {name} {docs.schema[name].dataType.simpleString()}" for name in keep)
    return rows.mapInArrow(label, f"doc_id long, held_out boolean, lang_pred string, score double{kinds}")


def identify(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every document's language by a model of the labelled ones outside the held-out fold.

    A text that is null or has no letter is `und` with score 0; so is every text if no language can
    be learned. With a single language to learn, every text with a letter has it, with score 1. Rows
    without an id are predicted and never held out; repeated rows are answered as
    often as they occur; other columns are not read, but those named in `keep` are passed on; an empty table gives an empty result.
    """
    return predict(docs, train(docs), keep=keep)
