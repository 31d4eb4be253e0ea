"""BPE encoding by speculation: propose greedily, verify neighbours, merge only what fails.

A word's tokens are proposed by greedy longest match, which is cheap and mostly right. A proposal
is the exact encoding if, and only if, every two tokens that stand side by side would stay apart
if the word held nothing else. That is decided for all adjacent pairs of a batch at once: two tokens join if
some merge across their border comes before the merges by which its two sides were built
into the tokens. Words with a pair that fails, and only those, are merged step by step, all of them side by side.

Text is cut into words by the tokenizer file's own normalizer and pre-tokenizer. Its words never
span white space, so a stretch between white space has the same ids wherever it stands; a
worker remembers late ones in a store bounded by bytes.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.llm.tables import text_bytes

# Bytes of stretches and ids, with what their objects take, that a worker remembers.
MEMO_BYTES = 96 << 20
_ENTRY = 180  # two objects and their place in a dict
# Texts taken together: so many bytes at least, or a single one.
PART_BYTES = 4 << 20
# Words of more symbols are merged by themselves, with a heap; others all together.
LONG_WORD = 64

# Closes a word: a character that no spelled byte has.
END = "\ue000"

_NEVER = np.int32(np.iinfo(np.int32).max)


class Merges:
    """The merges of a BPE vocabulary, and which tokens may stand side by side."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.suffix = suffix
        self.size = max(vocab.values(), default=-1) + 1
        left = np.full(self.size, -1, np.int32)
        right = np.full(self.size, -1, np.int32)
        rank = np.full(self.size, _NEVER, np.int32)
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for number, (a, b) in enumerate(merges):
            pair, made = (vocab[a], vocab[b]), vocab[a + b]
            if pair not in self.ranks:
                self.ranks[pair] = (number, made)
            if rank[made] == _NEVER:
                left[made], right[made], rank[made] = *pair, number
        keys = np.array([a * self.size + b for a, b in self.ranks], np.int64)
        order = np.argsort(keys)
        found = np.array(list(self.ranks.values()), np.int32).reshape(-1, 2)[order]
        self.keys, self.key_ranks, self.key_made = keys[order], found[:, 0], found[:, 1]
        # A token's border on either side: itself, the part of it there, that part's part, and so
        # on, each with the merge that took it into the next larger one.
        self.right_edge = self._edge(right, rank)
        self.left_edge = self._edge(left, rank)
        reached = self._reachable(left, right, rank)
        self.vocab = {token: number for token, number in vocab.items() if reached[number]}
        self.symbol_ids = {token: number for token, number in vocab.items() if rank[number] == _NEVER}
        # Tokens as the automaton has them: END stands for the suffix.
        self.automaton = ahocorasick.Automaton()
        self.lengths = np.zeros(self.size, np.int64)
        for token, number in self.vocab.items():
            ended = bool(suffix) and token.endswith(suffix)
            plain = token.removesuffix(suffix) + END if ended else token
            self.automaton.add_word(plain, number)
            self.lengths[number] = len(plain)
        self.automaton.make_automaton()
        # The longest token, without its suffix, by its first two symbols.
        self.reach: dict[str, int] = {}
        for token in self.vocab:
            plain = token.removesuffix(suffix) if suffix else token
            self.reach[plain[:2]] = max(len(plain), self.reach.get(plain[:2], 1))

    def _edge(self, part: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        nodes, limits = [np.arange(self.size, dtype=np.int32)], [np.full(self.size, _NEVER, np.int32)]
        while True:
            inner = np.where(nodes[-1] >= 0, part[nodes[-1]], -1)
            if (inner < 0).all():
                return np.stack(nodes), np.stack(limits)
            limits.append(np.where(inner >= 0, rank[nodes[-1]], _NEVER))
            nodes.append(inner)

    def _reachable(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Whether each token is the encoding of its own text: single symbols, and tokens
        of two reachable parts that nothing parts before they merge."""
        made = np.flatnonzero(rank != _NEVER)
        made = made[np.argsort(rank[made])]
        apart = self._stay_apart(left[made], right[made], rank[made])
        reached = np.ones(self.size, bool)
        for token, alone in zip(made.tolist(), apart.tolist(), strict=True):
            reached[token] = alone and reached[left[token]] and reached[right[token]]
        return reached

    def _stay_apart(self, first: np.ndarray, second: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge joins the two tokens of each pair, or none that comes before `until`.

        A merge of rank m joins a node of the first one's right edge and a node of the second one's
        left edge if both are there at its turn. Of equal merges the leftmost comes first: a node
        on the left side is taken by a merge of the same rank, one on the right side is not.
        """
        joined = np.zeros(len(first), bool)
        for nodes, limits in zip(*self.right_edge, strict=True):
            a, a_limit = nodes[first], limits[first]
            if until is not None:
                a_limit = np.minimum(a_limit, until)
            if (a < 0).all():
                break
            for others, other_limits in zip(*self.left_edge, strict=True):
                b, b_limit = others[second], other_limits[second]
                at = np.flatnonzero((a >= 0) & (b >= 0) & ~joined)
                if not len(at):
                    continue
                merge, _ = self._rank_of(a[at].astype(np.int64), b[at])
                joined[at[(merge < a_limit[at]) & (merge <= b_limit[at]) & (merge < _NEVER)]] = True
        return ~joined

    def symbols(self, word: str) -> list[str]:
        return [*word[:-1], word[-1] + self.suffix]

    def _rank_of(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the merge of each pair, or _NEVER, and the token that it makes."""
        if not len(self.keys):
            return np.full(len(first), _NEVER, np.int32), np.full(len(first), -1, np.int32)
        key = first * self.size + second
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[place] == key
        return np.where(known, self.key_ranks[place], _NEVER), np.where(known, self.key_made[place], -1)

    def exact(self, words: list[str]) -> list[list[int]]:
        """Tokens of each word by its merges, one after the other: least rank first, then leftmost."""
        start = [[self.symbol_ids[s] for s in self.symbols(w) if s in self.symbol_ids] for w in words]
        out = [self._one_by_one(ids) if len(ids) > LONG_WORD else ids for ids in start]
        short = [number for number, ids in enumerate(start) if 1 < len(ids) <= LONG_WORD]
        sizes = np.fromiter((len(start[i]) for i in short), np.int64, len(short))
        tokens = np.fromiter((t for i in short for t in start[i]), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(short)), sizes)
        rank = np.full(len(tokens), _NEVER, np.int32)
        made = np.full(len(tokens), -1, np.int32)
        look = np.ones(len(tokens), bool)  # where a pair is new
        while len(tokens):
            pair = np.zeros(len(tokens), bool)
            pair[:-1] = owner[1:] == owner[:-1]
            rank[~pair] = _NEVER
            at = np.flatnonzero(look & pair)
            rank[at], made[at] = self._rank_of(tokens[at], tokens[at + 1])
            firsts = np.flatnonzero(np.diff(owner, prepend=-1))
            least = np.minimum.reduceat(rank, firsts)
            sizes = np.diff(np.append(firsts, len(tokens)))
            going = np.repeat(least < _NEVER, sizes)
            if not going.all():  # words that are done leave
                for number, ids in zip(
                    owner[firsts[least == _NEVER]].tolist(),
                    np.split(tokens[~going], np.cumsum(sizes[least == _NEVER])[:-1]),
                    strict=True,
                ):
                    out[short[number]] = ids.tolist()
                tokens, owner, rank, made = tokens[going], owner[going], rank[going], made[going]
                sizes, least = sizes[least < _NEVER], least[least < _NEVER]
                if not len(tokens):
                    break
            hit = rank == np.repeat(least, sizes)
            # Of overlapping pairs, which are of one symbol, every second one from the left.
            begin = hit.copy()
            begin[1:] &= ~hit[:-1]
            places = np.arange(len(hit))
            hit &= (places - np.maximum.accumulate(np.where(begin, places, 0))) % 2 == 0
            tokens[hit] = made[hit]
            look = hit.copy()
            look[:-1] |= hit[1:]
            look[:-2] |= hit[2:]  # harmless where the pair has not changed
            kept = np.ones(len(hit), bool)
            kept[1:] = ~hit[:-1]
            tokens, owner, rank, made, look = tokens[kept], owner[kept], rank[kept], made[kept], look[kept]
        return out

    def _one_by_one(self, ids: list[int]) -> list[int]:
        """The same for a single long word, with a heap of pairs over a linked list."""
        count = len(ids)
        after = list(range(1, count + 1))
        before = list(range(-1, count - 1))
        ids = list(ids)
        heap = [(*found, i) for i, pair in enumerate(zip(ids, ids[1:])) if (found := self.ranks.get(pair))]
        heapq.heapify(heap)
        while heap:
            rank, made, at = heapq.heappop(heap)
            right = after[at]
            if ids[at] < 0 or right >= count or self.ranks.get((ids[at], ids[right])) != (rank, made):
                continue
            ids[at], ids[right] = made, -1
            after[at] = after[right]
            if after[right] < count:
                before[after[right]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] < count and (found := self.ranks.get((ids[left], ids[after[left]]))):
                    heapq.heappush(heap, (*found, left))
        return [t for t in ids if t >= 0]

    def greedy(self, word: str) -> list[int]:
        """Longest match from the left; a last token must end the word, and only it may."""
        vocab, reach, ids, at, end = self.vocab, self.reach, [], 0, len(word)
        ended = word + self.suffix
        while at < end:
            furthest = at + reach.get(word[at : at + 2], 1)
            if furthest >= end:
                found = vocab.get(ended[at:])
                if found is not None:
                    ids.append(found)
                    break
                furthest = end - 1
            for stop in range(furthest, at, -1):
                found = vocab.get(word[at:stop])
                if found is not None:
                    ids.append(found)
                    at = stop
                    break
            else:
                at += 1  # a symbol that is not in the vocabulary: dropped
        return ids

    def proposals(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, owner): greedy longest match of all words in one pass of an automaton, by word.

        Words that it leaves with a gap, such as a last token that does not end the word, are
        matched again one by one.
        """
        joined = "".join([word + END for word in words])
        found = list(self.automaton.iter_long(joined))
        tokens = np.fromiter((t for _, t in found), np.int64, len(found))
        stops = np.fromiter((at for at, _ in found), np.int64, len(found)) + 1
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        owner = np.searchsorted(ends, stops)
        covered = np.zeros(len(words), np.int64) if self.suffix else np.ones(len(words), np.int64)
        np.add.at(covered, owner, self.lengths[tokens])
        gaps = np.flatnonzero(covered != np.diff(ends, prepend=0))
        if len(gaps):
            again = [self.greedy(words[number]) for number in gaps.tolist()]
            sound = ~np.isin(owner, gaps)
            sizes = np.fromiter(map(len, again), np.int64, len(again))
            tokens = np.concatenate([tokens[sound], np.array([t for ids in again for t in ids], np.int64)])
            owner = np.concatenate([owner[sound], np.repeat(gaps, sizes)])
            order = np.argsort(owner, kind="stable")
            tokens, owner = tokens[order], owner[order]
        return tokens, owner

    def encode(self, words: list[str]) -> tuple[list[bytes], int]:
        """Tokens of each word as little-endian 32-bit integers, and how many words had to be merged."""
        tokens, owner = self.proposals(words)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        first, second = tokens[inside], tokens[inside + 1]
        pairs, which = np.unique(first * self.size + second, return_inverse=True)
        apart = self._stay_apart(pairs // self.size, pairs % self.size)
        failed = np.unique(owner[inside[~apart[which]]]).tolist()
        cuts = (4 * np.searchsorted(owner, np.arange(len(words) + 1))).tolist()
        data = tokens.astype("<u4").tobytes()
        out = [data[low:high] for low, high in zip(cuts, cuts[1:])]
        merged = self.exact([words[number] for number in failed])
        for number, ids in zip(failed, merged, strict=True):
            out[number] = array("I", ids).tobytes()
        return out, len(failed)


class Tokenizer:
    """A tokenizer file whose model is BPE, with a store of stretches between white space."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer as Library

        with open(path, encoding="utf-8") as source:
            shape = json.load(source)
        model = shape["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or odd or shape.get("decoder") or shape.get("post_processor"):
            raise ValueError(f"only plain BPE files are known, not {model['type']} with {odd}")
        library = Library.from_file(path)
        self.normalizer, self.cutter = library.normalizer, library.pre_tokenizer
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        if self.cutter is not None and [w for w, _ in self.cutter.pre_tokenize_str("a  b\n.")] != ["a", "b", "."]:
            raise ValueError("words of this file hold white space")
        self.merges = Merges(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.added = {a["content"]: a["id"] for a in shape["added_tokens"]}
        for token in shape["added_tokens"]:
            if token["normalized"] or token["single_word"] or token["lstrip"] or token["rstrip"] or not token["content"].split() == [token["content"]]:
                raise ValueError(f"added token {token['content']!r} is of a kind that is not known")
        self.added_cut = re.compile("|".join(sorted(map(re.escape, self.added), key=len, reverse=True)) or r"(?!)")
        names = {number: token for token, number in model["vocab"].items()} | {i: t for t, i in self.added.items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self.letters = self._single_words()
        marks = "".join(c for c in ".,;:!?" if self._cut("a" + c) == ["a", c])
        self.plain = re.compile(
            f"([{''.join(map(chr, self.letters))}]+)([{marks}]?)" if self.letters and marks else r"(?!)"
        )
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.held = 0
        self.words = self.failed = 0

    def _single_words(self) -> dict[int, str]:
        """How letters below U+0250 are spelled, if any of them in a row make a single word.

        None of them combines with one before it, so each is normalized by itself.
        """
        found = {c: self._cut(chr(c)) for c in range(0x250) if chr(c).isalpha()}
        letters = {c: parts[0] for c, parts in found.items() if len(parts) == 1 and isinstance(parts[0], str)}
        every = "".join(map(chr, letters))
        return letters if self._cut(every) == ["".join(letters.values())] else {}

    def _cut(self, stretch: str) -> list[str | int]:
        """Words of a stretch, as the model sees them, and ids of added tokens in it."""
        out: list[str | int] = []
        at = 0
        for hit in [*self.added_cut.finditer(stretch), None]:
            piece = stretch[at : hit.start() if hit else len(stretch)]
            if piece:
                if self.normalizer is not None:
                    piece = self.normalizer.normalize_str(piece)
                words = [piece] if self.cutter is None else [w for w, _ in self.cutter.pre_tokenize_str(piece)]
                out += [word for word in words if word]
            if hit:
                out.append(self.added[hit.group()])
                at = hit.end()
        return out

    def _cut_all(self, stretches: list[str]) -> list[list[str | int]]:
        """`_cut` of many stretches, plain ones with one call of the library."""
        out: list[list[str | int] | None] = [None] * len(stretches)
        plain = [i for i, s in enumerate(stretches) if not self.added_cut.search(s)]
        joined = " ".join([stretches[i] for i in plain])
        if self.normalizer is not None:
            joined = self.normalizer.normalize_str(joined)
        forms = joined.split(" ")
        # White space of its own inside a stretch would be counted here.
        if self.cutter is not None and len(forms) == len(plain) and all(forms):
            stops = np.cumsum([len(form) + 1 for form in forms])
            words = self.cutter.pre_tokenize_str(joined)
            places = np.fromiter((at for _, (at, _) in words), np.int64, len(words))
            cuts = np.searchsorted(places, stops).tolist()
            low = 0
            for i, high in zip(plain, cuts, strict=True):
                out[i] = [word for word, _ in words[low:high]]
                low = high
        return [self._cut(s) if parts is None else parts for s, parts in zip(stretches, out, strict=True)]

    def _learn(self, stretches: list[bytes]) -> None:
        texts = [stretch.decode() for stretch in stretches]
        cut: list[list[str | int]] = [[]] * len(texts)
        whole, odd = [], []
        for number, text in enumerate(texts):
            plain = self.plain.fullmatch(text)
            if plain:
                word, mark = plain.groups()
                cut[number] = [word.translate(self.letters), mark] if mark else [word.translate(self.letters)]
            elif text.split() == [text]:
                whole.append(number)
            else:
                odd.append(number)
        for number, parts in zip(whole, self._cut_all([texts[i] for i in whole]), strict=True):
            cut[number] = parts
        for number in odd:
            cut[number] = self._cut(texts[number])
        words = list({w: None for parts in cut for w in parts if isinstance(w, str)})
        tokens, failed = self.merges.encode(words)
        self.words += len(words)
        self.failed += failed
        known: dict[str | int, bytes] = dict(zip(words, tokens, strict=True))
        known |= {number: array("I", [number]).tobytes() for number in self.added.values()}
        for stretch, parts in zip(stretches, cut, strict=True):
            found = b"".join([known[part] for part in parts])
            self.recent[stretch] = found
            self.held += len(stretch) + len(found) + _ENTRY

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if 2 * self.held > MEMO_BYTES:
            self.older, self.recent, self.held = self.recent, {}, 0
        split = [text.split() for text in texts]
        recent, older = self.recent, self.older
        missing = []
        for stretch in set().union(*split):
            if stretch not in recent:
                found = older.get(stretch)
                if found is None:
                    missing.append(stretch)
                else:
                    recent[stretch] = found
                    self.held += len(stretch) + len(found) + _ENTRY
        if missing:
            self._learn(missing)
        get = recent.__getitem__
        return [b"".join(map(get, stretches)) for stretches in split]

    def decode(self, ids: np.ndarray) -> str:
        """Tokens' names, one blank apart, as a file without a decoder has it; unknown ids are left out."""
        names = self.names
        return " ".join([names[i] for i in ids.tolist() if i < len(names) and names[i]])


_tokenizers: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """The worker's tokenizer of a file; a worker holds one at a time."""
    if path not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[path] = Tokenizer(path)
    return _tokenizers[path]


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum([len(value.as_buffer()) for value in batch.column(1)])
    low = 0
    while low < batch.num_rows:
        done = sizes[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(sizes, done + PART_BYTES)))
        yield batch.slice(low, high - low)
        low = high


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every document (doc_id, text), by the tokenizer file at `path`.

    `ids` are little-endian unsigned 32-bit integers, as the tokenizers library gives them without
    special tokens of its own; `decoded` is the text that its decoder makes of them, special tokens
    that stood in the text included. `path` must be readable by every executor.

    A null or empty text has no ids and decodes to an empty text. Whole texts are encoded, a very long one by itself.
    Equal merges go leftmost first. Rows without an id and repeated rows are answered as often as
    they occur; other columns are not read; an empty table gives no row. Nothing is shuffled.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizer(path)
        for batch in batches:
            for part in _parts(batch):
                found = model.encode([value.as_py() for value in part.column(1)])
                decoded = [model.decode(np.frombuffer(ids, "<u4")) for ids in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array([len(ids) // 4 for ids in found], pa.int64()),
                        pa.array(found, pa.binary()), pa.array(decoded, pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("data"))
    return rows.mapInArrow(work, "doc_id long, n_tokens long, ids binary, decoded string")


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    return round_trip(docs, path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
