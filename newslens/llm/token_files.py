"""Token ids in binary files: tokenized documents in id order, Simple-8b coded.

A file holds whole documents. Its layout, all numbers little-endian:

    magic (8 bytes), block size, documents, ids, blocks, words (5 x uint64)
    doc ids (int64 each), whether the id is there (uint8 each), token counts (uint64 each)
    first word of each block (uint64 each), words (uint64 each)

Files are named by place, so that their names in order give the documents in order. They go to the
shared folder under a temporary name and are moved when whole; a task that runs again replaces
them. A table beside them, the manifest, says which files belong to the run.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newslens.llm import simple8b
from newslens.llm.tables import text_bytes
from newslens.session import fresh_path, written

MAGIC = b"S8BTOKEN"
SUFFIX = ".s8b"
END_ID = 2
# A file is closed when it holds so many ids; a document is never split.
FILE_IDS = 4_000_000
# Distinct words whose ids a worker remembers: some 110 bytes each.
MEMO = 400_000

_tokenizers: dict[str, WordTokenizer] = {}


# Bytes that only characters from U+0100 on have.
_BEYOND = re.compile(rb"[\xc4-\xff]")
# A single mark at the end of a word, after a letter or digit: the tokenizer parts them there.
_MARK = re.compile(
    rb"[.,;:!?](?=[\x20\x09-\x0d]|\Z)"
    rb"(?:(?<=[a-z0-9].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))"
)
# Byte-level models spell bytes as characters: printable ones as themselves, others from U+0100 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_HIDDEN = [b for b in range(256) if b not in set(_PRINTED)]
_SPELLING = {b: chr(b) for b in _PRINTED} | {b: chr(0x100 + i) for i, b in enumerate(_HIDDEN)}


class WordTokenizer(dict):
    """A tokenizer with a memo of words: word -> ids as bytes; one for each worker process.

    If the tokenizer lower-cases and composes characters, cuts at letters and spells bytes, then a
    lower-case word of letters below U+0100 reaches its model unchanged, and goes there directly.
    The memo holds the words of late, and those before them until as many new ones have come.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        super().__init__()
        self.older: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        shape = json.loads(self.tokenizer.to_str())
        normalizers = (shape["normalizer"] or {}).get("normalizers", [])
        cutters = (shape["pre_tokenizer"] or {}).get("pretokenizers", [])
        pattern = (cutters[0].get("pattern") or {}).get("Regex", "") if cutters else ""
        self.direct = (
            [x["type"] for x in normalizers] == ["NFC", "Replace", "Lowercase"]
            and [x["type"] for x in cutters] == ["Split", "ByteLevel"]
            and pattern.endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
            and not cutters[1].get("add_prefix_space")
        )

    def __missing__(self, word: bytes) -> bytes:
        found = self.older.get(word)
        if found is None:
            text = word.decode()
            if self.direct and text.isalpha() and text == text.lower() and max(text) < "\u0100":
                spelled = text if word.isascii() else word.decode("latin-1").translate(_SPELLING)
                ids = [token.id for token in self.tokenize(spelled)]
            else:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            found = array("I", ids).tobytes()
        self[word] = found
        return found

    def words(self, text: bytes) -> list[bytes]:
        """Pieces of a text whose ids, in a row, are those of the text."""
        if self.direct and not _BEYOND.search(text) and b"<|" not in text:
            # Below U+0100 lower case comes character by character, and nothing combines.
            text = text.lower() if text.isascii() else text.decode().lower().encode()
            text = _MARK.sub(rb" \g<0>", text)
        return text.split()

    def encode(self, text: bytes) -> bytes:
        if 2 * len(self) > MEMO:
            self.older = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, self.words(text)))


def token_bytes(texts: list[bytes], path: str) -> list[bytes]:
    """Ids of each text as little-endian 32-bit integers, without special ids.

    The tokenizer's pieces never span white space, so each text is cut there, and each
    distinct word is encoded once and then remembered.
    """
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return [_tokenizers[path].encode(text) for text in texts]


def pack(doc_ids: list[int | None], tokens: list[bytes]) -> bytes:
    """One file of documents."""
    lengths = np.array([len(t) // 4 for t in tokens], "<u8")
    ids = np.frombuffer(b"".join(tokens), "<u4")
    words, offsets = simple8b.encode(ids)
    head = np.array([simple8b.BLOCK, len(doc_ids), len(ids), len(offsets), len(words)], "<u8")
    return b"".join(
        (
            MAGIC,
            head.tobytes(),
            np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
            np.array([x is not None for x in doc_ids], np.uint8).tobytes(),
            lengths.tobytes(),
            offsets.astype("<u8").tobytes(),
            words.astype("<u8").tobytes(),
        )
    )


def unpack(content: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc ids, token counts, all ids) of one file."""
    if content[:8] != MAGIC:
        raise ValueError("not a token file")
    block, docs, ids, blocks, words = (int(x) for x in np.frombuffer(content, "<u8", 5, 8))
    if block != simple8b.BLOCK:
        raise ValueError(f"blocks of {block} ids are not known")
    at = 48
    parts = []
    for kind, count in (("<i8", docs), (np.uint8, docs), ("<u8", docs), ("<u8", blocks), ("<u8", words)):
        parts.append(np.frombuffer(content, kind, count, at))
        at += parts[-1].nbytes
    doc_ids, there, lengths, offsets, coded = parts
    known = [int(x) if y else None for x, y in zip(doc_ids, there, strict=True)]
    return known, lengths.astype(np.int64), simple8b.decode(coded, offsets.astype(np.int64), ids)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Token files of all documents in folder `path`; the manifest (file, n_docs, n_ids).

    Documents are ordered by doc_id, null ids first; equal ids by a hash of their text.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        files, folder = pyarrow.fs.FileSystem.from_uri(path)
        files.create_dir(folder, recursive=True)
        end = np.array([end_id], "<u4").tobytes()
        doc_ids: list[int | None] = []
        tokens: list[bytes] = []
        size = number = 0

        def close() -> pa.RecordBatch:
            nonlocal size, number
            name = f"part-{context.partitionId():06d}-{number:06d}{SUFFIX}"
            draft = f"{folder}/.{name}.{context.taskAttemptId()}"
            with files.open_output_stream(draft) as out:
                out.write(pack(doc_ids, tokens))
            files.move(draft, f"{folder}/{name}")
            row = pa.RecordBatch.from_pylist([{"file": name, "n_docs": len(doc_ids), "n_ids": size}])
            doc_ids.clear()
            tokens.clear()
            size = 0
            number += 1
            return row

        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = [value.as_py() for value in part.column(1)]
                for doc, ids in zip(part.column(0).to_pylist(), token_bytes(texts, tokenizer), strict=True):
                    doc_ids.append(doc)
                    tokens.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= FILE_IDS:
                        yield close()
        if doc_ids:
            yield close()
        pa.default_memory_pool().release_unused()

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("data")
    ).withColumn("tie", F.xxhash64("data"))
    ordered = (
        rows.repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "data")
        .select("doc_id", "data")
    )
    return written(ordered.mapInArrow(write, "file string, n_docs long, n_ids long"), "manifest")


def read_token_files(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of the manifest.

    start counts the ids of all documents before, over all files.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                doc_ids, lengths, ids = unpack(content.as_py())
                stops = np.cumsum(lengths)
                data = memoryview(ids.astype("<u4").tobytes())
                checks = [
                    zlib.crc32(data[4 * (stop - n) : 4 * stop])
                    for stop, n in zip(stops.tolist(), lengths.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name.as_py()] * len(doc_ids)), pa.array(doc_ids, pa.int64()),
                        pa.array(stops - lengths), pa.array(lengths), pa.array(checks, pa.int64()),
                    ],
                    ["file", "doc_id", "inner", "n_tokens", "ids_crc32"],
                )

    # As many rows as files: one short list gives each file's first id.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"))
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{SUFFIX}")
        .load(path)
        .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    )
    found = files.mapInArrow(
        read, "file string, doc_id long, inner long, n_tokens long, ids_crc32 long"
    )
    return found.join(offsets, "file").select(
        "doc_id", (F.col("first") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Documents written as token files in the shared folder and described from what is read back.

    A null text is an empty one: the end id alone. Rows without an id come first; repeated rows
    are written as often as they occur; other columns are not read; an empty table gives
    no file and no row. `tokenizer` is a path that every executor can read.
    """
    spark = docs.sparkSession
    path = fresh_path(spark, "tokens")
    manifest = write_token_files(docs, path, tokenizer, end_id)
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_token_files(spark, path, manifest)
