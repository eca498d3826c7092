"""Byte-level BPE of whole corpora through a sentencepiece model made from a rank file.

The rank file is a public vocabulary (one base64 token and its rank a line). Its
tokens are written, byte for byte mapped to printable letters, as the pieces of a
sentencepiece BPE model whose score is the negative rank, with identity
normalisation. sentencepiece then always joins the adjacent pair of highest score,
which is the pair of lowest rank, the leftmost first: the merge order of the
vocabulary. Texts are split into pre-tokens first; each distinct pre-token of a
worker is encoded once. Nothing is trained.
"""

from __future__ import annotations

import base64
import re
import struct
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Place of the vocabulary; a parameter of every function here.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Distinct pre-tokens a worker keeps encoded; beyond it the store is emptied and refilled.
KEPT = 1_000_000
#: Characters encoded at a time, so that memory doesn't depend on the batch.
SLICE_CHARS = 2_000_000

_TYPES = {"unknown": 2}


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(tag: int, value: bytes | int | float) -> bytes:
    if isinstance(value, bytes):
        return _varint(tag << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(tag << 3 | 5) + struct.pack("<f", value)
    return _varint(tag << 3) + _varint(value)


def byte_letters() -> list[str]:
    """A printable letter for every byte: itself where it is one, else from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


def read_ranks(path: str = VOCABULARY) -> list[bytes]:
    """Tokens of a rank file in order of rank; ranks must run from 0 without a gap."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without a gap")
    return [tokens[i] for i in range(len(tokens))]


def model_proto(tokens: list[bytes]) -> bytes:
    """Serialised sentencepiece model in which token i has id i; the unknown piece comes last."""
    letters = byte_letters()
    out = [_field(1, _field(1, "".join(letters[b] for b in token).encode()) + _field(2, -float(i))) for i, token in enumerate(tokens)]
    out.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, _TYPES["unknown"])))
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens)) + _field(41, -1) + _field(42, -1) + _field(43, -1)
    normaliser = _field(1, b"identity") + _field(2, b"") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(out) + _field(2, trainer) + _field(3, normaliser)


@lru_cache(1)
def pre_tokens() -> re.Pattern:
    """The vocabulary's split into pre-tokens, with its classes written out for ``re``."""
    spans: dict[str, list[list[int]]] = {"L": [], "N": []}
    for cp in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(cp))[0]
        if kind in spans:
            s = spans[kind]
            if s and s[-1][1] == cp - 1:
                s[-1][1] = cp
            else:
                s.append([cp, cp])
    cls = {k: "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in s) for k, s in spans.items()}
    space = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
    letters, digits = f"[{cls['L']}]+", f"[{cls['N']}]+"
    # frequent letters first: the long classes are only tried where these end
    letters = f"(?:[A-Za-zА-яЁё]+|{letters})+"
    other = f"[^{space}{cls['L']}{cls['N']}]+"
    return re.compile(f"'(?:[stmd]|re|ve|ll)| ?{letters}| ?{digits}| ?{other}|[{space}]+(?![^{space}])|[{space}]+")


class Encoder:
    """Encodes texts; holds the model and the pre-tokens met so far."""

    def __init__(self, ranks: list[bytes], kept: int = KEPT):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model_proto(ranks))
        self.letters = byte_letters()
        self.table = {b: x for b, x in enumerate(self.letters)}
        self.kept = kept
        self._empty()

    def _empty(self) -> None:
        self.known: dict[str, int] = {}
        self.sizes = np.zeros(1024, dtype=np.int64)
        self.starts = np.zeros(1024, dtype=np.int64)
        self.pool = np.zeros(4096, dtype=np.int32)
        self.used = 0

    def _learn(self, new: list[str]) -> None:
        mapped = [x.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.table) for x in new]
        ids = self.sp.encode(mapped, num_threads=1)
        n, sizes = len(self.known), np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        total = int(sizes.sum())
        while n + len(new) > len(self.sizes):
            self.sizes, self.starts = np.resize(self.sizes, 2 * len(self.sizes)), np.resize(self.starts, 2 * len(self.starts))
        while self.used + total > len(self.pool):
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.sizes[n : n + len(new)] = sizes
        self.starts[n : n + len(new)] = self.used + np.cumsum(sizes) - sizes
        self.pool[self.used : self.used + total] = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=total)
        self.used += total
        self.known.update(zip(new, range(n, n + len(new)), strict=True))

    def _codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        find = pre_tokens().findall
        split = [find(t) if t else [] for t in texts]
        if len(self.known) > self.kept:
            self._empty()
        words = list(chain.from_iterable(split))
        codes = list(map(self.known.get, words, repeat(-1)))
        if -1 in codes:
            new = list(dict.fromkeys(w for w, c in zip(words, codes, strict=True) if c < 0))
            self._learn(new)
            codes = list(map(self.known.__getitem__, words))
        return np.array(codes, dtype=np.int64), np.fromiter(map(len, split), dtype=np.int64, count=len(split))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): ids of text i are ``ids[offsets[i]:offsets[i+1]]``; none for null and empty texts."""
        codes, words = self._codes(texts)
        sizes = self.sizes[codes]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total, dtype=np.int64) + np.repeat(self.starts[codes] - (ends - sizes), sizes)
        offsets = np.append(0, ends)[np.append(0, np.cumsum(words))]
        return offsets, self.pool[at]

    def count(self, texts: list[str]) -> np.ndarray:
        """Number of ids of each text."""
        codes, words = self._codes(texts)
        ends = np.append(0, np.cumsum(self.sizes[codes]))
        at = np.append(0, np.cumsum(words))
        return ends[at[1:]] - ends[at[:-1]]


def decode(ids: list[int], ranks: list[bytes]) -> str:
    """The text of ``ids``, by the inverse mapping."""
    return b"".join(ranks[i] for i in ids).decode("utf-8", "surrogatepass")


_worker: dict[int, Encoder] = {}


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    texts = batch.column(column).to_pylist()
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= SLICE_CHARS or i == len(texts) - 1:
            yield batch.slice(lo, i + 1 - lo), texts[lo : i + 1]
            lo, size = i + 1, 0


def _shared(spark: SparkSession, path: str):
    """The vocabulary on every executor; its size is fixed by the file (under 1 MB)."""
    return spark.sparkContext.broadcast(read_ranks(path))


def _encoder(shared) -> Encoder:
    if id(shared.value) not in _worker:
        _worker.clear()
        _worker[id(shared.value)] = Encoder(shared.value)
    return _worker[id(shared.value)]


def encode(df: DataFrame, *, id: str, text: str, into: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """``id`` and the token ids of ``text`` by the vocabulary, without special tokens.

    One row per row of ``df``: null, empty texts give an empty list; blanks are
    tokens like any other; repeated rows and ids stay. Other columns are not read.
    """
    shared = _shared(df.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in batches:
            for part, texts in _slices(batch, 1):
                offsets, ids = encoder.encode(texts)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))], names=["id", "ids"])

    key = T.StructField("id", df.schema[id].dataType)
    out = df.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(run, T.StructType([key, T.StructField("ids", T.ArrayType(T.IntegerType()))]))
    return out.select(F.col("id").alias(id), F.col("ids").alias(into))


def count_tokens(df: DataFrame, *, text: str, keep: list[str], into: str = "tokens", vocabulary: str = VOCABULARY) -> DataFrame:
    """Columns ``keep`` of ``df`` and the number of tokens of ``text`` (0 for null and empty)."""
    shared = _shared(df.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in batches:
            for part, texts in _slices(batch, 0):
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(encoder.count(texts).astype(np.int64))], names=[*part.schema.names[1:], "n"])

    inner = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    fields = [T.StructField(f"k{i}", df.schema[c].dataType) for i, c in enumerate(keep)]
    out = df.select(F.col(text).cast("string").alias("t"), *inner).mapInArrow(run, T.StructType([*fields, T.StructField("n", T.LongType())]))
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], F.col("n").alias(into))
