"""Byte-level BPE: encoding by a perfect hash over the vocabulary, then heap merges; and decoding."""

from __future__ import annotations

import base64
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_rows
from tidemark.llm.perfect_hash import PerfectHash
from tidemark.llm.pieces import Splitter, merge_bytes


REMEMBERED = 1 << 18  # words, and as many pieces of words, whose ids a task keeps


def ranks_of(path: str) -> dict[bytes, int]:
    """The tokens of a ``.tiktoken`` file."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Encoding:
    """Ids of texts, packed as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks = ranks_of(path)
        self.hash = PerfectHash(list(self.ranks))
        self.tokens: list[bytes] = [b""] * self.hash.size
        self.packed: list[bytes] = [b""] * self.hash.size
        for token, rank in self.ranks.items():
            slot = self.hash.slot(token)
            self.tokens[slot], self.packed[slot] = token, rank.to_bytes(4, "little")
        self.encode = Splitter(pattern, self._piece, b"".join, REMEMBERED)

    def _piece(self, piece: bytes) -> bytes:
        slot = self.hash.slot(piece)
        if self.tokens[slot] == piece:  # first tier: the whole piece is a token
            return self.packed[slot]
        return np.array(merge_bytes(piece, self.ranks), "<u4").tobytes()


@lru_cache(maxsize=1)
def encoding(path: str, pattern: str) -> Encoding:
    return Encoding(path, pattern)


@lru_cache(maxsize=1)
def tokens_by_id(path: str) -> dict[int, bytes]:
    """All that decoding needs: a worker that decodes holds no hash."""
    return {rank: token for token, rank in ranks_of(path).items()}


def encode(
    docs: DataFrame, path: str, pattern: str, text: str | Column = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The ``keep`` columns, ``n_tokens`` and ``ids`` (binary: unsigned 32-bit little-endian) of every row.

    Each match of ``pattern`` is encoded by itself: one probe of a minimal perfect hash finds it when
    it is a token, else a heap merges its bytes. Strings of special tokens are ordinary text. A null text is
    empty: no ids. Repeated rows each get a row; columns not kept are left out.
    """
    text = F.col(text) if isinstance(text, str) else text

    def run(batches):
        own = encoding(path, pattern)
        for batch in batches:
            ids = [own.encode(text.as_py()) for text in batch.column("_0")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=[*batch.schema.names[:-1], "n_tokens", "ids"],
            )

    outputs = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    return map_rows(docs, keep, [F.coalesce(text.cast("string"), F.lit(""))], outputs, run)


def decode(encoded: DataFrame, path: str, ids: str = "ids", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``decoded`` (binary) of every row; null ids decode to empty bytes.

    Bytes, as ids may end inside a character. An id that the vocabulary lacks is an error.
    """

    def run(batches):
        token = tokens_by_id(path).__getitem__
        for batch in batches:
            packed = batch.column("_0")
            rows = [b"".join(map(token, np.frombuffer(one.as_buffer(), "<u4").tolist())) for one in packed]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(rows, pa.binary())], names=[*batch.schema.names[:-1], "decoded"]
            )

    outputs = [T.StructField("decoded", T.BinaryType())]
    return map_rows(encoded, keep, [F.coalesce(F.col(f"`{ids}`"), F.lit(b""))], outputs, run)
