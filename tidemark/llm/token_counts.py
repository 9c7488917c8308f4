"""Token counts of byte-level BPE, without making ids."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_rows
from tidemark.llm.pieces import Splitter, count_merged

# Fixed: how the byte-level pre-tokenizer splits text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes for
    themselves, the others from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(0x100 + i) for i, b in enumerate(hidden)}}


class Counter:
    """Counts the tokens of texts by the vocabulary and merges of a byte-level BPE file.

    Strings of added tokens inside a text count as one token each, as the file's library has it.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.symbol = [vocab[char] for _, char in sorted(byte_characters().items())]
        self.added = [token["content"] for token in spec.get("added_tokens", [])]
        self.count = Splitter(PATTERN, self._piece, sum)

    def _piece(self, piece: bytes) -> int:
        return count_merged([self.symbol[byte] for byte in piece], self.merges)

    def __call__(self, text: str) -> int:
        parts, found = [text], 0
        for token in self.added:
            if token in text:
                parts = [x for part in parts for x in part.split(token)]
                found = len(parts) - 1
        return found + sum(self.count(part) for part in parts if part)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(
    docs: DataFrame, path: str, text: str | Column = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The ``keep`` columns, ``n_bytes`` (UTF-8) and ``n_tokens`` of every row.

    Within each pre-token the lowest-ranked adjacent pair is popped from a heap over linked symbols
    again and again; the count is symbols less merges. ``path`` must exist on every executor. A null text counts
    as empty: 0 and 0. Repeated rows each get a row; columns not kept are left out.
    """
    text = F.col(text) if isinstance(text, str) else text

    def run(batches):
        count = counter(path)
        for batch in batches:
            texts = batch.column("_0").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array([len(text.encode()) for text in texts], pa.int64()),
                    pa.array([count(text) for text in texts], pa.int64()),
                ],
                names=[*batch.schema.names[:-1], "n_bytes", "n_tokens"],
            )

    outputs = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    return map_rows(docs, keep, [F.coalesce(text.cast("string"), F.lit(""))], outputs, run)
