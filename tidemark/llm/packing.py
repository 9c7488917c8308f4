"""Packing token sequences into windows by Karmarkar-Karp differencing."""

from __future__ import annotations

import re
from array import array
from bisect import insort
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidemark.llm.common import map_rows, remembered, slices
from tidemark.llm.token_counts import byte_characters

MEMO = 1 << 18  # words, and as many parts of words, whose ids a task keeps
AT_ONCE = 4 * 1024 * 1024  # bytes of text whose words are looked up together
# A word of Latin letters, between marks: the tokenizer takes the three apart, as no mark before the letters
# begins a contraction.
PARTS = re.compile(r"([!-&(-/:-@\[-`{-~]*)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")
LOWER = re.compile("[a-zß-öø-ÿ]+")


def difference(lengths: Sequence[int], windows: int) -> list[int]:
    """The window, below ``windows``, of each item, so that the sums of windows are nearly equal.

    Multiway differencing: a partial partition is its windows that hold items, fullest first; the others are
    empty. The two partitions with the largest spread between their sums merge again and again, the fullest windows
    of one with the emptiest of the other. Only differences matter, so sums need not be made relative.
    """
    into = list(range(len(lengths)))  # the window that each one became part of; item i begins as window i
    parts = [[(-length, i)] for i, length in enumerate(lengths)]
    heap = [(-length, i) for i, length in enumerate(lengths)]
    heapify(heap)
    while len(heap) > 1:
        a, b = parts[heappop(heap)[1]], parts[heappop(heap)[1]]
        if len(a) < len(b):
            a, b = b, a
        if len(b) == 1:
            # The usual case: one item goes to an empty window, or to the emptiest.
            size, window = b[0]
            if len(a) == windows:
                held, other = a.pop()
                into[window] = other
                size, window = size + held, other
            insort(a, (size, window))
        else:
            alone = max(0, windows - len(b))
            shared = []
            for i in range(alone, len(a)):
                (held, other), (size, window) = a[i], b[windows - 1 - i]
                into[window] = other
                shared.append((held + size, other))
            a = sorted(a[:alone] + shared + b[: max(0, windows - len(a))])
        emptiest = a[-1][0] if len(a) == windows else 0
        parts.append(a)
        heappush(heap, (a[0][0] - emptiest, len(parts) - 1))
    numbers = {window: number for number, (_, window) in enumerate(parts[-1])}
    placed = []
    for item in range(len(lengths)):
        window = item
        while into[window] != window:
            into[window] = window = into[into[window]]
        placed.append(numbers[window])
    return placed


def pack(lengths: Sequence[int], capacity: int) -> tuple[list[int], int]:
    """Windows of items no longer than ``capacity``, and their number: the least that capacity allows, then
    more as long as a window exceeds it, in the measure that the fullest one does."""
    if not lengths:
        return [], 0
    windows = max(1, -(-sum(lengths) // capacity))
    while True:
        placed = difference(lengths, windows)
        fullest = int(np.bincount(placed, weights=lengths, minlength=windows).max())
        if fullest <= capacity:
            return placed, windows
        windows = max(windows + 1, windows * fullest // capacity)


class Words:
    """Ids of whole texts, remembered by word and by part of a word.

    For tokenizers that lower case, drop blanks and let no token cross them or the border of letters and marks, which
    `word_bpe` files do: the words between ASCII blanks are looked up, then their letters and marks (`PARTS`),
    and what is new is encoded by the library one by one, each once.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.memo: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {"": b""}
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        # Lower-case letters need none of the library's steps before the merges, if it writes bytes as characters.
        self.shown = str.maketrans({chr(byte): char for byte, char in byte_characters().items()})
        self.plain = all(
            self._merged(part) == array("I", self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes()
            for part in ("a", "word", "straße", "ÿé")
        )

    def _merged(self, letters: str) -> bytes:
        # ASCII letters are shown as themselves.
        shown = letters if letters.isascii() else letters.encode().decode("latin-1").translate(self.shown)
        found = self.tokenizer.model.tokenize(shown)
        return array("I", [token.id for token in found]).tobytes()

    def _encode(self, parts: list[str]) -> None:
        if self.plain:
            letters = [part for part in parts if LOWER.fullmatch(part)]
            self.parts.update((part, self._merged(part)) for part in letters)
            parts = [part for part in parts if part not in self.parts]
        for start in range(0, len(parts), 20_000):
            some = parts[start : start + 20_000]
            found = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            self.parts.update((part, array("I", one.ids).tobytes()) for part, one in zip(some, found, strict=True))

    def _cut(self, word: str, added: list[str]) -> str | tuple[str, str, str]:
        """Letters alone in lower case, marks and letters and marks, or else the word."""
        match = PARTS.fullmatch(word)
        if not match or (added and any(token in word for token in added)):
            return word
        before, letters, after = match.groups()
        return (before, letters.lower(), after) if before or after else letters.lower()

    def _packed(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        memo, known, cut = self.memo, self.parts, self._cut
        packed = list(map(memo.get, words))
        unknown = [word for word, ids in zip(words, packed, strict=True) if ids is None]
        # Added tokens hold no blanks, so none reaches over words.
        together = " ".join(unknown)
        added = [token for token in self.added if token in together]
        plain = not added
        parts = [word.lower() if plain and word.isascii() and word.isalpha() else cut(word, added) for word in unknown]
        new = {part for part in parts if type(part) is str and part not in known}
        new.update(part for some in parts if type(some) is tuple for part in some if part not in known)
        self._encode(list(new))
        found = [
            known[some] if type(some) is str else known[some[0]] + known[some[1]] + known[some[2]] for some in parts
        ]
        # What came first is mostly what comes often; the rest is not kept.
        if len(memo) + len(unknown) <= MEMO:
            memo.update(zip(unknown, found, strict=True))
        if len(known) > MEMO:
            for part in new:
                del known[part]
        rest = iter(found)
        return [next(rest) if ids is None else ids for ids in packed]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one behind another, and the places where each text's begin, and the end."""
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        packed = self._packed(coded.dictionary.to_numpy(zero_copy_only=False).tolist())  # faster than to_pylist
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        pool, codes = np.frombuffer(b"".join(packed), "<u4"), coded.indices.to_numpy()
        own = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(own)])
        # Each id's place in the pool: where its word's begin, and how far into the word it is.
        shift = (np.cumsum(sizes) - sizes)[codes] - ends[:-1]
        kind = np.int32 if ends[-1] < 2**31 else np.int64
        place = np.repeat(shift.astype(kind), own)
        place += np.arange(len(place), dtype=kind)
        ids = pool[place]
        first = split.offsets.to_numpy()
        return ids, ends[first - first[0]]


def words(path: str) -> Words:
    return remembered(("words", path), lambda: Words(path))


def pack_documents(
    docs: DataFrame,
    path: str,
    capacity: int = 2048,
    piece: int = 512,
    group_windows: int = 256,
    end_id: int = 1,
    text: str | Column = "text",
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Pack the tokens of every row, each followed by ``end_id``, into sequences of at most ``capacity`` tokens.

    One row per piece: the ``keep`` columns, ``start`` (the row's ids before the piece), ``length``,
    ``ids`` (binary: unsigned 32-bit little-endian), ``doc_tokens``, ``sequence_id`` and ``offset`` in the sequence.

    A row with ``capacity`` ids or more first fills sequences by itself. What remains is cut into even pieces of at
    most ``piece`` ids. Pieces of ``group_windows`` sequences at a time are dealt out by Karmarkar-Karp
    differencing, which leaves the windows nearly equal and so nearly full; one window is added whenever
    capacity is exceeded. Groups are runs of rows inside a task, so nothing is shuffled, a task holds
    one group, and a repeated task makes the same rows. Each task's last group is smaller, so the
    padding is about half a window per group and task.

    A null or empty text is its end id alone. Repeated rows are packed each by itself.
    """
    text = F.col(text) if isinstance(text, str) else text
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = words(path)
        end = int(end_id).to_bytes(4, "little")
        sequence = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []  # (kept values, ids, start, stop) of the open group
        held = 0

        def batch_of(out: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            arrays = [pa.array([kept[i] for kept in columns[0]], schema.field(i).type) for i in range(len(names))]
            numbers = [pa.array(columns[k], pa.int64()) for k in (1, 2)]
            rest = [pa.array(columns[k], pa.int64()) for k in (4, 5, 6)]
            return pa.RecordBatch.from_arrays(
                [*arrays, *numbers, pa.array(columns[3], pa.binary()), *rest],
                names=[*names, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        def close() -> list[tuple]:
            nonlocal rows, held, sequence
            placed, count = pack([stop - start for _, _, start, stop in rows], capacity)
            filled = [0] * count
            out = []
            for window, (kept, ids, start, stop) in zip(placed, rows, strict=True):
                at = filled[window]
                filled[window] += stop - start
                out.append((kept, start, stop - start, ids[4 * start : 4 * stop], len(ids) // 4, sequence + window, at))
            sequence += count
            rows, held = [], 0
            return out

        schema = None
        for batch in batches:
            schema = batch.schema
            kept = list(zip(*[batch.column(name).to_pylist() for name in names], strict=True)) or [()] * batch.num_rows
            for k, texts in slices(batch.column("_0"), AT_ONCE):
                out = []
                tokens, at = own.ids(texts)
                for key, low, high in zip(kept[k : k + len(texts)], at[:-1].tolist(), at[1:].tolist(), strict=True):
                    ids = tokens[low:high].tobytes() + end
                    total = len(ids) // 4
                    whole = total // capacity * capacity
                    for start in range(0, whole, capacity):
                        out.append((key, start, capacity, ids[4 * start : 4 * (start + capacity)], total, sequence, 0))
                        sequence += 1
                    parts = -(-(total - whole) // piece)
                    for part in range(parts):
                        start = whole + (total - whole) * part // parts
                        rows.append((key, ids, start, whole + (total - whole) * (part + 1) // parts))
                    held += total - whole
                    if held >= group_windows * capacity:
                        out += close()
                if out:
                    yield batch_of(out, schema)
        if rows:
            yield batch_of(close(), schema)

    outputs = [
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
    return map_rows(docs, keep, [F.coalesce(text.cast("string"), F.lit(""))], outputs, run)
