"""Periodic runs of words: seeds on a text's diagonals, each stretch extended once."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_rows

LEAST, PERIODS = 6, 4  # a run has this many words, and this many times its period, at least
BATCH = 16 * 1024 * 1024  # bytes of collapsed text after which a batch of results goes out
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
# Texts below this size are split at once; of longer ones no list of all words is made.
SPLIT = 1024 * 1024

RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])


def words_of(data: bytes) -> Iterator[bytes]:
    return iter(data.split()) if len(data) < SPLIT else (m.group() for m in WORD.finditer(data))


def pair_names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A number for each pair: equal for equal pairs only."""
    return np.unique(left * (int(right.max(initial=0)) + 1) + right, return_inverse=True)[1]


def seeds(ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, starts, lags): where a k-gram occurs again after ``lags`` words, for each band of lags 2^j to 2^(j+1) - 1.

    A run of period q overlaps itself q words on in max(6, 4q) - q words at least; over a band that is k = 3 * 2^j, and
    5 in the first. As k is not below q, a k-gram of the run cannot recur after fewer than q words, or the run
    would have a smaller period. So the next occurrence alone is a seed for every run, and a word that is
    repeated throughout a text gives a pair a place, not all pairs.

    Grams of 2^j words are named by the names of their halves, and k-grams by two such that cover them.
    """
    n, names, size = len(ids), ids, 1
    low = 1
    while True:
        k = max(3 * low, LEAST - 1)
        while 2 * size <= min(k, n):
            names, size = pair_names(names[:-size], names[size:]), 2 * size
        if n <= k:
            return
        grams = pair_names(names[: n - k + 1], names[k - size :])
        order = np.argsort(grams, kind="stable")
        again = grams[order[1:]] == grams[order[:-1]]
        if not again.any():
            return  # nor does a longer gram recur
        starts, lags = order[:-1][again], np.diff(order)[again]
        band = (lags >= low) & (lags < 2 * low)
        yield k, starts[band], lags[band]
        low *= 2


def backwards(ids: np.ndarray, at: int, lag: int) -> int:
    """Where the stretch of words that recur ``lag`` words on begins, if those before ``at`` belong to it."""
    step = 64
    while at > 0:
        low = max(0, at - step)
        other = np.flatnonzero(ids[low:at] != ids[low + lag : at + lag])
        if len(other):
            return low + int(other[-1]) + 1
        at, step = low, 2 * step
    return 0


def forwards(ids: np.ndarray, at: int, lag: int) -> int:
    """Where that stretch ends, if it reaches ``at``."""
    step, last = 64, len(ids) - lag
    while at < last:
        high = min(last, at + step)
        other = np.flatnonzero(ids[at:high] != ids[at + lag : high + lag])
        if len(other):
            return at + int(other[0])
        at, step = high, 2 * step
    return last


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and then period."""
    found = []
    covered: dict[int, int] = {}  # lag: how far its stretches are known
    for k, starts, lags in seeds(ids):
        order = np.lexsort((starts, lags))
        starts, lags = starts[order], lags[order]
        # Seeds in a row are on one stretch, as the k-grams at both overlap.
        first = np.ones(len(starts), bool)
        first[1:] = (lags[1:] != lags[:-1]) | (starts[1:] != starts[:-1] + 1)
        for start, lag in zip(starts[first].tolist(), lags[first].tolist(), strict=True):
            if start < covered.get(lag, 0):
                continue
            begin, end = backwards(ids, start, lag), forwards(ids, start + k, lag)
            covered[lag] = end
            length = end - begin + lag
            if length >= max(LEAST, PERIODS * lag):
                found.append((begin, length, lag))
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapse(data: bytes) -> tuple[int, list[tuple[int, int, int]], bytes]:
    """Number of words, runs, and the words that are left when each run keeps its first period alone."""
    vocabulary: defaultdict[bytes, int] = defaultdict()
    vocabulary.default_factory = vocabulary.__len__
    ids = np.fromiter(map(vocabulary.__getitem__, words_of(data)), np.int64)
    runs = runs_of(ids) if len(ids) >= LEAST else []
    if runs:
        change = np.zeros(len(ids) + 1, np.int64)
        for start, length, period in runs:
            change[start + period] += 1
            change[start + length] -= 1
        ids_left = ids[np.cumsum(change[:-1]) == 0]
    else:
        ids_left = ids
    names = list(vocabulary)
    return len(ids), runs, b" ".join(map(names.__getitem__, ids_left.tolist()))


def _collapse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    struct = pa.struct([(f.name, pa.int64()) for f in RUN])

    def packed(batch: pa.RecordBatch, rows: list) -> pa.RecordBatch:
        columns = [
            pa.array([n for n, _, _ in rows], pa.int64()),
            pa.array([[dict(zip(RUN.names, run, strict=True)) for run in runs] for _, runs, _ in rows], pa.list_(struct)),
            pa.array([text for _, _, text in rows], pa.binary()).cast(pa.string()),
        ]
        names = [*batch.schema.names[:-1], "n_words", "runs", "collapsed"]
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names)

    for batch in batches:
        rows, size, done = [], 0, 0
        texts = batch.column(batch.num_columns - 1)
        for at in range(batch.num_rows):
            rows.append(collapse(texts[at].as_py() or b""))
            size += len(rows[-1][2])
            if size >= BATCH:
                yield packed(batch.slice(done, len(rows)), rows)
                rows, size, done = [], 0, at + 1
        if rows:
            yield packed(batch.slice(done), rows)


def periodic_runs(docs: DataFrame, text: str | Column = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of every row, and ``n_words``, ``runs`` (``start``, ``length``, ``period``) and ``collapsed``.

    Words are runs of code points other than space and U+0009 to U+000D, numbered from 0. A run is a stretch of words of
    smallest period q, of at least max(6, 4q) words, that neither neighbour extends; runs come by start, then
    period. ``collapsed`` joins by one space the words that no run holds after its own first q words.

    Null and empty texts have no words, no runs and an empty ``collapsed``. Every row has its own result, repeated rows
    too, and ids are only carried along. A text is read by one task, in memory in line with its size; nothing is shuffled.
    """
    column = F.col(f"`{text}`") if isinstance(text, str) else text
    outputs = [
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("collapsed", T.StringType()),
    ]
    return map_rows(docs, keep, [column.cast("string").cast("binary")], outputs, _collapse_batches)
