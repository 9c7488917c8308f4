"""Spelling variants: words at one edit, found by comparing tiles of words densely."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

MIDDLE = 2  # code points that words of a tile may differ in, and
PIECES = 32  # the most such middles of a word: beyond 64 code points they are longer
TILE = 512  # words of a tile's side
SIDE = 128  # words compared with as many at once, fewer when they are long
CELLS = 4 * 1024 * 1024  # code points compared at once
WORDS = 200_000  # distinct words that a task counts before it sends them on

RUN = re.compile("[a-zÀ-ÿ]+")


def runs_of(text: bytes) -> Counter[str]:
    """How often each run of letters occurs, in lower case as far as A to Z go."""
    return Counter(m.group() for m in RUN.finditer(text.lower().decode("utf-8", "replace")))


def without_one(doc_id: int | None, run: str, seed: int, every: int) -> str:
    """The run, less a code point if the CRC-32 of ``<doc_id>:<run>`` is a multiple of ``every``."""
    if doc_id is None:
        return run
    h = zlib.crc32(run.encode(), seed)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(
    docs: DataFrame, text: str = "text", id: str = "doc_id", least: int = 6, occurrences: int = 5, every: int | None = 199
) -> DataFrame:
    """(``word``, ``n``): maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` of at least ``least`` code points that occur
    ``occurrences`` times or more in all texts, with A to Z in lower case.

    With ``every``, a run loses one code point where the CRC-32 of ``<id>:<run>`` is a multiple of it, which plants
    variants; rows without an id are left as they are. Null texts have no words, and repeated rows count each.
    Tasks count before the shuffle, so that a frequent word is a row a task.
    """

    def counted(counts: Counter[str]) -> pa.RecordBatch:
        words = pa.array(list(counts), pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for doc_id, value in zip(batch.column(0), batch.column(1), strict=True):
                doc_id = doc_id.as_py()
                seed = zlib.crc32(f"{doc_id}:".encode())
                for run, n in runs_of(value.as_py() or b"").items():
                    word = without_one(doc_id, run, seed, every) if every else run
                    if len(word) >= least:
                        counts[word] += n
                if len(counts) >= WORDS:
                    yield counted(counts)
                    counts.clear()
        yield counted(counts)

    narrow = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    counts = narrow.mapInArrow(count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


def frames(word: Column, size: Column, base: Column) -> Column:
    """A key for each middle that an edit of a word of ``base`` code points may lie in: what is before and after it.

    A word at one edit from another of the same length, or one more, has the same prefix and suffix round one of the
    shorter word's middles. A hash stands for both; words that meet by chance are told apart when they are compared.
    """
    width = F.greatest(F.lit(MIDDLE), F.ceil(base / PIECES).cast("int"))

    def frame(start: Column) -> Column:
        after = F.greatest(base - start - width, F.lit(0))
        return F.xxhash64(base, start, F.substr(word, F.lit(1), start), F.substr(word, size - after + 1, after))

    return F.transform(F.sequence(F.lit(0), base - 1, width), frame)


def common(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Length of the common prefix of every row of ``left`` and every row of ``right``, padding included."""
    same = left[:, None, :] == right[None, :, :]
    first = same.argmin(2)
    return np.where(same.all(2), left.shape[1], first)


def matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points, padded with 0, of the words and of the words backwards."""
    kinds = f"<U{width}"
    return tuple(np.array(x, kinds).view(np.uint32).reshape(len(words), width) for x in (words, [w[::-1] for w in words]))


def near_in(words: list[str], tiles: np.ndarray) -> Iterator[tuple[int, int]]:
    """Places i < j of words of one tile that differ by one edit; ``tiles`` never falls."""
    sizes = np.array([len(w) for w in words])
    width = int(sizes.max(initial=1))
    side = max(1, min(SIDE, int((CELLS / width) ** 0.5)))
    starts = range(0, len(words), side)
    for low in starts:
        own = slice(low, low + side)
        forth, back = matrices(words[own], width)
        for other in range(low, len(words), side):
            if tiles[other] > tiles[own][-1]:
                break
            others = slice(other, other + side)
            to, fro = (forth, back) if other == low else matrices(words[others], width)
            longer = np.maximum(sizes[own][:, None], sizes[others][None, :])
            shorter = np.minimum(sizes[own][:, None], sizes[others][None, :])
            prefix, suffix = (np.minimum(common(a, b), shorter) for a, b in ((forth, to), (back, fro)))
            near = (prefix + suffix >= longer - 1) & (longer - shorter <= 1)
            near &= tiles[own][:, None] == tiles[others][None, :]
            near &= ~((prefix == longer) & (shorter == longer))
            for i, j in zip(*np.nonzero(near), strict=True):
                if low + i < other + j:
                    yield low + int(i), other + int(j)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (``a``, ``n_a``, ``b``, ``n_b``) of rows that come tile by tile, a few tiles at a time."""

    def links(rows: list[tuple]) -> pa.RecordBatch:
        words = [row[1] for row in rows]
        tiles = np.cumsum([0] + [rows[i][0] != rows[i - 1][0] for i in range(1, len(rows))])
        found = [(i, j) if words[i] < words[j] else (j, i) for i, j in near_in(words, tiles)]
        columns = [
            pa.array([rows[pair[end]][field] for pair in found], kind)
            for end in (0, 1)
            for field, kind in ((1, pa.string()), (2, pa.int64()))
        ]
        return pa.RecordBatch.from_arrays(columns, ["a", "n_a", "b", "n_b"])

    def rows() -> Iterator[tuple]:
        for batch in batches:
            key, i, j, word, n = (column.to_pylist() for column in batch.columns)
            yield from zip(zip(key, i, j, strict=True), word, n, strict=True)

    waiting: list[tuple] = []
    for _, tile in groupby(rows(), key=lambda row: row[0]):
        waiting += tile
        if len(waiting) >= TILE:
            yield links(waiting)
            waiting = []
    if waiting:
        yield links(waiting)


def near_words(words: DataFrame) -> DataFrame:
    """Links (``a``, ``n_a``, ``b``, ``n_b``), a < b, of the words (``word``, ``n``) that differ by one inserted, deleted or
    replaced code point, each once.

    Words that share prefix and suffix round a middle (see `frames`) form tiles, which are compared densely: two words
    are near when their common prefix and suffix together reach the longer one's length less one. A group of more than
    `TILE` words is dealt into blocks, and each pair of blocks is a tile, so no task holds a whole group.
    """
    size = F.char_length("word")
    bases = F.filter(F.array(size, size - 1), lambda base: base > 0)
    keyed = words.select("word", "n", F.explode(F.flatten(F.transform(bases, lambda b: frames(F.col("word"), size, b)))).alias("key"))
    held = F.ceil(F.count("*").over(Window.partitionBy("key")) / TILE).cast("int")
    grouped = keyed.select("*", F.count("*").over(Window.partitionBy("key")).alias("group"), held.alias("blocks"))
    block = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    dealt = grouped.where("group > 1").select("key", "word", "n", "blocks", block.alias("block"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least("block", other).alias("i"), F.greatest("block", other).alias("j")),
    )
    tiled = dealt.select("key", "word", "n", F.explode(pairs).alias("tile")).select("key", "tile.i", "tile.j", "word", "n")
    tiled = tiled.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "word")
    return tiled.mapInArrow(_compare, "a string, n_a long, b string, n_b long").distinct()


def variants(words: DataFrame, times: int = 5) -> DataFrame:
    """(``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``) for each of the words (``word``, ``n``), which are distinct.

    ``n_near`` counts the words at one edit. The ``form`` is the one of largest ``n``, ties to the first in code-point
    order, if that is at least ``times`` the word's own, else null. ``root`` is the end of the chain of forms, which
    has no circles as ``n`` rises along it, and the word itself where there is no form. No words give no rows.
    """
    words = materialise(words.select("word", "n"), "words")
    links = materialise(near_words(words), "links")  # read from both ends
    both = links.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("n_near")).union(
        links.select("b", "a", "n_a")
    )
    best = F.min(F.struct((-F.col("n_near")).alias("n"), "near"))
    found = both.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.n") >= times * F.col("n")
    formed = words.join(found, "word", "left").select(
        "word",
        F.when(enough, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, -F.col("best.n")).alias("form_n"),
    )
    formed = materialise(formed, "forms")
    # Each round doubles the steps of the chains, which are few: n is `times` larger after each step.
    chain = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        onward = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        chain = chain.select("word", "root").join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        chain = materialise(chain, "roots")
        if chain.where("moved").isEmpty():
            break
    return formed.join(chain.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
