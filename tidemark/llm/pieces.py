"""Splitting text before byte-pair merges, and the two heaps that merge a piece."""

from __future__ import annotations

import re
from collections.abc import Callable
from heapq import heapify, heappop, heappush

import regex

# Where a run of three blanks, or of two at the end, occurs, cutting before every space would cut
# a piece in two. Python's \s covers every blank of the tokenizers' patterns.
LONG_BLANK = re.compile(r"\s\s(?:\s|\Z)")


class Memo(dict):
    """``compute(key)``, remembered for the first ``limit`` keys."""

    def __init__(self, compute: Callable, limit: int) -> None:
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) < self.limit:
            self[key] = value
        return value


class Splitter:
    """Applies a function to the pieces of texts and remembers it by word.

    ``pattern`` must let a piece hold blanks only in front, or blanks alone. Texts are then cut
    before each space, and what a word and the space in front of it give is looked up at once.
    ``combine`` joins the results of several pieces.
    """

    def __init__(self, pattern: str, piece: Callable, combine: Callable, limit: int = 1 << 19) -> None:
        self.findall = regex.compile(pattern).findall
        self.combine = combine
        self.pieces = Memo(lambda text: piece(text.encode()), limit)
        self.first = Memo(self._whole, limit)
        self.spaced = Memo(lambda word: self._whole(" " + word), limit)

    def _whole(self, text: str):
        return self.combine(map(self.pieces.__getitem__, self.findall(text)))

    def __call__(self, text: str):
        if LONG_BLANK.search(text):
            return self._whole(text)
        words = text.split(" ")
        head = self.first[words[0]] if len(words[0]) < 100 else self._whole(words[0])
        if len(words) == 1:
            return self.combine([head])
        words[0] = None
        rest = map(self.spaced.__getitem__, words[1:])
        return self.combine([head, self.combine(rest)])


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of ``piece``: the adjacent pair whose bytes have the lowest rank merges first, the leftmost on
    ties. A heap over linked bytes, O(n log n)."""
    n = len(piece)
    end = list(range(1, n + 1))  # symbol i is piece[i:end[i]]; 0 once it is part of another
    before = list(range(-1, n))
    rank = ranks.get
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, stop = heappop(heap)
        j = end[i]
        if j == 0 or j >= n or end[j] != stop:
            continue
        end[i], end[j] = stop, 0
        before[stop] = i
        if stop < n and (r := rank(piece[i : end[stop]])) is not None:
            heappush(heap, (r, i, end[stop]))
        if (p := before[i]) >= 0 and (r := rank(piece[p:stop])) is not None:
            heappush(heap, (r, p, stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


def count_merged(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> int:
    """How many symbols are left when the lowest-ranked adjacent pair is merged, leftmost first, until none
    can be. ``merges`` maps a pair to its rank and the symbol it makes. No ids are emitted: the
    count is the number of symbols less the number of merges."""
    n = len(symbols)
    after = list(range(1, n + 1))  # the next symbol still there
    before = list(range(-1, n))
    symbols = list(symbols)
    get = merges.get
    heap = [(*pair, i) for i in range(n - 1) if (pair := get((symbols[i], symbols[i + 1])))]
    heapify(heap)
    count = n
    while heap:
        _, made, i = heappop(heap)
        j = after[i]
        if symbols[i] < 0 or j >= n:
            continue
        pair = get((symbols[i], symbols[j]))
        if pair is None or pair[1] != made:
            continue
        count -= 1
        symbols[i], symbols[j] = made, -1
        k = after[i] = after[j]
        before[k] = i
        if k < n and (pair := get((made, symbols[k]))):
            heappush(heap, (*pair, i))
        if (p := before[i]) >= 0 and (pair := get((symbols[p], made))):
            heappush(heap, (*pair, p))
    return count
