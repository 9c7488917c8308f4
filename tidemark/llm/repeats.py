"""Removal of byte strings that occur more than once, over a difference cover of all positions."""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import forget, materialise, release

CHUNK = 1 << 20  # bytes of text in a chunk, but for longer single texts; a task needs some 150 times as many
PART = 16 << 20  # bytes of text for each bucket


@lru_cache(maxsize=4)
def difference_cover(prime: int) -> tuple[int, np.ndarray]:
    """A period v = q*q + q + 1 and the q + 1 residues such that every difference mod v is one of two of them.

    Singer's construction: the zeros of a linear recurrence of order three over the integers mod q.
    """
    period = prime * prime + prime + 1
    for a, b, c in itertools.product(range(prime), range(prime), range(1, prime)):
        x, y, z, zeros = 0, 0, 1, []
        for i in range(period):
            if x == 0:
                zeros.append(i)
            x, y, z = y, z, (a * z + b * y + c * x) % prime
        if len(zeros) == prime + 1 and len({(i - j) % period for i in zeros for j in zeros}) == period:
            return period, np.array(zeros)
    raise ValueError(f"no difference cover for {prime}")


class Fingerprints:
    """128-bit polynomial fingerprints of any substring of ``data``: two prefix sums with wrapping."""

    def __init__(self, data: np.ndarray) -> None:
        self.sums = []
        rng = np.random.default_rng(20240229)
        for _ in range(2):
            codes = rng.integers(1, 2**63, 256, np.uint64)
            base = int(rng.integers(1, 2**62)) * 2 + 1
            sums = np.zeros(len(data) + 1, np.uint64)
            terms = codes[data]
            terms *= self._powers(base, len(data))
            np.cumsum(terms, out=sums[1:])
            del terms
            self.sums.append((sums, self._powers(pow(base, -1, 1 << 64), len(data) + 1)))

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[:1] = 1
        return np.cumprod(out, out=out)

    def of(self, start: np.ndarray, stop: np.ndarray, which: int) -> np.ndarray:
        sums, inverse = self.sums[which]
        out = (sums[stop] - sums[start]) * inverse[start]
        return (out ^ (out >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)


def unique_rows(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort rows; return the order, the number of each sorted row's run, and the first of each run."""
    order = np.lexsort(columns[::-1]) if len(columns) > 1 else np.argsort(columns[0], kind="stable")
    new = np.ones(len(order), bool)
    if len(order) > 1:
        new[1:] = False
        for column in columns:
            sorted_ = column[order]
            new[1:] |= sorted_[1:] != sorted_[:-1]
    return order, np.cumsum(new) - 1, np.flatnonzero(new)


class Chunk:
    """One chunk in a task, and what the rounds so far have told about it."""

    def __init__(self, blob: bytes, ends: Sequence[int], size: int, prime: int) -> None:
        self.data = np.frombuffer(blob, np.uint8)
        self.ends = np.asarray(ends, np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.size = size
        self.period, cover = difference_cover(prime)
        self.short = size - self.period + 1
        self.prints = Fingerprints(self.data)
        own, lo, hi = [], [], []
        for start, stop in zip(self.starts.tolist(), self.ends.tolist(), strict=True):
            if stop - start >= size:
                p = (start + np.arange(0, stop - start, self.period)[:, None] + cover[None, :]).ravel()
                p = p[p + self.short <= stop]
                own.append(p)
                lo.append(np.full(len(p), start))
                hi.append(np.full(len(p), stop))
        join = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
        self.at, self.lo, self.hi = join(own), join(lo), join(hi)
        self.rank = self.prints.of(self.at, self.at + self.short, 0)

    def asked(self, columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """The distinct rows in order, whether each occurs twice here, and which distinct row each row is."""
        order, run, first = unique_rows(columns)
        twice = np.bincount(run, minlength=len(first)) > 1 if len(run) else np.zeros(0, bool)
        which = np.empty(len(order), np.int64)
        which[order] = run
        return [column[order][first] for column in columns], twice, which

    def samples(self):
        """Round one: the cover samples, by the string that they start."""
        return self.asked([self.rank])

    def contexts(self, shared: np.ndarray):
        """Round two: shared samples with everything that a string of ``size`` bytes over them can hold."""
        _, _, which = self.samples()
        self.kept = np.flatnonzero(shared[which])
        at = self.at[self.kept]
        self.first = np.maximum(self.lo[self.kept], at - self.period + 1)
        self.stop = np.minimum(self.hi[self.kept], at + self.size)
        cut = ((at - self.first) << 20 | (self.stop - at)).astype(np.uint64)
        hashes = [self.prints.of(self.first, self.stop, i) + cut * np.uint64(0x9E3779B97F4A7C15) for i in (0, 1)]
        return self.asked([self.rank[self.kept], *hashes])

    def windows(self, shared: np.ndarray, told: np.ndarray):
        """Round three: the whole strings in contexts that differ from others of their sample's class.

        ``told`` has bit 1 for contexts that occur twice, all of whose strings do, and bit 2 for those to walk.
        """
        _, _, which = self.contexts(shared)
        told = told[which]
        last = self.stop - self.size
        n = len(self.data)

        def covered(chosen: np.ndarray) -> np.ndarray:
            step = np.zeros(n + 2, np.int32)
            np.add.at(step, self.first[chosen], 1)
            np.add.at(step, np.maximum(last[chosen] + 1, self.first[chosen]), -1)
            return np.cumsum(step, out=step)[:n] > 0

        self.repeated = covered((told & 1) > 0)
        self.walked = np.flatnonzero(covered((told & 2) > 0))
        return self.asked([self.prints.of(self.walked, self.walked + self.size, i) for i in (0, 1)])

    def removed(self, shared: np.ndarray, told: np.ndarray, same: np.ndarray) -> np.ndarray:
        """A mask of the bytes that a repeated string covers."""
        _, _, which = self.windows(shared, told)
        self.repeated[self.walked[same[which] > 0]] = True
        at = np.flatnonzero(self.repeated)
        step = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(step, at, 1)
        np.add.at(step, at + self.size, -1)
        return np.cumsum(step, out=step)[:-1] > 0


def pack_keys(columns: list[np.ndarray]) -> bytes:
    return np.stack(columns, 1).tobytes() if len(columns) > 1 else columns[0].tobytes()


def answer(replies: Sequence[dict] | None, count: int) -> np.ndarray:
    """Replies of all buckets, put together in the order of the keys."""
    if not replies:
        return np.zeros(count, np.uint8)
    return np.concatenate([np.frombuffer(r["reply"], np.uint8) for r in sorted(replies, key=lambda r: r["part"])])


def make_chunks(docs: DataFrame, text: Column, keep: Sequence[str]) -> DataFrame:
    """Rows of (``chunk``, ``blob``, ``ends``, ``kept``): texts end to end, compressed, and where each ends."""
    fields = docs.select(*[F.col(f"`{name}`") for name in keep]).schema.fields
    kept = T.StructType([T.StructField(f"k{i}", f.dataType) for i, f in enumerate(fields)])
    narrow = docs.select(
        F.struct(*[F.col(f"`{name}`").alias(f"k{i}") for i, name in enumerate(keep)]).alias("k"), text.alias("t")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        chunk = TaskContext.get().partitionId() << 33
        texts: list[bytes] = []
        keys: list[pa.Array] = []
        held = 0

        def close() -> pa.RecordBatch:
            k = pa.concat_arrays(keys)
            blob = pa.compress(b"".join(texts), codec="zstd", asbytes=True)
            ends = np.cumsum([len(t) for t in texts])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk], pa.int64()),
                    pa.array([blob], pa.binary()),
                    pa.array([ends.tolist()], pa.list_(pa.int64())),
                    pa.ListArray.from_arrays(pa.array([0, len(k)], pa.int32()), k),
                ],
                names=["chunk", "blob", "ends", "kept"],
            )

        for batch in batches:
            column, start = batch.column(1).to_pylist(), 0
            for i, value in enumerate(column):
                texts.append(value.encode())
                held += len(texts[-1])
                if held >= CHUNK:
                    keys.append(batch.column(0).slice(start, i + 1 - start))
                    yield close()
                    texts, keys, held, chunk, start = [], [], 0, chunk + 1, i + 1
            if start < len(column):
                keys.append(batch.column(0).slice(start))
        if texts:
            yield close()

    schema = T.StructType([
        T.StructField("chunk", T.LongType()),
        T.StructField("blob", T.BinaryType()),
        T.StructField("ends", T.ArrayType(T.LongType())),
        T.StructField("kept", T.ArrayType(kept)),
    ])
    return narrow.mapInArrow(run, schema)


def remove_repeats(
    docs: DataFrame,
    text: str | Column = "text",
    keep: Sequence[str] = ("doc_id",),
    size: int = 200,
    prime: int = 11,
) -> DataFrame:
    """The ``keep`` columns, ``n_bytes``, ``n_removed``, ``n_spans`` and ``remaining`` (binary) of every row.

    Every byte goes that is covered by a string of ``size`` bytes that also starts anywhere else, in the same
    text or another; strings are judged on the input and never cross texts.

    Positions of a difference cover of period v (133 by default, 12 of them) are the samples: for
    any two positions some shift below v moves both onto samples. A sample's rank is the class of the string of
    ``size`` - v + 1 bytes it starts, so equal long strings always hold two samples of one rank at the same shift.
    Samples are dealt into buckets by rank, and equal fingerprints of one bucket are grouped; no suffix is sorted. Within a class,
    contexts that agree over all strings that can hold the sample settle them at once; only
    contexts that differ are walked string by string, one copy of each. Order among strings is that of 128-bit
    fingerprints, as equality is all that counts. A chunk asks for each key once, so that a
    bucket grows with distinct strings in chunks and not with copies inside.

    A null or empty text has nothing to remove. Repeated rows are copies of each other.
    """
    spark = docs.sparkSession
    text = F.col(text) if isinstance(text, str) else text
    chunks = materialise(make_chunks(docs, F.coalesce(text.cast("string"), F.lit("")), keep), "chunks")
    n_bytes = chunks.agg(F.sum(F.element_at("ends", -1))).first()[0] or 0
    parts = max(16, -(-n_bytes // PART))

    def ask(told: list[DataFrame], width: int, classes: bool) -> DataFrame:
        rounds, frame = len(told), chunks.select("chunk", "blob", "ends")
        for i, replies in enumerate(told):
            frame = frame.join(replies.withColumnRenamed("replies", f"r{i}").hint("merge"), "chunk", "left")

        def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in (batch.slice(n, 1).to_pylist()[0] for batch in batches for n in range(batch.num_rows)):
                columns, twice, _ = question(row, rounds, size, prime)
                # Buckets are ranges of the leading fingerprint.
                edges = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)
                cuts = [0, *np.searchsorted(columns[0], edges).tolist(), len(twice)]
                out = [
                    (row["chunk"], p, pack_keys([c[a:b] for c in columns]), twice[a:b].tobytes())
                    for p, (a, b) in enumerate(itertools.pairwise(cuts))
                    if a < b
                ]
                if out:
                    yield pa.RecordBatch.from_pydict(dict(zip(("chunk", "part", "keys", "twice"), zip(*out), strict=True)))
            forget()

        def sort(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("chunk")
            rows = np.frombuffer(b"".join(group["keys"]), np.uint64).reshape(-1, width)
            twice = np.frombuffer(b"".join(group["twice"]), np.bool_)
            order, run, first = unique_rows([rows[:, i] for i in range(width)])
            many = (np.bincount(run) > 1) | (np.bincount(run, weights=twice[order]) > 0)
            flags = many[run].astype(np.uint8)
            if classes:
                # The first row of a context walks it when its class has other contexts.
                ranks = rows[order, 0][first]
                _, of, heads = unique_rows([ranks])
                flags[first] |= (np.bincount(of)[of] > 1).astype(np.uint8) << 1
            reply = np.empty(len(order), np.uint8)
            reply[order] = flags
            cuts = np.cumsum([0, *(len(x) for x in group["twice"])])
            return pd.DataFrame({
                "chunk": group["chunk"],
                "part": group["part"],
                "reply": [reply[a:b].tobytes() for a, b in itertools.pairwise(cuts)],
            })

        asked = frame.mapInArrow(keys, "chunk long, part long, keys binary, twice binary")
        replies = asked.repartition(min(parts, 20_000), "part").groupBy("part").applyInPandas(
            sort, "chunk long, part long, reply binary"
        )
        told = materialise(
            replies.groupBy("chunk").agg(F.collect_list(F.struct("part", "reply")).alias("replies")), "replies"
        )
        release(spark)
        return told

    shared = ask([], 1, False)
    told = ask([shared], 3, True)
    same = ask([shared, told], 2, False)

    frame = chunks
    for i, replies in enumerate([shared, told, same]):
        frame = frame.join(replies.withColumnRenamed("replies", f"r{i}").hint("merge"), "chunk", "left")
    kept_type = chunks.schema["kept"].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                one = batch.slice(n, 1)
                row = one.select(["blob", "ends", "r0", "r1", "r2"]).to_pylist()[0]
                chunk, replies = told_chunk(row, 3, size, prime)
                gone = chunk.removed(*replies)
                sizes, removed, spans, remaining = [], [], [], []
                for start, stop in zip(chunk.starts.tolist(), chunk.ends.tolist(), strict=True):
                    own = gone[start:stop]
                    sizes.append(stop - start)
                    removed.append(int(own.sum()))
                    spans.append(int((own[1:] & ~own[:-1]).sum() + own[0]) if len(own) else 0)
                    remaining.append(chunk.data[start:stop][~own].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        one.column("kept").flatten(),
                        *[pa.array(x, pa.int64()) for x in (sizes, removed, spans)],
                        pa.array(remaining, pa.binary()),
                    ],
                    names=["kept", "n_bytes", "n_removed", "n_spans", "remaining"],
                )
        forget()

    schema = T.StructType([
        T.StructField("kept", kept_type.elementType),
        *[T.StructField(name, T.LongType()) for name in ("n_bytes", "n_removed", "n_spans")],
        T.StructField("remaining", T.BinaryType()),
    ])
    out = frame.select("chunk", "blob", "ends", "kept", "r0", "r1", "r2").mapInArrow(cut, schema)
    return out.select(
        *[F.col(f"kept.k{i}").alias(name) for i, name in enumerate(keep)],
        "n_bytes",
        "n_removed",
        "n_spans",
        "remaining",
    )


def told_chunk(row: dict, rounds: int, size: int, prime: int) -> tuple[Chunk, list[np.ndarray]]:
    """The chunk of a row and the answers to its first ``rounds`` questions."""
    total = row["ends"][-1] if row["ends"] else 0
    chunk = Chunk(pa.decompress(row["blob"], total, codec="zstd", asbytes=True) if total else b"", row["ends"], size, prime)
    replies: list[np.ndarray] = []
    for i in range(rounds):
        columns, _, _ = (chunk.samples, chunk.contexts, chunk.windows)[i](*replies)
        replies.append(answer(row[f"r{i}"], len(columns[0])))
    return chunk, replies


def question(row: dict, rounds: int, size: int, prime: int):
    chunk, replies = told_chunk(row, rounds, size, prime)
    return (chunk.samples, chunk.contexts, chunk.windows)[rounds](*replies)
