"""Join of documents whose word n-gram sets are alike, by an exact prefix index."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from tidemark.llm.common import (
    LINKS,
    discard,
    forget,
    in_few_tasks,
    map_rows,
    materialise,
    release,
    slices,
    smallest_reachable,
    stars,
)
from tidemark.llm.pieces import Memo

CELLS = 1 << 16  # cells of the count sketch in one row
TEXT = 2 << 20  # bytes of text whose words are looked up together
PARITIES = 8  # 64-bit words of a set's parities
TURNS = 6  # at most so many turns join components before what is left is paired,
SHINGLES = 500_000  # a step takes a task for so many n-grams, if a shuffle would give it more,
PAIRS = 2_000  # or for so many pairs
FEW = 4  # and none after one in which at most one of so many compared pairs was alike
ODD = 0x9E3779B97F4A7C15


def mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return keys ^ (keys >> np.uint64(29))


class Shingles:
    """The sorted distinct 64-bit fingerprints of a text's word n-grams.

    A-Z are lower-cased and words are runs of other than ASCII blanks. A text with fewer than ``width``
    words is one n-gram; one without words has none.
    """

    def __init__(self, width: int) -> None:
        self.width = width
        self.memo = Memo(xxh3_64_intdigest, 1 << 19)

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()
        if not words:
            return np.empty(0, np.uint64)
        codes = np.fromiter(map(self.memo.__getitem__, words), np.uint64, len(words))
        return np.unique(self._rolled(codes, min(self.width, len(words))))


    def of_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The fingerprints of each text, as for one; the words of all are cut and looked up together."""
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()  # faster than to_pylist
        codes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))[coded.indices.to_numpy()]
        # Blanks at either end of a text leave empty words.
        real = np.array([len(word) > 0 for word in words], bool)[coded.indices.to_numpy()]
        places = split.offsets.to_numpy()
        ends = np.concatenate([[0], np.cumsum(real)])[places - places[0]]
        codes = codes[real]
        rolled = self._rolled(codes, self.width) if len(codes) >= self.width else codes[:0]
        for start, stop in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            n = stop - start
            if n >= self.width:
                yield np.unique(rolled[start : stop - self.width + 1])
            else:
                yield np.unique(self._rolled(codes[start:stop], n)) if n else codes[:0]

    @staticmethod
    def _rolled(codes: np.ndarray, width: int) -> np.ndarray:
        n = len(codes) - width + 1
        out = np.full(n, width, np.uint64)
        for i in range(width):
            out = mixed(out * np.uint64(ODD) + codes[i : i + n])
        return out


def parities(own: np.ndarray) -> np.ndarray:
    """For each of 64 * `PARITIES` cells, whether an odd number of n-grams falls in it. Two sets whose parities differ
    in d cells differ in at least d n-grams."""
    bits = np.bincount((own >> np.uint64(40)).astype(np.int64) % (64 * PARITIES), minlength=64 * PARITIES) % 2
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def rareness(counts: np.ndarray) -> np.ndarray:
    """The order of counts in a byte each: 0 for a count of one, then steps of a quarter of a doubling."""
    return np.rint(4 * np.log2(np.maximum(counts, 1).astype(np.float64))).astype(np.uint8)


def planes(counts: np.ndarray) -> bytes:
    """32-bit counts as all their first bytes, then all their second ones, and so on: most are small, and so planes
    compress to about half of what rows of numbers do."""
    return np.ascontiguousarray(counts.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def sketch(docs: DataFrame, text: Column, width: int, cells: int) -> np.ndarray:
    """How many texts hold an n-gram of each cell, over all texts, as `rareness`; ``cells`` bytes, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        shingles, counts = Shingles(width), np.zeros(cells, np.uint32)
        for batch in batches:
            for _, texts in slices(batch.column(0), TEXT):
                own = np.concatenate([*shingles.of_all(texts), np.empty(0, np.uint64)])
                np.add.at(counts, (own % np.uint64(cells)).astype(np.int64), np.uint32(1))
        for block in range(0, cells, CELLS):
            packed = zlib.compress(planes(counts[block : block + CELLS]), 1)
            yield pa.RecordBatch.from_pydict({"block": [block], "counts": [packed]})
        del counts
        forget()

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(min(CELLS, cells), np.uint64)
        for packed in group["counts"]:
            total += from_planes(zlib.decompress(packed))
        return pd.DataFrame({"block": group["block"].iloc[:1], "counts": [rareness(total).tobytes()]})

    schema = "block long, counts binary"
    parts = docs.select(text.alias("t")).mapInArrow(run, schema)
    rows = parts.groupBy("block").applyInPandas(add, schema).collect()  # a fixed number of cells
    out = np.zeros(cells, np.uint8)
    for row in rows:
        out[row["block"] : row["block"] + CELLS] = np.frombuffer(row["counts"], np.uint8)
    return out


def alike(
    docs: DataFrame,
    text: str | Column = "text",
    id: str = "doc_id",
    width: int = 5,
    percent: int = 75,
) -> DataFrame:
    """(``id``, ``n_shingles``, ``component_id``) of every row.

    Components are all that comes out: links are neither listed nor counted, and pairs inside a component found so far are
    not verified.

    Two rows link when 100 * intersection >= ``percent`` * union of their n-gram sets. The component is
    the smallest id reachable by links; no link is lost.

    Equal sets are one set first. N-grams are ordered from rare to frequent by a count sketch over all
    texts, and the index lists each set under its first n-grams only, as many as a partner must share one
    of. Each set is compared with the set that heads most of its lists; one that is alike
    passes its component on, which answers for all sets of that component. Only lists that still hold several
    components are walked, and there pairs are skipped by size, by position in the set and by the parities of
    n-grams in a few hundred cells, which bound from below how many n-grams two sets differ in.

    A null or empty text has no n-grams and links with nothing. Rows with a null id have a null
    component. Rows of one id are one document, which links where any of them does; each row is returned. Other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.col(text) if isinstance(text, str) else text
    text = F.coalesce(text.cast("string"), F.lit(""))
    cells = max(1 << 18, min(1 << 24, 1 << int(64 * docs.count()).bit_length()))
    counts = spark.sparkContext.broadcast(sketch(docs, text, width, cells))

    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        shingles, order = Shingles(width), counts.value
        for batch in batches:
            sizes, digests, first, odd = [], [], [], []
            for own in (own for _, texts in slices(batch.column("_0"), TEXT) for own in shingles.of_all(texts)):
                n = len(own)
                sizes.append(n)
                odd.append(parities(own))
                digests.append(xxh3_128_digest(own.tobytes()) if n else None)
                held = order[(own % np.uint64(cells)).astype(np.int64)]
                head = np.argsort(held, kind="stable")[: n - -(-n * percent // 100) + 1 if n else 0]
                # The sketch never counts too few: an n-gram whose cell counts one is in no other text.
                first.append(pa.array(own[head].view(np.int64), mask=held[head] == 0))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(
                        np.cumsum([0, *map(len, first)]).astype(np.int32),
                        pa.concat_arrays([pa.array([], pa.int64()), *first]),
                    ),
                    pa.array(odd, pa.list_(pa.int64())),
                ],
                names=[*batch.schema.names[:-1], "n", "digest", "first", "odd"],
            )
        forget()

    outputs = [
        T.StructField("n", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("first", T.ArrayType(T.LongType())),
        T.StructField("odd", T.ArrayType(T.LongType())),
    ]
    rows = docs.select(F.col(f"`{id}`").alias("id"), text.alias("text"))
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    signed = materialise(map_rows(numbered, ["id", "row"], [F.col("text")], outputs, signatures), "set-signatures")
    size = signed.agg(F.sum("n")).first()[0] or 0

    def written(table: DataFrame, label: str) -> DataFrame:
        """Small inputs are written in fewer tasks than a shuffle has partitions: most tables here are small."""
        return materialise(in_few_tasks(table, size, SHINGLES, 32), label)

    # A class takes its set's lists along, which move once and need no join with the signatures.
    own = F.min_by(F.struct("id", "n", "first", "odd"), F.struct("id", "row")).alias("own")
    same = signed.where("n > 0 AND id IS NOT NULL").groupBy("digest").agg(own)
    same = written(same.select("digest", F.col("own.id").alias("rep"), "own.n", "own.first", "own.odd"), "set-classes")
    # An id may have several texts and so several sets, whose places must not be counted as one set's.
    several = same.groupBy("rep").agg(F.count("*").alias("sets")).where("sets > 1")
    several = written(several.select("rep", F.lit(True).alias("several")), "set-several")
    reps = same.join(several, "rep", "left").select(
        F.col("rep").alias("id"), "n", F.coalesce("several", F.lit(False)).alias("several"), "first"
    )
    places = reps.select("id", "n", "several", F.posexplode("first").alias("pos", "tok")).where("tok IS NOT NULL")
    # One shuffle of few columns puts the lists together; most hold one set and go.
    place = F.col("n") * 2**31 + F.col("pos")
    places = places.select("tok", "id", F.when(F.col("several"), -1 - place).otherwise(place).alias("place"))
    own_list = Window.partitionBy("tok")
    head, last = F.min(F.struct("id", "place")).over(own_list), F.max("id").over(own_list)
    listed = places.select("*", head.alias("head"), last.alias("last")).where("head.id < last")

    def size_and_place(column: str, before: str) -> list[Column]:
        place = F.when(F.col(column) < 0, -1 - F.col(column)).otherwise(F.col(column))
        return [
            F.shiftright(place, 31).alias(f"{before}n"),
            place.bitwiseAND(2**31 - 1).cast("int").alias(f"{before}pos"),
            (F.col(column) < 0).alias(f"{before}several"),
        ]

    listed = listed.select(
        "tok", "id", *size_and_place("place", ""), F.col("head.id").alias("head"), *size_and_place("head.place", "head_")
    )
    listed = written(listed, "set-lists")
    release(spark)

    def can_link(shared: Column, n: Column, pos: Column, other_n: Column, other_pos: Column) -> Column:
        """Whether two sets can be alike that share so many of the first n-grams, the last of them at these places: what
        else they share comes later in both."""
        most = shared + F.least(n - pos, other_n - other_pos) - 1
        return (most * (100 + percent) >= (n + other_n) * percent) & (100 * F.least(n, other_n) >= percent * F.greatest(n, other_n))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [value.as_buffer() for value in batch.column("_0")]
            columns = [
                pa.array([pa.compress(one, codec="zstd", asbytes=True) for one in texts], pa.binary()),
                pa.array([one.size for one in texts], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *columns], names=[*batch.schema.names[:-1], "packed", "size"]
            )

    outputs = [T.StructField("packed", T.BinaryType()), T.StructField("size", T.LongType())]
    packed = map_rows(rows, ["id"], [F.col("text").cast("binary")], outputs, pack)

    def verify(pairs: DataFrame) -> tuple[DataFrame, int]:
        """Those of the written ``pairs`` (a, b, ..) that link, and how many were compared."""
        compared = pairs.count()
        named = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
        # Texts travel compressed, which is far less than their sets.
        needed = written(packed.join(named, "id", "left_semi"), "set-texts")

        @F.pandas_udf("boolean")
        def linked(x: pd.Series, x_size: pd.Series, y: pd.Series, y_size: pd.Series) -> pd.Series:
            shingles, out = Shingles(width), []
            for a, a_size, b, b_size in zip(x, x_size, y, y_size, strict=True):
                texts = [pa.decompress(one, size, codec="zstd", asbytes=True) for one, size in ((a, a_size), (b, b_size))]
                both = np.concatenate(list(shingles.of_all(pa.array(texts, pa.binary()).cast(pa.string()))))
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                out.append(100 * common >= percent * (len(both) - common))
            return pd.Series(out, dtype=bool)

        left = needed.select(F.col("id").alias("a"), F.col("packed").alias("x"), F.col("size").alias("x_size"))
        right = needed.select(F.col("id").alias("b"), F.col("packed").alias("y"), F.col("size").alias("y_size"))
        joined = pairs.join(left, "a").join(right, "b")
        links = joined.where(linked("x", "x_size", "y", "y_size")).select(*pairs.columns)
        links = materialise(in_few_tasks(links, compared, PAIRS, 32), "set-links")
        discard(pairs, needed)
        release(spark)
        return links, compared

    # First each set with the head of most of its lists, of those that it can be alike to as far as these lists tell.
    votes = listed.where("head <> id").groupBy("id", "head").agg(
        F.count("*").alias("votes"), F.max("n").alias("n"), F.max("pos").alias("pos"),
        F.max("head_n").alias("head_n"), F.max("head_pos").alias("head_pos"),
        F.max(F.col("several") | F.col("head_several")).alias("several"),
    )
    votes = votes.where(F.col("several") | can_link(*map(F.col, ("votes", "n", "pos", "head_n", "head_pos"))))
    best = votes.groupBy("id").agg(F.max_by("head", F.struct("votes", -F.col("head"))).alias("head"))
    links, _ = verify(written(best.select(F.col("head").alias("a"), F.col("id").alias("b")), "set-pairs"))
    root = smallest_reachable(same.select(F.col("rep").alias("id")).distinct(), links)
    discard(links)

    def joined_by(links: DataFrame, root: DataFrame) -> DataFrame:
        """The components after ``links`` (``root_a``, ``root_b``) have joined some of them."""
        moved = stars(links.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
        to = moved.select(F.col("hi").alias("root"), F.col("lo").alias("to"))
        after = root.join(to, "root", "left").select("id", F.coalesce("to", "root").alias("root"))
        after = materialise(in_few_tasks(after, root.count(), LINKS, 8), "set-roots")
        discard(moved, links, root)
        return after

    def still_open(lists: DataFrame, label: str) -> DataFrame:
        """The lists that hold several components."""
        named = lists.join(root, "id")
        named = named.select("*", F.min("root").over(own_list).alias("lo"), F.max("root").over(own_list).alias("hi"))
        return written(named.where("lo < hi").drop("lo", "hi"), label)

    # Then what lists with several components leave open.
    lists = still_open(listed.drop("head", "head_n", "head_pos", "head_several"), "set-open-lists")
    odd = same.select(F.col("rep").alias("id"), *[F.col("odd")[i].alias(f"odd{i}") for i in range(PARITIES)])
    held = written(lists.join(odd.join(lists.select("id").distinct(), "id", "left_semi"), "id"), "set-open")
    discard(listed, lists)
    names = ("id", "n", "pos", "several", "root", *[f"odd{i}" for i in range(PARITIES)])

    def left_open(one: Callable[[str], Column], two: Callable[[str], Column]) -> Column:
        """Whether sets of two components that meet in a list can be alike, by their sizes, places and parities."""
        need = (one("n") + two("n")) * percent  # intersection * (100 + percent) must reach it
        reach = 1 + F.least(one("n") - one("pos") - 1, two("n") - two("pos") - 1) + F.least(one("pos"), two("pos"))
        return (
            (100 * F.least(one("n"), two("n")) >= percent * F.greatest(one("n"), two("n")))
            & (reach * (100 + percent) >= need)
            & (apart(one, two) * (100 + percent) <= (one("n") + two("n")) * (100 - percent))
        )

    def apart(one: Callable[[str], Column], two: Callable[[str], Column]) -> Column:
        return sum(F.bit_count(one(f"odd{i}").bitwiseXOR(two(f"odd{i}"))) for i in range(PARITIES))

    def first_shared(one: Callable[[str], Column], two: Callable[[str], Column]) -> Column:
        """Whether the list's n-gram can be the first that two alike sets share: all that they share is at its place or
        later. Two sets that share a passage meet in each of its n-grams, but few of them are as early as that."""
        return F.least(one("n") - one("pos"), two("n") - two("pos")) * (100 + percent) >= (one("n") + two("n")) * percent

    # Near copies of one text need not be alike to the head, and would all be paired. So each set is compared
    # with one more of those that it meets, the nearest by parities of one set drawn from each list, as long as many of
    # them are alike. What is not found in these turns is found by the pairs of all.
    for turn in range(TURNS):
        drawn = F.min(F.struct(F.xxhash64(F.lit(turn), "tok", "id").alias("draw"), *names)).over(own_list)
        met = held.select("*", drawn.alias("drawn"))
        one, two = F.col, lambda name: F.col(f"drawn.{name}")
        met = met.where((one("root") != two("root")) & left_open(one, two))
        near = met.select(
            "id", "root", two("id").alias("other"), two("root").alias("other_root"),
            (apart(one, two) / (one("n") + two("n"))).alias("apart"),
        )
        best = near.groupBy("id", "root").agg(F.min(F.struct("apart", "other", "other_root")).alias("best"))
        ends = [F.struct(F.col(c).alias("id"), F.col(r).alias("root")) for c, r in (("id", "root"), ("best.other", "best.other_root"))]
        best = best.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()
        best = best.select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), F.col("a.root").alias("root_a"), F.col("b.root").alias("root_b"))
        links, compared = verify(written(best, "set-pairs"))
        few = FEW * links.count() <= compared
        root = joined_by(links, root)
        before, held = held, still_open(held.drop("root"), "set-open")
        discard(before)
        if few:
            break
    x = held.select("tok", *[F.col(c).alias(f"{c}_1") for c in names])
    y = held.select("tok", *[F.col(c).alias(f"{c}_2") for c in names])
    sides = [lambda name, i=i: F.col(f"{name}_{i}") for i in (1, 2)]
    pairs = (
        x.join(y, "tok")
        .where(F.col("root_1") < F.col("root_2"))
        .where(left_open(*sides) & first_shared(*sides))
        # Two components meet in open lists only, and what a pair shares is in one order in both: what is not counted here
        # comes later in both than what is.
        .groupBy(F.col("id_1").alias("a"), F.col("id_2").alias("b"))
        .agg(
            F.count("*").alias("shared"),
            F.max(F.col("several_1") | F.col("several_2")).alias("several"),
            *[F.max(f"{c}_{i}").alias(f"{c}_{i}") for c in ("n", "pos", "root") for i in (1, 2)],
        )
        .where(F.col("several") | can_link(*map(F.col, ("shared", "n_1", "pos_1", "n_2", "pos_2"))))
        .select("a", "b", F.col("root_1").alias("root_a"), F.col("root_2").alias("root_b"))
    )
    links, _ = verify(materialise(pairs, "set-pairs"))
    root = joined_by(links, root)
    discard(held)
    rooted = same.join(root.withColumnRenamed("id", "rep"), "rep").select("digest", "root")
    told = signed.join(rooted, "digest", "left").select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("root", "id")).alias("component_id"),
    )
    told = written(told, "set-components")
    discard(signed, same, several, root)
    release(spark)
    return told
