"""Near-duplicate vectors by Euclidean p-stable hashing, and exact cosine checks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import materialise, smallest_reachable


LEAST = 4  # projections of a table


def usable(vector: str):
    """True for vectors that are not null or empty, with finite components only, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors: pd.Series) -> np.ndarray:
    rows = np.stack([np.asarray(v, np.float64) for v in vectors])
    rows /= np.abs(rows).max(1, keepdims=True)  # squares of tiny or huge components stay finite
    return rows / np.sqrt((rows * rows).sum(1))[:, None]


def projections(dim: int, tables: int, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim])
    return rng.standard_normal((dim, tables * width)), rng.random(tables * width)


def meeting(distance: float, step: float) -> float:
    """The probability that two vectors at a distance share a cell of one projection (Datar et al., 2004)."""
    r = step / distance
    return 1 - math.erfc(r / math.sqrt(2)) - math.sqrt(2 / math.pi) / r * (1 - math.exp(-r * r / 2))


def hashing(n: int, threshold: float, step: float, recall: float, bucket: int) -> tuple[int, int]:
    """(projections of a table, tables) for ``n`` vectors.

    So many projections that vectors at right angles leave about ``bucket`` in one, whatever ``n`` is, and so many tables that a
    pair at the threshold meets with probability ``recall``. Tables grow as the power 0.27 of ``n`` at the defaults.
    """
    near = meeting(math.sqrt(2 - 2 * threshold), step)
    width = max(LEAST, math.ceil(math.log(max(1.0, n / bucket)) / -math.log(meeting(math.sqrt(2), step))))
    return width, math.ceil(math.log(1 - recall) / math.log(1 - near**width))


def local_roots(linked: np.ndarray) -> np.ndarray:
    """The smallest index each row reaches over a symmetric boolean matrix."""
    root = np.arange(len(linked))
    while True:
        least = np.where(linked, root[None, :], len(linked)).min(1)
        low = np.minimum(root, least)
        low = low[low]
        if (low == root).all():
            return root
        root = low


def near_vectors(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.9,
    recall: float = 0.991,
    bucket: int = 64,
    step: float = 2.0,
    block: int = 1024,
    seed: int = 7,
) -> DataFrame:
    """(``id``, ``n_links``, ``component_id``, ``kept``) of every row.

    Normalised vectors are projected on Gaussian directions; some projections, shifted and cut
    at multiples of ``step``, name a bucket in each of some tables. How many follows from the number of distinct vectors
    (see `hashing`): a pair at the threshold shares a bucket with probability ``recall``, closer ones with more, and
    a bucket holds about ``bucket`` unrelated vectors at every size. Pairs that share a
    bucket are checked by their cosine in double precision; a pair is counted in the first table
    in which it meets, so no list of pairs is made.

    Equal vectors are one row with a weight first. A bucket of more than ``block`` vectors is cut
    into blocks, and each pair of blocks is a group of its own, so a group is bounded.

    Null, empty or zero vectors and those with null or non-finite components have no links and are
    components by themselves; so have vectors of another length none with each other. Every row is returned and counts by
    itself, so rows that share an id or have none link with each other like any others. ``component_id`` is the smallest
    id of the component, null if none has one, and ``kept`` is true for one row of it, that with this id. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{id}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    rows = materialise(rows.select("*", usable("v").alias("ok"), F.monotonically_increasing_id().alias("row")), "vectors")
    good = rows.where("ok").withColumn("h", F.sha2(F.to_json(F.struct("v")), 256))
    least = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row"))
    same = good.groupBy("h").agg(least.alias("least"), F.count("*").alias("weight"))
    member = materialise(good.join(same, "h").select("id", "row", "least", "weight", "v"), "vector-members")
    first = member.where("row = least.row")
    reps = first.select(F.col("row").alias("id"), "weight", "v")  # ids from here on are row numbers

    width, tables = hashing(same.count(), threshold, step, recall, bucket)

    @F.pandas_udf("array<bigint>")
    def keys(batch: pd.Series) -> pd.Series:
        out: list = [None] * len(batch)
        sizes = batch.map(len).to_numpy()
        for dim in np.unique(sizes):
            at = np.flatnonzero(sizes == dim)
            directions, shift = projections(int(dim), tables, width, seed)
            cells = np.floor(unit(batch.iloc[at]) @ directions / step + shift).astype(np.int64)
            mix = np.random.default_rng([seed, 1]).integers(1, 2**62, width, np.int64) | 1
            with np.errstate(over="ignore"):
                cells = (cells.reshape(len(at), tables, width) * mix).sum(2) * 31 + int(dim)
            for i, row in zip(at, cells, strict=True):
                out[i] = row
        return pd.Series(out)

    hashed = materialise(reps.withColumn("keys", keys("v")), "vector-keys")
    places = hashed.select("id", F.posexplode("keys").alias("t", "key"))
    # Only buckets with company are dealt out, each row to the pairs of blocks that hold it.
    sizes = places.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("long")
    own = F.pmod(F.xxhash64("id"), F.col("blocks"))
    dealt = (
        places.join(sizes.withColumn("blocks", blocks), ["t", "key"])
        .withColumn("own", own)
        .select("id", "t", "key", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("id", "t", "key", "own", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
    )
    met = dealt.join(hashed.select("id", "weight", "v", "keys"), "id")

    def check(group: pd.DataFrame, units: np.ndarray, keys: np.ndarray) -> pd.DataFrame | None:
        n, t = len(group), int(group["t"].iloc[0])
        linked = np.zeros((n, n), bool)
        for lo in range(0, n, 512):
            linked[lo : lo + 512] = units[lo : lo + 512] @ units.T >= threshold
        np.fill_diagonal(linked, False)
        if group["a"].iloc[0] != group["b"].iloc[0]:  # pairs inside a block are counted by its own group
            linked &= group["own"].to_numpy()[:, None] != group["own"].to_numpy()[None, :]
        for row in np.flatnonzero(linked.any(1)):
            at = np.flatnonzero(linked[row])
            linked[row, at] = (keys[at, :t] != keys[row, :t]).all(1)
        found = linked.any(1)
        if not found.any():
            return None
        ids = group["id"].to_numpy()
        links = (linked * group["weight"].to_numpy()[None, :]).sum(1)
        return pd.DataFrame({"id": ids[found], "links": links[found], "root": ids[local_roots(linked)][found]})

    def check_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One call over a partition sorted by group: most groups are pairs, too small for a call each."""

        def checked(frame: pd.DataFrame, ends: np.ndarray) -> Iterator[pd.DataFrame]:
            start = 0
            for end in ends:
                group = frame.iloc[start:end]
                out = check(group, unit(group["v"]), np.stack(group["keys"]))
                start = end
                if out is not None:
                    yield out

        rest = None
        for batch in batches:
            frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            names = frame[["t", "key", "a", "b"]].to_numpy()
            ends = np.flatnonzero((names[1:] != names[:-1]).any(1)) + 1
            yield from checked(frame, ends)
            rest = frame.iloc[ends[-1] :] if len(ends) else frame
        if rest is not None and len(rest):
            yield from checked(rest, np.array([len(rest)]))

    schema = "id long, links long, root long"
    group = ["t", "key", "a", "b"]
    grouped = met.repartition(*group).sortWithinPartitions(*group, "id")
    part = materialise(grouped.mapInPandas(check_all, schema), "vector-links")
    counts = part.groupBy("id").agg(F.sum("links").alias("links"))
    roots = smallest_reachable(reps.select("id"), part.select(F.col("id").alias("a"), F.col("root").alias("b")))
    roots = materialise(roots, "vector-roots")
    top = roots.join(first.select(F.col("row").alias("id"), "least"), "id").groupBy("root").agg(F.min("least").alias("top"))
    per_rep = roots.join(top, "root").join(counts, "id", "left").select(F.col("id").alias("rep"), "top", "links")
    linked = member.select("id", "row", "weight", F.col("least.row").alias("rep")).join(per_rep, "rep").select(
        "id",
        (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.col("top.id").alias("root"),
        (F.col("row") == F.col("top.row")).alias("kept"),
    )
    alone = rows.where("NOT ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("root"), F.lit(True).alias("kept"))
    return linked.union(alone).select(F.col("id").alias(id), "n_links", F.col("root").alias("component_id"), "kept")
