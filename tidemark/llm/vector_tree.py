"""Nearest neighbours over a hierarchical k-means tree, searched best bin first."""

from __future__ import annotations

from functools import reduce
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise
from tidemark.llm.near_vectors import usable

SAMPLE = 20_000  # vectors the tree is fitted on, and
TRIALS = 200  # queries that calibrate the number of leaves
WIDEN = 4  # each round visits this many times the leaves of the round before
MOST = float("inf")


def kmeans(rows: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = rows[rng.choice(len(rows), k, replace=False)]
    for _ in range(rounds):
        near = nearest(rows, centres)
        centres = np.stack([rows[near == i].mean(0) if (near == i).any() else centres[i] for i in range(k)])
    return centres


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(1)[None, :] - 2 * rows @ centres.T).argmin(1)


class Tree:
    """Nodes hold the centres of their children; a node without centres is a leaf."""

    def __init__(self, rows: np.ndarray, branches: int, leaf: int, seed: int) -> None:
        self.centres: list[np.ndarray | None] = []
        self.children: list[list[int]] = []
        rng = np.random.default_rng(seed)
        self._grow(rows, branches, leaf, rng)

    def _grow(self, rows: np.ndarray, branches: int, leaf: int, rng: np.random.Generator) -> int:
        node = len(self.centres)
        self.centres.append(None)
        self.children.append([])
        if len(rows) > leaf and len(distinct := np.unique(rows, axis=0)) > branches:
            centres = kmeans(distinct, branches, rng)
            near = nearest(rows, centres)
            if np.bincount(near, minlength=branches).max() < len(rows):
                self.centres[node] = centres
                self.children[node] = [self._grow(rows[near == i], branches, leaf, rng) for i in range(branches)]
        return node

    def leaves(self) -> int:
        return sum(c is None for c in self.centres)

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.int64)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            if self.centres[node] is None:
                out[at] = node
            elif len(at):
                near = nearest(rows[at], self.centres[node])
                todo += [(child, at[near == i]) for i, child in enumerate(self.children[node])]
        return out

    def visit(self, query: np.ndarray, leaves: int, held: dict[int, int] | None = None, need: int = 0) -> list[int]:
        """The first ``leaves`` leaves, the branch with the nearest centre first, and as many more as it takes for
        ``need`` of the vectors that leaves hold (``held``)."""
        heap, found = [(0.0, 0)], []
        while heap and (len(found) < leaves or need > 0):
            _, node = heappop(heap)
            if self.centres[node] is None:
                found.append(node)
                need -= held.get(node, 0) if held else 0
                continue
            gaps = ((self.centres[node] - query) ** 2).sum(1).tolist()
            for gap, child in zip(gaps, self.children[node], strict=True):
                heappush(heap, (gap, child))
        return found


def calibrate(tree: Tree, rows: np.ndarray, k: int, recall: float, seed: int) -> int:
    """Leaves to visit until sampled queries find ``recall`` of their ``k`` nearest among ``rows``."""
    leaf = tree.leaf_of(rows)
    at = np.random.default_rng(seed).choice(len(rows), min(TRIALS, len(rows)), replace=False)
    needed: list[int] = []
    total = tree.leaves()
    for i in at:
        gaps = ((rows - rows[i]) ** 2).sum(1)
        gaps[i] = np.inf
        best = np.argsort(gaps, kind="stable")[: min(k, len(rows) - 1)]
        order = {node: n for n, node in enumerate(tree.visit(rows[i], total))}
        needed += [order[node] + 1 for node in leaf[best]]
    return int(np.quantile(needed, recall, method="higher")) if needed else 1


def search(
    vectors: DataFrame,
    queries: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    k: int = 10,
    recall: float = 0.97,
    branches: int = 8,
    leaf: int = 200,
    block: int = 4096,
    seed: int = 11,
) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): the ``k`` nearest of each query by Euclidean distance.

    The tree is fitted on at most `SAMPLE` vectors, those with the smallest hash of their id, and
    every vector is put in a leaf. A query walks the tree through a priority queue and
    visits as many leaves as sampled queries needed for ``recall``, and more until they hold ``k`` vectors of other
    ids, so that fewer come out only where there are no more. Distances are exact, in double precision, and ties
    go to the smaller id. A leaf with more than ``block`` vectors is searched in blocks. The leaves are visited in rounds
    that widen, and a leaf gives only what is no farther than the ``k``-th nearest of the rounds before: a query's
    rows grow with the rounds and not with the leaves.

    Vectors that are null, empty, zero or hold null or non-finite components neither ask nor answer, and neither do
    rows without an id, as no result could name them.
    Each length of vectors has a tree of its own. Without vectors the result is empty.
    """
    spark = vectors.sparkSession

    def narrow(df: DataFrame) -> DataFrame:
        df = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
        return df.where(usable("v") & F.col("id").isNotNull())

    schema = "query_id long, rank int, vec_id long, score double"
    rows = narrow(vectors)
    lengths = sorted(r["n"] for r in rows.select(F.size("v").alias("n")).distinct().collect())
    if not lengths:
        return spark.createDataFrame([], schema)

    def nearest_in_block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            right = right.sort_values("id")
            ids, rows = right["id"].to_numpy(), np.stack(right["v"])
            for ask, query, own, bound in zip(left["ask"], left["id"], left["v"], left["bound"], strict=True):
                gaps = np.sqrt(((rows - np.asarray(own)) ** 2).sum(1))
                gaps[ids == query] = np.inf
                best = np.argsort(gaps, kind="stable")[:k]
                out += [(ask, query, ids[i], gaps[i]) for i in best if gaps[i] <= bound and ids[i] != query]
        return pd.DataFrame(out, columns=["ask", "query_id", "vec_id", "score"])

    def among(dim: int) -> DataFrame:
        sample = rows.where(F.size("v") == dim).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toPandas()["v"]
        fitted = np.stack([np.asarray(v) for v in sample])
        tree = Tree(fitted, branches, leaf, seed)
        visits = calibrate(tree, fitted, k, recall, seed)
        shared = spark.sparkContext.broadcast(tree)  # at most SAMPLE / 1 leaves, whatever the input

        @F.pandas_udf("bigint")
        def leaf_of(batch: pd.Series) -> pd.Series:
            return pd.Series(shared.value.leaf_of(np.stack([np.asarray(v) for v in batch])))

        placed = rows.where(F.size("v") == dim).withColumn("leaf", leaf_of("v"))
        placed = materialise(placed, "leaves")
        held = {r["leaf"]: r["n"] for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}  # a row per leaf

        @F.pandas_udf("array<bigint>")
        def visit(batch: pd.Series, need: pd.Series) -> pd.Series:
            return pd.Series([shared.value.visit(np.asarray(v), visits, held, n) for v, n in zip(batch, need, strict=True)])

        sizes = placed.groupBy("leaf").agg(F.ceil(F.count("*") / block).cast("long").alias("blocks"))
        # One row per leaf of a tree with a bounded number of leaves.
        sizes = F.broadcast(sizes)
        blocks = placed.join(sizes, "leaf").select("id", "v", "leaf", F.pmod(F.xxhash64("id"), "blocks").alias("block"))
        # A query finds vectors of other ids, so those of its own do not count.
        asked = narrow(queries).where(F.size("v") == dim)
        own = placed.join(asked.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.count("*").alias("own"))
        asked = asked.join(own, "id", "left").select(
            F.monotonically_increasing_id().alias("ask"), "id", "v", visit("v", F.coalesce("own", F.lit(0)) + k).alias("path")
        )
        asked = materialise(asked, "paths")
        longest = asked.agg(F.max(F.size("path"))).first()[0] or 0
        best, start, count = None, 1, 1
        while start <= longest:
            # Leaves of this round, and how far the k-th nearest of the rounds before is: nothing farther comes out.
            here = asked.select("ask", "id", "v", F.explode(F.slice("path", start, count)).alias("leaf"))
            if best is None:
                here = here.withColumn("bound", F.lit(MOST))
            else:
                last = best.groupBy("ask").agg(F.when(F.count("*") >= k, F.max("score")).alias("last"))
                here = here.join(last, "ask", "left").withColumn("bound", F.coalesce("last", F.lit(MOST))).drop("last")
            here = here.join(sizes, "leaf").select(
                "ask", "id", "v", "bound", "leaf",
                F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
            )
            visited = here.select("leaf").distinct()  # no more than the tree's leaves
            near = blocks.join(F.broadcast(visited), "leaf", "left_semi")
            found = here.groupBy("leaf", "block").cogroup(near.groupBy("leaf", "block")).applyInPandas(
                nearest_in_block, "ask long, query_id long, vec_id long, score double"
            )
            if best is not None:
                found = best.union(found)
            first = F.row_number().over(Window.partitionBy("ask").orderBy("score", "vec_id"))
            best = materialise(found.withColumn("rank", first).where(F.col("rank") <= k).drop("rank"), "nearest")
            start, count = start + count, count * WIDEN
        if best is None:
            return spark.createDataFrame([], "query_id long, vec_id long, score double")
        return best.drop("ask")

    found = reduce(DataFrame.union, map(among, lengths))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
