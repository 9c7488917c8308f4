"""Vector operators against brute force."""

import math

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm.near_vectors import hashing, meeting, near_vectors
from tidemark.llm.vector_tree import search

SCHEMA = "vec_id long, embedding array<float>, label int"


def made(seed=3, groups=12):
    rng = np.random.default_rng(seed)
    rows = [rng.standard_normal(24) for _ in range(150)]
    for _ in range(groups):
        centre = rng.standard_normal(24)
        rows += [centre + rng.standard_normal(24) * rng.choice([0.0, 0.1, 0.25]) for _ in range(15)]
    rows += [rows[0], rows[0] * 3, rows[0] * 1e-30]
    out = [[float(np.float32(x)) for x in row] for row in rows]
    return out + [None, [], [0.0] * 24, [float("nan")] * 24, [None] * 24, [float("inf")] + [0.0] * 23]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in enumerate(rows)], SCHEMA).repartition(3)


def good(rows):
    return [i for i, v in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)]


def cosines(rows):
    units = np.array(rows, np.float64)
    units /= np.abs(units).max(1, keepdims=True)
    units /= np.linalg.norm(units, axis=1)[:, None]
    return units @ units.T


def links_by_force(rows):
    at = good(rows)
    near = cosines([rows[i] for i in at]) >= 0.9
    np.fill_diagonal(near, False)
    root = np.arange(len(at))
    for _ in range(len(at)):
        root = np.minimum(root, np.where(near, root[None, :], len(at)).min(1))
    out = {i: (0, i) for i in range(len(rows))}
    return out | {i: (int(n), at[r]) for i, n, r in zip(at, near.sum(1), root, strict=True)}


def test_links_and_components(spark):
    rows = made()
    want = links_by_force(rows)
    for block in (1024, 7):
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors(frame(spark, rows), block=block).collect()}
        assert got.keys() == want.keys()
        # Hashing may miss a pair; it never adds one.
        assert all(got[i][0] <= want[i][0] for i in want)
        assert sum(got[i][0] for i in want) >= 0.98 * sum(n for n, _ in want.values())
        assert sum(got[i][1] == want[i][1] for i in want) >= 0.98 * len(want)


def test_hashing_follows_the_number_of_vectors():
    assert abs(meeting(math.sqrt(0.2), 2.0) - 0.8216) < 1e-3 and abs(meeting(math.sqrt(2), 2.0) - 0.4863) < 1e-3
    sizes = (0, 1, 10_000, 50_000, 10**6, 10**9)
    found = [hashing(n, 0.9, 2.0, 0.991, 64) for n in sizes]
    assert found[3] == (10, 32) and found[0] == found[1]
    for n, (width, tables) in zip(sizes, found, strict=True):
        assert 1 - (1 - meeting(math.sqrt(0.2), 2.0) ** width) ** tables >= 0.991
        assert n * meeting(math.sqrt(2), 2.0) ** width <= 64
    # A thousand times the vectors, not seven times the tables.
    assert found[5][1] < 7 * found[4][1]


def test_pairs_at_the_threshold_are_found_at_two_sizes(spark):
    """Planted pairs just above the threshold among unrelated vectors: the share found, and what it takes."""
    rng = np.random.default_rng(8)
    for n in (500, 4000):
        base = rng.standard_normal((n, 24))
        base /= np.linalg.norm(base, axis=1)[:, None]
        other = rng.standard_normal((n, 24))
        other -= (other * base).sum(1)[:, None] * base
        other /= np.linalg.norm(other, axis=1)[:, None]
        near = 0.9005 * base + math.sqrt(1 - 0.9005**2) * other
        rows = [(i, v.tolist(), 0) for i, v in enumerate(base)] + [(n + i, v.tolist(), 0) for i, v in enumerate(near)]
        table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
        links = {r["vec_id"]: r["n_links"] for r in near_vectors(table).collect()}
        assert sum(links[i] > 0 for i in range(n)) >= 0.975 * n


def test_links_of_nothing(spark):
    assert near_vectors(frame(spark, []).where(F.lit(False))).collect() == []


def test_links_of_repeated_and_null_ids(spark):
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    rows = [(5, a), (5, a), (5, b), (None, b), (None, c), (None, c), (9, [0.0, 0.0, 2.0]), (None, None), (None, [-1.0, 0.0, 0.0])]
    rows += [(3, None), (3, None)]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    got = [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_vectors(table).collect()]
    want = [(5, 1, 5, True), (5, 1, 5, False), (5, 1, 5, True), (None, 1, 5, False), (None, 2, 9, False), (None, 2, 9, False)]
    want += [(9, 2, 9, True), (None, 0, None, True), (None, 0, None, True), (3, 0, 3, True), (3, 0, 3, True)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_recall_on_tables(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = {r["vec_id"]: r["embedding"] for r in table.collect()}
    found = {}
    for r in search(table, table.where("vec_id % 100 = 0")).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    ids = np.array([i for i in rows if rows[i] is not None])
    matrix = np.array([rows[i] for i in ids], np.float64)
    hits = wanted = 0
    for query, own in found.items():
        gaps = np.sqrt(((matrix - np.array(rows[query], np.float64)) ** 2).sum(1))
        by_id = dict(zip(ids.tolist(), gaps.tolist(), strict=True))
        best = sorted((g, i) for i, g in by_id.items() if i != query)[:10]
        own.sort()
        assert [r for r, _, _ in own] == list(range(1, 11))
        assert all(score == by_id[i] for _, i, score in own)
        hits += len({i for _, i in best} & {i for _, i, _ in own})
        wanted += 10
    assert found.keys() == {i for i in rows if i % 100 == 0 and rows[i] is not None}
    assert hits >= 0.9 * wanted


def test_search_leaves_out_odd_vectors(spark):
    rows = [[1.0, 0.0], [1.0, 0.0], [0.0, 1.0], None, [0.0, 0.0], [None, 1.0], [float("nan"), 1.0]]
    table = frame(spark, rows)
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in search(table, table).collect()]
    assert sorted(got)[:2] == [(0, 1, 1, 0.0), (0, 2, 2, 2**0.5)]
    assert {q for q, *_ in got} == {0, 1, 2}
    assert search(table, table.where("false")).collect() == []
    assert search(table.where("false"), table).collect() == []


def test_search_finds_k_where_there_are(spark):
    rng = np.random.default_rng(2)
    # Tight groups of which each is a leaf or more, outliers, repeated ids, and vectors of another length.
    rows = [(i, (rng.standard_normal(4) * 0.01 + 10 * (i % 40)).tolist()) for i in range(800)]
    rows += [(1000 + i, (np.eye(4)[i] * 900.0 - 500).tolist()) for i in range(4)] + [(1000, [-400.0] * 4)] * 15
    rows += [(2000 + i, [float(i + 1), 1.0]) for i in range(12)]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    asked = [(i, v, 0) for i, v in dict(rows).items() if i % 40 < 4 or i >= 1000]
    found = search(table, spark.createDataFrame(asked, SCHEMA), leaf=6).groupBy("query_id").count().collect()
    assert {r["query_id"]: r["count"] for r in found} == {i: 10 for i, _, _ in asked}


def test_search_keeps_large_ids_beside_null_ones(spark):
    big = 2**53
    rows = [(100, [1.0, 0.0]), (None, [1.0, 0.1]), (big + 1, [1.0, 0.25]), (big + 3, [1.0, 0.5]), (None, [1.0, 0.0])]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(2)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in search(table, table).collect())
    want = [(100, 1, big + 1, 0.25), (100, 2, big + 3, 0.5)]
    want += [(big + 1, 1, 100, 0.25), (big + 1, 2, big + 3, 0.25), (big + 3, 1, big + 1, 0.25), (big + 3, 2, 100, 0.5)]
    assert got == sorted(want)
