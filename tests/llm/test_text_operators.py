"""Repeat removal and the set join against brute force."""

import hashlib
import os
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, repeats, set_join
from tidemark.llm.common import materialise
from tidemark.llm.repeats import difference_cover, remove_repeats
from tidemark.llm.set_join import alike
from tidemark.session import scratch_dir, sql_settings

SCHEMA = "doc_id long, text string, n long, rank string, part int"


def frame(spark, texts):
    rows = [(i, text, 1, "x", 2) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def removed_by_force(texts, size):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + size] for d in data for i in range(len(d) - size + 1))
    out = {}
    for key, d in enumerate(data):
        gone = bytearray(len(d))
        for i in range(len(d) - size + 1):
            if seen[d[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out[key] = (len(d), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), kept)
    return out


def texts_with_repeats(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcé", k=rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rng.randint(40, 150))) for _ in range(6)]
    texts = [None, "", "short", "a" * 700, "ab" * 300, passages[0], passages[0], "ß" * 150]
    for _ in range(40):
        parts = [" ".join(word() for _ in range(rng.randint(0, 80))) for _ in range(3)]
        parts.insert(rng.randint(0, 2), rng.choice(passages))
        parts.insert(rng.randint(0, 3), rng.choice(passages)[rng.randint(0, 60) :])
        texts.append(" ".join(parts))
    return texts


def test_cover_reaches_every_difference():
    period, cover = difference_cover(11)
    assert (period, len(cover)) == (133, 12)
    assert {(int(a) - int(b)) % period for a in cover for b in cover} == set(range(period))


def test_removed_bytes(spark):
    for seed in (1, 2):
        texts = texts_with_repeats(seed)
        got = {
            r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["remaining"]))
            for r in remove_repeats(frame(spark, texts)).collect()
        }
        assert got == removed_by_force(texts, 200)


def test_removal_over_many_chunks(spark, monkeypatch):
    import tidemark.llm.repeats as module

    monkeypatch.setattr(module, "CHUNK", 500)
    texts = texts_with_repeats(3)
    got = {r["doc_id"]: r["n_removed"] for r in remove_repeats(frame(spark, texts)).collect()}
    assert got == {k: v[1] for k, v in removed_by_force(texts, 200).items()}


def test_removal_on_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: hashlib.sha256(r["remaining"]).hexdigest() for r in remove_repeats(docs).collect()}
    want = removed_by_force(list(texts.values()), 200)
    assert got == {k: hashlib.sha256(w[3]).hexdigest() for k, w in zip(texts, want.values(), strict=True)}


def test_removal_of_nothing(spark):
    assert remove_repeats(frame(spark, [])).collect() == []
    assert [r["n_removed"] for r in remove_repeats(frame(spark, [None])).collect()] == [0]


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {str(f) for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(blocks) if "shuffle_" in str(f)}


def left_after(spark, before):
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def test_written_tables_leave_no_shuffle_files(spark):
    """Whether or not the driver collects its garbage, and while the frame is still held."""
    before = shuffle_files(spark)
    grouped = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    written = materialise(grouped, "test")
    assert left_after(spark, before) == set()
    assert written.count() == 7


def test_rounds_leave_no_shuffle_files(spark, monkeypatch):
    monkeypatch.setattr(repeats, "release", lambda spark: None)
    docs = frame(spark, texts_with_repeats(1))
    before = shuffle_files(spark)
    remove_repeats(docs)  # all rounds, and not yet the result
    left = left_after(spark, before)
    assert sum(os.path.getsize(f) for f in left if os.path.exists(f)) < 20_000  # the sum of the chunks' sizes


def sets_of(texts):
    out = []
    for text in texts:
        words = (text or "").encode().lower().split()
        n = min(5, len(words))
        out.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    return out


def alike_by_force(texts, ids):
    sets = sets_of(texts)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(ids)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = find(ids[a]), find(ids[b])
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in zip(ids, sets, strict=True)}


def test_components(spark):
    rng = random.Random(5)
    texts = [None, "", "  \t", "one", "One", "two words", "a b c d e", "A B C D E", "a b c d f", "a a a a a a a", "a a a a a"]
    common = [rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(80)]
    for _ in range(8):  # chains: neighbours are alike, ends are not
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(20, 120))]
        for _ in range(12):
            words = list(words)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = f"w{rng.randint(0, 10**6)}"
            texts.append(" ".join(words))
    texts += [" ".join(common + [f"x{rng.randint(0, 99)}" for _ in range(rng.randint(0, 60))]) for _ in range(60)]
    rng.shuffle(texts)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in alike(frame(spark, texts)).collect()}
    assert got == alike_by_force(texts, list(range(len(texts))))


@pytest.mark.parametrize("ids", ["own", "shared"])
def test_components_near_the_limit(spark, ids):
    """Many pairs just above and below the limit, of texts that share passages; ids with texts of different groups."""
    rng, texts = random.Random(9), []
    passages = [[f"p{i}w{rng.randint(0, 10**5)}" for _ in range(rng.randint(6, 40))] for i in range(5)]
    for _ in range(14):
        words = [f"w{rng.randint(0, 10**5)}" for _ in range(rng.randint(25, 70))]
        for _ in range(11):
            near = list(words)
            for _ in range(rng.choice([1, 2, 2, 3, 3, 4])):
                at = rng.randrange(len(near))
                near[at : at + rng.randint(0, 2)] = [f"w{rng.randint(0, 10**5)}" for _ in range(rng.randint(0, 2))]
            texts.append(" ".join(near + rng.choice(passages) if rng.random() < 0.4 else near))
    rng.shuffle(texts)
    names = [i if ids == "own" else i % 97 for i in range(len(texts))]
    rows = [(name, text, 1, "x", 2) for name, text in zip(names, texts, strict=True)]
    found = alike(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    want = alike_by_force(texts, names)
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: component for i, (_, component) in want.items()}
    assert 5 < len({component for _, component in want.values()}) < len(set(names)) - 5


def test_near_copies_need_no_pairs_of_all(spark, monkeypatch):
    """Copies of one text that are alike to it, and to some of each other, whose smallest id is as poor a head as any."""
    rng, texts, compared = random.Random(12), [], []
    words = [f"w{i}" for i in range(300)]
    for _ in range(240):
        near = list(words)
        for at in rng.sample(range(300), rng.randint(3, 6)):
            near[at] = f"x{rng.randint(0, 10**6)}"
        texts.append(" ".join(near))

    def noted(df, label):
        written = materialise(df, label)
        if label == "set-pairs":
            compared.append(written.count())
        return written

    monkeypatch.setattr(set_join, "materialise", noted)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in alike(frame(spark, texts)).collect()}
    assert got == alike_by_force(texts, list(range(len(texts))))
    assert sum(compared) < 6 * len(texts)


def rows_joined(df):
    """The most rows that a join of the query makes, when it runs."""
    execution, most = df._jdf.queryExecution(), 0
    execution.toRdd().count()
    nodes = [execution.executedPlan()]
    for node in nodes:
        inner = [node.executedPlan()] if node.nodeName() == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in node.nodeName() else []
        children = node.children()
        nodes += [*inner, *(children.apply(i) for i in range(children.size()))]
        if "Join" in node.nodeName():
            most = max(most, node.metrics().apply("numOutputRows").value())
    return most


@pytest.mark.parametrize("alike_too", [0, 12])
def test_a_shared_passage_gives_few_rows(spark, monkeypatch, alike_too):
    """Long texts that share most of a passage, and are not alike, meet in many lists: they are not paired in each."""
    rng, made = random.Random(21), []
    passage = [f"p{i}" for i in range(1120)]
    texts = [" ".join(passage + [f"x{rng.randint(0, 10**9)}" for _ in range(280)]) for _ in range(40)]
    for text in texts[:alike_too]:
        words = text.split()
        words[1300:] = [f"y{rng.randint(0, 10**9)}" for _ in range(100)]
        texts.append(" ".join(words))

    def noted(df, label):
        if label == "set-pairs":
            made.append(rows_joined(df))
        return materialise(df, label)

    monkeypatch.setattr(set_join, "materialise", noted)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in alike(frame(spark, texts)).collect()}
    assert got == alike_by_force(texts, list(range(len(texts))))
    assert made[-1] < len(texts) ** 2  # each of the pairs met in some 70 lists


def test_components_leave_their_result_alone(spark):
    folder = os.path.dirname(scratch_dir(spark, "x").removeprefix("file:"))
    before = set(os.listdir(folder))
    found = alike(frame(spark, ["a b c d e f g h", "a b c d e f g i", "a b c d e f g h j", "", None]))
    assert [name[:23] for name in set(os.listdir(folder)) - before] == ["tidemark-set-components"]
    assert found.count() == 5


def test_components_on_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in alike(docs).collect()}
    assert got == alike_by_force([r["text"] for r in rows], [r["doc_id"] for r in rows])


def test_components_of_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a b"), (4, "a b"), (4, "a b"), (7, "a b")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in alike(docs).collect()), key=str)
    assert got == [(4, 4), (4, 4), (7, 4), (None, None)]
    assert alike(docs.where(F.lit(False))).collect() == []


def test_counts_survive_their_planes():
    counts = np.array([0, 1, 255, 256, 70_000, 2**32 - 1], np.uint32)
    assert set_join.from_planes(set_join.planes(counts)).tolist() == counts.tolist()


def test_signatures_are_not_joined_again(spark, monkeypatch):
    """Classes take their sets' lists along: lists are put together without a join of two large tables."""
    plans = {}

    def noted(df, label):
        plans.setdefault(label, []).append(df._jdf.queryExecution().executedPlan().toString())
        return materialise(df, label)

    monkeypatch.setattr(set_join, "materialise", noted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2k")  # few ids have several texts
    try:
        rng = random.Random(4)
        texts = [" ".join(f"w{rng.randrange(3000)}" for _ in range(60)) for _ in range(400)]
        texts += [text + " end" for text in texts[:100]]
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in alike(frame(spark, texts)).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == alike_by_force(texts, list(range(len(texts))))
    assert "SortMergeJoin" not in plans["set-lists"][0]


def test_small_tables_are_few_files(spark, monkeypatch):
    """However many partitions a shuffle has, a small input is not written in as many files at each step."""
    files = {}

    def noted(df, label):
        written = materialise(df, label)
        files[label] = max(files.get(label, 0), len(written.inputFiles()))
        return written

    monkeypatch.setattr(set_join, "materialise", noted)
    settings = {"spark.sql.shuffle.partitions": "100", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(3000)}" for _ in range(60)) for _ in range(300)]
    texts += [text + " end" for text in texts[:150]]
    with sql_settings(spark, settings):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in alike(frame(spark, texts)).collect()}
    assert got == alike_by_force(texts, list(range(len(texts))))
    assert 1 < files["set-classes"] <= 32 and max(files.values()) <= 32


def reached(links, nodes):
    least = {node: node for node in nodes}
    while True:
        before = dict(least)
        for a, b in links:
            if a is not None and b is not None:
                least[a] = least[b] = min(least[a], least[b])
        if least == before:
            return least


def test_smallest_reachable(spark, monkeypatch):
    """Chains, rings, hubs, loops, repeated links and null ends; links that are stars are written once."""
    labels = []

    def noted(df, label):
        labels.append(label)
        return materialise(df, label)

    monkeypatch.setattr(common, "materialise", noted)
    rng = random.Random(6)
    chain = [(i, i + 1) for i in range(0, 40)]
    ring = [(60 + (i + 1) % 9, 60 + i) for i in range(9)]
    hubs = [(i, 150) for i in range(100, 140)] + [(80, i) for i in range(81, 95)]
    mixed = [(rng.randrange(200, 320), rng.randrange(200, 320)) for _ in range(90)]
    odd = [(7, 7), (None, 3), (3, None), (150, 100), (100, 150)]
    nodes = spark.range(330)
    for links, tables in (
        (chain + ring + hubs + mixed + odd, None),
        ([(80, i) for i in range(81, 95)] + [(99, 97), (97, 98)], 1),
        ([], 1),
    ):
        rng.shuffle(links)
        labels.clear()
        found = common.smallest_reachable(nodes, spark.createDataFrame(links, "a long, b long").repartition(3))
        assert {r["id"]: r["root"] for r in found.collect()} == reached(links, range(330))
        assert tables in (None, labels.count("links"))
