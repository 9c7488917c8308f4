"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import periodic_runs as module
from tidemark.llm.periodic_runs import collapse, periodic_runs, runs_of
from tidemark.llm.registry import op12_periodic_runs

SCHEMA = "doc_id long, text string, n_words long, runs string, k0 int"


def words_by_force(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def runs_by_force(words):
    n, found = len(words), set()
    for q in range(1, n // 4 + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - start + q
            smaller = any(all(words[i] == words[i + d] for i in range(start, start + length - d)) for d in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                found.add((start, length, q))
            start = end + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def contract_by_force(doc_id, text):
    words = words_by_force(text)
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n > 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = runs_by_force(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def texts():
    rng = random.Random(5)
    out = [None, "", " \t\n", "a", "a " * 5, "a " * 6, "a a a a a a b", "ab cd " * 4, "x y " * 9, "a b c " * 7]
    for letters in (2, 3, 20):
        for _ in range(25):
            words = [rng.choice("abcdefghijklmnopqrstuvwxyz"[:letters]) for _ in range(rng.randint(0, 90))]
            unit = words[: rng.randint(1, 12)]
            words += unit * rng.randint(0, 8) + words[:3] + unit * rng.randint(0, 7)
            out.append(rng.choice([" ", "\n", " \t"]).join(words))
    return out


def table(spark, rows, tmp_path):
    path = f"{tmp_path}/sf/documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(path)
    return f"{tmp_path}/sf"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60) | st.lists(st.integers(0, 1), max_size=40).map(lambda x: x * 5))
def test_runs_of_any_words(ids):
    assert runs_of(np.array(ids, np.int64)) == runs_by_force(ids)


def test_query_equals_brute_force(spark, tmp_path):
    rows = list(enumerate(texts() * 4)) + [(None, "a b " * 6), (7, "a b " * 6), (7, "a b " * 6)]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 20
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = [(r["doc_id"], *(r[n] for n in names)) for r in op12_periodic_runs(spark, table(spark, rows, tmp_path)).collect()]
    want = [(i, *contract_by_force(i, text)) for i, text in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_query_on_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    short = {i: t for i, t in rows.items() if len(words_by_force(t)) < 600}
    got = {r["doc_id"]: tuple(r)[1:] for r in op12_periodic_runs(spark, sf).collect()}
    assert got.keys() == rows.keys()
    assert {i: got[i] for i in short} == {i: contract_by_force(i, t) for i, t in short.items()}


def test_operator_keeps_clashing_names_and_empty_tables(spark):
    row = (3, "a b " * 4 + "c", 9, "x", 1)
    got = periodic_runs(spark.createDataFrame([row, row], SCHEMA), keep=("doc_id", "k0")).collect()
    assert [tuple(r) for r in got] == [(3, 1, 9, [(0, 8, 2)], "a b c")] * 2
    empty = spark.createDataFrame([], SCHEMA)
    assert periodic_runs(empty).collect() == []
    with pytest.raises(ValueError, match="clash"):
        periodic_runs(empty, keep=("doc_id", "runs"))


def test_long_texts(monkeypatch):
    monkeypatch.setattr(module, "SPLIT", 0)
    n, runs, left = collapse(b"w " * 300_000 + b"x y z " * 100_000)
    assert (n, runs, left) == (600_000, [(0, 300_000, 1), (300_000, 300_000, 3)], b"w x y z")
    rng = random.Random(1)
    unit = " ".join(str(rng.randrange(10**6)) for _ in range(30_000)).encode()
    n, runs, left = collapse(b" ".join([unit] * 5))
    assert (n, runs, left == unit) == (150_000, [(0, 150_000, 30_000)], True)
