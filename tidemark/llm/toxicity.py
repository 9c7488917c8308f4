"""Toxicity by a subsequence string kernel: a support vector machine over Nystroem landmarks."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import forget, map_rows, materialise, slices
from tidemark.llm.set_join import Shingles

TOXIC_ROWS, CLEAN_ROWS = 3_000, 9_000  # labelled rows that training reads at most, of each label
TOXIC_WORDS, CLEAN_WORDS = 1_500, 4_000  # strings of the sample that the machine is fitted on at most
HARD_WORDS, ROUNDS = 2_000, 2  # and strings of clean texts added in each round of mistakes
LANDMARKS = 250  # of each label
ORDER, SPAN, DECAY = 4, 6, 0.5  # characters of a subsequence, the text it may stretch over, weight of each step
LONG = 32  # longer words are read in windows of this many characters
EDGE = "^"
BEGINNINGS = range(5, 10)  # characters of a word's beginnings, with the edge
MASK = 0x2545F4914F6CDD1D  # any value that deals fingerprints anew
MIX = np.uint64(0x9E3779B97F4A7C15)  # any odd value of that size
REMEMBERED = 1 << 19  # words whose decisions a task keeps
AT_ONCE = 4_000  # words judged together
TEXT = 1 << 20  # bytes of text whose words are held at once


def subsequences(word: str) -> dict[str, float]:
    """The normalised kernel features of ``word``: each subsequence of `ORDER` characters, gaps
    weighted down by `DECAY` for each character that it stretches over."""
    out: dict[str, float] = {}
    for i, first in enumerate(word):
        for rest in combinations(range(i + 1, min(len(word), i + SPAN)), ORDER - 1):
            key = first + "".join([word[k] for k in rest])
            out[key] = out.get(key, 0.0) + DECAY ** (rest[-1] - i)
    size = math.sqrt(sum(x * x for x in out.values())) or 1.0
    return {key: x / size for key, x in out.items()}


def fingerprints(codes: list[np.ndarray]) -> np.ndarray:
    """A 64-bit fingerprint of the characters at equal places."""
    out = np.zeros(len(codes[0]), np.uint64)
    for code in codes:
        out = (out + code + np.uint64(1)) * MIX
        out ^= out >> np.uint64(29)
    return out


def windows_of(marked: str) -> list[str]:
    return [marked] if len(marked) <= LONG else [marked[i : i + LONG] for i in range(0, len(marked) - LONG // 2, LONG // 2)]


def strings_of(word: str) -> list[str]:
    """What the machine judges of a word: all of it, in windows if it is long, and how it begins."""
    marked = EDGE + word
    return windows_of(marked) + [marked[:n] for n in BEGINNINGS if len(marked) > n]


def words_of(text: str) -> set[str]:
    """Distinct lower-case words without punctuation around them; a run of single letters is one
    word too."""
    out, run = set(), []
    for raw in text.lower().split():
        word = raw if raw.isalnum() else raw.strip("".join({c for c in raw if not c.isalnum()}))
        if len(word) == 1:
            run.append(word)
            continue
        if len(run) > 2:
            out.add("".join(run))
        run = []
        out.add(word)
    if len(run) > 2:
        out.add("".join(run))
    out.discard("")
    return out


def gram(left: list[dict[str, float]], right: list[dict[str, float]]) -> np.ndarray:
    index = {key: i for i, key in enumerate(sorted({key for row in right for key in row}))}
    dense = np.zeros((len(right), len(index)))
    for i, row in enumerate(right):
        for key, x in row.items():
            dense[i, index[key]] = x
    out = np.zeros((len(left), len(right)))
    for i, row in enumerate(left):
        at = [index[key] for key in row if key in index]
        out[i] = dense[:, at] @ np.array([x for key, x in row.items() if key in index]) if at else 0
    return out


def squared_hinge(rows: np.ndarray, sign: np.ndarray, weight: np.ndarray, cost: float = 10.0) -> np.ndarray:
    """A linear support vector machine, by Newton steps on the squared hinge; the last column is the bias."""
    rows = np.hstack([rows, np.ones((len(rows), 1))])
    ridge = np.eye(rows.shape[1])
    ridge[-1, -1] = 1e-3
    w = np.zeros(rows.shape[1])
    for _ in range(30):
        active = sign * (rows @ w) < 1
        a, c = rows[active], cost * weight[active]
        new = np.linalg.solve(ridge + (a * c[:, None]).T @ a, (a * c[:, None]).T @ sign[active])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a label's log odds, by Newton steps with a small ridge."""
    rows, w = np.stack([x, np.ones(len(x))], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        slope = rows.T @ (p - y) + 1e-2 * w
        curve = (rows * (p * (1 - p) + 1e-9)[:, None]).T @ rows + 1e-2 * np.eye(2)
        w = w - np.linalg.solve(curve, slope)
    return float(w[0]), float(w[1])


class Machine:
    """A fitted machine. As the decision is linear in the landmarks' kernels, these fold into one weight
    for each subsequence that a landmark holds."""

    def __init__(self, toxic: list[tuple[str, float]], clean: list[tuple[str, float]]) -> None:
        strings = [s for s, _ in toxic + clean]
        sign = np.array([1.0] * len(toxic) + [-1.0] * len(clean))
        weight = np.array([w for _, w in toxic + clean])
        for side in (sign > 0, sign < 0):
            weight[side] *= len(sign) / 2 / weight[side].sum()
        weight /= weight.mean()
        features = [subsequences(s) for s in strings]
        # The strings come most telling first.
        chosen = features[: min(len(toxic), LANDMARKS)] + features[len(toxic) :][:LANDMARKS]
        values, vectors = np.linalg.eigh(gram(chosen, chosen))
        strong = values > 1e-6
        whiten = vectors[:, strong] / np.sqrt(values[strong])
        w = squared_hinge(gram(features, chosen) @ whiten, sign, weight)
        self.bias = float(w[-1])
        self.weights: dict[str, float] = {}
        for beta, landmark in zip(whiten @ w[:-1], chosen, strict=True):
            for key, x in landmark.items():
                self.weights[key] = self.weights.get(key, 0.0) + float(beta) * x
        self.slope, self.offset = 1.0, 0.0
        self.memo: dict[str, float] | None = None
        self.table: tuple[np.ndarray, np.ndarray] | None = None

    def judge(self, strings: list[str], beginnings: bool = False) -> np.ndarray:
        """The decision on each of the strings, of `LONG` + 1 characters at most, or with ``beginnings`` the strongest
        over it and its beginnings of a length in `BEGINNINGS`, as each holds the subsequences of the one before.

        All subsequences of all strings are sorted once, by string, subsequence and end: sums along that order are
        the squared norm up to each end.
        """
        found = np.full(len(strings), self.bias)
        if not strings:
            return found
        if self.table is None:
            keys = np.array([[ord(c) for c in key] for key in self.weights], np.uint64).reshape(-1, ORDER)
            prints = fingerprints([keys[:, i] for i in range(ORDER)])
            order = np.argsort(prints)
            self.table = prints[order], np.array(list(self.weights.values()))[order]
        size = np.array([len(string) for string in strings])
        width = max(int(size.max()), ORDER)
        codes = np.array(strings, f"<U{width}").view(np.uint32).reshape(len(strings), width).astype(np.uint64)
        prints, places, steps = [], [], []
        for back in combinations(range(SPAN - 1, 0, -1), ORDER - 1):
            row, end = np.nonzero(np.arange(back[0], width)[None, :] < size[:, None])
            end += back[0]
            prints.append(fingerprints([codes[row, end - d] for d in (*back, 0)]))
            places.append(row * width + end)
            steps.append(np.full(len(row), DECAY ** back[0]))
        prints, places, steps = map(np.concatenate, (prints, places, steps))
        known, weight = self.table
        at = np.minimum(np.searchsorted(known, prints), len(known) - 1)
        along = np.where(known[at] == prints, weight[at], 0.0) * steps if len(known) else np.zeros(len(steps))
        # One number holds string and subsequence, and in its last bits the end.
        group = (prints + (places // width).astype(np.uint64) * MIX) * MIX & ~np.uint64(63)
        order = np.argsort(group | (places % width).astype(np.uint64))
        group, step = group[order], steps[order]
        first = np.ones(len(group), bool)
        first[1:] = group[1:] != group[:-1]
        before = np.cumsum(step) - step  # exact: steps are powers of two
        before -= before[first][np.cumsum(first) - 1]
        shape = len(strings) * width
        square = np.bincount(places[order], step * (2 * before + step), shape).reshape(-1, width).cumsum(1)
        along = np.bincount(places, along, shape).reshape(-1, width).cumsum(1)
        decisions = along / np.sqrt(np.where(square > 0, square, 1.0))
        rows = np.arange(len(strings))
        whole = size >= ORDER
        found[whole] += decisions[rows, size - 1][whole]
        if beginnings:
            for stop in BEGINNINGS:
                if stop >= width:
                    break
                longer = size > stop
                found[longer] = np.maximum(found[longer], decisions[longer, stop - 1] + self.bias)
        return found

    def judge_words(self, words: list[str]) -> list[float]:
        """The strongest decision over each word's windows and beginnings."""
        marked = [EDGE + word for word in words]
        found = self.judge([word[:LONG] for word in marked], beginnings=True)
        others = [(i, other) for i, word in enumerate(marked) if len(word) > LONG for other in windows_of(word)[1:]]
        if others:
            np.maximum.at(found, [i for i, _ in others], self.judge([other for _, other in others]))
        return found.tolist()

    def decisions(self, texts: list[str]) -> list[float]:
        """For each text the strongest decision over its words, no further than the margin, and the log of how many
        are on the toxic side; texts without words are as clean as can be."""
        if self.memo is None:
            self.memo = {}
        memo, sets = self.memo, [words_of(text) for text in texts]
        new = list(set().union(*sets).difference(memo))
        for start in range(0, len(new), AT_ONCE):
            some = new[start : start + AT_ONCE]
            memo.update(zip(some, self.judge_words(some), strict=True))
        out = []
        for words in sets:
            found = list(map(memo.__getitem__, words))
            out.append(max(-2.0, min(1.0, max(found, default=-2.0))) + math.log1p(sum(x > 0 for x in found)))
        if len(memo) > REMEMBERED:
            for word in new:
                del memo[word]
        return out

    def score(self, text: str) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * self.decisions([text])[0] + self.offset))))

    def __getstate__(self):
        return {**self.__dict__, "memo": None, "table": None}


def string_judge(shared):
    @F.pandas_udf("double")
    def judge(batch: pd.Series) -> pd.Series:
        return pd.Series(shared.value.judge(batch.tolist()))

    return judge


def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    shingles = Shingles(5)
    for batch in batches:
        sets = [shingles(text).view(np.int64) for text in batch.column("_0").to_pylist()]
        ends = [[x[0], x[-1], x[np.argmin(x ^ np.int64(MASK))]] if len(x) else [0, 0, 0] for x in sets]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(ends, pa.list_(pa.int64()))], names=[*batch.schema.names[:-1], "marks"]
        )


def first_rows(labelled: DataFrame) -> DataFrame:
    """The `TOXIC_ROWS` and `CLEAN_ROWS` rows with the smallest hash of their id."""
    toxic, clean = (
        labelled.where(F.col("toxic") == label).orderBy(F.xxhash64("id"), "id").limit(limit)
        for label, limit in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))
    )
    return toxic.union(clean)


def train(labelled: DataFrame) -> Machine | float:
    """Fit on rows of (``id``, ``text``, ``toxic``); without both labels, the share of toxic rows.

    Reads at most `TOXIC_ROWS` and `CLEAN_ROWS` rows, those with the smallest hash of their id. Which
    strings make a text toxic is not labelled: those found far oftener in toxic texts than chance would
    have it teach one side, and strings of clean texts the other.
    """
    narrow = labelled.where("text IS NOT NULL AND toxic IS NOT NULL").select("id", "text", "toxic")
    sample = materialise(first_rows(materialise(narrow, "toxicity-rows")), "toxicity-sample")
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return float(max(totals, default=0))
    base = totals[1] / (totals[0] + totals[1])

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = sorted({s for word in words_of(text) for s in strings_of(word)})
                yield pa.RecordBatch.from_pydict({"s": pa.array(found, pa.string()), "toxic": pa.array([toxic] * len(found), pa.int64())})

    # Near copies of a text count once, so that a group of them does not decide: they tend to
    # share two of three extremes of their n-grams' fingerprints.
    marked = map_rows(sample, ["text", "toxic"], [F.col("text")], [T.StructField("marks", T.ArrayType(T.LongType()))], marks)
    for i, j in ((0, 1), (1, 2), (0, 2)):
        marked = marked.withColumn("mark", F.array(F.col("marks")[i], F.col("marks")[j])).dropDuplicates(["mark"])
    counted = (
        marked.select("text", F.col("toxic").cast("int"))
        .repartition(32)
        .mapInArrow(explode, "s string, toxic long")
        .groupBy("s")
        .agg(F.sum("toxic").alias("p"), F.count("*").alias("n"))
    )
    rate = F.col("p") / F.col("n")
    tiny = F.lit(1e-12)
    surprise = F.col("p") * F.log((rate + tiny) / base) + (F.col("n") - F.col("p")) * F.log(
        (1 - rate + tiny) / (1 - base)
    )
    counted = materialise(counted.withColumn("surprise", surprise), "toxicity-strings")
    toxic = (
        counted.where(rate >= 0.5 + base / 2).where("p >= 3 AND surprise >= 12")
        .orderBy(F.desc("surprise"), "s").limit(TOXIC_WORDS).collect()
    )
    plain = counted.where(rate <= base + (1 - base) / 8)
    often = plain.orderBy(F.desc("n"), "s").limit(CLEAN_WORDS // 2).collect()
    other = plain.where("n - p >= 1").orderBy(F.xxhash64("s"), "s").limit(CLEAN_WORDS // 2).collect()
    clean = list({r["s"]: r for r in often + other}.values())
    if not toxic or not clean:
        return base
    known = [(r["s"], math.log1p(r["p"])) for r in toxic]
    other = {r["s"]: math.log1p(r["n"]) for r in clean}
    machine = Machine(known, list(other.items()))
    # Strings of clean texts that the machine takes for toxic join the clean side.
    spark = sample.sparkSession
    for _ in range(ROUNDS):
        judge = string_judge(spark.sparkContext.broadcast(machine))
        wrong = plain.where("n - p >= 1").withColumn("d", judge("s")).where("d > -1")
        hard = wrong.orderBy(F.desc("d"), "s").limit(HARD_WORDS).collect()
        new = {r["s"]: math.log1p(r["n"]) * 2 for r in hard if r["s"] not in other}
        if not new:
            break
        other = {**new, **other}
        machine = Machine(known, list(other.items()))
    judged = decisions(sample.repartition(32), machine, ["toxic"], F.col("text")).toPandas()  # two numbers a sampled row
    machine.slope, machine.offset = logistic(judged["decision"].to_numpy(), judged["toxic"].to_numpy(np.float64))
    return machine


def decisions(docs: DataFrame, machine: Machine | float, keep: list[str], text: Column) -> DataFrame:
    """The ``keep`` columns, ``decision`` and ``score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # bounded by the landmarks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        own = shared.value
        for batch in batches:
            if isinstance(own, float):
                found = [0.0] * batch.num_rows
                scores = [own] * batch.num_rows
            else:
                found = [x for _, texts in slices(batch.column("_0"), TEXT) for x in own.decisions(texts.to_pylist())]
                scores = [1 / (1 + math.exp(-max(-30.0, min(30.0, own.slope * x + own.offset)))) for x in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.float64()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names[:-1], "decision", "score"],
            )
        if not isinstance(own, float):
            own.memo = None  # the worker keeps the broadcast machine

    outputs = [T.StructField("decision", T.DoubleType()), T.StructField("score", T.DoubleType())]
    return map_rows(docs, keep, [F.coalesce(text.cast("string"), F.lit(""))], outputs, run)


def held_out(id: str = "doc_id") -> Column:
    """True for the third of ids that labels are never learnt from."""
    return F.crc32(F.col(f"`{id}`").cast("string").cast("binary")) % 3 == 1


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    label: str = "toxic",
    threshold: float = 0.7,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(``id``, ``held_out``, ``score``, ``predicted``) of every row of ``docs``, and its ``keep`` columns.

    A text's score follows its most toxic word and how many are toxic, from a support vector machine on gap-weighted
    subsequences of characters, so that an insult with characters put in between still resembles the insult. Labels
    are learnt from rows that are not held out. Of several labels of one id the largest counts;
    null labels and ids teach nothing, and a null id is not held out.

    A null or empty text scores as low as the machine can. Without labels all scores are 0, with one
    label only they are that label. Repeated rows each get a row; columns not in ``keep`` are ignored.
    """
    others = [name for name in keep if name != id]
    known = labels.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").alias("toxic"))
    known = known.where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1)).where(~held_out("id"))
    known = known.groupBy("id").agg(F.max("toxic").cast("int").alias("toxic"))
    texts = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text")).where("text IS NOT NULL")
    # Labels meet ids first, and texts as a list of bounded length.
    known = known.join(texts.select("id"), "id", "left_semi")
    machine = train(texts.join(F.broadcast(first_rows(known)), "id"))
    scored = decisions(docs, machine, [id, *others], F.col(f"`{text}`"))
    return scored.select(
        id,
        F.coalesce(held_out(id), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        *others,
    )
