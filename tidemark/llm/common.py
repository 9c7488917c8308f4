"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
import gc
import weakref
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_dir, sql_settings
from tidemark.sources.files import delete_tree


#: Spark deletes the shuffle files of a query as it ends, and not when the driver next collects its garbage.
CLEANUP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


#: Rows of a table of links that a task takes, if there are many.
LINKS = 200_000

_WRITTEN: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def materialise(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: what follows does not recompute it
    when an executor is lost, and its shuffle files go as soon as it is written."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    with sql_settings(spark, CLEANUP):
        df.write.option("compression", "zstd").parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    _WRITTEN[written] = path
    return written


def discard(*written: DataFrame) -> None:
    """Delete tables that `materialise` wrote, when all that reads them is written itself."""
    for table in written:
        delete_tree(table.sparkSession, _WRITTEN.pop(table))


_REMEMBERED: dict = {}


def remembered(key: tuple, make: Callable):
    """What ``make`` gives, kept in this process for later tasks. Only one thing is: asking for another lets it go."""
    if key not in _REMEMBERED:
        forget()
        _REMEMBERED[key] = make()
    return _REMEMBERED[key]


def forget() -> None:
    """Let go what an operator before keeps in this process: Spark's Python workers outlive its tasks. The allocators
    give what is free back to the system, where they can."""
    _REMEMBERED.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that are done: its cleaner acts when the driver collects garbage,
    which on a driver with little to do may be long after."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def map_rows(
    df: DataFrame,
    keep: Sequence[str],
    inputs: Sequence[DataFrame | object],
    outputs: Sequence[T.StructField],
    function: Callable[[Iterator[tuple[pa.RecordBatch, list[pa.Array]]]], Iterator[pa.RecordBatch]],
) -> DataFrame:
    """Run ``function`` over Arrow batches holding the ``keep`` columns, then ``inputs`` as ``_0``, ``_1``, ..

    The result has the ``keep`` columns and then ``outputs``. Other columns of ``df`` are left behind,
    so that none of them can clash with an output.
    """
    clash = {field.name for field in outputs} & set(keep)
    if clash:
        raise ValueError(f"kept columns clash with outputs: {sorted(clash)}")
    kept = df.select(*[F.col(f"`{name}`") for name in keep]).schema.fields
    narrow = df.select(
        *[F.col(f"`{name}`").alias(f"k{i}") for i, name in enumerate(keep)],
        *[column.alias(f"_{i}") for i, column in enumerate(inputs)],
    )
    inner = T.StructType([T.StructField(f"k{i}", f.dataType) for i, f in enumerate(kept)] + list(outputs))
    mapped = narrow.mapInArrow(function, inner)
    return mapped.select(
        *[F.col(f"k{i}").alias(name) for i, name in enumerate(keep)], *[F.col(f.name) for f in outputs]
    )


def slices(texts: pa.Array, at_once: int) -> Iterator[tuple[int, pa.Array]]:
    """Runs of texts of up to ``at_once`` bytes, or one longer text, and where each begins."""
    start = size = 0
    for i, own in enumerate(pc.binary_length(texts).to_pylist()):
        if size + own > at_once and i > start:
            yield start, texts.slice(start, i - start)
            start, size = i, 0
        size += own
    if len(texts) > start:
        yield start, texts.slice(start)


def in_few_tasks(df: DataFrame, rows: int, each: int, least: int) -> DataFrame:
    """``df`` with its last step in a task for each ``each`` of ``rows``, and in ``least`` at least, if that is fewer than
    it would have: a small table is few files then, however many partitions a shuffle has."""
    return df.coalesce(max(least, -(-rows // each)))


def stars(links: DataFrame) -> DataFrame:
    """(``lo``, ``hi``) for every id ``hi`` that reaches a smaller one over ``links`` (``a``, ``b``), taken both ways, and
    the smallest that it reaches; a table of `materialise`.

    Alternates large-star and small-star steps (Kiveris et al., "Connected Components in MapReduce
    and Beyond", 2014) until every link goes from a root to a member. Each step is a grouped minimum, taken on
    the map side first, and a join; each result is a written table. Hub nodes cost a row per link, and
    no group of neighbours is ever gathered.
    """
    edges = links.where("a <> b").select(
        F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")
    ).distinct()
    edges = materialise(in_few_tasks(edges, links.count(), LINKS, 8), "links")
    while True:
        # Each link goes from a smaller id to a larger one. So links are stars if no id has two smaller ones, or a smaller
        # and a larger one.
        ends = edges.select(F.col("hi").alias("id"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(
            edges.select(F.col("lo").alias("id"), F.lit(0).alias("below"), F.lit(1).alias("above"))
        )
        each = ends.groupBy("id").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
        rows = edges.count()
        broken = in_few_tasks(each, rows, LINKS, 8).where("below > 1 OR below = 1 AND above = 1")
        with sql_settings(links.sparkSession, CLEANUP):
            if not broken.agg(F.count("*")).first()[0]:
                break
        last = edges
        # Large star: every larger neighbour of u is linked to the smallest of u's neighbours and u.
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(
            edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi"))
        large = in_few_tasks(large, rows, LINKS, 8).distinct()
        edges = materialise(in_few_tasks(large, rows, LINKS, 8), "links")
        discard(last)
        last = edges
        # Small star: u and its smaller neighbours are linked to the smallest of them.
        least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
        joined = edges.join(least, "hi").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
        small = joined.union(least.select(F.col("m").alias("lo"), "hi")).where("lo <> hi")
        small = in_few_tasks(small, rows, LINKS, 8).distinct()
        edges = materialise(in_few_tasks(small, rows, LINKS, 8), "links")
        discard(last)
    return edges


def smallest_reachable(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(``id``, ``root``) for every ``id`` in ``nodes``: the smallest id that it reaches over ``links``
    (``a``, ``b``), taken both ways."""
    found = stars(links)
    roots = nodes.join(found.select(F.col("hi").alias("id"), F.col("lo").alias("root")), "id", "left")
    roots = roots.select("id", F.coalesce("root", "id").alias("root"))
    roots = materialise(in_few_tasks(roots, nodes.count(), LINKS, 8), "roots")
    discard(found)
    return roots
