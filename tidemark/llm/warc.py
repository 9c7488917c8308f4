"""WARC archives with a two-level capture index: written, looked up and read back."""

from __future__ import annotations

import gzip
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import hashlib

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_rows, materialise
from tidemark.session import scratch_dir
from tidemark.sources.files import list_names

END = "\r\n\r\n"  # what ends the head of a record
MEMBER = (1 << 24) - 1  # bytes of a record in one GZIP member at most
FEED = 1 << 16  # bytes of an archive unpacked at once
DIRECTORY = 100_000  # entries of the sparse directory at most, whatever the input
HEAD = re.compile(rb"([A-Za-z-]+): ([^\r]*)\r\n")


def url_key(url: Column) -> Column:
    """The URL with its host's labels reversed and no scheme, user or port: ``com,example)/path``."""
    rest = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_extract(rest, r"^[^/?#]*", 0), r"^.*@|:\d*$", "")
    path = F.regexp_replace(rest, r"^[^/?#]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path)


def squeezed(df: DataFrame, keep: list[str], column: str) -> DataFrame:
    """The ``keep`` columns, and the binary ``column`` compressed as ``packed``: what is shuffled is a fraction of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [pa.compress(value.as_buffer(), codec="zstd", asbytes=True) for value in batch.column("_0")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(packed, pa.binary())], names=[*batch.schema.names[:-1], "packed"]
            )

    return map_rows(df, keep, [F.col(column)], [T.StructField("packed", T.BinaryType())], run)


def unpacked(packed: bytes | None, size: int) -> bytes:
    return pa.decompress(packed, size, codec="zstd", asbytes=True) if packed is not None and size else b""


def records(pages: DataFrame, least: int) -> DataFrame:
    """(``head``, ``packed``, ``body``): the head of a WARC record for every page, and its compressed payload with its
    length, null and 0 for revisits. Heads name the page and the row."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    pages = pages.withColumn("row", F.monotonically_increasing_id())
    pages = pages.withColumn("bytes", F.octet_length("payload")).withColumn("digest", F.sha2("payload", 256))
    pages = pages.withColumn("payload", F.col("payload").cast("binary"))
    pages = materialise(squeezed(pages, ["row", "page_id", "url", "bytes", "digest"], "payload"), "warc-pages")
    long = pages.where((F.col("bytes") >= least) & F.col("page_id").isNotNull())
    first = long.groupBy("digest").agg(F.min(F.struct("page_id", "row")).alias("first"), F.count("*").alias("n"))
    # Most payloads occur once; only the others are joined.
    joined = pages.join(first.where("n > 1").select("digest", "first"), "digest", "left")
    revisit = F.coalesce((F.col("bytes") >= least) & (F.col("row") != F.col("first.row")) & F.col("page_id").isNotNull(), F.lit(False))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(":"), F.col("row").cast("string"), F.lit(">\r\nWARC-Target-URI: "), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%0A"),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: <urn:page:"), F.col("first.page_id").cast("string"), F.lit(">")))
        .otherwise(""),
        F.lit("\r\nWARC-Payload-Length: "), F.col("bytes").cast("string"),
        F.lit("\r\nContent-Length: "), F.when(revisit, "0").otherwise(F.col("bytes").cast("string")),
        F.lit(END),
    )
    return joined.select(
        head.alias("head"),
        F.when(~revisit, F.col("packed")).alias("packed"), F.when(revisit, 0).otherwise(F.col("bytes")).cast("long").alias("body"),
    )


def members(record: bytes) -> bytes:
    """A record as a member of a GZIP file, or as several if it is so long that a size would not end in a zero byte."""
    parts = [record[i : i + MEMBER] for i in range(0, len(record), MEMBER)]
    return b"".join(gzip.compress(part, 6, mtime=0) for part in parts)


def write_archives(records: DataFrame, folder: str, size: int) -> None:
    """Write ``archive=N`` folders of one file each, of about ``size`` bytes: records as GZIP members.

    Spark's text writer ends each line with one byte at least. The last byte of a member is the highest of its size,
    which is zero, so that is the line's end. Each archive is written by one task, as its number is the task's own.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, at = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            archives, lines = [], []
            for i in range(batch.num_rows):
                head, packed, body = (batch.column(name)[i].as_py() for name in ("head", "packed", "body"))
                data = members(head.encode() + unpacked(packed, body))
                if at and at + len(data) > size:
                    archive, at = archive + 1, 0
                archives.append(archive)
                lines.append(data[:-1])
                at += len(data)
            columns = [pa.array(archives, pa.int64()), pa.array(lines, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["archive", "line"])

    lines = records.mapInArrow(place, "archive long, line binary")
    lines = lines.select("archive", F.col("line").cast("string"))
    lines.write.partitionBy("archive").option("lineSep", "\0").text(folder)


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """(``archive``, ``content``) of the files written."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.regexp_extract("path", r"archive=(\d+)", 1).cast("long").alias("archive"), "content")


def told(record: bytes) -> tuple[dict[bytes, bytes], bytes]:
    """The fields of a record's head, and the payload so far."""
    head, _, payload = record.partition(b"\r\n\r\n")
    return dict(HEAD.findall(head + b"\r\n")), payload


def records_in(content: memoryview) -> Iterator[tuple[int, int, dict[bytes, bytes]]]:
    """(start, length, fields) of each record of an archive. Only heads are kept."""
    at, start, missing, fields = 0, 0, 0, None
    while at < len(content):
        member, fed, data = zlib.decompressobj(31), at, []
        while not member.eof:
            data.append(member.decompress(content[fed : fed + FEED]))
            fed += FEED
        at = min(fed, len(content)) - len(member.unused_data)
        if fields is None:
            fields, payload = told(b"".join(data))
            missing = int(fields[b"Content-Length"]) - len(payload)
        else:
            missing -= sum(map(len, data))
        if missing <= 0:
            yield start, at - start, fields
            start, fields = at, None


def captures(spark: SparkSession, folder: str) -> DataFrame:
    """Where each record of the archives lies: (``row``, ``page_id``, ``key``, ``archive``, ``start``, ``length``)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(*batch.columns, strict=True):
                out: list[tuple] = []
                for start, length, fields in records_in(memoryview(content.as_buffer())):
                    page, row = fields[b"WARC-Record-ID"][10:-1].split(b":")
                    url = fields.get(b"WARC-Target-URI", b"").decode()
                    out.append((int(row), int(page) if page else None, url, archive.as_py(), start, length))
                if out:
                    columns = dict(zip(("row", "page_id", "url", "archive", "start", "length"), zip(*out, strict=True), strict=True))
                    yield pa.RecordBatch.from_pydict(columns, schema)

    kinds = {"row": pa.int64(), "page_id": pa.int64(), "url": pa.string(), "archive": pa.int64(), "start": pa.int64(), "length": pa.int64()}
    schema = pa.schema(list(kinds.items()))
    found = archives(spark, folder).mapInArrow(
        scan, "row long, page_id long, url string, archive long, start long, length long"
    )
    places = found.select("row", "page_id", url_key(F.col("url")).alias("key"), "archive", "start", "length")
    return materialise(places, "warc-captures")


def build_index(places: DataFrame, block: int) -> tuple[DataFrame, list[tuple[str, int]], list[int]]:
    """Compressed blocks of entries sorted by URL key, and the sparse directory of their first entries."""
    total = places.count()
    block = max(block, -(-total // (DIRECTORY // 2)))
    fields = ["key", "row", "page_id", "archive", "start", "length"]

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, []

        def close(rows: list[tuple]) -> pa.RecordBatch:
            data = "\n".join("\t".join("" if x is None else str(x) for x in row[1:]) + "\t" + row[0] for row in rows)
            packed = zlib.compress(data.encode(), 6)
            return pa.RecordBatch.from_pydict(
                {"block": [number], "first": [rows[0][0]], "first_row": [rows[0][1]], "data": [packed]}
            )

        for batch in batches:
            held += zip(*[batch.column(name).to_pylist() for name in fields], strict=True)
            while len(held) >= block:
                yield close(held[:block])
                held, number = held[block:], number + 1
        if held:
            yield close(held)

    clean = places.withColumn("key", F.regexp_replace("key", r"[\t\n]", " ")).select(*fields)
    ordered = clean.repartitionByRange("key", "row").sortWithinPartitions("key", "row")
    blocks = materialise(ordered.mapInArrow(squeeze, "block long, first string, first_row long, data binary"), "warc-index")
    rows = blocks.select("first", "first_row", "block").collect()  # the directory: at most DIRECTORY entries and one a task
    rows = sorted((r["first"].encode(), r["first_row"], r["block"]) for r in rows)
    return blocks, [(key, row) for key, row, _ in rows], [b for *_, b in rows]


def look_up(blocks: DataFrame, directory: list, numbers: list[int], wanted: DataFrame) -> DataFrame:
    """Where the records of ``wanted`` (``key``, ``row``) lie: the directory names a block, and the block an entry."""
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast((directory, numbers))

    @F.pandas_udf("bigint")
    def block_of(keys: pd.Series, rows: pd.Series) -> pd.Series:
        firsts, numbers = shared.value
        at = [bisect_right(firsts, (key.encode(), row)) - 1 for key, row in zip(keys, rows, strict=True)]
        return pd.Series([numbers[i] if i >= 0 else -1 for i in at])

    def find(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            entries = []
            for line in zlib.decompress(bytes(right["data"].iloc[0])).decode().split("\n"):
                row, page, archive, start, length, key = line.split("\t", 5)
                entries.append((key.encode(), int(row), int(page) if page else None, int(archive), int(start), int(length)))
            keys = [entry[:2] for entry in entries]
            for key, row in zip(left["key"], left["row"], strict=True):
                i = bisect_left(keys, (key.encode(), int(row)))
                if i < len(keys) and keys[i] == (key.encode(), row):
                    out.append(entries[i][1:2] + entries[i][3:])
        return pd.DataFrame(out, columns=["row", "archive", "start", "length"], dtype="int64")

    wanted = wanted.withColumn("key", F.regexp_replace("key", r"[\t\n]", " ")).select("key", "row")
    asked = wanted.withColumn("block", block_of("key", "row"))
    return asked.groupBy("block").cogroup(blocks.groupBy("block")).applyInPandas(
        find, "row long, archive long, start long, length long"
    )


def read_records(spark: SparkSession, folder: str, places: DataFrame) -> DataFrame:
    """Read the byte ranges of ``places`` and parse their records; ``payload`` is null for revisits."""
    def read(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            content = memoryview(right["content"].iloc[0])
            for row, start, length in zip(left["row"], left["start"], left["length"], strict=True):
                fields, payload = told(gzip.decompress(content[start : start + length]))
                if len(payload) != int(fields[b"Content-Length"]):
                    raise ValueError(f"record at {start} does not have its stated length")
                number = lambda value: int(value) if value else None
                kind, digest = fields[b"WARC-Type"].decode(), fields[b"WARC-Payload-Digest"][7:].decode()
                if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"record at {start} does not have its stated digest")
                out.append((
                    int(row), number(fields[b"WARC-Record-ID"][10:-1].split(b":")[0]), int(fields[b"WARC-Payload-Length"]),
                    digest, kind, number(fields.get(b"WARC-Refers-To", b"")[10:-1]), payload if kind == "response" else None,
                ))
        frame = pd.DataFrame(out, columns=["row", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])
        return frame.astype({"page_id": "Int64", "refers_to": "Int64"})

    schema = (
        "row long, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    )
    return places.groupBy("archive").cogroup(archives(spark, folder).groupBy("archive")).applyInPandas(read, schema)


def round_trip(pages: DataFrame, least: int = 100, size: int = 8 << 20, block: int = 3000) -> DataFrame:
    """Write a record for every row of ``pages`` (``page_id``, ``url``, ``html``), index the archives, look every
    page up in the index and read its record back.

    (``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, ``payload``). Of equal payloads
    of ``least`` bytes or more the one with the smallest page_id is the response and the others revisit it. An archive
    holds about ``size`` bytes, or one longer record, and a task holds one archive.

    A null html is empty, a null URL too. A row with a null page_id is always a response. Repeated
    rows each get a record, of which one is the response. Other columns are ignored.
    """
    spark = pages.sparkSession
    folder = scratch_dir(spark, "archives")
    write_archives(records(pages, least), folder, size)
    if not any(name.startswith("archive=") for name in list_names(spark, folder)):
        schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
        return spark.createDataFrame([], schema)
    places = captures(spark, folder)
    blocks, directory, numbers = build_index(places, block)
    found = look_up(blocks, directory, numbers, places.select("key", "row"))
    return read_records(spark, folder, found).drop("row")
