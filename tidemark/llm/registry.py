"""Registered queries of the package: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.byte_bpe import decode, encode
from tidemark.llm.licenses import scan, templates
from tidemark.llm.near_vectors import near_vectors
from tidemark.llm.packing import pack_documents
from tidemark.llm.periodic_runs import periodic_runs
from tidemark.llm.personal_data import KINDS, find_personal_data
from tidemark.llm.repeats import remove_repeats
from tidemark.llm.set_join import alike
from tidemark.llm.spelling import variants, word_counts
from tidemark.llm.token_counts import count_tokens
from tidemark.llm.toxicity import score_toxicity
from tidemark.llm.vector_tree import search
from tidemark.llm.warc import round_trip


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages")).drop("payload")


def op3_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    return cut.withColumn("kept_sha256", F.sha2("remaining", 256)).drop("remaining")


def op4_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 100 = 0"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), templates(spark))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alike(table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = encode(table(spark, sf_dir, "documents"), path, pattern)
    decoded = decode(encoded, path, keep=("doc_id", "n_tokens", "ids"))
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def listed(spans: Column | str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, KINDS), F.sha2(listed(base), 256).alias("base_sha256"), listed("spans").alias("spans")
    )


def with_planted_run(doc_id: Column, text: Column) -> Column:
    """The text, but for a tenth of the ids one whose words repeat from some word on, as the query's contract has it."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")
    h = F.crc32(doc_id.cast("string").cast("binary"))
    n, g = F.greatest(F.size(words), F.lit(1)).cast("long"), F.floor(h / 10)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    unit = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    tail = F.flatten(F.array_repeat(unit, F.ceil((n - a) / p).cast("int")))
    planted = F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(tail, F.lit(1), (n - a).cast("int")))
    return F.when((h % 10 == 0) & (F.size(words) > 0), F.array_join(planted, " ")).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs(docs, with_planted_run(F.col("doc_id"), F.col("text")))
    longest_first = F.transform(
        "runs", lambda r: F.struct(r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period"))
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = found.select("*", F.array_max(longest_first).alias("best"), F.array_join(lines, "\n").alias("lines"))
    listed = F.when(F.size("runs") > 0, F.concat("lines", F.lit("\n"))).otherwise("")
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(word_counts(table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_near_vectors": op1_near_vectors,
    "op2_warc_index": op2_warc_index,
    "op3_remove_repeats": op3_remove_repeats,
    "op4_nearest_vectors": op4_nearest_vectors,
    "op5_license_scan": op5_license_scan,
    "op6_toxicity": op6_toxicity,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_token_counts": op9_token_counts,
    "op10_packing": op10_packing,
    "op11_personal_data": op11_personal_data,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_spelling_variants": op13_spelling_variants,
}

#: The contract of an operator where SQL can state it; the others are held against brute force in tests.
ORACLES: dict[str, str] = {
    "op2_warc_index": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS n FROM pages
        ), d AS (
            SELECT page_id, n, sha256(payload) AS digest,
                   CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY sha256(payload)) END AS first
            FROM p
        )
        SELECT page_id, n AS payload_bytes, digest AS payload_digest,
               CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first < page_id THEN first END AS refers_to
        FROM d
    """,
}
