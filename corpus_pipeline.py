"""A corpus pipeline: toxic documents go, near copies go, repeated passages go, and the rest is packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, release
from tidemark.llm.packing import pack_documents
from tidemark.llm.repeats import remove_repeats
from tidemark.llm.set_join import alike
from tidemark.llm.toxicity import score_toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows whose own toxicity is below 0.7, whatever their id."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_toxicity(docs, labels, keep=COLUMNS)
    return scored.where("predicted = 0").select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that with the smallest id, a null id last. Of rows that share an
    id, the columns' hash decides, so that repeated rows and null ids leave one row too. Texts without words have no
    copies. Rows are told apart by numbers, which are written before they are used twice."""
    release(spark)
    numbered = docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id())
    docs = materialise(numbered, "pipeline-rows")
    groups = alike(docs, id="_row").select("_row", "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.xxhash64(*COLUMNS).alias("hash"), "_row")
    named = docs.select("_row", order.alias("order")).join(groups, "_row")
    kept = named.groupBy("component_id").agg(F.min("order").alias("least")).select("least._row")
    return docs.join(kept, "_row", "left_semi").select(*COLUMNS)


def whole_characters(data: Column) -> Column:
    """UTF-8 text without the bytes of cut characters. Replacement characters of the text itself stay."""
    text = data.cast("string")
    for old, new in (("\uffff", "\uffff0"), ("\ufffd", "\uffff1")):
        text = F.replace(text, F.lit(old), F.lit(new))
    text = F.make_valid_utf8(text)
    for old, new in (("\ufffd", ""), ("\uffff1", "\ufffd"), ("\uffff0", "\uffff")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, less the 200-byte strings that occur more than once. Characters cut in two
    go whole, null texts become empty, and ``n_chars`` is counted anew."""
    release(spark)
    cut = remove_repeats(docs, keep=("doc_id", "lang", "source", "n_chars"))
    changed = cut.select("*", whole_characters(F.col("remaining")).alias("text"))
    return changed.select(
        "doc_id", "text", "lang", "source", F.char_length("text").cast("long").alias("n_chars")
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document, packed into sequences of 2048 tokens."""
    release(spark)
    pieces = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("toxicity", clean_of_toxicity),
    ("ngram_jaccard", one_of_each_group),
    ("remove_repeats", without_repeats),
    ("packing", packed),
]

#: Tokens, fingerprints and a trained machine are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on what the one before wrote; the result is the last one's."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
