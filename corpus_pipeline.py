"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; its
result is written as Parquet to the shared folder and read again for the next one.

Cases that hold for every stage: texts of any length are taken whole; an empty table
stays empty; other columns, whatever their names, are handed on (the last stage drops
them); a row without an id is judged by its text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lanecost.llm import catalog, decontam, langid, near_dup, packing, suffix_dedup
from lanecost.llm.util import ship, stage

# The repeats stage looks for shorter strings than op1: 51 words take 256 bytes or more.
REPEAT_BYTES, REPEAT_REACH = 256, 160


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows; null, empty and letterless texts go.
    Repeated rows are judged alike."""
    return langid.drop_unknown(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the least id, and one row
    of rows that repeat id and text. Texts without words have no duplicates and stay."""
    return near_dup.drop_near_duplicates(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of ``REPEAT_BYTES`` bytes that occur more than once.
    A passage of over 50 words is longer than that. Null texts stay null, shorter ones as
    they are; repeated rows lose what they repeat."""
    return suffix_dedup.strip_repeats(docs, length=REPEAT_BYTES, reach=REPEAT_REACH)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none; repeated
    rows are judged alike."""
    return decontam.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, in sequences of 1024 tokens. A null or empty text is its
    end id alone; repeated rows are documents of their own."""
    pieces = packing.pack_documents(docs, *catalog.packing_tokenizer())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


STAGES = [
    ("language_id", language),
    ("near_dedup", near_duplicates),
    ("suffix_dedup", repeats),
    ("decontamination", benchmark),
    ("packing", pack),
]

# Training a language model, connected components and tokenising are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
