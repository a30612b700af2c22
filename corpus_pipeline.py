"""The corpus pipeline: stages applied one after the other to `documents`, each written and read again.

quality rules    documents that fail the standard policy go
line dedup       lines of later copies of passages of 50 words or more go; a document left without a
                 word goes too, and n_chars follows the text
near duplicates  of every group one document, that with the least id, stays
decontamination  documents in which a window of a benchmark item occurs go
packing          the rest as pieces in sequences of 1024 tokens

Each stage takes any table with the columns of documents and returns these columns (the last one its
pieces), whatever other columns there are. Rows that repeat an id stay or go together in the stages that
decide by id; a null id is an id there.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashline.llm import decontamination, line_dedup, minmax_dedup, packing, quality_rules
from cashline.llm.common import join_by_id, settled, table, white_words
from cashline.session import configure

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = "byte_bpe_50k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    judged = quality_rules.ledger(docs.select(*DOCUMENT))
    return judged.filter(quality_rules.passes(quality_rules.STANDARD, F.col("quality.failed"))).select(*DOCUMENT)


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    left = line_dedup.dedup_lines(docs.select(*DOCUMENT))
    changed = F.size("deleted") > 0
    left = left.filter(~changed | (F.size(white_words(F.col("text"))) > 0))
    return left.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars"))).select(*DOCUMENT)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    # Rows without an id are told apart by a number of their own.
    numbered = minmax_dedup.with_numbers(docs.select(*DOCUMENT), "number")
    found = minmax_dedup.near_duplicates(numbered.select(F.col("number").alias("doc_id"), "text"))
    kept = found.filter("kept").select(F.col("doc_id").alias("number")).distinct()
    return join_by_id(numbered, kept, "left_semi", "number").select(*DOCUMENT)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    hit = decontamination.contamination(docs.select("doc_id", "text"), items).filter("contaminated")
    return join_by_id(docs.select(*DOCUMENT), hit.select("doc_id").distinct(), "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    pieces = packing.pieces(docs.select("doc_id", "text"), public_tokenizers.path(TOKENIZER))
    return packing.pack(packing.with_crc(pieces))


STAGES = [
    ("quality rules", quality),
    ("line dedup", unique_lines),
    ("near duplicates", distinct_documents),
    ("decontamination", clean_of_benchmark),
    ("packing", packed),
]

# Token ids and packing have no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
