"""One query per operator over the whole shared tables, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashline.llm import backoff_lm, byte_repeats, decontamination, divergence, filter_audit, line_dedup, minmax_dedup, packing, quality_rules, secret_scan, token_files, warc, wrappers
from cashline.llm.common import new_folder, table

TOKENIZER = "byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = new_folder(spark, "token-files")
    token_files.write(docs, public_tokenizers.path(TOKENIZER), folder)
    return token_files.read(spark, folder, ids=False)


def op2_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = wrappers.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = F.size(F.split("text", "\n", -1))
    n_deleted = F.aggregate("deleted", F.lit(0), lambda n, run: n + run["n"])
    left = line_dedup.dedup_lines(docs.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(lines)))
    return left.select("doc_id", "n_lines", n_deleted.alias("n_deleted"), "text")


def op4_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = backoff_lm.score(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rounded = [F.round(name, digits).alias(name) for name, digits in (("log_score", 4), ("mean_log_score", 6))]
    return scored.select("doc_id", "n_words", *rounded)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = packing.with_crc(packing.pieces(docs, public_tokenizers.path(TOKENIZER)))
    return packing.pack(cut)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontamination.contamination(docs.select("doc_id", "text"), items.select("item_id", "text"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    warc.write(table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    records = warc.read(spark, folder, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    measured, failed = F.col("quality.measured"), F.col("quality.failed")
    return judged.select(
        "doc_id",
        *[measured[name].alias(name) for name in "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()],
        (~quality_rules.passes(quality_rules.BASE, failed)).alias("base_failed"),
        quality_rules.passes(quality_rules.STANDARD, failed).alias("kept"),
        failed.alias("failed_rules"),
    )


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of two policies does, by the bits of one stored ledger."""
    kept = quality_rules.stored(quality_rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text")))
    each = [
        quality_rules.ablations(kept, policy).select(F.lit(policy.version).alias("policy"), "rule", "n_failed", "n_only", "n_kept_without")
        for policy in (quality_rules.BASE, quality_rules.STANDARD)
    ]
    return each[0].union(each[1])


def op10_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents").select("lang", "source", "text"))


def op12_byte_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = byte_repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_spans = F.size("spans").cast("long").alias("n_spans")
    return left.select("doc_id", "n_bytes", "n_removed", n_spans, F.sha2("kept", 256).alias("kept_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    rows = filter_audit.judged(docs.select("doc_id", "lang", "text"))
    return filter_audit.orders_audit(filter_audit.mask_counts(rows, labels))


def all_queries() -> dict[str, Query]:
    found = [
        op1_token_files, op2_wrappers, op3_line_dedup, op4_backoff_lm, op5_best_fit_packing, op6_decontamination, op7_secret_scan,
        op8_warc, op9_quality_rules, quality_ablations, op10_minmax_dedup, op11_divergence, op12_byte_repeats, op13_filter_audit,
    ]
    return {query.__name__: query for query in found}
