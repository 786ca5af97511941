"""One query per operator, with its production parameters, over the whole documents table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from querywright.llm import (alignment, exact_dedup, line_dedup, near_dedup, packing, pii, prefix_trie, quality, secrets, sharding,
                             suffix_dedup, token_counts, transcode)
from querywright.llm.storage import settle

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PII_KEY = "spark.querywright.piiKey"
TOKEN_LIMIT = 512


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pii_key(spark: SparkSession) -> str:
    """The secret of the pseudonyms; set it for real data."""
    return spark.conf.get(PII_KEY, "unset")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(packing.pieces(documents(spark, sf_dir), TOKENIZER))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.measured(documents(spark, sf_dir).select("doc_id", "text"))
    # the measures of a row are some ten numbers: they are written, the texts are not
    rows = settle(rows.select(F.struct("row.doc_id").alias("row"), "f"))
    return quality.score(rows).select("row.doc_id", "f.n_words", "f.word_chars", "f.n_symbols", "f.n_dup_lines",
                                      "f.n_repeat_words", "base_failed", "kept", "posterior")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.pseudonymise(documents(spark, sf_dir).select("doc_id", "text"), pii_key(spark))
    return out.select("row.doc_id", "out.text", F.size("out.kinds").cast("long").alias("n_replaced"), "out.kinds")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.snapshot(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("row.doc_id", "out.n_lines", "out.n_dropped", F.sha2("out.text", 256).alias("kept_sha256"))


def op6_transcode(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = transcode.encode(documents(spark, sf_dir).select("doc_id", "text"), TOKENIZER).drop("text")
    out = transcode.decode(ids, TOKENIZER)
    return out.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(spark, f"{sf_dir}/documents.parquet")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts.with_token_counts(documents(spark, sf_dir).select("doc_id", "text"), TOKENIZER)
    return out.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "n_tokens",
                      (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secrets.find(documents(spark, sf_dir).select("doc_id", "text"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return rows.select("row.doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                       F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
                       secrets.listed(F.col("spans")).alias("spans"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_rows(documents(spark, sf_dir))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.without_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("row.doc_id", "out.n_bytes", "out.n_removed", F.size("out.spans").cast("long").alias("n_spans"),
                      F.sha2("out.kept", 256).alias("kept_sha256"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = alignment.align(documents(spark, sf_dir).select("doc_id", "text"), TOKENIZER, PIECES, digest=True)
    return out.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


PLANS = {f.__name__: f for f in (op1_near_dedup, op2_packing, op3_quality, op4_pii, op5_line_dedup, op6_transcode,
                                 op7_exact_dedup, op8_token_counts, op9_secret_scan, op10_sharding, op11_suffix_dedup,
                                 op12_alignment, op13_prefix_trie)}
