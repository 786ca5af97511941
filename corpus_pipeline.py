"""The corpus pipeline: quality rules, line dedup, near-dedup, pseudonyms, packing.

Every stage works on all that its predecessor kept. ``run`` writes the stages in between to reliable storage, so a stage
that reads its input more than once, or again after an executor is lost, never repeats the ones before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from querywright.llm import line_dedup, near_dedup, packing, pii, quality
from querywright.llm.queries import TOKENIZER, documents, pii_key
from querywright.llm.storage import settle


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a changed text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(line_dedup.clean_rows(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def with_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(pii.clean_rows(docs, pii_key(spark)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = packing.pack(packing.pieces(docs, TOKENIZER))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", good_documents),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", one_of_each_group),
    ("pii", with_pseudonyms),
    ("packing", packed),
]

# The vote model, the pseudonyms and the packing are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = settle(docs)
    return docs
