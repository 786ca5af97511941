"""Question/SQL pair files and result artifacts."""

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from querywright.sources.jsonarray import opens, read_json_array
from querywright.sources.tables import _exists

PAIR_SCHEMA = "question string, sql string, schema_context string, category string, complexity string"
RESULTS_SCHEMA = ("metadata struct<timestamp: string, total_questions: bigint>, "
                  "strategy_results map<string, struct<success_rate: double, avg_confidence: double, avg_execution_time: double, "
                  "avg_bleu_score: double, execution_accuracy: double, schema_compliance_rate: double>>")


def load_pairs(spark: SparkSession, path: str, schema: str = PAIR_SCHEMA) -> DataFrame:
    """Pairs from JSON arrays (in ranges, by many tasks), JSON lines or a CSV with header. A missing or unsupported file is
    an empty frame. Unreadable lines and elements are kept in ``_corrupt_record``."""
    kind = PurePosixPath(path).suffix.lower()
    if kind not in (".json", ".jsonl", ".csv") or not _exists(spark, path):
        return spark.createDataFrame([], schema)
    if kind == ".csv":
        return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"', enforceSchema=False)
    if kind == ".json" and opens(path):
        return read_json_array(spark, path, schema)
    # file systems that only Spark's readers know: one task per JSON array
    with_bad = schema + ", _corrupt_record string"
    return spark.read.schema(with_bad).json(path, multiLine=kind == ".json", columnNameOfCorruptRecord="_corrupt_record")


def load_results(spark: SparkSession, paths, schema: str = RESULTS_SCHEMA) -> DataFrame | None:
    """Strategy rows of the first results artifact that exists, or None."""
    for path in paths:
        if _exists(spark, path):
            raw = spark.read.schema(schema).json(path, multiLine=True)
            return raw.select("metadata", F.explode("strategy_results").alias("strategy", "m")).select(
                "metadata.timestamp", "metadata.total_questions", "strategy", "m.*")
    return None
