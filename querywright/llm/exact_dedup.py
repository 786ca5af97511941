"""Exact dedup as a stateful stream.

Texts are equal when they are the same after lower-casing A-Z. The stream keeps one state entry per text digest, without
expiry, in a disk-backed state store under the shared folder: the number of rows, and of the row with the largest id its
stable id and content locator (file and row number). Rows are pre-aggregated before they reach the state, so a text that
makes up a third of the corpus is one row per task. A later run on the same state folder takes only new files.

The digest alone decides nothing: wherever a digest was hit more than once, the full bytes of its rows are compared. Should
two texts share a digest, that digest's rows are grouped by their bytes instead.

The state is read back through the state data source. Only the rows of repeated digests move with their texts; the digests
that were hit are sent to the scan while they number at most BROADCAST_KEYS, beyond that they meet the texts in a join.

Edge cases: a null text is empty; a row without an id never stands for its group unless no row of it has one; of rows that
repeat id and text the last by locator stays; an empty table gives an empty result. Other columns are not read."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from querywright.llm.storage import settle, shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BROADCAST_KEYS = 500_000
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    # stores of many partitions are small each; their logs need no space in advance
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does just that on plain ASCII, and faster."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _located(rows: DataFrame, id_col: str, text: str, digest) -> DataFrame:
    norm = normalised(F.col(text))
    return rows.select(
        F.col(id_col).alias("doc_id"), norm.alias("norm"), digest(norm).alias("digest"),
        F.struct(F.col(id_col).alias("id"), F.col("_metadata.file_path").alias("file"),
                 F.col("_metadata.row_index").alias("row")).alias("place"))


def ingest(spark: SparkSession, path: str, state: str, id_col: str = "doc_id", text: str = "text", digest=sha256,
           files_per_trigger: int | None = None) -> None:
    """Run all files under ``path`` that the state has not seen through the state, and stop."""
    schema = spark.read.parquet(path).select(id_col, text).schema
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    path = path.rstrip("/")
    named = f"{path[:-1]}[{path[-1]}]"                 # as a pattern the path may be one file as well as a folder
    rows = _located(reader.parquet(named), id_col, text, digest).select("digest", "place")
    kept = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("place").alias("keeper"))
    before = {k: spark.conf.get(k, None) for k in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        query = (kept.writeStream.format("noop").outputMode("update").option("checkpointLocation", state)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def entries(spark: SparkSession, state: str) -> DataFrame:
    """(digest, n, keeper): the state as a table."""
    held = spark.read.format("statestore").load(state)
    # the state holds the aggregation buffers in the order of the aggregates
    n, keeper = held.schema["value"].dataType.names
    return held.select("key.digest", F.col(f"value.{n}").alias("n"), F.col(f"value.{keeper}").alias("keeper"))


def exact_duplicates(spark: SparkSession, path: str, id_col: str = "doc_id", text: str = "text",
                     state: str | None = None, digest=sha256) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row under ``path``."""
    state = state or f"{shared_folder(spark)}/exact-dedup-{uuid.uuid4().hex}"
    ingest(spark, path, state, id_col, text, digest)
    groups = settle(entries(spark, state))
    rows = _located(spark.read.parquet(path), id_col, text, digest)
    hit = settle(groups.filter("n > 1").select("digest"))
    repeated = rows.join(F.broadcast(hit) if hit.count() <= BROADCAST_KEYS else hit, "digest", "left_semi")
    # all bytes of every repeated text against each other: the smallest and the largest are the same text
    mixed = settle(repeated.groupBy("digest").agg(F.min("norm").alias("low"), F.max("norm").alias("high"))
                   .filter("low <> high").select("digest"))
    lean = rows.select("doc_id", "place", "digest", sha256(F.col("norm")).alias("text_sha256"))
    out = lean.join(groups, "digest")
    if not mixed.isEmpty():
        apart = rows.join(mixed, "digest", "left_semi")
        by_bytes = apart.groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("n"), F.max("place").alias("keeper"))
        split = apart.join(by_bytes, ["digest", "norm"]).withColumn("text_sha256", sha256(F.col("norm")))
        out = out.join(mixed, "digest", "left_anti").unionByName(split.select(*out.columns))
    return out.select("doc_id", F.col("keeper.id").alias("keep_id"), F.col("n").alias("group_size"),
                      (F.col("place") == F.col("keeper")).alias("kept"), "text_sha256")
