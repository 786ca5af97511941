"""The query history as a stream: an append-only event log and windowed strategy metrics."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from querywright.scale import checked_broadcast

DAY = "_history_day"      # partition of a history; rows without a time lie under "none"
SPANS = "_spans"          # beside the partitions: per batch and day the keys it brought (readers skip the name)


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for sink and checkpoint. It lies in the folder the cluster names in
    ``spark.checkpoint.dir``; only a local master may fall back to the machine's own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix=f"{name}-")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to a fresh work folder and read again: computed once, with known sizes for all later uses."""
    folder = work_folder(df.sparkSession, name) + "/rows"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def read_events(spark: SparkSession, folder: str, pattern: str = "events*", files_per_trigger: int | None = None) -> DataFrame:
    """Event files of a folder as a stream, with a proper event-time column."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def read_history(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The events of a history as they were appended."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def known_keys(spark: SparkSession, path: str, field: StructField, low, high, null: bool) -> DataFrame:
    """The keys a history holds from ``low`` to ``high`` (None: none), and the null key if asked for.

    Only days into whose spans these keys fall are read: the join with them prunes partitions at run time. Inside a day files
    and row groups are skipped by their statistics, since they lie sorted by key."""
    day = StructField(DAY, StringType())
    spans = spark.read.schema(StructType([day, StructField("low", field.dataType), StructField("high", field.dataType),
                                          StructField("has_null", BooleanType())])).parquet(f"{path}/{SPANS}")
    key, near, inside = F.col(field.name), F.lit(False), F.lit(False)
    if low is not None:
        near, inside = (F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low)), key.between(F.lit(low), F.lit(high))
    if null:
        near, inside = near | F.col("has_null"), inside | key.isNull()
    days = checked_broadcast(spans.filter(near).select(DAY).distinct())
    rows = spark.read.schema(StructType([field, day])).parquet(path).filter(inside)
    return rows.join(days, DAY, "left_semi").select(key.alias("_known"))


def append_history(events: DataFrame, path: str, checkpoint: str, key: str = "event_id", time: str = "ts"):
    """Append events to a parquet history, one of each key (nulls count as one key), partitioned by the day of ``time``.

    Every micro-batch drops its own copies and what the history holds already. Copies of one key meet wherever they lie: a batch
    reads each day that ever received keys within its own span of keys, and of those days only that span. Keys that grow with
    time thus cost a batch its own days; keys without any order cost it all days. The order of the files and the distance of two
    copies do not matter. Spans are written before the rows they announce, so a batch that is repeated after a failure
    finds what it left and adds nothing twice. A busy day is written by several tasks."""
    spark, field = events.sparkSession, events.schema[key]
    if DAY in events.columns:
        raise ValueError(f"the events hold a column named {DAY}")
    keyed = lambda rows: rows.withColumn(DAY, F.coalesce(F.date_format(time, "yyyy-MM-dd"), F.lit("none")))
    empty = spark.createDataFrame([], events.schema)
    span = (F.min(key).alias("low"), F.max(key).alias("high"), F.coalesce(F.max(F.col(key).isNull()), F.lit(False)).alias("has_null"))
    keyed(empty).write.partitionBy(DAY).mode("append").parquet(path)
    keyed(empty).groupBy(DAY).agg(*span).write.mode("append").parquet(f"{path}/{SPANS}")

    def add(batch: DataFrame, _):
        batch = keyed(batch).persist()
        try:
            all_of_it = batch.agg(*span).first()
            old = known_keys(batch.sparkSession, path, field, *all_of_it)
            batch.groupBy(DAY).agg(*span).coalesce(1).write.mode("append").parquet(f"{path}/{SPANS}")
            fresh = batch.dropDuplicates([key]).join(old, F.col(key).eqNullSafe(F.col("_known")), "left_anti")
            fresh.repartitionByRange(DAY, key).sortWithinPartitions(DAY, key).write.partitionBy(DAY).mode("append").parquet(path)
        finally:
            batch.unpersist()

    return (events.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def strategy_windows(events: DataFrame, strategy: str, ok: str, correct: str, time: str, window: str = "1 day") -> DataFrame:
    """Per window and strategy: calls, correct calls and the mean time of the calls that are ``ok``. The sums are decimal,
    so a window's result does not depend on how its events arrived. Late events count: no watermark closes a window, and
    the state is one row per window and strategy."""
    time_ = F.when(F.col(ok), F.col(time).cast("decimal(18,2)"))  # hundredths of a second
    return (events.groupBy(F.window("ts", window), F.col(strategy).alias("strategy"))
            .agg(F.count(F.lit(1)).alias("calls"), F.sum(F.col(correct).cast("long")).alias("correct"),
                 (F.sum(time_).cast("double") / 100.0 / F.count(time_)).alias("avg_time")))


def run_to_table(stream: DataFrame, path: str, checkpoint: str):
    """Work off a stream's backlog; the table holds the complete result of everything read so far."""
    query = (stream.writeStream.outputMode("complete").foreachBatch(lambda rows, _: rows.write.mode("overwrite").parquet(path))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query
