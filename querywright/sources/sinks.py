"""Writers. Paths are given by the caller and belong on storage all executors see."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from querywright.operators.analytics import best_technique, recommendations
from querywright.operators.clean import clean_catalog
from querywright.scale import estimated_bytes


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a work folder that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def write_splits(df: DataFrame, folder: str, column: str = "split") -> None:
    """JSON lines under one folder per split."""
    df.write.mode("overwrite").partitionBy(column).json(folder)


def write_clean(tables: dict, folder: str, keys: dict | None = None, format: str = "parquet") -> None:
    """Cleaned tables (parquet, or csv with header) under ``folder/tables`` and their statistics as JSON."""
    clean_catalog(tables, folder, keys, format).write.mode("overwrite").json(f"{folder}/stats")


def write_metrics(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(f"{folder}/csv")
    df.write.mode("overwrite").json(f"{folder}/json")


def nested_results(df: DataFrame, key: str = "question_id") -> DataFrame:
    """One row per question with an array of its strategy results (a handful per question)."""
    fields = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("results"))


def write_results(df: DataFrame, path: str, key: str = "question_id") -> None:
    nested_results(df, key).write.mode("overwrite").json(path)


BUCKET_BYTES = 256 << 20


def bucket_count(tables, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for tables that are joined with each other: a power of two, sized by the largest, so that a bucket holds
    about ``bucket_bytes`` of files. Small tables get one per core."""
    tables = list(tables)
    least = tables[0].sparkSession.sparkContext.defaultParallelism
    wanted = max(least, *[-(-estimated_bytes(df) // bucket_bytes) for df in tables])
    return 1 << (wanted - 1).bit_length()


def register_tables(spark: SparkSession, tables: dict, bucket_keys: dict, buckets: int | None = None,
                    location: str | None = None, replace: bool = False) -> None:
    """Load tables for query. A table with a join key is bucketed and sorted on it, so joins on that key need no shuffle;
    the others become views. The number of buckets follows from the tables' sizes unless given. ``location`` puts the
    files elsewhere than in the warehouse; a table of the same name is an error unless ``replace``."""
    bucketed = [df for name, df in tables.items() if name in bucket_keys]
    if bucketed and buckets is None:
        buckets = bucket_count(bucketed)
    for name, df in tables.items():
        if name in bucket_keys:
            key = bucket_keys[name]
            if replace:
                spark.sql(f"DROP TABLE IF EXISTS {name}")
            rows = df.repartition(buckets, key)  # one file per bucket
            writer = rows.write.mode("errorifexists").bucketBy(buckets, key).sortBy(key).format("parquet")
            (writer.option("path", f"{location}/{name}") if location else writer).saveAsTable(name)
        else:
            df.createOrReplaceTempView(name)


def save_cards(cards: DataFrame, path: str) -> None:
    cards.write.mode("overwrite").partitionBy("type").parquet(path)


def load_cards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def comparison_summary(metrics: DataFrame) -> DataFrame:
    """One JSON-ready row: best technique, metrics per technique, advice (rows per technique only)."""
    fields = [c for c in metrics.columns if c != "technique"]
    per = metrics.agg(F.map_from_entries(F.array_sort(F.collect_list(
        F.struct("technique", F.struct(*fields).alias("metrics"))))).alias("comparative_metrics"))
    advice = recommendations(metrics).agg(F.transform(F.array_sort(F.collect_list(
        F.struct("section", "technique", "seq", "text"))), lambda x: x["text"]).alias("a")).scalar()
    best = best_technique(metrics).select("best_technique").scalar()
    return per.withColumn("recommendations", advice).withColumn("best_technique", best)


def write_comparison(metrics: DataFrame, path: str) -> None:
    comparison_summary(metrics).write.mode("overwrite").json(path)
