"""The star schema: loading, view registration, declared keys."""

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
         "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

PRIMARY_KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"],
    "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"], "documents": ["doc_id"],
    "embeddings": ["vec_id"], "pages": ["page_id"], "benchmark": ["item_id"],
    "labels": ["doc_id"], "conversations": ["conv_id", "turn"],
}

FOREIGN_KEYS = (
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("labels", "doc_id", "documents", "doc_id"),
)


class Tables:
    """Lazy handle on a folder of parquet tables: ``Tables(spark, folder).orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, str(folder)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def register_views(spark: SparkSession, folder: str, names=NAMES) -> None:
    tables = Tables(spark, folder)
    for name in names:
        getattr(tables, name).createOrReplaceTempView(name)


def _exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(jpath)


_READERS = {
    ".parquet": lambda spark, path: spark.read.parquet(path),
    ".csv": lambda spark, path: spark.read.csv(path, header=True, inferSchema=True),
    ".json": lambda spark, path: spark.read.json(path, multiLine=True),
    ".jsonl": lambda spark, path: spark.read.json(path),
}


def load_catalog(spark: SparkSession, folder: str, files: dict, register: bool = True) -> dict:
    """Load the named files that exist; fail only when none does."""
    loaded = {}
    for name, file in files.items():
        path = f"{folder}/{file}"
        if not _exists(spark, path):
            continue
        loaded[name] = _READERS[Path(file).suffix.lower()](spark, path)
        if register:
            loaded[name].createOrReplaceTempView(name)
    if not loaded:
        raise FileNotFoundError(f"none of {sorted(files.values())} found in {folder}")
    return loaded


def load_report(tables: dict) -> DataFrame:
    """One row per table: rows and columns (one count job over all tables)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).cast("long").alias("columns"))
        for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column=None, lower=None, upper=None,
              partitions=16, **options) -> DataFrame:
    """Read a relational table, split on a numeric or date column when bounds are given."""
    return jdbc_reader(spark, url, table, partition_column, lower, upper, partitions, **options).load()


def jdbc_reader(spark, url, table, partition_column=None, lower=None, upper=None, partitions=16, **options):
    return spark.read.format("jdbc").options(
        **jdbc_options(url, table, partition_column, lower, upper, partitions, **options))


def jdbc_options(url, table, partition_column=None, lower=None, upper=None, partitions=16, **options) -> dict:
    out = {"url": url, "dbtable": table, "fetchsize": "10000", **{k: str(v) for k, v in options.items()}}
    if partition_column is not None:
        if lower is None or upper is None:
            raise ValueError("a partition column needs lower and upper bounds")
        out.update(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
                   numPartitions=str(partitions))
    return out
