"""Reliable intermediate results and small Arrow helpers shared by the operators."""

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SLICE_ROWS = 256

_own: dict[str, str] = {}  # by application: the folder taken where the setting is missing


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it. Where the setting is missing, a folder
    of this machine is taken under a local master; another master is refused, since its executors would not see it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="llm-")
    return _own[app]


def settle(df: DataFrame) -> DataFrame:
    """Write a frame to reliable storage and cut its lineage: an executor's loss never repeats what came before, and
    every later use reads the same rows."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """The frame written as a columnar table under the shared folder and read again: like ``settle``, compressed, for wide
    or large frames of which later steps read some columns. The folder goes with the application's shared folder."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches, rows: int = SLICE_ROWS):
    """Arrow batches in small slices, so that the Python objects of a task stay few."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def to_batch(schema: pa.Schema, columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
