"""Where user code plugs in: models, techniques and metrics. User functions run in Arrow batches."""

import inspect

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from querywright.operators.evaluate import timed_map
from querywright.scale import spread, union_all

DEFAULT_CONFIDENCE = 0.5


def generate(df: DataFrame, load, prompt: str = "prompt", output: str = "response") -> DataFrame:
    """Apply a model to a column of prompts. ``load()`` runs once per task and returns
    ``generate(prompt) -> text``."""
    schema = T.StructType([*df.schema.fields, T.StructField(output, T.StringType())])

    def run(batches):
        model = load()
        for batch in batches:
            yield batch.assign(**{output: [model(p) for p in batch[prompt]]})
    return spread(df).mapInPandas(run, schema)


def run_techniques(df: DataFrame, techniques: dict, key: str) -> DataFrame:
    """(key, technique, predicted_sql, confidence_score, response_time) for each technique, a
    ``fn(row dict)`` that returns a dict with sql and confidence, or a text. A failing call has an
    infinite time, no SQL and zero confidence."""
    import time

    key_type = df.schema[key].dataType.simpleString()
    schema = f"{key} {key_type}, technique string, predicted_sql string, confidence_score double, response_time double"

    def runner(name, fn):
        def run(batches):
            for batch in batches:
                rows = []
                for row in batch.to_dict("records"):
                    start = time.perf_counter()
                    try:
                        result = fn(row)
                        if not isinstance(result, dict):
                            result = {"sql": str(result)}
                        rows.append((row[key], name, result.get("sql", ""), float(result.get("confidence", DEFAULT_CONFIDENCE)),
                                     time.perf_counter() - start))
                    except Exception:  # a failure is a result
                        rows.append((row[key], name, "", 0.0, float("inf")))
                yield pd.DataFrame(rows, columns=[key, "technique", "predicted_sql", "confidence_score", "response_time"])
        return run
    base = spread(df)
    return union_all([base.mapInPandas(runner(n, f), schema) for n, f in techniques.items()])


METRICS = {}


def register_metric(name: str, metric) -> None:
    """``metric`` takes no argument and returns an aggregate Column, or takes a DataFrame and keys
    and returns a DataFrame with the keys and a column of its name."""
    METRICS[name] = metric


def compute_metrics(df: DataFrame, keys, names=None) -> DataFrame:
    """All simple metrics in one aggregation; frame metrics are joined on the keys."""
    names = list(names or METRICS)
    simple = [n for n in names if not inspect.signature(METRICS[n]).parameters]
    aggregates = [METRICS[n]().alias(n) for n in simple] or [F.count(F.lit(1)).alias("n")]
    out = df.groupBy(*keys).agg(*aggregates)
    for n in names:
        if n not in simple:
            out = out.join(METRICS[n](df, keys), list(keys))
    return out


def column_metric(expression: Column):
    return lambda: expression


__all__ = ["generate", "run_techniques", "register_metric", "compute_metrics", "column_metric", "timed_map", "METRICS"]
