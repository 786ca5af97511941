"""Scoring of predicted SQL against true SQL, column-wise and without shuffles where possible."""

import time

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from querywright.functions.sqltext import normalise, referenced_tables, strip, text, tokens, word_set
from querywright.operators.guard import run_readonly
from querywright.scale import spread, union_all

JACCARD_THRESHOLD = 0.7
BLEU_ORDER = 4
BLEU_EPSILON = 0.1


def exact_match(pred, truth, mode: str = "normalised") -> Column:
    if mode == "strict":
        return F.upper(strip(text(pred))) == F.upper(strip(text(truth)))
    return normalise(pred) == normalise(truth)


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of two word sets; 0 when both are empty."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.coalesce(F.try_divide(both, either), F.lit(0.0))


def structural_match(pred, truth) -> Column:
    return jaccard(word_set(normalise(pred)), word_set(normalise(truth))) > JACCARD_THRESHOLD


def _grams(toks: str, size: str, n: int) -> Column:
    """Sorted n-grams of a token array."""
    starts = F.sequence(F.lit(1), F.col(size) - n + 1)
    grams = F.sort_array(F.transform(starts, lambda i: F.array_join(F.slice(toks, i, n), "\u0001")))
    return F.when(~F.col("_same") & (F.col(size) >= n), grams).otherwise(F.array().cast("array<string>"))


def _numbered(grams: str) -> Column:
    """Grams with their occurrence number, so that a set intersection counts clipped matches. The
    array is a column of its own: inside the function it must not be computed again per gram."""
    return F.transform(grams, lambda g, i: F.concat(g, F.lit("\u0002"), (i - F.array_position(grams, g)).cast("string")))


def _matches(n: int) -> Column:
    """Clipped n-gram matches. Equal texts match everywhere; without repeats on one side the common
    set is the answer; only the rest needs occurrence numbers."""
    p, t = F.col(f"_gp{n}"), F.col(f"_gt{n}")
    no_repeats = (F.size(F.array_distinct(p)) == F.size(p)) | (F.size(F.array_distinct(t)) == F.size(t))
    return (F.when(F.col("_same"), F.greatest(F.col("_np") - n + 1, F.lit(0)))
            .when(no_repeats, F.size(F.array_intersect(p, t)))
            .otherwise(F.size(F.array_intersect(_numbered(f"_gp{n}"), _numbered(f"_gt{n}")))))


def with_bleu(df: DataFrame, pred: str, truth: str, name: str = "bleu_score") -> DataFrame:
    """Add BLEU-4 (uniform weights, epsilon smoothing, brevity penalty). Each row is scored from its
    own two token arrays: no explode and no shuffle."""
    orders = range(1, BLEU_ORDER + 1)
    staged = spread(df).withColumns({"_p": tokens(pred), "_t": tokens(truth)})
    staged = staged.withColumns({"_np": F.size("_p"), "_nt": F.size("_t"), "_same": F.col("_p") == F.col("_t")})
    staged = staged.withColumns({f"_g{s}{n}": _grams(f"_{s}", f"_n{s}", n) for s in "pt" for n in orders})
    staged = staged.withColumns({f"_m{n}": _matches(n) for n in orders})
    logs = F.lit(0.0)
    for n in range(1, BLEU_ORDER + 1):
        total = F.greatest(F.lit(1), F.col("_np") - n + 1)
        hits = F.when(F.col(f"_m{n}") > 0, F.col(f"_m{n}").cast("double")).otherwise(F.lit(BLEU_EPSILON))
        logs = logs + F.ln(hits / total) / BLEU_ORDER
    brevity = F.when(F.col("_np") > F.col("_nt"), F.lit(0.0)).otherwise(1 - F.try_divide(F.col("_nt"), F.col("_np")))
    score = F.when((F.col("_np") == 0) | (F.col("_nt") == 0) | (F.col("_m1") == 0), F.lit(0.0)).otherwise(
        F.exp(brevity + logs))
    return staged.select(*df.columns, score.alias(name))


def schema_compliant(pred, tables) -> Column:
    """Every referenced table is in the catalog (case-insensitive); empty SQL never complies."""
    known = F.array(*[F.lit(t.upper()) for t in tables])
    return (strip(text(pred)) != "") & (F.size(F.array_except(referenced_tables(pred), known)) == 0)


def evaluate(pairs: DataFrame, tables, pred: str = "pred_sql", truth: str = "truth_sql") -> DataFrame:
    """The evaluation record of each pair; a missing prediction becomes an error row."""
    failed = F.col(pred).isNull()
    scored = with_bleu(pairs, pred, truth)
    return scored.select(
        *pairs.columns,
        (~failed & structural_match(pred, truth)).alias("execution_correct"),
        (~failed & exact_match(pred, truth)).alias("exact_match"),
        (~failed & schema_compliant(pred, tables)).alias("schema_compliant"), "bleu_score",
        F.when(failed, F.lit("no prediction")).alias("error_message"))


def align(predictions: DataFrame, truths: DataFrame, key: str) -> tuple:
    """(aligned pairs, unmatched keys): replaces the equal-length check of list input."""
    p = predictions.withColumn("_p", F.lit(True))
    t = truths.withColumn("_t", F.lit(True))
    both = p.join(t, key, "full_outer")
    side = F.when(F.col("_t").isNull(), "prediction only").otherwise("truth only")
    lonely = both.filter(F.col("_p").isNull() | F.col("_t").isNull()).select(key, side.alias("side"))
    return p.drop("_p").join(t.drop("_t"), key), lonely


def simple_accuracy(pred, truth) -> Column:
    """Equal without semicolons, or word overlap above the threshold."""
    def flat(c):
        return F.replace(F.upper(strip(text(c))), F.lit(";"), F.lit(""))
    a, b = word_set(flat(pred)), word_set(flat(truth))
    return (flat(pred) == flat(truth)) | ((F.size(a) > 0) & (F.size(b) > 0) & (jaccard(a, b) > JACCARD_THRESHOLD))


def same_result(a: DataFrame, b: DataFrame, mode: str = "set") -> DataFrame:
    """One row ``same``: equal row counts and equal sets (or bags) of rows. Columns are matched by
    name. One shuffle: both sides are counted per distinct row."""
    if sorted(a.columns) != sorted(b.columns):
        return a.sparkSession.range(1).select(F.lit(False).alias("same"))
    names = sorted(a.columns)
    tagged = (a.select(*names, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
              .unionByName(b.select(*names, F.lit(0).alias("_a"), F.lit(1).alias("_b"))))
    per_row = tagged.groupBy(*names).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    agree = (F.col("_a") == F.col("_b")) if mode == "bag" else ((F.col("_a") > 0) & (F.col("_b") > 0))
    return per_row.agg((F.coalesce(F.bool_and(agree), F.lit(True))
                        & (F.coalesce(F.sum("_a"), F.lit(0)) == F.coalesce(F.sum("_b"), F.lit(0)))).alias("same"))


def timed_map(df: DataFrame, fn, input_col: str, output_col: str = "output") -> DataFrame:
    """Call ``fn(text)`` per row inside Arrow batches; a failing call has infinite time and no output."""
    schema = T.StructType([*df.schema.fields, T.StructField(output_col, T.StringType()),
                           T.StructField("response_time", T.DoubleType())])

    def run(batches):
        for batch in batches:
            outputs, times = [], []
            for value in batch[input_col]:
                start = time.perf_counter()
                try:
                    outputs.append(fn(value))
                    times.append(time.perf_counter() - start)
                except Exception:  # the failure is the measurement
                    outputs.append(None)
                    times.append(float("inf"))
            yield batch.assign(**{output_col: pd.Series(outputs, index=batch.index, dtype="object"),
                                  "response_time": pd.Series(times, index=batch.index, dtype="float64")})
    return spread(df).mapInPandas(run, schema)
