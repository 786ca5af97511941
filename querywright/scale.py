"""Building blocks that keep every operator safe on large or skewed input.

* ``fits`` asks Catalyst for the size of a plan; a one-task or broadcast plan is taken
  only below the limit, and each caller has a distributed plan beyond it.
* ``top_k`` is planned with WindowGroupLimit, so a hot group sends k rows per task.
* ``quantiles`` and ``cumulative_counts`` are exact without a task that sees a whole group.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SINGLE_TASK_BYTES = "spark.querywright.singleTaskBytes"
BROADCAST_BYTES = "spark.querywright.broadcastBytes"
RANGE_BUCKETS = "spark.querywright.rangeBuckets"
SKETCH_ACCURACY = "spark.querywright.sketchAccuracy"

SPLIT_BYTES = 128 << 20  # Spark's default size of a file split
SMALL_SPLIT_BYTES = 4 << 20  # smaller splits are not made to give every core one

DEFAULTS = {
    SINGLE_TASK_BYTES: 32 << 20,
    BROADCAST_BYTES: 32 << 20,
    RANGE_BUCKETS: 256,
    SKETCH_ACCURACY: 100_000,
}


def setting(df: DataFrame, key: str) -> int:
    return int(df.sparkSession.conf.get(key, str(DEFAULTS[key])))


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan (no job is run)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits(df: DataFrame, key: str = SINGLE_TASK_BYTES) -> bool:
    return estimated_bytes(df) <= setting(df, key)


def few_rows(df: DataFrame, row_bytes: int = 64) -> bool:
    """Whether a frame holds no more rows than the broadcast limit allows. Reading stops at the
    limit, so the check is cheap on any size."""
    if fits(df, BROADCAST_BYTES):
        return True
    bound = max(1, setting(df, BROADCAST_BYTES) // row_bytes)
    return df.limit(bound + 1).count() <= bound


def broadcast_if(df: DataFrame, small: bool) -> DataFrame:
    """Broadcast under a proven bound; otherwise leave the join to Catalyst and AQE."""
    return F.broadcast(df) if small else df


def checked_broadcast(df: DataFrame, row_bytes: int = 64) -> DataFrame:
    """Broadcast a derived frame after its row count is checked. The rows are fetched by the check
    (at most the limit) and reused, so the frame is computed once; a larger frame stays a plan."""
    if fits(df, BROADCAST_BYTES):
        return F.broadcast(df)
    bound = max(1, setting(df, BROADCAST_BYTES) // row_bytes)
    rows = df.limit(bound + 1).toArrow()
    if rows.num_rows > bound:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def sum_by_dimension(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str, group, sums: dict,
                     sized_by: DataFrame | None = None) -> DataFrame:
    """Sums of a fact table per attribute of a dimension.

    A dimension within the broadcast limit is joined in the scan stage. A larger one is joined
    after the fact rows are summed per key, so that only one row per key and task is shuffled and
    a hot key weighs no more than any other. ``sized_by`` is the table that bounds the dimension
    when it is itself a join."""
    if fits(dim if sized_by is None else sized_by, BROADCAST_BYTES):
        joined = fact.join(F.broadcast(dim), F.col(fact_key) == F.col(dim_key))
        return joined.groupBy(*group).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    partial = fact.groupBy(fact_key).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    return (partial.join(dim, F.col(fact_key) == F.col(dim_key)).groupBy(*group)
            .agg(*[F.sum(n).alias(n) for n in sums]))


def top_k(df: DataFrame, keys, order, k: int, rank: str = "rank", keep_rank: bool = True) -> DataFrame:
    """First ``k`` rows per key. ``order`` must be total so that the result is repeatable."""
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)
    return out if keep_rank else out.drop(rank)


def _bucket(value: Column, cuts) -> Column:
    """Index of the range bucket of ``value`` as a balanced tree of comparisons."""
    def tree(lo, hi):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value <= F.lit(cuts[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))
    return tree(0, len(cuts))


def range_bucket(df: DataFrame, value: str) -> Column:
    """A repeatable range-partition number for a numeric column. The cut points are one row of
    at most ``rangeBuckets`` numbers from a quantile sketch, fetched once so that every use of
    the bucket in a plan (and every retried task) agrees."""
    n = setting(df, RANGE_BUCKETS)
    probs = [i / n for i in range(1, n)]
    row = df.agg(F.percentile_approx(F.col(value), probs, 10_000).alias("cuts")).first()
    cuts = sorted(set(row.cuts or []))
    return _bucket(F.col(value), cuts)


def cumulative_counts(df: DataFrame, keys, value: str, distributed: bool | None = None) -> DataFrame:
    """(keys, value, n, before): rows per value and rows of the key with a smaller value.

    Rows are counted per value before anything is ordered, so copies of one value cost one row."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    if distributed is None:
        distributed = not fits(df.select(*keys, value))
    return running_totals(counts, keys, value, distributed)


def running_totals(counts: DataFrame, keys, value: str, distributed: bool) -> DataFrame:
    """Add ``before``: the sum of ``n`` over smaller values of the key.

    In the distributed plan a running total is kept per range bucket and shifted by the totals of
    the buckets before it, so no task orders a whole key."""
    prior = (Window.unboundedPreceding, -1)
    if not distributed:
        w = Window.partitionBy(*keys).orderBy(value).rowsBetween(*prior)
        return counts.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)).cast("long"))
    counts = counts.withColumn("_b", range_bucket(counts, value))
    totals = counts.groupBy(*keys, "_b").agg(F.sum("n").alias("_bn"))
    wt = Window.partitionBy(*keys).orderBy("_b").rowsBetween(*prior)
    totals = totals.select(*keys, "_b", F.coalesce(F.sum("_bn").over(wt), F.lit(0)).alias("_shift"))
    wb = Window.partitionBy(*keys, "_b").orderBy(value).rowsBetween(*prior)
    return (counts.withColumn("_in", F.coalesce(F.sum("n").over(wb), F.lit(0)))
            .join(totals, [*keys, "_b"])
            .withColumn("before", (F.col("_in") + F.col("_shift")).cast("long")).drop("_in", "_shift", "_b"))


def quantiles(df: DataFrame, keys, value: str, probs: dict, distributed: bool | None = None) -> DataFrame:
    """One row per key with linear-interpolated quantiles; ``probs`` maps output name to
    probability. Nulls are skipped.

    Beyond the single-task limit: a sketch brackets each quantile, one pass counts the rows
    below the bracket and the rows per value inside it, and the exact order statistics are read
    from the bracket, which holds a fixed small share of the rows."""
    names, ps = list(probs), [float(p) for p in probs.values()]
    if distributed is None:
        distributed = not fits(df.select(*keys, value))
    if not distributed:
        arr = df.groupBy(*keys).agg(F.percentile(value, ps).alias("_q"))
        return arr.select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    const = F.lit(0).alias("_k")
    rows = df.select(*keys, const, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    gk = [*keys, "_k"]
    acc = setting(df, SKETCH_ACCURACY)
    eps = 2.0 / acc
    lows, highs = [max(0.0, p - eps) for p in ps], [min(1.0, p + eps) for p in ps]
    sketch = rows.groupBy(*gk).agg(
        F.percentile_approx("_v", lows + highs, acc).alias("_s"), F.count("_v").alias("_n"),
        F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    tiny = F.col("_n") < F.lit(acc)

    def bound(i, edge, p):
        at_edge = tiny | F.lit(p in (0.0, 1.0))
        return F.when(at_edge, F.col(edge)).otherwise(F.col("_s")[i])

    brackets = sketch.select(*gk, "_n", F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), F.lit(p).alias("p"),
                 bound(i, "_min", lows[i]).alias("lo"), bound(i + len(ps), "_max", highs[i]).alias("hi"))
        for i, (n, p) in enumerate(zip(names, ps))])).alias("_b")).select(*gk, "_n", "_b.*")
    joined = rows.join(checked_broadcast(brackets), gk).filter(F.col("_v") <= F.col("hi"))
    # every row below a bracket folds into one line per key and quantile
    slot = F.when(F.col("_v") >= F.col("lo"), F.col("_v"))
    counts = joined.groupBy(*gk, "name", "p", "_n", slot.alias("_v")).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(*gk, "name").orderBy(F.col("_v").asc_nulls_first())
    ranked = counts.withColumn("_upto", F.sum("c").over(w)).filter(F.col("_v").isNotNull())
    pos = F.col("p") * (F.col("_n") - 1)
    at_floor = F.col("_upto") > F.floor(pos)
    at_ceil = F.col("_upto") > F.ceil(pos)
    picked = ranked.groupBy(*gk, "name").agg(
        F.min(F.when(at_floor, F.col("_v"))).alias("a"), F.min(F.when(at_ceil, F.col("_v"))).alias("b"),
        F.first(pos - F.floor(pos)).alias("f"))
    val = F.when(F.col("f") == 0, F.col("a")).otherwise(F.col("a") + (F.col("b") - F.col("a")) * F.col("f"))
    out = picked.groupBy(*gk).agg(*[F.max(F.when(F.col("name") == n, val)).alias(n) for n in names])
    if keys:
        every = df.select(*keys).distinct()
        return every.join(out, list(keys), "left").select(*keys, *names)
    return out.agg(*[F.max(n).alias(n) for n in names])


def spread(df: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Give row-by-row work with a small input all cores. An input with a split per core or more is
    left as it is, so large data is not shuffled."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if estimated_bytes(df) < cores * split_bytes else df


def union_all(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def guarded_corr(x, y) -> Column:
    """Pearson r, null instead of an error when a side is constant."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def rate(flag) -> Column:
    return F.avg(F.col(flag).cast("double")) if isinstance(flag, str) else F.avg(flag.cast("double"))
