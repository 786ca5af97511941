"""The numbers behind each chart. Drawing is left to the reader's tool."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from querywright.operators.profile import numeric_columns, string_columns, unpivot
from querywright.scale import checked_broadcast, cumulative_counts, quantiles


def choose_chart(df: DataFrame) -> DataFrame:
    """One row: the chart type for the column classes; only pie vs bar looks at the data, and it
    stops after eleven rows."""
    numeric, text = len(numeric_columns(df)), len(string_columns(df))
    if numeric == 1 and text >= 1:
        few = df.limit(11).agg(F.count(F.lit(1)).alias("n"))
        return few.select(F.when(F.col("n") <= 10, "pie").otherwise("bar").alias("chart_type"))
    kind = "scatter" if numeric >= 2 else "histogram" if numeric == 1 else "bar"
    return df.limit(1).agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("chart_type"))


def available_charts(df: DataFrame) -> DataFrame:
    numeric, text = len(numeric_columns(df)), len(string_columns(df))
    kinds = ["bar"] + (["line", "histogram"] if numeric else []) + (["pie"] if text else []) + (
        ["scatter"] if numeric >= 2 else [])
    some = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    kinds_col = F.array(*[F.lit(k) for k in kinds])
    return (some.filter("n > 0").select(F.posexplode(kinds_col).alias("pos", "chart_type"))
            .select((F.col("pos") + 1).cast("long").alias("ordinal"), "chart_type"))


def class_summary(df: DataFrame) -> DataFrame:
    """Rows, columns, numeric and categorical columns, names."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(df.columns)).cast("long").alias("columns"),
        F.lit(len(numeric_columns(df))).cast("long").alias("numeric_columns"),
        F.lit(len(string_columns(df))).cast("long").alias("categorical_columns"),
        F.lit(", ".join(df.columns)).alias("column_names"))


def _counts(df, label):
    return df.filter(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("value"))


def bar_data(df: DataFrame, row_key: str | None = None) -> DataFrame:
    """First categorical against first numeric column; counts per category without a numeric one;
    else the first three numeric columns per row (``row_key`` names the row)."""
    numeric, text = numeric_columns(df), string_columns(df)
    if text and numeric:
        return df.select(F.col(text[0]).alias("label"), F.col(numeric[0]).cast("double").alias("value"))
    if text:
        return _counts(df, text[0])
    shown = [c for c in numeric if c != row_key][:3]
    return unpivot(df, shown, lambda c: F.col(c).cast("double"), keep=[row_key]).select(
        F.col(row_key).alias("row"), F.col("column").alias("series"), "value")


def line_data(df: DataFrame) -> DataFrame:
    """First numeric column as x, the next up to three as series."""
    x, *series = numeric_columns(df)[:4]
    return unpivot(df, series, lambda c: F.col(c).cast("double"), keep=[x]).select(
        F.col(x).alias("x"), F.col("column").alias("series"), F.col("value").alias("y"))


def pie_data(df: DataFrame) -> DataFrame:
    """Value per label with its share: sums of the first numeric column, else counts."""
    numeric, text = numeric_columns(df), string_columns(df)
    if not numeric:
        parts = _counts(df, text[0])
        total = df.agg(F.count(text[0])).scalar()
        return parts.select("label", "value", F.try_divide("value", total).alias("share"))
    value = F.col(numeric[0]).cast("decimal(18,2)")
    parts = df.groupBy(F.col(text[0]).alias("label")).agg(F.sum(value).cast("double").alias("value"))
    total = df.agg(F.sum(value).cast("double")).scalar()
    return parts.select("label", "value", F.try_divide("value", total).alias("share"))


def scatter_data(df: DataFrame) -> DataFrame:
    x, y = numeric_columns(df)[:2]
    colour = [F.col(c).alias("colour") for c in string_columns(df)[:1]]
    return df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), *colour)


def _binned(df: DataFrame, value: str, bins: int, keys, right_closed: bool) -> DataFrame:
    """Counts per equal-width bin. The edges are one row (a scalar subquery), shared by all keys;
    a value is placed by comparing it with the edges, so rounding cannot move it."""
    x = F.col(value).cast("double")
    keep = [F.col(k) for k in keys]
    edges = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi")).alias("e")).scalar()
    rows = df.filter(x.isNotNull()).select(*keep, x.alias("_x"), edges.alias("_e"))

    def edge(i):
        return F.col("_e.lo") + i * ((F.col("_e.hi") - F.col("_e.lo")) / bins)

    # a guess by division, moved by one where the comparison with the edges says so
    place = F.try_divide(F.col("_x") - F.col("_e.lo"), (F.col("_e.hi") - F.col("_e.lo")) / bins)
    guess = F.ceil(place) - 1 if right_closed else F.floor(place)
    guess = F.least(F.greatest(F.coalesce(guess, F.lit(0)), F.lit(0)), F.lit(bins - 1)).cast("int")
    rows = rows.withColumn("_g", guess)
    below, above = edge(F.col("_g")), edge(F.col("_g") + 1)
    x_ = F.col("_x")
    down = (x_ <= below) if right_closed else (x_ < below)
    up = (x_ > above) if right_closed else (x_ >= above)
    slot = (F.when(down & (F.col("_g") > 0), F.col("_g") - 1).when(up & (F.col("_g") < bins - 1), F.col("_g") + 1)
            .otherwise(F.col("_g")))
    counts = rows.groupBy(*keys, slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    slots = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), edges.alias("_e"))
    if keys:
        slots = df.select(*keep).distinct().select(*keep, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
                                                   edges.alias("_e"))
    lower = edge(F.col("bin"))
    if right_closed:
        lower = F.when(F.col("bin") == 0, F.col("_e.lo") - 0.001 * (F.col("_e.hi") - F.col("_e.lo"))).otherwise(lower)
    return (slots.join(counts, [*keys, "bin"], "left")
            .select(*keys, (F.col("bin") + 1).cast("long").alias("bin"), lower.alias("lower"),
                    edge(F.col("bin") + 1).alias("upper"), F.coalesce("n", F.lit(0)).alias("n")))


def cut_bins(df: DataFrame, value: str, bins: int = 5) -> DataFrame:
    """Right-closed equal-width bins, the lowest edge widened by a thousandth of the range."""
    return _binned(df, value, bins, (), True)


def histogram(df: DataFrame, value: str, bins: int = 20, keys=()) -> DataFrame:
    """Left-closed equal-width bins, the last one closed; empty bins are kept."""
    return _binned(df, value, bins, tuple(keys), False)


def empirical_cdf(df: DataFrame, key: str, value: str) -> DataFrame:
    """Steps of the cumulative distribution per key: one row per distinct value with the height
    before its first and after its last copy."""
    counts = cumulative_counts(df.filter(F.col(value).isNotNull()), [key], value)
    totals = df.groupBy(key).agg(F.count(value).alias("_all"))
    step = counts.join(checked_broadcast(totals), key)
    return step.select(key, value, "n", ((F.col("before") + 1) / F.col("_all")).alias("first_step"),
                       ((F.col("before") + F.col("n")) / F.col("_all")).alias("last_step"))


def percentile_table(df: DataFrame, key: str, value: str, percents=(50, 75, 90, 95, 99)) -> DataFrame:
    return quantiles(finite(df, value), [key], value, {f"p{p}": p / 100 for p in percents})


def finite(df: DataFrame, value: str) -> DataFrame:
    """Rows of successful calls (a failed call has an infinite time)."""
    return df.filter(F.col(value) != float("inf"))


def box_summary(df: DataFrame, key: str, value: str) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers and the number of points beyond them."""
    rows = finite(df, value).select(key, value)
    box = quantiles(rows, [key], value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    joined = rows.join(checked_broadcast(box), key)
    inside = (F.col(value) >= F.col("q1") - reach) & (F.col(value) <= F.col("q3") + reach)
    return joined.groupBy(key, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(value))).alias("whisker_low"), F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.sum((~inside).cast("long")).alias("outliers"), F.count(F.lit(1)).alias("n"))


def linear_trend(df: DataFrame, x: str, ys) -> DataFrame:
    """Least-squares slope and intercept of each y against x, in one aggregation."""
    def num(c) -> Column:
        return F.col(c).cast("double")

    slope = {y: F.try_divide(F.covar_pop(num(x), num(y)), F.var_pop(num(x))) for y in ys}
    one = df.agg(*[F.struct(F.lit(y).alias("target"), slope[y].alias("slope"),
                            (F.avg(num(y)) - slope[y] * F.avg(num(x))).alias("intercept")).alias(y) for y in ys])
    return one.select(F.explode(F.array(*ys)).alias("_t")).select("_t.*")


def radar_data(metrics: DataFrame, key: str, columns) -> DataFrame:
    return unpivot(metrics, columns, lambda c: F.col(c).cast("double"), keep=[key]).select(
        key, F.col("column").alias("metric"), "value")
