"""Table profiling: numeric and categorical summaries, gaps, copies, insights, advice."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from querywright.scale import fits, guarded_corr, quantiles, union_all

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def numeric_columns(df: DataFrame) -> list:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def _value(df: DataFrame, name: str) -> Column:
    """The column as a number; NaN counts as missing."""
    kind = df.schema[name].dataType
    c = F.col(name).cast("double")
    return F.when(~F.isnan(c), c) if isinstance(kind, (T.DoubleType, T.FloatType)) else c


def unpivot(df: DataFrame, columns, value=None, keep=()) -> DataFrame:
    """Long form (column, value) of the named columns."""
    value = value or F.col
    cells = [F.struct(F.lit(c).alias("column"), value(c).alias("value")) for c in columns]
    return df.select(*keep, F.explode(F.array(*cells)).alias("_cell")).select(*keep, "_cell.*")


def numeric_summary(df: DataFrame) -> DataFrame:
    """count, mean, sample std, min, quartiles, max per numeric column: one aggregation. Large
    input takes the quartiles from the distributed plan."""
    names = numeric_columns(df)
    small = fits(df.select(*names))

    def cell(name):
        v = _value(df, name)
        parts = [F.lit(name).alias("column"), F.count(v).alias("count"), F.avg(v).alias("mean"),
                 F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")]
        if small:
            q = F.percentile(v, list(QUARTILES.values()))
            parts += [q[i].alias(n) for i, n in enumerate(QUARTILES)]
        return F.struct(*parts)

    one = df.agg(*[cell(n).alias(n) for n in names])
    out = one.select(F.explode(F.array(*[F.col(n) for n in names])).alias("_s")).select("_s.*")
    if not small:
        long = unpivot(df, names, lambda n: _value(df, n))
        out = out.join(quantiles(long, ["column"], "value", QUARTILES), "column")
    return out.select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def ranges(df: DataFrame) -> DataFrame:
    """Mean, min, max and range of numeric columns that hold any value."""
    names = numeric_columns(df)
    cells = [F.struct(F.lit(n).alias("column"), F.avg(_value(df, n)).alias("mean"), F.min(_value(df, n)).alias("min"),
                      F.max(_value(df, n)).alias("max")).alias(n) for n in names]
    out = df.agg(*cells).select(F.explode(F.array(*names)).alias("_s")).select("_s.*")
    return out.filter(F.col("mean").isNotNull()).withColumn("range", F.col("max") - F.col("min"))


def outliers(df: DataFrame, sigmas: float = 2.0) -> DataFrame:
    """Values further than two sample deviations from the mean, per numeric column. The moments
    are one row, read as a scalar subquery by the counting pass."""
    names = numeric_columns(df)
    moments = df.agg(F.struct(*[
        F.struct(F.avg(_value(df, n)).alias("mean"), F.stddev_samp(_value(df, n)).alias("std")).alias(n)
        for n in names]).alias("m")).scalar()
    tagged = df.select(*[_value(df, n).alias(n) for n in names], moments.alias("_m"))

    def hit(n):
        m = F.col("_m")[n]
        return F.when((m["std"] > 0) & (F.abs(F.col(n) - m["mean"]) > sigmas * m["std"]), 1).otherwise(0)

    one = tagged.agg(*[F.sum(hit(n)).cast("long").alias(n) for n in names])
    return unpivot(one, names).select("column", F.col("value").alias("outliers"))


def skew(df: DataFrame) -> DataFrame:
    """right / left when mean and median differ by more than a tenth of the deviation."""
    s = numeric_summary(df)
    flag = F.when(F.abs(F.col("mean") - F.col("q50")) > 0.1 * F.col("std"),
                  F.when(F.col("mean") > F.col("q50"), "right").otherwise("left"))
    return s.select("column", flag.alias("skew"))


def value_counts(df: DataFrame, names=None) -> DataFrame:
    """(column, value, n) of string columns; null is a value here."""
    names = names or string_columns(df)
    return unpivot(df, names).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def categorical_summary(df: DataFrame) -> DataFrame:
    """Distinct values, the most common one, its share of all rows, and dominance."""
    counts = value_counts(df)
    top = F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("neg"), F.col("value").alias("v"))))
    s = counts.groupBy("column").agg(F.count("value").alias("unique_count"), F.sum("n").alias("_rows"), top.alias("_t"))
    share = F.try_divide(-F.col("_t.neg"), F.col("_rows"))
    dominance = F.when(share > 0.8, "dominated").when((share < 0.2) & (F.col("unique_count") > 5), "well distributed")
    return s.select("column", "unique_count", F.col("_t.v").alias("most_common"),
                    (-F.col("_t.neg")).alias("most_common_count"), share.alias("share"), dominance.alias("dominance"))


def missing(df: DataFrame) -> DataFrame:
    """Nulls per column with the total and the worst column (the first on ties)."""
    cells = [F.struct(F.lit(i).alias("i"), F.lit(c).alias("column"),
                      F.sum(F.col(c).isNull().cast("long")).alias("missing")).alias(f"c{i}")
             for i, c in enumerate(df.columns)]
    one = df.agg(*cells).select(F.array(*[f"c{i}" for i in range(len(df.columns))]).alias("a"))
    total = F.aggregate("a", F.lit(0).cast("long"), lambda acc, x: acc + x["missing"])
    worst = F.array_max(F.transform("a", lambda x: F.named_struct(F.lit("missing"), x["missing"], F.lit("neg"), -x["i"])))
    return (one.select(F.explode("a").alias("x"), total.alias("total_missing"), worst.alias("w"))
            .select("x.column", "x.missing", "total_missing",
                    ((F.col("x.missing") > 0) & (-F.col("x.i") == F.col("w.neg"))).alias("is_worst")))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows."""
    return (df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows")))


def size_class(df: DataFrame) -> DataFrame:
    n = F.col("row_count")
    label = F.when(n == 1, "single row").when(n < 10, "small").when(n > 1000, "large").otherwise("medium")
    return df.agg(F.count(F.lit(1)).alias("row_count")).select("row_count", label.alias("size_class"))


def insights(df: DataFrame, keep: int = 10) -> DataFrame:
    """Ranked sentences: numeric columns, then categorical ones, then the whole table."""
    order = {c: i for i, c in enumerate(df.columns)}

    def position():
        return F.create_map(*[x for c, i in order.items() for x in (F.lit(c), F.lit(i))])[F.col("column")]

    def sentences(frame, section, pos, texts):
        cells = F.array(*[F.struct(F.lit(i).alias("seq"), text.alias("text")) for i, text in enumerate(texts)])
        return (frame.select(F.lit(section).alias("section"), pos.alias("ordinal"), F.explode(cells).alias("c"))
                .select("section", "ordinal", "c.*").filter(F.col("text").isNotNull()))

    col = F.col("column")
    some = F.col("count") > 0
    num = numeric_summary(df).join(outliers(df), "column")
    skewed = F.abs(F.col("mean") - F.col("q50")) > 0.1 * F.col("std")
    frames = []
    if numeric_columns(df):
        frames.append(sentences(num, 1, position(), [
            F.when(~some, F.concat(col, F.lit(": No valid numeric data"))),
            F.when(some, F.format_string("%s: Average is %.2f", col, "mean")),
            F.when(some, F.format_string("%s: Range from %.2f to %.2f", col, "min", "max")),
            F.when(F.col("outliers") > 0, F.format_string("%s: Found %d potential outliers", col, "outliers")),
            F.when(skewed & (F.col("mean") > F.col("q50")), F.concat(col, F.lit(": Data appears right-skewed")))
            .when(skewed, F.concat(col, F.lit(": Data appears left-skewed")))]))
    if string_columns(df):
        cat = categorical_summary(df)
        frames.append(sentences(cat, 2, position(), [
            F.format_string("%s: %d unique values", col, "unique_count"),
            F.when(F.col("unique_count") > 0, F.format_string(
                "%s: Most common value is '%s' (%.1f%%)", col, F.col("most_common"), F.col("share") * 100)),
            F.when(F.col("dominance") == "dominated", F.concat(col, F.lit(": Highly dominated by one value")))
            .when(F.col("dominance") == "well distributed", F.concat(col, F.lit(": Values are well distributed")))]))
    gaps = missing(df).groupBy("total_missing").agg(
        F.max(F.when(F.col("is_worst"), F.col("column"))).alias("column"), F.max("missing").alias("worst"))
    has = F.col("total_missing") > 0
    frames.append(sentences(gaps, 3, F.lit(0), [
        F.when(has, F.format_string("Dataset has %d missing values across all columns", "total_missing")),
        F.when(has, F.format_string("Column '%s' has the most missing values (%d)", col, "worst"))]))
    frames.append(sentences(duplicate_rows(df), 3, F.lit(1), [
        F.when(F.col("duplicate_rows") > 0, F.format_string("Found %d duplicate rows", "duplicate_rows"))]))
    kind = F.col("size_class")
    frames.append(sentences(size_class(df), 3, F.lit(2), [
        F.when(kind == "single row", "Single row result - likely an aggregation or specific lookup")
        .when(kind == "small", "Small result set - good for detailed analysis")
        .when(kind == "large", "Large result set - consider filtering for focused analysis")]))
    return union_all(frames).orderBy("section", "ordinal", "seq").limit(keep)


def summary(df: DataFrame, sql: str = "") -> DataFrame:
    """One sentence about the result and the statement that produced it."""
    upper, parts = sql.upper(), []
    if upper.strip().startswith("SELECT"):
        parts = [text for word, text in (
            ("GROUP BY", "This appears to be an aggregation query."),
            ("JOIN", "This query involves multiple tables."),
            ("ORDER BY", "Results are sorted.")) if word in upper]
    n = F.col("row_count")
    tail = F.when((n > 0) & F.lit(len(numeric_columns(df)) > 0),
                  F.lit(f"Found {len(numeric_columns(df))} numeric columns for analysis."))
    head = F.format_string(f"Query returned %d rows and {len(df.columns)} columns.", n)
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", F.lit(len(df.columns)).cast("long").alias("column_count"),
        F.concat_ws(" ", head, *[F.lit(p) for p in parts], tail).alias("summary"))


def recommendations(df: DataFrame, sql: str = "", keep: int = 5) -> DataFrame:
    upper = sql.upper()
    numeric, text = len(numeric_columns(df)), len(string_columns(df))
    nulls = sum((F.sum(F.col(c).isNull().cast("long")) for c in df.columns), F.lit(0))
    n, gaps = F.col("n"), F.col("gaps")
    rules = [
        (F.lit("LIMIT" not in upper) & (n > 100), "Consider adding LIMIT clause for large result sets"),
        (F.lit("ORDER BY" not in upper) & (n > 10), "Consider adding ORDER BY for consistent results"),
        (F.lit(numeric > 1), "Multiple numeric columns found - consider correlation analysis"),
        (F.lit(numeric > 0), "Numeric data available - consider aggregations (SUM, AVG, MAX)"),
        (F.lit(text > 0), "Categorical data found - consider GROUP BY analysis"),
        (gaps > 0, "Missing values detected - consider data cleaning"),
    ]
    texts = F.filter(F.array(*[F.when(test, F.lit(text)) for test, text in rules]), lambda x: x.isNotNull())
    empty = F.array(F.lit("No data to analyze - check your query conditions"))
    return (df.agg(F.count(F.lit(1)).alias("n"), nulls.alias("gaps"))
            .select(F.posexplode(F.slice(F.when(n == 0, empty).otherwise(texts), 1, keep)).alias("pos", "recommendation"))
            .select((F.col("pos") + 1).cast("long").alias("ordinal"), "recommendation"))


def correlation_matrix(df: DataFrame, columns) -> DataFrame:
    """Pearson r of every pair, in one aggregation; null where a side is constant."""
    as_number = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    pairs = [(a, b) for a in columns for b in columns]
    one = as_number.agg(*[guarded_corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"{a}|{b}").alias("r")) for a, b in pairs]
    return one.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*")


def integrity(tables: dict, primary_keys: dict, foreign_keys) -> DataFrame:
    """Declared keys checked on the data: repeated primary keys and rows without a parent."""
    parts = []
    for name, key in primary_keys.items():
        if name in tables:
            repeated = tables[name].groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
            parts.append((repeated, "primary_key", name, ",".join(key)))
    for name, column, parent, parent_key in foreign_keys:
        if name in tables and parent in tables:
            child = tables[name].filter(F.col(column).isNotNull())
            orphans = child.join(tables[parent].select(F.col(parent_key).alias("_pk")), F.col(column) == F.col("_pk"), "left_anti")
            parts.append((orphans, "foreign_key", name, column))
    return union_all([p.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(kind).alias("check"), F.lit(name).alias("table_name"), F.lit(cols).alias("columns"), "violations")
        for p, kind, name, cols in parts])
