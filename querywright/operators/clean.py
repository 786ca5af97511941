"""Table cleaning: copies, gaps, dates and text, with before/after statistics."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from querywright.operators.profile import numeric_columns, string_columns, unpivot, value_counts
from querywright.scale import fits, quantiles, running_totals, union_all

TABLES_AT_ONCE = 4


def _cell(c: str):
    """A column by its exact name, dots included."""
    return F.col(f"`{c.replace('`', '``')}`")


def dedupe(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def medians(df: DataFrame, names) -> DataFrame:
    """One row, one median per column."""
    if fits(df.select(*names)):
        return df.agg(*[F.median(n).alias(n) for n in names])
    long = unpivot(df, names, lambda n: F.col(n).cast("double"))
    q = quantiles(long, ["column"], "value", {"median": 0.5})
    return q.agg(*[F.max(F.when(F.col("column") == n, F.col("median"))).alias(n) for n in names])


def modes(df: DataFrame, names) -> DataFrame:
    """One row, the most common value per column (the smallest on ties). Counted per value first,
    so no task holds the values of a whole column."""
    top = value_counts(df, names).filter(F.col("value").isNotNull()).groupBy("column").agg(
        F.min(F.struct((-F.col("n")).alias("neg"), "value")).alias("t"))
    return top.agg(*[F.max(F.when(F.col("column") == n, F.col("t.value"))).alias(n) for n in names])


def impute_median(df: DataFrame, keys=()) -> DataFrame:
    """Numeric gaps become the column median; filled columns are doubles. ``keys`` are left alone."""
    names = [c for c in numeric_columns(df) if c not in keys]
    if not names:
        return df
    m = medians(df, names).select(F.struct(*names)).scalar()
    filled = df.select("*", m.alias("_m"))
    return filled.select(*[F.coalesce(F.col(c).cast("double"), F.col("_m")[c]).alias(c) if c in names else F.col(c)
                           for c in df.columns])


def impute_mode(df: DataFrame) -> DataFrame:
    names = string_columns(df)
    if not names:
        return df
    m = modes(df, names).select(F.struct(*names)).scalar()
    filled = df.select("*", m.alias("_m"))
    return filled.select(*[F.coalesce(F.col(c), F.col("_m")[c], F.lit("unknown")).alias(c) if c in names else F.col(c)
                           for c in df.columns])


def date_columns(df: DataFrame) -> list:
    return [c for c in df.columns if "date" in c.lower() or "timestamp" in c.lower()]


def parse_dates(df: DataFrame) -> DataFrame:
    """Text columns named like dates become timestamps; what does not parse becomes null."""
    def parsed(c):
        if isinstance(df.schema[c].dataType, T.StringType):
            return F.try_to_timestamp(_cell(c)).cast("timestamp_ntz").alias(c)
        return _cell(c)
    return df.select(*[parsed(c) if c in date_columns(df) else _cell(c) for c in df.columns])


def standardise_text(df: DataFrame) -> DataFrame:
    skip = date_columns(df)
    return df.select(*[F.lower(F.trim(_cell(c))).alias(c) if c in string_columns(df) and c not in skip else _cell(c)
                       for c in df.columns])


def _staged(df: DataFrame) -> DataFrame:
    """Cut the plan in the cluster's checkpoint folder when the rows are too many to compute three
    times; without such a folder the plan is recomputed."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if fits(df) or not folder:
        return df
    spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def clean(df: DataFrame, keys=(), dates_first: bool = False) -> DataFrame:
    """All steps in the reference order: gaps are filled before dates are parsed, so a missing date
    becomes the most common one. ``dates_first`` parses first and leaves missing dates null."""
    df = _staged(dedupe(df))
    if dates_first:
        return standardise_text(impute_mode(impute_median(parse_dates(df), keys)))
    return standardise_text(parse_dates(impute_mode(impute_median(df, keys))))


def _null_count(df: DataFrame):
    return F.sum(sum((_cell(c).isNull().cast("long") for c in df.columns), F.lit(0).cast("long")))


def clean_stats(before: DataFrame, after: DataFrame, name: str) -> DataFrame:
    """Rows, removed copies and nulls on both sides; one row."""
    b = before.agg(F.count(F.lit(1)).alias("original_rows"), _null_count(before).alias("original_nulls"))
    a = after.agg(F.struct(F.count(F.lit(1)).alias("rows"), _null_count(after).alias("nulls")).alias("s")).scalar()
    return b.withColumn("_a", a).select(
        F.lit(name).alias("table_name"), "original_rows", F.col("_a.rows").alias("final_rows"),
        (F.col("original_rows") - F.col("_a.rows")).alias("duplicates_removed"), "original_nulls",
        F.col("_a.nulls").alias("final_nulls"), F.lit(len(before.columns)).cast("long").alias("columns"))


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def fill_values(df: DataFrame, numbers, texts, distributed: bool | None = None, folder: str | None = None) -> dict:
    """What fills the gaps: the median of each column in ``numbers``, the mode of each in ``texts`` (the smallest on ties).
    A column without any value has no entry. One value per column reaches the driver.

    The columns are laid out in long form and counted per value by one shuffle. A mode is the least (-count, value); a median
    is read off running totals of the counts, kept per range of values, so no task holds a column. Beyond one task's size the
    counts are written to ``folder`` and read by both."""
    if not numbers and not texts:
        return {}
    if distributed is None:
        distributed = not fits(df.select(*[_cell(c) for c in [*numbers, *texts]]))
    none = F.lit(None)
    cells = [F.struct(F.lit(c).alias("column"), _cell(c).cast("double").alias("number"), none.cast("string").alias("text"))
             for c in numbers]
    cells += [F.struct(F.lit(c).alias("column"), none.cast("double").alias("number"), _cell(c).alias("text")) for c in texts]
    long = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*").filter("number IS NOT NULL OR text IS NOT NULL")
    counts = long.groupBy("column", "number", "text").agg(F.count(F.lit(1)).alias("n"))
    if distributed and folder:
        counts = _kept(counts, folder)
    found = {}
    if texts:
        top = counts.filter(F.col("text").isNotNull()).groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("neg"), "text")).alias("t"))
        found.update({r.column: r.text for r in top.select("column", "t.text").collect()})
    if numbers:
        values = counts.filter(F.col("number").isNotNull()).drop("text")
        middle = values.groupBy("column").agg(((F.sum("n") - 1) / 2.0).alias("at"))
        ranked = running_totals(values, ["column"], "number", distributed).join(F.broadcast(middle), "column")

        def at(place):
            return F.max(F.when((F.col("before") <= place) & (place < F.col("before") + F.col("n")), F.col("number")))

        ends = ranked.groupBy("column").agg(at(F.floor("at")).alias("a"), at(F.ceil("at")).alias("b"))
        found.update({r.column: r.a if r.a == r.b else r.a + (r.b - r.a) * 0.5 for r in ends.collect()})
    return found


def clean_table(df: DataFrame, name: str, folder: str, keys=(), format: str = "parquet", dates_first: bool = False) -> DataFrame:
    """Clean one table into ``folder/tables/name``; returns its row of statistics, counted from what was written.

    The source is read once: its distinct rows and their numbers of copies are written to ``folder/distinct/name``. Only
    columns with gaps are searched for a median or mode, and only they become doubles; ``keys`` are left alone. Gaps are
    filled before dates are parsed unless ``dates_first``. csv has a header and holds nested values as JSON."""
    spark, columns = df.sparkSession, df.columns
    copies = "_copies"
    while copies in columns:
        copies += "_"
    rows = _kept(df.groupBy(*[_cell(c) for c in columns]).agg(F.count(F.lit(1)).alias(copies)), f"{folder}/distinct/{name}")
    nulls = [_cell(c).isNull().cast("long") for c in columns]
    before = rows.agg(F.coalesce(F.sum(copies), F.lit(0)), F.coalesce(F.sum(F.col(copies) * sum(nulls)), F.lit(0)),
                      *[F.sum(n) for n in nulls]).first()
    gaps = {c for c, n in zip(columns, before[2:]) if n}
    out = parse_dates(rows.drop(copies)) if dates_first else rows.drop(copies)
    numbers = [c for c in numeric_columns(out) if c in gaps and c not in keys]
    texts = [c for c in string_columns(out) if c in gaps]
    fills = fill_values(out, numbers, texts, folder=f"{folder}/counts/{name}")
    fills = {c: fills.get(c, "unknown" if c in texts else None) for c in [*numbers, *texts]}
    out = out.select(*[F.coalesce(_cell(c).cast("double") if c in numbers else _cell(c), F.lit(fills[c])).alias(c)
                       if c in fills and fills[c] is not None else _cell(c) for c in columns])
    out = standardise_text(out if dates_first else parse_dates(out))
    path = f"{folder}/tables/{name}"
    if format == "csv":
        nested = (T.ArrayType, T.MapType, T.StructType)
        flat = out.select(*[F.to_json(_cell(c)).alias(c) if isinstance(out.schema[c].dataType, nested) else _cell(c) for c in columns])
        flat.write.mode("overwrite").csv(path, header=True, escape='"')
    else:
        out.write.mode("overwrite").format(format).save(path)
    after = read_clean(spark, folder, name, out.schema, format).agg(
        F.count(F.lit(1)).alias("final_rows"), F.coalesce(_null_count(out), F.lit(0)).alias("final_nulls"))
    total = F.lit(before[0])
    return after.select(F.lit(name).alias("table_name"), total.alias("original_rows"), "final_rows",
                        (total - F.col("final_rows")).alias("duplicates_removed"), F.lit(before[1]).cast("long").alias("original_nulls"),
                        "final_nulls", F.lit(len(columns)).cast("long").alias("columns"))


def read_clean(spark, folder: str, name: str, schema: T.StructType | None = None, format: str = "parquet") -> DataFrame:
    """A cleaned table as written. csv has no types: give the schema; nested columns are JSON texts."""
    reader = spark.read
    if format == "csv":
        nested = (T.ArrayType, T.MapType, T.StructType)
        flat = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, nested) else f.dataType) for f in schema])
        return reader.schema(flat).csv(f"{folder}/tables/{name}", header=True, escape='"', multiLine=True)
    return reader.format(format).load(f"{folder}/tables/{name}")


def clean_catalog(tables: dict, folder: str, keys: dict | None = None, format: str = "parquet", dates_first: bool = False) -> DataFrame:
    """Clean every table into ``folder``; statistics per table and a row of totals. ``keys`` names the key columns per table.
    A few tables are cleaned at a time, so that small ones do not leave the cluster idle."""
    def one(item):
        name, df = item
        return clean_table(df, name, folder, (keys or {}).get(name, ()), format, dates_first)

    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        stats = union_all(list(pool.map(one, tables.items())))
    sums = [F.sum(c).cast("long").alias(c) for c in stats.columns[1:]]
    return stats.unionByName(stats.agg(*sums).withColumn("table_name", F.lit("TOTAL")))
