"""Result equivalence over a table of statements, by statement shapes.

Statements that differ in compared literals only are one shape: the literals become columns of a parameter table, and the shape is
planned once as ``params, LATERAL (shape)``. The number of plans follows from the distinct shapes, not from the statements,
and all results stay on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from querywright.functions.sqltext import strip
from querywright.operators.guard import check_statement
from querywright.scale import union_all
from querywright.streaming.history import stored

# A compared integer or a plain quoted text; what follows must not go on with a number or name
LITERAL = r"(=|<>|!=|<=|>=|<|>)(\s*)('[^'\\]*'|-?[0-9]{1,18})(?![\w.(])"
TEXT_SLOT, NUMBER_SLOT = ":?text", ":?number"
MAX_SHAPES = 10_000       # distinct shapes that are planned on the driver
BATCH_SHAPES = 40         # shapes in one plan; each batch is written before the next


def with_shape(df: DataFrame, sql: str) -> DataFrame:
    """Add ``shape`` (the statement with slots for its compared literals) and ``args``. A statement whose quotes or comments
    leave doubt about what is a literal keeps its own text as shape."""
    # a column per step: each is computed once, however often the next ones read it
    rows = df.withColumn("_body", F.regexp_replace(strip(F.col(sql)), r"[;\s]+$", ""))
    rows = rows.withColumn("_marked", F.regexp_replace(
        F.regexp_replace("_body", LITERAL.replace("|-?[0-9]{1,18}", ""), f"$1$2{TEXT_SLOT}"),
        LITERAL.replace(r"'[^'\\]*'|", ""), f"$1$2{NUMBER_SLOT}"))
    rows = rows.withColumn("_doubt", F.regexp_like("_marked", F.lit(r"""['"`\\]|--|/\*""")) | F.col("_body").contains(":?"))
    args = F.when(F.col("_doubt"), F.array().cast("array<string>")).otherwise(F.regexp_extract_all("_body", F.lit(LITERAL), F.lit(3)))
    return rows.select(
        *df.columns, F.when(F.col("_doubt"), F.col("_body")).otherwise(F.regexp_replace("_marked", r"\s+", " ")).alias("shape"),
        F.transform(args, lambda a: F.regexp_replace(a, "^'|'$", "")).alias("args"))


def _bound(shape: str, params: str) -> str:
    """The shape with its slots read from the row of parameters."""
    out, place = "", 0
    while True:
        at = [(k, s) for s in (TEXT_SLOT, NUMBER_SLOT) if (k := shape.find(s)) >= 0]
        if not at:
            return out + shape
        k, slot = min(at)
        value = f"{params}._args[{place}]"
        out += shape[:k] + (value if slot == TEXT_SLOT else f"CAST({value} AS BIGINT)")
        shape, place = shape[k + len(slot):], place + 1


def _cell(c: Column, kind: T.DataType) -> Column:
    """A value as text that is equal for equal values of any numeric type."""
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        d = c.cast("double")
        return F.when((d == F.floor(d)) & (F.abs(d) < 2.0 ** 53), d.cast("bigint").cast("string")).otherwise(d.cast("string"))
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(F.struct(c.alias("v")))
    return c.cast("string")


def shape_rows(spark: SparkSession, shape: str, params: DataFrame) -> tuple[str, DataFrame] | None:
    """(column names, rows (_sid, row, n)) of one shape over its parameters (_sid, _args); None if it cannot be planned."""
    try:
        made = spark.sql(f"SELECT _p_._sid, _r_.* FROM {{params}} AS _p_, LATERAL ({_bound(shape, '_p_')}) AS _r_", params=params)
        names = made.columns[1:]
        made = made.toDF("_sid", *[f"c{i}" for i in range(len(names))])
        cells = [_cell(F.col(f"c{i}"), made.schema[f"c{i}"].dataType) for i in sorted(range(len(names)), key=lambda i: (names[i], i))]
        rows = made.select("_sid", F.to_json(F.array(*cells)).alias("row")).groupBy("_sid", "row").agg(F.count(F.lit(1)).alias("n"))
        rows.schema
    except Exception:  # a statement that cannot be analysed matches nothing
        return None
    return ",".join(sorted(names)), rows


def _written(df: DataFrame) -> DataFrame:
    """Cut the plan where a checkpoint folder is named; else the plan goes on."""
    sc = df.sparkSession.sparkContext
    return df.checkpoint() if sc.getCheckpointDir() or df.sparkSession.conf.get("spark.checkpoint.dir", None) else df


def execution_match(spark: SparkSession, pairs: DataFrame, pred: str = "pred_sql", truth: str = "truth_sql", mode: str = "set",
                    max_shapes: int = MAX_SHAPES) -> DataFrame:
    """Add ``execution_correct``: both statements run and give equal numbers of rows and equal sets (or bags) of rows, columns
    matched by name. Unsafe, failing and missing statements do not match."""
    sid = lambda c: F.sha2(F.coalesce(F.col(c), F.lit("")), 256)
    texts = pairs.select(F.col(pred).alias("sql")).unionByName(pairs.select(F.col(truth).alias("sql"))).filter("sql IS NOT NULL").distinct()
    # read once per shape: written sorted by shape, so that each reads its own rows
    known = stored(with_shape(texts.withColumn("_sid", sid("sql")), "sql").sortWithinPartitions("shape"), "statements")
    samples = known.groupBy("shape").agg(F.min("sql").alias("sample")).orderBy("shape").limit(max_shapes + 1).collect()
    if len(samples) > max_shapes:
        raise ValueError(f"more than {max_shapes} distinct statement shapes; raise max_shapes or split the input")
    columns, rows = [], []
    for row in samples:
        if check_statement(spark, row["sample"]) is None:
            params = known.filter(F.col("shape") == row["shape"]).select("_sid", F.col("args").alias("_args"))
            made = shape_rows(spark, row["shape"], params)
            if made:
                columns.append((row["shape"], made[0]))
                rows.append(made[1])
    if not rows:
        return pairs.withColumn("execution_correct", F.lit(False))
    found = [union_all(rows[k:k + BATCH_SHAPES]) for k in range(0, len(rows), BATCH_SHAPES)]
    found = union_all([_written(f) for f in found]) if len(found) > 1 else found[0]
    # the columns of a shape: at most max_shapes rows
    names = spark.createDataFrame(columns, "shape string, names string")
    runs = known.join(F.broadcast(names), "shape").select("_sid", "names")
    end = lambda s: runs.select(F.col("_sid").alias(f"_{s}"), F.col("names").alias(f"_n{s}"))
    asked = pairs.select(sid(pred).alias("_p"), sid(truth).alias("_t")).distinct()
    able = asked.join(end("p"), "_p").join(end("t"), "_t").filter("_np = _nt").select("_p", "_t")
    zero, n = F.lit(0).cast("long"), F.col("n")
    sides = able.filter("_p <> _t").select("_p", "_t", F.inline(F.array(
        F.struct(F.col("_p").alias("_sid"), F.lit(True).alias("first")), F.struct(F.col("_t").alias("_sid"), F.lit(False).alias("first")))))
    each = sides.join(found, "_sid").groupBy("_p", "_t", "row").agg(
        F.sum(F.when(F.col("first"), n).otherwise(zero)).alias("a"), F.sum(F.when(F.col("first"), zero).otherwise(n)).alias("b"))
    agree = (F.col("a") == F.col("b")) if mode == "bag" else ((F.col("a") > 0) & (F.col("b") > 0))
    verdict = each.groupBy("_p", "_t").agg((F.bool_and(agree) & (F.sum("a") == F.sum("b"))).alias("same"))
    # a pair that runs and has no row on either side is equal
    verdict = able.join(verdict, ["_p", "_t"], "left").select("_p", "_t", F.coalesce("same", F.lit(True)).alias("same"))
    return (pairs.withColumn("_p", sid(pred)).withColumn("_t", sid(truth)).join(verdict, ["_p", "_t"], "left")
            .select(*pairs.columns, (F.coalesce("same", F.lit(False)) & F.col(pred).isNotNull() & F.col(truth).isNotNull())
                    .alias("execution_correct")))
