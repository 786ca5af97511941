"""Curation of question/SQL pairs: checks, reports, variants, splits and model input text.

Records are (pair_id, question, sql, schema_context, ...). The context is text: a JSON object, a
schema string ``t(c1, c2)`` or nothing."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from querywright.functions.sqltext import col, plausible_sql, strip, text, tidy_sql
from querywright.operators.catalog import parse_tables
from querywright.scale import union_all

MIN_QUESTION, MAX_QUESTION = 5, 500

# Paraphrase rules (the first that applies) and aggregate names in priority order.
PARAPHRASES = (("show me", "display"), ("find", "get"), ("what is", "what are"), ("how many", "count"), ("list all", "show all"))
AGGREGATES = ("COUNT", "SUM", "AVG", "MAX", "MIN")
VARIANTS = ("upper", "lower", "collapse", "commas")
RANK_BUCKET_DIGITS, RANK_BUCKET_ROWS = 3, 1 << 20


def _issue(test: Column, *message) -> Column:
    parts = [F.lit(m) if isinstance(m, str) else m for m in message]
    return F.when(test, F.concat(F.lit("Item "), F.col("pair_id").cast("string"), F.lit(": "), *parts))


def _context_json() -> Column:
    return F.try_parse_json("schema_context")


def context_fields(df: DataFrame) -> DataFrame:
    """Add ``_tables``, ``_columns`` and ``_context_issues`` read from the schema context."""
    staged = df.withColumn("_v", _context_json())
    kind = F.substring(F.trim("schema_context"), 1, 1)
    is_object = F.col("_v").isNotNull() & (kind == "{")
    is_other = F.col("_v").isNotNull() & (kind != "{") & (kind != '"')
    staged = staged.withColumn("_keys", F.when(is_object, F.json_object_keys("schema_context")))
    staged = staged.withColumn("_t", F.try_variant_get("_v", "$.relevant_tables", "array<string>"))
    staged = staged.withColumn("_c", F.try_variant_get("_v", "$.relevant_columns", "array<string>"))
    bad_tables = F.coalesce(F.array_contains("_keys", "relevant_tables") & F.col("_t").isNull(), F.lit(False))
    bad_columns = F.coalesce(F.array_contains("_keys", "relevant_columns") & F.col("_c").isNull(), F.lit(False))
    invalid = is_other | bad_tables | bad_columns
    issues = F.filter(F.array(
        _issue(bad_tables, "relevant_tables should be a list"),
        _issue(F.size("_t") == 0, "relevant_tables is empty"),
        _issue(bad_columns, "relevant_columns should be a list"),
        _issue(is_other, "Invalid schema_context type")), lambda x: x.isNotNull())
    none = F.array().cast("array<string>")
    found = parse_tables("schema_context")
    from_text = F.col("schema_context").isNotNull() & ~is_object & ~is_other
    text_columns = F.flatten(F.transform(found, lambda x: F.transform(
        F.split(x["columns"], ","), lambda c: F.concat(x["table"], F.lit("."), F.trim(c)))))
    return staged.select(
        *df.columns,
        F.when(from_text, F.transform(found, lambda x: x["table"])).otherwise(F.col("_t")).alias("_tables"),
        F.when(from_text, text_columns).otherwise(F.col("_c")).alias("_columns"),
        F.when(invalid, issues).otherwise(none).alias("_context_issues"))


def checked_pairs(df: DataFrame) -> DataFrame:
    """Every record with ``is_valid``, its ``issues`` and the cleaned fields. A record without a
    required field gets no further checks."""
    staged = context_fields(df).withColumn("_q", strip("question"))
    staged = staged.withColumns({"_len": F.length("_q"), "_sane": plausible_sql("sql")})
    required = F.filter(F.array(*[
        _issue(text(f) == "", f"Missing or empty '{f}' field") for f in ("question", "sql")]), lambda x: x.isNotNull())
    complete = (text("question") != "") & (text("sql") != "")
    q, n = F.col("_q"), F.col("_len")
    short, long = n < MIN_QUESTION, n > MAX_QUESTION
    sane = F.col("_sane")
    later = F.filter(F.array(
        _issue(short, "Question too short (", n.cast("string"), " chars)"),
        _issue(long, "Question too long (", n.cast("string"), " chars)"),
        _issue(~sane, "Invalid SQL syntax")), lambda x: x.isNotNull())
    valid = F.coalesce(complete & ~short & sane, F.lit(False))
    return staged.select(
        *[c for c in df.columns if c not in ("question", "sql")],
        F.when(complete, F.substring(q, 1, MAX_QUESTION)).otherwise(F.col("question")).alias("question"),
        F.when(complete, tidy_sql("sql")).otherwise(F.col("sql")).alias("sql"),
        valid.alias("is_valid"),
        F.when(complete, F.concat(later, F.col("_context_issues"))).otherwise(required).alias("issues"),
        F.col("_tables").alias("relevant_tables"), F.col("_columns").alias("relevant_columns"))


def validate_pairs(df: DataFrame, keep_warnings: bool = False) -> tuple:
    """(valid pairs, issue log). Remarks on valid pairs are dropped unless ``keep_warnings``."""
    checked = checked_pairs(df)
    valid = checked.filter("is_valid").drop("is_valid", "issues")
    rejected = checked if keep_warnings else checked.filter(~F.col("is_valid"))
    issues = (rejected.select("pair_id", F.posexplode_outer("issues").alias("pos", "issue")).filter(F.col("issue").isNotNull())
              .select("pair_id", (F.col("pos") + 1).cast("long").alias("ordinal"), "issue"))
    return valid, issues


def quality_report(df: DataFrame) -> DataFrame:
    """Totals, average lengths, unique and repeated questions (ignoring case)."""
    checked = checked_pairs(df)
    ok = F.col("is_valid")
    one = checked.agg(
        F.count(F.lit(1)).alias("total_samples"), F.sum(ok.cast("long")).alias("valid_samples"),
        F.coalesce(F.avg(F.when(ok, F.length("question"))), F.lit(0.0)).alias("avg_question_length"),
        F.coalesce(F.avg(F.when(ok, F.length("sql"))), F.lit(0.0)).alias("avg_sql_length"),
        F.countDistinct(F.when(ok, F.lower("question"))).alias("unique_questions"),
        F.sum(F.when(ok, 0).otherwise(F.size("issues"))).cast("long").alias("quality_issues"))
    return one.select("total_samples", "valid_samples", (F.col("total_samples") - F.col("valid_samples")).alias("invalid_samples"),
                      "avg_question_length", "avg_sql_length", "unique_questions",
                      (F.col("valid_samples") - F.col("unique_questions")).alias("duplicate_questions"), "quality_issues")


def schema_coverage(df: DataFrame) -> DataFrame:
    """Valid pairs per referenced table."""
    valid, _ = validate_pairs(df)
    return valid.select(F.explode_outer("relevant_tables").alias("table_name")).filter(
        F.col("table_name").isNotNull()).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n"))


def distribution(df: DataFrame, *columns) -> DataFrame:
    """Pairs per value of each column, in one pass."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    return df.select(F.explode(cells).alias("c")).select("c.*").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def paraphrase(question) -> Column:
    """Lower case with the first matching rule applied, first letter capital; empty stays as it is."""
    low = F.lower(col(question))
    out = F
    for old, new in PARAPHRASES:
        out = out.when(low.contains(old), F.replace(low, F.lit(old), F.lit(new)))
    out = out.otherwise(low)
    return F.when(out == "", col(question)).otherwise(F.concat(F.upper(F.substring(out, 1, 1)), F.substr(out, F.lit(2))))


def sql_variant(sql, name) -> Column:
    s, name = col(sql), col(name)
    return (F.when(name == "upper", F.upper(s)).when(name == "lower", F.lower(s))
            .when(name == "collapse", F.regexp_replace(s, r"\s+", " ")).when(name == "commas", F.replace(s, F.lit(","), F.lit(", "))))


def sql_variants(df: DataFrame, sql: str = "sql") -> DataFrame:
    """One row per formatting variant."""
    return df.select("*", F.explode(F.array(*[F.lit(v) for v in VARIANTS])).alias("variant")).withColumn(
        sql, sql_variant(sql, "variant"))


def alias_aggregate(sql) -> Column:
    """Name the first aggregate call of a SELECT without any ``AS``."""
    s = col(sql)
    eligible = F.upper(s).startswith("SELECT") & ~F.upper(s).contains("AS ")
    out = F
    for f in AGGREGATES:
        call = F.regexp_extract(s, rf"(?i){f}\([^)]+\)", 0)
        out = out.when(eligible & (call != ""), F.replace(s, call, F.concat(call, F.lit(f" AS {f.lower()}_result"))))
    return out.otherwise(s)


def hash_rank(df: DataFrame, key: str, n: int, seed: int = 0, name: str = "shuffle_rank") -> DataFrame:
    """Position (from 0) of each of ``n`` rows in a repeatable shuffle: the order of md5(key, seed).

    Hashes are uniform, so their first digits are balanced buckets: rows are numbered per bucket and shifted by the sizes
    of the buckets before. More rows take more digits, so that a bucket stays near a million rows at most."""
    digits = RANK_BUCKET_DIGITS
    while n > RANK_BUCKET_ROWS << (4 * digits):
        digits += 1
    h = df.withColumn("_h", F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))))
    h = h.withColumn("_b", F.substring("_h", 1, digits))
    sizes = h.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy("_h", key)) - 1
    return (h.withColumn("_i", inside).join(F.broadcast(shifts), "_b")
            .withColumn(name, (F.col("_i") + F.col("_shift")).cast("long")).drop("_h", "_b", "_i", "_shift"))


def split(df: DataFrame, key: str, ratios=(0.8, 0.1, 0.1), seed: int = 0) -> DataFrame:
    """Add ``split``: exact floor sizes for train and validation, the rest is test."""
    if abs(sum(ratios) - 1.0) > 1e-6:
        raise ValueError("ratios must sum to 1.0")
    n = df.count()
    ranked = hash_rank(df, key, n, seed)
    train, val = F.floor(F.lit(n) * ratios[0]), F.floor(F.lit(n) * ratios[1])
    label = (F.when(F.col("shuffle_rank") < train, "train").when(F.col("shuffle_rank") < train + val, "validation")
             .otherwise("test"))
    return ranked.withColumn("split", label).drop("shuffle_rank")


def split_by_group(df: DataFrame, group: Column, ratios=(0.8, 0.1, 0.1), seed: int = 0) -> DataFrame:
    """Add ``group_key`` and ``split``: rows of equal ``group`` fall in one split. Groups lie one after the other in the order of their
    digest, and a group goes where its first row would go, so every border is missed by less than one group. Only one row per
    group is ordered, in ranges of the digest; a group of a third of all rows is one row there."""
    if abs(sum(ratios) - 1.0) > 1e-6:
        raise ValueError("ratios must sum to 1.0")
    keyed = df.withColumn("group_key", F.md5(F.concat_ws(":", group, F.lit(str(seed)))))
    sizes = keyed.groupBy("group_key").agg(F.count(F.lit(1)).alias("n"))
    bucket = F.substring("group_key", 1, RANK_BUCKET_DIGITS)
    totals = sizes.groupBy(bucket.alias("_b")).agg(F.sum("n").alias("_n"))
    prior = (Window.unboundedPreceding, -1)
    shifts = totals.select("_b", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(*prior)), F.lit(0)).alias("_shift"),
                           F.sum("_n").over(Window.partitionBy()).alias("_all"))     # 16 ** RANK_BUCKET_DIGITS rows at most
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("_b").orderBy("group_key").rowsBetween(*prior)), F.lit(0))
    placed = sizes.withColumn("_b", bucket).withColumn("_at", inside).join(F.broadcast(shifts), "_b")
    at, n = F.col("_at") + F.col("_shift"), F.col("_all")
    train, val = F.floor(n * F.lit(ratios[0])), F.floor(n * F.lit(ratios[1]))
    label = F.when(at < train, "train").when(at < train + val, "validation").otherwise("test")
    return keyed.join(placed.select("group_key", label.alias("split")), "group_key")


def leaks(df: DataFrame, group: str = "group_key", label: str = "split") -> DataFrame:
    """(group, n_rows, splits): the groups that lie in more than one split, by one grouping without a self-join."""
    found = df.groupBy(group).agg(F.count(F.lit(1)).alias("n_rows"), F.sort_array(F.collect_set(label)).alias("splits"))
    return found.filter(F.size("splits") > 1)


def draw(i: Column, seed: int, n, salt: str) -> Column:
    """A repeatable draw from 0..n-1 for each row number."""
    h = F.md5(F.concat_ws(":", i.cast("string"), F.lit(str(seed)), F.lit(salt)))
    return F.pmod(F.conv(F.substring(h, 1, 12), 16, 10).cast("long"), n)


def augment(df: DataFrame, key: str = "pair_id", factor: float = 1.5, seed: int = 0, folder: str | None = None) -> DataFrame:
    """Grow to ``int(n * factor)`` rows: the originals plus variants of rows drawn with replacement,
    each by a drawn technique. ``origin`` tells them apart.

    The rows are needed four times (their number, bucket sizes, ranks, originals): with ``folder`` they are computed once,
    written there and read by each with the columns it needs."""
    if folder:
        df.write.mode("overwrite").parquet(folder)
        df = df.sparkSession.read.parquet(folder)
    n = df.count()
    extra = max(0, int(n * factor) - n)
    original = df.withColumn("origin", F.lit("original"))
    if not extra:
        return original
    i = F.col("id")
    technique = draw(i, seed, F.lit(3), "technique")
    variant = F.get(F.array(*[F.lit(v) for v in VARIANTS]), draw(i, seed, F.lit(len(VARIANTS)), "variant").cast("int"))
    draws = df.sparkSession.range(extra).select(
        draw(i, seed, F.lit(n), "row").alias("shuffle_rank"), technique.alias("_k"), variant.alias("_variant"))
    picked = hash_rank(df, key, n, seed).join(draws, "shuffle_rank")
    question = F.when(F.col("_k") == 0, paraphrase("question")).otherwise(F.col("question"))
    sql = F.when(F.col("_k") == 1, sql_variant("sql", "_variant")).when(F.col("_k") == 2, alias_aggregate("sql")).otherwise(F.col("sql"))
    origin = F.get(F.array(F.lit("paraphrase"), F.lit("format"), F.lit("alias")), F.col("_k").cast("int"))
    made = picked.select(*[question.alias(c) if c == "question" else sql.alias(c) if c == "sql" else F.col(c) for c in df.columns],
                         origin.alias("origin"))
    return union_all([original, made])


def tuning_input(question, tables, columns) -> Column:
    """``prefix | Question | Tables | Columns``; absent parts are skipped."""
    return F.concat_ws(" | ", F.lit("Generate SQL for the following question:"), F.concat(F.lit("Question: "), col(question)),
                       F.concat(F.lit("Tables: "), F.array_join(col(tables), ", ")),
                       F.concat(F.lit("Columns: "), F.array_join(col(columns), ", ")))


def model_input(question, schema) -> Column:
    """Inference text with the schema when there is one."""
    head = F.concat(F.lit("translate English to SQL: "), col(question))
    return F.when(text(schema) != "", F.concat(head, F.lit(" | schema: "), col(schema))).otherwise(head)
