"""Parsing of model answers: JSON inside prose, per-strategy defaults, fallbacks."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from querywright.functions.sqltext import col, strip

# Field names, confidences and the SQL-keyword lines of each strategy.
#   strategy: (sql field, confidence field, confidence when missing, confidence when nothing parses)
DEFAULTS = {
    "zero_shot": ("sql", "confidence", 0.5, 0.5),
    "chain_of_thought": ("sql", "confidence", 0.5, 0.3),
    "few_shot": ("sql", "confidence", 0.8, 0.7),
    "self_consistency": ("final_sql", "final_confidence", 0.9, 0.85),
    "least_to_most": ("final_sql", "confidence", 0.85, 0.75),
}
LINE_KEYWORDS = ("SELECT", "FROM", "WHERE", "JOIN", "GROUP BY", "ORDER BY")
REQUIRED_FIELDS = ("sql", "used_tables", "used_columns", "reason_short", "confidence")
NO_SQL = "SELECT 1"


def json_text(response, mode: str = "last") -> Column:
    """The JSON part: from the last (``outer``: first) opening to the last closing brace; '' if none."""
    if mode == "last":
        return F.regexp_extract(col(response), r"(\{[^{]*\})[^{}]*$", 1)
    return F.regexp_extract(col(response), r"(?s)(\{.*\})", 1)


def json_value(body: Column) -> Column:
    """The object as a variant, null unless the whole text is exactly one JSON value."""
    wrapped = F.try_parse_json(F.concat(F.lit("["), body, F.lit("]")))
    alone = F.try_variant_get(wrapped, "$[1]", "string").isNull()
    return F.when((body != "") & alone, F.try_variant_get(wrapped, "$[0]", "variant"))


def field(value: Column, name: str, kind: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", kind)


def _select_text(response, stops: str) -> Column:
    found = F.regexp_extract(col(response), rf"(?is)(SELECT\s+.*?(?:{stops}|$))", 1)
    return F.when(found == "", NO_SQL).otherwise(F.rtrim(strip(found), F.lit(";")))


def fallback_sql(response, strategy) -> Column:
    """SQL from plain text: up to a semicolon for zero-/few-shot, up to a line end for the sampled
    strategies, the first line with a SQL keyword for chain of thought."""
    lines = F.transform(F.split(col(response), "\n"), strip)
    line = F.coalesce(F.get(F.filter(lines, lambda x: F.upper(x).rlike("|".join(LINE_KEYWORDS))), 0), F.lit(""))
    s = col(strategy)
    return (F.when(s == "chain_of_thought", line)
            .when(s.isin("self_consistency", "least_to_most"), _select_text(response, ";|\n"))
            .otherwise(_select_text(response, ";")))


def parse_responses(df, response="response", strategy="strategy", mode="last"):
    """Add ``sql``, ``confidence`` and ``parsed``."""
    def by_strategy(pick):
        out = F
        for name, spec in DEFAULTS.items():
            out = out.when(F.col(strategy) == name, pick(spec))
        return out

    staged = df.withColumn("_body", json_text(response, mode)).withColumn("_json", json_value(F.col("_body")))
    staged = (staged
              .withColumn("_sql", by_strategy(lambda s: field(F.col("_json"), s[0], "string")))
              .withColumn("_conf", by_strategy(lambda s: field(F.col("_json"), s[1], "double"))))
    needs_sql = F.col(strategy).isin("self_consistency", "least_to_most")
    parsed = F.col("_json").isNotNull() & (~needs_sql | F.col("_sql").isNotNull())
    missing_sql = F.when(F.col(strategy) == "chain_of_thought", "").otherwise(fallback_sql(response, strategy))
    staged = staged.withColumn("parsed", parsed)
    sql = F.when(F.col("parsed"), F.coalesce("_sql", missing_sql)).otherwise(fallback_sql(response, strategy))
    conf = (F.when(F.col("parsed"), F.coalesce("_conf", by_strategy(lambda s: F.lit(s[2]))))
            .otherwise(by_strategy(lambda s: F.lit(s[3]))))
    return staged.select(*df.columns, sql.alias("sql"), conf.alias("confidence"), "parsed")


def check_fields(df, response="response"):
    """Parse with the outermost braces and list the required fields that are absent."""
    staged = df.withColumn("_body", json_text(response, "outer")).withColumn("_json", json_value(F.col("_body")))
    keys = F.coalesce(F.when(F.col("_json").isNotNull(), F.json_object_keys("_body")), F.array().cast("array<string>"))
    absent = F.array_join(F.array_except(F.array(*[F.lit(f) for f in REQUIRED_FIELDS]), keys), ",")
    status = (F.when(F.col("_body") == "", "no_json").when(F.col("_json").isNull(), "bad_json")
              .when(absent != "", "missing_field").otherwise("ok"))
    return staged.select(*df.columns, status.alias("status"), F.when(F.col("_json").isNotNull(), absent).alias("missing_fields"),
                         field(F.col("_json"), "sql", "string").alias("sql"))
