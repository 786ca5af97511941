"""Read-only execution of user SQL and labels for tables of statements."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from querywright.functions.sqltext import is_safe

# Parsed plan nodes a read-only statement may contain. Everything else is refused.
READ_NODES = {
    "Project", "Filter", "Aggregate", "Join", "AsOfJoin", "LateralJoin", "Sort", "Distinct", "GlobalLimit", "LocalLimit",
    "Offset", "Tail", "Union", "Intersect", "Except", "Window", "WithWindowDefinition", "Generate", "Expand", "Pivot",
    "Unpivot", "Sample", "SubqueryAlias", "UnresolvedSubqueryColumnAliases", "UnresolvedRelation", "UnresolvedHaving",
    "UnresolvedWith", "UnresolvedInlineTable", "UnresolvedTableValuedFunction", "UnresolvedTVFAliases", "OneRowRelation",
    "LocalRelation", "Range", "ResolvedInlineTable", "UnresolvedHint", "CTERelationDef", "CTERelationRef", "WithCTE",
    "RelationTimeTravel", "UnresolvedOrderBy", "LimitAll", "ResolvedHint", "Deduplicate",
}


def label_safe(df: DataFrame, sql_col: str, mode: str = "keyword") -> DataFrame:
    return df.withColumn("is_safe", is_safe(sql_col, mode))


def _nodes(plan):
    """Names of all nodes of a parsed plan, through children, CTE bodies and subqueries."""
    yield plan.getClass().getSimpleName().rstrip("$")
    for seq in (plan.children(), plan.innerChildren()):
        for i in range(seq.size()):
            yield from _nodes(seq.apply(i))


def check_statement(spark: SparkSession, sql: str | None) -> str | None:
    """Reason for refusing the statement, or None."""
    if not sql or not sql.strip():
        return "empty query"
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except Exception as err:
        return f"parse error: {str(err).splitlines()[0]}"
    refused = sorted({n for n in _nodes(plan)} - READ_NODES)
    return f"not read-only: {', '.join(refused)}" if refused else None


def run_readonly(spark: SparkSession, sql: str | None, count: bool = True) -> tuple:
    """(status row, result or None). Nothing is raised: empty, unsafe and failing statements come
    back as a status row. The result stays a lazy DataFrame."""
    error, result, rows = check_statement(spark, sql), None, None
    if error is None:
        try:
            result = spark.sql(sql)
            rows = result.count() if count else None
        except Exception as err:
            error, result = str(err).splitlines()[0], None
    status = spark.range(0, 1, 1, 1).select(
        F.lit(sql).cast("string").alias("sql"), F.lit(error is None).alias("success"),
        F.lit(rows).cast("long").alias("row_count"), F.lit(error).cast("string").alias("error"))
    return status, result


def preview(df: DataFrame, n: int = 100) -> DataFrame:
    """The first ``n`` rows for display, each with the full row count."""
    return df.limit(n).withColumn("total_rows", df.agg(F.count(F.lit(1))).scalar())
