"""Column functions over SQL statements and questions. All stay inside the JVM."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word lists of the rules below.
BLOCKED_KEYWORD = ("INSERT", "UPDATE", "DELETE", "DROP", "CREATE", "ALTER", "TRUNCATE", "REPLACE", "MERGE", "EXEC", "EXECUTE")
BLOCKED_LOOSE = ("INSERT", "UPDATE", "DELETE", "DROP", "CREATE", "ALTER", "TRUNCATE", "REPLACE", "MERGE", "CALL", "EXEC")
AGGREGATE_WORDS = ("SUM", "COUNT", "AVG", "MAX", "MIN", "GROUP BY")
AGGREGATE_NAMES = ("SUM", "COUNT", "AVG", "MAX", "MIN")
WINDOW_WORDS = ("OVER", "PARTITION BY", "ROW_NUMBER", "RANK")
VALID_STARTS = ("SELECT", "INSERT", "UPDATE", "DELETE", "WITH")
QUESTION_TYPES = (
    ("complex_aggregation", ("average", "more than", "less than", "compare", "ratio")),
    ("multi_table_analysis", ("join", "across", "between", "relationship", "combined")),
    ("temporal_comparison", ("monthly", "yearly", "trend", "over time", "period", "growth")),
    ("conditional_logic", ("if", "when", "where", "classify", "categorize", "based on")),
)
DEFAULT_TYPE = "multi_table_analysis"
QUESTION_CATEGORIES = (
    (("customer_analysis", "delivery_analysis"), ("customer", "city", "state", "user")),
    (("product_analysis", "payment_analysis"), ("product", "category", "item", "revenue", "sales")),
    (("delivery_analysis", "temporal_analysis"), ("delivery", "shipping", "time", "days")),
    (("payment_analysis", "product_analysis"), ("payment", "pay", "method", "value")),
)
DEFAULT_CATEGORIES = ("customer_analysis", "product_analysis")
# Words in any script; a single other character is a token of its own.
WHITESPACE = " \t\n\x0b\f\r"
TOKEN_PATTERN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c) -> Column:
    return F.coalesce(col(c), F.lit(""))


def strip(c) -> Column:
    """Both ends without any kind of whitespace."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def contains_any(c, words, word: bool = False) -> Column:
    """Substring test against a list; with ``word`` only whole words count."""
    if word:
        return col(c).rlike(r"\b(" + "|".join(words) + r")\b")
    return reduce(or_, (col(c).contains(w) for w in words))


def count_contained(c, words) -> Column:
    return sum((col(c).contains(w).cast("int") for w in words), F.lit(0))


def occurrences(c, piece: str) -> Column:
    c = col(c)
    return ((F.length(c) - F.length(F.replace(c, F.lit(piece), F.lit("")))) / len(piece)).cast("int")


def normalise(c) -> Column:
    """Upper case, single blanks, no trailing semicolons, no blanks at the ends."""
    flat = F.regexp_replace(F.upper(strip(text(c))), r"\s+", " ")
    return F.rtrim(F.rtrim(flat, F.lit(";")))


def tokens(c) -> Column:
    return F.regexp_extract_all(F.lower(text(c)), F.lit(TOKEN_PATTERN), F.lit(0))


def words(c) -> Column:
    """Whitespace-separated words without empty ones."""
    return F.filter(F.split(col(c), r"\s+"), lambda w: w != "")


def word_set(c) -> Column:
    return F.array_distinct(words(c))


def complexity(c) -> Column:
    s = F.upper(text(c))
    points = (F.when(s.contains("JOIN"), 2).otherwise(0) + F.when(occurrences(s, "SELECT") > 1, 2).otherwise(0)
              + F.when(contains_any(s, AGGREGATE_WORDS), 1).otherwise(0)
              + F.when(contains_any(s, WINDOW_WORDS), 2).otherwise(0)
              + F.when(s.contains("WHERE") & contains_any(s, ("AND", "OR")), 1).otherwise(0))
    return F.when(points >= 4, "complex").when(points >= 2, "medium").otherwise("simple")


def query_type(c) -> Column:
    s = strip(F.upper(text(c)))
    out = F.when(s.startswith("SELECT"),
                 F.when(contains_any(s, AGGREGATE_WORDS), "select_aggregate")
                 .when(s.contains("JOIN"), "select_join").otherwise("select_simple"))
    for verb in ("INSERT", "UPDATE", "DELETE", "CREATE"):
        out = out.when(s.startswith(verb), verb.lower())
    return out.otherwise("unknown")


def referenced_tables(c) -> Column:
    s = F.upper(text(c))
    found = [F.regexp_extract_all(s, F.lit(rf"{w}\s+(\w+)"), F.lit(1)) for w in ("FROM", "JOIN")]
    return F.array_distinct(F.concat(*found))


def length_class(c) -> Column:
    n = F.length(text(c))
    return F.when(n < 50, "Short (<50)").when(n < 150, "Medium (50-150)").otherwise("Long (>150)")


def question_type(c, word: bool = False) -> Column:
    q = F.lower(text(c))
    out = F
    for name, hints in QUESTION_TYPES:
        out = out.when(contains_any(q, hints, word), name)
    return out.otherwise(DEFAULT_TYPE)


def question_categories(c) -> Column:
    q = F.lower(text(c))
    out = F
    for pair, hints in QUESTION_CATEGORIES:
        out = out.when(contains_any(q, hints), F.array(*[F.lit(p) for p in pair]))
    return out.otherwise(F.array(*[F.lit(p) for p in DEFAULT_CATEGORIES]))


def length_confidence(token_array: Column) -> Column:
    n = F.size(token_array)
    return F.when(n < 10, 0.5).when(n < 20, 0.8).otherwise(0.9)


def is_safe(c, mode: str = "keyword") -> Column:
    """Read-only label. ``keyword``: no blocked word and SELECT (or WITH) first; ``loose``: no
    blocked word; ``prefix``: starts with select or with."""
    if mode == "prefix":
        return F.coalesce(F.lower(strip(c)).rlike("^(select|with)"), F.lit(False))
    s = F.upper(text(c))
    clear = ~contains_any(s, BLOCKED_KEYWORD if mode == "keyword" else BLOCKED_LOOSE)
    if mode == "loose":
        return clear
    return clear & strip(s).rlike(r"^(SELECT|WITH)\b")


def plausible_sql(c) -> Column:
    """Allowed first word, FROM or DUAL after SELECT, as many opening as closing brackets."""
    s = strip(F.upper(text(c)))
    starts = s.rlike("^(" + "|".join(VALID_STARTS) + ")")
    has_source = ~s.startswith("SELECT") | contains_any(s, ("FROM", "DUAL"))
    return starts & has_source & (occurrences(s, "(") == occurrences(s, ")"))


def tidy_sql(c) -> Column:
    return F.rtrim(F.regexp_replace(strip(c), r"\s+", " "), F.lit(";"))
