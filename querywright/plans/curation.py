"""Catalog and pair-curation queries."""

from pyspark.sql import functions as F

from querywright.functions import sqltext as st
from querywright.operators import catalog, curate
from querywright.plans.fixtures import (columns_catalog, edges_catalog, qa_pairs, raw_pairs, search_terms,
                                        user_questions)
from querywright.plans.profiles import rounded
from querywright.scale import union_all
from querywright.sources.tables import FOREIGN_KEYS, NAMES, PRIMARY_KEYS, load_report
from querywright.streaming.history import work_folder


def cat01(t):
    """The listing with the number of rows behind each column."""
    tables = {n: getattr(t, n) for n in NAMES}
    info = catalog.schema_info(t.spark, tables, PRIMARY_KEYS).drop("nullable")
    return info.join(load_report(tables).select("table_name", "rows"), "table_name")


def cat02(t):
    """Declared references with the rows and distinct values that use them."""
    used = union_all([getattr(t, table).agg(F.count(column).alias("rows"), F.countDistinct(column).alias("distinct_values"))
                      .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "rows", "distinct_values")
                      for table, column, _, _ in FOREIGN_KEYS])
    return catalog.declared_keys(t.spark, FOREIGN_KEYS).join(used, ["table_name", "column_name"])


def cat03(t):
    return catalog.schema_topk(columns_catalog(t))


def cat04(t):
    return catalog.edge_lines(edges_catalog(t))


def cat04_text(t):
    return catalog.schema_graph(edges_catalog(t))


def cat05(t):
    return union_all([catalog.schema_text(columns_catalog(t), s).withColumn("style", F.lit(s)) for s in catalog.STYLES])


def cat06(t):
    return catalog.parse_schema_text(catalog.schema_text(columns_catalog(t)), "text").select("table", "column")


def cat07(t):
    return catalog.build_cards(columns_catalog(t), edges_catalog(t))


def cat08(t):
    cards = catalog.build_cards(columns_catalog(t))
    return catalog.search_cards(cards, search_terms(t)).select("query", "id")


def cat08_tables(t):
    cards = catalog.build_cards(columns_catalog(t))
    return catalog.search_cards(cards, search_terms(t), card_type="table").select("query", "id")


def cat09(t):
    cards = catalog.build_cards(columns_catalog(t))
    out = catalog.match_any_word(user_questions(t), cards, "qid", "question")
    return out.withColumn("rank", F.col("rank").cast("long"))


def cur01(t):
    rows = curate.checked_pairs(raw_pairs(t))
    return rows.select("pair_id", F.array_join(F.filter("issues", lambda x: x.contains("Missing or empty")), "; ").alias("missing"))


def cur02(t):
    rows = curate.checked_pairs(raw_pairs(t)).filter((st.text("question") != "") & (st.text("sql") != ""))
    return rows.select("pair_id", F.md5("question").alias("question_md5"), F.length("question").cast("long").alias("length"))


def cur03(t):
    return raw_pairs(t).select("pair_id", F.coalesce(st.plausible_sql("sql"), F.lit(False)).alias("plausible"))


def cur04(t):
    return raw_pairs(t).select("pair_id", st.tidy_sql("sql").alias("sql"))


def cur05(t):
    rows = curate.context_fields(raw_pairs(t))
    return rows.select("pair_id", F.array_join("_tables", ",").alias("tables"), F.array_join("_columns", ",").alias("columns"),
                       F.array_join("_context_issues", "; ").alias("issues"))


def cur06(t):
    return curate.validate_pairs(raw_pairs(t))[1]


def cur06_warnings(t):
    return curate.validate_pairs(raw_pairs(t), keep_warnings=True)[1]


def cur07(t):
    return rounded(curate.quality_report(raw_pairs(t)), "avg_question_length", "avg_sql_length")


def cur08(t):
    return curate.schema_coverage(raw_pairs(t))


def cur09(t):
    rows = raw_pairs(t).select("category", st.complexity("sql").alias("complexity"))
    return curate.distribution(rows, "category", "complexity")


def cur10(t):
    rows = raw_pairs(t).select("pair_id", "question").unionByName(qa_pairs(t).select("pair_id", "question"))
    return rows.filter(F.col("question").isNotNull()).select("pair_id", F.md5(curate.paraphrase("question")).alias("paraphrase_md5"),
                                                             F.length(curate.paraphrase("question")).cast("long").alias("length"))


def cur11(t):
    return curate.sql_variants(raw_pairs(t).select("pair_id", "sql"))


def cur12(t):
    rows = raw_pairs(t).select("pair_id", F.replace("sql", F.lit(" AS n"), F.lit("")).alias("sql"))
    return rows.select("pair_id", curate.alias_aggregate("sql").alias("sql"))


def cur13(t):
    valid = curate.validate_pairs(raw_pairs(t))[0].select("pair_id", "question", "sql")
    out = curate.augment(valid, factor=1.5, folder=work_folder(t.spark, "pairs"))
    return out.select("pair_id", "origin", F.md5(F.concat_ws("|", "question", "sql")).alias("content_md5"))


def cur14(t):
    return curate.split(qa_pairs(t).select("pair_id"), "pair_id")


def cur15(t):
    rows = curate.checked_pairs(raw_pairs(t)).filter("is_valid")
    return rows.select("pair_id", F.md5(curate.tuning_input("question", "relevant_tables", "relevant_columns")).alias("input_md5"))


def cur16(t):
    rows = raw_pairs(t).filter(F.col("question").isNotNull())
    return rows.select("pair_id", F.md5(curate.model_input("question", "schema_context")).alias("input_md5"))


def _asked(t):
    """All questions, of conversations and of raw pairs, with the key under which near copies meet."""
    rows = qa_pairs(t).select(F.concat(F.lit("q"), F.col("pair_id").cast("string")).alias("row_id"), "question").unionByName(
        raw_pairs(t).select(F.concat(F.lit("r"), F.col("pair_id").cast("string")).alias("row_id"), "question"))
    return rows.withColumn("_group", F.regexp_replace(F.lower(F.trim(F.coalesce("question", F.lit("")))), "[ ]+", " "))


def cur17(t):
    """Every question with its split; equal normalised questions stay together."""
    return curate.split_by_group(_asked(t), F.col("_group")).select("row_id", "group_key", "split")


def cur17_leaks(t):
    """What a split by single rows would leak."""
    single = curate.split(_asked(t).select("row_id", F.md5("_group").alias("group_key")), "row_id")
    return curate.leaks(single).select("group_key", "n_rows", F.array_join("splits", ",").alias("splits"))


PLANS = {name[:5].upper() + name[5:]: f for name, f in list(globals().items())
         if callable(f) and name[:3] in ("cat", "cur") and name[3:5].isdigit()}
