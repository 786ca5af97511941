"""Catalog listings, schema text, cards and card search.

A catalog is three flat tables: columns (table_name, column_name, position, data_type, nullable,
is_primary_key), edges (table_name, column_name, ref_table, ref_column) and the cards built from
them."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from querywright.functions.sqltext import words
from querywright.scale import broadcast_if, checked_broadcast, few_rows, spread, top_k
from querywright.streaming.history import stored

GRAM = 3
RUN = r"\p{L}+|\p{Nd}+"   # runs of letters, runs of digits
RUN_PIECE = 12            # longest word looked up among the substrings of runs
HOT_WORDS = 10_000        # words broadcast to the queries


def schema_info(spark: SparkSession, tables: dict, primary_keys=None) -> DataFrame:
    """(table_name, column_name, position, data_type, nullable, is_primary_key) of DataFrames."""
    primary_keys = primary_keys or {}
    rows = [F.struct(F.lit(name).alias("table_name"), F.lit(f.name).alias("column_name"),
                     F.lit(i).cast("long").alias("position"), F.lit(f.dataType.simpleString()).alias("data_type"),
                     F.lit(f.nullable).alias("nullable"), F.lit(f.name in primary_keys.get(name, ())).alias("is_primary_key"))
            for name, df in tables.items() for i, f in enumerate(df.schema)]
    return spark.range(0, 1, 1, 1).select(F.explode(F.array(*rows)).alias("c")).select("c.*")


def declared_keys(spark: SparkSession, foreign_keys) -> DataFrame:
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(("table_name", "column_name", "ref_table", "ref_column"), fk)])
            for fk in foreign_keys]
    return spark.range(0, 1, 1, 1).select(F.explode(F.array(*rows)).alias("k")).select("k.*")


def _ordered_text(piece: Column, glue: str = ", ") -> Column:
    """Pieces of a group in position order, joined."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col("position"), piece.alias("piece"))))
    return F.array_join(F.transform(ordered, lambda x: x["piece"]), glue)


def schema_topk(columns: DataFrame, k: int = 5, shown: int = 6) -> DataFrame:
    """The k tables with most columns and their first columns, as ``name:type`` (``*`` = key)."""
    sizes = columns.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_columns"))
    top = sizes.orderBy(F.desc("n_columns"), "table_name").limit(k)
    few = top_k(columns.join(F.broadcast(top), "table_name"), ["table_name"], ["position"], shown)
    piece = F.concat("column_name", F.lit(":"), "data_type", F.when(F.col("is_primary_key"), "*").otherwise(""))
    return few.groupBy("table_name", "n_columns").agg(_ordered_text(piece).alias("columns"))


def edge_lines(edges: DataFrame) -> DataFrame:
    """One line ``t.c → rt.rc`` per foreign key."""
    return edges.select("table_name", F.format_string(
        "%s.%s → %s.%s", "table_name", "column_name", "ref_table", "ref_column").alias("line"))


def schema_graph(edges: DataFrame) -> DataFrame:
    """The edge lines of each table as one text, in order. A text is as long as its table has keys; the texts in the order
    of their tables are the text of the whole catalog."""
    return edge_lines(edges).groupBy("table_name").agg(
        F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("schema_graph"))


STYLES = {
    # style: (text per column, text per table)
    "names": (lambda: F.col("column_name"), lambda cols: F.concat("table_name", F.lit("("), cols, F.lit(")"))),
    "typed": (lambda: F.concat("column_name", F.lit("("), "data_type", F.lit(")")),
              lambda cols: F.concat(F.lit("- "), "table_name", F.lit(": "), cols)),
    "keys": (lambda: F.concat("column_name", F.lit(":"), "data_type", F.when(F.col("is_primary_key"), " (PK)").otherwise("")),
             lambda cols: F.concat(F.lit("  "), "table_name", F.lit("("), cols, F.lit(")"))),
}


def schema_text(columns: DataFrame, style: str = "names") -> DataFrame:
    """One line of schema text per table."""
    piece, line = STYLES[style]
    per_table = columns.groupBy("table_name").agg(_ordered_text(piece()).alias("_cols"))
    return per_table.select("table_name", line(F.col("_cols")).alias("text"))


def parse_tables(c) -> Column:
    """Array of (table, columns text) found in ``t1(c1, c2), t2(c3)``."""
    pattern = r"(\w+)\s*\(([^)]+)\)"
    c = F.col(c) if isinstance(c, str) else c
    return F.arrays_zip(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)).alias("table"),
                        F.regexp_extract_all(c, F.lit(pattern), F.lit(2)).alias("columns"))


def parse_schema_text(df: DataFrame, text: str) -> DataFrame:
    """(row columns, table, column) with columns written as ``t.c``."""
    found = df.select("*", F.explode(parse_tables(text)).alias("_t"))
    return found.select(*df.columns, F.col("_t.table").alias("table"),
                        F.explode(F.split("_t.columns", ",")).alias("_c")).select(
        *df.columns, "table", F.concat("table", F.lit("."), F.trim("_c")).alias("column"))


def build_cards(columns: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """Table cards and column cards with derived id and content."""
    tables = columns.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_columns"))
    table_cards = tables.select(
        F.concat(F.lit("table_"), "table_name").alias("id"), F.lit("table").alias("type"), F.col("table_name").alias("name"),
        F.concat(F.lit("Table: "), "table_name").alias("content"), "table_name", "n_columns")
    if edges is None:
        linked = columns.withColumn("is_foreign_key", F.lit(False))
    else:
        refs = edges.select("table_name", "column_name").distinct().withColumn("_fk", F.lit(True))
        linked = columns.join(refs, ["table_name", "column_name"], "left").withColumn(
            "is_foreign_key", F.coalesce("_fk", F.lit(False)))
    kind = F.coalesce("data_type", F.lit("unknown"))
    column_cards = linked.select(
        F.concat_ws("_", F.lit("column"), "table_name", "column_name").alias("id"), F.lit("column").alias("type"),
        F.concat_ws(".", "table_name", "column_name").alias("name"),
        F.format_string("Column: %s.%s (%s)", F.col("table_name"), F.col("column_name"), kind).alias("content"), "table_name",
        kind.alias("data_type"), "nullable", "is_primary_key", "is_foreign_key")
    return table_cards.unionByName(column_cards, allowMissingColumns=True)


def _grams(text: Column, size: int) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(size))))


def contains_join(needles: DataFrame, needle: str, hay: DataFrame, texts, key: str = "id") -> DataFrame:
    """All (needle, row) pairs where a text column contains the needle, ignoring case, without a cross join.

    The rows are indexed by their grams of GRAM letters (shorter needles: by shorter grams, made only when such needles
    are asked). A gram's rows are counted once, and a needle meets the rows of its *rarest* gram alone, so its candidates are
    at most that gram's count. Keys and one text move through the index; the other columns are joined to the hits.

    ``needle`` values must be distinct and not empty; ``key`` must be distinct in ``hay``."""
    whole = F.lower(F.concat_ws("\u0001", *texts))
    asked = needles.select(F.col(needle), F.lower(needle).alias("_needle")).withColumn(
        "_size", F.least(F.length("_needle"), F.lit(GRAM)))
    sizes = sorted(r[0] for r in asked.select("_size").distinct().collect())     # GRAM values at most
    by_size = lambda text, size: F.coalesce(*[F.when(size == g, _grams(text, g)) for g in sizes])
    if not sizes:
        return hay.limit(0).withColumn(needle, F.lit(None).cast("string"))
    grams = asked.select(needle, "_needle", F.explode(by_size(F.col("_needle"), F.col("_size"))).alias("_gram"))
    wanted = grams.select("_gram").distinct()
    small = few_rows(wanted)
    index = spread(hay.select(key, whole.alias("_text"))).select(key, "_text", F.explode(
        F.array_distinct(F.concat(*[_grams(F.col("_text"), g) for g in sizes]))).alias("_gram"))
    index = index.join(broadcast_if(wanted, small), "_gram", "left_semi")
    counts = index.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    rarest = (grams.join(counts, "_gram", "left").groupBy(needle, "_needle")
              .agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_gram").alias("gram"))).alias("_r"))
              .filter("_r.n > 0").select(needle, "_needle", F.col("_r.gram").alias("_gram")))
    rarest = F.broadcast(rarest) if few_rows(needles) else checked_broadcast(rarest)  # most of many needles have no row
    hits = index.join(rarest, "_gram").filter(F.col("_text").contains(F.col("_needle")))
    return hay.join(hits.select(key, needle), key).select(*hay.columns, needle)


def search_cards(cards: DataFrame, queries: DataFrame, query: str = "query", card_type: str | None = None) -> DataFrame:
    """Cards whose content or name contains the query text, for a table of queries."""
    pool = cards if card_type is None else cards.filter(F.col("type") == card_type)
    return contains_join(queries.select(query).distinct(), query, pool, ["content", "name"])


def _plain(word: Column) -> Column:
    """Whether a word is one run of letters or of digits, short enough to be looked up among the substrings of such runs."""
    return word.rlike(rf"\A({RUN})\z") & (F.length(word) <= RUN_PIECE)


def _first_with_run(words: DataFrame, cards: DataFrame, k: int) -> DataFrame:
    """(word, late, id, name, slots): the first k cards whose content holds each plain word.

    A word of letters alone, or digits alone, lies inside one run of them. Every run keeps its first k cards, and every asked
    substring of a run the first k of its runs, so neither step grows with words times cards. ``slots`` counts equal cards:
    every copy of a card takes a place, once for each of the rows of its id."""
    sizes = [r[0] for r in words.select(F.length("word")).distinct().collect()]  # RUN_PIECE values at most
    copies = Window.partitionBy("id")
    kept = (cards.filter(F.col("id").isNotNull()).select("id", "name", "content", (F.col("type") != "table").alias("late"))
            .repartition("id").groupBy("id", "name", "content", "late").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("slots", F.col("n") * F.sum("n").over(copies)).withColumn("_h", F.xxhash64("content")))
    card = ["late", "id", "name", "_h", "slots"]

    def first(rows, name):
        w = Window.partitionBy(name).orderBy(*card)
        return rows.withColumn("_r", F.dense_rank().over(w)).filter(F.col("_r") <= k).select(name, *card)

    runs = F.array_distinct(F.regexp_extract_all(F.lower("content"), F.lit(RUN), F.lit(0)))
    per_run = first(kept.select(F.explode(runs).alias("run"), *card), "run")
    pieces = F.array_distinct(F.concat(*[F.when(F.length("run") >= n, _grams(F.col("run"), n)).otherwise(F.array().cast("array<string>"))
                                         for n in sizes] or [F.array().cast("array<string>")]))
    per_word = first(per_run.select(F.explode(pieces).alias("word"), *card), "word")
    return (per_word.join(words.select("word"), "word", "left_semi").distinct()
            .groupBy("word", "late", "id", "name").agg(F.sum("slots").alias("slots")))


def match_any_word(queries: DataFrame, cards: DataFrame, key: str, text: str, k: int = 3) -> DataFrame:
    """The first k cards (tables first, then by id) holding any word of each query.

    Matching runs once per distinct word and keeps k cards per word, which is enough: the first k of
    a query are among the first k of its words. The cards found are numbered in their order, so a query gathers k numbers a
    word; the HOT_WORDS asked most travel to the queries, the others are joined."""
    asked = stored(queries.select(key, F.explode(F.array_distinct(words(F.lower(text)))).alias("word")), "asked")
    vocabulary = stored(asked.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "vocabulary")
    plain = vocabulary.filter(_plain(F.col("word")))
    other = vocabulary.filter(~_plain(F.col("word"))).select("word")
    late = (F.col("type") != "table").alias("late")
    rest = contains_join(other, "word", cards.select("id", "name", "content", late), ["content"])
    rest = rest.groupBy("word", "late", "id", "name").agg(F.count(F.lit(1)).alias("slots"))
    place = ["late", "id", "name"]
    w = Window.partitionBy("word").orderBy(*place)
    taken = F.coalesce(F.sum("slots").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    best = top_k(_first_with_run(plain, cards, k).unionByName(rest), ["word"], place, k)
    found = stored(best.withColumn("_taken", taken).filter(F.col("_taken") < k).select("word", *place), "found")
    # numbers follow the order of the partitions, which are ranges
    numbered = stored(found.select(*place).distinct().orderBy(*place).withColumn("_no", F.monotonically_increasing_id()), "cards")
    same = [found[c].eqNullSafe(numbered[c]) for c in place]
    lists = found.join(numbered, same).groupBy("word").agg(F.collect_list("_no").alias("_nos"))
    lists = stored(lists.join(vocabulary, "word"), "lists")
    hot = F.broadcast(lists.orderBy(F.desc("n"), "word").limit(HOT_WORDS).select("word", "_nos"))
    near = asked.join(hot, "word").select(key, "_nos")
    far = asked.join(hot, "word", "left_anti").join(lists, "word").select(key, "_nos")
    firsts = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_nos")))), 1, k)
    per_query = near.unionByName(far).groupBy(key).agg(firsts.alias("_nos"))
    rows = per_query.select(key, F.posexplode("_nos").alias("_at", "_no"))
    return rows.join(numbered.select("_no", "name"), "_no").select(key, "name", (F.col("_at") + 1).alias("rank"))
