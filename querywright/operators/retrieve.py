"""BM25, dense and hybrid retrieval for a table of queries over a table of documents.

docs: (id, type, content[, name, n_columns, data_type, embedding]); queries: (qid, text[, embedding]).
Every ranking is cut per task before it is shuffled, so neither a common term nor a popular query
gathers more than k rows per task."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from querywright.functions.sqltext import contains_any, text, tokens, word_set, words
from querywright.scale import broadcast_if, few_rows, fits, running_totals, top_k

K1, B, EPSILON = 1.5, 0.75, 0.25
SCORE_DIGITS = 9  # scores equal to this many digits rank by id
QUERY_BLOCK = 4096  # queries scored against one block of vectors
TILE_BYTES = 64 << 20
PART_CHARS = 16 << 20  # text whose terms one task counts
SCORE_ROWS = 512  # vectors scored at once

# Intent words of a query and the words that show the context covers them.
COVERAGE = (
    (("from", "table", "in"), ("table",)),
    (("select", "where", "column", "field"), ("column",)),
    (("count", "sum", "average", "max", "min", "total"), ("count", "sum", "avg", "aggregate")),
    (("join", "combine", "merge", "across", "between"), ("join", "foreign", "relationship")),
)
UNASKED_COVERAGE = 0.8


def term_list(c, tokenizer: str = "whitespace") -> Column:
    """Case-sensitive whitespace words (punctuation stays), or lower-cased word tokens."""
    return tokens(c) if tokenizer == "word" else words(c)


def _parts(docs: DataFrame, chars: int | None) -> int:
    """Partitions of at most PART_CHARS of text on average, whatever the corpus."""
    return max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil((chars or 0) / PART_CHARS))


def _chars(docs: DataFrame) -> int | None:
    return docs.agg(F.sum(F.length("content").cast("long"))).first()[0]


def _tokenised(docs: DataFrame, tokenizer: str, parts: int | None = None) -> DataFrame:
    """Token lists partitioned by document. The text is shuffled before it is split (it is smaller
    than its tokens), once for all uses in a plan; counts per document then stay in place."""
    rows = docs.select("id", "content").repartition(*([parts] if parts else []), "id")
    return rows.select("id", term_list("content", tokenizer).alias("_tok")).withColumn("dl", F.size("_tok").cast("long"))


def postings(docs: DataFrame, vocabulary: DataFrame | None = None, small: bool = False,
             tokenizer: str = "whitespace", parts: int | None = None) -> DataFrame:
    """(id, dl, term, f), partitioned by document. With a vocabulary only its terms are kept; a
    ``small`` one is broadcast and nothing further is shuffled. The partitions follow from the size of the text, so a task
    counts the terms of a bounded part."""
    rows = _tokenised(docs, tokenizer, parts or _parts(docs, _chars(docs))).select("id", "dl", F.explode_outer("_tok").alias("term"))
    if vocabulary is not None:
        rows = rows.join(broadcast_if(vocabulary, small), "term", "left_semi")
    return rows.filter(F.col("term").isNotNull()).groupBy("id", "dl", "term").agg(F.count(F.lit(1)).alias("f"))


def term_stats(docs: DataFrame, tokenizer: str = "whitespace", parts: int | None = None) -> DataFrame:
    """(term, df) over the whole corpus; each document counts a term once before the shuffle."""
    # the outer form keeps Catalyst from testing the token list a second time in the scan, which
    # would also stop the uses of the shuffled text from sharing it
    return (_tokenised(docs, tokenizer, parts).select(F.explode_outer(F.array_distinct("_tok")).alias("term"))
            .filter(F.col("term").isNotNull()).groupBy("term").agg(F.count(F.lit(1)).alias("df")))


def corpus_stats(docs: DataFrame, tokenizer: str = "whitespace", parts: int | None = None) -> DataFrame:
    """One row: number of documents and mean length."""
    return _tokenised(docs, tokenizer, parts).agg(F.count(F.lit(1)).alias("n_docs"), F.avg("dl").alias("avgdl"))


def raw_idf(n: Column, df: Column) -> Column:
    return F.ln(n - df + 0.5) - F.ln(df + 0.5)


def bm25_topk(docs: DataFrame, queries: DataFrame, k: int, tokenizer: str = "whitespace") -> DataFrame:
    """(qid, id, score, rank): Okapi scores above zero, best k per query."""
    parts = _parts(docs, _chars(docs))
    stats = corpus_stats(docs, tokenizer, parts).select(F.struct("n_docs", "avgdl")).scalar()
    frequencies = term_stats(docs, tokenizer, parts).withColumn("_s", stats)
    idf = frequencies.select("term", raw_idf(F.col("_s.n_docs"), F.col("df")).alias("idf"))
    floor = idf.agg(F.avg("idf") * EPSILON).scalar()
    asked = queries.select("qid", F.explode(term_list("text", tokenizer)).alias("term")).groupBy("qid", "term").agg(
        F.count(F.lit(1)).alias("qtf"))
    small = few_rows(asked)  # bounds the vocabulary and the weights too
    vocabulary = asked.select("term").distinct()
    known = idf.join(broadcast_if(vocabulary, small), "term").withColumn("_floor", floor)
    weights = asked.join(known, "term").select(
        "qid", "term", (F.col("qtf") * F.when(F.col("idf") < 0, F.col("_floor")).otherwise(F.col("idf"))).alias("w"))
    hits = postings(docs, vocabulary, small, tokenizer, parts).withColumn("_s", stats)
    norm = F.col("f") + K1 * (1 - B + B * F.col("dl") / F.col("_s.avgdl"))
    hits = hits.select("id", "term", (F.col("f") * (K1 + 1) / norm).alias("gain"))
    scores = hits.join(broadcast_if(weights, small), "term").groupBy("qid", "id").agg(
        F.round(F.sum(F.col("w") * F.col("gain")), SCORE_DIGITS).alias("score"))
    return top_k(scores.filter(F.col("score") > 0), ["qid"], [F.desc("score"), F.asc("id")], k)


def _unit(column: pd.Series) -> np.ndarray:
    m = np.vstack([np.asarray(v, dtype="float64") for v in column])
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def _best(parts, qids, queries, k) -> pd.DataFrame:
    """The best k of each query over all (ids, embeddings) in ``parts``, ties by id. Vectors are scored in blocks of
    SCORE_ROWS, so a task holds one block of scores (16 MB for 4,096 queries) and k rows per query, whatever it reads; a
    block of nothing but ties adds two million short rows to that while it is merged."""
    held, floor = None, np.full(len(qids), -np.inf)
    for ids, embeddings in parts:
        for start in range(0, len(ids), SCORE_ROWS):
            some = ids[start:start + SCORE_ROWS]
            scores = np.round(_unit(embeddings[start:start + SCORE_ROWS]) @ queries.T, SCORE_DIGITS)
            cut = floor
            if len(some) > k:
                cut = np.maximum(floor, np.partition(scores, len(some) - k, axis=0)[len(some) - k])
            rows, cols = np.nonzero(scores >= cut)
            if not len(rows):
                continue
            fresh = pd.DataFrame({"q": cols, "id": some[rows], "score": scores[rows, cols]})
            held = fresh if held is None else pd.concat([held, fresh], ignore_index=True)
            held = held.sort_values(["q", "score", "id"], ascending=[True, False, True]).groupby("q").head(k)
            last = held.groupby("q")["score"].agg(["size", "min"])
            full = last[last["size"] == k]
            floor[full.index.to_numpy()] = full["min"].to_numpy()
    if held is None:
        return pd.DataFrame({"qid": [], "id": [], "score": []})
    return pd.DataFrame({"qid": qids[held["q"].to_numpy()], "id": held["id"].to_numpy(), "score": held["score"].to_numpy()})


def dense_topk(docs: DataFrame, queries: DataFrame, k: int, block: int = QUERY_BLOCK) -> DataFrame:
    """(qid, id, score, rank): exact cosine ranking.

    A batch of at most ``block`` queries travels to the vectors, which are scored where they are; every task sends on its
    best k per query once. A larger batch is joined in tiles of at most TILE_BYTES of vectors and ``block`` queries; their
    number follows from a count of the vectors."""
    vectors = docs.filter(F.col("embedding").isNotNull()).select("id", "embedding")
    asked = queries.filter(F.col("embedding").isNotNull()).select("qid", "embedding")
    schema = f"qid {dict(asked.dtypes)['qid']}, id {dict(vectors.dtypes)['id']}, score double"
    few = asked.limit(block + 1).toPandas()
    if len(few) == 0:
        found = vectors.sparkSession.createDataFrame([], schema)
    elif len(few) <= block:
        qids, matrix = few["qid"].to_numpy(), _unit(few["embedding"])

        def score(batches):
            yield _best(((b["id"].to_numpy(), b["embedding"]) for b in batches), qids, matrix, k)
        found = vectors.mapInPandas(score, schema)
    else:
        tile_rows = max(1, TILE_BYTES // (8 * max(1, len(few["embedding"].iloc[0]))))
        rows = max(1, math.ceil(vectors.count() / tile_rows))
        cols = math.ceil(asked.count() / block)

        def every(n):
            return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

        left = vectors.select("*", F.pmod(F.xxhash64("id"), F.lit(rows)).cast("long").alias("_r"), every(cols).alias("_c"))
        right = asked.select("*", F.pmod(F.xxhash64("qid"), F.lit(cols)).cast("long").alias("_c"), every(rows).alias("_r"))

        def tile(v: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
            if v.empty or q.empty:
                return pd.DataFrame({"qid": [], "id": [], "score": []})
            return _best([(v["id"].to_numpy(), v["embedding"])], q["qid"].to_numpy(), _unit(q["embedding"]), k)
        found = left.groupBy("_r", "_c").cogroup(right.groupBy("_r", "_c")).applyInPandas(tile, schema)
    return top_k(found, ["qid"], [F.desc("score"), F.asc("id")], k)


def min_max(ranked: DataFrame) -> DataFrame:
    """Scores of a cut ranking scaled to 0..1 per query; all equal becomes 1."""
    w = Window.partitionBy("qid")
    lo, hi = F.min("score").over(w), F.max("score").over(w)
    return ranked.withColumn("score", F.when(hi == lo, 1.0).otherwise((F.col("score") - lo) / (hi - lo)))


def fuse(sparse: DataFrame, dense: DataFrame, alpha: float = 0.5) -> DataFrame:
    """Weighted sum of normalised scores damped by position; 1.2 times when found by both."""
    def side(ranked, weight, name):
        return min_max(ranked).select("qid", "id", (F.col("score") * weight / (1 + 0.1 * (F.col("rank") - 1))).alias(name))

    both = side(sparse, 1 - alpha, "_b").join(side(dense, alpha, "_d"), ["qid", "id"], "full_outer")
    total = F.coalesce("_b", F.lit(0.0)) + F.coalesce("_d", F.lit(0.0))
    found_twice = F.col("_b").isNotNull() & F.col("_d").isNotNull()
    return both.select("qid", "id", (total * F.when(found_twice, 1.2).otherwise(1.0)).alias("score"))


def rerank(results: DataFrame, docs: DataFrame, queries: DataFrame, k: int, rich: bool = True) -> DataFrame:
    """Boost word overlap, tables and rich metadata; best k with their documents."""
    small = few_rows(queries.select("qid"), row_bytes=64 * 4 * k)  # at most 4k candidates a query
    with_docs = docs.drop("embedding").join(broadcast_if(results, small), "id")
    rows = with_docs.join(queries.select("qid", word_set(F.lower("text")).alias("_q")), "qid")
    overlap = F.size(F.array_intersect("_q", word_set(F.lower("content"))))
    boost = (1 + 0.1 * overlap) * F.when(F.col("type") == "table", 1.15).otherwise(1.0) * (1.05 if rich else 1.0)
    rows = rows.withColumn("score", F.round(F.col("score") * boost, SCORE_DIGITS)).drop("_q")
    return top_k(rows, ["qid"], [F.desc("score"), F.asc("id")], k)


def hybrid_topk(docs: DataFrame, queries: DataFrame, k: int = 10, alpha: float = 0.5) -> DataFrame:
    """Twice k candidates from each side, fused, reranked, cut to k."""
    fused = fuse(bm25_topk(docs, queries, 2 * k), dense_topk(docs, queries, 2 * k), alpha)
    return rerank(fused, docs, queries, k)


def best_context(ranked: DataFrame, queries: DataFrame) -> DataFrame:
    """The first result per query, or an empty record."""
    first = ranked.filter(F.col("rank") == 1).select("qid", "id", "type", "content", "score")
    return queries.select("qid", "text").join(first, "qid", "left").select(
        "qid", "text", "id", F.coalesce("type", F.lit("none")).alias("type"),
        F.coalesce("content", F.lit("")).alias("content"), F.coalesce("score", F.lit(0.0)).alias("score"))


def coverage(query, context) -> Column:
    """Mean of the intents the context covers; 0.8 when the query shows none."""
    q, c = F.lower(text(query)), F.lower(text(context))
    asked = [contains_any(q, intent) for intent, _ in COVERAGE]
    hits = sum(((a & contains_any(c, shown)).cast("int") for a, (_, shown) in zip(asked, COVERAGE)), F.lit(0))
    checks = sum((a.cast("int") for a in asked), F.lit(0))
    return F.coalesce(F.try_divide(hits, checks), F.lit(UNASKED_COVERAGE))


def cosine(a, b) -> Column:
    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def relevance(contexts: DataFrame, docs: DataFrame, queries: DataFrame) -> DataFrame:
    """Relevance of each query's context: words .4, cosine .4 (words again without vectors),
    coverage .2. An empty query or context scores 0."""
    needed = contexts.select("qid", "id").filter(F.col("id").isNotNull())
    small = few_rows(queries.select("qid"))  # one context a query
    vectors = docs.select("id", F.col("embedding").alias("_v")).join(broadcast_if(needed, small), "id").select("qid", "_v")
    rows = contexts.join(vectors, "qid", "left").join(queries.select("qid", F.col("embedding").alias("_qv")), "qid")
    q = word_set(F.lower("text"))
    lexical = F.coalesce(F.try_divide(F.size(F.array_intersect(q, word_set(F.lower("content")))), F.size(q)), F.lit(0.0))
    rows = rows.withColumn("lexical", lexical)
    semantic = F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine("_v", "_qv"))), F.col("lexical"))
    total = F.least(F.lit(1.0), F.col("lexical") * 0.4 + semantic * 0.4 + coverage("text", "content") * 0.2)
    empty = (F.col("content") == "") | (F.size(q) == 0)
    return rows.select("qid", F.when(empty, 0.0).otherwise(total).alias("relevance"))


def quality(contexts: DataFrame, truths: DataFrame) -> DataFrame:
    """A hit contains the truth text. One result per query makes precision, recall and accuracy equal."""
    hit = F.lower("content").contains(F.lower("truth")).cast("double")
    p = truths.join(contexts, "qid").agg(F.coalesce(F.avg(hit), F.lit(0.0)).alias("precision"))
    f1 = F.when(F.col("precision") > 0, F.col("precision")).otherwise(0.0)
    return p.select("precision", F.col("precision").alias("recall"), f1.alias("f1"), F.col("precision").alias("accuracy"))


def assemble(ranked: DataFrame) -> DataFrame:
    """Tables, columns and scored items per query, in rank order (at most k items a query)."""
    items = F.array_sort(F.collect_list(F.struct("rank", "type", "id", "name", "n_columns", "data_type", "score")))
    return ranked.groupBy("qid").agg(items.alias("items")).select(
        "qid", F.filter("items", lambda x: x["type"] == "table").alias("tables"),
        F.filter("items", lambda x: x["type"] == "column").alias("columns"), "items")


def augment_prompt(prompts: DataFrame, assembled: DataFrame, max_tables: int = 3, max_columns: int = 5) -> DataFrame:
    """Append the first tables and columns to each prompt (qid, prompt)."""
    joined = prompts.join(assembled, "qid", "left")

    def block(title, array, limit, line):
        lines = F.array_join(F.transform(F.slice(array, 1, limit), line), "")
        return F.when(F.size(array) > 0, F.concat(F.lit(title), lines)).otherwise("")

    tables = block("### Relevant Tables:\n", F.col("tables"), max_tables, lambda x: F.format_string(
        "- %s: %d columns\n", x["name"], x["n_columns"]))
    columns = block("### Relevant Columns:\n", F.col("columns"), max_columns, lambda x: F.format_string(
        "- %s (%s)\n", x["name"], x["data_type"]))
    return joined.select("qid", F.concat(F.col("prompt"), F.lit("\n\n## Retrieved Schema Context:\n"), F.coalesce(tables, F.lit("")),
                                         F.coalesce(columns, F.lit("")), F.lit("\n")).alias("prompt"))


def retrieval_report(scores: DataFrame, ranked: DataFrame, docs: DataFrame, target: float = 0.75) -> DataFrame:
    """Relevance summary, items per query, corpus size and whether the target is met."""
    per_query = scores.select("qid").join(ranked.groupBy("qid").agg(F.count(F.lit(1)).alias("n")), "qid", "left")
    items = per_query.agg(F.avg(F.coalesce("n", F.lit(0)))).scalar()
    cards = docs.agg(F.count(F.lit(1))).scalar()
    out = scores.agg(F.avg("relevance").alias("avg_relevance"), F.min("relevance").alias("min_relevance"),
                     F.max("relevance").alias("max_relevance"), F.stddev_pop("relevance").alias("std_relevance"))
    return out.withColumn("avg_context_items", items).withColumn("total_cards", cards).withColumn(
        "target_achieved", F.col("avg_relevance") >= target)


def retrieval_series(scores: DataFrame, times: DataFrame | None = None, distributed: bool | None = None) -> DataFrame:
    """Relevance in percent (and milliseconds, when measured) by question ordinal. The ordinal is
    the order of ``qid``; the series has one point per query. Large batches are ranked in ranges of ``qid``."""
    if distributed is None:
        distributed = not fits(scores)
    ranked = running_totals(scores.withColumn("n", F.lit(1)), [], "qid", distributed)
    out = ranked.select("qid", (F.col("before") + 1).alias("ordinal"), (F.col("relevance") * 100).alias("relevance_percent"))
    if times is None:
        return out
    return out.join(times.select("qid", (F.col("response_time") * 1000).alias("time_ms")), "qid")
