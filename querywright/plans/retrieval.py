"""Retrieval queries: benchmark passages against all documents."""

from pyspark.sql import functions as F

from querywright.operators import retrieve as r
from querywright.plans.profiles import rounded
from querywright.scale import few_rows

K = 5


def docs(t):
    vectors = t.embeddings.select(F.col("vec_id").alias("doc_id"), "embedding")
    return t.documents.join(vectors, "doc_id", "left").select(
        F.col("doc_id").alias("id"), F.when(F.col("lang") == "en", "table").otherwise("column").alias("type"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("name"), F.col("text").alias("content"),
        F.col("n_chars").alias("n_columns"), F.col("lang").alias("data_type"), "embedding")


def corpus(t):
    return t.documents.select(F.col("doc_id").alias("id"), F.col("text").alias("content"))


def vectors(t):
    return t.embeddings.select(F.col("vec_id").alias("id"), "embedding")


def queries(t):
    vecs = t.embeddings.select(F.col("vec_id").alias("item_id"), "embedding")
    return t.benchmark.join(vecs, "item_id", "left").select(F.col("item_id").alias("qid"), "text", "embedding")


def hybrid(t):
    return r.hybrid_topk(docs(t), queries(t), K)


def contexts(t):
    return r.best_context(hybrid(t), queries(t))


def long_rank(df):
    return df.withColumn("rank", F.col("rank").cast("long"))


def ret01(t):
    return r.term_stats(corpus(t))


def ret01_postings(t):
    """Per document: length, distinct terms and the highest term count."""
    return r.postings(corpus(t)).groupBy("id").agg(F.max("dl").alias("dl"), F.count(F.lit(1)).alias("terms"), F.max("f").alias("top_f"))


def ret01_corpus(t):
    return rounded(r.corpus_stats(corpus(t)), "avgdl")


def ret02(t):
    return rounded(long_rank(r.bm25_topk(corpus(t), t.benchmark.select(F.col("item_id").alias("qid"), "text"), 10)), "score")


def ret03(t):
    return rounded(long_rank(r.dense_topk(vectors(t), queries(t), 10)), "score")


def ret04(t):
    top = r.bm25_topk(corpus(t), t.benchmark.select(F.col("item_id").alias("qid"), "text"), 2 * K)
    return rounded(r.min_max(top).drop("rank"), "score")


def ret05(t):
    d, q = docs(t), queries(t)
    return rounded(r.fuse(r.bm25_topk(d, q, 2 * K), r.dense_topk(d, q, 2 * K)), "score")


def ret06(t):
    return rounded(long_rank(hybrid(t)).select("qid", "id", "type", "score", "rank"), "score")


def ret07(t):
    return rounded(contexts(t).select("qid", "id", "type", F.md5("content").alias("content_md5"), "score"), "score")


def ret08(t):
    return rounded(r.relevance(contexts(t), docs(t), queries(t)), "relevance")


def ret09(t):
    return rounded(contexts(t).select("qid", r.coverage("text", "content").alias("coverage")), "coverage")


def ret09_documents(t):
    """Coverage of a fixed intent by every document."""
    return rounded(t.documents.select("doc_id", r.coverage(F.lit("count rows from a table where they join"), "text").alias("coverage")), "coverage")


def ret10(t):
    truths = t.benchmark.select(F.col("item_id").alias("qid"), F.col("text").alias("truth"))
    return rounded(r.quality(contexts(t), truths), "precision", "recall", "f1", "accuracy")


def ret11(t):
    def names(c):
        return F.array_join(F.transform(c, lambda x: x["name"]), ",")
    a = r.assemble(hybrid(t))
    return a.select("qid", names(F.col("tables")).alias("tables"), names(F.col("columns")).alias("columns"), F.size("items").cast("long").alias("n_items"))


def ret12(t):
    prompts = t.benchmark.select(F.col("item_id").alias("qid"), F.concat(F.lit("Answer: "), F.col("text")).alias("prompt"))
    return r.augment_prompt(prompts, r.assemble(hybrid(t)))


def ret13(t):
    d, q = docs(t), queries(t)
    ranked = hybrid(t)
    out = r.retrieval_report(r.relevance(r.best_context(ranked, q), d, q), ranked, d)
    return rounded(out, "avg_relevance", "min_relevance", "max_relevance", "std_relevance", "avg_context_items")


def ret14(t):
    scores = r.relevance(contexts(t), docs(t), queries(t))
    # one score a query: the questions bound the series, not the size Catalyst guesses for the joins behind it
    return rounded(r.retrieval_series(scores, distributed=not few_rows(queries(t).select("qid"))), "relevance_percent")


PLANS = {name[:5].upper() + name[5:]: f for name, f in list(globals().items())
         if callable(f) and name.startswith("ret") and name[3:5].isdigit()}
