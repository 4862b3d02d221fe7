"""Lexical and vector retrieval: scores, fused ranks, budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The constant of reciprocal rank fusion (fixed value).
RRF_K = 60


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[a-z0-9]+"), 0)


def lexical_scores(docs: DataFrame, doc: str, text: str, asked: DataFrame, query: str, words: str) -> DataFrame:
    """``(query, doc, score)``: sum over shared words of their counts in the query times in the document."""
    of_query = asked.select(query, F.explode(tokens(F.col(words))).alias("word")).groupBy(query, "word").agg(F.count("*").alias("q"))
    of_doc = docs.select(doc, F.explode(tokens(F.col(text))).alias("word"))
    # only the words that are asked for leave the documents' side
    of_doc = of_doc.join(of_query.select("word").distinct(), "word", "left_semi")
    of_doc = of_doc.groupBy(doc, "word").agg(F.count("*").alias("d"))
    return of_doc.join(of_query, "word").groupBy(query, doc).agg(F.sum(F.col("q") * F.col("d")).alias("score"))


def lexical_counts(docs: DataFrame, doc: str, words: str, asked: DataFrame) -> DataFrame:
    """``(doc, score)``: the same of word arrays and one query ``asked(word, q)``."""
    of_doc = docs.select(doc, F.explode(words).alias("word")).join(asked, "word")
    return of_doc.groupBy(doc).agg(F.sum("q").alias("score"))


def top_ranked(scores: DataFrame, group: str, item: str, score: str, k: int) -> DataFrame:
    """``(group, item, score, rank)`` of the ``k`` best items, equal scores by item."""
    window = Window.partitionBy(group).orderBy(F.desc(score), F.asc(item))
    return scores.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def fuse(lists: list[DataFrame], group: str, item: str) -> DataFrame:
    """``(group, item, fused)``: sum of 1 / (60 + rank) over the lists that name the item."""
    long = lists[0].select(group, item, "rank")
    for other in lists[1:]:
        long = long.unionByName(other.select(group, item, "rank"))
    return long.groupBy(group, item).agg(F.sum(1.0 / (RRF_K + F.col("rank"))).alias("fused"))


def within_budget(ranked: DataFrame, group: str, item: str, rank: str, cost: str, most_items: int, budget: int) -> DataFrame:
    """``(group, item, rank, cost, selected)``: items taken in rank order as long as number and cost allow; one too dear is passed over.

    One list for each group, of as many items as its ranked list has.
    """
    listed = ranked.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(F.col(rank).alias("rank"), F.col(item).alias("item"), F.col(cost).cast("long").alias("cost")))).alias("all"))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("sum"), F.array().cast("array<int>").alias("took"))

    def step(s, x):
        fits = (s["n"] < most_items) & (s["sum"] + x["cost"] <= budget)
        return F.struct((s["n"] + F.when(fits, 1).otherwise(0)).alias("n"), (s["sum"] + F.when(fits, x["cost"]).otherwise(F.lit(0))).alias("sum"), F.when(fits, F.concat(s["took"], F.array(x["rank"].cast("int")))).otherwise(s["took"]).alias("took"))

    folded = listed.withColumn("took", F.aggregate("all", start, step)["took"])
    out = folded.select(group, F.explode("all").alias("x"), "took")
    return out.select(group, F.col("x.item").alias(item), F.col("x.rank").alias(rank), F.col("x.cost").alias(cost), F.array_contains("took", F.col("x.rank").cast("int")).alias("selected"))


def dot(a: Column, b: Column) -> Column:
    """Sum of products of two arrays, in double."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(vector: Column) -> Column:
    """The vector divided by its length; null for the zero vector."""
    length = F.sqrt(dot(vector, vector))
    return F.when(length > 0, F.transform(vector, lambda x: x.cast("double") / length))


def cosine_top(asked: DataFrame, query: str, question: str, items: DataFrame, item: str, vector: str, k: int) -> DataFrame:
    """``(query, item, cosine, rank)``: exact search of a bounded set of queries against all items.

    The queries must be few; their number is checked and they are sent to every task, where they are
    compared with the items as they are scanned; each task keeps its own best before the exchange.
    """
    n = asked.limit(10_001).count()
    if n > 10_000:
        raise ValueError("exact search takes at most 10,000 queries; use the graph index for more")
    few = F.broadcast(asked.select(query, unit(F.col(question)).alias("_q")).filter("_q is not null"))
    rows = items.select(item, unit(F.col(vector)).alias("_v")).filter("_v is not null")
    scored = rows.join(few, F.size("_v") == F.size("_q")).select(query, item, dot(F.col("_q"), F.col("_v")).alias("cosine"))
    return top_ranked(scored.withColumn("cosine", F.round("cosine", 6)), query, item, "cosine", k)
