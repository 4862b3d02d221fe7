"""Facts as a property graph, reuse of vectors, quality of rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fact_nodes(relations: DataFrame, row: str, left: str, right: str, evidence: str) -> DataFrame:
    """``(node_id, label)``: an entity for each name, an assertion for each row, an evidence for each fragment, each once."""
    entity = relations.select(F.explode(F.array(left, right)).alias("x")).filter("x is not null").select(F.concat(F.lit("entity:"), F.sha2("x", 256)).alias("node_id"), F.lit("Entity").alias("label"))
    fact = relations.select(F.concat(F.lit("assertion:"), F.col(row).cast("string")).alias("node_id"), F.lit("Assertion").alias("label"))
    source = relations.filter(F.col(evidence).isNotNull()).select(F.concat(F.lit("evidence:"), F.col(evidence)).alias("node_id"), F.lit("Evidence").alias("label"))
    return entity.unionByName(fact).unionByName(source).distinct()


def fact_edges(relations: DataFrame, row: str, left: str, right: str, evidence: str) -> DataFrame:
    """``(source, target, kind)``: subject to assertion, assertion to object, assertion to evidence; null ends have no edge."""
    fact = F.concat(F.lit("assertion:"), F.col(row).cast("string"))
    entity = lambda c: F.concat(F.lit("entity:"), F.sha2(F.col(c), 256))
    edges = F.array(
        F.struct(entity(left).alias("source"), fact.alias("target"), F.lit("ASSERTION_SUBJECT").alias("kind")),
        F.struct(fact.alias("source"), entity(right).alias("target"), F.lit("ASSERTION_OBJECT").alias("kind")),
        F.struct(fact.alias("source"), F.concat(F.lit("evidence:"), F.col(evidence)).alias("target"), F.lit("SUPPORTED_BY").alias("kind")),
    )
    return relations.select(F.explode(edges).alias("e")).select("e.*").filter("source is not null and target is not null").distinct()


def missing_vectors(items: DataFrame, digest: str, vectors: DataFrame, vector_digest: str) -> DataFrame:
    """``(digest, items)``: contents of items that no vector has, with how many items need each."""
    known = vectors.select(F.col(vector_digest).alias(digest)).distinct()
    return items.filter(F.col(digest).isNotNull()).join(known, digest, "left_anti").groupBy(digest).agg(F.count("*").alias("items"))


def ranking_quality(ranked: DataFrame, group: str, rank: str, relevant: Column, wanted: DataFrame, wanted_count: str, k: int) -> DataFrame:
    """``(group, hits, recall, ndcg)`` of the first ``k``: found of the wanted, and discounted gain against the best order."""
    gain = F.when(relevant, 1.0 / F.log2(F.col(rank) + 1.0)).otherwise(0.0)
    found = ranked.filter(F.col(rank) <= k).groupBy(group).agg(F.sum(F.when(relevant, 1).otherwise(0)).cast("long").alias("hits"), F.sum(gain).alias("gain"))
    best = F.aggregate(F.sequence(F.lit(1), F.least(F.col(wanted_count), F.lit(k)).cast("int")), F.lit(0.0), lambda s, i: s + 1.0 / F.log2(i + 1.0))
    both = found.join(wanted, group).filter(F.col(wanted_count) > 0)
    return both.select(group, "hits", F.round(F.col("hits") / F.least(F.col(wanted_count), F.lit(k)), 6).alias("recall"), F.round(F.col("gain") / best, 6).alias("ndcg"))


def markdown_lines(text: Column) -> Column:
    """``array<struct<n, kind, level, text>>`` of the lines that hold something: heading, table, list, image, rule or paragraph."""
    lines = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "\r", ""), "\n")

    def line(x: Column, n: Column) -> Column:
        plain = F.trim(x)
        kind = F.when(plain.rlike(r"^#{1,6}\s"), "heading").when(plain.rlike(r"^\|"), "table").when(plain.rlike(r"^([-*•]|\d+[.)])\s"), "list").when(plain.rlike(r"^!\["), "image").when(plain.rlike(r"^(-{3,}|\*{3,}|={3,})$"), "rule").otherwise("paragraph")
        return F.struct(n.cast("int").alias("n"), kind.alias("kind"), F.length(F.regexp_extract(plain, r"^(#*)", 1)).alias("level"), plain.alias("text"))

    return F.filter(F.transform(lines, line), lambda x: x["text"] != "")
