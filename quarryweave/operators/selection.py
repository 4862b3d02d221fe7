"""Choosing sources for a gap in the evidence: what is out, what is a copy, what fits the budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryweave.operators.retrieval import lexical_counts
from quarryweave.operators.texts import search_tokens
from quarryweave.plans import materialise

#: Titles that say nothing, and metadata whose text does (fixed values).
PLACEHOLDER_TITLES = ["unknown", "unknown source", "untitled", "n/a", "none", "未知来源", "未命名"]
TEXT_METADATA = ["abstract", "keywords", "keyword", "authors", "journal", "venue", "assignee", "patentee", "ipc", "category", "material_categories", "top_categories"]
#: Names under which a number of pages stands, its greatest value, and what an unknown number counts as (fixed values).
PAGE_NAMES, MOST_PAGES, UNKNOWN_PAGES = ["page_count", "pages", "pdf_page_count"], 100_000, 100


def search_text(title: Column, kind: Column, doi: Column, metadata: Column) -> Column:
    """What a source is searched by: title, kind, DOI and the texts of its metadata, in this order."""
    return F.concat_ws(" ", title, kind, doi, *(metadata[k] for k in TEXT_METADATA))


def page_count(metadata: Column) -> Column:
    """The first number of pages that metadata names, if it is possible, else a careful guess."""
    named = F.coalesce(*(metadata[k] for k in PAGE_NAMES)).try_cast("int")
    return F.when(named.between(1, MOST_PAGES), named).otherwise(F.lit(UNKNOWN_PAGES))


def sufficient(title: Column, doi: Column, metadata: Column) -> Column:
    """Whether a source can be judged: a title that says something, an identifier, or a text in its metadata."""
    plain = F.lower(F.trim(F.coalesce(title, F.lit(""))))
    texts = [F.coalesce(F.trim(metadata[k]) != "", F.lit(False)) for k in TEXT_METADATA]
    return ((plain != "") & ~plain.isin(*PLACEHOLDER_TITLES)) | doi.isNotNull() | F.greatest(*texts)


def rejections(sources: DataFrame, done: list[str], failed: list[str], primary: str) -> DataFrame:
    """Each ``source`` once, with ``reason`` (null: it may be chosen), its ``tokens``, ``pages`` and ``later`` (not of the primary root).

    ``sources(source, root, path, title, kind, doi, digest, canonical, status, metadata)``.  A source
    sent again counts as the row with most to search, then the primary root's.  ``duplicate``: it
    points to another source, its state is one of ``done``, its content is that of a source in such a
    state, or another source of the same content is preferred.  ``insufficient_metadata``: its state is
    one of ``failed``, or nothing tells what it is about.
    """
    rows = sources.withColumn("tokens", search_tokens(search_text(F.col("title"), F.col("kind"), F.col("doi"), F.col("metadata")))).withColumn("later", F.when(F.col("root") == primary, 0).otherwise(1))
    best = F.struct((-F.size("tokens")).alias("n"), "later", "source")
    wide = F.struct("digest", "title", "doi", "canonical", "status", "metadata", "tokens", "later")
    once = rows.filter("source is not null").groupBy("source").agg(F.min_by(wide, F.struct(best.alias("b"), "digest", "title", "doi", "canonical", "status", F.to_json("metadata").alias("m"))).alias("r")).select("source", "r.*")
    hard = F.when(F.col("canonical").isNotNull() | F.col("status").isin(*done), "duplicate").when(F.col("status").isin(*failed), "insufficient_metadata")
    once = materialise(once.withColumn("hard", hard), "sources")
    # contents of finished sources, and the preferred one of each other content
    finished = once.filter(F.col("hard").isNotNull() & F.col("status").isin(*done) & F.col("digest").isNotNull()).select("digest").distinct().withColumn("taken", F.lit(True))
    chosen = once.filter("hard is null and digest is not null").groupBy("digest").agg(F.min(best).alias("b")).select("digest", F.col("b.source").alias("chosen"))
    met = once.join(finished, "digest", "left").join(chosen, "digest", "left")
    copy = F.col("taken").isNotNull() | (F.col("digest").isNotNull() & (F.col("chosen") != F.col("source")))
    reason = F.when(F.col("hard").isNotNull(), F.col("hard")).when(F.coalesce(copy, F.lit(False)), "duplicate").when(~sufficient(F.col("title"), F.col("doi"), F.col("metadata")), "insufficient_metadata")
    return met.select("source", reason.alias("reason"), "tokens", page_count(F.col("metadata")).alias("pages"), "later")


def select_for_gap(judged: DataFrame, gap: str, most: int = 20, budget: int = 2_000) -> DataFrame:
    """``(source, rank, pages, selected, reason)``: candidates by how often they name the gap's words, taken while number and pages last.

    One too long is passed over and shorter ones after it may still fit.  Reason: ``active_evidence_gap``
    for the chosen, ``budget_deferred`` for other candidates, else why it was rejected (rank null).
    """
    spark = judged.sparkSession
    judged = materialise(judged, "judged")
    asked = spark.range(1).select(F.explode(search_tokens(F.lit(gap))).alias("word")).groupBy("word").agg(F.count("*").alias("q"))
    scores = lexical_counts(judged.filter("reason is null"), "source", "tokens", asked)
    ranked = judged.filter("reason is null").join(scores, "source", "left").select("source", "pages", "later", F.coalesce("score", F.lit(0)).alias("score"))
    order = [F.desc("score"), F.asc("later"), F.asc("source")]
    # each step takes what fits of the next candidates that are short enough: at most ``most`` steps of as many rows
    taken: list[str] = []
    left, rest = budget, ranked
    while len(taken) < most:
        ahead = rest.filter(F.col("pages") <= left).orderBy(*order).limit(most - len(taken)).collect()
        if not ahead:
            break
        for row in ahead:
            if row["pages"] > left:
                break
            taken.append(row["source"])
            left, last = left - row["pages"], row
        after = (F.col("score") < last["score"]) | ((F.col("score") == last["score"]) & ((F.col("later") > last["later"]) | ((F.col("later") == last["later"]) & (F.col("source") > last["source"]))))
        rest = ranked.filter(after)
    chosen = F.col("source").isin(*taken) if taken else F.lit(False)
    parts = materialise(ranked.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranked")
    numbered = _numbered(parts, order).select("source", "rank", "pages", chosen.alias("selected"), F.when(chosen, "active_evidence_gap").otherwise("budget_deferred").alias("reason"))
    out = judged.filter("reason is not null").select("source", F.lit(None).cast("long").alias("rank"), "pages", F.lit(False).alias("selected"), "reason")
    return numbered.unionByName(out)


def _numbered(parts: DataFrame, order: list[Column]) -> DataFrame:
    """Ranks from 1 over a range partitioning: rows of the parts before, then within the part."""
    before = parts.groupBy("part").agg(F.count("*").alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return parts.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy(*order))).join(before, "part").withColumn("rank", (F.col("place") + F.col("offset")).cast("long"))
