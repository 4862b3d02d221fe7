"""Queries on projected facts, reuse of vectors, quality of rankings, lines of markdown, coverage."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarryweave.operators import projection as P
from quarryweave.operators import retrieval as R
from quarryweave.plans import read_table

_TERMS = ["annealing", "spectroscopy", "porosity", "tensile", "degassing"]


def fact_nodes(spark, folder):
    return P.fact_nodes(read_table(spark, folder, "custom_kg_relationships"), "rel_no", "src_id", "tgt_id", "source_id")


def fact_edges(spark, folder):
    return P.fact_edges(read_table(spark, folder, "custom_kg_relationships"), "rel_no", "src_id", "tgt_id", "source_id")


def vector_backlog(spark, folder):
    return P.missing_vectors(read_table(spark, folder, "evidence_fragments"), "content_sha256", read_table(spark, folder, "vectors"), "content_sha256")


def label_quality(spark, folder):
    """How well the five nearest embeddings of a query share its label."""
    rows = read_table(spark, folder, "embeddings")
    top = R.cosine_top(rows.filter("vec_id % 20 = 0"), "vec_id", "embedding", rows.select(F.col("vec_id").alias("item"), "embedding"), "item", "embedding", 6).filter("vec_id <> item")
    labels = rows.select("vec_id", "label")
    counted = labels.groupBy("label").agg((F.count("*") - 1).alias("wanted"))
    asked = labels.join(counted, "label").select("vec_id", F.col("label").alias("asked"), "wanted")
    rank = F.row_number().over(Window.partitionBy("vec_id").orderBy(F.desc("cosine"), "item"))
    judged = top.withColumn("place", rank).join(labels.select(F.col("vec_id").alias("item"), "label"), "item").join(asked.select("vec_id", "asked"), "vec_id")
    return P.ranking_quality(judged, "vec_id", "place", F.col("label") == F.col("asked"), asked.select("vec_id", "wanted"), "wanted", 5)


def markdown_kinds(spark, folder):
    rows = read_table(spark, folder, "textbook_sources").select("scan_no", F.explode(P.markdown_lines(F.col("text"))).alias("x"))
    return rows.groupBy(F.col("x.kind").alias("kind"), F.col("x.level").alias("level")).agg(F.count("*").alias("lines"), F.count_distinct("scan_no").alias("texts"))


def keyword_matches(spark, folder):
    low = F.lower("text")
    hits = sum((F.when(F.contains(low, F.lit(t)), 1).otherwise(0) for t in _TERMS), F.lit(0))
    rows = read_table(spark, folder, "documents").select("doc_id", F.coalesce(hits, F.lit(0)).cast("int").alias("matched"))
    return rows.filter("matched >= 2").withColumn("share", F.round(F.col("matched") / len(_TERMS), 4))


def coverage_gaps(spark, folder):
    """Source ids that one table names and the catalog lacks."""
    known = read_table(spark, folder, "source_catalog").select("source_id").distinct()
    parts = [read_table(spark, folder, t).select(F.lit(t).alias("table_name"), "source_id") for t in ("evidence_fragments", "mineru_blocks", "textbook_sources")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).filter("source_id is not null").join(known, "source_id", "left_anti").groupBy("table_name").agg(F.count("*").alias("rows"), F.count_distinct("source_id").alias("sources"))


def public_uris(spark, folder):
    rows = read_table(spark, folder, "evidence_fragments").select("fragment_no", "source_id", F.col("locator.page").alias("page"), F.col("locator.block_index").alias("block"))
    query = F.concat_ws("&", F.concat(F.lit("page="), F.col("page").cast("string")), F.concat(F.lit("block="), F.col("block").cast("string")))
    return rows.select("fragment_no", F.concat(F.lit("source://"), F.coalesce("source_id", F.lit("")), F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")).alias("uri"))


def late_arrivals(spark, folder):
    """Rows that came more than a day after they were made, by table and month of making."""
    tables = {"evidence_fragments": "created_at", "custom_kg_entities": "created_at", "custom_kg_relationships": "created_at", "source_relations": "recorded_at"}
    parts = [read_table(spark, folder, t).select(F.lit(t).alias("table_name"), F.col(c).alias("made_at"), "loaded_at") for t, c in tables.items()]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    late = F.col("loaded_at") > F.col("made_at") + F.expr("interval 1 day")
    return rows.groupBy("table_name", F.date_format("made_at", "yyyy-MM").alias("month")).agg(F.count("*").alias("rows"), F.sum(F.when(late, 1).otherwise(0)).cast("long").alias("late"))


_LATE = " UNION ALL ".join(f"SELECT '{t}' AS table_name, {c} AS made_at, loaded_at FROM {t}" for t, c in {"evidence_fragments": "created_at", "custom_kg_entities": "created_at", "custom_kg_relationships": "created_at", "source_relations": "recorded_at"}.items())
_HITS = " + ".join(f"CASE WHEN contains(lower(text), '{t}') THEN 1 ELSE 0 END" for t in _TERMS)
ORACLE_SQL = {
    "fact_nodes": "SELECT DISTINCT 'entity:' || sha256(x) AS node_id, 'Entity' AS label FROM (SELECT src_id AS x FROM custom_kg_relationships UNION ALL SELECT tgt_id FROM custom_kg_relationships) WHERE x IS NOT NULL UNION ALL SELECT DISTINCT 'assertion:' || rel_no, 'Assertion' FROM custom_kg_relationships UNION ALL SELECT DISTINCT 'evidence:' || source_id, 'Evidence' FROM custom_kg_relationships WHERE source_id IS NOT NULL",
    "fact_edges": "SELECT DISTINCT * FROM (SELECT 'entity:' || sha256(src_id) AS source, 'assertion:' || rel_no AS target, 'ASSERTION_SUBJECT' AS kind FROM custom_kg_relationships UNION ALL SELECT 'assertion:' || rel_no, 'entity:' || sha256(tgt_id), 'ASSERTION_OBJECT' FROM custom_kg_relationships UNION ALL SELECT 'assertion:' || rel_no, 'evidence:' || source_id, 'SUPPORTED_BY' FROM custom_kg_relationships) WHERE source IS NOT NULL AND target IS NOT NULL",
    "vector_backlog": "SELECT content_sha256, count(*) AS items FROM evidence_fragments WHERE content_sha256 IS NOT NULL AND content_sha256 NOT IN (SELECT content_sha256 FROM vectors WHERE content_sha256 IS NOT NULL) GROUP BY 1",
    "label_quality": "WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), s AS (SELECT a.vec_id, a.label AS asked, b.vec_id AS item, b.label, round(list_cosine_similarity(a.v, b.v), 6) AS cosine FROM e a JOIN e b ON a.vec_id % 20 = 0 QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(a.v, b.v), 6) DESC, b.vec_id) <= 6), t AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, item) AS place FROM s WHERE vec_id <> item), w AS (SELECT label AS asked, count(*) - 1 AS wanted FROM embeddings GROUP BY 1), g AS (SELECT vec_id, asked, CAST(count(*) FILTER (label = asked) AS BIGINT) AS hits, sum(CASE WHEN label = asked THEN 1.0 / log2(place + 1.0) ELSE 0.0 END) AS gain FROM t WHERE place <= 5 GROUP BY 1, 2) SELECT vec_id, hits, round(hits / CAST(least(wanted, 5) AS DOUBLE), 6) AS recall, round(gain / list_sum(list_transform(range(1, least(wanted, 5) + 1), lambda i: 1.0 / log2(i + 1.0))), 6) AS ndcg FROM g JOIN w USING (asked) WHERE wanted > 0",
    "markdown_kinds": r"WITH l AS (SELECT scan_no, trim(unnest(string_split(replace(text, chr(13), ''), chr(10)))) AS x FROM textbook_sources WHERE text IS NOT NULL) SELECT CASE WHEN regexp_matches(x, '^#{1,6}\s') THEN 'heading' WHEN regexp_matches(x, '^\|') THEN 'table' WHEN regexp_matches(x, '^([-*•]|\d+[.)])\s') THEN 'list' WHEN regexp_matches(x, '^!\[') THEN 'image' WHEN regexp_matches(x, '^(-{3,}|\*{3,}|={3,})$') THEN 'rule' ELSE 'paragraph' END AS kind, CAST(length(regexp_extract(x, '^(#*)', 1)) AS INT) AS level, count(*) AS lines, count(DISTINCT scan_no) AS texts FROM l WHERE x <> '' GROUP BY 1, 2",
    "keyword_matches": f"SELECT doc_id, matched, round(matched / CAST({len(_TERMS)} AS DOUBLE), 4) AS share FROM (SELECT doc_id, CAST({_HITS} AS INT) AS matched FROM documents) WHERE matched >= 2",
    "coverage_gaps": "SELECT table_name, count(*) AS rows, count(DISTINCT source_id) AS sources FROM (SELECT 'evidence_fragments' AS table_name, source_id FROM evidence_fragments UNION ALL SELECT 'mineru_blocks', source_id FROM mineru_blocks UNION ALL SELECT 'textbook_sources', source_id FROM textbook_sources) WHERE source_id IS NOT NULL AND source_id NOT IN (SELECT source_id FROM source_catalog WHERE source_id IS NOT NULL) GROUP BY 1",
    "public_uris": "SELECT fragment_no, 'source://' || coalesce(source_id, '') || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS uri FROM (SELECT fragment_no, source_id, concat_ws('&', 'page=' || locator.page, 'block=' || locator.block_index) AS q FROM evidence_fragments)",
    "late_arrivals": f"SELECT table_name, strftime(made_at, '%Y-%m') AS month, count(*) AS rows, count(*) FILTER (loaded_at > made_at + INTERVAL 1 DAY) AS late FROM ({_LATE}) GROUP BY 1, 2",
}
QUERIES = {f.__name__: f for f in (fact_nodes, fact_edges, vector_backlog, label_quality, markdown_kinds, keyword_matches, coverage_gaps, public_uris, late_arrivals)}
