"""Queries on references to records that do not exist."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryweave.operators.orphans import orphan_counts, orphan_references
from quarryweave.plans import read_table

RELATIONSHIPS, FRAGMENTS, ENTITIES = "custom_kg_relationships", "evidence_fragments", "custom_kg_entities"


def _children_and_parents(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rels = read_table(spark, folder, RELATIONSHIPS).select("rel_no", "created_at", F.explode(F.array(*(F.struct(F.lit(c).alias("f"), F.col(c).alias("k")) for c in ("src_id", "tgt_id")))).alias("x"))
    rels = rels.select(F.lit(RELATIONSHIPS).alias("ref_table"), F.col("x.f").alias("ref_field"), F.col("rel_no").alias("ref_row"), F.col("x.k").alias("ref_key"), F.lit("name").alias("parent_table"), F.col("created_at").alias("at"))
    frags = read_table(spark, folder, FRAGMENTS).select("fragment_no", "created_at", F.explode("supported_entity_ids").alias("k"))
    frags = frags.select(F.lit(FRAGMENTS).alias("ref_table"), F.lit("supported_entity_ids").alias("ref_field"), F.col("fragment_no").alias("ref_row"), F.col("k").alias("ref_key"), F.lit("id").alias("parent_table"), F.col("created_at").alias("at"))
    ents = read_table(spark, folder, ENTITIES).select("created_at", "deleted_at", F.explode(F.array(F.struct(F.lit("name").alias("p"), F.col("entity_name").alias("k")), F.struct(F.lit("id").alias("p"), F.col("entity_id").alias("k")))).alias("x"))
    ents = ents.select(F.col("x.p").alias("parent_table"), F.col("x.k").alias("key"), F.col("created_at").alias("born"), F.col("deleted_at").alias("died"))
    return rels.unionByName(frags), ents


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return orphan_references(*_children_and_parents(spark, folder)).drop("at")


def p2_counts(spark: SparkSession, folder: str) -> DataFrame:
    return orphan_counts(orphan_references(*_children_and_parents(spark, folder)))


_WIDE = "".join(chr(0xFF01 + i) for i in range(94))
_NARROW = "".join(chr(0x21 + i) for i in range(94)).replace("'", "''")


def _normal(c: str) -> str:
    """SQL of a normal name for what the tables hold: wide forms, white space, straight quotes."""
    plain = f"trim(regexp_replace(translate({c}, '{_WIDE}', '{_NARROW}'), '[\\s\u3000]+', ' ', 'g'))"
    return f"(SELECT lower(CASE WHEN length(k) > 1 AND left(k, 1) IN ('\"', '\'\'') AND left(k, 1) = right(k, 1) THEN trim(substr(k, 2, length(k) - 2)) ELSE k END) FROM (SELECT {plain} AS k))"


_REFS = f"""WITH raw AS (
  SELECT 'custom_kg_relationships' AS ref_table, 'src_id' AS ref_field, rel_no AS ref_row, src_id AS ref_key, 'name' AS parent, created_at AS made_at FROM custom_kg_relationships
  UNION ALL SELECT 'custom_kg_relationships', 'tgt_id', rel_no, tgt_id, 'name', created_at FROM custom_kg_relationships
  UNION ALL SELECT 'evidence_fragments', 'supported_entity_ids', fragment_no, unnest(supported_entity_ids), 'id', created_at FROM evidence_fragments
), refs AS (SELECT DISTINCT *, {_normal("ref_key")} AS key FROM raw WHERE ref_key IS NOT NULL
), ents AS (SELECT 'name' AS parent, {_normal("entity_name")} AS key, created_at, deleted_at FROM custom_kg_entities WHERE entity_name IS NOT NULL
  UNION ALL SELECT 'id', {_normal("entity_id")}, created_at, deleted_at FROM custom_kg_entities WHERE entity_id IS NOT NULL
), judged AS (
  SELECT ref_table, ref_field, ref_row, ref_key, made_at, count(e.key) AS parents, count(*) FILTER (e.created_at <= made_at) AS born, count(*) FILTER (e.created_at <= made_at AND (e.deleted_at IS NULL OR made_at < e.deleted_at)) AS live
  FROM refs LEFT JOIN ents e ON e.parent = refs.parent AND e.key = refs.key GROUP BY ALL
), orphans AS (SELECT *, CASE WHEN parents = 0 THEN 'missing' WHEN born = 0 THEN 'late' ELSE 'deleted' END AS reason FROM judged WHERE live = 0)
"""

ORACLE_SQL = {
    "p2_found": _REFS + "SELECT ref_table, ref_field, ref_row, ref_key, reason FROM orphans",
    "p2_counts": _REFS + "SELECT ref_table, ref_field, strftime(made_at, '%Y-%m') AS month, reason, count(*) AS orphans FROM orphans GROUP BY 1, 2, 3, 4",
}
QUERIES = {"p2_found": p2_found, "p2_counts": p2_counts}
