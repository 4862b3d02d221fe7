"""Canonical entities and relationships from many mentions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryweave.functions.keys import entity_key_udf, letters_udf

#: Distinct values kept of what every mention adds, descriptions joined, characters of the joined text (fixed values).
FIRST_VALUES, DESCRIPTIONS, DESCRIPTION_LENGTH = 32, 3, 2000


#: Types by preference, for entities that several types name equally often (fixed values).
TYPE_PRIORITY = ["Material", "Structure", "Process", "ProcessCondition", "Property", "TestMethod", "Mechanism", "Equipment", "Application", "Standard", "Organization", "Data", "Concept", "Other"]


def folded(text: Column) -> Column:
    """Lower case in which a sharp s is two."""
    return F.lower(F.replace(text, F.lit("ß"), F.lit("ss")))


def most_common(rows: DataFrame, key: str, value: str, name: str, *ties: Column) -> DataFrame:
    """``(key, name)``: the most frequent value of each key, of equal ones the first by ``ties`` (the longest where none are given), then the smallest."""
    counts = rows.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    order = [x.alias(f"t{i}") for i, x in enumerate(ties or (-F.length(value), folded(F.col(value))))]
    best = counts.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("n"), *order, F.col(value).alias("v"))).alias("best"))
    return best.select(key, F.col("best.v").alias(name))


def type_rank(kind: Column) -> Column:
    """Place of a type in the order of preference, unknown ones last."""
    place = F.array_position(F.array(*map(F.lit, TYPE_PRIORITY)), kind)
    return F.when(place > 0, place).otherwise(F.lit(len(TYPE_PRIORITY) + 1))


def first_values(rows: DataFrame, key: str, value: str, order: str, name: str, most: int = FIRST_VALUES) -> DataFrame:
    """``(key, name)``: the first ``most`` distinct values of each key in order of appearance."""
    seen = rows.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.min(order).alias("at"))
    ranked = seen.withColumn("r", F.row_number().over(Window.partitionBy(key).orderBy("at", value))).filter(F.col("r") <= most)
    return ranked.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("r", F.col(value).alias("v")))).alias("x")).select(key, F.transform("x", lambda x: x["v"]).alias(name))


def joined_descriptions(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``(key, name)``: the most frequent descriptions, then the longest, joined by a wide semicolon and cut."""
    counts = rows.filter(F.trim(F.col(value)) != "").groupBy(key, value).agg(F.count("*").alias("n"))
    window = Window.partitionBy(key).orderBy(F.desc("n"), F.desc(F.length(value)), folded(F.col(value)), F.asc(value))
    top = counts.withColumn("r", F.row_number().over(window)).filter(F.col("r") <= DESCRIPTIONS)
    lists = top.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("r", F.col(value).alias("v")))).alias("x"))
    return lists.select(key, F.substring(F.array_join(F.transform("x", lambda x: x["v"]), "；"), 1, DESCRIPTION_LENGTH).alias(name))


def canonical_entities(rows: DataFrame, key: str, name: str, kind: str, description: str, source: str, order: str) -> DataFrame:
    """One row for each key: mentions, display name, type, joined descriptions, first sources."""
    keyed = rows.filter(F.col(key).isNotNull())
    out = keyed.groupBy(key).agg(F.count("*").alias("mentions"))
    for part in (most_common(keyed, key, name, "display_name"), most_common(keyed, key, kind, "entity_type", type_rank(F.col(kind))), joined_descriptions(keyed, key, description, "description"), first_values(keyed, key, source, order, "sources")):
        out = out.join(part, key, "left")
    return out


def canonical_relationships(rows: DataFrame, left: str, right: str, description: str) -> DataFrame:
    """One row for each unordered pair of different keys: mentions, weight, distinct descriptions."""
    kept = rows.filter(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right)))
    pairs = kept.groupBy(F.least(left, right).alias("source_key"), F.greatest(left, right).alias("target_key"))
    return pairs.agg(F.count("*").alias("mentions"), F.count_distinct(description).alias("descriptions")).withColumn("weight", F.bround(1 + F.log1p(F.col("mentions")), 6))


def merge_aliases(rows: DataFrame, key: str, name: str, fixed: list[str]) -> DataFrame:
    """``(key, aliases, drifts)``: sorted distinct names of each key, and in how many fixed fields its rows disagree."""
    drift = sum((F.when(F.count_distinct(f) > 1, 1).otherwise(0) for f in fixed), F.lit(0))
    return rows.groupBy(key).agg(F.array_sort(F.collect_set(name)).alias("aliases"), drift.alias("drifts"))


def pair_id(left: Column, right: Column) -> Column:
    """MD5 of the two names in order, without a separator."""
    return F.md5(F.concat(F.least(left, right), F.greatest(left, right)))


def pair_collisions(rows: DataFrame, left: str, right: str) -> DataFrame:
    """``(source_key, target_key, pair, concat_collision, reverse_collision)`` of pairs whose joined names collide."""
    pairs = rows.filter(F.col(left).isNotNull() & F.col(right).isNotNull()).select(F.least(left, right).alias("source_key"), F.greatest(left, right).alias("target_key")).distinct()
    pairs = pairs.withColumn("pair", F.md5(F.concat("source_key", "target_key"))).withColumn("reverse", F.md5(F.concat("target_key", "source_key")))
    shared = pairs.groupBy("pair").agg(F.count("*").alias("n"))
    reversed_ = pairs.filter("pair <> reverse").select(F.col("reverse").alias("pair"), F.lit(True).alias("is_reverse")).distinct()
    out = pairs.join(shared, "pair").join(reversed_, "pair", "left").select("source_key", "target_key", "pair", (F.col("n") > 1).alias("concat_collision"), F.coalesce("is_reverse", F.lit(False)).alias("reverse_collision"))
    return out.filter("concat_collision or reverse_collision")


def supported_mentions(entities: DataFrame, row: str, name: str, description: str, fragment: str, fragments: DataFrame, fragment_id: str, text: str) -> DataFrame:
    """``(row, fragment, key, outcome)``: whether the fragment that an entity row cites holds its name.

    Outcome: ``unknown_fragment`` where no such fragment is, ``incomplete`` without a name or a
    description, ``not_in_source`` where the letters and digits of the name are not found in those of
    any text of the fragment, else ``kept``.
    """
    named = entities.select(F.col(row).alias("row"), F.col(fragment).alias("fragment"), F.col(name).alias("name"), (F.trim(F.coalesce(F.col(description), F.lit(""))) == "").alias("bare"))
    named = named.withColumn("key", entity_key_udf("name")).withColumn("compact", letters_udf("name"))
    texts = fragments.filter(F.col(fragment_id).isNotNull()).select(F.col(fragment_id).alias("fragment"), letters_udf(F.coalesce(F.col(text), F.lit(""))).alias("letters")).distinct()
    met = named.join(texts, "fragment", "left")
    incomplete = F.col("key").isNull() | (F.col("key") == "") | F.col("bare")
    outcome = F.when(F.col("letters").isNull(), 1).when(incomplete, 2).when((F.col("compact") == "") | ~F.contains("letters", "compact"), 3).otherwise(4)
    judged = met.select("row", "fragment", "key", outcome.alias("o")).groupBy("row", "fragment", "key").agg(F.max("o").alias("o"))
    return judged.select("row", "fragment", "key", F.element_at(F.array(*map(F.lit, ("unknown_fragment", "incomplete", "not_in_source", "kept"))), F.col("o")).alias("outcome"))


def local_relationships(relationships: DataFrame, row: str, left: str, right: str, description: str, fragment: str, kept: DataFrame) -> DataFrame:
    """``(row, source_key, target_key, outcome)``: relationship rows whose ends are entities kept in the same fragment.

    ``kept(fragment, key)``.  Outcome: ``no_source``, ``no_target``, ``self``, ``incomplete`` without a
    description, else ``kept``.
    """
    local = kept.select("fragment", "key").distinct()
    rows = relationships.select(F.col(row).alias("row"), F.col(fragment).alias("fragment"), entity_key_udf(left).alias("source_key"), entity_key_udf(right).alias("target_key"), F.col(description).alias("about"))
    met = rows.join(local.select("fragment", F.col("key").alias("source_key"), F.lit(True).alias("has_source")), ["fragment", "source_key"], "left").join(local.select("fragment", F.col("key").alias("target_key"), F.lit(True).alias("has_target")), ["fragment", "target_key"], "left")
    outcome = F.when(F.col("has_source").isNull(), "no_source").when(F.col("has_target").isNull(), "no_target").when(F.col("source_key") == F.col("target_key"), "self").when(F.trim(F.coalesce("about", F.lit(""))) == "", "incomplete").otherwise("kept")
    return met.select("row", "source_key", "target_key", outcome.alias("outcome"))
