"""Registered queries of the operators for training-data corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryweave.functions.dois import doi_key
from quarryweave.functions.keys import canonical_uuid
from quarryweave.llm.encoding import encode_corpus, token_counts
from quarryweave.llm.grouping import consolidate
from quarryweave.llm.near_duplicates import all_pairs, near_duplicates
from quarryweave.llm.neighbours import most_similar
from quarryweave.llm.oracle import ORACLE_SQL  # noqa: F401
from quarryweave.llm.packing import pack
from quarryweave.llm.scan_noise import find_noise, paragraphs
from quarryweave.llm.splitting import split_oversized
from quarryweave.llm.survivors import surviving_values
from quarryweave.llm.truncation import judge_ends, truncation_rates
from quarryweave.plans import materialise, read_table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return find_noise(read_table(spark, folder, "mineru_blocks"))["noise"].withColumnRenamed("row", "block_no")


def p1_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    return paragraphs(read_table(spark, folder, "mineru_blocks")).withColumnRenamed("task", "task_id")


def p3_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return split_oversized(read_table(spark, folder, "textbook_sources"), "scan_no", "text", "source_family", read_table(spark, folder, "size_limits").filter("unit = 'bytes'"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return p3_pieces(spark, folder).filter("piece_no = 1").select("scan_no")


#: Fields of a surviving record.
RECORD_FIELDS = ("source_id", "root_id", "relative_path", "source_kind", "display_title", "status", "directory_year", "normalized_doi", "legal_status", "sha256", "byte_size")


def _catalog_groups(spark: SparkSession, folder: str, fields: tuple[str, ...]) -> DataFrame:
    """Catalog rows with so many of their fields, the number of their source: the smallest record_no of all rows of one source, and their root's trust."""
    rows = read_table(spark, folder, "source_catalog").select(
        "record_no", "observed_at", *dict.fromkeys(["root_id", *fields]),
        F.coalesce(canonical_uuid(F.col("source_id")), F.concat(F.lit("row "), F.col("record_no").cast("string"))).alias("source"),
        canonical_uuid(F.col("canonical_source_id")).alias("canonical"),
        doi_key(F.col("normalized_doi")).alias("doi"),
    )
    rows = materialise(rows, "catalog")
    known = rows.select(F.col("source").alias("canonical")).distinct()
    to_source = rows.filter("canonical is not null").join(known, "canonical", "left_semi").select(F.col("source").alias("a"), F.col("canonical").alias("b"))
    to_work = rows.filter("doi is not null").select(F.col("source").alias("a"), F.concat(F.lit("doi "), "doi").alias("b"))
    groups = consolidate(rows.select(F.col("source").alias("a"), F.col("source").alias("b")).unionByName(to_source).unionByName(to_work), "a", "b")
    ranks = read_table(spark, folder, "root_ranks").groupBy("root_id").agg(F.min("trust_rank").alias("trust_rank"))
    rows = materialise(rows.drop("canonical").join(groups.withColumnRenamed("id", "source"), "source").join(ranks, "root_id", "left"), "grouped")
    numbers = rows.groupBy("group_id").agg(F.min("record_no").alias("group_no"), F.count("*").alias("n_rows"))
    return rows.join(numbers, "group_id")


def _usable(field: str) -> Column:
    """Whether a row has a value of a field that may survive: not null, blank or ``unknown``, a size above 0, a DOI that is none of the placeholders."""
    if field == "normalized_doi":
        return F.col("doi").isNotNull()
    if field in ("byte_size", "directory_year"):
        return F.col(field) >= 1
    text = F.lower(F.trim(F.regexp_replace(field, r"(?U)\s+", " ")))
    return text.isNotNull() & ~text.isin("", "unknown")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    fields = ("normalized_doi", "byte_size", "legal_status")
    rows = _catalog_groups(spark, folder, fields).filter("n_rows > 1")
    return surviving_values(rows, "group_no", "record_no", "trust_rank", "observed_at", {f: _usable(f) for f in fields})


def p4_survivors(spark: SparkSession, folder: str) -> DataFrame:
    """One surviving record for each source, each field from the row that keeps it; null where no row has a usable value."""
    rows = materialise(_catalog_groups(spark, folder, RECORD_FIELDS), "numbered")
    kept = surviving_values(rows, "group_no", "record_no", "trust_rank", "observed_at", {f: _usable(f) for f in RECORD_FIELDS})
    # a row keeps as many fields as there are at most
    kept = kept.groupBy("group_no", "record_no").agg(F.collect_set("field_name").alias("fields"))
    value = {f: F.col("doi") if f == "normalized_doi" else F.col(f) for f in RECORD_FIELDS}
    chosen = kept.join(rows.select("record_no", *(v.alias(f) for f, v in value.items())), "record_no")
    picked = chosen.groupBy("group_no").agg(*(F.max(F.when(F.array_contains("fields", f), F.col(f))).alias(f) for f in RECORD_FIELDS))
    return rows.groupBy("group_no").agg(F.max("n_rows").alias("n_rows")).join(picked, "group_no", "left")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    rels = read_table(spark, folder, "source_relations").select(canonical_uuid(F.col("source_id")).alias("a"), canonical_uuid(F.col("target_source_id")).alias("b"))
    return consolidate(rels, "a", "b").select(F.col("id").alias("source_id"), "group_id")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    near = most_similar(read_table(spark, folder, "vectors"), "vector_index", "embedding", at_least=0.9)
    return near.select(F.least("idx", "neighbour").alias("index_a"), F.greatest("idx", "neighbour").alias("index_b")).distinct()


def p6_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The ten most similar vectors of every usable one whose index is divisible by 20, against all."""
    near = most_similar(read_table(spark, folder, "vectors"), "vector_index", "embedding", asked=F.col("idx") % 20 == 0)
    return near.select(F.col("idx").alias("vector_index"), "neighbour", "rank", F.round("cosine", 5).alias("cosine"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    links, members = near_duplicates(read_table(spark, folder, "textbook_sources"), "scan_no", "text")
    return all_pairs(links, members).select(F.col("a").alias("scan_a"), F.col("b").alias("scan_b"))


def p7_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Every text's class, its group of nearly equal texts, and how many other texts it is linked with."""
    links, members = near_duplicates(read_table(spark, folder, "textbook_sources"), "scan_no", "text")
    links = materialise(links, "links")
    ends = links.select(F.explode(F.array("rep_a", "rep_b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_links"))
    order = lambda c: F.lpad(F.col(c).cast("string"), 20, "0")
    groups = consolidate(links.select(order("rep_a").alias("a"), order("rep_b").alias("b")), "a", "b").select(F.col("id").cast("long").alias("rep"), F.col("group_id").cast("long").alias("group_no"))
    return members.join(ends, "rep", "left").join(groups, "rep", "left").select(F.col("row").alias("scan_no"), F.col("rep").alias("class_no"), F.coalesce("group_no", "rep").alias("group_no"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_corpus(read_table(spark, folder, "documents"), "doc_id", "text")


def p9_containers(spark: SparkSession, folder: str) -> DataFrame:
    limit = read_table(spark, folder, "size_limits").filter("limit_name = 'container'").agg(F.coalesce(F.min("max_size"), F.lit(0))).first()[0]
    if limit < 1:
        raise ValueError("size_limits has no row named container")
    sizes = token_counts(read_table(spark, folder, "documents"), "doc_id", "text")
    return pack(sizes, "doc_id", "n_tokens", limit).select("doc_id", "piece_no", F.col("begin").alias("begin_token"), F.col("size").alias("n_tokens"), "container_no")


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return judge_ends(read_table(spark, folder, "documents"), "doc_id", "text", "source").filter("cut").select(F.col("row_id").alias("doc_id"))


def p10_rates(spark: SparkSession, folder: str) -> DataFrame:
    return truncation_rates(judge_ends(read_table(spark, folder, "documents"), "doc_id", "text", "source"))


QUERIES = {f.__name__: f for f in (p1_found, p1_paragraphs, p3_found, p3_pieces, p4_found, p4_survivors, p5_found, p6_found, p6_neighbours, p7_found, p7_groups, p8_ids, p9_containers, p10_found, p10_rates)}
