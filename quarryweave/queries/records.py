"""Catalog, knowledge, retrieval, text and event queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryweave.functions.dois import CLOSING, PLACEHOLDER_SUFFIXES, doi_key
from quarryweave.functions.keys import NAME_EDGES, entity_key_udf
from quarryweave.operators import catalog as C
from quarryweave.operators import knowledge as K
from quarryweave.operators import lookup as L
from quarryweave.operators import retrieval as R
from quarryweave.operators import texts as X
from quarryweave.plans import materialise, read_table
from quarryweave.streaming.quotas import quota_windows

FIELDS = ["display_title", "directory_year", "normalized_doi", "byte_size", "sha256"]
_FULL = " + ".join(f"CASE WHEN trim(CAST({f} AS VARCHAR)) <> '' THEN 1 ELSE 0 END" for f in FIELDS)
_DOI = r"regexp_extract(lower(replace(regexp_replace(translate(normalized_doi, '１', '1'), '\s+', '', 'g'), '%2F', '/')), '(10\.[0-9]{4,9}(?:\.[0-9]+)*/[^<>]+)', 1)"
_DOI = rf"(SELECT CASE WHEN d = '' OR regexp_extract(d, '^[^/]*/(.*)$', 1) IN ({', '.join(repr(s) for s in PLACEHOLDER_SUFFIXES)}) OR regexp_matches(regexp_extract(d, '^[^/]*/(.*)$', 1), '^(x+|0+|[-_.]+)$') THEN NULL ELSE d END FROM (SELECT regexp_replace(regexp_replace({_DOI}, '[.,;:!?]+$', ''), '{CLOSING.replace("'", "''")}', '\1') AS d))"
_WIDE, _NARROW = ("".join(chr(x + i) for i in range(94)) for x in (0xFF01, 0x21))
_KEY = "replace(lower(trim(trim(regexp_replace(translate({}, '" + _WIDE + "', '" + _NARROW.replace("'", "''") + "'), '[\\s\u3000\u00A0]+', ' ', 'g')), '" + NAME_EDGES.replace("'", "''") + "')), 'ß', 'ss')"


def _sql_key(c: str) -> str:
    """SQL of an entity's key for what the tables hold."""
    return _KEY.replace("{}", c)


def _catalog(spark, folder) -> DataFrame:
    return read_table(spark, folder, "source_catalog")


def _key(c: str):
    return entity_key_udf(F.col(c))


def catalog_canonical(spark, folder):
    return C.canonical_copies(_catalog(spark, folder), "record_no", "sha256", FIELDS, F.col("root_id") == "data_main")


def catalog_versions(spark, folder):
    rows = _catalog(spark, folder).withColumn("work", doi_key(F.col("normalized_doi")))
    return C.versions(rows, "record_no", "work", "sha256", FIELDS, F.col("root_id") == "data_main")


def catalog_doi(spark, folder):
    return _catalog(spark, folder).select("record_no", doi_key(F.col("normalized_doi")).alias("doi"))


def catalog_merged(spark, folder):
    return C.merge_preferred(_catalog(spark, folder), ["root_id", "relative_path"], [F.col("observed_at"), F.col("record_no")], ["legal_status", "byte_size", "sha256", "source_kind"], {"legal_status": ["unknown"], "source_kind": ["unknown"]})


def catalog_ids(spark, folder):
    rows = _catalog(spark, folder)
    return rows.select("record_no", C.uuid5(F.concat_ws(":", F.lit("manifest"), "root_id", "relative_path")).alias("path_id"), C.version_key(F.col("root_id"), F.col("relative_path"), F.col("byte_size")).alias("version_key"))


def catalog_stats(spark, folder):
    n = lambda c, a: F.sum(F.when(c, 1).otherwise(0)).cast("long").alias(a)
    return _catalog(spark, folder).groupBy("root_id").agg(F.count("*").alias("rows"), F.count_distinct("source_id").alias("sources"), n(F.col("normalized_doi").isNull(), "without_doi"), n(F.col("sha256").isNull(), "without_digest"), F.sum(F.when(F.col("byte_size") > 0, F.col("byte_size"))).alias("bytes"), F.max("observed_at").alias("last_seen"))


def corpus_inventory(spark, folder):
    rows = read_table(spark, folder, "textbook_sources")
    return rows.groupBy("source_family").agg(F.count("*").alias("documents"), F.count_distinct("content_sha256").alias("contents"), F.sum(F.octet_length("text")).cast("long").alias("bytes"), F.count("part_number").alias("parts"))


def corpus_duplicates(spark, folder):
    rows = read_table(spark, folder, "textbook_sources").select("scan_no", "content_sha256", "source_family", F.lower("relative_path").alias("path"))
    rows = rows.filter("content_sha256 is not null")
    kept = rows.groupBy("content_sha256").agg(F.min(F.struct("source_family", "path", "scan_no")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    return rows.join(kept.select("content_sha256", F.col("first.scan_no").alias("kept")), "content_sha256").filter("scan_no <> kept").select("scan_no", "kept")


def title_groups(spark, folder):
    rows = read_table(spark, folder, "textbook_sources").select(F.lower(F.trim(F.regexp_replace("logical_title", r"\s+", " "))).alias("title"), "content_sha256")
    return rows.filter("title <> ''").groupBy("title").agg(F.count("*").alias("rows"), F.count_distinct("content_sha256").alias("contents")).filter("rows > 1")


def fragments_per_source(spark, folder):
    return read_table(spark, folder, "evidence_fragments").groupBy("source_id").agg(F.count("*").alias("fragments"), F.count_distinct("fragment_id").alias("distinct_fragments"), F.max("created_at").alias("last_created"))


def provenance_chain(spark, folder):
    """How many source ids each pair of the chain's tables shares, and lacks on either side."""
    ids = lambda t: read_table(spark, folder, t).select(F.col("source_id").alias("id")).filter("id is not null").distinct()
    blocks, fragments, textbooks, catalog = (ids(t).withColumn(n, F.lit(1)) for t, n in (("mineru_blocks", "b"), ("evidence_fragments", "f"), ("textbook_sources", "t"), ("source_catalog", "c")))
    joined = blocks.join(fragments, "id", "full").join(textbooks, "id", "full").join(catalog, "id", "full")
    has = lambda c: F.col(c).isNotNull()
    return joined.groupBy(has("b").alias("in_blocks"), has("f").alias("in_fragments"), has("t").alias("in_textbooks"), has("c").alias("in_catalog")).agg(F.count("*").alias("sources"))


def first_write_wins(spark, folder):
    """Evidence rows by fragment id: the first kept, how many repeat it, how many contradict its content."""
    rows = read_table(spark, folder, "evidence_fragments").select("fragment_id", "fragment_no", F.coalesce("content_sha256", F.lit("")).alias("digest"))
    groups = rows.groupBy("fragment_id").agg(F.min("fragment_no").alias("kept"), F.count("*").alias("rows"), F.count_distinct("digest").alias("contents"))
    return groups.filter("rows > 1")


def kg_entities(spark, folder):
    rows = read_table(spark, folder, "custom_kg_entities").withColumn("entity_key", _key("entity_name"))
    out = K.canonical_entities(rows, "entity_key", "entity_name", "entity_type", "description", "source_id", "entity_no")
    return out.withColumn("sources", F.array_join("sources", ","))


def kg_relationships(spark, folder):
    rows = read_table(spark, folder, "custom_kg_relationships").select(_key("src_id").alias("l"), _key("tgt_id").alias("r"), "description")
    return K.canonical_relationships(rows, "l", "r", "description")


def kg_missing_ends(spark, folder):
    names = read_table(spark, folder, "custom_kg_entities").groupBy(_key("entity_name").alias("name")).agg(F.min("entity_type").alias("kind")).filter("name is not null")
    rows = read_table(spark, folder, "custom_kg_relationships").select(_key("src_id").alias("l"), _key("tgt_id").alias("r"))
    typed = rows.join(names.select(F.col("name").alias("l"), F.col("kind").alias("lk")), "l", "left").join(names.select(F.col("name").alias("r"), F.col("kind").alias("rk")), "r", "left")
    kind = lambda c: F.coalesce(c, F.lit("MissingEntity"))
    return typed.groupBy(kind("lk").alias("source_type"), kind("rk").alias("target_type")).agg(F.count("*").alias("edges"))


def kg_alias_merge(spark, folder):
    out = K.merge_aliases(read_table(spark, folder, "custom_kg_entities"), "entity_id", "entity_name", ["entity_type", "description"])
    return out.select("entity_id", F.array_join("aliases", "|").alias("aliases"), F.col("drifts").cast("int").alias("drifts"))


def kg_pair_ids(spark, folder):
    rows = read_table(spark, folder, "custom_kg_relationships").filter("src_id is not null and tgt_id is not null")
    return rows.select("rel_no", K.pair_id(F.col("src_id"), F.col("tgt_id")).alias("pair_id"), F.md5(F.concat(F.greatest("src_id", "tgt_id"), F.least("src_id", "tgt_id"))).alias("reverse_id"))


def kg_pair_collisions(spark, folder):
    """Pairs of the whole relationship table whose joined names collide."""
    return K.pair_collisions(read_table(spark, folder, "custom_kg_relationships"), "src_id", "tgt_id")


def node_search(spark, folder):
    """Entities whose name contains a text, whatever the case, in order of name: one page and one more."""
    rows = read_table(spark, folder, "custom_kg_entities").filter(F.col("entity_name").ilike("%composite%"))
    return rows.select("entity_no", "entity_name").orderBy(F.lower("entity_name"), "entity_no").limit(51)


def node_resolve(spark, folder):
    """The ids that fragments support and the names that relationships start from, looked up among the entities."""
    nodes = read_table(spark, folder, "custom_kg_entities").select(F.col("entity_id").alias("node"), F.col("entity_name").alias("label"))
    ids = read_table(spark, folder, "evidence_fragments").select(F.lit("id").alias("kind"), F.explode("supported_entity_ids").alias("value"))
    names = read_table(spark, folder, "custom_kg_relationships").select(F.lit("label").alias("kind"), F.col("src_id").alias("value"))
    return L.resolve_nodes(nodes, ids.unionByName(names))


def node_search_typed(spark, folder):
    """Processes whose name contains a text: one page, and whether there is more."""
    rows = read_table(spark, folder, "custom_kg_entities")
    return L.search_nodes(rows, "entity_name", "entity_no", "of", "contains", kind=("entity_type", "Process"), limit=50).select("entity_no", "entity_name", "more")


def _lexical(spark, folder, k=50):
    asked = spark.createDataFrame([("conductivity", "thermal conductivity of polymer composite"), ("strength", "tensile strength of steel wire after annealing"), ("porosity", "porosity and density of ceramic coating")], "query string, words string")
    return R.top_ranked(R.lexical_scores(read_table(spark, folder, "documents"), "doc_id", "text", asked, "query", "words"), "query", "doc_id", "score", k)


def lexical_rank(spark, folder):
    return _lexical(spark, folder)


def _fused(spark, folder):
    lexical = materialise(_lexical(spark, folder), "lexical")
    sizes = read_table(spark, folder, "documents").select("doc_id", F.col("n_chars").alias("n"))
    short = R.top_ranked(lexical.select("query", "doc_id").join(sizes, "doc_id").withColumn("score", -F.col("n")), "query", "doc_id", "score", 50)
    return R.fuse([lexical, short], "query", "doc_id")


def rrf_fusion(spark, folder):
    return _fused(spark, folder).withColumn("fused", F.round("fused", 8))


def budget_select(spark, folder):
    fused = _fused(spark, folder).withColumn("fused", F.round("fused", 8))
    ranked = R.top_ranked(fused, "query", "doc_id", "fused", 50).join(read_table(spark, folder, "documents").select("doc_id", F.col("n_chars").alias("cost")), "doc_id")
    return R.within_budget(ranked, "query", "doc_id", "rank", "cost", 20, 20_000)


def cosine_topk(spark, folder):
    rows = read_table(spark, folder, "embeddings")
    return R.cosine_top(rows.filter("vec_id % 20 = 0"), "vec_id", "embedding", rows.select(F.col("vec_id").alias("item"), "embedding"), "item", "embedding", 5)


def vector_dedupe(spark, folder):
    """Vectors of one content once, numbered from 0 without gaps in order of appearance."""
    rows = read_table(spark, folder, "vectors").filter("content_sha256 is not null").groupBy("content_sha256").agg(F.min("vector_index").alias("first_index"), F.count("*").alias("copies"))
    # positions over a range partitioning: rows before the part, then within it
    parts = materialise(rows.repartitionByRange("first_index").withColumn("part", F.spark_partition_id()), "ranged")
    before = parts.groupBy("part").agg(F.count("*").alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("part").orderBy("first_index"))
    return parts.withColumn("w", within).join(before, "part").select("content_sha256", "first_index", "copies", (F.col("w") - 1 + F.col("offset")).cast("long").alias("position"))


def vector_norms(spark, folder):
    rows = read_table(spark, folder, "vectors").filter("embedding is not null and size(embedding) = 64")
    return rows.select("vector_index", F.round(F.sqrt(R.dot(F.col("embedding"), F.col("embedding"))), 4).alias("length"), F.round(R.unit(F.col("embedding"))[0], 5).alias("first"))


def vector_audit(spark, folder):
    rows = read_table(spark, folder, "vectors")
    flag = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return rows.groupBy("kind").agg(F.count("*").alias("rows"), F.count_distinct("vector_index").alias("indexes"), F.min("vector_index").alias("first"), F.max("vector_index").alias("last"), F.count_distinct("content_sha256").alias("contents"), flag(F.col("embedding").isNull()).alias("without_vector"), flag(F.size("embedding") != 64).alias("wrong_size"))


def embedding_text(spark, folder):
    """The text an entity is embedded by: name, then description, control characters replaced."""
    rows = read_table(spark, folder, "custom_kg_entities")
    plain = F.regexp_replace(F.concat_ws("\n", "entity_name", "description"), r"[\x00-\x08\x0b\x0c\x0e-\x1f]", " ")
    return rows.select("entity_no", F.sha2(plain, 256).alias("text_sha256"), F.length(plain).alias("n_chars"))


def sentence_counts(spark, folder):
    rows = read_table(spark, folder, "documents")
    return rows.select("doc_id", F.size(X.sentence_units(F.col("text"))).cast("long").alias("units"))


def token_counts_by_language(spark, folder):
    rows = read_table(spark, folder, "documents").select(F.upper("lang").alias("lang"), X.search_tokens(F.col("text")).alias("t"))
    return rows.groupBy("lang").agg(F.count("*").alias("documents"), F.sum(F.size("t")).cast("long").alias("tokens"))


def chunk_documents(spark, folder):
    return X.chunk_documents(read_table(spark, folder, "documents"), "doc_id", "text")


def evidence_scores(spark, folder):
    rows = read_table(spark, folder, "mineru_blocks")
    return rows.select("block_no", X.evidence_confidence(F.col("block_type"), F.col("text"), F.col("section")).alias("confidence"))


def evidence_retained(spark, folder):
    """Of each source the eight best blocks of different texts, of those that can support something."""
    rows = read_table(spark, folder, "mineru_blocks").withColumn("confidence", X.evidence_confidence(F.col("block_type"), F.col("text"), F.col("section"))).filter("confidence >= 0.6")
    once = rows.groupBy("source_id", F.sha2("text", 256).alias("digest")).agg(F.min(F.struct((-F.col("confidence")).alias("c"), "block_index", "block_no")).alias("b"))
    rank = F.row_number().over(Window.partitionBy("source_id").orderBy("b.c", "b.block_index", "b.block_no"))
    return once.withColumn("rank", rank).filter("rank <= 8").select("source_id", F.col("b.block_no").alias("block_no"), "rank")


def section_forward(spark, folder):
    """The last title above each block of its task."""
    order = Window.partitionBy("task_id").orderBy("page", "block_index", "block_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return read_table(spark, folder, "mineru_blocks").select("block_no", F.last(F.when(F.col("block_type") == "title", F.col("text")), ignorenulls=True).over(order).alias("title"))


def event_quota_windows(spark, folder):
    return quota_windows(read_table(spark, folder, "events"), "ts", "user_id", "value", "1 hour")


def event_streaks(spark, folder):
    """Longest run of one event type for each user."""
    rows = read_table(spark, folder, "events")
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    runs = rows.withColumn("new", F.when(F.lag("event_type").over(order) == F.col("event_type"), 0).otherwise(1)).withColumn("run", F.sum("new").over(order))
    lengths = runs.groupBy("user_id", "event_type", "run").agg(F.count("*").alias("n"))
    return lengths.groupBy("user_id", "event_type").agg(F.max("n").alias("longest"))


_CONF = r"""CASE WHEN block_type IN ('header', 'footer', 'page_number') THEN 0.0 WHEN length(t) < 16 THEN 0.2 ELSE least(0.95, 0.65 + CASE WHEN regexp_matches(t, '[0-9]+(\.[0-9]+)? ?(°C|%|MPa|GPa|kPa|mm|nm|kJ|HV|wt|mol|min|rpm|Hz|kHz)') THEN 0.15 ELSE 0 END + CASE WHEN regexp_matches(lower(t), 'spectroscopy|diffraction|microscopy|analysis|calorimetry|testing|rheometry') THEN 0.1 ELSE 0 END + CASE WHEN block_type = 'table' THEN 0.05 ELSE 0 END + CASE WHEN trim(coalesce(section, '')) <> '' THEN 0.05 ELSE 0 END) END"""
_BLOCKS = rf"SELECT *, CAST(round({_CONF}, 2) AS DOUBLE) AS confidence FROM (SELECT *, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS t FROM mineru_blocks)"
_ASKED = "(VALUES ('conductivity', 'thermal conductivity of polymer composite'), ('strength', 'tensile strength of steel wire after annealing'), ('porosity', 'porosity and density of ceramic coating')) a(query, words)"
_LEX = f"q AS (SELECT query, w, count(*) AS c FROM (SELECT query, unnest(string_split(words, ' ')) AS w FROM {_ASKED}) GROUP BY 1, 2), dw AS (SELECT doc_id, w, count(*) AS c FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w FROM documents) WHERE w IN (SELECT w FROM q) GROUP BY 1, 2), s AS (SELECT query, doc_id, CAST(sum(q.c * dw.c) AS BIGINT) AS score FROM q JOIN dw USING (w) GROUP BY 1, 2), lx AS (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS INT) AS rank FROM s QUALIFY rank <= 50)"
_FUSE = _LEX + ", sh AS (SELECT query, doc_id, row_number() OVER (PARTITION BY query ORDER BY n_chars, doc_id) AS rank FROM lx JOIN documents USING (doc_id) QUALIFY rank <= 50), fu AS (SELECT query, doc_id, round(sum(1.0 / (60 + rank)), 8) AS fused FROM (SELECT query, doc_id, CAST(rank AS DOUBLE) AS rank FROM lx UNION ALL SELECT query, doc_id, CAST(rank AS DOUBLE) FROM sh) GROUP BY 1, 2)"
_TOP = "(CASE WHEN trim({0}) <> '' AND lower(trim({0})) NOT IN ('unknown') THEN {0} END)"


def _merged(f: str, weak: bool) -> str:
    solid = _TOP.format(f) if weak else f"(CASE WHEN trim(CAST({f} AS VARCHAR)) <> '' THEN {f} END)"
    filled = f"(CASE WHEN trim(CAST({f} AS VARCHAR)) <> '' THEN {f} END)"
    pick = lambda x: f"arg_max({x}, (observed_at, record_no)) FILTER ({x} IS NOT NULL)"
    return f"coalesce({pick(solid)}, {pick(filled)}) AS {f}"


ORACLE_SQL = {
    "catalog_canonical": f"WITH k AS (SELECT record_no, sha256, ({_FULL}) AS c, CASE WHEN root_id = 'data_main' THEN 0 ELSE 1 END AS p FROM source_catalog WHERE sha256 IS NOT NULL) SELECT record_no, first_value(record_no) OVER (PARTITION BY sha256 ORDER BY c DESC, p, record_no) AS canonical_row FROM k QUALIFY count(*) OVER (PARTITION BY sha256) > 1",
    "catalog_doi": f"SELECT record_no, {_DOI} AS doi FROM source_catalog",
    "catalog_versions": f"WITH k AS (SELECT record_no, sha256, {_DOI} AS work, ({_FULL}) AS c, CASE WHEN root_id = 'data_main' THEN 0 ELSE 1 END AS p FROM source_catalog WHERE sha256 IS NOT NULL), e AS (SELECT * FROM k WHERE work IS NOT NULL QUALIFY row_number() OVER (PARTITION BY work, sha256 ORDER BY c DESC, p, record_no) = 1), v AS (SELECT record_no, first_value(record_no) OVER (PARTITION BY work ORDER BY c DESC, p, record_no) AS version_of, count(*) OVER (PARTITION BY work) AS n FROM e) SELECT record_no, version_of FROM v WHERE n > 1 AND record_no <> version_of",
    "catalog_merged": f"SELECT root_id, relative_path, {_merged('legal_status', True)}, {_merged('byte_size', False)}, {_merged('sha256', False)}, {_merged('source_kind', True)} FROM source_catalog GROUP BY 1, 2",
    "catalog_ids": "WITH h AS (SELECT *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('manifest:' || root_id || ':' || relative_path)) AS d FROM source_catalog) SELECT record_no, substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-5' || substr(d, 14, 3) || '-' || substr('89ab', CAST(('0x' || substr(d, 17, 1)) AS INT) % 4 + 1, 1) || substr(d, 18, 3) || '-' || substr(d, 21, 12) AS path_id, sha256(root_id || chr(0) || relative_path || chr(0) || coalesce(CAST(byte_size AS VARCHAR), '')) AS version_key FROM h",
    "catalog_stats": "SELECT root_id, count(*) AS rows, count(DISTINCT source_id) AS sources, count(*) FILTER (normalized_doi IS NULL) AS without_doi, count(*) FILTER (sha256 IS NULL) AS without_digest, CAST(sum(byte_size) FILTER (byte_size > 0) AS BIGINT) AS bytes, max(observed_at) AS last_seen FROM source_catalog GROUP BY 1",
    "corpus_inventory": "SELECT source_family, count(*) AS documents, count(DISTINCT content_sha256) AS contents, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes, count(part_number) AS parts FROM textbook_sources GROUP BY 1",
    "corpus_duplicates": "SELECT scan_no, kept FROM (SELECT scan_no, first_value(scan_no) OVER (PARTITION BY content_sha256 ORDER BY source_family, lower(relative_path), scan_no) AS kept FROM textbook_sources WHERE content_sha256 IS NOT NULL) WHERE scan_no <> kept",
    "title_groups": r"SELECT lower(trim(regexp_replace(logical_title, '\s+', ' ', 'g'))) AS title, count(*) AS rows, count(DISTINCT content_sha256) AS contents FROM textbook_sources GROUP BY 1 HAVING title <> '' AND count(*) > 1",
    "fragments_per_source": "SELECT source_id, count(*) AS fragments, count(DISTINCT fragment_id) AS distinct_fragments, max(created_at) AS last_created FROM evidence_fragments GROUP BY 1",
    "provenance_chain": "WITH a AS (SELECT source_id AS id, 'b' AS k FROM mineru_blocks UNION SELECT source_id, 'f' FROM evidence_fragments UNION SELECT source_id, 't' FROM textbook_sources UNION SELECT source_id, 'c' FROM source_catalog), g AS (SELECT id, bool_or(k = 'b') AS in_blocks, bool_or(k = 'f') AS in_fragments, bool_or(k = 't') AS in_textbooks, bool_or(k = 'c') AS in_catalog FROM a WHERE id IS NOT NULL GROUP BY 1) SELECT in_blocks, in_fragments, in_textbooks, in_catalog, count(*) AS sources FROM g GROUP BY ALL",
    "first_write_wins": "SELECT fragment_id, min(fragment_no) AS kept, count(*) AS rows, count(DISTINCT coalesce(content_sha256, '')) AS contents FROM evidence_fragments GROUP BY 1 HAVING count(*) > 1",
    "kg_entities": f"WITH r AS (SELECT *, {_sql_key('entity_name')} AS entity_key FROM custom_kg_entities WHERE entity_name IS NOT NULL), m AS (SELECT entity_key, count(*) AS mentions FROM r GROUP BY 1), nm AS (SELECT entity_key, entity_name AS display_name FROM r GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY entity_key ORDER BY count(*) DESC, length(entity_name) DESC, lower(replace(entity_name, 'ß', 'ss')), entity_name) = 1), ty AS (SELECT entity_key, entity_type FROM r WHERE entity_type IS NOT NULL GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY entity_key ORDER BY count(*) DESC, coalesce(list_position({K.TYPE_PRIORITY}, entity_type), 15), entity_type) = 1), dr AS (SELECT entity_key, description, row_number() OVER (PARTITION BY entity_key ORDER BY count(*) DESC, length(description) DESC, lower(replace(description, 'ß', 'ss')), description) AS k FROM r WHERE trim(description) <> '' GROUP BY 1, 2), de AS (SELECT entity_key, substr(string_agg(description, '；' ORDER BY k), 1, 2000) AS description FROM dr WHERE k <= 3 GROUP BY 1), sr AS (SELECT entity_key, source_id, row_number() OVER (PARTITION BY entity_key ORDER BY min(entity_no), source_id) AS k FROM r WHERE source_id IS NOT NULL GROUP BY 1, 2), so AS (SELECT entity_key, string_agg(source_id, ',' ORDER BY k) AS sources FROM sr WHERE k <= 32 GROUP BY 1) SELECT entity_key, mentions, display_name, entity_type, description, sources FROM m LEFT JOIN nm USING (entity_key) LEFT JOIN ty USING (entity_key) LEFT JOIN de USING (entity_key) LEFT JOIN so USING (entity_key)",
    "kg_relationships": f"WITH r AS (SELECT {_sql_key('src_id')} AS l, {_sql_key('tgt_id')} AS r, description FROM custom_kg_relationships WHERE src_id IS NOT NULL AND tgt_id IS NOT NULL) SELECT least(l, r) AS source_key, greatest(l, r) AS target_key, count(*) AS mentions, count(DISTINCT description) AS descriptions, round_even(1 + ln(1 + count(*)), 6) AS weight FROM r WHERE l <> r GROUP BY 1, 2",
    "kg_missing_ends": f"WITH n AS (SELECT {_sql_key('entity_name')} AS name, min(entity_type) AS kind FROM custom_kg_entities WHERE entity_name IS NOT NULL GROUP BY 1) SELECT coalesce(a.kind, 'MissingEntity') AS source_type, coalesce(b.kind, 'MissingEntity') AS target_type, count(*) AS edges FROM custom_kg_relationships LEFT JOIN n a ON a.name = {_sql_key('src_id')} LEFT JOIN n b ON b.name = {_sql_key('tgt_id')} GROUP BY 1, 2",
    "kg_alias_merge": "SELECT entity_id, coalesce(array_to_string(list_sort(list(DISTINCT entity_name) FILTER (entity_name IS NOT NULL)), '|'), '') AS aliases, CAST((count(DISTINCT entity_type) > 1) AS INT) + CAST((count(DISTINCT description) > 1) AS INT) AS drifts FROM custom_kg_entities GROUP BY 1",
    "kg_pair_ids": "SELECT rel_no, md5(least(src_id, tgt_id) || greatest(src_id, tgt_id)) AS pair_id, md5(greatest(src_id, tgt_id) || least(src_id, tgt_id)) AS reverse_id FROM custom_kg_relationships WHERE src_id IS NOT NULL AND tgt_id IS NOT NULL",
    "kg_pair_collisions": "WITH p AS (SELECT DISTINCT least(src_id, tgt_id) AS source_key, greatest(src_id, tgt_id) AS target_key, md5(least(src_id, tgt_id) || greatest(src_id, tgt_id)) AS pair, md5(greatest(src_id, tgt_id) || least(src_id, tgt_id)) AS rev FROM custom_kg_relationships WHERE src_id IS NOT NULL AND tgt_id IS NOT NULL) SELECT source_key, target_key, pair, count(*) OVER (PARTITION BY pair) > 1 AS concat_collision, pair IN (SELECT rev FROM p WHERE rev <> pair) AS reverse_collision FROM p QUALIFY concat_collision OR reverse_collision",
    "node_search": "SELECT entity_no, entity_name FROM custom_kg_entities WHERE entity_name ILIKE '%composite%' ORDER BY lower(entity_name), entity_no LIMIT 51",
    "node_resolve": "WITH a AS (SELECT DISTINCT * FROM (SELECT 'id' AS kind, unnest(supported_entity_ids) AS value FROM evidence_fragments UNION ALL SELECT 'label', src_id FROM custom_kg_relationships) WHERE value IS NOT NULL), n AS (SELECT DISTINCT entity_id, entity_name FROM custom_kg_entities), m AS (SELECT kind, value, count(DISTINCT entity_id) AS matches, min(entity_id) AS node FROM a LEFT JOIN (SELECT 'id' AS kind, entity_id AS value, entity_id FROM n UNION ALL SELECT 'label', entity_name, entity_id FROM n) USING (kind, value) GROUP BY 1, 2) SELECT kind, value, CASE WHEN matches = 0 THEN 'unresolved' WHEN matches = 1 THEN 'match' ELSE 'ambiguous' END AS status, CASE WHEN matches = 1 THEN node END AS node FROM m",
    "node_search_typed": "SELECT entity_no, entity_name, n > 50 AS more FROM (SELECT *, count(*) OVER () AS n FROM custom_kg_entities WHERE entity_name ILIKE '%of%' AND entity_type = 'Process') ORDER BY lower(entity_name), entity_no LIMIT 50",
    "lexical_rank": f"WITH {_LEX} SELECT query, doc_id, score, rank FROM lx",
    "rrf_fusion": f"WITH {_FUSE} SELECT query, doc_id, fused FROM fu",
    "budget_select": f"WITH RECURSIVE {_FUSE}, rk AS (SELECT query, doc_id, n_chars AS cost, CAST(row_number() OVER (PARTITION BY query ORDER BY fused DESC, doc_id) AS INT) AS rank FROM fu JOIN documents USING (doc_id) QUALIFY rank <= 50), walk AS (SELECT query, 0 AS rank, CAST(0 AS BIGINT) AS doc_id, CAST(0 AS BIGINT) AS cost, 0 AS n, CAST(0 AS BIGINT) AS used, false AS selected FROM (SELECT DISTINCT query FROM rk) UNION ALL SELECT rk.query, rk.rank, rk.doc_id, rk.cost, n + CAST(n < 20 AND used + rk.cost <= 20000 AS INT), used + CASE WHEN n < 20 AND used + rk.cost <= 20000 THEN rk.cost ELSE 0 END, n < 20 AND used + rk.cost <= 20000 FROM walk JOIN rk ON rk.query = walk.query AND rk.rank = walk.rank + 1) SELECT query, doc_id, rank, cost, selected FROM walk WHERE rank > 0",
    "cosine_topk": "WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), s AS (SELECT a.vec_id, b.vec_id AS item, round(list_cosine_similarity(a.v, b.v), 6) AS cosine FROM e a JOIN e b ON a.vec_id % 20 = 0) SELECT vec_id, item, cosine, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, item) AS INT) AS rank FROM s QUALIFY rank <= 5",
    "vector_dedupe": "SELECT content_sha256, min(vector_index) AS first_index, count(*) AS copies, row_number() OVER (ORDER BY min(vector_index)) - 1 AS position FROM vectors WHERE content_sha256 IS NOT NULL GROUP BY 1",
    "vector_norms": "WITH v AS (SELECT vector_index, CAST(embedding AS DOUBLE[]) AS e FROM vectors WHERE embedding IS NOT NULL AND len(embedding) = 64), l AS (SELECT *, sqrt(list_dot_product(e, e)) AS n FROM v) SELECT vector_index, round(n, 4) AS length, CASE WHEN n > 0 THEN round(e[1] / n, 5) END AS first FROM l",
    "vector_audit": "SELECT kind, count(*) AS rows, count(DISTINCT vector_index) AS indexes, min(vector_index) AS first, max(vector_index) AS last, count(DISTINCT content_sha256) AS contents, count(*) FILTER (embedding IS NULL) AS without_vector, count(*) FILTER (len(embedding) <> 64) AS wrong_size FROM vectors GROUP BY 1",
    "embedding_text": r"SELECT entity_no, sha256(t) AS text_sha256, CAST(length(t) AS INT) AS n_chars FROM (SELECT entity_no, regexp_replace(concat_ws(chr(10), entity_name, description), '[\x00-\x08\x0b\x0c\x0e-\x1f]', ' ', 'g') AS t FROM custom_kg_entities)",
    "sentence_counts": r"SELECT doc_id, CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '[^.!?;。！？；]*[.!?;。！？；]|[^.!?;。！？；]+$'), lambda x: trim(x) <> '')) AS BIGINT) AS units FROM documents",
    "token_counts_by_language": r"SELECT upper(lang) AS lang, count(*) AS documents, CAST(sum(len(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+')) + 2 * len(regexp_extract_all(coalesce(text, ''), '[\x{4E00}-\x{9FFF}]')) - len(regexp_extract_all(coalesce(text, ''), '[\x{4E00}-\x{9FFF}]+'))) AS BIGINT) AS tokens FROM documents GROUP BY 1",
    "evidence_scores": f"SELECT block_no, confidence FROM ({_BLOCKS})",
    "evidence_retained": f"WITH o AS (SELECT source_id, block_no, block_index, confidence FROM ({_BLOCKS}) WHERE confidence >= 0.6 QUALIFY row_number() OVER (PARTITION BY source_id, sha256(text) ORDER BY confidence DESC, block_index, block_no) = 1) SELECT source_id, block_no, CAST(row_number() OVER (PARTITION BY source_id ORDER BY confidence DESC, block_index, block_no) AS INT) AS rank FROM o QUALIFY rank <= 8",
    "section_forward": "SELECT block_no, last_value(CASE WHEN block_type = 'title' THEN text END IGNORE NULLS) OVER (PARTITION BY task_id ORDER BY page, block_index, block_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS title FROM mineru_blocks",
    "event_quota_windows": "SELECT user_id AS scope, date_trunc('hour', ts) AS window_start, count(*) AS requests, round(sum(value), 4) AS amount FROM events GROUP BY 1, 2",
    "event_streaks": "WITH o AS (SELECT *, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM o), n AS (SELECT user_id, event_type, run, count(*) AS n FROM r GROUP BY 1, 2, 3) SELECT user_id, event_type, max(n) AS longest FROM n GROUP BY 1, 2",
}
QUERIES = {f.__name__: f for f in (catalog_canonical, catalog_doi, catalog_versions, catalog_merged, catalog_ids, catalog_stats, corpus_inventory, corpus_duplicates, title_groups, fragments_per_source, provenance_chain, first_write_wins, kg_entities, kg_relationships, kg_missing_ends, kg_alias_merge, kg_pair_ids, kg_pair_collisions, node_search, node_search_typed, node_resolve, lexical_rank, rrf_fusion, budget_select, cosine_topk, vector_dedupe, vector_norms, vector_audit, embedding_text, sentence_counts, token_counts_by_language, chunk_documents, evidence_scores, evidence_retained, section_forward, event_quota_windows, event_streaks)}
