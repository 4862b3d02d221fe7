"""Queries on sources for a gap, names held by their fragments, and blocks of texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryweave.functions import checks as C
from quarryweave.functions.keys import NAME_EDGES, entity_key_udf
from quarryweave.operators import knowledge as K
from quarryweave.operators import sections
from quarryweave.operators import selection as S
from quarryweave.plans import materialise, read_table

GAP = "thermal conductivity of polymer composite"
#: States of sources that were or are being worked on, and of such that failed for good.
DONE, FAILED, PRIMARY = ["deduplicated", "indexed"], ["failed_permanent"], "data_main"


def _judged(spark, folder):
    rows = read_table(spark, folder, "source_catalog").select(F.col("source_id").alias("source"), F.col("root_id").alias("root"), F.col("relative_path").alias("path"), F.col("display_title").alias("title"), F.col("source_kind").alias("kind"), F.col("normalized_doi").alias("doi"), F.col("sha256").alias("digest"), F.col("canonical_source_id").alias("canonical"), "status", "metadata")
    return S.rejections(rows, DONE, FAILED, PRIMARY)


def hard_rejection(spark, folder):
    """Sources by why they can't be chosen, and how many pages they have."""
    return _judged(spark, folder).groupBy(F.coalesce("reason", F.lit("candidate")).alias("reason")).agg(F.count("*").alias("sources"))


def gap_selection(spark, folder):
    return S.select_for_gap(_judged(spark, folder), GAP)


def _mentions(spark, folder):
    return K.supported_mentions(read_table(spark, folder, "custom_kg_entities"), "entity_no", "entity_name", "description", "source_id", read_table(spark, folder, "evidence_fragments"), "fragment_id", "text")


def kg_filtered_mentions(spark, folder):
    """Entity rows by whether the fragment they cite holds their name."""
    return _mentions(spark, folder).select(F.col("row").alias("entity_no"), "key", "outcome")


def kg_local_relationships(spark, folder):
    """Relationship rows by whether both ends are entities that cite the same fragment."""
    cited = materialise(_mentions(spark, folder), "mentions").filter("outcome in ('kept', 'not_in_source')")
    rows = K.local_relationships(read_table(spark, folder, "custom_kg_relationships"), "rel_no", "src_id", "tgt_id", "description", "source_id", cited)
    return rows.groupBy("outcome").agg(F.count("*").alias("rows"), F.count_distinct("source_key", "target_key").alias("pairs"))


def textbook_blocks(spark, folder):
    blocks = sections.text_blocks(read_table(spark, folder, "textbook_sources").dropDuplicates(["scan_no"]), "scan_no", "text", "logical_title")
    return blocks.select(F.col("row").alias("scan_no"), "block_no", "page", "section", "path", "kind", F.sha2("body", 256).alias("body_sha256"))


def catalog_paths(spark, folder):
    """Paths of the catalog in plain form (null: not below a root), and titles short enough for a label."""
    rows = read_table(spark, folder, "source_catalog")
    return rows.select("record_no", C.relative_path(F.col("relative_path")).alias("path"), C.bounded_label(F.col("display_title"), 24).alias("label"))


def unsafe_texts(spark, folder):
    """Fragments whose text names a place inside a network or holds a secret."""
    rows = read_table(spark, folder, "evidence_fragments").select("fragment_no", F.col("text").rlike(C.SECRET).alias("secret"), F.col("text").rlike(C.INTERNAL_PLACE).alias("place"))
    return rows.groupBy("secret", "place").agg(F.count("*").alias("fragments"))


def kg_type_pairs(spark, folder):
    """Relationships by the types of their ends in either order, with the weight of that many mentions."""
    names = read_table(spark, folder, "custom_kg_entities").groupBy(entity_key_udf("entity_name").alias("name")).agg(F.min("entity_type").alias("kind")).filter("name is not null")
    rows = read_table(spark, folder, "custom_kg_relationships").select(entity_key_udf("src_id").alias("l"), entity_key_udf("tgt_id").alias("r"))
    typed = rows.join(names.select(F.col("name").alias("l"), F.col("kind").alias("lk")), "l", "left").join(names.select(F.col("name").alias("r"), F.col("kind").alias("rk")), "r", "left")
    counted = typed.groupBy(C.type_pair(F.col("lk"), F.col("rk")).alias("pair")).agg(F.count("*").alias("edges"))
    return counted.withColumn("weight", F.bround(C.mention_weight(F.col("edges")), 6))


def merge_conflicts(spark, folder):
    """Entities whose rows contradict each other: how many types, descriptions and fragments they name, and the name that came first."""
    rows = read_table(spark, folder, "custom_kg_entities").filter("entity_id is not null")
    groups = rows.groupBy("entity_id").agg(F.count("*").alias("rows"), *(F.count_distinct(c).alias(n) for c, n in (("entity_type", "types"), ("description", "descriptions"), ("source_id", "fragments"))), F.min_by("entity_name", F.struct("created_at", "entity_no")).alias("first_name"))
    return groups.filter("types > 1 or descriptions > 1 or fragments > 1")


def corpus_digest(spark, folder):
    """One digest of all texts of each family, whatever their order."""
    rows = read_table(spark, folder, "textbook_sources").select("source_family", F.sha2(F.coalesce("text", F.lit("")), 256).alias("d")).distinct()
    buckets = rows.groupBy("source_family", F.substring("d", 1, 4).alias("bucket")).agg(F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("d")), ","), 256).alias("d"))
    return buckets.groupBy("source_family").agg(F.sum("n").alias("texts"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "d"))), lambda x: x["d"]), ","), 256).alias("digest"))


_WIDE, _NARROW = ("".join(chr(x + i) for i in range(94)) for x in (0xFF01, 0x21))


def _narrow(c: str) -> str:
    narrow = _NARROW.replace("'", "''")
    return f"translate({c}, '{_WIDE}', '{narrow}')"


def _key(c: str) -> str:
    edges = NAME_EDGES.replace("'", "''")
    return f"replace(lower(trim(trim(regexp_replace({_narrow(c)}, '[\\s\u3000\u00A0]+', ' ', 'g')), '{edges}')), 'ß', 'ss')"


def _letters(c: str) -> str:
    return f"regexp_replace(replace(lower({_narrow(c)}), 'ß', 'ss'), '[^\\p{{L}}\\p{{N}}]', '', 'g')"


_MENTIONS = f"""f AS (SELECT DISTINCT fragment_id, {_letters("coalesce(text, '')")} AS letters FROM evidence_fragments),
m AS (SELECT entity_no, source_id, {_key("entity_name")} AS key, max(CASE WHEN letters IS NULL THEN 1 WHEN entity_name IS NULL OR {_key("entity_name")} = '' OR trim(coalesce(description, '')) = '' THEN 2 WHEN {_letters("entity_name")} = '' OR NOT contains(letters, {_letters("entity_name")}) THEN 3 ELSE 4 END) AS o FROM custom_kg_entities LEFT JOIN f ON fragment_id = source_id GROUP BY 1, 2, 3)"""
_LINE = "regexp_replace(line, '^[\\s\u3000\u00A0]+|[\\s\u3000\u00A0]+$', '', 'g')"
_TITLE = "regexp_replace(lower(coalesce({}, '')), '[^\\p{L}\\p{N}]', '', 'g')"
_BLOCKS = rf"""WITH l AS (SELECT scan_no, title, n, {_LINE} AS line FROM (SELECT scan_no, {_TITLE.replace("{}", "logical_title")} AS title, unnest(range(1, len(ls) + 1)) AS n, unnest(ls) AS line FROM (SELECT scan_no, logical_title, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS ls FROM textbook_sources WHERE text IS NOT NULL))),
k AS (SELECT *, TRY_CAST(CASE WHEN regexp_matches(line, '{sections.PAGE_COMMENT}') THEN regexp_extract(line, '{sections.PAGE_COMMENT}', 1) WHEN regexp_matches(line, '{sections.PAGE_HEADING}') THEN regexp_extract(line, '{sections.PAGE_HEADING}', 1) END AS INT) AS mark FROM l),
t AS (SELECT *, CASE WHEN line = '' THEN 'blank' WHEN mark IS NOT NULL THEN 'page' WHEN regexp_matches(line, '{sections.HEADING}') THEN 'heading' WHEN regexp_matches(line, '{sections.NOISE}') THEN 'noise' ELSE 'text' END AS kind FROM k),
h AS (SELECT *, CASE WHEN kind = 'heading' THEN regexp_extract(line, '{sections.HEADING}', 1) END AS heading, lag(kind) OVER w AS prior, coalesce(bool_or(kind = 'text') OVER (PARTITION BY scan_no ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS had FROM t WINDOW w AS (PARTITION BY scan_no ORDER BY n)),
x AS (SELECT *, kind = 'heading' AND NOT had AND {_TITLE.replace("{}", "heading")} = title AS wrapper FROM h),
lv AS (SELECT *, CASE WHEN kind = 'heading' AND NOT wrapper THEN length(regexp_extract(line, '^(#+)', 1)) END AS lev FROM x),
hp AS (SELECT *, {", ".join(f"max(CASE WHEN lev = {k} THEN n END) OVER w AS n{k}, last_value(CASE WHEN lev = {k} THEN heading END IGNORE NULLS) OVER w AS t{k}" for k in range(1, 7))} FROM lv WINDOW w AS (PARTITION BY scan_no ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
pa AS (SELECT *, concat_ws(' / ', {", ".join(f"CASE WHEN n{k} > greatest(-1, {', '.join(f'coalesce(n{j}, -1)' for j in range(1, k)) or '-1'}) THEN t{k} END" for k in range(1, 7))}) AS path FROM hp),
y AS (SELECT *, last_value(mark IGNORE NULLS) OVER w AS page, last_value(CASE WHEN NOT wrapper THEN heading END IGNORE NULLS) OVER w AS section, sum(CASE WHEN kind = 'heading' OR kind = 'text' AND coalesce(prior, '') <> 'text' THEN 1 ELSE 0 END) OVER w AS b FROM pa WINDOW w AS (PARTITION BY scan_no ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
z AS (SELECT scan_no, b, any_value(page) AS page, any_value(section) AS section, any_value(path) AS path, any_value(kind) AS kind, string_agg(line, chr(10) ORDER BY n) AS body FROM y WHERE kind = 'text' OR kind = 'heading' AND NOT wrapper GROUP BY 1, 2)
SELECT scan_no, CAST(row_number() OVER (PARTITION BY scan_no ORDER BY b) AS INT) AS block_no, page, section, path, kind, sha256(CASE WHEN kind = 'heading' THEN section ELSE body END) AS body_sha256 FROM z"""
_META = ", ".join(f"metadata['{k}']" for k in S.TEXT_METADATA)
_PAGES = ", ".join(f"metadata['{k}']" for k in S.PAGE_NAMES)
_HAN = "[\\x{4E00}-\\x{9FFF}]"
_IN = lambda values: "(" + ", ".join(f"'{v}'" for v in values) + ")"
_JUDGED = f"""v AS (SELECT source_id AS source, CASE WHEN root_id = '{PRIMARY}' THEN 0 ELSE 1 END AS later, display_title AS title, normalized_doi AS doi, sha256 AS digest, canonical_source_id AS canonical, status, metadata, lower(concat_ws(' ', display_title, source_kind, normalized_doi, {_META})) AS x FROM source_catalog WHERE source_id IS NOT NULL),
u AS (SELECT *, len(regexp_extract_all(x, '[a-z0-9]+')) + 2 * len(regexp_extract_all(x, '{_HAN}')) - len(regexp_extract_all(x, '{_HAN}+')) AS n FROM v),
o AS (SELECT *, CASE WHEN canonical IS NOT NULL OR status IN {_IN(DONE)} THEN 'duplicate' WHEN status IN {_IN(FAILED)} THEN 'insufficient_metadata' END AS hard FROM u QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC, later, digest NULLS FIRST, title NULLS FIRST, doi NULLS FIRST, canonical NULLS FIRST, status NULLS FIRST, CAST(to_json(metadata) AS VARCHAR) NULLS FIRST) = 1),
fin AS (SELECT DISTINCT digest FROM o WHERE hard IS NOT NULL AND status IN {_IN(DONE)} AND digest IS NOT NULL),
pref AS (SELECT digest, source AS chosen FROM o WHERE hard IS NULL AND digest IS NOT NULL QUALIFY row_number() OVER (PARTITION BY digest ORDER BY n DESC, later, source) = 1),
j AS (SELECT source, later, x, coalesce(CASE WHEN p BETWEEN 1 AND {S.MOST_PAGES} THEN p END, {S.UNKNOWN_PAGES}) AS pages, CASE WHEN hard IS NOT NULL THEN hard WHEN digest IN (SELECT digest FROM fin) OR chosen <> source THEN 'duplicate' WHEN NOT (doi IS NOT NULL OR (lower(trim(coalesce(title, ''))) NOT IN {_IN(['', *S.PLACEHOLDER_TITLES])}) OR trim(concat_ws('', {_META})) <> '') THEN 'insufficient_metadata' END AS reason FROM (SELECT *, TRY_CAST(coalesce({_PAGES}) AS INT) AS p FROM o) LEFT JOIN pref USING (digest))"""
ORACLE_SQL = {
    "hard_rejection": f"WITH {_JUDGED} SELECT coalesce(reason, 'candidate') AS reason, count(*) AS sources FROM j GROUP BY 1",
    "gap_selection": f"WITH RECURSIVE {_JUDGED}, w AS (SELECT source, unnest(regexp_extract_all(x, '[a-z0-9]+')) AS word FROM j WHERE reason IS NULL), q AS (SELECT word, count(*) AS q FROM (SELECT unnest(string_split('{GAP}', ' ')) AS word) GROUP BY 1), sc AS (SELECT source, sum(q) AS score FROM w JOIN q USING (word) GROUP BY 1), rk AS (SELECT source, pages, row_number() OVER (ORDER BY coalesce(score, 0) DESC, later, source) AS rank FROM j LEFT JOIN sc USING (source) WHERE reason IS NULL), pick(n, rank, room) AS (SELECT 0, CAST(0 AS BIGINT), CAST(2000 AS BIGINT) UNION ALL SELECT pick.n + 1, min(rk.rank), any_value(room) - arg_min(pages, rk.rank) FROM pick JOIN rk ON rk.rank > pick.rank AND pages <= room WHERE pick.n < 20 GROUP BY pick.n) SELECT source, rank, pages, rank IN (SELECT rank FROM pick) AS selected, CASE WHEN rank IN (SELECT rank FROM pick) THEN 'active_evidence_gap' ELSE 'budget_deferred' END AS reason FROM rk UNION ALL SELECT source, NULL, pages, false, reason FROM j WHERE reason IS NOT NULL",
    "kg_filtered_mentions": f"WITH {_MENTIONS} SELECT entity_no, key, ['unknown_fragment', 'incomplete', 'not_in_source', 'kept'][o] AS outcome FROM m",
    "kg_local_relationships": f"WITH {_MENTIONS}, k AS (SELECT DISTINCT source_id, key FROM m WHERE o IN (3, 4)), r AS (SELECT rel_no, source_id, {_key('src_id')} AS s, {_key('tgt_id')} AS t, description FROM custom_kg_relationships), j AS (SELECT s, t, CASE WHEN a.key IS NULL THEN 'no_source' WHEN b.key IS NULL THEN 'no_target' WHEN s = t THEN 'self' WHEN trim(coalesce(description, '')) = '' THEN 'incomplete' ELSE 'kept' END AS outcome FROM r LEFT JOIN k a ON a.source_id = r.source_id AND a.key = s LEFT JOIN k b ON b.source_id = r.source_id AND b.key = t) SELECT outcome, count(*) AS rows, count(DISTINCT CASE WHEN s IS NOT NULL AND t IS NOT NULL THEN (s, t) END) AS pairs FROM j GROUP BY 1",
    "textbook_blocks": _BLOCKS,
    "catalog_paths": r"SELECT record_no, CASE WHEN p = '' OR regexp_matches(p, '^[A-Za-z][A-Za-z0-9+.-]*:') OR starts_with(p, '/') OR regexp_matches(p, '(^|/)\.\.(/|$)') THEN NULL ELSE regexp_replace(regexp_replace(regexp_replace(regexp_replace(p, '(^|/)(\./)+', '\1', 'g'), '/{2,}', '/', 'g'), '/\.$', ''), '(.)/$', '\1') END AS path, CASE WHEN length(t) <= 24 THEN t ELSE substr(t, 1, 23) || '…' END AS label FROM (SELECT record_no, replace(trim(relative_path), chr(92), '/') AS p, trim(regexp_replace(display_title, '[\s\x{00A0}\x{3000}]+', ' ', 'g')) AS t FROM source_catalog)",
    "unsafe_texts": rf"SELECT regexp_matches(text, '{C.SECRET}') AS secret, regexp_matches(text, '{C.INTERNAL_PLACE.replace(chr(39), chr(39) * 2)}') AS place, count(*) AS fragments FROM evidence_fragments GROUP BY 1, 2",
    "kg_type_pairs": f"WITH n AS (SELECT {_key('entity_name')} AS name, min(entity_type) AS kind FROM custom_kg_entities WHERE entity_name IS NOT NULL GROUP BY 1), t AS (SELECT coalesce(a.kind, 'Other') AS x, coalesce(b.kind, 'Other') AS y FROM custom_kg_relationships LEFT JOIN n a ON a.name = {_key('src_id')} LEFT JOIN n b ON b.name = {_key('tgt_id')}) SELECT least(x, y) || '|' || greatest(x, y) AS pair, count(*) AS edges, round_even(1 + 0.2 * ln(count(*)), 6) AS weight FROM t GROUP BY 1",
    "merge_conflicts": "SELECT entity_id, count(*) AS rows, count(DISTINCT entity_type) AS types, count(DISTINCT description) AS descriptions, count(DISTINCT source_id) AS fragments, arg_min(entity_name, (created_at, entity_no)) AS first_name FROM custom_kg_entities WHERE entity_id IS NOT NULL GROUP BY 1 HAVING types > 1 OR descriptions > 1 OR fragments > 1",
    "corpus_digest": "WITH d AS (SELECT DISTINCT source_family, sha256(coalesce(text, '')) AS d FROM textbook_sources), b AS (SELECT source_family, substr(d, 1, 4) AS bucket, count(*) AS n, sha256(string_agg(d, ',' ORDER BY d)) AS d FROM d GROUP BY 1, 2) SELECT source_family, CAST(sum(n) AS BIGINT) AS texts, sha256(string_agg(d, ',' ORDER BY bucket)) AS digest FROM b GROUP BY 1",
}
QUERIES = {f.__name__: f for f in (hard_rejection, gap_selection, kg_filtered_mentions, kg_local_relationships, textbook_blocks, catalog_paths, unsafe_texts, kg_type_pairs, merge_conflicts, corpus_digest)}
