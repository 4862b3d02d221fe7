"""SQL of the queries that SQL can express, over whole tables."""

from __future__ import annotations

from quarryweave.functions.dois import CLOSING, PLACEHOLDER_SUFFIXES


def _uuid(c: str) -> str:
    digits = f"regexp_replace(regexp_replace(lower({c}), '^[\\s{{]*urn:uuid:', ''), '[^0-9a-f]', '', 'g')"
    return f"(SELECT CASE WHEN h = '' THEN NULL ELSE substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) END FROM (SELECT {digits} AS h))"


def _doi(c: str) -> str:
    found = rf"regexp_replace(regexp_replace(regexp_extract(lower(replace(regexp_replace(translate({c}, '１', '1'), '\s+', '', 'g'), '%2F', '/')), '(10\.[0-9]{{4,9}}(?:\.[0-9]+)*/[^<>]+)', 1), '[.,;:!?]+$', ''), '{CLOSING.replace(chr(39), chr(39) * 2)}', '\\1')"
    suffix = "regexp_extract(d, '^[^/]*/(.*)$', 1)"
    return f"(SELECT CASE WHEN d = '' OR {suffix} IN ({', '.join(repr(s) for s in PLACEHOLDER_SUFFIXES)}) OR regexp_matches({suffix}, '^(x+|0+|[-_.]+)$') THEN NULL ELSE d END FROM (SELECT {found} AS d))"


_NUMBERED = f"""WITH RECURSIVE r AS (SELECT *, {_uuid("source_id")} AS s, {_uuid("canonical_source_id")} AS k, {_doi("normalized_doi")} AS doi FROM source_catalog),
ends AS (SELECT s AS a, k AS b FROM r WHERE k IN (SELECT s FROM r) UNION SELECT s, 'doi ' || doi FROM r WHERE doi IS NOT NULL),
both_ AS (SELECT a, b FROM ends UNION SELECT b, a FROM ends),
reach(s, seen) AS (SELECT DISTINCT s, s FROM r UNION SELECT reach.s, both_.b FROM reach JOIN both_ ON both_.a = reach.seen),
grp AS (SELECT s, min(seen) AS g FROM reach GROUP BY 1),
num AS (SELECT r.* REPLACE (doi AS normalized_doi), trust_rank, min(record_no) OVER (PARTITION BY g) AS group_no, count(*) OVER (PARTITION BY g) AS n_rows FROM r JOIN grp USING (s) LEFT JOIN root_ranks USING (root_id))"""
_NAMED = "lower(trim({0})) NOT IN ('', 'unknown')"


def _value(field: str, usable: str, least: int) -> str:
    """Rows that hold the surviving value of a field, for groups of at least so many rows."""
    best = "row_number() OVER (PARTITION BY group_no ORDER BY trust_rank NULLS LAST, observed_at DESC NULLS LAST, record_no)"
    return f"SELECT group_no, '{field}' AS field_name, record_no, CAST({field} AS VARCHAR) AS kept FROM num WHERE n_rows >= {least} AND {usable.format(field)} QUALIFY {best} = 1"


_FIELDS = {"source_id": _NAMED, "root_id": _NAMED, "relative_path": _NAMED, "source_kind": _NAMED, "display_title": _NAMED, "status": _NAMED, "directory_year": "{0} >= 1", "normalized_doi": "{0} IS NOT NULL", "legal_status": _NAMED, "sha256": _NAMED, "byte_size": "{0} >= 1"}
_GROUPS = f"{_NUMBERED}, kept AS ({' UNION ALL '.join(_value(f, _FIELDS[f], 2) for f in ('normalized_doi', 'byte_size', 'legal_status'))}) SELECT group_no, field_name, record_no FROM kept"
_TYPES = {"directory_year": "INT", "byte_size": "BIGINT"}
_SURVIVORS = f"{_NUMBERED}, kept AS ({' UNION ALL '.join(_value(f, u, 1) for f, u in _FIELDS.items())}), every AS (SELECT DISTINCT group_no, n_rows FROM num) SELECT group_no, any_value(n_rows) AS n_rows, " + ", ".join(f"CAST(max(kept) FILTER (field_name = '{f}') AS {_TYPES.get(f, 'VARCHAR')}) AS {f}" for f in _FIELDS) + " FROM every LEFT JOIN kept USING (group_no) GROUP BY 1"

_UNITS = "u AS (SELECT vector_index AS i, CAST(embedding AS DOUBLE[]) AS v FROM vectors WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL)) = 0 AND list_dot_product(list_transform(embedding, lambda x: coalesce(x, 0)), list_transform(embedding, lambda x: coalesce(x, 0))) > 0), near AS (SELECT a.i AS i, b.i AS j, list_cosine_similarity(a.v, b.v) AS cosine FROM u a JOIN u b ON a.i <> b.i QUALIFY row_number() OVER (PARTITION BY a.i ORDER BY round(cosine, 9) DESC, b.i) <= 10)"

ORACLE_SQL = {
    "p3_found": "SELECT DISTINCT scan_no FROM textbook_sources JOIN size_limits ON limit_name = source_family AND unit = 'bytes' WHERE octet_length(encode(text)) > max_size",
    "p4_found": _GROUPS,
    "p4_survivors": _SURVIVORS,
    "p5_found": f"WITH RECURSIVE e AS (SELECT {_uuid('source_id')} AS a, {_uuid('target_source_id')} AS b FROM source_relations), b2 AS (SELECT a, b FROM e WHERE a IS NOT NULL AND b IS NOT NULL UNION SELECT b, a FROM e WHERE a IS NOT NULL AND b IS NOT NULL), ids AS (SELECT a AS id FROM e WHERE a IS NOT NULL UNION SELECT b FROM e WHERE b IS NOT NULL), reach(id, seen) AS (SELECT id, id FROM ids UNION SELECT reach.id, b2.b FROM reach JOIN b2 ON b2.a = reach.seen) SELECT id AS source_id, min(seen) AS group_id FROM reach GROUP BY 1",
    "p6_found": f"WITH {_UNITS} SELECT DISTINCT least(i, j) AS index_a, greatest(i, j) AS index_b FROM near WHERE cosine >= 0.9",
    "p7_found": r"WITH t AS (SELECT scan_no, regexp_replace(lower(text), '[\s\x{00A0}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0085}]+', '', 'g') AS x FROM textbook_sources WHERE text IS NOT NULL), sh AS (SELECT DISTINCT scan_no, substr(x, CAST(p AS INT), 12) AS g FROM t, unnest(range(1, length(x) - 10)) r(p) WHERE length(x) >= 12), n AS (SELECT scan_no, count(*) AS n FROM sh GROUP BY 1), p AS (SELECT a.scan_no AS scan_a, b.scan_no AS scan_b, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.scan_no < b.scan_no GROUP BY 1, 2) SELECT scan_a, scan_b FROM p JOIN n na ON na.scan_no = scan_a JOIN n nb ON nb.scan_no = scan_b WHERE c >= 0.6 * (na.n + nb.n - c)",
}
