"""Texts cut off by field limits, found from word trigrams in pure SQL.

Every text becomes words, numbers (all as one token), single ideographs, marks and ends of lines.  A
trigram ends where a text, a line or a sentence ends after it, and goes on where anything else follows
or where its third word is only the beginning of a longer one: ``to the not`` goes on wherever ``to the
notch`` stands.  The last trigram of every text is joined to these counts; a text is cut when its last
trigram goes on often and almost never ends.

It is one statistic: the share of ends among the occurrences of the last three tokens, smoothed by the
same share of the last two, that by the share of the last one, that by the share of all tokens.  What a
text itself adds is taken off, so that a text does not vouch for its own end; copies count once.  In a
last line that opens as only last lines do (keywords, signatures) the share of the last word alone will do.

Marks of omission (dots, ``[more]``, a broken character) are taken off first and raise the share below
which an end is a cut, and so does a length at which most of a source's texts of that length or more
end.  A last line that is a table row has no words to tell: it is cut when its last cell is open or
cells of the row above are missing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryweave.plans import materialise

#: Smoothed share of ends below which a last trigram tells of a cut; the same with a mark or at a field limit.
SHARE, MARKED_SHARE = 0.02, 0.6
#: Weight of the next shorter n-gram, in occurrences.
PRIOR = 1.0
#: Texts whose last lines open alike, and their share of all lines that open so, that make them closing lines.
LEAST_CLOSED, CLOSED_PART = 3, 0.8
#: Texts of one length that make it a field limit, and their share of the source's texts of that length or more.
LIMIT_TEXTS, LIMIT_PART = 5, 0.5
#: A last trigram with more than one in this many texts is looked up in a broadcast table of at most as many rows.
HOT_SHARE = 512
#: Letters of one token at most; a longer run of letters is several tokens.
TOKEN_LETTERS = 64

#: Words the cut may have put at the end in brackets (fixed values).
OMISSION_WORDS = ["more", "continued", "truncated", "cut", "fortsetzung", "gekürzt", "weiter", "未完", "更多", "…", "..."]

_TOKEN = rf"[a-zß-öø-ÿ]{{1,{TOKEN_LETTERS}}}|\p{{IsHan}}|\p{{N}}+(?:[.,]\p{{N}}+)*|[\p{{L}}\p{{M}}]{{1,{TOKEN_LETTERS}}}|\n|\S"
_OMITTED = "|".join(w.replace(".", r"\.") for w in OMISSION_WORDS)
_MARK = r"(?i)(?:(?:…|\.\.\.)\s*)?[(\[](?:" + _OMITTED + r")[)\]]$|(?:…|\.\.\.)$"
#: What counts as blank at the end of a text.
_BLANKS = "".join(map(chr, [0, *range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]))
_BLANK = "decode(unhex('" + _BLANKS.encode().hex() + "'), 'UTF-8')"
_BROKEN = "decode(unhex('efbfbd'), 'UTF-8')"
_STOPS = "('\n', '.', '!', '?', '。', '！', '？')"

#: Last bytes that a blank may have (others need no look), in hexadecimal.
_BLANK_BYTES = "(" + ", ".join(f"'{x:02X}'" for x in sorted({c.encode()[-1] for c in _BLANKS})) + ")"


def _trimmed(text: str) -> str:
    """SQL: a text without blanks at its end."""
    return f"IF(hex(substring(CAST({text} AS BINARY), -1, 1)) IN {_BLANK_BYTES}, rtrim({_BLANK}, {text}), {text})"


#: Every text's tokens without blanks and marks of omission at the end, and what else its end shows.
_TOKENS = rf"""
SELECT row_id, source, copy, n_chars, n_bytes, IF(octet_length(bare) = n_bytes, n_chars, length(bare)) AS n_bare, IF(mark <> '' OR broken, length(body), n_chars) AS n_body, mark <> '' OR broken AS marked, broken,
       startswith(ltrim(last_line), '|') AS in_table,
       startswith(ltrim(last_line), '|') AND (NOT endswith(last_line, '|') OR (startswith(ltrim(line_before), '|') AND length(last_line) - length(replace(last_line, '|', '')) < length(line_before) - length(replace(line_before, '|', '')))) AS row_open,
       transform(concat(array('^', '^'), regexp_extract_all(lower(body), r'{_TOKEN}', 0)), x -> IF(x >= '0' AND x < ':', '#', x)) AS t
FROM (
  SELECT *, substring_index(body, '\n', -1) AS last_line, substring_index(substring_index(body, '\n', -2), '\n', 1) AS line_before
  FROM (
    SELECT *, IF(mark = '', whole, rtrim({_BLANK}, left(whole, length(whole) - length(mark)))) AS body
    FROM (
      SELECT *, IF(endswith(whole, '…') OR endswith(whole, ')') OR endswith(whole, ']') OR endswith(whole, '...'), regexp_extract(whole, r'{_MARK}', 0), '') AS mark
      FROM (
        SELECT *, endswith(bare, {_BROKEN}) AS broken, IF(endswith(bare, {_BROKEN}), rtrim(concat({_BLANK}, {_BROKEN}), bare), bare) AS whole
        FROM (
          SELECT row_no AS row_id, source_name AS source, xxhash64(body_text) AS copy, length(body_text) AS n_chars, octet_length(body_text) AS n_bytes, {_trimmed("body_text")} AS bare
          FROM {{texts}} WHERE body_text IS NOT NULL)))))
"""

#: The same without the tokens: the last three, and how the last of several lines opens.
_ENDS = r"""
SELECT * EXCEPT (t, from_end), xxhash64(get(t, size(t) - 3), get(t, size(t) - 2)) AS ab, xxhash64(get(t, size(t) - 2)) AS b, get(t, size(t) - 1) AS c,
       IF(from_end > 2, xxhash64('\n', get(t, size(t) - from_end + 1)), NULL) AS oab, IF(from_end > 2, get(t, size(t) - from_end + 2), NULL) AS oc
FROM (SELECT *, array_position(reverse(t), '\n') AS from_end FROM {tokens} WHERE size(t) > 2)
"""

#: Trigrams inside texts: how often each stands, and how often an end follows.
_INSIDE = rf"""
SELECT xxhash64(a, b) AS ab, xxhash64(b) AS b, c, sum(IF(d IN {_STOPS}, 1, 0)) AS ended, count(*) AS n
FROM (SELECT inline(arrays_zip(t, slice(t, 2, size(t)), slice(t, 3, size(t)), slice(t, 4, size(t)))) AS (a, b, c, d) FROM {{tokens}})
WHERE d IS NOT NULL AND c <> '\n'
GROUP BY xxhash64(a, b), xxhash64(b), c
"""

#: Last trigrams, the texts that end with each (copies once), and the keys of their three levels.
_FINALS = """
SELECT *, xxhash64(3, ab, c) AS k3, xxhash64(2, b, c) AS k2, xxhash64(1, c) AS k1
FROM (
  SELECT ab, b, c, count(DISTINCT copy) AS texts, count(*) AS n_rows
  FROM {ends}
  GROUP BY ab, b, c)
"""


def _beginnings(level: int, context: str, rows: str) -> str:
    """SQL: a gram goes on where its last word is the beginning of a longer one, and ends or goes on where it is the whole."""
    hashed = f"xxhash64({level}, {context}left(c, i))"
    spread = r"explode(IF(c RLIKE r'^[\p{L}\p{M}]', sequence(1, length(c)), array(length(c)))) AS i"
    return f"SELECT {hashed} AS k, IF(i = length(c), n - ended, n) AS went_on, IF(i = length(c), ended, 0) AS ended, false AS wanted FROM (SELECT *, {spread} FROM {rows})"


#: Counts of the grams that end some text, on three levels.
_COUNTS = f"""
SELECT k, sum(went_on) AS went_on, sum(ended) AS ended
FROM (
  {_beginnings(3, "ab, ", "(SELECT ab, c, n, ended FROM {inside} LEFT SEMI JOIN {finals} USING (ab))")}
  UNION ALL {_beginnings(2, "b, ", "(SELECT b, c, sum(n) AS n, sum(ended) AS ended FROM {inside} LEFT SEMI JOIN {finals} USING (b) GROUP BY b, c)")}
  UNION ALL {_beginnings(1, "", "(SELECT c, sum(n) AS n, sum(ended) AS ended FROM {inside} GROUP BY c)")}
  UNION ALL SELECT explode(array(k3, k2, k1)) AS k, 0 AS went_on, texts AS ended, true AS wanted FROM {{finals}})
GROUP BY k HAVING bool_or(wanted)
"""

#: One row for each level of each last trigram with the counts of its gram; keys that many share are looked up in a broadcast table.
_LEVELS = f"""
WITH keyed AS (SELECT ab, c, inline(array(named_struct('level', 3, 'k', k3), named_struct('level', 2, 'k', k2), named_struct('level', 1, 'k', k1))) FROM {{finals}}
), hot AS (SELECT k FROM keyed GROUP BY k HAVING count(*) * {HOT_SHARE} > (SELECT count(*) FROM keyed)
), known AS (SELECT k, went_on, ended FROM {{counts}} LEFT SEMI JOIN hot USING (k))
SELECT ab, c, level, went_on, ended FROM (SELECT /*+ BROADCAST(known) */ ab, c, level, known.went_on, known.ended FROM keyed JOIN known ON known.k = keyed.k)
UNION ALL SELECT ab, c, level, went_on, ended FROM (SELECT /*+ BROADCAST(hot) */ * FROM keyed LEFT ANTI JOIN hot ON hot.k = keyed.k) JOIN {{counts}} USING (k)
"""

#: The smoothed share of ends of each last trigram, without the text itself.
_SHARES = f"""
SELECT ab, c, n3, n2, n1, n3 - went3 AS ended3, went3, p1, (n3 - went3 + {PRIOR} * (ended2 + {PRIOR} * p1) / (n2 + {PRIOR})) / (n3 + {PRIOR}) AS share
FROM (
  SELECT *, (ended1 + {PRIOR} * p0) / (n1 + {PRIOR}) AS p1
  FROM (
    SELECT ab, c, max(IF(level = 3, went_on, 0)) AS went3, max(IF(level = 3, went_on + ended - 1, 0)) AS n3,
           max(IF(level = 2, ended - 1, 0)) AS ended2, max(IF(level = 2, went_on + ended - 1, 0)) AS n2,
           max(IF(level = 1, ended - 1, 0)) AS ended1, max(IF(level = 1, went_on + ended - 1, 0)) AS n1
    FROM {{levels}} GROUP BY ab, c),
  (SELECT coalesce(sum(ended) / sum(n), 0) AS p0 FROM {{inside}}))
"""

_JUDGED = rf"""
WITH lengths AS (
  SELECT source, copy, explode(array(named_struct('kind', 'c', 'size', IF(marked, n_body, n_chars)), named_struct('kind', 'b', 'size', IF(marked, NULL, n_bytes)))) AS x FROM {{ends}}
), sized AS (SELECT source, x.kind, x.size, count(DISTINCT copy) AS m FROM lengths WHERE x.size IS NOT NULL AND source IS NOT NULL GROUP BY source, x.kind, x.size
), limits AS (
  SELECT source, kind, size FROM (SELECT *, sum(m) OVER (PARTITION BY source, kind ORDER BY size DESC) AS as_long FROM sized)
  WHERE m >= {LIMIT_TEXTS} AND m >= {LIMIT_PART} * as_long
), openings AS (SELECT oab, oc, count(DISTINCT copy) AS closed FROM {{ends}} WHERE oc IS NOT NULL GROUP BY oab, oc HAVING count(DISTINCT copy) >= {LEAST_CLOSED}
), closing AS (
  SELECT oab, oc FROM openings LEFT JOIN (SELECT ab, c, sum(n) AS n FROM {{inside}} LEFT SEMI JOIN openings ON openings.oab = ab AND openings.oc = c GROUP BY ab, c) ON ab = oab AND c = oc
  WHERE closed >= {CLOSED_PART} * coalesce(n, 0)
), closers AS (SELECT DISTINCT row_id AS closer FROM {{ends}} e LEFT SEMI JOIN closing ON closing.oab = e.oab AND closing.oc = e.oc
), ends AS (
  SELECT row_id, l.source, marked, broken, in_table, row_open, ab, c, closer IS NOT NULL AS in_closing,
         (lc.source IS NOT NULL OR lb.source IS NOT NULL) AND (marked OR n_bare >= n_chars - 1) AS at_limit
  FROM {{ends}} l LEFT JOIN closers ON closers.closer = l.row_id
  LEFT JOIN limits lc ON lc.source = l.source AND lc.kind = 'c' AND lc.size = IF(l.marked, l.n_body, l.n_chars)
  LEFT JOIN limits lb ON lb.source = l.source AND lb.kind = 'b' AND lb.size = IF(l.marked, NULL, l.n_bytes)
), hot AS (SELECT ab, c FROM {{finals}} WHERE n_rows * {HOT_SHARE} > (SELECT sum(n_rows) FROM {{finals}})
), known AS (SELECT s.* FROM {{shares}} s LEFT SEMI JOIN hot ON hot.ab = s.ab AND hot.c = s.c
), joined AS (
  SELECT /*+ BROADCAST(known) */ ends.*, n3, n2, n1, ended3, went3, p1, share FROM ends JOIN known ON known.ab = ends.ab AND known.c = ends.c
  UNION ALL SELECT rest.*, n3, n2, n1, ended3, went3, p1, share FROM (SELECT /*+ BROADCAST(hot) */ * FROM ends LEFT ANTI JOIN hot ON hot.ab = ends.ab AND hot.c = ends.c) rest JOIN {{shares}} s ON s.ab = rest.ab AND s.c = rest.c
), judged AS (
  SELECT *, CASE WHEN in_table THEN row_open ELSE greatest(share, IF(in_closing, p1, 0)) < IF((marked OR at_limit) AND NOT c RLIKE r'^[.!?。！？]$', {MARKED_SHARE}, {SHARE}) END AS incomplete,
         CASE WHEN in_table THEN 'table row' WHEN n3 > 0 THEN 'trigram' WHEN n2 > 0 THEN 'bigram' WHEN n1 > 0 THEN 'word' ELSE 'mark or limit' END AS level
  FROM joined
)
SELECT DISTINCT row_id, source, incomplete OR broken AS cut, IF(incomplete, level, IF(broken, 'broken character', NULL)) AS decided_by, went3 AS seen_inside, ended3 AS seen_terminal, share, at_limit, marked FROM judged
"""


def _query(spark: SparkSession, statement: str, **tables: DataFrame) -> DataFrame:
    """A statement over tables named in braces."""
    views = {name: f"{name}_{uuid.uuid4().hex}" for name in tables}
    for name, view in views.items():
        tables[name].createOrReplaceTempView(view)
        statement = statement.replace("{" + name + "}", view)
    try:
        return spark.sql(statement)
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)


def judge_ends(texts: DataFrame, row: str, text: str, source: str) -> DataFrame:
    """``(row_id, source, cut, decided_by, seen_inside, seen_terminal, share, at_limit, marked)`` of every text with a visible character.

    Null, empty and blank texts are not judged, nor are texts of nothing but marks of omission.  Copies
    of one text count once as an end.  A null source has no field limit.  Other columns are ignored;
    repeated rows give one.
    """
    spark = texts.sparkSession
    named = texts.selectExpr(f"`{row}` AS row_no", f"`{text}` AS body_text", f"`{source}` AS source_name")
    tokens = materialise(_query(spark, _TOKENS, texts=named), "tokens")
    inside = materialise(_query(spark, _INSIDE, tokens=tokens), "trigrams")
    ends = materialise(_query(spark, _ENDS, tokens=tokens), "ends")
    finals = materialise(_query(spark, _FINALS, ends=ends), "finals")
    counts = materialise(_query(spark, _COUNTS, inside=inside, finals=finals), "counts")
    levels = _query(spark, _LEVELS, finals=finals, counts=counts)
    shares = materialise(_query(spark, _SHARES, levels=levels, inside=inside), "shares")
    return _query(spark, _JUDGED, ends=ends, finals=finals, shares=shares, inside=inside)


def truncation_rates(judged: DataFrame) -> DataFrame:
    """Texts, cut texts and their share for each source."""
    cut = F.col("cut").cast("int")
    return judged.groupBy("source").agg(F.count("*").alias("texts"), F.sum(cut).alias("cut_texts"), F.round(F.avg(cut), 6).alias("cut_share"))
