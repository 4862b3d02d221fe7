"""One spelling for every way a DOI is written."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Suffixes that stand for "no DOI yet" (fixed values); runs of x, of 0 and of dashes also do.
PLACEHOLDER_SUFFIXES = ["unknown", "placeholder", "tbd", "none", "null", "na", "n/a", "nan", "pending", "todo", "missing", "test", "dummy"]

_WIDE = "".join(chr(0xFF01 + i) for i in range(94))
_NARROW = "".join(chr(0x21 + i) for i in range(94))


#: Balanced text before marks and brackets that close nothing: ``a(1))`` is ``a(1)``.
CLOSING = r"^((?:[^()\[\]{}]|\((?:[^()]|\([^()]*\))*\)|\[[^\[\]]*\]|\{[^{}]*\})*?)[.,;:!?'>)\]}]+$"


def doi_key(value: Column) -> Column:
    """Lower-case ``10.prefix/suffix`` of any spelling; null for null, blank, placeholders and texts without a DOI.

    Resolver addresses, ``doi:`` labels, angle brackets, white space, percent escapes, full-width
    forms, upper case, punctuation and brackets that close nothing at the end are spellings.
    """
    narrow = F.regexp_replace(F.translate(value, _WIDE, _NARROW), r"(?U)[\s\x{200B}\x{FEFF}]+", "")
    plain = F.when(narrow.rlike("%[0-9A-Fa-f]{2}"), F.coalesce(F.try_url_decode(F.replace(narrow, F.lit("+"), F.lit("%2B"))), narrow)).otherwise(narrow)
    doi = F.regexp_extract(F.lower(plain), r'(10\.[0-9]{4,9}(?:\.[0-9]+)*/[^<>"{}|^`\\]+)', 1)
    doi = F.regexp_replace(F.regexp_replace(doi, r"[.,;:!?'>]+$", ""), CLOSING, "$1")
    suffix = F.regexp_extract(doi, r"^[^/]*/(.*)$", 1)
    hollow = suffix.isin("", *PLACEHOLDER_SUFFIXES) | suffix.rlike(r"^(x+|0+|[-_.]+)$")
    return F.when(hollow, F.lit(None)).otherwise(doi)
