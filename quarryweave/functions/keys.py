"""Normal forms of names and identifiers."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Opening and closing marks that enclose a quoted value (fixed values).
QUOTE_PAIRS = {'"': '"', "'": "'", "`": "`", "“": "”", "„": "“", "‘": "’", "‚": "‘", "«": "»", "»": "«", "「": "」", "『": "』"}

_PLAIN = re.compile(r"[!#-&(-_a-~]+(?: [!#-&(-_a-~]+)*")


def normal_name(value: str | None) -> str | None:
    """NFKC, trimmed, single spaces, enclosing quotes taken off, lower case; null stays null."""
    if value is None:
        return None
    if _PLAIN.fullmatch(value):
        return value.lower()
    text = " ".join(unicodedata.normalize("NFKC", value).split())
    while len(text) > 1 and QUOTE_PAIRS.get(text[0]) == text[-1]:
        text = " ".join(text[1:-1].split())
    return text.lower()


@F.pandas_udf(T.StringType())
def normal_name_udf(values: pd.Series) -> pd.Series:
    known: dict[str | None, str | None] = {}
    out = []
    for value in values:
        if value not in known:
            known[value] = normal_name(value)
        out.append(known[value])
    return pd.Series(out, dtype=object)


#: Marks that are no part of an entity's name at either end (fixed values).
NAME_EDGES = " \t\r\n\"'“”‘’`"

_PLAIN_NAME = re.compile(r"[!#-&(-_a-~]+(?: [!#-&(-_a-~]+)*")


def entity_key(name: str | None) -> str | None:
    """One key for every way an entity's name is written: NFKC, single spaces, no quotes at the ends, case folded; null stays null."""
    if name is None:
        return None
    if _PLAIN_NAME.fullmatch(name):
        return name.lower()
    return " ".join(unicodedata.normalize("NFKC", name).replace("\0", " ").split()).strip(NAME_EDGES).casefold()


@F.pandas_udf(T.StringType())
def entity_key_udf(names: pd.Series) -> pd.Series:
    codes, distinct = pd.factorize(names, use_na_sentinel=True)
    keys = pd.Series([entity_key(x) for x in distinct], dtype=object).reindex(codes)
    return keys.where(codes >= 0, None).reset_index(drop=True)


@F.pandas_udf(T.StringType())
def letters_udf(texts: pd.Series) -> pd.Series:
    """NFKC, case folded, letters and digits only: in this form a name is looked for in a text."""
    return texts.map(lambda x: None if x is None else "".join(c for c in unicodedata.normalize("NFKC", x).casefold() if c.isalnum()))


def canonical_uuid(value: Column) -> Column:
    """36 lower-case characters from any spelling that holds 32 hex digits, else the trimmed lower-case text.

    Braces, a ``urn:uuid:`` prefix, white space, missing hyphens and upper case are spellings of one
    id.  Null and blank give null.
    """
    bare = F.lower(F.regexp_replace(value, r"(?U)[\s{}\x00]+", ""))
    bare = F.regexp_replace(bare, r"^urn:", "")
    bare = F.regexp_replace(bare, r"^uuid:", "")
    digits = F.regexp_replace(bare, "-", "")
    shaped = F.regexp_replace(digits, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(bare == "", F.lit(None)).when(digits.rlike(r"^[0-9a-f]{32}$"), shaped).otherwise(bare)
