"""Expressions that judge or shorten a value: paths, places, secrets, labels, weights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What looks like a secret: signed tokens, provider keys, bearer headers.
SECRET = r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\b|\bsk-[A-Za-z0-9_-]{16,}\b|(?i:\bbearer\s+[A-Za-z0-9._~+/=-]{16,})"
#: What names a place inside a network: drives, shares, file and share addresses.
INTERNAL_PLACE = r"(?i)(?:^|[\s\"'(=])(?:[a-z]:[\\/]|\\\\[^\\\s]+\\|(?:file|smb|nfs|afp|nas)://)"


def relative_path(path: Column) -> Column:
    """The path below a root in plain form, null when it is none: empty, with an address, a drive, from the root, or leading out."""
    plain = F.replace(F.trim(path), F.lit("\\"), F.lit("/"))
    bad = (plain == "") | plain.contains("\x00") | plain.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | plain.startswith("/") | plain.rlike(r"(?:^|/)\.\.(?:/|$)")
    tidy = F.regexp_replace(F.regexp_replace(F.regexp_replace(plain, r"(?:(?<=/)|^)\./", ""), r"/{2,}", "/"), r"(?<=.)/\.?$", "")
    return F.when(~bad, tidy)


def bounded_label(text: Column, most: int = 160) -> Column:
    """The text with single spaces, cut with an ellipsis so that it has at most so many characters."""
    compact = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    return F.when(F.length(compact) <= most, compact).otherwise(F.concat(F.substring(compact, 1, most - 1), F.lit("…")))


def mention_weight(mentions: Column) -> Column:
    """1 for one mention, growing with the logarithm; an unknown number counts as one."""
    return 1.0 + 0.20 * F.log(F.greatest(F.lit(1), F.coalesce(mentions.cast("long"), F.lit(1))).cast("double"))


def type_pair(left: Column, right: Column) -> Column:
    """One name for two types in either order; a missing one is ``Other``."""
    a, b = (F.coalesce(x, F.lit("Other")) for x in (left, right))
    return F.concat_ws("|", F.least(a, b), F.greatest(a, b))


def rgb(colour: Column) -> Column:
    """``array<int>`` of a colour written as ``#rrggbb``, null when it is not."""
    part = lambda at: F.conv(F.substring(colour, at, 2), 16, 10).cast("int")
    return F.when(colour.rlike(r"^#[0-9A-Fa-f]{6}$"), F.array(part(2), part(4), part(6)))
