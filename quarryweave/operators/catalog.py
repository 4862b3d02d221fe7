"""Catalog records: identities, preferred merging, canonical copies and versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The name space of names that are URLs, as sixteen bytes (fixed value of RFC 4122).
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(name: Column, namespace: str = URL_NAMESPACE) -> Column:
    """The version 5 UUID of a name, computed inside the plan."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3)) + F.lit(8)))
    part = lambda a, n: F.substring(digest, a, n)
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12))


def version_key(*parts: Column) -> Column:
    """SHA-256 of parts joined by NUL, a null part being empty."""
    return F.sha2(F.concat_ws("\x00", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)), 256)


def merge_preferred(rows: DataFrame, keys: list[str], order: list[Column], fields: list[str], weak: dict[str, list[str]] | None = None) -> DataFrame:
    """One row for each key: of every field the last value in ``order`` that is neither null, blank nor weak; else the last weak one."""
    place = F.struct(*order)
    picked = []
    for f in fields:
        text = F.trim(F.col(f).cast("string"))
        solid = (text != "") & ~F.lower(text).isin(*((weak or {}).get(f) or ["\x00"]))
        # of the rows with a value, one that is not weak, then the last one
        rank = F.when(text != "", F.struct(F.when(solid, 1).otherwise(0).alias("s"), place.alias("p")))
        picked.append(F.max_by(F.col(f), rank).alias(f))
    return rows.groupBy(*keys).agg(*picked)


def completeness(fields: list[str]) -> Column:
    """How many of the fields are neither null nor blank."""
    return sum((F.when(F.trim(F.col(f).cast("string")) != "", 1).otherwise(0) for f in fields), F.lit(0))


def canonical_copies(rows: DataFrame, row: str, digest: str, fields: list[str], primary: Column) -> DataFrame:
    """``(row, canonical_row)`` of every row whose digest others share: most complete, then primary, then smallest row."""
    ranked = rows.filter(F.col(digest).isNotNull()).select(row, digest, F.struct((-completeness(fields)).alias("c"), F.when(primary, 0).otherwise(1).alias("p"), F.col(row).alias("r")).alias("key"))
    best = ranked.groupBy(digest).agg(F.min("key").alias("best"), F.count("*").alias("n")).filter("n > 1")
    return ranked.join(best, digest).select(row, F.col("best.r").alias("canonical_row"))


def versions(rows: DataFrame, row: str, work: str, digest: str, fields: list[str], primary: Column) -> DataFrame:
    """``(row, version_of)``: of the different contents of one work, each points to the best one."""
    held = rows.filter(F.col(work).isNotNull() & F.col(digest).isNotNull())
    key = F.struct((-completeness(fields)).alias("c"), F.when(primary, 0).otherwise(1).alias("p"), F.col(row).alias("r"))
    each = held.groupBy(work, digest).agg(F.min(key).alias("key"))
    best = each.groupBy(work).agg(F.min("key").alias("best"), F.count("*").alias("n")).filter("n > 1")
    return each.join(best, work).filter(F.col("key.r") != F.col("best.r")).select(F.col("key.r").alias(row), F.col("best.r").alias("version_of"))
