"""Manifests of a corpus, as JSON lines or CSV, read with their own column names.

A record has a path; other known columns are recognised by any of their names, unknown ones go into
``metadata``.  Records that cannot be read come out with ``problem`` set, so that none is lost.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryweave.functions.dois import doi_key

#: Names by which a column is known (own choice).
ALIASES = {
    "relative_path": ["relative_path", "path", "file_path"],
    "display_title": ["display_title", "title"],
    "normalized_doi": ["normalized_doi", "doi"],
    "sha256": ["sha256", "digest"],
    "byte_size": ["byte_size", "size", "bytes"],
    "source_kind": ["source_kind", "kind"],
}
MOST_LINE_BYTES = 1 << 20


def record_columns(cells: Column) -> list[Column]:
    """Typed columns and the rest of a ``map<string,string>`` of cells whose keys are lower-case names."""
    named = {}
    for column, names in ALIASES.items():
        named[column] = F.coalesce(*(F.nullif(F.trim(cells[n]), F.lit("")) for n in names))
    taken = [n for names in ALIASES.values() for n in names]
    path = named["relative_path"]
    size = named["byte_size"].try_cast("bigint")
    return [
        path.alias("relative_path"),
        F.coalesce(named["display_title"], F.element_at(F.split(path, "/"), -1)).alias("display_title"),
        doi_key(named["normalized_doi"]).alias("normalized_doi"),
        F.when(F.lower(named["sha256"]).rlike("^[0-9a-f]{64}$"), F.lower(named["sha256"])).alias("sha256"),
        F.when(size >= 0, size).alias("byte_size"),
        F.coalesce(named["source_kind"], F.lit("unknown")).alias("source_kind"),
        F.map_filter(cells, lambda k, v: ~k.isin(*taken) & (F.trim(v) != "")).alias("metadata"),
    ]


def _finish(rows: DataFrame) -> DataFrame:
    out = rows.select(*record_columns(F.col("cells")), "problem")
    return out.withColumn("problem", F.coalesce("problem", F.when(F.col("relative_path").isNull(), "no path")))


def jsonl_records(lines: DataFrame) -> DataFrame:
    """Records of lines (``value``), batch or stream; blank lines are none, repeated keys and bad JSON are problems.

    Keys are repeated when they are equal as field names (``Title`` and ``title``); the record then
    comes out with ``problem`` and without cells.
    """
    parsed = lines.filter(F.trim("value") != "").select("value", F.try_parse_json("value").alias("v"))
    problem = F.when(F.octet_length("value") > MOST_LINE_BYTES, "line too long").when(F.col("v").isNull(), "not a JSON object").when(F.schema_of_variant("v").rlike("^OBJECT").__invert__(), "not a JSON object")
    entries = F.map_entries(F.coalesce(F.when(problem.isNull(), F.from_json("value", "map<string,string>")), F.create_map().cast("map<string,string>")))
    read = parsed.select(problem.alias("problem"), entries.alias("entries"))
    # all names of a record are one string for the exchange with Python
    named = read.withColumn("names", F.split(field_name_list(F.array_join(F.transform("entries", lambda e: e["key"]), "\x1f")), "\x1f"))
    repeated = (F.size("entries") > 0) & (F.size(F.array_distinct("names")) < F.size("names"))
    named = named.withColumn("problem", F.coalesce("problem", F.when(repeated, "repeated field")))
    empty = F.create_map().cast("map<string,string>")
    cells = F.when(F.col("problem").isNull() & (F.size("entries") > 0), F.map_from_arrays("names", F.transform("entries", lambda e: e["value"]))).otherwise(empty)
    return _finish(named.select(cells.alias("cells"), "problem"))


@F.pandas_udf(T.StringType())
def field_name_list(joined: pd.Series) -> pd.Series:
    """Field names of names joined by a unit separator, joined again."""
    return joined.map(lambda x: "\x1f".join(_name(n) for n in x.split("\x1f")))


def _name(raw: str) -> str:
    return re.sub(r"[\s\-.]+", "_", unicodedata.normalize("NFKC", raw).strip().casefold())


def read_jsonl_manifest(spark: SparkSession, path: str) -> DataFrame:
    return jsonl_records(spark.read.text(path))


def read_csv_manifest(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; quoted cells may hold line ends, so that one file is read by one task; rows with another number of fields are problems.

    A header that names a field twice makes every record a problem.
    """
    header = spark.read.csv(path, header=False, multiLine=True, escape='"').first()
    titles = [c or "" for c in header] if header else []
    names = [_name(c) for c in titles]
    schema = ", ".join(f"`c{i}` string" for i in range(len(names)))
    rows = spark.read.schema((schema + ", " if schema else "") + "_bad string").csv(path, header=True, enforceSchema=True, multiLine=True, escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord="_bad")
    if len(set(names)) < len(names):
        return _finish(rows.select(F.create_map().cast("map<string,string>").alias("cells"), F.lit("repeated field").alias("problem")))
    cells = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*(F.col(f"c{i}") for i in range(len(names)))))
    return _finish(rows.select(cells.alias("cells"), F.when(F.col("_bad").isNotNull(), "field count").alias("problem")))
