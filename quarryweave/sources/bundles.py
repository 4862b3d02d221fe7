"""Bundles: several tables as JSON lines with a manifest of their counts and digests; SQLite tables read in parts."""

from __future__ import annotations

import json
import re
import sqlite3
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryweave.sources.artifacts import write_jsonl

MANIFEST = "manifest.json"


def table_digest(df: DataFrame) -> DataFrame:
    """One row ``(rows, digest)``, the same whatever the order of rows: digests of rows, sorted in 65,536 buckets, and of the buckets.

    A bucket holds as many digests as there are rows for each of its beginnings, a share of 1 in 65,536;
    equal rows are counted, so that copies of one row do not gather.
    """
    line = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    lines = df.select(line.alias("d")).groupBy("d").agg(F.count("*").alias("n"))
    buckets = lines.groupBy(F.substring("d", 1, 4).alias("bucket")).agg(F.sum("n").alias("rows"), F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat("d", F.lit(":"), F.col("n").cast("string")))), ","), 256).alias("d"))
    whole = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "d"))), lambda x: x["d"]), ","), 256)
    return buckets.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), whole.alias("digest"))


def write_bundle(tables: dict[str, tuple[DataFrame, list[str]]], path: str, **facts: str) -> dict:
    """Each table, in its order, as JSON lines under ``path``, then the manifest, which makes the bundle whole."""
    spark = next(iter(tables.values()))[0].sparkSession
    entries = {}
    for name, (df, order) in sorted(tables.items()):
        write_jsonl(df, f"{path}/{name}.jsonl", order)
        one = table_digest(df).first()
        entries[name] = {"rows": one["rows"], "digest": one["digest"], "columns": [list(c) for c in df.dtypes]}
    manifest = {"tables": entries, "facts": facts}
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{MANIFEST}")
    return manifest


def read_bundle(spark: SparkSession, path: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """The tables of a bundle, each compared with the manifest; another number of rows, other content or other tables than ``names`` raise."""
    manifest = json.loads(spark.read.text(f"{path}/{MANIFEST}").first()["value"])
    if names is not None and set(names) != set(manifest["tables"]):
        raise ValueError(f"the bundle holds {sorted(manifest['tables'])}")
    out = {}
    for name, entry in manifest["tables"].items():
        df = spark.read.schema(", ".join(f"`{c}` {t}" for c, t in entry["columns"])).json(f"{path}/{name}.jsonl")
        one = table_digest(df).first()
        if (one["rows"], one["digest"]) != (entry["rows"], entry["digest"]):
            raise ValueError(f"{name} is not what the manifest says")
        out[name] = df
    return out


def read_sqlite(spark: SparkSession, path: str, table: str, schema: str, parts: int = 8) -> DataFrame:
    """A table of an SQLite file that every executor can reach, opened read-only and read by ranges of row numbers.

    Columns the table lacks raise.
    """
    if not re.fullmatch(r"\w+", table):
        raise ValueError("not the name of a table")
    columns = [f.name for f in spark.createDataFrame([], schema).schema]
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        known = {r[1] for r in db.execute(f'PRAGMA table_info("{table}")')}
        if set(columns) - known:
            raise ValueError(f"{table} has no {', '.join(sorted(set(columns) - known))}")
        low, high = db.execute(f'SELECT min(rowid), max(rowid) FROM "{table}"').fetchone()
    if low is None:
        return spark.createDataFrame([], schema)
    step = -(-(high - low + 1) // parts)
    named = ", ".join(f'"{c}"' for c in columns)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in batch["id"]:
                begin = low + int(part) * step
                with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
                    rows = db.execute(f'SELECT {named} FROM "{table}" WHERE rowid >= ? AND rowid < ?', (begin, begin + step))
                    while chunk := rows.fetchmany(10_000):
                        yield pd.DataFrame(chunk, columns=columns)

    return spark.range(0, parts, 1, parts).mapInPandas(read, schema)
