"""Portable artifacts: JSON lines in a fixed order, packed vectors and edge pairs in numbered parts."""

from __future__ import annotations

import os
from urllib.parse import urlparse

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, order: list[str]) -> None:
    """One JSON object a line, sorted by ``order`` over all parts, nulls kept."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def _local(path: str) -> str:
    return urlparse(path).path if path.startswith("file:") else path


def _write_packed(rows: DataFrame, path: str, order: str, pack) -> None:
    target = _local(path)
    os.makedirs(target, exist_ok=True)

    def part(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        count = 0
        with open(os.path.join(target, f".part-{number:05d}.writing"), "wb") as f:
            for batch in batches:
                f.write(pack(batch))
                count += len(batch)
        os.replace(os.path.join(target, f".part-{number:05d}.writing"), os.path.join(target, f"part-{number:05d}.bin"))
        yield pd.DataFrame({"part": [number], "records": [count]})

    rows.repartitionByRange(order).sortWithinPartitions(order).mapInPandas(part, "part int, records long").write.format("noop").mode("overwrite").save()


def write_vectors(df: DataFrame, path: str, order: str, vector: str) -> None:
    """Vectors as little-endian half floats, in order, on a folder all tasks share; a part appears when it is whole."""
    _write_packed(df.select(order, vector), path, order, lambda b: np.array(b.iloc[:, 1].tolist(), dtype="<f2").tobytes())


def write_edge_pairs(df: DataFrame, path: str, left: str, right: str) -> None:
    """Pairs of node numbers as little-endian unsigned 32-bit integers, ordered by the left one."""
    _write_packed(df.select(left, right), path, left, lambda b: b.to_numpy().astype("<u4").tobytes())
