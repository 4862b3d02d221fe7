"""Looking nodes up by id, label or part of their name."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def resolve_nodes(nodes: DataFrame, asked: DataFrame) -> DataFrame:
    """``(kind, value, status, node)`` of every distinct ``asked(kind, value)`` among ``nodes(node, label)``.

    ``kind`` is ``id`` or ``label``; a label must agree exactly.  A value that several nodes have is
    ``ambiguous`` and gets none of them, one that no node has is ``unresolved``.  Null values are not asked.
    """
    known = nodes.filter("node is not null").select("node", F.explode(F.array(F.struct(F.lit("id").alias("kind"), F.col("node").alias("value")), F.struct(F.lit("label").alias("kind"), F.col("label").alias("value")))).alias("x"))
    known = known.select("x.kind", "x.value", "node").filter("value is not null")
    # the least and the greatest node tell whether there are several, without gathering them
    held = known.groupBy("kind", "value").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    found = asked.select("kind", "value").filter("value is not null").distinct().join(held, ["kind", "value"], "left")
    status = F.when(F.col("least").isNull(), "unresolved").when(F.col("least") == F.col("most"), "match").otherwise("ambiguous")
    return found.select("kind", "value", status.alias("status"), F.when(status == "match", F.col("least")).alias("node"))


def search_nodes(nodes: DataFrame, name: str, order: str, text: str, mode: str = "contains", kind: tuple[str, str] | None = None, limit: int = 50) -> DataFrame:
    """The first rows by name, whatever the case, whose name is or contains a text; ``more`` tells that there are others.

    ``mode`` is ``exact`` or ``contains``, the text's own ``%`` and ``_`` are plain characters.  ``kind``
    names a column and the value it must have.
    """
    plain = text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    rows = nodes.filter(F.col(name).ilike(plain if mode == "exact" else f"%{plain}%"))
    if kind:
        rows = rows.filter(F.col(kind[0]) == kind[1])
    ahead = rows.orderBy(F.lower(name), order).limit(limit + 1)
    # limit + 1 rows at most
    counted = ahead.withColumn("more", F.count("*").over(Window.partitionBy(F.lit(1))) > limit)
    return counted.orderBy(F.lower(name), order).limit(limit)
