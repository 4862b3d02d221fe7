"""References to records that do not exist, at the time they were made.

Parent and child keys are united in one tagged long form and grouped by parent table and key; a
group without a parent holds only orphans.  Within a group the rows are read in the order of time,
parents first, carrying forward the latest end of life of the parents seen so far: a reference made
before that end is live.  A key that many references share is dealt into parts, each of which gets the
key's parents, so that no task holds all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryweave.functions.keys import normal_name_udf
from quarryweave.plans import materialise

#: A key with more than one in this many references is dealt into parts, each of about as many.
HOT_SHARE = 512

_FOREVER = "timestamp '9999-12-31 23:59:59'"


def long_form(children: DataFrame, parents: DataFrame) -> DataFrame:
    """Tagged union of ``children(ref_table, ref_field, ref_row, ref_key, parent_table, key, at)`` and ``parents(parent_table, key, born, died)``, keys in normal form."""
    child = children.select("parent_table", "key", "at", F.lit(None).cast("timestamp").alias("died"), F.lit(False).alias("is_parent"), "ref_table", "ref_field", "ref_row", "ref_key")
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("ref_table", "string"), ("ref_field", "string"), ("ref_row", "long"), ("ref_key", "string"))]
    parent = parents.select("parent_table", "key", F.col("born").alias("at"), F.coalesce("died", F.expr(_FOREVER)).alias("died"), F.lit(True).alias("is_parent"), *nothing)
    return child.unionByName(parent)


def hot_keys(refs: DataFrame) -> DataFrame:
    """``(parent_table, key, parts)`` of keys that many references share; at most HOT_SHARE rows, as their shares add up to one."""
    counted = refs.groupBy("parent_table", "key").agg(F.count("*").alias("n"))
    total = refs.agg(F.count("*").alias("total")).scalar()
    hot = counted.filter(F.col("n") * HOT_SHARE > F.greatest(total, F.lit(100 * HOT_SHARE)))
    return hot.select("parent_table", "key", F.ceil(F.col("n") * HOT_SHARE / total).cast("int").alias("parts"))


def orphan_references(children: DataFrame, parents: DataFrame) -> DataFrame:
    """``(ref_table, ref_field, ref_row, ref_key, reason, at)`` of the references without a live parent.

    Keys are equal when their normal names are.  A parent lives from ``born`` up to, not including,
    ``died``; a null ``died`` is never, a null ``born`` always was.  A reference without a time can
    only be ``missing``.  Null references are none; an empty text is one.  Reason: ``missing`` without
    any parent row, ``late`` when all are born after it, else ``deleted``.  Repeated rows give one.
    """
    refs = children.filter("ref_key is not null").withColumn("key", normal_name_udf("ref_key"))
    # the normal form is computed once and serves the count of hot keys and the groups
    refs = materialise(refs, "references")
    hot = F.broadcast(hot_keys(refs))

    named = parents.filter("key is not null").select("parent_table", "key", "born", "died").distinct().withColumn("key", normal_name_udf("key"))
    rows = long_form(refs, named).join(hot, ["parent_table", "key"], "left")
    parts = F.coalesce("parts", F.lit(1))
    dealt = F.when(F.col("is_parent"), F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.pmod(F.hash("ref_row", "ref_field"), parts)))
    rows = rows.withColumn("part", F.explode(dealt)).drop("parts")

    group = Window.partitionBy("parent_table", "key", "part")
    by_time = group.orderBy(F.col("at").asc_nulls_first(), F.col("is_parent").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    read = rows.withColumn("ends", F.max(F.when(F.col("is_parent"), F.col("died"))).over(by_time))
    read = read.withColumn("any_parent", F.max("is_parent").over(group))
    orphan = read.filter(~F.col("is_parent") & (~F.col("any_parent") | (F.col("at").isNotNull() & (F.col("ends").isNull() | (F.col("ends") <= F.col("at"))))))
    reason = F.when(~F.col("any_parent"), "missing").when(F.col("ends").isNull(), "late").otherwise("deleted")
    return orphan.select("ref_table", "ref_field", "ref_row", "ref_key", reason.alias("reason"), "at").distinct()


def orphan_counts(orphans: DataFrame) -> DataFrame:
    """Orphans per table, field, month of the reference and reason."""
    month = F.date_format("at", "yyyy-MM").alias("month")
    return orphans.groupBy("ref_table", "ref_field", month, "reason").agg(F.count("*").alias("orphans"))
