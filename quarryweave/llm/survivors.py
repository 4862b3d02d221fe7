"""One surviving record for each group of duplicate records, by Pareto dominance.

A record dominates another when it has every field the other has, is at least as trusted and at
least as recent, and more of one of these two (records alike in both are told apart by their numbers,
field by field).  The undominated records are the first layer; taking them away bares the next.  Each field takes its value from the first layer that has it, there
from the most trusted, then the most recent record.

Before anything is gathered, each group is reduced to the best record for every set of present
fields and trust rank, which bounds what one group holds (``2 ** fields`` times the trust ranks), so
that a group with a third of all rows costs no more than any other.  The reduction keeps every
undominated record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Trust rank of a root that the rank table lacks.
UNRANKED = 2_000_000_000


def _dominates(q: Column, r: Column) -> Column:
    covers = q["mask"].bitwiseAND(r["mask"]) == r["mask"]
    no_worse = (q["trust"] <= r["trust"]) & (q["seen"] >= r["seen"])
    better = (q["trust"] < r["trust"]) | (q["seen"] > r["seen"])
    return covers & no_worse & better


def _filled(rest: Column, fields: int, row_type: str) -> Column:
    """For each field the row it is taken from: layer after layer is taken off, and fills what the ones before left open."""
    start = F.struct(rest.alias("rest"), F.array_repeat(F.lit(None).cast(row_type), fields).alias("picks"))

    def step(state: Column, depth: Column) -> Column:
        left = state["rest"]
        # the last layer is what is left; nothing is peeled once all fields are filled
        top = F.when(depth == fields, left).otherwise(F.filter(left, lambda r: ~F.exists(left, lambda q: _dominates(q, r))))
        open_ = F.exists(state["picks"], lambda x: x.isNull())
        deeper = F.when(depth == fields, F.slice(left, 1, 0)).otherwise(F.filter(left, lambda r: F.exists(left, lambda q: _dominates(q, r))))

        def fill(pick: Column, i: Column) -> Column:
            having = F.filter(top, lambda r: F.call_function("shiftright", r["mask"], i).bitwiseAND(F.lit(1)) == 1)
            keyed = F.transform(having, lambda r: F.struct(r["trust"].alias("t"), (-r["seen"]).alias("s"), r["row"].alias("row")))
            return F.coalesce(pick, F.array_min(keyed)["row"])

        filled = F.struct(deeper.alias("rest"), F.transform(state["picks"], fill).alias("picks"))
        return F.when(open_ & (F.size(left) > 0), filled).otherwise(state)

    return F.aggregate(F.sequence(F.lit(0), F.lit(fields)), start, step, lambda state: state["picks"])


def surviving_values(records: DataFrame, group: str, row: str, trust: str, seen: str, usable: dict[str, Column]) -> DataFrame:
    """One row ``(group, field_name, row)`` for each group and field with a usable value.

    ``usable`` says for each field which rows have a value.  Of rows equal in trust and time the
    smallest ``row`` wins; null trust counts as the least, null time as the oldest.  Groups of one row
    are left to the caller.
    """
    fields = list(usable)
    mask = sum((F.when(F.coalesce(on, F.lit(False)), F.lit(1 << i)).otherwise(F.lit(0)) for i, on in enumerate(usable.values())), F.lit(0))
    ranked = records.select(
        F.col(group).alias("grp"),
        F.col(row).alias("row"),
        mask.cast("int").alias("mask"),
        F.coalesce(F.col(trust).cast("int"), F.lit(UNRANKED)).alias("trust"),
        F.coalesce(F.unix_micros(F.col(seen).cast("timestamp")), F.lit(-(2**62))).alias("seen"),
    ).filter("mask > 0 and grp is not null")
    best = ranked.groupBy("grp", "mask", "trust").agg(F.max(F.struct("seen", (-F.col("row")).alias("minus"))).alias("top"))
    best = best.select("grp", F.struct("mask", "trust", F.col("top.seen").alias("seen"), (-F.col("top.minus")).alias("row")).alias("rec"))
    layered = best.groupBy("grp").agg(F.collect_list("rec").alias("rest"))
    row_type = dict(ranked.dtypes)["row"]
    picks = layered.select("grp", F.posexplode(_filled(F.col("rest"), len(fields), row_type)).alias("i", "row")).filter("row is not null")
    return picks.select(F.col("grp").alias(group), F.element_at(F.array(*map(F.lit, fields)), F.col("i") + 1).alias("field_name"), F.col("row").alias(row))
