"""Filling fixed-capacity containers by linear grouping, configurations and best fit.

The plan is made from the histogram of sizes alone, which has at most as many rows as the capacity
has units, whatever the number of items:

1. Large sizes (over an eighth of the capacity) are sorted and dealt into groups of equal
   cardinality, each rounded up to its largest size, so that few sizes are left.
2. For these the linear programme over configurations (what one container holds) is solved by column
   generation; whole multiples of its configurations are opened.
3. The actual sizes take the places of the rounded ones.  What the rounding of multiples left over,
   and then the small sizes, go by decreasing size into the fullest container that has room; runs of
   like containers are handled as one, so this too depends on the capacity only.

The plan is a list of runs: so many items of one size, by rank, over so many containers in a row.
Items get their rank within their size in parts of bounded length and are joined to the runs.
"""

from __future__ import annotations

import bisect
import math
from collections import defaultdict, deque
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryweave.plans import materialise

#: Groups the large sizes are dealt into; what part of the capacity is large; units of the knapsack.
GROUPS, LARGE_PART, UNITS = 24, 8, 4096
#: Items ranked in one task.
RANKED_TOGETHER = 50_000


def best_configuration(worth: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Copies of each size in one container that are worth most (unbounded knapsack)."""
    best = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    order = np.argsort(sizes)
    sizes_, worth_ = sizes[order], worth[order]
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        fits = int(np.searchsorted(sizes_, room, side="right"))
        if fits:
            value = best[room - sizes_[:fits]] + worth_[:fits]
            k = int(value.argmax())
            if value[k] > best[room] + 1e-12:
                best[room], taken[room] = value[k], k
    copies, room = np.zeros(len(sizes), dtype=int), capacity
    while room > 0:
        if taken[room] < 0:
            room -= 1
        else:
            copies[order[taken[room]]] += 1
            room -= int(sizes_[taken[room]])
    return copies


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations of the linear programme and how many whole containers of each to open."""
    unit = max(1, math.ceil(capacity / UNITS))
    room = capacity // unit
    scaled = np.array([math.ceil(s / unit) for s in sizes])
    need = np.array(demand, dtype=float)
    base = np.diag(np.maximum(1, room // scaled)).astype(float)
    amount = need / base.diagonal()
    for _ in range(40 * len(sizes)):
        worth = np.linalg.solve(base.T, np.ones(len(sizes)))
        column = best_configuration(np.maximum(worth, 0), scaled, room)
        if worth @ column <= 1 + 1e-7:
            break
        way = np.linalg.solve(base, column.astype(float))
        steps = np.where(way > 1e-9, amount / np.where(way > 1e-9, way, 1), np.inf)
        leaves = int(steps.argmin())
        step = steps[leaves]
        amount = amount - step * way
        amount[leaves] = step
        base[:, leaves] = column
    return [(base[:, j].astype(int), int(amount[j] + 1e-6)) for j in range(len(sizes)) if amount[j] >= 1 - 1e-6]


@dataclass
class Plan:
    """Runs ``(size, first rank, items, first container, containers)`` and the containers opened."""

    capacity: int
    runs: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    opened: int = 0
    used: dict[int, int] = field(default_factory=lambda: defaultdict(int))

    def put(self, size: int, items: int, first: int, containers: int) -> None:
        self.runs.append((size, self.used[size], items, first, containers))
        self.used[size] += items

    def open(self, containers: int) -> int:
        self.opened += containers
        return self.opened - containers + 1


def plan_containers(histogram: dict[int, int], capacity: int) -> Plan:
    """A plan for items of the given sizes (1 to ``capacity``) and how many there are of each."""
    plan = Plan(capacity)
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free room: runs of (first container, containers)
    left = {s: n for s, n in histogram.items() if n > 0}
    large = sorted((s for s in left if s * LARGE_PART > capacity and s < capacity), reverse=True)
    total = sum(left[s] for s in large)
    if total:
        most, group, filled = math.ceil(total / GROUPS), 0, 0
        queues: list[deque[list[int]]] = [deque()]
        for s in large:
            n = left[s]
            while n:
                if filled == most:
                    queues.append(deque())
                    group, filled = group + 1, 0
                take = min(n, most - filled)
                queues[group].append([s, take])
                filled, n = filled + take, n - take
        rounded = [q[0][0] for q in queues]
        demand = [sum(n for _, n in q) for q in queues]
        for copies, containers in configurations(rounded, demand, capacity):
            if not containers:
                continue
            first = plan.open(containers)
            columns = []
            for g, c in enumerate(copies):
                for _ in range(int(c)):
                    pieces, at = [], 0
                    while at < containers and queues[g]:
                        s, n = queues[g][0]
                        take = min(n, containers - at)
                        pieces.append((at, take, s))
                        plan.put(s, take, first + at, take)
                        left[s] -= take
                        at += take
                        queues[g][0][1] -= take
                        if queues[g][0][1] == 0:
                            queues[g].popleft()
                    columns.append(pieces)
            ends = sorted({0, containers, *(a for p in columns for a, _, _ in p), *(a + t for p in columns for a, t, _ in p)})
            at_ = [0] * len(columns)
            for a, b in zip(ends, ends[1:], strict=False):
                full = 0
                for j, pieces in enumerate(columns):
                    while at_[j] < len(pieces) and pieces[at_[j]][0] + pieces[at_[j]][1] <= a:
                        at_[j] += 1
                    if at_[j] < len(pieces) and pieces[at_[j]][0] <= a:
                        full += pieces[at_[j]][2]
                rooms[capacity - full].append((first + a, b - a))
    free = sorted(r for r in rooms if r > 0)

    def give(room: int, first: int, containers: int) -> None:
        if room > 0 and containers > 0:
            k = bisect.bisect_left(free, room)
            if k == len(free) or free[k] != room:
                free.insert(k, room)
            rooms[room].append((first, containers))

    for s in sorted((s for s, n in left.items() if n > 0), reverse=True):
        n = left[s]
        while n:
            k = bisect.bisect_left(free, s)
            while k < len(free) and not rooms[free[k]]:
                free.pop(k)
            if k == len(free):
                each = capacity // s
                containers = max(1, n // each)
                first, room = plan.open(containers), capacity
            else:
                room = free[k]
                first, containers = rooms[room].pop()
                each = room // s
            if n >= each:
                used = min(containers, n // each)
                plan.put(s, used * each, first, used)
                n -= used * each
                give(room - each * s, first, used)
                give(room, first + used, containers - used)
            else:
                plan.put(s, n, first, 1)
                give(room - n * s, first, 1)
                give(room, first + 1, containers - 1)
                n = 0
    return plan


def pack(items: DataFrame, row: str, size: str, capacity: int) -> DataFrame:
    """``(row, piece_no, begin, size, container_no)``: every item in a container of ``capacity``.

    An item over the capacity is cut into pieces of the capacity and a rest, no other is cut.  Items
    of size 0 or null take no room and lie in container 1.  Equal items are told apart by ``row`` and,
    where that repeats too, arbitrarily.  An empty table gives no rows; other columns are ignored.
    """
    spark = items.sparkSession
    sized = items.select(F.col(row).alias("_row"), F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)).alias("_all"))
    steps = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("_all") / capacity) - 1, F.lit(0)).cast("int"))
    pieces = sized.select("_row", "_all", F.explode(steps).alias("piece_no")).select(
        "_row", "piece_no", (F.col("piece_no").cast("long") * capacity).alias("begin"), F.least(F.lit(capacity), F.col("_all") - F.col("piece_no").cast("long") * capacity).cast("int").alias("size")
    )
    pieces = materialise(pieces, "pieces")
    counts = pieces.filter("size > 0").groupBy("size").count()
    histogram = {r["size"]: r["count"] for r in counts.collect()}  # at most `capacity` rows
    plan = plan_containers(histogram, capacity)

    parts = counts.select("size", F.ceil(F.col("count") / RANKED_TOGETHER).cast("int").alias("parts"))
    salted = pieces.filter("size > 0").join(F.broadcast(parts), "size").withColumn("part", F.pmod(F.xxhash64("_row", "piece_no"), F.col("parts")).cast("int")).drop("parts")
    each = salted.groupBy("size", "part").count()
    before = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = each.select("size", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("size", "part").orderBy("_row", "piece_no")
    ranked = salted.withColumn("n", F.row_number().over(within) - 1).join(offset, ["size", "part"]).withColumn("rank", F.col("n") + F.col("offset"))

    runs = spark.createDataFrame(plan.runs or [(0, 0, 0, 0, 1)], "run_size int, run_from long, run_items long, run_first long, run_containers long")
    placed = ranked.join(F.broadcast(runs), (F.col("size") == F.col("run_size")) & (F.col("rank") >= F.col("run_from")) & (F.col("rank") < F.col("run_from") + F.col("run_items")))
    placed = placed.select("_row", "piece_no", "begin", "size", (F.col("run_first") + F.pmod(F.col("rank") - F.col("run_from"), F.col("run_containers"))).alias("container_no"))
    nothing = pieces.filter("size = 0").withColumn("container_no", F.lit(1).cast("long"))
    return placed.unionByName(nothing).withColumnRenamed("_row", row)
