"""Label propagation over blocks of nodes: links stay with their block, labels travel between blocks as arrays.

A node is in the block that its key leaves over a prime number of blocks.  A block holds all links of its
nodes; each round it sends every other block the labels of those of its nodes that have a neighbour there,
in the order of their keys.  The other block has the same list of its own, as every link is in the blocks
of both its ends, so that no keys are sent.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryweave.plans import materialise

#: Links of a block, both directions counted, on the average; rows that are dealt to blocks at once.
BLOCK_LINKS, DEALT_ROWS = 2_000_000, 1_000_000


def _same(block: int) -> int:
    return block


def _prime(least: int) -> int:
    while any(least % d == 0 for d in range(2, int(least**0.5) + 1)):
        least += 1
    return least


def _small(values: np.ndarray) -> np.ndarray:
    """The same whole numbers in as few bytes as hold them."""
    if not len(values):
        return values.astype(np.uint8)
    return values.astype(np.promote_types(np.min_scalar_type(int(values.min())), np.min_scalar_type(int(values.max()))))


def _turns(keys: np.ndarray, turn: int) -> np.ndarray:
    """A number for each key that no other key has in this turn."""
    with np.errstate(over="ignore"):
        z = keys.astype(np.int64).astype(np.uint64) + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _deal(batches: Iterator[pa.RecordBatch], blocks: int) -> Iterator[pa.RecordBatch]:
    """Rows for the blocks of both ends; those of weight 0 are nodes with their place."""

    def dealt(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        x, y, w = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in range(3))
        link, node = (w > 0) & (x != y), w == 0
        key, other, weight = np.concatenate([x[link], y[link], x[node]]), np.concatenate([y[link], x[link], y[node]]), np.concatenate([w[link], w[link], w[node]])
        block = _small(key % blocks)
        order = np.argsort(block, kind="stable")
        bounds = np.searchsorted(block[order], np.arange(blocks + 1))
        rows = [(b, order[bounds[b] : bounds[b + 1]]) for b in range(blocks) if bounds[b] < bounds[b + 1]]
        return pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([pickle.dumps(tuple(_small(v[at]) for v in (key, other, weight))) for _, at in rows], pa.binary())], ["block", "data"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= DEALT_ROWS:
            yield dealt(held)
            held = []
    if sum(b.num_rows for b in held):
        yield dealt(held)


def _build(rows: Iterator[tuple[int, bytes]], blocks: int) -> Iterator[tuple]:
    """The links of the one block that a partition holds."""
    parts, block = [], None
    for block, data in rows:
        parts.append(pickle.loads(data))
    if block is None:
        return
    key, other, weight = (np.concatenate([p[i] for p in parts]) for i in range(3))
    del parts
    is_node = weight == 0
    named, place = key[is_node].astype(np.int64), other[is_node].astype(np.int64)
    key, other, weight = key[~is_node].astype(np.int64), other[~is_node].astype(np.int64), weight[~is_node]
    keys = np.unique(np.concatenate([key, named]))
    at = np.full(len(keys), -1)
    at[np.searchsorted(keys, named)] = place
    n = np.searchsorted(keys, key)
    order = np.argsort(n, kind="stable")
    n, other, weight = n[order], other[order], weight[order]
    del key, order
    # other ends by their block, then by key: so they arrive
    others, o = np.unique(other, return_inverse=True)
    by_block = np.argsort(others % blocks, kind="stable")
    moved = np.empty(len(others), np.int64)
    moved[by_block] = np.arange(len(others))
    # own nodes that other blocks ask for, by block, then by key
    sent = np.unique((other % blocks) * len(keys) + n)
    to = np.searchsorted(sent // max(1, len(keys)), np.arange(blocks + 1))
    yield block, ("links", {"at": _small(at), "keys": _small(keys), "counts": _small(np.bincount(n, minlength=len(keys))), "o": _small(moved[o]), "w": _small(weight), "others": _small(others[by_block]), "sent": _small(sent % max(1, len(keys))), "to": to})


def _met(rows: Iterator[tuple]) -> tuple[int | None, dict, tuple, list[tuple[np.ndarray, ...]]]:
    """What a partition holds: its block, the block's links, own values, and what each other block sent, in their order."""
    block, links, own, came = None, {}, (), []
    for block, (kind, *what) in rows:
        if kind == "links":
            links = what[0]
        elif kind == "own":
            own = tuple(v.astype(np.int64) for v in what[0])
        else:
            came.append(what)
    came.sort(key=lambda x: x[0])
    return block, links, own, [values for _, values in came]


def _tell(block: int, links: dict, label: np.ndarray, wish: np.ndarray | None = None) -> Iterator[tuple]:
    """Own values to the block itself; to each block labels of the nodes it asks for: all, or the places, labels and wishes of those that would change."""
    yield block, ("own", tuple(map(_small, (label,) if wish is None else (label, wish))))
    to = links["to"]
    for b in np.flatnonzero(np.diff(to)):
        at = links["sent"][to[b] : to[b + 1]]
        if wish is None:
            sent = (label[at],)
        else:
            place = np.flatnonzero(label[at] != wish[at])
            sent = (np.array([len(at)]), place, label[at[place]], wish[at[place]])
        yield int(b), ("sent", block, tuple(map(_small, sent)))


def _around(came: list[tuple[np.ndarray, ...]]) -> np.ndarray:
    """Labels of the other ends."""
    return np.concatenate([label for (label,) in came]).astype(np.int64)


def _ends(links: dict) -> np.ndarray:
    return np.repeat(np.arange(len(links["counts"])), links["counts"])


def _summed(first: np.ndarray, second: np.ndarray, weight: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of weights for each pair of numbers, in their order; the second is below ``span``."""
    key, bits = first * span + second, int(weight.max()).bit_length() if len(weight) else 1
    if len(key) and int(key.max()).bit_length() + bits < 63:
        # with the weight in the lowest bits, sorted without a permutation
        key = np.sort((key << bits) | weight.astype(np.int64))
        weight, key = key & ((1 << bits) - 1), key >> bits
    else:
        order = np.argsort(key, kind="stable")
        key, weight = key[order], weight[order].astype(np.int64)
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    sums = np.add.reduceat(weight, start) if len(key) else np.zeros(0, np.int64)
    return key[start] // span, key[start] % span, sums


def _start(rows: Iterator[tuple]) -> Iterator[tuple]:
    block, links, _, _ = _met(rows)
    if links:
        yield from _tell(block, links, links["at"])


def _wish(rows: Iterator[tuple], span: int, wishes) -> Iterator[tuple]:
    """The heaviest label around each node, of equal ones the smallest; the own one counts half a link."""
    block, links, own, came = _met(rows)
    if not links:
        return
    label, wish = own[0], own[0].copy()
    if came:
        n, around, weight = _ends(links), _around(came)[links["o"]], links["w"]
        known = (around >= 0) & (label >= 0)[n]
        if not known.all():
            n, around, weight = n[known], around[known], weight[known]
        n, found, votes = _summed(n, around, weight, span)
        votes = 2 * votes + (label[n] == found)
        if len(n):
            start = np.flatnonzero(np.r_[True, n[1:] != n[:-1]])
            best = np.maximum.reduceat(votes, start)
            top = np.flatnonzero(votes == np.repeat(best, np.diff(np.r_[start, len(n)])))
            top = top[np.r_[True, n[top][1:] != n[top][:-1]]]
            wish[n[top]] = found[top]
    wishes.add(int((wish != label).sum()))
    yield from _tell(block, links, label, wish)


def _move(rows: Iterator[tuple], turn: int) -> Iterator[tuple]:
    """Wishes come true, but for one of two linked nodes whose changes undo each other."""
    block, links, own, came = _met(rows)
    if not links:
        return
    c, w = own
    goes = w != c
    if came:
        # others that would change nothing are of no label and no wish
        others = np.full((2, len(links["others"])), -1)
        first = 0
        for size, place, label, wish in came:
            others[:, first + place.astype(np.int64)] = label, wish
            first += int(size[0])
        n, o = _ends(links), links["o"]
        both = goes[n] & (others[1] >= 0)[o]
        n, o = n[both], o[both]
        oc, ow = others[:, o]
        undone = (w[n] == oc).astype(np.int8) + (ow == c[n]) > (w[n] == ow).astype(np.int8) + (c[n] == oc)
        later = _turns(links["keys"], turn)[n] > _turns(links["others"], turn)[o]
        goes[n[undone & later]] = False
    yield from _tell(block, links, np.where(goes, w, c))


def _labels(rows: Iterator[tuple]) -> Iterator[tuple]:
    _, links, own, _ = _met(rows)
    if links:
        known = links["at"] >= 0
        yield (pickle.dumps((links["at"][known], own[0][known])),)


def _between(rows: Iterator[tuple], span: int) -> Iterator[tuple]:
    """Weights between the labels of a block's nodes and those of their neighbours, each direction of its own."""
    _, links, own, came = _met(rows)
    if came:
        here, there = own[0][_ends(links)], _around(came)[links["o"]]
        known = (here >= 0) & (there >= 0)
        yield (pickle.dumps(_summed(here[known], there[known], links["w"][known], span)),)


def _table(spark: SparkSession, packed: RDD, names: list[str]) -> DataFrame:
    """Packed arrays of whole numbers as rows."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                columns = [v.astype(np.int64) for v in pickle.loads(data.as_py())]
                for i in range(0, len(columns[0]), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(v[i : i + 100_000]) for v in columns], names)

    return spark.createDataFrame(packed, "data binary").mapInArrow(unpack, ", ".join(f"{n} long" for n in names))


def propagate(nodes: DataFrame, links: DataFrame, total: int, size: int, weights: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """``(at, label)`` of nodes (``key``, ``at``: places from 0 to ``total`` in the order in which equal labels are preferred) over links (``a``, ``b``, ``weight``) of keys, about ``size`` rows, read once.

    With ``weights`` also ``(label, other, weight)``: the weight between labels, in both directions, that
    inside a label twice.  Keys and weights are whole numbers, weights positive; the same link may come in
    several rows.
    """
    spark = nodes.sparkSession
    blocks, span = _prime(max(2, -(-2 * size // BLOCK_LINKS))), max(1, total)
    rows = links.select(F.col("a").cast("long").alias("x"), F.col("b").cast("long").alias("y"), F.col("weight").cast("long").alias("w")).filter("x is not null and y is not null and w > 0")
    rows = rows.unionByName(nodes.select(F.col("key").cast("long").alias("x"), F.col("at").cast("long").alias("y"), F.lit(0).cast("long").alias("w")).filter("x is not null"))
    read = rows.mapInArrow(lambda b: _deal(b, blocks), "block int, data binary").rdd
    dealt = read.map(lambda r: (r[0], bytes(r[1]))).partitionBy(blocks, _same)
    # on the executors' disks; what is lost is made again from the links
    held = dealt.mapPartitions(lambda r: _build(r, blocks), preservesPartitioning=True).persist(StorageLevel.DISK_ONLY)

    def done(rdd: RDD) -> RDD:
        rdd.mapPartitions(lambda r: ()).count()
        return rdd

    def told(step: Callable, *before: RDD) -> RDD:
        return done((held.union(before[0]) if before else held).mapPartitions(step).partitionBy(blocks, _same))

    def forget(rdd: RDD) -> None:
        """Delete the shuffle files under what later steps no longer read."""
        rdd._jrdd.rdd().cleanShuffleDependencies(True)

    done(dealt)
    forget(read)
    done(held)
    forget(dealt)
    label, turn = told(_start), 0
    while True:
        wishes = spark.sparkContext.accumulator(0)
        asked = told(lambda r, wishes=wishes: _wish(r, span, wishes), label)
        if not wishes.value:
            break
        forget(label)
        label = told(lambda r, turn=turn: _move(r, turn), asked)
        forget(asked)
        turn += 1
    at_end = held.union(label)
    found = materialise(_table(spark, at_end.mapPartitions(_labels), ["at", "label"]), "labels")
    between = None
    if weights:
        between = _table(spark, at_end.mapPartitions(lambda r: _between(r, span)), ["label", "other", "weight"]).groupBy("label", "other").agg(F.sum("weight").alias("weight"))
        between = materialise(between, "between")
    forget(asked)
    held.unpersist()
    return found, between
