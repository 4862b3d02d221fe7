"""The k most similar vectors of every vector: shards by nearest centre, large ones with a hierarchical small-world graph.

Vectors are dealt to shards by the nearest of some centres (fitted on a bounded sample, all vectors
are indexed); a centre with more vectors than one graph may hold is split by a hash into several.
Many centres are fitted in two levels and found through the upper one.  A shard of up to ``WHOLE_ROWS``
vectors is compared as a whole; a larger one has a graph, built in blocks: a block searches the graph so
far and itself, keeps a diverse choice of what it finds and links back.

Every vector asks the shards of all centres that are at most a margin less similar to it than its nearest
one, so that a vector between several shards asks more of them than one in the midst of its own.  The
margin is fitted on a bounded sample of queries and their true neighbours, looked for in all vectors:
within it lie the shards of a share of them (of those of a stated cosine, which tell each other of it).
Members and askers of a shard come to it in one exchange, the only one that vectors go through (where
very many are copies of others, those are taken out by a join before).  The answers are merged.  With ``exact`` the k-th of these answers is a bound, and every vector is also
compared with all others over a grid of blocks.

Exact copies are one vertex of the graph and come back as neighbours of each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryweave.plans import materialise

#: Vectors a centre stands for, vectors one part of a shard holds at most, queries searched together.
SHARD_ROWS, GRAPH_ROWS, QUERY_ROWS = 4_000, 16_000, 32_000
#: Vectors of a shard up to which it has no graph but is compared as a whole; similar ones looked at beyond those wanted, for rounding.
WHOLE_ROWS, SPARE = 16_000, 8
#: Rows about copies that are sent to all executors (about 50 MB); more are joined.
MARKS_SENT = 500_000
#: Samples that centres and margin are fitted on: vectors, queries among them, vectors for each centre of the lower level.
CENTRE_SAMPLE, MARGIN_QUERIES, CELL_SAMPLE = 32_768, 2_048, 32
#: Centres from which on there are two levels, and how many there are at most (a broadcast of 64 MB at 64 numbers each);
#: that is a billion vectors, beyond them shards grow to GRAPH_ROWS (4 billion), then they are split.
ONE_LEVEL, MOST_CENTRES = 4_096, 262_144
#: Share of the sampled queries' true neighbours whose shards lie within the margin.
WANTED_SHARE = 0.999
#: The same for neighbours of a stated cosine, where a pair is missed only if neither finds the other; sampled pairs this rests on at least.
NEAR_SHARE, LEAST_PAIRS = 1.0, 500
#: Links of a vertex above the ground level (twice as many there), breadth of search when building and asking.
LINKS, BUILD_BREADTH, SEARCH_BREADTH = 12, 48, 48
#: Queries and vectors of one cell of the grid that finds what the margin and the graphs miss.
CELL_QUERIES, CELL_ROWS = 16_000, 64_000
#: A vector with more than one in this many rows, and so many at least, is dealt into parts.
HOT_SHARE, HOT_LEAST, HOT_PARTS = 512, 1_000, 64


def _search(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, starts: np.ndarray, breadth: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of a block of queries over one level: places and similarities, best first; -1 where none."""
    m, dead = len(queries), n
    place = np.full((m, breadth), dead, dtype=np.int32)
    value = np.full((m, breadth), -np.inf, dtype=np.float32)
    done = np.zeros((m, breadth), dtype=bool)
    seen = np.zeros((m, n + 1), dtype=bool)
    seen[:, dead] = True
    width = min(starts.shape[1], breadth)
    place[:, :width] = starts[:, :width]
    rows = np.arange(m)[:, None]
    real = place != dead
    value[:, :width] = np.einsum("mkd,md->mk", vectors[place[:, :width]], queries)
    value[~real] = -np.inf
    seen[rows, place] = True
    active = np.arange(m)
    while len(active):
        open_ = np.where(done[active] | (place[active] == dead), -np.inf, value[active])
        pick = np.argpartition(-open_, 1, axis=1)[:, :2] if breadth > 2 else np.arange(breadth)[None, :].repeat(len(active), 0)
        top = np.take_along_axis(open_, pick, 1)
        go = top.max(axis=1) > -np.inf
        active, pick, top = active[go], pick[go], top[go]
        if not len(active):
            break
        r = active[:, None]
        usable = top > -np.inf
        done[r, pick] |= usable
        near = links[np.where(usable, place[r, pick], dead)].reshape(len(active), -1)
        fresh = ~seen[r, near]
        seen[r, near] = True
        # the same place twice in one row: only the first counts
        order = np.sort(np.where(fresh, near, dead), axis=1)
        order[:, 1:][order[:, 1:] == order[:, :-1]] = dead
        keep = int((order != dead).sum(axis=1).max(initial=0))
        if keep == 0:
            continue
        order.sort(axis=1)
        new = order[:, :keep]
        sims = np.einsum("mkd,md->mk", vectors[new], queries[active])
        sims[new == dead] = -np.inf
        all_place = np.concatenate([place[active], new], axis=1)
        all_value = np.concatenate([value[active], sims], axis=1)
        all_done = np.concatenate([done[active], np.zeros_like(new, dtype=bool)], axis=1)
        best = np.argpartition(-all_value, breadth - 1, axis=1)[:, :breadth]
        place[active] = np.take_along_axis(all_place, best, 1)
        value[active] = np.take_along_axis(all_value, best, 1)
        done[active] = np.take_along_axis(all_done, best, 1)
    order = np.argsort(-value, axis=1, kind="stable")
    place, value = np.take_along_axis(place, order, 1), np.take_along_axis(value, order, 1)
    return np.where(value > -np.inf, place, dead), value


def _diverse(vectors: np.ndarray, place: np.ndarray, value: np.ndarray, most: int, dead: int) -> np.ndarray:
    """Up to ``most`` of the candidates of each row, best first, each nearer to the row than to a chosen one; then filled up."""
    m, width = place.shape
    chosen = np.full((m, most), dead, dtype=np.int32)
    count = np.zeros(m, dtype=np.int64)
    taken = np.zeros((m, width), dtype=bool)
    for j in range(width):
        ok = (place[:, j] != dead) & (count < most)
        if not ok.any():
            continue
        sims = np.einsum("mkd,md->mk", vectors[chosen[ok]], vectors[place[ok, j]])
        sims[chosen[ok] == dead] = -np.inf
        far = sims.max(axis=1) < value[ok, j]
        at = np.flatnonzero(ok)[far]
        chosen[at, count[at]] = place[at, j]
        count[at] += 1
        taken[at, j] = True
    for j in range(width):
        at = np.flatnonzero((place[:, j] != dead) & (count < most) & ~taken[:, j])
        chosen[at, count[at]] = place[at, j]
        count[at] += 1
    return chosen


class Graph:
    """A graph over unit vectors, ordered so that level ``l`` holds the first ``sizes[l]`` of them."""

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray], sizes: list[int]):
        self.vectors, self.links, self.sizes = vectors, links, sizes

    @classmethod
    def build(cls, unit: np.ndarray, links: int = LINKS, breadth: int = BUILD_BREADTH) -> "Graph":
        n, dim = unit.shape
        vectors = np.zeros((n + 1, dim), dtype=np.float32)
        vectors[:n] = unit
        sizes = [n]
        while sizes[-1] > 2 * links * links:
            sizes.append(max(1, sizes[-1] // links))
        levels = [np.full((n + 1, links * (2 if l == 0 else 1)), n, dtype=np.int32) for l in range(len(sizes))]
        graph = cls(vectors, levels, sizes)
        at = 0
        while at < n:
            end = min(n, at + max(256, min(at, 1024)))
            graph._insert(at, end, breadth)
            at = end
        return graph

    def _entries(self, queries: np.ndarray, n: int, down_to: int, breadth: int) -> np.ndarray:
        """Places to start from on level ``down_to``: the top level in use is compared as a whole."""
        top = len(self.sizes) - 1
        head = min(n, self.sizes[top])
        sims = queries @ self.vectors[:head].T
        width = min(8, head)
        starts = np.argpartition(-sims, width - 1, axis=1)[:, :width].astype(np.int32)
        for level in range(top - 1, down_to, -1):
            starts, _ = _search(self.vectors, self.links[level], queries, starts, breadth, len(self.vectors) - 1)
        return starts

    def _insert(self, at: int, end: int, breadth: int) -> None:
        dead = len(self.vectors) - 1
        block = self.vectors[at:end]
        own = block @ block.T
        np.fill_diagonal(own, -np.inf)
        for level, size in enumerate(self.sizes):
            stop = min(end, size)
            if stop <= at:
                continue
            rows = stop - at
            inside = own[:rows, :rows]
            k = min(breadth, rows - 1)
            place = np.full((rows, k), dead, dtype=np.int32)
            value = np.full((rows, k), -np.inf, dtype=np.float32)
            if k:
                near = np.argpartition(-inside, k - 1, axis=1)[:, :k]
                place, value = (near + at).astype(np.int32), np.take_along_axis(inside, near, 1)
            if at:
                starts = self._entries(block[:rows], at, level, 16)
                old_place, old_value = _search(self.vectors, self.links[level], block[:rows], starts, breadth, dead)
                place, value = np.concatenate([place, old_place], 1), np.concatenate([value, old_value], 1)
            order = np.argsort(-value, axis=1, kind="stable")[:, :breadth]
            place, value = np.take_along_axis(place, order, 1), np.take_along_axis(value, order, 1)
            links = self.links[level]
            wanted = links.shape[1] // 2 if level == 0 else links.shape[1]
            links[at:stop, :wanted] = _diverse(self.vectors, place, value, wanted, dead)
            self._link_back(links, at, stop, dead)

    def _link_back(self, links: np.ndarray, at: int, stop: int, dead: int) -> None:
        source = np.repeat(np.arange(at, stop, dtype=np.int32), links.shape[1])
        target = links[at:stop].ravel()
        real = target != dead
        source, target = source[real], target[real]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        heads, first, count = np.unique(target, return_index=True, return_counts=True)
        width = int(count.max(initial=0))
        incoming = np.full((len(heads), width), dead, dtype=np.int32)
        incoming[np.repeat(np.arange(len(heads)), count), np.arange(len(target)) - np.repeat(first, count)] = source
        known = (incoming[:, :, None] == links[heads][:, None, :]).any(axis=2)
        incoming[known] = dead
        both = np.concatenate([links[heads], incoming], axis=1)
        value = np.einsum("mkd,md->mk", self.vectors[both], self.vectors[heads])
        value[both == dead] = -np.inf
        order = np.argsort(-value, axis=1, kind="stable")
        both, value = np.take_along_axis(both, order, 1), np.take_along_axis(value, order, 1)
        over = (both != dead).sum(axis=1) > links.shape[1]
        links[heads[~over]] = both[~over][:, : links.shape[1]]
        if over.any():
            links[heads[over]] = _diverse(self.vectors, both[over], value[over], links.shape[1], dead)

    def search(self, queries: np.ndarray, k: int, breadth: int = SEARCH_BREADTH) -> tuple[np.ndarray, np.ndarray]:
        """Places of about the ``k`` most similar vectors and their similarities; ``n`` where none."""
        n = len(self.vectors) - 1
        breadth = int(breadth * (1 + max(0.0, math.log2(max(n, 1) / 500)) / 2))  # larger graphs need a wider search
        places, values = [], []
        step = max(64, min(1024, 16_000_000 // (n + 1)))
        for a in range(0, len(queries), step):
            block = np.ascontiguousarray(queries[a : a + step], dtype=np.float32)
            starts = self._entries(block, n, 0, 16)
            place, value = _search(self.vectors, self.links[0], block, starts, max(breadth, k), n)
            places.append(place[:, :k])
            values.append(value[:, :k])
        return np.concatenate(places), np.concatenate(values)


def fit_centres(sample: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Unit centres by spherical k-means, started from evenly spread rows of the sample."""
    centres = sample[np.linspace(0, len(sample) - 1, count).astype(int)].copy()
    for _ in range(rounds):
        owner = np.concatenate([(sample[a : a + 4096] @ centres.T).argmax(axis=1) for a in range(0, len(sample), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centres)
    return centres.astype(np.float32)


class Centres:
    """Centres of one level, or of two: each of the upper ones with its own."""

    def __init__(self, upper: np.ndarray, lower: list[np.ndarray] | None = None):
        self.upper, self.lower = upper, lower
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in lower])]) if lower else None
        self.count = int(self.first[-1]) if lower else len(upper)

    def near(self, unit: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, centre, similarity) of all centres within the margin of each row's nearest one, the nearest of a row first."""
        if len(unit) > 2_000:
            found = [(rows + a, cells, value) for a in range(0, len(unit), 2_000) for rows, cells, value in [self.near(unit[a : a + 2_000], margin)]]
            return tuple(np.concatenate(x) for x in zip(*found, strict=True))
        sims = unit @ self.upper.T
        rows, cells = np.nonzero(sims >= sims.max(axis=1, keepdims=True) - max(margin, 0.0))
        if self.lower is None:
            value = sims[rows, cells]
        else:
            order = np.argsort(cells, kind="stable")
            rows, cells = rows[order], cells[order]
            found = []
            for cell in np.unique(cells):
                mine = rows[np.searchsorted(cells, cell) : np.searchsorted(cells, cell, "right")]
                inner = unit[mine] @ self.lower[cell].T
                r, c = np.nonzero(inner >= inner.max(axis=1, keepdims=True) - max(margin, 0.0))
                found.append((mine[r], c + self.first[cell], inner[r, c]))
            rows, cells, value = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (rows, cells, np.zeros(0, dtype=np.float32))
            best = np.full(len(unit), -2.0, dtype=np.float32)
            np.maximum.at(best, rows, value)
            keep = value >= best[rows] - max(margin, 0.0)
            rows, cells, value = rows[keep], cells[keep], value[keep]
        order = np.lexsort((cells, -value, rows))
        return rows[order], cells[order].astype(np.int32), value[order]


def _margin(cosines: np.ndarray, gaps: np.ndarray, share: float, at_least: float) -> float:
    """The gap within which a share of neighbours lie."""
    if at_least <= -1 or not len(gaps):
        return float(np.quantile(gaps, share)) if len(gaps) else 0.0
    order = np.argsort(-cosines, kind="stable")
    return float(np.quantile(gaps[order[: max(LEAST_PAIRS, int((cosines >= at_least).sum()))]], NEAR_SHARE))


def _owners(centres: Centres, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row, and its similarity."""
    rows, cells, value = centres.near(unit, 0.0)
    first = np.append(True, np.diff(rows) > 0)
    return cells[first], value[first]


def _sample_gaps(batches: Iterator[np.ndarray], centres: Centres, asked: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, cosine, gap) of the ``k`` most similar of the batches for each query; a vector equal to it is itself."""
    flat = centres.upper if centres.lower is None else np.concatenate(centres.lower)
    _, best = _owners(centres, asked)
    query, cosine, gap = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.float32), np.zeros(0, dtype=np.float32)
    bound = np.full(len(asked), -2.0, dtype=np.float32)
    for unit in batches:
        for a in range(0, len(unit), 4_096):
            block = unit[a : a + 4_096]
            sims = asked @ block.T
            near = sims > bound[:, None]
            if near.sum() > 4 * k * len(asked):
                top = np.argpartition(-sims, min(k, sims.shape[1] - 1), axis=1)[:, : k + 1]
                near[:] = False
                np.put_along_axis(near, top, True, axis=1)
            r, c = np.nonzero(near)
            other = (asked[r] != block[c]).any(axis=1)
            r, c = r[other], c[other]
            if not len(r):
                continue
            some, at = np.unique(c, return_inverse=True)
            cells, _ = _owners(centres, block[some])
            query, cosine = np.append(query, r), np.append(cosine, sims[r, c])
            gap = np.append(gap, best[r] - np.einsum("md,md->m", flat[cells[at]], asked[r]))
            order = np.lexsort((-cosine, query))
            query, cosine, gap = query[order], cosine[order], gap[order]
            place = np.arange(len(query)) - np.searchsorted(query, query)
            query, cosine, gap, place = query[place < k], cosine[place < k], gap[place < k], place[place < k]
            bound[query[place == k - 1]] = cosine[place == k - 1]
    return query, cosine, gap


def fit_margin(centres: Centres, sample: np.ndarray, k: int, queries: int = MARGIN_QUERIES, share: float = WANTED_SHARE, at_least: float = -2.0, among: DataFrame | None = None) -> float:
    """How much less similar a centre may be than the nearest one, so that the shards of a share of the sampled queries' neighbours lie within.

    Neighbours are looked for in the whole table ``among`` (``vec``), without one in the sample: those of a
    sample are farther than the true ones, the more so the larger the table.
    """
    if centres.count < 2 or len(sample) < 2:
        return 0.0
    asked = sample[:queries]
    if among is None:
        _, cosines, gaps = _sample_gaps(iter([sample]), centres, asked, k)
        return _margin(cosines, gaps, share, at_least)
    shared = among.sparkSession.sparkContext.broadcast((centres, asked))

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        query, cosine, gap = _sample_gaps((_units(b["vec"]).astype(np.float32) for b in batches if len(b)), *shared.value, k)
        yield pd.DataFrame({"query": query, "cosine": cosine, "gap": gap})

    # MARGIN_QUERIES rows at most
    each = among.select("vec").mapInPandas(look, "query long, cosine float, gap float").groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("cosine")).alias("far"), "gap"))), 1, k).alias("near"))
    found = each.select(F.explode("near").alias("x")).select((-F.col("x.far")).alias("cosine"), "x.gap").toPandas()
    return _margin(found["cosine"].to_numpy(), found["gap"].to_numpy(), share, at_least)


def _units(column: pd.Series) -> np.ndarray:
    raw = np.array(column.tolist(), dtype=np.float64)
    raw /= np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def usable_vectors(vectors: DataFrame, row: str, embedding: str, dim: int) -> DataFrame:
    """``(idx, vec)`` of the vectors of the right size, finite and not all zero."""
    finite = F.forall(F.col("vec"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(row).cast("long").alias("idx"), F.col(embedding).cast("array<float>").alias("vec"))
    return rows.filter((F.size("vec") == dim) & finite & F.exists("vec", lambda x: x != 0) & F.col("idx").isNotNull())


def _fit_all(distinct: DataFrame, total: int, sample: np.ndarray, count: int, one_level: int) -> Centres:
    """So many centres; the lower of two levels is fitted for each upper one apart, on a bounded sample of its vectors."""
    count = min(count, MOST_CENTRES)
    if count <= one_level:
        return Centres(fit_centres(sample, min(count, len(sample))))
    upper = distinct.sparkSession.sparkContext.broadcast(fit_centres(sample, min(math.ceil(math.sqrt(count)), len(sample))))
    each = math.ceil(count / len(upper.value))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch[["vec", "key"]].assign(cell=(_units(batch["vec"]).astype(np.float32) @ upper.value.T).argmax(axis=1).astype(np.int32))

    # a cell gets centres by its share of the sample, and is fitted on CELL_SAMPLE vectors for each
    owner = np.bincount((sample @ upper.value.T).argmax(axis=1), minlength=len(upper.value))
    wanted = np.maximum(1, np.round(owner / max(len(sample), 1) * count)).astype(int)
    most = int(wanted.max()) * CELL_SAMPLE
    # CELL_SAMPLE vectors for each centre in all, of whatever number of vectors
    drawn = distinct.filter(F.pmod("key", F.lit(1_000_003)) < F.lit(math.ceil(1_000_003 * min(1.0, 2 * CELL_SAMPLE * each * len(upper.value) / max(total, 1)))))
    ranked = drawn.mapInPandas(place, "vec array<float>, key long, cell int").withColumn("at", F.row_number().over(Window.partitionBy("cell").orderBy("key"))).filter(F.col("at") <= most)

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        cell = int(rows["cell"].iloc[0])
        unit = _units(rows.sort_values("key", kind="stable")["vec"]).astype(np.float32)
        own = fit_centres(unit, min(int(wanted[cell]), len(unit)))
        return pd.DataFrame({"cell": [cell], "own": [own.tobytes()]})

    # MOST_CENTRES vectors at most
    fitted = {r["cell"]: np.frombuffer(r["own"], dtype=np.float32).reshape(-1, sample.shape[1]) for r in ranked.groupBy("cell").applyInPandas(fit, "cell int, own binary").collect()}
    return Centres(upper.value, [fitted.get(c, upper.value[c : c + 1]) for c in range(len(upper.value))])


def _unit_rows(raw: np.ndarray) -> np.ndarray:
    raw = raw.astype(np.float64)
    raw /= np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def _top(unit: np.ndarray, names: np.ndarray, asks: np.ndarray, own: np.ndarray, k: int, breadth: int, whole_rows: int, at_least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(row of asks, name, cosine)`` of the ``k`` most similar others: a small shard is compared as a whole, a larger one has a graph."""
    near = np.ascontiguousarray(unit.astype(np.float32).T)
    graph = Graph.build(unit.astype(np.float32)) if len(unit) > whole_rows else None
    width = min(len(unit), k + 1 + SPARE)
    step = max(64, min(1024, 4_000_000 // len(unit)))
    for a in range(0, len(asks), step):
        block = asks[a : a + step]
        if graph is not None:
            place, _ = graph.search(block.astype(np.float32), width, max(breadth, width))
            there = place < len(unit)
            place = np.where(there, place, 0)
        else:
            sims = block.astype(np.float32) @ near
            close = sims >= at_least - 1e-5
            # with a stated cosine most rows have few, or none but themselves
            most = min(width, int(close.sum(axis=1).max()))
            if most < width:
                r, c = np.nonzero(close)
                place, there = np.zeros((len(block), max(1, most)), dtype=np.int64), np.zeros((len(block), max(1, most)), dtype=bool)
                at = np.arange(len(r)) - np.searchsorted(r, r)
                place[r, at], there[r, at] = c, True
            else:
                place = np.argpartition(sims, len(unit) - width, axis=1)[:, len(unit) - width :]
                there = np.ones(place.shape, dtype=bool)
        value = np.einsum("mkd,md->mk", unit[place], block)
        name = names[place]
        value[~there | (name == own[a : a + step, None])] = -np.inf
        order = np.lexsort((name, -value), axis=1)[:, :k]
        value, name = np.take_along_axis(value, order, 1), np.take_along_axis(name, order, 1)
        r, c = np.nonzero(value > -np.inf)
        yield r + a, name[r, c], value[r, c]


def most_similar(vectors: DataFrame, row: str, embedding: str, k: int = 10, dim: int = 64, shard_rows: int = SHARD_ROWS, breadth: int = SEARCH_BREADTH, share: float = WANTED_SHARE, exact: bool = False, one_level: int = ONE_LEVEL, at_least: float = -2.0, asked: Column | None = None) -> DataFrame:
    """``(idx, neighbour, cosine, rank)``: about the ``k`` most similar other vectors of each usable one.

    Null vectors, such of another length than ``dim``, with a null, NaN or infinite element or of
    length zero have no neighbours and are none.  Copies are neighbours with cosine 1; equal cosines
    are ranked by ``neighbour``.  Repeated rows of one ``row`` value count once if their vectors are
    equal.  An empty table gives no rows.  ``share`` is the share of sampled neighbours whose shards
    must be asked; ``exact`` compares all vectors in blocks too, which misses none and grows with the
    square of the vectors.  Of the ``k``, those below the cosine ``at_least`` are left out, and rows for
    which ``asked`` (over ``idx``) does not hold; neither is carried along.
    """
    spark = vectors.sparkSession
    # vectors stay in their table and are read again; 128 bits of hashes stand for them until they are dealt to shards
    usable = usable_vectors(vectors, row, embedding, dim).withColumns({"key": F.xxhash64("vec"), "twin": F.xxhash64(F.lit(1), "vec")})
    same = ["key", "twin"]
    # one vertex for each distinct vector, with the k + 1 first of its copies (each row needs at most k others)
    keys = materialise(usable.select("idx", *same).distinct(), "keys")
    # at most HOT_SHARE vectors, as their shares add up to one
    counted = keys.groupBy(*same).agg(F.count("*").alias("n"), F.min("idx").alias("rep"))
    hot = materialise(counted.filter(F.col("n") * HOT_SHARE > max(keys.count(), HOT_LEAST * HOT_SHARE)).select(*same, "rep"), "hot")
    ordered = Window.partitionBy(*same).orderBy("idx")
    rest = keys.join(F.broadcast(hot.select(*same)), same, "left_anti")
    rest = rest.withColumn("n", F.row_number().over(ordered)).withColumn("rep", F.min("idx").over(Window.partitionBy(*same)))
    dealt_out = keys.join(F.broadcast(hot), same).withColumn("part", F.pmod(F.xxhash64("idx"), F.lit(HOT_PARTS)))
    dealt_out = dealt_out.withColumn("n", F.row_number().over(Window.partitionBy(*same, "part").orderBy("idx"))).drop("part")
    first = dealt_out.filter(F.col("n") <= k + 1).withColumn("n", F.row_number().over(ordered))
    columns = ["idx", "rep", "n", *same]
    copies = rest.select(*columns).unionByName(first.select(*columns)).unionByName(dealt_out.filter(F.col("n") > k + 1).select(*columns))
    copies = materialise(copies, "copies")
    total = copies.filter("n = 1").count()
    if total == 0:
        return spark.createDataFrame([], "idx long, neighbour long, cosine double, rank int")

    # later copies are no vertices; the first one asks for all
    later = copies.filter("n > 1")
    marks = materialise(later.select("idx", *same, F.lit(False).alias("vertex")).unionByName(later.filter("n = 2").select(F.col("rep").alias("idx"), *same, F.lit(True).alias("vertex"))), "marks")
    marked = usable.join(F.broadcast(marks) if marks.count() <= MARKS_SENT else marks, ["idx", *same], "left").filter(F.coalesce("vertex", F.lit(True)))
    asking = F.lit(True) if asked is None else F.coalesce("vertex", asked, F.lit(False))
    distinct = marked.select("idx", "vec", "key", asking.alias("asks"))
    count = min(MOST_CENTRES, max(1, math.ceil(total / shard_rows)))
    # keys are spread evenly: twice as many of the smallest as are wanted
    low = F.col("key") <= F.lit(min(2**63 - 1, 2**65 * CENTRE_SAMPLE // total - 2**63))
    sample = distinct.filter(low).orderBy("key", "idx").limit(CENTRE_SAMPLE).select("vec").toPandas()["vec"]  # CENTRE_SAMPLE rows
    if not len(sample):
        sample = distinct.orderBy("key", "idx").limit(CENTRE_SAMPLE).select("vec").toPandas()["vec"]
    sample = _units(sample).astype(np.float32)
    centres = _fit_all(distinct, total, sample, count, one_level)
    margin = fit_margin(centres, sample, k, share=share, at_least=at_least, among=distinct if total > len(sample) else None)
    count = centres.count
    centres = spark.sparkContext.broadcast(centres)

    def near_of(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, centre, whether it is the row's nearest), rows that don't ask with their nearest only."""
        rows, cells, _ = centres.value.near(_units(batch["vec"]).astype(np.float32), margin)
        own = np.append(True, np.diff(rows) > 0)
        sent = own | batch["asks"].to_numpy(dtype=bool)[rows]
        return rows[sent], cells[sent], own[sent]

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        members, queries = np.zeros(count, dtype=np.int64), np.zeros(count, dtype=np.int64)
        for batch in batches:
            if len(batch):
                rows, cells, own = near_of(batch)
                members += np.bincount(cells[own], minlength=count)
                queries += np.bincount(cells[batch["asks"].to_numpy(dtype=bool)[rows]], minlength=count)
        some = np.flatnonzero(members + queries)
        yield pd.DataFrame({"centre": some, "members": members[some], "queries": queries[some]})

    # one row for each centre, MOST_CENTRES at most
    tallied = distinct.mapInPandas(tally, "centre long, members long, queries long").groupBy("centre").agg(F.sum("members").alias("members"), F.sum("queries").alias("queries")).toPandas()
    salts, blocks = np.zeros(count, dtype=np.int64), np.ones(count, dtype=np.int64)
    salts[tallied["centre"]] = -(-tallied["members"] // GRAPH_ROWS)
    blocks[tallied["centre"]] = np.maximum(1, -(-tallied["queries"] // QUERY_ROWS))
    cut = spark.sparkContext.broadcast((salts, blocks, np.cumsum(salts * blocks) - salts * blocks))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        salts, blocks, first = cut.value
        for batch in batches:
            if not len(batch):
                continue
            rows, cells, own = near_of(batch)
            idx, key, asks = batch["idx"].to_numpy(), batch["key"].to_numpy(), batch["asks"].to_numpy(dtype=bool)
            raw = np.array(batch["vec"].tolist(), dtype=np.float32)
            # all parts of a shard; a vector is a member of one salt and asks in one block
            each = (salts * blocks)[cells]
            at = np.repeat(np.arange(len(rows)), each)
            part = np.arange(len(at)) - np.repeat(np.cumsum(each) - each, each)
            salt, block, mine = part // blocks[cells[at]], part % blocks[cells[at]], rows[at]
            member = own[at] & (salt == key[mine] % np.maximum(1, salts[cells[at]]))
            ask = asks[mine] & (block == (key[mine] >> 20) % blocks[cells[at]])
            kept = member | ask
            mine = mine[kept]
            data = [v.tobytes() for v in raw]
            yield pd.DataFrame({"part": (first[cells[at]] + part)[kept], "idx": idx[mine], "vec": [data[i] for i in mine], "role": (member + 2 * ask)[kept].astype(np.int8)})

    def ask(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["idx"].duplicated().any():
            rows = rows.drop_duplicates(["idx", "vec", "role"])  # rows that came twice
        role = rows["role"].to_numpy()
        member, query = (role & 1) > 0, (role & 2) > 0
        if not member.any() or not query.any():
            return pd.DataFrame({"idx": [], "rep": [], "cosine": []})
        unit, idx = _unit_rows(np.frombuffer(b"".join(rows["vec"]), dtype=np.float32).reshape(len(rows), dim)), rows["idx"].to_numpy()
        # a random order, the same each time
        order = np.flatnonzero(member)[np.lexsort((idx[member], pd.util.hash_array(idx[member])))]
        own, out = idx[query], []
        for r, name, value in _top(unit[order], idx[order], unit[query], own, k, breadth, WHOLE_ROWS, at_least):
            keep = value >= at_least
            out.append(pd.DataFrame({"idx": own[r[keep]], "rep": name[keep], "cosine": value[keep]}))
        return pd.concat(out)

    answers = distinct.mapInPandas(deal, "part long, idx long, vec binary, role byte").groupBy("part").applyInPandas(ask, "idx long, rep long, cosine double")
    if at_least > -1:
        # few rows; whoever finds a neighbour is one of it, unless its list is full of nearer ones
        answers = materialise(answers, "found")
        answers = answers.unionByName(answers.select(F.col("rep").alias("idx"), F.col("idx").alias("rep"), "cosine"))
        answers = answers.groupBy("idx", "rep").agg(F.max("cosine").alias("cosine"))
    # of each shard at most k rows a vector: its probes times the salts bound what is gathered
    nearest = lambda df: df.groupBy("idx").agg(F.slice(F.array_sort(F.collect_set(F.struct((-F.col("cosine")).alias("far"), "rep"))), 1, k).alias("near"))
    best = materialise(nearest(answers), "answers")

    if exact and count > 1:
        stripes, parts = math.ceil(total / CELL_QUERIES), math.ceil(total / CELL_ROWS)

        def compare(queries: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
            if not len(queries) or not len(stored):
                return pd.DataFrame({"idx": [], "rep": [], "cosine": []})
            left, right = _units(queries["vec"]), _units(stored["known"])
            own, names, bound = queries["idx"].to_numpy(), stored["rep"].to_numpy(), queries["bound"].to_numpy()
            across, out = np.ascontiguousarray(right.astype(np.float32).T), []
            for a in range(0, len(left), 256):
                sims = left[a : a + 256].astype(np.float32) @ across
                # a little below the bound, as it is of double precision
                r, c = np.nonzero(sims > (bound[a : a + 256, None] - 1e-5).astype(np.float32))
                value = np.einsum("md,md->m", left[a + r], right[c])
                keep = (own[a + r] != names[c]) & (value >= bound[a + r])
                out.append(pd.DataFrame({"idx": own[a + r][keep], "rep": names[c][keep], "cosine": value[keep]}))
            return pd.concat(out)

        bounds = best.select("idx", F.when(F.size("near") == k, -F.element_at("near", -1)["far"]).otherwise(F.lit(at_least)).alias("bound"))
        asking = distinct.filter("asks").select("idx", "vec", "key").join(bounds, "idx", "left").withColumn("bound", F.coalesce("bound", F.lit(at_least)))
        asking = asking.withColumn("stripe", F.pmod(F.hash("key"), F.lit(stripes))).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).drop("key")
        stored = distinct.select(F.col("idx").alias("rep"), F.col("vec").alias("known"), F.pmod(F.hash("key"), F.lit(parts)).alias("part")).withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
        missed = asking.groupBy("stripe", "part").cogroup(stored.groupBy("stripe", "part")).applyInPandas(compare, "idx long, rep long, cosine double")
        known = best.select("idx", F.explode("near").alias("x")).select("idx", F.col("x.rep").alias("rep"), (-F.col("x.far")).alias("cosine"))
        both = known.unionByName(missed).groupBy("idx", "rep").agg(F.max("cosine").alias("cosine"))
        best = materialise(nearest(both), "answers")

    few = copies.filter(F.col("n") <= k + 1).select(F.col("idx").alias("neighbour"), "rep", "n")
    of_rep = best.select(F.col("idx").alias("rep_a"), F.explode("near").alias("x")).select("rep_a", F.col("x.rep").alias("rep"), (-F.col("x.far")).alias("cosine"))
    others = of_rep.join(few.filter(F.col("n") <= k), "rep").select("rep_a", "neighbour", "cosine")
    own = few.filter(F.col("n") > 0).select(F.col("rep").alias("rep_a"), "neighbour", F.lit(1.0).alias("cosine"))
    listed = others.unionByName(own).groupBy("rep_a").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("cosine")).alias("far"), "neighbour"))), 1, k + 1).alias("near"))
    every = copies.select("idx", F.col("rep").alias("rep_a"))
    every, crowded = every if asked is None else every.filter(asked), F.broadcast(hot.select(F.col("rep").alias("rep_a")))
    each = every.join(crowded, "rep_a", "left_anti").join(listed, "rep_a").unionByName(every.join(F.broadcast(listed.join(crowded, "rep_a", "left_semi")), "rep_a"))
    near = F.slice(F.filter(F.col("near"), lambda x: x["neighbour"] != F.col("idx")), 1, k)
    return each.select("idx", F.posexplode(near).alias("at", "x")).select("idx", F.col("x.neighbour").alias("neighbour"), (-F.col("x.far")).alias("cosine"), (F.col("at") + 1).cast("int").alias("rank"))
