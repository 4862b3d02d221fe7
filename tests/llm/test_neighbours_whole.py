import numpy as np
import pytest

from quarryweave import plans
from quarryweave.llm import neighbours


def rows_of(spark, x, first=0):
    return spark.createDataFrame([(first + i, [float(v) for v in row]) for i, row in enumerate(x)], "n long, e array<float>")


def true_neighbours(x, k=10):
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    sims = unit @ unit.T
    np.fill_diagonal(sims, -2)
    return {(i, int(j)) for i in range(len(x)) for j in np.argsort(-sims[i], kind="stable")[:k]}


def test_the_exact_way_misses_none(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_QUERIES", 300)
    monkeypatch.setattr(neighbours, "CELL_ROWS", 400)
    # without clusters the nearest are spread over many shards
    x = np.random.default_rng(51).normal(size=(1000, 16)).astype(np.float32)
    got = {(r["idx"], r["neighbour"]) for r in neighbours.most_similar(rows_of(spark, x), "n", "e", k=10, dim=16, shard_rows=40, exact=True).collect()}
    assert got == true_neighbours(x)


@pytest.mark.parametrize("one_level", [512, 20])
def test_recall_with_many_shards(spark, one_level):
    rng = np.random.default_rng(52)
    middles = rng.normal(size=(60, 24))
    x = (middles[rng.integers(0, 60, 6400)] + 0.8 * rng.normal(size=(6400, 24))).astype(np.float32)
    near = neighbours.most_similar(rows_of(spark, x), "n", "e", k=10, dim=24, shard_rows=40, one_level=one_level)  # 160 shards
    got = {(r["idx"], r["neighbour"]) for r in near.collect()}
    want = true_neighbours(x)
    assert len(got) == 64_000 and len(got & want) >= 0.98 * len(want)


def test_margin_asks_few_where_topics_are_apart():
    rng = np.random.default_rng(53)
    middles = rng.normal(size=(50, 24))
    x = middles[rng.integers(0, 50, 4000)] + 0.2 * rng.normal(size=(4000, 24))
    unit = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    centres = neighbours.Centres(neighbours.fit_centres(unit, 50))
    rows, _, _ = centres.near(unit, neighbours.fit_margin(centres, unit, 10))
    assert len(rows) <= 6 * len(unit)


def test_a_vector_of_very_many_copies(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "HOT_LEAST", 20)
    x = np.random.default_rng(54).normal(size=(300, 8)).astype(np.float32)
    df = rows_of(spark, x).unionByName(rows_of(spark, np.repeat(x[:1], 150, axis=0), 1000))
    got = {}
    for r in neighbours.most_similar(df, "n", "e", k=5, dim=8).collect():
        got.setdefault(r["idx"], []).append((r["rank"], r["neighbour"], round(r["cosine"], 6)))
    copies = [0, *range(1000, 1150)]
    assert len(got) == 450
    for i in copies:
        assert [n for _, n, _ in sorted(got[i])] == [c for c in copies if c != i][:5] and all(c == 1.0 for _, _, c in got[i])


def test_vectors_are_not_stored(spark, monkeypatch):
    rng = np.random.default_rng(55)
    middles = rng.normal(size=(12, 64))
    x = (middles[rng.integers(0, 12, 3000)] + 0.2 * rng.normal(size=(3000, 64))).astype(np.float32)
    df = neighbours.materialise(rows_of(spark, x).unionByName(rows_of(spark, x[:3], 5000)).unionByName(rows_of(spark, x[:9])), "given")
    tables = []
    monkeypatch.setattr(neighbours, "materialise", lambda d, label: tables.append(d) or plans.materialise(d, label))
    got = {(r["idx"], r["neighbour"]) for r in neighbours.most_similar(df, "n", "e", k=10, dim=64, shard_rows=250, at_least=0.9).collect()}
    assert not any("vec" in d.columns for d in tables)
    unit = np.vstack([x, x[:3]]).astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    names = np.append(np.arange(3000), [5000, 5001, 5002])
    sims = unit @ unit.T
    np.fill_diagonal(sims, -2)
    sims = np.round(sims, 12)
    want = {(int(names[i]), int(names[j])) for i in range(len(names)) for j in np.lexsort((names, -sims[i]))[:10] if sims[i, j] >= 0.9}
    assert len(want) > 1000 and len(want - got) <= 0.01 * len(want)
