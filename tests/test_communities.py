import random
from collections import Counter, defaultdict

from quarryweave.operators import graph


def test_communities_are_finished(spark):
    rng = random.Random(41)
    pairs = {(f"a{i:02d}", f"a{i + 1:02d}"): 1 for i in range(60)} | {(f"b{i}", f"c{j}"): 1 for i in range(5) for j in range(6)} | {("x", "y"): 1}
    pairs |= {(f"d{rng.randrange(30):02d}", f"e{rng.randrange(30):02d}"): rng.randint(1, 3) for _ in range(90)}
    # labels travel along a chain of ever heavier links, one link in each round
    pairs |= {(f"f{i:02d}", f"f{i + 1:02d}"): 30 - i for i in range(25)}
    near = defaultdict(dict)
    for (a, b), w in pairs.items():
        near[a][b] = near[b][a] = w
    nodes = spark.createDataFrame([(n,) for n in [*near, "lone"]], "node string")
    rows = spark.createDataFrame([(a, b, w) for (a, b), w in pairs.items()], "a string, b string, weight long")
    got = {r["node"]: r["community"] for r in graph.communities(nodes, rows).collect()}
    assert set(got) == {*near, "lone"} and got["lone"] == "lone" and got["x"] == got["y"]
    for n, others in near.items():
        votes = Counter({got[n]: 0.5})
        for o, w in others.items():
            votes[got[o]] += w
        assert got[n] == min(votes, key=lambda c: (-votes[c], c))
    assert len({got[f"b{i}"] for i in range(5)} | {got[f"c{j}"] for j in range(6)}) == 1
