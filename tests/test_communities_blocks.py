import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from quarryweave.operators import graph, propagation
from quarryweave.queries import graphs


def by_hand(nodes, pairs):
    """The rule of ``communities`` on dictionaries."""
    at = {n: i for i, n in enumerate(sorted(nodes))}
    near = defaultdict(dict)
    for (a, b), w in pairs.items():
        if a in at and b in at:
            near[a][b] = near[b][a] = w
    label, turn = {n: n for n in nodes}, 0
    while True:
        wish = {}
        for n in nodes:
            votes = Counter({label[n]: 0.5})
            for o, w in near[n].items():
                votes[label[o]] += w
            best = min(votes, key=lambda c: (-votes[c], c))
            if best != label[n]:
                wish[n] = best
        if not wish:
            return label
        t = {n: int(propagation._turns(np.array([at[n]]), turn)[0]) for n in wish}
        stays = set()
        for n, w in wish.items():
            for o in near[n].keys() & wish.keys():
                if (w == label[o]) + (wish[o] == label[n]) > (w == wish[o]) + (label[n] == label[o]) and t[n] > t[o]:
                    stays.add(n)
        label |= {n: w for n, w in wish.items() if n not in stays}
        turn += 1


@pytest.mark.parametrize("block", [150, 10_000])
def test_communities_do_not_depend_on_blocks(spark, monkeypatch, block):
    # with few links to a block nearly every label crosses blocks
    monkeypatch.setattr(propagation, "BLOCK_LINKS", block)
    monkeypatch.setattr(propagation, "DEALT_ROWS", 200)
    rng = random.Random(91)
    nodes = [f"n{i}" for i in range(160)]
    pairs = {}
    for _ in range(420):
        a, b = sorted((rng.choice(nodes[20 * (k := rng.randrange(8)) : 20 * k + 20]), rng.choice(nodes[20 * k : 20 * k + 20] if rng.random() < 0.8 else nodes)))
        if a != b:
            pairs[a, b] = rng.choice([1, 1, 2, 300])
    pairs["m", "n1"] = 5  # an end that is no node has no vote
    known = spark.createDataFrame([(n,) for n in [*nodes, nodes[0], "zz"]], "node string")
    rows = spark.createDataFrame([(a, b, w) for (a, b), w in pairs.items()], "a string, b string, weight long")
    got = list(map(tuple, graph.communities(known, rows).collect()))
    assert len(got) == 161 and dict(got) == by_hand([*nodes, "zz"], pairs)


def test_weights_between_communities(spark):
    rng = random.Random(92)
    links = [(2 * rng.randrange(40), 2 * rng.randrange(40) + 1, rng.randint(1, 3)) for _ in range(90)]  # some of them twice
    named = spark.createDataFrame([(f"{'cp'[k % 2]}{k}", k) for k in range(80)], "node string, key long")
    groups, between = graph.keyed_communities(graph.in_order(named, "node"), spark.createDataFrame(links, "a long, b long, weight long"), 90, weights=True)
    of, want = dict(map(tuple, groups.collect())), Counter()
    for a, b, w in links:
        want[of[f"c{a}"], of[f"p{b}"]] += w
        want[of[f"p{b}"], of[f"c{a}"]] += w
    assert {(r["community"], r["other"]): r["weight"] for r in between.collect()} == want


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables here")
def test_partitions_equal_those_of_pairs(spark):
    folder = "/root/testdata/sf0.001"
    got = {r["step"]: (r["groups"], r["modularity"]) for r in graphs.graph_partitions(spark, folder).collect()}
    pairs, first = graphs._pairs(spark, folder), graphs.graph_communities(spark, folder)
    last = graph.attach_small(pairs, first, graphs.LEAST_SIZE)
    for step, groups in (("found", first), ("attached", last)):
        one = graph.modularity(pairs, groups, "node", "community").first()
        assert got[step] == (one["groups"], pytest.approx(one["modularity"], abs=1e-6))
