"""Graph queries over all order lines, against brute force on tables whose lines are mostly small."""

import math
import random
from collections import Counter, defaultdict

import pytest

from quarryweave.queries import graphs
from tests.conftest import rows_of

NAMES = ("graph_audit", "graph_degree_percentiles", "graph_top_hubs", "graph_taxonomy", "graph_components", "graph_component_sizes", "graph_satellites", "graph_pagerank", "graph_layout_edges", "graph_damped_degrees", "graph_rank_scale", "graph_neighbourhood_1", "graph_neighbourhood_2", "graph_attachment")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(21)
    customers = [(i, f"C{i:03d}", i % 4, rng.choice(["A", "B"])) for i in range(60)]
    parts = [(i, f"P{i:03d}", f"Brand{i % 3}", 50 if i % 40 == 7 else 1) for i in range(260)]
    # customer 0 is a hub, 1 to 29 share the parts below 160, 30 to 49 have two parts of their own, the rest none
    links = [(0, p) for p in range(150)] + [(rng.randrange(1, 30), rng.randrange(160)) for _ in range(200)] + [(c, 160 + 2 * (c - 30) + k) for c in range(30, 50) for k in (0, 1)]
    links += links[:20]
    lines = [(i, p, c, float(rng.choice([1, 7, 30, 49, 50]))) for i, (c, p) in enumerate(links)]
    folder = str(tmp_path_factory.mktemp("lines"))
    write = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    write(customers, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string", "customer")
    write(parts, "p_partkey long, p_name string, p_brand string, p_size int", "part")
    write([(i, c) for i, _, c, _ in lines], "o_orderkey long, o_custkey long", "orders")
    write([(i, p, q) for i, p, _, q in lines], "l_orderkey long, l_partkey long, l_quantity double", "lineitem")
    return folder, customers, parts, lines


def point(values, p):
    values, at = sorted(values), p * (len(values) - 1)
    low = math.floor(at)
    return values[low] + (at - low) * (values[min(low + 1, len(values) - 1)] - values[low])


def brute(customers, parts, lines):
    kind = {f"c{c[0]}": c[3] for c in customers} | {f"p{p[0]}": p[2] for p in parts}
    name = {f"c{c[0]}": c[1] for c in customers} | {f"p{p[0]}": p[1] for p in parts}
    edges = [(f"c{c}", f"p{p}", int(q)) for _, p, c, q in lines]
    pairs, amount, near = Counter((a, b) for a, b, _ in edges), Counter(), defaultdict(set)
    degree = Counter({n: 0 for n in kind})
    for a, b, q in edges:
        amount[a, b] += q
        near[a].add(b), near[b].add(a)
        degree.update((a, b))
    values, out = list(degree.values()), {}
    out["graph_audit"] = [(len(kind), len(kind), len(edges), 0, 0, 0, 0, len(pairs), len(edges) - len(pairs), values.count(0), round(sum(values) / len(values), 6), point(values, 0.5), point(values, 0.9), max(values))]
    out["graph_degree_percentiles"] = [tuple(point(values, p) for p in (0.5, 0.9, 0.99, 0.999))]
    out["graph_top_hubs"] = sorted((n, degree[n], name[n]) for n in sorted(degree, key=lambda n: (-degree[n], name[n], n))[:20])
    kinds = Counter((kind[a], kind[b]) for a, b, _ in edges)
    out["graph_taxonomy"] = sorted((*k, n, round(n / len(edges), 6)) for k, n in kinds.items())

    def reach(n):
        seen, todo = {n}, [n]
        while todo:
            fresh = near[todo.pop()] - seen
            seen |= fresh
            todo += fresh
        return seen

    component = {n: min(reach(n)) for n in kind}
    sizes = Counter(component.values())
    out["graph_components"] = sorted(component.items())
    out["graph_component_sizes"] = sorted(Counter(sizes.values()).items())
    largest, satellites = min(sizes, key=lambda c: (-sizes[c], c)), defaultdict(lambda: [0, 0])
    for c, size in sizes.items():
        if c != largest:
            count = Counter(kind[n] for n in kind if component[n] == c)
            held = satellites[min(count, key=lambda k: (-count[k], k))]
            held[0], held[1] = held[0] + 1, held[1] + size
    out["graph_satellites"] = sorted((k, *v) for k, v in satellites.items())
    weight = lambda n, o: pairs[(n, o) if n[0] == "c" else (o, n)]
    rank, out_of = {n: 1 / len(kind) for n in kind}, Counter(a for a, _, _ in edges)
    for _ in range(10):
        lost = sum(rank[n] for n in kind if not out_of[n])
        rank = {n: (0.15 + 0.85 * lost) / len(kind) + 0.85 * sum(rank[o] * pairs[o, n] / out_of[o] for o in near[n] if (o, n) in pairs) for n in kind}
    out["graph_pagerank"] = sorted(rank.items())
    out["graph_layout_edges"] = sorted((a, b, w) for (a, b), w in amount.items())
    shrink = lambda n, o: (120 / max(120, len(near[n]), len(near[o]))) ** 0.55
    out["graph_damped_degrees"] = sorted((n, len(near[n]), sum(weight(n, o) * shrink(n, o) for o in near[n])) for n in kind if near[n])
    held = Counter()
    for (a, b), w in amount.items():
        held[a] += w
        held[b] += w
    logs = {n: math.log1p(w) for n, w in held.items()}
    low, high = point(logs.values(), 0.05), point(logs.values(), 0.995)
    out["graph_rank_scale"] = sorted((n, max(0.0, min(1.0, (x - low) / (high - low)))) for n, x in logs.items())
    for hops in (1, 2):
        rows = []
        for centre in (f"p{p[0]}" for p in parts if p[3] == 50):
            order, edge, cut = {centre: 0}, [centre], False
            for hop in range(1, hops + 1):
                edge, last = [], edge
                for n in last:
                    for o in sorted(near[n]):
                        if o not in order and not cut:
                            if len(order) >= graphs.MAX_NODES:
                                cut = True
                            else:
                                order[o] = hop
                                edge.append(o)
                if cut:
                    break
            inner = sum(a in order and b in order for a, b in pairs)
            rows += [(centre, n, hop, at, cut, min(inner, graphs.MAX_EDGES), inner > graphs.MAX_EDGES) for at, (n, hop) in enumerate(order.items())]
        out[f"graph_neighbourhood_{hops}"] = sorted(rows)
    nation, of = {f"c{c[0]}": c[2] for c in customers}, Counter()
    for (a, b), w in amount.items():
        of[nation[a], b] += w
    cross = {g: {h: sum(min(of[g, p], of[h, p]) for p in kind if p[0] == "p") for h in range(4) if h != g} for g in range(4)}
    out["graph_attachment"] = [(g, h, cross[g][h]) for g in range(4) for h in [min(cross[g], key=lambda h: (-cross[g][h], h))]]
    return out


@pytest.fixture(scope="module")
def wanted(tables):
    return brute(*tables[1:])


@pytest.mark.parametrize("name", NAMES)
def test_all_lines_count(spark, tables, wanted, name):
    got = rows_of(graphs.QUERIES[name](spark, tables[0]))
    assert len(got) == len(wanted[name])
    for row, want in zip(got, wanted[name], strict=True):
        for x, y in zip(row, want, strict=True):
            assert x == pytest.approx(y, abs=1.1e-5) if isinstance(y, float) else x == y


def test_entry_counts_all_lines(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).first()["edge_rows"] == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
