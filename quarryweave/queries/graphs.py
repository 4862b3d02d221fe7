"""Graph queries over customers and parts that all order lines link."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryweave.operators import graph as G
from quarryweave.plans import materialise, read_table

#: Links over which a node is a hub.
HUB = 120
#: Nodes and edges shown around a node, nodes a community has at least.
MAX_NODES, MAX_EDGES, LEAST_SIZE = 64, 128, 8


def _edges(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each order line."""
    lines = read_table(spark, folder, "lineitem")
    lines = lines.select("l_orderkey", "l_partkey", F.col("l_quantity").cast("long").alias("quantity"))
    orders = read_table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return lines.join(orders, "l_orderkey").select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("l"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("r"), "quantity")


def _nodes(spark: SparkSession, folder: str) -> DataFrame:
    customers = read_table(spark, folder, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("node"), F.col("c_mktsegment").alias("kind"), F.col("c_name").alias("name"))
    parts = read_table(spark, folder, "part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("node"), F.col("p_brand").alias("kind"), F.col("p_name").alias("name"))
    return customers.unionByName(parts)


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    return materialise(G.undirected(_edges(spark, folder), "l", "r"), "pairs")


def graph_audit(spark, folder):
    return G.audit(_nodes(spark, folder), materialise(_edges(spark, folder), "edges"), "l", "r")


def graph_degree_percentiles(spark, folder):
    deg = G.degrees(_nodes(spark, folder), materialise(_edges(spark, folder), "edges"), "l", "r")
    return deg.agg(*(F.expr(f"percentile(degree, {p})").alias(n) for p, n in ((0.5, "p50"), (0.9, "p90"), (0.99, "p99"), (0.999, "p999"))))


def graph_top_hubs(spark, folder):
    deg = G.degrees(_nodes(spark, folder), materialise(_edges(spark, folder), "edges"), "l", "r")
    return deg.join(_nodes(spark, folder).select("node", "name"), "node").orderBy(F.desc("degree"), "name", "node").limit(20)


def graph_taxonomy(spark, folder):
    nodes = _nodes(spark, folder).select("node", "kind")
    rows = _edges(spark, folder).join(nodes.withColumnRenamed("node", "l").withColumnRenamed("kind", "source_kind"), "l", "left").join(nodes.withColumnRenamed("node", "r").withColumnRenamed("kind", "target_kind"), "r", "left")
    counts = rows.groupBy(F.coalesce("source_kind", F.lit("missing")).alias("source_kind"), F.coalesce("target_kind", F.lit("missing")).alias("target_kind")).agg(F.count("*").alias("edges"))
    total = counts.agg(F.sum("edges")).scalar()
    return counts.withColumn("frequency", F.bround(F.col("edges") / total, 6))


def graph_components(spark, folder):
    return G.components(_nodes(spark, folder), _pairs(spark, folder))


def graph_component_sizes(spark, folder):
    sizes = graph_components(spark, folder).groupBy("component").agg(F.count("*").alias("size"))
    return sizes.groupBy("size").agg(F.count("*").alias("components"))


def graph_satellites(spark, folder):
    """Components outside the largest, by the kind that most of their nodes have: how many, how many nodes."""
    of = graph_components(spark, folder).join(_nodes(spark, folder).select("node", "kind"), "node", "left")
    kinds = of.groupBy("component", "kind").agg(F.count("*").alias("n"))
    best = kinds.groupBy("component").agg(F.min(F.struct((-F.col("n")).alias("n"), "kind")).alias("b"), F.sum("n").alias("size"))
    largest = best.orderBy(F.desc("size"), "component").limit(1).select("component")
    rest = best.join(largest, "component", "left_anti")
    return rest.groupBy(F.col("b.kind").alias("kind")).agg(F.count("*").alias("components"), F.sum("size").alias("nodes"))


def graph_pagerank(spark, folder):
    """Parts have no way out, so that their rank is spread evenly."""
    return G.pagerank(_nodes(spark, folder), materialise(_edges(spark, folder), "edges"), "l", "r", rounds=10).select("node", F.round("rank", 7).alias("rank"))


def _communities(spark, folder, weights=False):
    """Communities over customers of even keys and parts of odd ones, each order line a link; and the weight between communities."""
    key = lambda c, odd: 2 * F.col(c).cast("long") + odd
    name = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    customers, parts = read_table(spark, folder, "customer"), read_table(spark, folder, "part")
    nodes = customers.select(name("c", "c_custkey").alias("node"), key("c_custkey", 0).alias("key")).unionByName(parts.select(name("p", "p_partkey").alias("node"), key("p_partkey", 1).alias("key")))
    orders = read_table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    links = lines.join(orders, "l_orderkey").select(key("o_custkey", 0).alias("a"), key("l_partkey", 1).alias("b"), F.lit(1).alias("weight"))
    return G.keyed_communities(materialise(G.in_order(nodes.distinct(), "node"), "nodes"), links, lines.count(), weights)


def graph_communities(spark, folder):
    return _communities(spark, folder)[0]


def graph_layout_edges(spark, folder):
    return G.undirected(_edges(spark, folder), "l", "r", "quantity")


def graph_damped_degrees(spark, folder):
    return G.damped_degrees(_pairs(spark, folder), threshold=HUB).select("node", "degree", F.round("weighted_degree", 6).alias("weighted_degree"))


def graph_rank_scale(spark, folder):
    """Weighted degrees on a scale of 0 to 1 between their 5 and 99.5 per cent points."""
    ends = G.both_ways(graph_layout_edges(spark, folder)).groupBy("node").agg(F.log1p(F.sum("weight")).alias("x"))
    ends = materialise(ends, "ends")
    low, high = ends.agg(F.expr("percentile(x, 0.05)")).scalar(), ends.agg(F.expr("percentile(x, 0.995)")).scalar()
    return ends.select("node", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("x") - low) / (high - low))), 5).alias("rank"))


def _seeds(spark, folder):
    return read_table(spark, folder, "part").filter("p_size = 50").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("node"))


def _neighbourhood(spark, folder, hops):
    nodes, edges = G.bounded_neighbourhood(_pairs(spark, folder), _seeds(spark, folder), hops, MAX_NODES, MAX_EDGES)
    counted = edges.groupBy("centre").agg(F.count("*").alias("edges"), F.max("truncated").alias("edges_truncated"))
    return nodes.join(counted, "centre", "left").select("centre", "node", "hop", F.col("at").alias("place"), F.col("truncated").alias("nodes_truncated"), F.coalesce("edges", F.lit(0)).alias("edges"), F.coalesce("edges_truncated", F.lit(False)).alias("edges_truncated"))


def graph_neighbourhood_1(spark, folder):
    return _neighbourhood(spark, folder, 1)


def graph_neighbourhood_2(spark, folder):
    return _neighbourhood(spark, folder, 2)


def graph_partitions(spark, folder):
    """Communities, small ones attached to the major one they share most weight with, numbered by size; and how good both are."""
    first, between = _communities(spark, folder, weights=True)
    major = materialise(G.attached_between(between, first, LEAST_SIZE), "attached")
    last = G.ordered_groups(first.join(major, "community").select("node", F.col("major").alias("community")))
    numbers = last.select(F.col("community").alias("major"), "number").distinct()
    number = materialise(major.join(numbers, "major").select("community", "number"), "numbers")
    after = between.join(number, "community").join(number.select(F.col("community").alias("other"), F.col("number").alias("n")), "other").groupBy(F.col("number").alias("community"), F.col("n").alias("other")).agg(F.sum("weight").alias("weight"))
    rows = [G.modularity_between(between).withColumn("step", F.lit("found")), G.modularity_between(after).withColumn("step", F.lit("attached"))]
    return rows[0].unionByName(rows[1]).select("step", "groups", F.round("modularity", 6).alias("modularity"))


def graph_attachment(spark, folder):
    """Order weight between the customers' nations, the strongest partner of each: cross weight and the winner."""
    of = read_table(spark, folder, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("l"), F.col("c_nationkey").alias("group_no"))
    lines = _edges(spark, folder).join(of, "l").groupBy("group_no", "r").agg(F.sum("quantity").alias("w"))
    cross = lines.join(lines.select(F.col("group_no").alias("other_no"), "r", F.col("w").alias("v")), "r").filter("group_no <> other_no")
    sums = cross.groupBy("group_no", "other_no").agg(F.sum(F.least("w", "v")).alias("weight"))
    best = sums.groupBy("group_no").agg(F.min(F.struct((-F.col("weight")).alias("w"), "other_no")).alias("b"))
    return best.select("group_no", F.col("b.other_no").alias("other_no"), (-F.col("b.w")).alias("weight"))


_E = f"e AS (SELECT 'c' || o_custkey AS l, 'p' || l_partkey AS r, CAST(l_quantity AS BIGINT) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
_N = "n AS (SELECT 'c' || c_custkey AS node, c_mktsegment AS kind, c_name AS name FROM customer UNION ALL SELECT 'p' || p_partkey, p_brand, p_name FROM part)"
_P = "p AS (SELECT least(l, r) AS a, greatest(l, r) AS b, count(*) AS weight FROM e GROUP BY 1, 2)"
_D = "d AS (SELECT node, coalesce(c, 0) AS degree FROM n LEFT JOIN (SELECT x AS node, count(*) AS c FROM (SELECT l AS x FROM e UNION ALL SELECT r FROM e) GROUP BY 1) USING (node))"
_B = "b AS (SELECT a AS node, b AS other, weight FROM p UNION ALL SELECT b, a, weight FROM p)"



def _around(hops: int) -> str:
    """SQL of bounded neighbourhoods of one or two hops."""
    one = f"h1 AS (SELECT s.node AS centre, other AS node, row_number() OVER (PARTITION BY s.node ORDER BY other) AS place FROM s JOIN (SELECT DISTINCT node, other FROM b) b USING (node)), c1 AS (SELECT centre FROM h1 WHERE place >= {MAX_NODES}), k1 AS (SELECT * FROM h1 WHERE place < {MAX_NODES})"
    two = f"h2 AS (SELECT centre, node, (SELECT count(*) FROM k1 z WHERE z.centre = y.centre) + row_number() OVER (PARTITION BY centre ORDER BY up, node) AS place FROM (SELECT k1.centre, b.other AS node, min(k1.place) AS up FROM k1 JOIN b ON b.node = k1.node WHERE k1.centre NOT IN (SELECT centre FROM c1) AND b.other <> k1.centre AND NOT EXISTS (SELECT 1 FROM k1 x WHERE x.centre = k1.centre AND x.node = b.other) GROUP BY 1, 2) y), c2 AS (SELECT centre FROM h2 WHERE place >= {MAX_NODES}), k2 AS (SELECT * FROM h2 WHERE place < {MAX_NODES})"
    more, cut = (f", {two}", "SELECT centre FROM c1 UNION SELECT centre FROM c2") if hops == 2 else ("", "SELECT centre FROM c1")
    rows = "SELECT node AS centre, node, 0 AS hop, 0 AS place FROM s UNION ALL SELECT centre, node, 1, place FROM k1" + (" UNION ALL SELECT centre, node, 2, place FROM k2" if hops == 2 else "")
    return f"WITH {_E}, {_P}, {_B}, s AS (SELECT 'p' || p_partkey AS node FROM part WHERE p_size = 50), {one}{more}, r AS ({rows}), g AS (SELECT x.centre, count(*) AS n FROM r x JOIN p ON p.a = x.node JOIN r y ON y.centre = x.centre AND y.node = p.b GROUP BY 1) SELECT r.centre, node, hop, CAST(place AS INT) AS place, r.centre IN ({cut}) AS nodes_truncated, CAST(least(coalesce(n, 0), {MAX_EDGES}) AS BIGINT) AS edges, coalesce(n, 0) > {MAX_EDGES} AS edges_truncated FROM r LEFT JOIN g USING (centre)"


ORACLE_SQL = {
    "graph_audit": f"WITH {_E}, {_N}, {_D}, pr AS (SELECT count(*) AS m FROM e GROUP BY l, r) SELECT (SELECT count(*) FROM n) AS entity_rows, (SELECT count(DISTINCT node) FROM n) AS entities, (SELECT count(*) FROM e) AS edge_rows, (SELECT count(*) FROM e WHERE l NOT IN (SELECT node FROM n)) AS missing_sources, (SELECT count(*) FROM e WHERE r NOT IN (SELECT node FROM n)) AS missing_targets, (SELECT count(*) FROM e WHERE l NOT IN (SELECT node FROM n) OR r NOT IN (SELECT node FROM n)) AS edges_missing_end, (SELECT count(*) FROM e WHERE l = r) AS self_loops, (SELECT count(*) FROM pr) AS distinct_pairs, (SELECT CAST(sum(m - 1) AS BIGINT) FROM pr) AS repeated_rows, CAST(count(*) FILTER (degree = 0) AS BIGINT) AS isolated, round_even(avg(degree), 6) AS mean_degree, quantile_cont(degree, 0.5) AS median_degree, quantile_cont(degree, 0.9) AS p90_degree, max(degree) AS max_degree FROM d",
    "graph_degree_percentiles": f"WITH {_E}, {_N}, {_D} SELECT quantile_cont(degree, 0.5) AS p50, quantile_cont(degree, 0.9) AS p90, quantile_cont(degree, 0.99) AS p99, quantile_cont(degree, 0.999) AS p999 FROM d",
    "graph_top_hubs": f"WITH {_E}, {_N}, {_D} SELECT d.node, degree, name FROM d JOIN n ON n.node = d.node ORDER BY degree DESC, name, d.node LIMIT 20",
    "graph_taxonomy": f"WITH {_E}, {_N} SELECT coalesce(a.kind, 'missing') AS source_kind, coalesce(z.kind, 'missing') AS target_kind, count(*) AS edges, round_even(count(*) / CAST((SELECT count(*) FROM e) AS DOUBLE), 6) AS frequency FROM e LEFT JOIN n a ON a.node = l LEFT JOIN n z ON z.node = r GROUP BY 1, 2",
    "graph_pagerank": f"WITH RECURSIVE {_E}, {_N}, o AS (SELECT l AS node, count(*) AS out FROM e GROUP BY 1), m AS (SELECT l AS node, r AS other, count(*) / CAST(any_value(out) AS DOUBLE) AS part FROM e JOIN o ON o.node = l GROUP BY 1, 2), t AS (SELECT count(*) AS total FROM n), pr(i, node, rank) AS (SELECT 0, node, CAST(1.0 AS DOUBLE) / total FROM n, t UNION ALL SELECT i + 1, node, (0.15 + 0.85 * lost) / total + 0.85 * came FROM (SELECT i, x.node, sum(came) AS came, any_value(lost) AS lost, any_value(total) AS total FROM (SELECT i, other AS node, rank * part AS came FROM pr JOIN m USING (node) WHERE i < 10 UNION ALL SELECT i, node, 0.0 FROM pr WHERE i < 10) x, (SELECT coalesce(sum(rank), 0) AS lost FROM pr WHERE node NOT IN (SELECT node FROM o)) d, t GROUP BY i, x.node)) SELECT node, round(rank, 7) AS rank FROM pr WHERE i = 10",
    "graph_layout_edges": f"WITH {_E} SELECT least(l, r) AS a, greatest(l, r) AS b, CAST(sum(quantity) AS BIGINT) AS weight FROM e GROUP BY 1, 2",
    "graph_damped_degrees": f"WITH {_E}, {_P}, {_B}, dg AS (SELECT node, count(DISTINCT other) AS degree FROM b GROUP BY 1) SELECT b.node, max(x.degree) AS degree, round(sum(weight * CASE WHEN greatest(x.degree, y.degree) > {HUB} THEN pow({HUB}.0 / greatest(x.degree, y.degree), 0.55) ELSE 1.0 END), 6) AS weighted_degree FROM b JOIN dg x ON x.node = b.node JOIN dg y ON y.node = b.other GROUP BY 1",
    "graph_rank_scale": f"WITH {_E}, w AS (SELECT x AS node, ln(1 + sum(quantity)) AS x2 FROM (SELECT l AS x, quantity FROM e UNION ALL SELECT r, quantity FROM e) GROUP BY 1), q AS (SELECT quantile_cont(x2, 0.05) AS lo, quantile_cont(x2, 0.995) AS hi FROM w) SELECT node, round(greatest(0.0, least(1.0, (x2 - lo) / (hi - lo))), 5) AS rank FROM w, q",
    "graph_neighbourhood_1": _around(1),
    "graph_neighbourhood_2": _around(2),
    "graph_attachment": f"WITH {_E}, g AS (SELECT c_nationkey AS group_no, r, sum(quantity) AS w FROM e JOIN customer ON l = 'c' || c_custkey GROUP BY 1, 2), x AS (SELECT g.group_no, h.group_no AS other_no, CAST(sum(least(g.w, h.w)) AS BIGINT) AS weight FROM g JOIN g h ON g.r = h.r AND g.group_no <> h.group_no GROUP BY 1, 2) SELECT group_no, other_no, weight FROM x QUALIFY row_number() OVER (PARTITION BY group_no ORDER BY weight DESC, other_no) = 1",
}
QUERIES = {f.__name__: f for f in (graph_audit, graph_degree_percentiles, graph_top_hubs, graph_taxonomy, graph_components, graph_component_sizes, graph_satellites, graph_pagerank, graph_communities, graph_layout_edges, graph_damped_degrees, graph_rank_scale, graph_neighbourhood_1, graph_neighbourhood_2, graph_partitions, graph_attachment)}

