"""Graph analytics on edge tables: audit, degrees, components, rank, communities, neighbourhoods."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryweave.operators.propagation import propagate
from quarryweave.plans import materialise


def undirected(edges: DataFrame, left: str, right: str, weight: str | None = None) -> DataFrame:
    """``(a, b, weight)``, ``a < b``: one row for each pair of different ends, weights or row counts added up."""
    amount = F.sum(weight) if weight else F.count("*")
    rows = edges.filter(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right)))
    return rows.groupBy(F.least(left, right).alias("a"), F.greatest(left, right).alias("b")).agg(amount.alias("weight"))


def both_ways(pairs: DataFrame) -> DataFrame:
    """``(node, other, weight)``: every pair in both directions."""
    return pairs.select("weight", F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("e")).select("e.*", "weight")


def degrees(nodes: DataFrame, edges: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, degree)`` over all rows with both ends among the nodes; a self-loop counts two, a lone node zero."""
    known = nodes.select("node").distinct()
    valid = edges.select(F.col(left).alias("l"), F.col(right).alias("r")).join(known.withColumnRenamed("node", "l"), "l", "left_semi").join(known.withColumnRenamed("node", "r"), "r", "left_semi")
    ends = valid.select(F.explode(F.array("l", "r")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
    return known.join(ends, "node", "left").select("node", F.coalesce("degree", F.lit(0)).alias("degree"))


def audit(nodes: DataFrame, edges: DataFrame, left: str, right: str) -> DataFrame:
    """One row of counts over an entity table (``node``) and a directed edge table."""
    known = nodes.select("node").distinct()
    tagged = edges.select(F.col(left).alias("l"), F.col(right).alias("r"))
    tagged = tagged.join(known.select(F.col("node").alias("l"), F.lit(True).alias("l_known")), "l", "left").join(known.select(F.col("node").alias("r"), F.lit(True).alias("r_known")), "r", "left")
    ok = F.col("l_known").isNotNull() & F.col("r_known").isNotNull()
    flag = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    missing = lambda c: flag(F.col(c).isNull())
    of_edges = tagged.agg(F.count("*").alias("edge_rows"), missing("l_known").alias("missing_sources"), missing("r_known").alias("missing_targets"), flag(~ok).alias("edges_missing_end"), flag(ok & (F.col("l") == F.col("r"))).alias("self_loops"))
    # pairs as they are directed; a null end is an end of its own
    of_pairs = tagged.groupBy("l", "r").agg(F.count("*").alias("n")).agg(F.count("*").alias("distinct_pairs"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("repeated_rows"))
    of_nodes = nodes.agg(F.count("*").alias("entity_rows"), F.count_distinct("node").alias("entities"))
    deg = degrees(nodes, edges, left, right)
    of_degrees = deg.agg(flag(F.col("degree") == 0).alias("isolated"), F.bround(F.avg("degree"), 6).alias("mean_degree"), F.expr("percentile(degree, 0.5)").alias("median_degree"), F.expr("percentile(degree, 0.9)").alias("p90_degree"), F.max("degree").alias("max_degree"))
    # five tables of one row each, put side by side on a constant key
    out = of_nodes.withColumn("k", F.lit(1))
    for part in (of_edges, of_pairs, of_degrees):
        out = out.join(part.withColumn("k", F.lit(1)), "k")
    return out.drop("k")


def components(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(node, component)``: the smallest node each node is linked with.

    Each round every node goes over to its smallest neighbour's parent, and the links are drawn between
    the parents; they are fewer each time.  A component's smallest node never moves, so it is what is
    left.  The steps are then followed backwards.
    """
    links = materialise(both_ways(pairs).select("node", "other").distinct(), "links")
    every = nodes.select("node").unionByName(links.select("node")).distinct()
    steps: list[DataFrame] = []
    while not links.isEmpty():
        low = links.groupBy("node").agg(F.min("other").alias("near")).select("node", F.least("node", "near").alias("parent"))
        above = low.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        step = materialise(low.join(above, "parent").select("node", F.col("above").alias("parent")), "parents")
        steps.append(step)
        drawn = links.join(step, "node").select(F.col("parent").alias("a"), F.col("other").alias("node")).join(step, "node").select(F.col("a").alias("node"), F.col("parent").alias("other"))
        links = materialise(drawn.filter("node <> other").distinct(), "links")
    resolved: DataFrame | None = None
    for step in reversed(steps):
        if resolved is None:
            resolved = step.select("node", F.col("parent").alias("component"))
        else:
            known = resolved.select(F.col("node").alias("parent"), F.col("component").alias("root"))
            resolved = step.join(known, "parent", "left").select("node", F.coalesce("root", "parent").alias("component"))
    if resolved is None:
        return every.select("node", F.col("node").alias("component"))
    return every.join(resolved, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def pagerank(nodes: DataFrame, edges: DataFrame, left: str, right: str, rounds: int = 15, damping: float = 0.85) -> DataFrame:
    """``(node, rank)`` after a fixed number of rounds over directed edge rows, repeats counting each; the rank of nodes without a way out is spread evenly.

    Rows with an end that is null or no node are left out.  Ranks add up to one.
    """
    base = materialise(nodes.select("node").distinct(), "nodes")
    total = base.count()
    if not total:
        return base.select("node", F.lit(0.0).alias("rank"))
    known = edges.select(F.col(left).alias("node"), F.col(right).alias("other")).join(base, "node", "left_semi").join(base.withColumnRenamed("node", "other"), "other", "left_semi")
    weights = known.groupBy("node", "other").agg(F.count("*").alias("weight"))
    out = known.groupBy("node").agg(F.count("*").alias("out"))
    moves = materialise(weights.join(out, "node").select("node", "other", (F.col("weight") / F.col("out")).alias("part")), "moves")
    begun = base.join(out, "node", "left").select("node", F.col("out").isNull().alias("stuck"), F.lit(1.0 / total).alias("rank"))
    rank = materialise(begun, "rank")
    for _ in range(rounds):
        lost = rank.filter("stuck").agg(F.coalesce(F.sum("rank"), F.lit(0.0))).first()[0]
        came = moves.join(rank.select("node", "rank"), "node").select(F.col("other").alias("node"), (F.col("rank") * F.col("part")).alias("came"), F.lit(None).cast("boolean").alias("stuck"))
        # nodes and what comes to them meet in one exchange
        met = came.unionByName(rank.select("node", F.lit(0.0).alias("came"), "stuck")).groupBy("node").agg(F.sum("came").alias("came"), F.max("stuck").alias("stuck"))
        rest = (1 - damping + damping * lost) / total
        rank = materialise(met.select("node", "stuck", (F.lit(rest) + F.lit(damping) * F.col("came")).alias("rank")), "rank")
    return rank.select("node", "rank")


def in_order(nodes: DataFrame, *order: str) -> DataFrame:
    """The rows with ``at``, their place from 0 in the order of some columns."""
    ranked = nodes.repartitionByRange(*order)
    # numbers over a range partitioning: rows of the parts before, then within the part
    ranked = materialise(ranked.withColumn("part", F.spark_partition_id()), "ranked")
    before = ranked.groupBy("part").agg(F.count("*").alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return ranked.withColumn("place", place).join(F.broadcast(before.select("part", "offset")), "part").withColumn("at", (F.col("place") - 1 + F.col("offset")).cast("long")).drop("part", "place", "offset")


def communities(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(node, community)`` by weighted label propagation: the heaviest label around, of equal ones the smallest; own label counts half a link.

    Rounds go on until no node would change.  Of two linked nodes whose changes undo each other (each goes
    where the other leaves, as between the sides of a bipartite graph) only the one with the smaller hash of
    node and round changes.  So the weight of links inside communities rises by more than half a link with
    every change, and the rounds come to an end.  Weights are whole numbers of links.
    """
    named = materialise(in_order(nodes.select("node").distinct(), "node").withColumn("key", F.col("at")), "nodes")
    end = lambda n: named.select(F.col("node").alias(n), F.col("key").alias(f"k_{n}"))
    keyed = materialise(pairs.join(end("a"), "a").join(end("b"), "b").select(F.col("k_a").alias("a"), F.col("k_b").alias("b"), "weight"), "links")
    return keyed_communities(named, keyed, keyed.count())[0]


def keyed_communities(named: DataFrame, links: DataFrame, size: int, weights: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """``communities`` of nodes (``node``, ``key``, and ``at``, its place in their order) over about ``size`` links of keys, which may be repeated.

    With ``weights`` also ``(community, other, weight)``, as ``between_groups`` has it.
    """
    found, between = propagate(named, links, named.count(), size, weights)
    name = lambda at, n: named.select(F.col("at").alias(at), F.col("node").alias(n))
    # a node without a key has no links
    labels = named.select("node", "at").join(found, "at", "left").select("node", F.coalesce("label", "at").alias("label"))
    groups = materialise(labels.join(name("label", "community"), "label").select("node", "community"), "labels")
    if weights:
        between = materialise(between.join(name("label", "community"), "label").join(name("other", "name"), "other").select("community", F.col("name").alias("other"), "weight"), "between")
    return groups, between


def neighbourhood(pairs: DataFrame, seeds: DataFrame, hops: int) -> DataFrame:
    """``(node, hop)`` of all nodes within ``hops`` of the seeds (``node``), each at its least distance."""
    links = both_ways(pairs).select("node", "other").distinct()
    reached = seeds.select("node").distinct().withColumn("hop", F.lit(0))
    edge = reached
    for hop in range(1, hops + 1):
        edge = edge.join(links, "node").select(F.col("other").alias("node")).distinct().join(reached.select("node"), "node", "left_anti").withColumn("hop", F.lit(hop))
        reached = reached.unionByName(edge)
    return reached


def bounded_neighbourhood(pairs: DataFrame, centres: DataFrame, hops: int, max_nodes: int = 64, max_edges: int = 128) -> tuple[DataFrame, DataFrame]:
    """``nodes(centre, node, hop, at, truncated)`` and ``edges(centre, a, b, at, truncated)`` around each centre (``node``).

    Nodes are visited in the order of the node they are reached from, then by name; once ``max_nodes``
    are reached (the centre is one) the search ends and is marked truncated.  Edges are those between
    reached nodes, in order of their ends, at most ``max_edges`` of them.  A centre without links is alone.
    """
    links = both_ways(pairs).select("node", "other").distinct()
    reached = centres.select(F.col("node").alias("centre"), "node").distinct().withColumn("hop", F.lit(0)).withColumn("at", F.lit(0)).withColumn("truncated", F.lit(False))
    for hop in range(1, hops + 1):
        # from the last hop's nodes, unless the search around the centre has ended
        edge = reached.filter((F.col("hop") == hop - 1) & ~F.col("truncated")).join(links, "node").groupBy("centre", F.col("other").alias("node")).agg(F.min("at").alias("reached_from"))
        seen = reached.groupBy("centre").agg(F.count("*").alias("n"))
        fresh = edge.join(reached.select("centre", "node"), ["centre", "node"], "left_anti").join(seen, "centre")
        order = Window.partitionBy("centre").orderBy("reached_from", "node")
        placed = fresh.withColumn("place", F.row_number().over(order)).filter(F.col("place") + F.col("n") <= max_nodes + 1)
        placed = placed.withColumn("at", (F.col("place") + F.col("n") - 1).cast("int"))
        # one node over the limit tells that there are more; it is taken off again
        over = placed.filter(F.col("at") >= max_nodes).select("centre", F.lit(True).alias("cut"))
        kept = placed.filter(F.col("at") < max_nodes).select("centre", "node", F.lit(hop).alias("hop"), "at", F.lit(False).alias("truncated"))
        reached = reached.unionByName(kept).join(over, "centre", "left").select("centre", "node", "hop", "at", (F.col("truncated") | F.col("cut").isNotNull()).alias("truncated"))
        reached = materialise(reached, "reached")
    inside = reached.select("centre", F.col("node").alias("a")).join(pairs.select("a", "b").distinct(), "a").join(reached.select("centre", F.col("node").alias("b")), ["centre", "b"])
    numbered = inside.withColumn("at", F.row_number().over(Window.partitionBy("centre").orderBy("a", "b"))).filter(F.col("at") <= max_edges + 1)
    more = numbered.filter(F.col("at") > max_edges).select("centre", F.lit(True).alias("cut"))
    edges = numbered.filter(F.col("at") <= max_edges).join(more, "centre", "left").select("centre", "a", "b", "at", F.col("cut").isNotNull().alias("truncated"))
    return reached, edges


def between_groups(pairs: DataFrame, groups: DataFrame, node: str, group: str) -> DataFrame:
    """``(community, other, weight)``: weights between groups in both directions, those inside a group twice."""
    of = groups.select(F.col(node).alias("node"), F.col(group).alias("g"))
    tagged = pairs.join(of.select(F.col("node").alias("a"), F.col("g").alias("ga")), "a").join(of.select(F.col("node").alias("b"), F.col("g").alias("gb")), "b")
    ways = F.array(F.struct(F.col("ga").alias("community"), F.col("gb").alias("other")), F.struct(F.col("gb").alias("community"), F.col("ga").alias("other")))
    return tagged.select("weight", F.explode(ways).alias("e")).groupBy("e.community", "e.other").agg(F.sum("weight").alias("weight"))


def modularity(pairs: DataFrame, groups: DataFrame, node: str, group: str, resolution: float = 1.0) -> DataFrame:
    """One row: how much more weight lies inside groups than the degrees of their nodes let expect, from -0.5 to 1."""
    return modularity_between(between_groups(pairs, groups, node, group), resolution)


def modularity_between(between: DataFrame, resolution: float = 1.0) -> DataFrame:
    """``modularity`` by the weights between groups (``between_groups``)."""
    sums = between.groupBy("community").agg(F.sum("weight").alias("degree"), F.sum(F.when(F.col("community") == F.col("other"), F.col("weight")).otherwise(0)).alias("inside"))
    whole = sums.agg(F.sum("degree").alias("whole"), F.sum("inside").alias("inside"), F.sum(F.col("degree").cast("double") * F.col("degree")).alias("squares"), F.count("*").alias("groups"))
    return whole.select("groups", (F.col("inside") / F.col("whole") - F.lit(resolution) * F.col("squares") / (F.col("whole").cast("double") * F.col("whole"))).alias("modularity"))


def attach_small(pairs: DataFrame, groups: DataFrame, least: int) -> DataFrame:
    """``(node, community)``: nodes of groups below a size go to the large group that their group shares most weight with.

    Of equal weights the smaller name wins; a small group that touches no large one stays as it is.
    """
    major = attached_between(between_groups(pairs, groups, "node", "community"), groups, least)
    return groups.join(major, "community").select("node", F.col("major").alias("community"))


def attached_between(between: DataFrame, groups: DataFrame, least: int) -> DataFrame:
    """``(community, major)``: each group and the one ``attach_small`` lets its nodes go to, often itself."""
    sizes = materialise(groups.groupBy("community").agg((F.count("*") >= least).alias("large")), "sized")
    cross = between.join(sizes.filter("not large").select("community"), "community", "left_semi").join(sizes.filter("large").select(F.col("community").alias("other")), "other", "left_semi")
    best = cross.groupBy("community").agg(F.min(F.struct((-F.col("weight")).alias("w"), F.col("other").alias("major"))).alias("b"))
    return sizes.join(best, "community", "left").select("community", F.coalesce("b.major", "community").alias("major"))


def ordered_groups(groups: DataFrame) -> DataFrame:
    """``(node, community, number)``: groups numbered from 0 by falling size, then by their smallest node."""
    sizes = groups.groupBy("community").agg(F.count("*").alias("size"), F.min("node").alias("first"))
    ranked = sizes.repartitionByRange(F.desc("size"), "first")
    # numbers over a range partitioning: groups of the parts before, then within the part
    ranked = materialise(ranked.withColumn("part", F.spark_partition_id()), "ranked")
    before = ranked.groupBy("part").agg(F.count("*").alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("size"), "first"))
    numbered = ranked.withColumn("place", place).join(before, "part").select("community", (F.col("place") - 1 + F.col("offset")).cast("long").alias("number"))
    return groups.join(numbered, "community").select("node", "community", "number")


def damped_degrees(pairs: DataFrame, threshold: int = 120, exponent: float = 0.55) -> DataFrame:
    """``(node, degree, weighted_degree)``: weights of links to hubs over the threshold shrink by a power of the excess."""
    links = both_ways(pairs)
    degree = links.groupBy("node").agg(F.count_distinct("other").alias("degree"))
    shrink = F.when(F.col("hub") > threshold, F.pow(F.lit(float(threshold)) / F.col("hub"), F.lit(exponent))).otherwise(F.lit(1.0))
    damped = links.join(degree, "node").join(degree.select(F.col("node").alias("other"), F.col("degree").alias("other_degree")), "other")
    damped = damped.withColumn("hub", F.greatest("degree", "other_degree")).withColumn("damped", F.col("weight") * shrink)
    return damped.groupBy("node").agg(F.max("degree").alias("degree"), F.sum("damped").alias("weighted_degree"))
