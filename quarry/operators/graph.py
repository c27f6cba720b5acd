"""Graph measures on edge tables.

A graph is ``nodes(node)`` plus undirected simple ``edges(src, dst[, weight])``
with src < dst.  Every operator is joins and aggregations over these tables.

Triangles use degree ordering: each edge is oriented from the lower-ranked to
the higher-ranked end, rank = (degree, node).  A node's higher-ranked
neighbours number at most √(2m), so the wedges generated at one node are
bounded by 2m however large its degree is — a hub never turns into one task
pairing all of its neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize, release


def canonical_edges(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(src, dst, weight): undirected simple edges from endpoint pairs; self
    loops dropped, duplicates counted into weight."""
    e = pairs.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("src"), F.greatest(a, b).alias("dst"))
    return e.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight"))


def both_directions(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def degrees(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(node, degree); isolated nodes get 0 when ``nodes`` is given."""
    d = both_directions(edges).groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("degree"))
    if nodes is None:
        return d
    return nodes.select("node").join(d, "node", "left").select("node", F.coalesce("degree", F.lit(0)).cast("long").alias("degree"))


def summary(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(n_nodes, n_edges, mean_degree); mean degree 0 for an empty graph."""
    n_nodes = nodes.select(F.count(F.lit(1))).scalar()
    n_edges = edges.select(F.count(F.lit(1))).scalar()
    one = nodes.sparkSession.range(1)
    return one.select(
        n_nodes.alias("n_nodes"),
        n_edges.alias("n_edges"),
        F.round(F.coalesce(F.try_divide(2 * n_edges, n_nodes), F.lit(0.0)), 6).alias("mean_degree"),
    )


def oriented(edges: DataFrame) -> DataFrame:
    """(lo, hi, d_hi): each edge pointing from the lower to the higher (degree, node) rank, with
    the degree of its higher end."""
    deg = degrees(edges)
    e = edges.select("src", "dst")
    e = e.join(deg.select(F.col("node").alias("src"), F.col("degree").alias("ds")), "src")
    e = e.join(deg.select(F.col("node").alias("dst"), F.col("degree").alias("dd")), "dst")
    src_lower = (F.col("ds") < F.col("dd")) | ((F.col("ds") == F.col("dd")) & (F.col("src") < F.col("dst")))
    return e.select(
        F.when(src_lower, F.col("src")).otherwise(F.col("dst")).alias("lo"),
        F.when(src_lower, F.col("dst")).otherwise(F.col("src")).alias("hi"),
        F.greatest("ds", "dd").alias("d_hi"),
    )


def ranked_triangles(o: DataFrame) -> DataFrame:
    """(u, v, w) of ``oriented`` edges, ascending in rank — every triangle once.  A wedge is made
    once, not once for either order of its ends."""
    w1 = o.select(F.col("lo").alias("u"), F.col("hi").alias("v"), F.col("d_hi").alias("dv"))
    w2 = o.select(F.col("lo").alias("u"), F.col("hi").alias("w"), F.col("d_hi").alias("dw"))
    wedges = w1.join(w2, "u").where((F.col("dv") < F.col("dw")) | ((F.col("dv") == F.col("dw")) & (F.col("v") < F.col("w")))).select("u", "v", "w")
    close = o.select(F.col("lo").alias("v"), F.col("hi").alias("w"))
    return wedges.join(close, ["v", "w"]).select("u", "v", "w")


def triangles(edges: DataFrame) -> DataFrame:
    """(a, b, c) with a < b < c — every triangle once."""
    tri = ranked_triangles(oriented(edges))
    nodes3 = F.array_sort(F.array("u", "v", "w"))
    return tri.select(nodes3[0].alias("a"), nodes3[1].alias("b"), nodes3[2].alias("c"))


def bowties(edges: DataFrame, tri: DataFrame | None = None) -> DataFrame:
    """Induced bow-ties: (center, a, b, c, d) — triangles (center, a, b) and
    (center, c, d) with a < b, c < d, (a, b) < (c, d), the five nodes distinct
    and no edge between {a, b} and {c, d}."""
    tri = tri if tri is not None else triangles(edges)
    # Each triangle seen from each of its three corners: (center, x, y), x < y.
    tri = materialize(tri, "bowtie-triangles")
    corner = lambda c, x, y: F.struct(F.col(c).alias("center"), F.col(x).alias("x"), F.col(y).alias("y"))
    at = tri.select(F.explode(F.array(corner("a", "b", "c"), corner("b", "a", "c"), corner("c", "a", "b"))).alias("t")).select("t.*")
    # An edge between two neighbours of the centre is a triangle with it, so what must not be in the
    # other triangle is what a or b form a triangle with at this centre (each other included).
    near = at.unionByName(at.select("center", F.col("y").alias("x"), F.col("x").alias("y")))
    near = near.groupBy("center", "x").agg(F.collect_set("y").alias("near"))
    left = at.select("center", F.col("x").alias("a"), F.col("y").alias("b"))
    for x in ("a", "b"):
        left = left.join(near.select("center", F.col("x").alias(x), F.col("near").alias(f"near_{x}")), ["center", x])
    left = left.select("center", "a", "b", F.array_union("near_a", "near_b").alias("near"))
    right = at.select("center", F.col("x").alias("c"), F.col("y").alias("d"))
    pairs = left.join(right, "center").where(
        (F.col("a") < F.col("c")) & ~F.array_contains("near", F.col("c")) & ~F.array_contains("near", F.col("d"))
    )
    return pairs.select("center", "a", "b", "c", "d")


def bowtie_counts(edges: DataFrame) -> DataFrame:
    """(center, n_triangles, n_bowties) for every node in a triangle, without a list of
    bow-ties or of triangle pairs.

    The triangles at a centre are the edges of its link graph (the graph among its
    neighbours), and an induced bow-tie is a pair of disjoint link edges with none of the
    four possible edges between them.  By inclusion-exclusion over those four, that is

        disjoint pairs - paths of 3 edges + paws + 2 * 4-cycles - 2 * diamonds + 3 * K4

    of the link graph, each from sums: paths, paws and diamonds from the degrees and the
    triangles on a link edge (K4 of the graph), K4 of the link graph from K5, 4-cycles from
    wedges at their highest-ranked node.  Cliques extend ranked cliques, so a hub pairs few
    of its neighbours; all sums are keyed by (centre, neighbour) before they meet per centre."""
    o = materialize(oriented(edges), "bowtie-edges")
    tri = materialize(ranked_triangles(o), "bowtie-triangles")
    up = lambda a, b: o.select(F.col("lo").alias(a), F.col("hi").alias(b))
    k4 = tri.join(tri.select("u", "v", F.col("w").alias("x")), ["u", "v"]).join(up("w", "x"), ["w", "x"]).select("u", "v", "w", "x")
    k4 = materialize(k4, "bowtie-k4")
    k5 = k4.join(k4.select("u", "v", "w", F.col("x").alias("y")), ["u", "v", "w"]).join(up("x", "y"), ["x", "y"])

    triple = lambda *c: F.array_sort(F.array(*c)).alias("t")
    inside = k4.select(F.explode(F.array(*(F.array_sort(F.array(*c)) for c in (("u", "v", "w"), ("u", "v", "x"), ("u", "w", "x"), ("v", "w", "x"))))).alias("t"))
    inside = inside.groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    counted = tri.select("u", "v", "w", triple("u", "v", "w")).join(inside, "t", "left").select("u", "v", "w", F.coalesce("n", F.lit(0)).alias("n"))
    corner = lambda c, x, y: F.struct(F.col(c).alias("center"), F.col(x).alias("x"), F.col(y).alias("y"), F.col("n").alias("n"))
    link = counted.select(F.explode(F.array(corner("u", "v", "w"), corner("v", "u", "w"), corner("w", "u", "v"))).alias("e")).select("e.*")
    link = materialize(link, "bowtie-links")
    turned = link.select("center", F.col("y").alias("x"), F.col("x").alias("y"), "n")
    ends = link.unionByName(turned)
    at = materialize(ends.groupBy("center", "x").agg(F.count(F.lit(1)).alias("d"), F.sum("n").alias("n")), "bowtie-degrees")
    one, two = at.select("center", "x", F.col("d").alias("dx")), at.select("center", F.col("x").alias("y"), F.col("d").alias("dy"))
    graded = materialize(link.join(one, ["center", "x"]).join(two, ["center", "y"]), "bowtie-graded")

    per_edge = graded.groupBy("center").agg(
        F.count(F.lit(1)).alias("m"), F.sum((F.col("dx") - 1) * (F.col("dy") - 1) - F.col("n")).alias("paths"), F.sum(F.expr("n * (n - 1) div 2")).alias("diamonds")
    )
    per_node = at.groupBy("center").agg(F.sum(F.expr("d * (d - 1) div 2")).alias("touching"), F.sum(F.expr("n * (d - 2) div 2")).alias("paws"))
    # from v up to u, on to any w ranked below u: two such wedges with the same ends close a cycle
    rk = lambda d, x: F.struct(F.col(d).alias("d"), F.col(x).alias("n"))
    rise = graded.select("center", F.least(rk("dx", "x"), rk("dy", "y")).alias("v"), F.greatest(rk("dx", "x"), rk("dy", "y")).alias("u"))
    step = rise.select("center", "v", F.col("u").alias("w")).unionByName(rise.select("center", F.col("u").alias("v"), F.col("v").alias("w")))
    wedges = rise.join(step, ["center", "v"]).where(F.col("w") < F.col("u"))
    squares = wedges.groupBy("center", "u", "w").agg(F.count(F.lit(1)).alias("n")).groupBy("center").agg(F.sum(F.expr("n * (n - 1) div 2")).alias("squares"))
    cliques = k5.select(F.explode(F.array("u", "v", "w", "x", "y")).alias("center")).groupBy("center").agg(F.count(F.lit(1)).alias("cliques"))

    c = per_edge.join(per_node, "center").join(squares, "center", "left").join(cliques, "center", "left").na.fill(0, ["squares", "cliques"])
    pairs = F.expr("m * (m - 1) div 2") - F.col("touching")
    found = pairs - F.col("paths") + F.col("paws") + 2 * F.col("squares") - 2 * F.col("diamonds") + 3 * F.col("cliques")
    return c.select("center", F.col("m").alias("n_triangles"), found.alias("n_bowties"))


def simple_cycles(edges: DataFrame, max_length: int) -> DataFrame:
    """(length, cycle): every simple cycle of 3 to ``max_length`` edges once, as an array of
    nodes that starts at its smallest node and goes on to the smaller of its neighbours.

    A cycle is put together from two half-paths that leave its highest-ranked node, rank =
    (degree, node), and meet in the middle; no path is extended beyond half the length, and a
    path only visits nodes ranked below its start, so hubs are starts and hardly ever lie
    in the middle.  Of the two ways around, the one that leaves by the lower-ranked node
    counts."""
    if max_length < 3:
        raise ValueError("a simple cycle has at least 3 edges")
    rank = degrees(edges).select("node", F.struct("degree", "node").alias("r"))
    e = both_directions(edges).join(rank.toDF("src", "a"), "src").join(rank.toDF("dst", "b"), "dst").select("a", "b")
    e = materialize(e, "cycle-edges")
    halves = {1: e.where(F.col("b") < F.col("a")).select(F.col("a").alias("s"), F.array("b").alias("path"), F.col("b").alias("t"))}
    for n in range(2, (max_length + 1) // 2 + 1):
        longer = halves[n - 1].join(e.toDF("t", "b"), "t").where((F.col("b") < F.col("s")) & ~F.array_contains("path", F.col("b")))
        halves[n] = materialize(longer.select("s", F.concat("path", F.array("b")).alias("path"), F.col("b").alias("t")), "cycle-halves")
    out = None
    for length in range(3, max_length + 1):
        a, b = (length + 1) // 2, length // 2
        met = halves[a].join(halves[b].select("s", "t", F.col("path").alias("back")), ["s", "t"])
        inner = lambda p, n: F.slice(p, 1, n - 1)
        met = met.where((F.element_at("path", 1) < F.element_at("back", 1)) & ~F.arrays_overlap(inner("path", a), inner("back", b)))
        nodes = F.transform(F.concat(F.array("s"), F.col("path"), F.reverse(inner("back", b))), lambda r: r["node"])
        found = met.select(F.lit(length).alias("length"), nodes.alias("cycle"))
        out = found if out is None else out.unionByName(found)
    first = F.array_position("cycle", F.array_min("cycle")).cast("int")
    turned = out.select("length", F.concat(F.slice("cycle", first, F.col("length")), F.slice("cycle", F.lit(1), first - 1)).alias("cycle"))
    other = F.concat(F.slice("cycle", 1, 1), F.reverse(F.slice("cycle", F.lit(2), F.col("length") - 1)))
    return turned.select("length", F.when(F.element_at("cycle", 2) < F.element_at("cycle", -1), F.col("cycle")).otherwise(other).alias("cycle"))


def cycles4(edges: DataFrame) -> DataFrame:
    """4-cycles as sorted node sets (n1, n2, n3, n4), each once.

    Ranks are (degree, node).  A 4-cycle u–v–w–x is found from its
    highest-ranked node u: wedges u–v–w with v and w ranked below u are
    grouped on (u, w), and two different middles v < x close a cycle.  A hub
    is the middle of a wedge only for the few nodes ranked above it, so the
    wedges number O(m · arboricity) rather than Σ degree²."""
    rank = degrees(edges).select("node", F.struct("degree", "node").alias("r"))
    # the ranks join the edges, not the wedges
    e = both_directions(edges).join(rank.toDF("src", "rv"), "src").join(rank.toDF("dst", "rw"), "dst")
    e = materialize(e.select(F.col("src").alias("v"), "rv", F.col("dst").alias("w"), "rw"), "cycle4-edges")
    up = e.where(F.col("rv") < F.col("rw")).select("v", F.col("w").alias("u"), F.col("rw").alias("ru"))
    wedges = up.join(e.select("v", "w", "rw"), "v").where(F.col("rw") < F.col("ru"))
    p1 = wedges.select("u", "w", F.col("v").alias("b"))
    p2 = wedges.select("u", "w", F.col("v").alias("d"))
    cyc = p1.join(p2, ["u", "w"]).where(F.col("b") < F.col("d"))
    s = F.array_sort(F.array("u", "b", "w", "d"))
    return cyc.select(s[0].alias("n1"), s[1].alias("n2"), s[2].alias("n3"), s[3].alias("n4")).distinct()


def connected_components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, component) with component = smallest node id of the component.

    Hook and contract: each round every node points at the smallest node among
    itself and its neighbours, pointers are followed twice, and the edges are
    rewritten between pointer targets, dropping loops and repeats, so the graph
    shrinks each round (a star collapses in one).  The loop runs until no edge
    is left.  Pointers, labels and edges are parquet tables under the
    checkpoint folder: a round never recomputes an earlier one, and a lost
    executor costs part of one round.  Rounds that are no longer read are deleted."""
    labels = materialize(nodes.select("node", F.col("node").alias("label")).distinct(), "cc-labels")
    ends = edges.where(F.col("src") != F.col("dst")).select(F.least("src", "dst").alias("lo"), F.greatest("src", "dst").alias("hi"))
    live = materialize(ends.distinct(), "cc-edges")
    while not live.isEmpty():
        pairs = live.unionAll(live.select("hi", "lo")).toDF("node", "other")
        hook = materialize(
            pairs.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("to")), "cc-hook"
        )
        nxt = hook.toDF("to", "to2")
        ptr = hook.join(nxt, "to").select("node", F.col("to2").alias("to"))
        ptr = materialize(ptr.join(nxt, "to").select("node", F.col("to2").alias("to")), "cc-ptr")
        lo, hi = ptr.toDF("lo", "a"), ptr.toDF("hi", "b")
        new_live = materialize(
            live.join(lo, "lo").join(hi, "hi").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
            .where(F.col("lo") != F.col("hi")).distinct(),
            "cc-edges",
        )
        new_labels = materialize(
            labels.join(ptr.toDF("label", "to"), "label", "left").select("node", F.coalesce("to", "label").alias("label")), "cc-labels"
        )
        for old in (live, labels, hook, ptr):
            release(old)
        live, labels = new_live, new_labels
    release(live)
    return labels.select("node", F.col("label").alias("component"))


def component_shapes(edges: DataFrame, comps: DataFrame) -> DataFrame:
    """Per component: n_nodes, n_edges, max_degree, is_cycle (every node has
    degree 2 and edges = nodes)."""
    deg = degrees(edges, comps.select("node"))
    per_node = comps.join(deg, "node")
    nodes_agg = per_node.groupBy("component").agg(
        F.count(F.lit(1)).alias("n_nodes"),
        F.max("degree").alias("max_degree"),
        F.min("degree").alias("min_degree"),
        (F.sum("degree") / 2).cast("long").alias("n_edges"),
    )
    return nodes_agg.select(
        "component", "n_nodes", "n_edges", "max_degree",
        ((F.col("min_degree") == 2) & (F.col("max_degree") == 2) & (F.col("n_edges") == F.col("n_nodes"))).alias("is_cycle"),
    )


def two_cycle_tests(shapes: DataFrame, n_nodes_total) -> DataFrame:
    """The reference's three whole-graph tests over the component profile:
    exactly two non-trivial components, both cycles, and (a) each of n/2 nodes,
    (b) any sizes, (c) covering every node."""
    nt = shapes.where(F.col("n_nodes") > 1)
    agg = nt.agg(
        F.count(F.lit(1)).alias("k"),
        F.coalesce(F.min(F.col("is_cycle").cast("int")), F.lit(0)).alias("all_cycles"),
        F.coalesce(F.sum("n_nodes"), F.lit(0)).alias("covered"),
        F.coalesce(F.min("n_nodes"), F.lit(0)).alias("mn"),
        F.coalesce(F.max("n_nodes"), F.lit(0)).alias("mx"),
    )
    two = (F.col("k") == 2) & (F.col("all_cycles") == 1)
    return agg.select(
        (two & (F.col("mn") == F.col("mx")) & (F.col("mn") == F.floor(F.lit(n_nodes_total) / 2))).alias("two_equal_cycles"),
        two.alias("two_cycles"),
        (two & (F.col("covered") == F.lit(n_nodes_total))).alias("two_cycles_cover_all"),
    )
