import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.operators import graph as G

GRAPHS = {
    "two_triangles": (6, [(0, 1), (1, 2), (0, 2), (3, 4), (4, 5), (3, 5)]),
    "two_squares": (8, [(0, 1), (1, 2), (2, 3), (0, 3), (4, 5), (5, 6), (6, 7), (4, 7)]),
    "tri_square_isolated": (8, [(0, 1), (1, 2), (0, 2), (3, 4), (4, 5), (5, 6), (3, 6)]),
    "bowtie": (5, [(0, 1), (0, 2), (1, 2), (0, 3), (0, 4), (3, 4)]),
    "bowtie_chord": (5, [(0, 1), (0, 2), (1, 2), (0, 3), (0, 4), (3, 4), (1, 3)]),
    "k4": (4, [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)]),
}


def frames(spark, name):
    n, e = GRAPHS[name]
    edges = spark.createDataFrame(e, "src long, dst long")
    nodes = spark.range(n).select(F.col("id").alias("node"))
    return edges, nodes


@pytest.mark.parametrize("name,tri,bow", [("two_triangles", 2, 0), ("bowtie", 2, 1), ("bowtie_chord", 3, 0), ("k4", 4, 0), ("two_squares", 0, 0)])
def test_triangles_and_induced_bowties(spark, name, tri, bow):
    edges, _ = frames(spark, name)
    assert G.triangles(edges).count() == tri
    assert G.bowties(edges).count() == bow


def test_four_cycles(spark):
    edges, _ = frames(spark, "two_squares")
    assert G.cycles4(edges).count() == 2
    # cycles are de-duplicated by node set: K4's three 4-cycles share one set
    edges, _ = frames(spark, "k4")
    assert G.cycles4(edges).count() == 1


def test_summary_and_isolated_degree(spark):
    edges, nodes = frames(spark, "tri_square_isolated")
    s = G.summary(edges, nodes).first()
    assert (s.n_nodes, s.n_edges) == (8, 7) and abs(s.mean_degree - 14 / 8) < 1e-9
    deg = {r.node: r.degree for r in G.degrees(edges, nodes).collect()}
    assert deg[7] == 0


@pytest.mark.parametrize(
    "name,expected",
    [("two_squares", (True, True, True)), ("tri_square_isolated", (False, True, False)), ("two_triangles", (True, True, True)), ("bowtie", (False, False, False))],
)
def test_two_cycle_tests(spark, name, expected):
    edges, nodes = frames(spark, name)
    comps = G.connected_components(edges, nodes)
    shapes = G.component_shapes(edges, comps)
    row = G.two_cycle_tests(shapes, GRAPHS[name][0]).first()
    assert (row.two_equal_cycles, row.two_cycles, row.two_cycles_cover_all) == expected


def test_components_on_a_long_path(spark):
    n = 200
    edges = spark.createDataFrame([(i, i + 1) for i in range(n - 1)], "src long, dst long")
    nodes = spark.range(n).select(F.col("id").alias("node"))
    comps = G.connected_components(edges, nodes)
    assert comps.select("component").distinct().collect()[0].component == 0


def adjacency(edges):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    return near


def random_edges(seed, n, p):
    rnd = random.Random(seed)
    return [(a, b) for a in range(n) for b in range(a + 1, n) if rnd.random() < (0.95 if a == 0 else p)]


def plain_cycles(edges, most):
    """Every simple cycle from its smallest node, by depth-first search."""
    near, out = adjacency(edges), []

    def walk(path):
        for x in near[path[-1]]:
            if x == path[0] and len(path) > 2 and path[1] < path[-1]:
                out.append(tuple(path))
            if x > path[0] and x not in path and len(path) < most:
                walk([*path, x])

    for s in near:
        walk([s])
    return sorted(out)


@pytest.mark.parametrize("seed, n, p, most", [(1, 9, 0.5, 6), (4, 30, 0.05, 7)])
def test_simple_cycles_of_any_bounded_length(spark, seed, n, p, most):
    edges = random_edges(seed, n, p)
    got = G.simple_cycles(spark.createDataFrame(edges, "src long, dst long"), most).collect()
    assert sorted(tuple(r.cycle) for r in got) == plain_cycles(edges, most)
    assert all(r.length == len(r.cycle) for r in got)


def test_cycles_agree_with_the_triangles_and_need_three_edges(spark):
    edges, _ = frames(spark, "tri_square_isolated")
    assert sorted(r.length for r in G.simple_cycles(edges, 6).collect()) == [3, 4]
    assert G.simple_cycles(edges.limit(0), 6).count() == 0
    with pytest.raises(ValueError):
        G.simple_cycles(edges, 2)


def plain_bowties(edges):
    near = adjacency(edges)
    tri, bow = Counter(), Counter()
    for c, ns in near.items():
        link = [(a, b) for a, b in itertools.combinations(sorted(ns), 2) if b in near[a]]
        tri[c] = len(link)
        for (a, b), (x, y) in itertools.combinations(link, 2):
            bow[c] += len({a, b, x, y}) == 4 and not (near[a] | near[b]) & {x, y}
    return {c: (tri[c], bow[c]) for c in near if tri[c]}


@pytest.mark.parametrize("seed, n, p", [(1, 14, 0.4), (3, 10, 0.8)])
def test_bowties_are_counted_without_a_list(spark, seed, n, p):
    edges = random_edges(seed, n, p)
    frame = spark.createDataFrame(edges, "src long, dst long")
    got = {r.center: (r.n_triangles, r.n_bowties) for r in G.bowtie_counts(frame).collect()}
    assert got == plain_bowties(edges)
    assert sum(b for _, b in got.values()) == G.bowties(frame).count()


@pytest.mark.parametrize("seed, n, p", [(1, 14, 0.4), (3, 10, 0.8)])
def test_bowties_and_four_cycles_equal_brute_force(spark, seed, n, p):
    edges = random_edges(seed, n, p)
    frame, near = spark.createDataFrame(edges, "src long, dst long"), adjacency(edges)
    want = []
    for c, ns in near.items():
        link = [(a, b) for a, b in itertools.combinations(sorted(ns), 2) if b in near[a]]
        want += [(c, *x, *y) for x, y in itertools.combinations(link, 2) if len({*x, *y}) == 4 and not (near[x[0]] | near[x[1]]) & {*y}]
    assert sorted(tuple(r) for r in G.bowties(frame).collect()) == sorted(want)
    cycles = {tuple(sorted(c)) for c in plain_cycles(edges, 4) if len(c) == 4}
    assert sorted(tuple(r) for r in G.cycles4(frame).collect()) == sorted(cycles)
    assert sorted(tuple(r) for r in G.triangles(frame).collect()) == sorted(tuple(sorted(c)) for c in plain_cycles(edges, 3))


def joins_of(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString().count("Join ")


def test_lists_join_edges_and_not_their_pairs(spark):
    """Bow-ties need no join for each of four possible edges, wedges none for their ranks."""
    edges, _ = frames(spark, "bowtie_chord")
    assert joins_of(G.bowties(edges)) == 3
    assert joins_of(G.cycles4(edges)) == 3


def test_no_triangles_no_bowties(spark):
    edges, _ = frames(spark, "two_squares")
    assert G.bowtie_counts(edges).count() == 0


def test_a_hub_pairs_no_triangles(spark):
    """A wheel of many separate triangles around one node: the count needs no pair of them."""
    k = 3000
    edges = [(0, i) for i in range(1, 2 * k + 1)] + [(i, i + 1) for i in range(1, 2 * k, 2)]
    row = G.bowtie_counts(spark.createDataFrame(edges, "src long, dst long")).where("center = 0").first()
    assert (row.n_triangles, row.n_bowties) == (k, k * (k - 1) // 2)
