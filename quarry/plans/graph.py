"""Graph plans on the part graph: parts on consecutive lines of one order are
adjacent (an equi-join on (order, line + 1), linear in the number of lines —
no all-pairs expansion inside an order).  Nodes are all parts, so parts
without an edge are isolated nodes."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import graph as G
from quarry.plans import register
from quarry.session import materialize
from quarry.sources.tables import Tables

R = 6
SPARSE_MIN_WEIGHT = 2  # edges seen in at least two orders: many small components


def part_edges(t, min_weight: int = 1):
    return line_edges(t.lineitem).where(F.col("weight") >= min_weight)


def line_edges(lines):
    """(src, dst, weight) between the parts of consecutive lines of an order."""
    li = lines.select("l_orderkey", "l_linenumber", "l_partkey")
    a = li.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("a"))
    b = li.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("l_partkey").alias("b"))
    pairs = a.join(b, ["l_orderkey", "l_linenumber"]).where(F.col("a") != F.col("b"))
    e = pairs.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"), "l_orderkey")
    # weight = number of distinct orders holding the adjacency
    return e.groupBy("src", "dst").agg(F.count_distinct("l_orderkey").alias("weight"))


def _stored_edges(t):
    """The part graph, stored: lists of triangles and cycles read it several times."""
    return materialize(part_edges(t).select("src", "dst"), "part-edges")


def part_nodes(t):
    return t.part.select(F.col("p_partkey").alias("node"))


EDGES_SQL = """
pe AS (SELECT least(a.l_partkey, b.l_partkey) AS src, greatest(a.l_partkey, b.l_partkey) AS dst, count(DISTINCT a.l_orderkey) AS weight
       FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1
       WHERE a.l_partkey <> b.l_partkey GROUP BY 1, 2),
nodes AS (SELECT p_partkey AS node FROM part),
both_dir AS (SELECT src, dst FROM pe UNION ALL SELECT dst, src FROM pe)
"""

TRI_SQL = """
tri AS (SELECT e1.src AS a, e1.dst AS b, e2.dst AS c FROM pe e1 JOIN pe e2 ON e2.src = e1.dst
        JOIN pe e3 ON e3.src = e1.src AND e3.dst = e2.dst)
"""


@register("graph_edges", f"WITH {EDGES_SQL} SELECT src, dst, weight FROM pe")
def graph_edges(spark, sf):
    """G1: canonical undirected simple edges with weights."""
    return part_edges(Tables(spark, sf))


@register(
    "graph_degree",
    f"WITH {EDGES_SQL} SELECT n.node, CAST(coalesce(d.degree, 0) AS BIGINT) AS degree FROM nodes n "
    "LEFT JOIN (SELECT src AS node, count(*) AS degree FROM both_dir GROUP BY 1) d USING (node)",
)
def graph_degree(spark, sf):
    """Degree of every node, isolated nodes included."""
    t = Tables(spark, sf)
    return G.degrees(part_edges(t), part_nodes(t))


@register(
    "graph_summary",
    f"WITH {EDGES_SQL} SELECT (SELECT count(*) FROM nodes) AS n_nodes, (SELECT count(*) FROM pe) AS n_edges, "
    f"round(coalesce(2.0 * (SELECT count(*) FROM pe) / nullif((SELECT count(*) FROM nodes), 0), 0.0), {R}) AS mean_degree",
)
def graph_summary(spark, sf):
    """Edge count, node count, mean degree (0 for an empty graph)."""
    t = Tables(spark, sf)
    return G.summary(part_edges(t), part_nodes(t))


@register("graph_triangles", f"WITH {EDGES_SQL}, {TRI_SQL} SELECT a, b, c FROM tri")
def graph_triangles(spark, sf):
    """Every triangle once, nodes ascending."""
    return G.triangles(part_edges(Tables(spark, sf)))


BOWTIE_SQL = f"""WITH {EDGES_SQL}, {TRI_SQL},
    corner AS (SELECT a AS center, b AS x, c AS y FROM tri UNION ALL SELECT b, a, c FROM tri UNION ALL SELECT c, a, b FROM tri)
    SELECT l.center, l.x AS a, l.y AS b, r.x AS c, r.y AS d
    FROM corner l JOIN corner r ON l.center = r.center
    WHERE (l.x < r.x OR (l.x = r.x AND l.y < r.y))
      AND l.x <> r.x AND l.x <> r.y AND l.y <> r.x AND l.y <> r.y
      AND NOT EXISTS (SELECT 1 FROM pe WHERE (src, dst) IN ((least(l.x, r.x), greatest(l.x, r.x)), (least(l.x, r.y), greatest(l.x, r.y)),
                                                             (least(l.y, r.x), greatest(l.y, r.x)), (least(l.y, r.y), greatest(l.y, r.y))))"""


@register("graph_bowties", BOWTIE_SQL)
def graph_bowties(spark, sf):
    """Induced bow-ties (two triangles sharing exactly one node, no other edge)."""
    return G.bowties(_stored_edges(Tables(spark, sf)))


@register("graph_bowtie_count", f"SELECT count(*) AS n_bowties, count(DISTINCT center) AS n_centers FROM ({BOWTIE_SQL})")
def graph_bowtie_count(spark, sf):
    """G5 as the number of bow-ties, and of nodes that are the centre of one; no bow-tie is
    listed."""
    e = materialize(part_edges(Tables(spark, sf)).select("src", "dst"), "part-edges")
    found = G.bowtie_counts(e).where(F.col("n_bowties") > 0)
    return found.agg(F.coalesce(F.sum("n_bowties"), F.lit(0)).alias("n_bowties"), F.count(F.lit(1)).alias("n_centers"))


@register(
    "graph_cycles_le4",
    f"""WITH {EDGES_SQL}, {TRI_SQL},
    p AS (SELECT f.src AS a, f.dst AS m, s.dst AS c FROM both_dir f JOIN both_dir s ON s.src = f.dst WHERE f.dst > f.src AND s.dst > f.src),
    c4 AS (SELECT DISTINCT list_sort([p1.a, p1.m, p1.c, p2.m]) AS ns FROM p p1 JOIN p p2 ON p1.a = p2.a AND p1.c = p2.c AND p1.m < p2.m)
    SELECT 3 AS length, a AS n1, b AS n2, c AS n3, CAST(NULL AS BIGINT) AS n4 FROM tri
    UNION ALL SELECT 4, ns[1], ns[2], ns[3], ns[4] FROM c4""",
)
def graph_cycles_le4(spark, sf):
    """G6 with the length bound 4: simple cycles as node sets."""
    e = _stored_edges(Tables(spark, sf))
    t3 = G.triangles(e).select(F.lit(3).alias("length"), F.col("a").alias("n1"), F.col("b").alias("n2"), F.col("c").alias("n3"), F.lit(None).cast("long").alias("n4"))
    t4 = G.cycles4(e).select(F.lit(4).alias("length"), "n1", "n2", "n3", "n4")
    return t3.unionByName(t4)


MAX_CYCLE = 6


@register(
    "graph_cycles_le6",
    f"""WITH RECURSIVE sp AS (
        SELECT DISTINCT least(a.l_partkey, b.l_partkey) AS src, greatest(a.l_partkey, b.l_partkey) AS dst
        FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1
        WHERE a.l_partkey <> b.l_partkey AND a.l_returnflag = 'R' AND b.l_returnflag = 'R'),
    sd AS (SELECT src, dst FROM sp UNION ALL SELECT dst, src FROM sp),
    walk(s, path) AS (SELECT src, [src, dst] FROM sd WHERE dst > src UNION ALL
                      SELECT s, list_append(path, sd.dst) FROM walk JOIN sd ON sd.src = path[-1] WHERE len(path) < {MAX_CYCLE} AND sd.dst > s AND NOT list_contains(path, sd.dst)),
    c AS (SELECT path FROM walk JOIN sd ON sd.src = path[-1] AND sd.dst = s WHERE len(path) >= 3 AND path[2] < path[-1])
    SELECT CAST(len(path) AS INTEGER) AS length, array_to_string(list_sort(path), ',') AS nodes, count(*) AS n_cycles FROM c GROUP BY 1, 2""",
)
def graph_cycles_le6(spark, sf):
    """G6 with the length bound 6, on the graph of parts returned together (consecutive lines
    of an order, both returned): node sets of simple cycles, and how many cycles run through
    each set."""
    returned = Tables(spark, sf).lineitem.where(F.col("l_returnflag") == "R")
    found = G.simple_cycles(line_edges(returned), MAX_CYCLE)
    nodes = F.array_join(F.array_sort("cycle").cast("array<string>"), ",")
    return found.groupBy("length", nodes.alias("nodes")).agg(F.count(F.lit(1)).alias("n_cycles"))


CC_SQL = f"""
sp AS (SELECT src, dst FROM pe WHERE weight >= {SPARSE_MIN_WEIGHT}),
sd AS (SELECT src, dst FROM sp UNION ALL SELECT dst, src FROM sp),
reach(node, label) AS (SELECT node, node FROM nodes UNION SELECT sd.dst, reach.label FROM reach JOIN sd ON sd.src = reach.node),
comp AS (SELECT node, min(label) AS component FROM reach GROUP BY node)
"""


@register("graph_components", f"WITH RECURSIVE {EDGES_SQL}, {CC_SQL} SELECT node, component FROM comp")
def graph_components(spark, sf):
    """G8 on the sparse part graph: component = smallest part key in it."""
    t = Tables(spark, sf)
    return G.connected_components(part_edges(t, SPARSE_MIN_WEIGHT), part_nodes(t))


@register(
    "graph_components_full",
    f"WITH RECURSIVE {EDGES_SQL}, reach(node, label) AS (SELECT node, node FROM nodes UNION "
    "SELECT b.dst, reach.label FROM reach JOIN both_dir b ON b.src = reach.node) SELECT node, min(label) AS component FROM reach GROUP BY node",
)
def graph_components_full(spark, sf):
    """G8 on the whole part graph, every edge."""
    t = Tables(spark, sf)
    return G.connected_components(part_edges(t), part_nodes(t))


@register(
    "graph_component_shapes",
    f"""WITH RECURSIVE {EDGES_SQL}, {CC_SQL},
    deg AS (SELECT n.node, coalesce(d.degree, 0) AS degree FROM nodes n LEFT JOIN (SELECT src AS node, count(*) AS degree FROM sd GROUP BY 1) d USING (node)),
    agg AS (SELECT component, count(*) AS n_nodes, max(degree) AS max_degree, min(degree) AS min_degree, CAST(sum(degree) / 2 AS BIGINT) AS n_edges
            FROM comp JOIN deg USING (node) GROUP BY component)
    SELECT component, n_nodes, n_edges, max_degree, (min_degree = 2 AND max_degree = 2 AND n_edges = n_nodes) AS is_cycle
    FROM agg WHERE n_nodes > 1""",
)
def graph_component_shapes(spark, sf):
    """G7 profile: nodes, edges, max degree and cycle flag of every non-trivial component."""
    t = Tables(spark, sf)
    e = materialize(part_edges(t, SPARSE_MIN_WEIGHT), "part-edges")
    shapes = G.component_shapes(e, G.connected_components(e, part_nodes(t)))
    return shapes.where(F.col("n_nodes") > 1)


@register(
    "graph_two_cycle_tests",
    f"""WITH RECURSIVE {EDGES_SQL}, {CC_SQL},
    deg AS (SELECT n.node, coalesce(d.degree, 0) AS degree FROM nodes n LEFT JOIN (SELECT src AS node, count(*) AS degree FROM sd GROUP BY 1) d USING (node)),
    agg AS (SELECT component, count(*) AS n_nodes, max(degree) AS mx, min(degree) AS mn FROM comp JOIN deg USING (node) GROUP BY component HAVING count(*) > 1),
    s AS (SELECT count(*) AS k, coalesce(bool_and(mn = 2 AND mx = 2), false) AS cycles, coalesce(sum(n_nodes), 0) AS covered, min(n_nodes) AS lo, max(n_nodes) AS hi FROM agg),
    t AS (SELECT count(*) AS n FROM nodes)
    SELECT k = 2 AND cycles AND lo = hi AND lo = n // 2 AS two_equal_cycles, k = 2 AND cycles AS two_cycles,
           k = 2 AND cycles AND covered = n AS two_cycles_cover_all FROM s, t""",
)
def graph_two_cycle_tests(spark, sf):
    """The three whole-graph tests on the sparse part graph."""
    t = Tables(spark, sf)
    e = materialize(part_edges(t, SPARSE_MIN_WEIGHT), "part-edges")
    shapes = G.component_shapes(e, G.connected_components(e, part_nodes(t)))
    return G.two_cycle_tests(shapes, part_nodes(t).count())
