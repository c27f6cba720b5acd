"""Graph-learning plans: parts that have an ``embeddings`` row (vec_id = part
key) carry that vector; edges are the part graph restricted to such parts."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quarry.ml import evaluate as EV
from quarry.ml import features as FE
from quarry.ml import train as TR
from quarry.operators import graphlearn as GL
from quarry.operators.factorize import truncated_svd
from quarry.plans import register
from quarry.plans.graph import EDGES_SQL, part_edges
from quarry.session import materialize
from quarry.sources.tables import Tables

R = 6
PAD_WIDTH = 128
PROJ_DIM = 16
PROJ_SEED = 17
LAYERS = 2
WALK_LEN, WALK_P, WALK_Q = 5, 2.0, 0.5
WALK_WINDOW, EMB_DIM = 3, 16
WIDE_LEN, WIDE_WALKS, WIDE_DIM = 10, 4, 128


def _vec_edges(t):
    ids = t.embeddings.select(F.col("vec_id").alias("n"))
    e = part_edges(t).select("src", "dst")
    e = e.join(ids.withColumnRenamed("n", "src"), "src", "left_semi").join(ids.withColumnRenamed("n", "dst"), "dst", "left_semi")
    return materialize(e.select("src", "dst"), "vector-edges")  # read once per layer and direction


def _feats(t):
    return GL.feature_vectors(t.embeddings, "vec_id", "embedding")


VEC_SQL = f"""{EDGES_SQL},
ev AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
ge AS (SELECT src, dst FROM pe WHERE src IN (SELECT vec_id FROM ev) AND dst IN (SELECT vec_id FROM ev)),
bd AS (SELECT src, dst FROM ge UNION ALL SELECT dst, src FROM ge),
f0 AS (SELECT vec_id AS node, CAST(unnest(generate_series(0, len(v) - 1)) AS INTEGER) AS dim, unnest(v) AS value FROM ev)
"""


@register(
    "link_score_dot",
    f"WITH {VEC_SQL} SELECT src, dst, round(list_inner_product(a.v, b.v), {R}) AS score "
    "FROM ge JOIN ev a ON a.vec_id = src JOIN ev b ON b.vec_id = dst",
)
def link_score_dot(spark, sf):
    """Link score = dot product of the endpoint vectors."""
    t = Tables(spark, sf)
    s = GL.link_scores(_vec_edges(t), t.embeddings, "vec_id", "embedding")
    return s.select("src", "dst", F.round("score", R).alias("score"))


@register(
    "link_negative_sample",
    f"""WITH {VEC_SQL},
    m AS (SELECT count(*) AS m FROM ge),
    b AS (SELECT src, dst, ('0x' || substr(md5(src || ',' || dst), 1, 8))::BIGINT % (SELECT m FROM m) AS bucket FROM ge),
    o AS (SELECT (((bucket - 1) % (SELECT m FROM m)) + (SELECT m FROM m)) % (SELECT m FROM m) AS bucket, dst AS d2 FROM b),
    neg AS (SELECT DISTINCT least(b.src, o.d2) AS src, greatest(b.src, o.d2) AS dst FROM b JOIN o USING (bucket) WHERE b.src <> o.d2),
    negf AS (SELECT * FROM neg WHERE NOT EXISTS (SELECT 1 FROM ge WHERE ge.src = neg.src AND ge.dst = neg.dst))
    SELECT src, dst, 1 AS label FROM ge UNION ALL SELECT src, dst, 0 FROM negf""",
)
def link_negative_sample(spark, sf):
    """Positive edges plus hash-drawn non-edges."""
    e = _vec_edges(Tables(spark, sf))
    neg = GL.negative_samples(e)
    return e.withColumn("label", F.lit(1)).unionByName(neg.withColumn("label", F.lit(0)))


@register(
    "graph_feature_propagation",
    f"""WITH {VEC_SQL},
    h1 AS (SELECT bd.dst AS node, f.dim, avg(f.value) AS value FROM bd JOIN f0 f ON f.node = bd.src GROUP BY 1, 2),
    h2 AS (SELECT bd.dst AS node, h.dim, avg(h.value) AS value FROM bd JOIN h1 h ON h.node = bd.src GROUP BY 1, 2)
    SELECT node, dim, round(value, {R}) AS value FROM h2""",
)
def graph_feature_propagation(spark, sf):
    """Two layers of neighbour-mean aggregation (no training)."""
    t = Tables(spark, sf)
    h = GL.vectors_to_long(GL.propagate_mean(_vec_edges(t), _feats(t), LAYERS))
    return h.select("node", "dim", F.round("value", R).alias("value"))


@register(
    "graph_feature_propagation_gcn",
    f"""WITH {VEC_SQL},
    dt AS (SELECT n.node, coalesce(d.d, 0) + 1 AS dt FROM (SELECT DISTINCT node FROM f0) n
           LEFT JOIN (SELECT src AS node, count(*) AS d FROM bd GROUP BY 1) d USING (node)),
    e2 AS (SELECT x.src, x.dst, 1.0 / sqrt(a.dt * b.dt) AS w
           FROM (SELECT src, dst FROM bd UNION ALL SELECT node, node FROM dt) x JOIN dt a ON a.node = x.src JOIN dt b ON b.node = x.dst),
    h1 AS (SELECT e2.dst AS node, f.dim, sum(f.value * e2.w) AS value FROM e2 JOIN f0 f ON f.node = e2.src GROUP BY 1, 2),
    h2 AS (SELECT e2.dst AS node, h.dim, sum(h.value * e2.w) AS value FROM e2 JOIN h1 h ON h.node = e2.src GROUP BY 1, 2)
    SELECT node, dim, round(value, {R}) AS value FROM h2""",
)
def graph_feature_propagation_gcn(spark, sf):
    """N6, GCN form: symmetric degree normalisation with self loops, two layers."""
    t = Tables(spark, sf)
    h = GL.vectors_to_long(GL.propagate_gcn(_vec_edges(t), _feats(t), LAYERS))
    return h.select("node", "dim", F.round("value", R).alias("value"))


@register(
    "feature_zero_pad",
    f"SELECT vec_id, CAST(d AS INTEGER) AS dim, CASE WHEN d < len(embedding) THEN embedding[d + 1]::DOUBLE ELSE 0.0 END AS value "
    f"FROM embeddings, range(0, {PAD_WIDTH}) t(d)",
)
def feature_zero_pad(spark, sf):
    """Widen vectors to a target width with zeros."""
    e = Tables(spark, sf).embeddings
    return GL.to_long(e.select("vec_id", GL.zero_pad(F.col("embedding"), PAD_WIDTH).alias("v")), "vec_id", "v").withColumnRenamed("node", "vec_id")


@register(
    "feature_random_projection",
    f"""WITH f AS (SELECT vec_id, CAST(unnest(generate_series(0, len(embedding) - 1)) AS INTEGER) AS dim, unnest(embedding)::DOUBLE AS value FROM embeddings),
    r AS (SELECT CAST(i // {PROJ_DIM} AS INTEGER) AS dim, CAST(i % {PROJ_DIM} AS INTEGER) AS out_dim,
                 (CASE WHEN ('0x' || substr(md5('{PROJ_SEED},' || CAST(i // {PROJ_DIM} AS INTEGER) || ',' || CAST(i % {PROJ_DIM} AS INTEGER)), 1, 8))::BIGINT % 2 = 0
                       THEN 1.0 ELSE -1.0 END) / sqrt({PROJ_DIM}) AS r
          FROM range(0, (SELECT max(len(embedding)) FROM embeddings) * {PROJ_DIM}) t(i))
    SELECT f.vec_id, r.out_dim AS dim, round(sum(f.value * r.r), {R}) AS value FROM f JOIN r USING (dim) GROUP BY 1, 2""",
)
def feature_random_projection(spark, sf):
    """Project vectors with a seeded ±1/√k matrix (k = 16)."""
    e = Tables(spark, sf).embeddings
    d_in = e.select(F.max(F.size("embedding"))).first()[0] or 1
    projected = e.select("vec_id", GL.random_projection(F.col("embedding"), GL.projection_axes(d_in, PROJ_DIM, PROJ_SEED)).alias("v"))
    long = GL.to_long(projected, "vec_id", "v")
    return long.select(F.col("node").alias("vec_id"), "dim", F.round("value", R).alias("value"))


@register("feature_svd")
def feature_svd(spark, sf):
    """The vectors' coordinates along the axes of the 16 largest singular values."""
    e = Tables(spark, sf).embeddings
    svd = truncated_svd(e, "embedding", PROJ_DIM)
    long = GL.to_long(e.select("vec_id", svd.project(F.col("embedding")).alias("v")), "vec_id", "v")
    return long.select(F.col("node").alias("vec_id"), "dim", F.round("value", R).alias("value"))


@register(
    "feature_svd_spectrum",
    """WITH f AS (SELECT vec_id, unnest(generate_series(1, len(embedding))) AS d, unnest(embedding)::DOUBLE AS v FROM embeddings),
    g AS (SELECT a.d AS i, b.d AS j, sum(a.v * b.v) AS x FROM f a JOIN f b ON a.vec_id = b.vec_id GROUP BY 1, 2),
    g2 AS (SELECT a.i, b.j, sum(a.x * b.x) AS x FROM g a JOIN g b ON a.j = b.i GROUP BY 1, 2),
    g3 AS (SELECT a.i, b.j, sum(a.x * b.x) AS x FROM g2 a JOIN g b ON a.j = b.i GROUP BY 1, 2),
    t AS (SELECT 1 AS p, sum(x) AS t FROM g WHERE i = j UNION ALL SELECT 2, sum(x * x) FROM g
          UNION ALL SELECT 3, sum(g.x * g2.x) FROM g JOIN g2 USING (i, j) UNION ALL SELECT 4, sum(x * x) FROM g2
          UNION ALL SELECT 5, sum(g2.x * g3.x) FROM g2 JOIN g3 USING (i, j) UNION ALL SELECT 6, sum(x * x) FROM g3)
    SELECT p AS power, round(pow(t, 1.0 / p) / (SELECT t FROM t WHERE p = 1), 6) AS norm FROM t""",
)
def feature_svd_spectrum(spark, sf):
    """Schatten norms of all singular values, relative to the first.  SQL has them as
    traces of powers of the Gram matrix, without a decomposition."""
    svd = truncated_svd(Tables(spark, sf).embeddings, "embedding", 1 << 20)
    squares = svd.values**2
    rows = [(p, float((squares**p).sum() ** (1 / p) / squares.sum())) for p in range(1, 7)] if squares.sum() > 0 else []
    return spark.createDataFrame(rows, "power int, norm double").select("power", F.round("norm", R).alias("norm"))


def _h32_sql(*parts: str) -> str:
    joined = " || ',' || ".join(f"CAST({x} AS VARCHAR)" for x in parts)
    return f"('0x' || substr(md5({joined}), 1, 8))::BIGINT"


def walks_cte(trials: int = 128) -> str:
    """The walks with every step a CTE; ``trials`` draws are enough that the chance of a
    walker without an accepted one is below 1e-15 a step."""
    top = max(1 / WALK_P, 1, 1 / WALK_Q)
    steps = []
    for k in range(1, WALK_LEN):
        pos = f"({_h32_sql('17', 'f.walk_id', str(k), 't')} * d.degree) // 4294967296"
        luck = f"{_h32_sql('17', 'f.walk_id', str(k), 't', repr('accept'))} / 4294967296.0"
        steps.append(f"""s{k} AS (SELECT f.walk_id, any_value(f.cur) AS prev, arg_min(n.dst, t) AS cur
    FROM s{k - 1} f JOIN degs d ON d.src = f.cur CROSS JOIN range(0, {trials}) r(t)
    JOIN places n ON n.src = f.cur AND n.pos = {pos}
    WHERE f.prev IS NULL OR CAST({luck} AS DOUBLE) * {top} < CASE WHEN n.dst = f.prev THEN {1 / WALK_P} WHEN (f.prev, n.dst) IN (SELECT src, dst FROM both_dir) THEN 1.0 ELSE {1 / WALK_Q} END
    GROUP BY f.walk_id)""")
    each = " UNION ALL ".join(f"SELECT walk_id, {k} AS step, cur AS node FROM s{k}" for k in range(WALK_LEN))
    return f"""{EDGES_SQL},
    places AS (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY {_h32_sql('src', 'dst')}, dst) - 1 AS pos FROM both_dir),
    degs AS (SELECT src, count(*) AS degree FROM both_dir GROUP BY src),
    s0 AS (SELECT src AS walk_id, CAST(NULL AS BIGINT) AS prev, src AS cur FROM degs),
    {", ".join(steps)},
    walks AS ({each})"""


@register("graph_random_walks", f"WITH {walks_cte()} SELECT walk_id, step, node FROM walks")
def graph_random_walks(spark, sf):
    """One node2vec walk (p = 2, q = 0.5, 5 nodes) from every node with an edge."""
    e = materialize(part_edges(Tables(spark, sf)).select("src", "dst"), "part-edges")
    starts = e.select(F.col("src").alias("node")).unionByName(e.select(F.col("dst").alias("node"))).distinct()
    return GL.random_walks(e, starts, WALK_LEN, WALK_P, WALK_Q)


def node_vectors(spark, sf):
    return GL.walk_embedding(graph_random_walks(spark, sf), WALK_WINDOW, EMB_DIM)


def _skip_gram_sql() -> str:
    """Skip-gram vectors of the walks' pairs: ``sg<k>`` holds the vectors after k epochs."""
    at = range(1, EMB_DIM + 1)
    first = lambda side: ", ".join(f"({_h32_sql('17', repr(side), 'node', str(d))} / 4294967296.0 - 0.5) / {EMB_DIM}" for d in range(EMB_DIM))
    steps = []
    for k in range(GL.EPOCHS):
        drawn = "".join(f" UNION ALL SELECT i, n, d AS k, 0.0 AS y FROM (SELECT *, {_h32_sql('17', str(k), 'i', 'j', str(r))} % (SELECT count(*) FROM ids) AS d FROM sp) WHERE d <> j" for r in range(GL.NEGATIVES))
        moved = lambda x: f"list_transform(list_zip({x}, d{x}), lambda p: p[1] + {GL.RATE} * p[2] / sqrt(sq_{x} + list_inner_product(d{x}, d{x}) + {GL.STILL}))"
        steps.append(f"""t{k} AS MATERIALIZED (SELECT i, k, u, v, n * (y - 1 / (1 + exp(-list_inner_product(u, v)))) AS g
    FROM (SELECT i, n, j AS k, 1.0 AS y FROM sp{drawn}) JOIN (SELECT id, u FROM sg{k}) a ON a.id = i JOIN (SELECT id, v FROM sg{k}) b ON b.id = k),
    du{k} AS (SELECT i AS id, [{", ".join(f"sum(g * v[{d}])" for d in at)}] AS du FROM t{k} GROUP BY i),
    dv{k} AS (SELECT k AS id, [{", ".join(f"sum(g * u[{d}])" for d in at)}] AS dv FROM t{k} GROUP BY k),
    sg{k + 1} AS MATERIALIZED (SELECT id, node, {moved("u")} AS u, {moved("v")} AS v, sq_u + list_inner_product(du, du) AS sq_u, sq_v + list_inner_product(dv, dv) AS sq_v
    FROM sg{k} JOIN du{k} USING (id) JOIN dv{k} USING (id))""")
    return f"""pairs AS (SELECT a.node, b.node AS other, count(*) AS n FROM walks a JOIN walks b ON a.walk_id = b.walk_id
              AND abs(a.step - b.step) BETWEEN 1 AND {WALK_WINDOW} GROUP BY 1, 2),
    ids AS MATERIALIZED (SELECT node, row_number() OVER (ORDER BY node) - 1 AS id FROM (SELECT DISTINCT node FROM pairs)),
    sp AS MATERIALIZED (SELECT a.id AS i, b.id AS j, CAST(p.n AS DOUBLE) AS n FROM pairs p JOIN ids a ON a.node = p.node JOIN ids b ON b.node = p.other),
    sg0 AS MATERIALIZED (SELECT id, node, [{first("input")}] AS u, [{first("context")}] AS v, CAST(0 AS DOUBLE) AS sq_u, CAST(0 AS DOUBLE) AS sq_v FROM ids),
    {", ".join(steps)}"""


@register(
    "graph_node_embedding",
    f"""WITH {walks_cte()}, {_skip_gram_sql()},
    v AS (SELECT node, CAST(unnest(generate_series(0, {EMB_DIM - 1})) AS INTEGER) AS dim, unnest(u) / sqrt(list_inner_product(u, u)) AS x FROM sg{GL.EPOCHS})
    SELECT node, dim, round(coalesce(x, 0), {R}) + 0.0 AS value FROM v""",
)
def graph_node_embedding(spark, sf):
    """Node vectors trained on the walks by skip-gram with negative sampling."""
    v = GL.to_long(node_vectors(spark, sf), "node", "embedding")
    return v.select("node", "dim", (F.round("value", R) + 0.0).alias("value"))


def wide_node_vectors(spark, sf):
    """N2 at full width: several longer walks a node, factorised to 128 columns."""
    e = materialize(part_edges(Tables(spark, sf)).select("src", "dst"), "part-edges")
    starts = e.select(F.col("src").alias("node")).unionByName(e.select(F.col("dst").alias("node"))).distinct()
    walks = materialize(GL.random_walks(e, starts, WIDE_LEN, WALK_P, WALK_Q, per_node=WIDE_WALKS), "walks")
    return GL.walk_vectors(walks, WALK_WINDOW, WIDE_DIM)


@register("graph_node_vectors")
def graph_node_vectors(spark, sf):
    """128-wide node vectors from four walks of ten nodes each."""
    return wide_node_vectors(spark, sf)


@register("node_embedding_classify")
def node_embedding_classify(spark, sf):
    """N3 on N2's 128-wide vectors: multinomial logistic regression on the label of each
    part that has one (hash split on the node)."""
    t = Tables(spark, sf)
    labels = t.embeddings.select(F.col("vec_id").alias("node"), F.col("label").cast("double").alias("label"))
    rows = wide_node_vectors(spark, sf).join(labels, "node").select("node", "label", array_to_vector("embedding").alias("features"), FE.hash_split(F.col("node")).alias("split"))
    rows = materialize(rows, "node-features")
    m = LogisticRegression(maxIter=50, regParam=0.01).fit(rows.where(F.col("split") == "train"))
    return m.transform(rows.where(F.col("split") == "test")).select("node", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"))


def link_predictions(spark, sf):
    """Stored (src, dst, label, prediction, p1) of the held-out pairs: edges and hash-drawn
    non-edges, split by a hash of the pair, scored by a network trained on the other pairs'
    element-wise products of vectors."""
    t = Tables(spark, sf)
    e = _vec_edges(t)
    pairs = e.withColumn("label", F.lit(1)).unionByName(GL.negative_samples(e).withColumn("label", F.lit(0)))
    return materialize(TR.score_links(pairs, t.embeddings, "vec_id", "embedding"), "link-predictions")


@register("link_score_mlp")
def link_score_mlp(spark, sf):
    """N4, trained mode: probability of an edge for every held-out pair."""
    return link_predictions(spark, sf)


@register("link_mlp_metrics")
def link_mlp_metrics(spark, sf):
    """AUC and metrics of the trained pair scorer, from its stored predictions."""
    p = link_predictions(spark, sf)
    auc = EV.auc(EV.roc_points(p, "p1"), p)
    return EV.binary_metrics(EV.confusion(p)).select(auc.select("auc").scalar().alias("auc"), "*")


@register("embedding_classify")
def embedding_classify(spark, sf):
    """Multinomial logistic regression on the vectors (hash split on vec_id)."""
    e = Tables(spark, sf).embeddings.select("vec_id", F.col("label").cast("double").alias("label"), array_to_vector("embedding").alias("features"),
                                           FE.hash_split(F.col("vec_id")).alias("split"))
    m = LogisticRegression(maxIter=50, regParam=0.01).fit(e.where(F.col("split") == "train"))
    return m.transform(e.where(F.col("split") == "test")).select("vec_id", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"))


CENTROID_SQL = f"""
ev AS (SELECT vec_id, label, embedding,
              CASE WHEN ('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8))::BIGINT % 100 < {FE.TRAIN_PERCENT} THEN 'train' ELSE 'test' END AS split FROM embeddings),
fl AS (SELECT vec_id, label, split, CAST(unnest(generate_series(0, len(embedding) - 1)) AS INTEGER) AS dim, unnest(embedding)::DOUBLE AS value FROM ev),
cent AS (SELECT label AS c, dim, avg(value) AS m FROM fl WHERE split = 'train' GROUP BY 1, 2),
sc AS (SELECT f.vec_id, f.label, c.c, sum(f.value * c.m) AS s FROM fl f JOIN cent c USING (dim) WHERE f.split = 'test' GROUP BY 1, 2, 3),
pred AS (SELECT vec_id, label, arg_max(c, s) AS prediction FROM sc GROUP BY 1, 2),
nn AS (SELECT count(*) AS n FROM pred),
pt AS (SELECT label AS c, count(*) AS support, count(*) FILTER (WHERE label = prediction) AS tp FROM pred GROUP BY 1),
pp AS (SELECT prediction AS c, count(*) AS predicted FROM pred GROUP BY 1),
per AS (SELECT pt.*, coalesce(pp.predicted, 0) AS predicted FROM pt LEFT JOIN pp USING (c)),
mm AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS prec, tp / support AS rec,
              support / (SELECT n FROM nn) AS w FROM per)
"""


@register(
    "ml_metrics_multiclass",
    f"""WITH {CENTROID_SQL}
    SELECT round(sum(tp) / (SELECT n FROM nn), {R}) AS accuracy, round(sum(w * prec), {R}) AS weighted_precision,
           round(sum(w * rec), {R}) AS weighted_recall,
           round(sum(w * CASE WHEN prec + rec = 0 THEN 0.0 ELSE 2 * prec * rec / (prec + rec) END), {R}) AS f1 FROM mm""",
)
def ml_metrics_multiclass(spark, sf):
    """Weighted multi-class metrics of a nearest-centroid rule (class whose
    train-side mean vector has the largest dot product)."""
    e = Tables(spark, sf).embeddings.withColumn("split", FE.hash_split(F.col("vec_id")))
    pred = GL.nearest_centroid(e.where(F.col("split") == "train"), e.where(F.col("split") == "test"), "embedding")
    return EV.multiclass_metrics(pred)
