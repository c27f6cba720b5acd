"""Classification plans on orders (fixture C10): features from line items,
a hash split, pyspark.ml training (rows-only checks) and evaluation of the
fixed rule "gross > 300,000" (SQL-checked)."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarry.ml import evaluate as EV
from quarry.ml import features as FE
from quarry.ml import train as TR
from quarry.operators.profile import date_to_int, zscore
from quarry.plans import register
from quarry.session import materialize, scratch_path
from quarry.sources import delimited
from quarry.sources.tables import Tables

R = 6
LABEL_THRESHOLD = 300_000.0
NUMERIC = ["gross", "n_lines", "quantity", "o_totalprice", "date_int"]
CATEGORICAL = ["o_orderstatus", "o_orderpriority"]


def order_features(t):
    li = t.lineitem.groupBy("l_orderkey").agg(
        F.sum("l_extendedprice").alias("gross"),
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("net"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("quantity"),
    )
    o = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority")
    f = li.join(o, li["l_orderkey"] == o["o_orderkey"]).drop("l_orderkey")
    return f.select(
        "o_orderkey", "gross", "net", "n_lines", "quantity", "o_totalprice",
        date_to_int(F.col("o_orderdate")).alias("date_int"), "o_orderstatus", "o_orderpriority",
        FE.threshold_label(F.col("net"), LABEL_THRESHOLD).alias("label"),
        FE.hash_split(F.col("o_orderkey")).alias("split"),
    )


def rule_predictions(t):
    f = order_features(t)
    return f.select("o_orderkey", "label", "split", "gross", "net",
                    F.round("gross", 4).alias("score"), FE.threshold_label(F.col("gross"), LABEL_THRESHOLD).alias("prediction"))


FEAT_SQL = f"""
li AS (SELECT l_orderkey, sum(l_extendedprice) AS gross, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS net,
              count(*) AS n_lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_orderkey),
feat AS (SELECT o.o_orderkey, li.gross, li.net, li.n_lines, li.quantity, o.o_totalprice,
                CAST(year(o.o_orderdate) * 10000 + month(o.o_orderdate) * 100 + day(o.o_orderdate) AS INTEGER) AS date_int,
                o.o_orderstatus, o.o_orderpriority,
                CASE WHEN li.net > {LABEL_THRESHOLD} THEN 1 ELSE 0 END AS label,
                CASE WHEN ('0x' || substr(md5(CAST(o.o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 100 < {FE.TRAIN_PERCENT} THEN 'train' ELSE 'test' END AS split
         FROM li JOIN orders o ON li.l_orderkey = o.o_orderkey),
rule AS (SELECT o_orderkey, label, split, gross, net, round(gross, 4) AS score, CASE WHEN gross > {LABEL_THRESHOLD} THEN 1 ELSE 0 END AS prediction FROM feat),
test AS (SELECT * FROM rule WHERE split = 'test'),
cm AS (SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
              count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn FROM test)
"""


# ------------------------------------ SQL-checked ------------------------------------

@register(
    "ml_split_counts",
    f"WITH {FEAT_SQL} SELECT split, label, count(*) AS n FROM feat GROUP BY split, label",
)
def ml_split_counts(spark, sf):
    """Hash split on the order key, label balance per side."""
    f = order_features(Tables(spark, sf))
    return f.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))


def _index_sql(col: str) -> str:
    return (f"(SELECT {col} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, {col} ASC) - 1 AS DOUBLE) AS idx "
            f"FROM feat GROUP BY {col})")


@register(
    "ml_string_index",
    f"WITH {FEAT_SQL} SELECT f.o_orderkey, s.idx AS o_orderstatus_idx, p.idx AS o_orderpriority_idx FROM feat f "
    f"JOIN {_index_sql('o_orderstatus')} s ON s.v = f.o_orderstatus JOIN {_index_sql('o_orderpriority')} p ON p.v = f.o_orderpriority",
)
def ml_string_index(spark, sf):
    """M1: category indices by descending frequency (ties alphabetical)."""
    f = order_features(Tables(spark, sf))
    model = StringIndexer(inputCols=CATEGORICAL, outputCols=[f"{c}_idx" for c in CATEGORICAL]).fit(f)
    return model.transform(f).select("o_orderkey", *[f"{c}_idx" for c in CATEGORICAL])


@register("ml_confusion_matrix", f"WITH {FEAT_SQL} SELECT tp, fn, fp, tn FROM cm")
def ml_confusion_matrix(spark, sf):
    """[[TP, FN], [FP, TN]] of the rule on the test side, one pass."""
    p = rule_predictions(Tables(spark, sf)).where(F.col("split") == "test")
    return EV.confusion(p)


@register(
    "ml_metrics",
    f"""WITH {FEAT_SQL},
    pts AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM test GROUP BY score),
    cum AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp FROM pts),
    auc AS (SELECT sum(neg * (tp - pos / 2.0)) / ((SELECT sum(label) FROM test) * (SELECT sum(1 - label) FROM test)) AS auc FROM cum),
    m AS (SELECT tp::DOUBLE AS tp, fn::DOUBLE AS fn, fp::DOUBLE AS fp, tn::DOUBLE AS tn, (tp + fn + fp + tn)::DOUBLE AS n FROM cm),
    r AS (SELECT *, tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0 FROM m)
    SELECT round((SELECT auc FROM auc), {R}) AS auc, round((tp + tn) / n, {R}) AS accuracy,
           round((tp + fn) / n * p1 + (tn + fp) / n * p0, {R}) AS weighted_precision,
           round((tp + fn) / n * r1 + (tn + fp) / n * r0, {R}) AS weighted_recall,
           round((tp + fn) / n * (2 * p1 * r1 / (p1 + r1)) + (tn + fp) / n * (2 * p0 * r0 / (p0 + r0)), {R}) AS f1
    FROM r""",
)
def ml_metrics(spark, sf):
    """AUC, accuracy, weighted precision / recall, F1 of the rule on the test side."""
    p = rule_predictions(Tables(spark, sf)).where(F.col("split") == "test")
    a = EV.auc(EV.roc_points(p), p)
    m = EV.binary_metrics(EV.confusion(p))
    return m.select(a.select("auc").scalar().alias("auc"), "*")


@register(
    "ml_roc_curve",
    f"""WITH {FEAT_SQL},
    pts AS (SELECT score AS threshold, sum(label) AS pos, sum(1 - label) AS neg FROM test GROUP BY score),
    cum AS (SELECT threshold, pos, neg,
                   sum(pos) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
                   sum(neg) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp FROM pts)
    SELECT threshold, CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
           round(tp / (SELECT sum(label) FROM test), {R}) AS tpr, round(fp / (SELECT sum(1 - label) FROM test), {R}) AS fpr FROM cum
    UNION ALL SELECT NULL, 0, 0, 0, 0, 0.0, 0.0""",
)
def ml_roc_curve(spark, sf):
    """One ROC point per distinct score, cumulative counts by a distributed prefix sum."""
    p = rule_predictions(Tables(spark, sf)).where(F.col("split") == "test")
    return EV.roc_points(p)


@register(
    "ml_error_report",
    f"""WITH {FEAT_SQL},
    z AS (SELECT o_orderkey, (net - (SELECT avg(net) FROM feat)) / (SELECT stddev_samp(net) FROM feat) AS z FROM feat),
    wrong AS (SELECT t.*, z.z FROM test t JOIN z USING (o_orderkey) WHERE t.label <> t.prediction)
    SELECT count(*) AS n_wrong, count(*) FILTER (WHERE z > 3) AS n_outliers,
           round(100.0 * count(*) FILTER (WHERE z > 3) / nullif(count(*), 0), {R}) AS outlier_pct,
           round(CASE WHEN isnan(corr(gross, net)) THEN NULL ELSE corr(gross, net) END, {R}) AS corr_gross_net FROM wrong""",
)
def ml_error_report(spark, sf):
    """Wrong test predictions joined back to their rows; share of
    outliers (signed z > 3 on the target measure) and correlation among them."""
    t = Tables(spark, sf)
    z = zscore(order_features(t), "net").select("o_orderkey", "z")
    wrong = rule_predictions(t).where((F.col("split") == "test") & (F.col("label") != F.col("prediction"))).join(z, "o_orderkey")
    return wrong.agg(
        F.count(F.lit(1)).alias("n_wrong"),
        F.count_if(F.col("z") > 3).alias("n_outliers"),
        F.round(F.try_divide(100.0 * F.count_if(F.col("z") > 3), F.count(F.lit(1))), R).alias("outlier_pct"),
        F.round(F.corr("gross", "net"), R).alias("corr_gross_net"),
    )


# --------------------------------- training (rows-only) --------------------------------

def _train_test(spark, sf):
    f = order_features(Tables(spark, sf))
    return f.where(F.col("split") == "train"), f.where(F.col("split") == "test")


def _features():
    return FE.feature_pipeline(NUMERIC, CATEGORICAL)


def _feature_sql() -> str:
    """Assembled, scaled slots: numbers, then one slot for each train category by frequency,
    all over their sample deviation on the train side (0 where that is 0)."""
    slots = [f"SELECT o_orderkey, label, split, {i} AS slot, CAST({c} AS DOUBLE) AS x FROM feat" for i, c in enumerate(NUMERIC)]
    before = str(len(NUMERIC))
    for c in CATEGORICAL:
        slots.append(f"SELECT o_orderkey, label, split, {before} + idx AS slot, CASE WHEN {c} = v THEN 1.0 ELSE 0.0 END AS x FROM feat, k_{c}")
        before += f" + (SELECT count(*) FROM k_{c})"
    kinds = ", ".join(f"k_{c} AS (SELECT {c} AS v, row_number() OVER (ORDER BY count(*) DESC, {c} ASC) - 1 AS idx FROM feat WHERE split = 'train' GROUP BY {c})" for c in CATEGORICAL)
    return f"""WITH {FEAT_SQL}, {kinds}, raw AS ({' UNION ALL '.join(slots)}),
    dev AS (SELECT slot, stddev_samp(x) AS sd FROM raw WHERE split = 'train' GROUP BY slot)
    SELECT o_orderkey, label, split, CAST(slot AS INTEGER) AS slot, round(CASE WHEN sd > 0 THEN x / sd ELSE 0.0 END, {R}) AS value FROM raw JOIN dev USING (slot)"""


@register("ml_feature_table", _feature_sql())
def ml_feature_table(spark, sf):
    """M2-M5: index → one-hot → assemble → scale, fitted on the train side only; a row for
    each slot of the vector."""
    train, _ = _train_test(spark, sf)
    f = order_features(Tables(spark, sf))
    model = _features().fit(train)
    made = model.transform(f).select("o_orderkey", "label", "split", F.posexplode(vector_to_array("features")).alias("slot", "value"))
    return made.select("o_orderkey", "label", "split", "slot", F.round("value", R).alias("value"))


@register("ml_logreg")
def ml_logreg(spark, sf):
    """M7: logistic regression, test-side predictions."""
    train, test = _train_test(spark, sf)
    m = TR.fit_pipeline(_features(), TR.logistic_regression(regParam=0.01, elasticNetParam=0.0, maxIter=50), train)
    return TR.predictions(m, test, "o_orderkey")


@register("ml_random_forest")
def ml_random_forest(spark, sf):
    """M8: random forest."""
    train, test = _train_test(spark, sf)
    m = TR.fit_pipeline(_features(), TR.random_forest(numTrees=20, maxDepth=5), train)
    return TR.predictions(m, test, "o_orderkey")


@register("ml_gbt")
def ml_gbt(spark, sf):
    """M9: gradient-boosted trees."""
    train, test = _train_test(spark, sf)
    m = TR.fit_pipeline(_features(), TR.gbt(maxIter=10, maxDepth=3), train)
    return TR.predictions(m, test, "o_orderkey")


@register("ml_mlp")
def ml_mlp(spark, sf):
    """Multilayer perceptron; input width read from the assembled vector."""
    train, test = _train_test(spark, sf)
    feats = _features().fit(train)
    width = len(FE.vector_attrs(feats.transform(train.limit(1)), "raw_features"))
    m = TR.fit_pipeline(_features(), TR.mlp(width, [8], maxIter=50), train)
    return TR.predictions(m, test, "o_orderkey")


def _stored_features(spark, sf):
    """(o_orderkey, label, split, features) once, fitted on the train side; every fit reads it.
    Also the width of the features."""
    f = order_features(Tables(spark, sf))
    model = _features().fit(f.where(F.col("split") == "train"))
    out = materialize(model.transform(f).select("o_orderkey", "label", "split", "features"), "ml-features")
    return out, out.select("features").first()[0].size


GRID_SCHEMA = "model string, setting string, mean_auc double, best boolean"


def grid_search(spark, sf, names: list[str]):
    """Best-parameter table of the named grids, 5 folds."""
    feats, width = _stored_features(spark, sf)
    train = feats.where(F.col("split") == "train")
    rows = [r for n in names for r in TR.grid_table(n, *TR.reference_grids(width)[n], train)]
    return spark.createDataFrame(rows, GRID_SCHEMA).withColumn("mean_auc", F.round("mean_auc", R))


_HALVED: dict[tuple[str, str], list[tuple]] = {}  # (application, tables) → a row for each candidate and rung


def halved_grids(spark, sf):
    """The four reference grids by successive halving on stored folds, run once a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _HALVED:
        feats, width = _stored_features(spark, sf)
        train = TR.with_folds(feats.where(F.col("split") == "train"), "o_orderkey")
        _HALVED[key] = TR.halving_table(TR.reference_grids(width), train)
    return spark.createDataFrame(_HALVED[key], TR.HALVING_SCHEMA).withColumn("mean_auc", F.round("mean_auc", R))


@register("ml_halving_grids")
def ml_halving_grids(spark, sf):
    """Every candidate's mean AUC in each rung it took part in, and the best of each
    model."""
    return halved_grids(spark, sf)


@register("ml_best_parameters")
def ml_best_parameters(spark, sf):
    """Best parameters of the halved grids, written as a text report and read back."""
    found = halved_grids(spark, sf).where("best").select(F.format_string("%s: %s, mean AUC %.6f over all train rows", "model", "setting", "mean_auc").alias("value"))
    report = scratch_path(spark, "best-parameters")
    found.write.text(report)
    return spark.read.text(report).withColumnRenamed("value", "line")


@register("ml_cv_grid")
def ml_cv_grid(spark, sf):
    """The 3 x 3 grid (regParam x elasticNetParam), 5 folds on AUC; one row per
    candidate.  ``grid_search`` runs the other grids too; they take too long for a test run."""
    return grid_search(spark, sf, ["logistic_regression"])


@register(
    "ml_model_comparison",
    f"WITH {FEAT_SQL} SELECT m AS model, count(*) AS n_test, sum(label)::BIGINT AS n_positive FROM test, "
    "(VALUES ('logistic_regression'), ('random_forest'), ('gbt'), ('mlp')) v(m) GROUP BY m",
)
def ml_model_comparison(spark, sf):
    """M12, the part SQL can state: every model's stored test predictions are complete."""
    return model_metrics(spark, sf).select("model", "n_test", "n_positive")


@register("ml_model_metrics")
def ml_model_metrics(spark, sf):
    """AUC, accuracy, weighted precision and recall, F1 of each trained model on the
    test side, recomputed from the stored predictions."""
    return model_metrics(spark, sf)


def model_metrics(spark, sf):
    feats, width = _stored_features(spark, sf)
    train, test = feats.where(F.col("split") == "train"), feats.where(F.col("split") == "test")
    models = {
        "logistic_regression": TR.logistic_regression(regParam=0.01, maxIter=50), "random_forest": TR.random_forest(numTrees=20, maxDepth=10),
        "gbt": TR.gbt(maxIter=10, maxDepth=5), "mlp": TR.mlp(width, [100], maxIter=50),
    }
    out = None
    for name, model in models.items():
        p = materialize(TR.predictions(model.fit(train), test, "o_orderkey"), f"predictions-{name}")
        points = EV.roc_points(p, "p1")
        sizes = p.agg(F.count(F.lit(1)).alias("n_test"), F.sum(F.col("label").cast("long")).alias("n_positive"))
        row = EV.binary_metrics(EV.confusion(p)).select(
            F.lit(name).alias("model"), sizes.select("n_test").scalar().alias("n_test"), sizes.select("n_positive").scalar().alias("n_positive"),
            EV.auc(points, p).select("auc").scalar().alias("auc"), "*",
        )
        out = row if out is None else out.unionByName(row)
    return out


@register(
    "ml_error_files",
    f"""WITH {FEAT_SQL} SELECT 'rule: ' || count(*) || ' wrong of ' || (SELECT count(*) FROM test) AS line FROM test WHERE label <> prediction
    UNION ALL SELECT 'wrong ' || o_orderkey || ' as ' || prediction FROM test WHERE label <> prediction""",
)
def ml_error_files(spark, sf):
    """Wrong test rows to CSV and a text report, both read back as the report's lines."""
    test = rule_predictions(Tables(spark, sf)).where(F.col("split") == "test").select("o_orderkey", "label", "prediction")
    wrong = test.where(F.col("label") != F.col("prediction"))
    rows, report = scratch_path(spark, "wrong-csv"), scratch_path(spark, "report")
    delimited.write_csv(wrong, rows)
    head = test.agg(F.format_string("rule: %d wrong of %d", F.count_if(F.col("label") != F.col("prediction")), F.count(F.lit(1))).alias("value"))
    back = spark.read.csv(rows, header=True, schema="o_orderkey long, label int, prediction int")
    head.unionAll(back.select(F.format_string("wrong %d as %d", "o_orderkey", "prediction"))).write.text(report)
    return spark.read.text(report).withColumnRenamed("value", "line")


@register("ml_feature_importance")
def ml_feature_importance(spark, sf):
    """Importances of the forest and of the boosted trees, summed back onto source columns."""
    train, _ = _train_test(spark, sf)
    feats = _features().fit(train)
    made = feats.transform(train)
    attrs = FE.vector_attrs(made, "raw_features")
    stored = materialize(made.select("label", "features"), "importance-features")  # read by both fits
    rows = []
    for name, model in (("random_forest", TR.random_forest(numTrees=20, maxDepth=5)), ("gbt", TR.gbt(maxIter=10, maxDepth=3))):
        m = model.fit(stored)
        imp = FE.source_importances(m.featureImportances.toArray(), attrs, NUMERIC + CATEGORICAL)
        rows += [(name, s, round(v, R)) for s, v in imp]
    return spark.createDataFrame(rows, "model string, source_column string, importance double")


@register(
    "model_persist_roundtrip",
    f"WITH {FEAT_SQL} SELECT count(*) AS compared, 0::BIGINT AS differing FROM feat WHERE split = 'test'",
)
def model_persist_roundtrip(spark, sf):
    """Save the fitted pipeline (overwrite), load it by class, and count the test rows
    compared and those on which the loaded model differs from the original."""
    from pyspark.ml import PipelineModel

    train, test = _train_test(spark, sf)
    m = TR.fit_pipeline(_features(), TR.logistic_regression(regParam=0.01, maxIter=30), train)
    path = scratch_path(spark, "model")
    m.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    a = TR.predictions(m, test, "o_orderkey")
    b = TR.predictions(loaded, test, "o_orderkey").select("o_orderkey", F.col("prediction").alias("p2"), F.col("p1").alias("q1"))
    same = F.col("prediction").eqNullSafe(F.col("p2")) & F.col("p1").eqNullSafe(F.col("q1"))
    return a.join(b, "o_orderkey", "full").agg(F.count(F.lit(1)).alias("compared"), F.count_if(~same).alias("differing"))
