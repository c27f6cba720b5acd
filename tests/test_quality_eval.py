from pyspark.sql import functions as F

from quarry.ml import evaluate as EV
from quarry.operators import quality as Q


def test_clock_rules(spark):
    rows = [
        (1, 2350, 10, 20),      # next day, positive diff
        (2, 1000, 1100, 1500),  # more than a day: diff mod 1440
        (3, 1000, 950, -10),    # negative diff
        (4, 10, 2350, -20),     # t1 moves a day when diff < 0 and t2 > t1
        (5, 2400, 5, 5),        # 24:00 is 00:00
        (6, 1000, 1005, 4),     # inconsistent
        (7, 1000, 2460, 5),     # not a clock time: undecidable, dropped
        (8, 1000, 1001, -1439), # t1 moves a day: 00:01 − 24:00 = −1439, sign kept by mod
    ]
    df = spark.createDataFrame(rows, "id int, t1 int, t2 int, diff int")
    kept = {r.id for r in Q.clock_consistent(df, "t1", "t2", "diff").collect()}
    assert kept == {1, 2, 3, 4, 5, 8}


def test_breakdown_keeps_nulls_sum_drops_them(spark):
    df = spark.createDataFrame([(1, 1, 2, 3), (2, None, 2, 3), (3, 1, 2, 4)], "id int, a int, b int, t int")
    assert {r.id for r in Q.sum_consistent(df, ["a", "b"], "t").collect()} == {1}
    assert {r.id for r in Q.breakdown_consistent(df, ["a", "b"], "t").collect()} == {1, 2}


def test_auc_equals_pairwise_probability(spark):
    import random

    rnd = random.Random(3)
    rows = [(i, rnd.choice([0, 1]), float(rnd.randint(0, 20))) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, label int, score double")
    got = EV.auc(EV.roc_points(df), df).first().auc
    pos = [s for _, y, s in rows if y == 1]
    neg = [s for _, y, s in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(got - want) < 1e-6


def test_roc_is_monotone_and_ends_at_one(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)], "label int, score double")
    pts = EV.roc_points(df).orderBy(F.col("threshold").desc_nulls_first()).collect()
    assert [p.tp for p in pts] == [0, 1, 1, 2, 2] and pts[0].fpr == 0.0 and pts[-1].tpr == 1.0 and pts[-1].fpr == 1.0


def test_auc_does_not_hang_on_exchange_reuse(spark):
    """Each branch of the prefix sum sees the same range partitions without exchange reuse."""
    from pyspark.sql import functions as F

    from quarry.ml import evaluate as EV

    pred = spark.range(4000).select((F.xxhash64("id") % 500).cast("double").alias("score"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)) == 0).cast("int").alias("label"))
    rows = [(r.score, r.label) for r in pred.collect()]
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    old = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        points = EV.roc_points(pred)
        assert abs(EV.auc(points, pred).first().auc - want) < 1e-6
        assert [(r.tp, r.fp) for r in points.where("threshold IS NULL").collect()] == [(0, 0)]
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)
