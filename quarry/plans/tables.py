"""Ratings, data-quality and profiling plans over the bundled tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import profile, quality, ratings
from quarry.plans import fixtures as fx
from quarry.plans import register
from quarry.session import scratch_path
from quarry.sources import nested
from quarry.sources.tables import Tables

R = 6
LINEITEM_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


# ----------------------------------- ratings ----------------------------------------

@register(
    "rating_topk_count",
    f"WITH {fx.RATINGS_SQL} SELECT item, count(*) AS n_reviews FROM ratings GROUP BY item "
    "ORDER BY n_reviews DESC, item ASC LIMIT 10",
)
def rating_topk_count(spark, sf):
    return ratings.top_by_count(fx.ratings(Tables(spark, sf)), k=10)


@register(
    "rating_topk_avg",
    f"WITH {fx.RATINGS_SQL} SELECT item, count(*) AS n_reviews, round(avg(mark), {R}) AS mean_mark FROM ratings "
    f"GROUP BY item HAVING count(*) >= {fx.RATING_MIN_COUNT} ORDER BY round(avg(mark), 12) DESC, item ASC LIMIT 10",
)
def rating_topk_avg(spark, sf):
    return ratings.top_by_mean(fx.ratings(Tables(spark, sf)), min_count=fx.RATING_MIN_COUNT, k=10)


# ------------------------------- clock consistency ----------------------------------

_CLOCK_ERR_SQL = """
  ((CASE WHEN (t2 < t1) AND diff > 0 THEN m2 + 1440 ELSE m2 END)
   - (CASE WHEN (t2 > t1) AND diff < 0 THEN m1 + 1440 ELSE m1 END)) - diff % 1440
"""
_CLOCK_MIN_SQL = """
clockm AS (
  SELECT c.*,
         CASE WHEN t1 >= 0 AND t1 // 100 < 24 AND t1 % 100 < 60 THEN (t1 // 100) * 60 + t1 % 100 END AS m1,
         CASE WHEN t2 >= 0 AND t2 // 100 < 24 AND t2 % 100 < 60 THEN (t2 // 100) * 60 + t2 % 100 END AS m2
  FROM (SELECT event_id, user_id,
               CASE WHEN t1 = 2400 THEN 0 ELSE t1 END AS t1,
               CASE WHEN t2 = 2400 THEN 0 ELSE t2 END AS t2, diff FROM clock) c)
"""


@register(
    "clock_diff_consistent",
    f"WITH {fx.CLOCK_SQL}, {_CLOCK_MIN_SQL} SELECT event_id, user_id, t1, t2, diff FROM clockm "
    f"WHERE NOT (abs({_CLOCK_ERR_SQL}) > 0)",
)
def clock_diff_consistent(spark, sf):
    return quality.clock_consistent(fx.clock_events(Tables(spark, sf)), "t1", "t2", "diff")


@register(
    "clock_diff_anomalies",
    f"WITH {fx.CLOCK_SQL}, {_CLOCK_MIN_SQL} SELECT event_id, user_id, t1, t2, diff, "
    f"CAST({_CLOCK_ERR_SQL} AS INTEGER) AS gap_error FROM clockm WHERE abs({_CLOCK_ERR_SQL}) > 0",
)
def clock_diff_anomalies(spark, sf):
    return quality.clock_anomalies(fx.clock_events(Tables(spark, sf)), "t1", "t2", "diff")


# ------------------------------ additive consistency --------------------------------

@register(
    "sum_consistency",
    f"WITH {fx.ORDERS_PARTS_SQL} SELECT * FROM oparts WHERE NOT (a + b + c <> total)",
)
def sum_consistency(spark, sf):
    return quality.sum_consistent(fx.orders_parts(Tables(spark, sf)), ["a", "b", "c"], "total")


@register(
    "breakdown_consistency",
    f"WITH {fx.ORDERS_BREAKDOWN_SQL} SELECT * FROM obreak WHERE NOT ("
    + " AND ".join(f"{c} IS NOT NULL" for c in fx.BREAKDOWN_COLS)
    + " AND (" + " + ".join(fx.BREAKDOWN_COLS) + ") <> total)",
)
def breakdown_consistency(spark, sf):
    return quality.breakdown_consistent(fx.orders_breakdown(Tables(spark, sf)), fx.BREAKDOWN_COLS, "total")


# --------------------------- filters, complement, counts ----------------------------

@register(
    "clean_filter_complement",
    f"""WITH {fx.ORDERS_NULLS_SQL},
    s AS (SELECT count(*) AS total,
                 count(*) FILTER (WHERE cancelled = 1 OR diverted = 1) AS s0,
                 count(*) FILTER (WHERE cancelled = 0 AND diverted = 0) AS s1,
                 count(*) FILTER (WHERE cancelled = 0 AND diverted = 0 AND o_totalprice IS NOT NULL) AS s2
          FROM onull)
    SELECT 'cancelled_or_diverted' AS step, s0 AS n_rows, round(s0 * 100.0 / total, {R}) AS pct_of_total FROM s
    UNION ALL SELECT 'kept_flights', s1, round(s1 * 100.0 / total, {R}) FROM s
    UNION ALL SELECT 'kept_with_price', s2, round(s2 * 100.0 / total, {R}) FROM s""",
)
def clean_filter_complement(spark, sf):
    """Disjunctive filter, its complement, then IS NOT NULL; counted in one scan."""
    o = fx.orders_nulls(Tables(spark, sf))
    bad = (F.col("cancelled") == 1) | (F.col("diverted") == 1)
    good = (F.col("cancelled") == 0) & (F.col("diverted") == 0)
    return quality.step_counts(
        o,
        [
            ("cancelled_or_diverted", bad),
            ("kept_flights", good),
            ("kept_with_price", good & F.col("o_totalprice").isNotNull()),
        ],
    )


@register(
    "clean_orders",
    f"WITH {fx.ORDERS_NULLS_SQL} SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority "
    "FROM onull WHERE cancelled = 0 AND diverted = 0 AND o_totalprice IS NOT NULL",
)
def clean_orders(spark, sf):
    """The cleaned rows themselves: complement filter, null filter, flag columns dropped."""
    o = fx.orders_nulls(Tables(spark, sf))
    kept, _ = quality.filter_with_complement(o, (F.col("cancelled") == 0) & (F.col("diverted") == 0))
    return kept.where(F.col("o_totalprice").isNotNull()).drop("cancelled", "diverted")


_ONULL_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "cancelled", "diverted"]


@register(
    "profile_null_counts",
    f"WITH {fx.ORDERS_NULLS_SQL} SELECT "
    + ", ".join(f"CAST(count(*) - count({c}) AS BIGINT) AS {c}_null_count" for c in _ONULL_COLS)
    + " FROM onull",
)
def profile_null_counts(spark, sf):
    return profile.null_counts(fx.orders_nulls(Tables(spark, sf)))


# ------------------------------------ profiling -------------------------------------

@register(
    "profile_describe",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}::DOUBLE), {R}) AS mean, "
        f"round(stddev_samp({c}::DOUBLE), {R}) AS stddev, min({c}::DOUBLE) AS min, max({c}::DOUBLE) AS max FROM lineitem"
        for c in LINEITEM_NUMERIC
    ),
)
def profile_describe(spark, sf):
    li = Tables(spark, sf).lineitem
    return profile.describe(li, profile.numeric_columns(li))


_PAIRS = [(a, b) for i, a in enumerate(LINEITEM_NUMERIC) for b in LINEITEM_NUMERIC[i:]]


@register(
    "profile_corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}::DOUBLE, {b}::DOUBLE), {R}) AS corr FROM lineitem"
        for a, b in _PAIRS
    ),
)
def profile_corr_matrix(spark, sf):
    li = Tables(spark, sf).lineitem
    return profile.corr_matrix(li, LINEITEM_NUMERIC)


_HISTS = [("l_extendedprice", 20), ("l_quantity", 10)]


def _hist_sql(col: str, bins: int) -> str:
    return f"""SELECT '{col}' AS "column", bin, round(mn + (bin - 1) * ((mx - mn) / {bins}), {R}) AS lo,
                      round(mn + bin * ((mx - mn) / {bins}), {R}) AS hi, n
               FROM (SELECT CAST(coalesce(least(floor((x - mn) / nullif(mx - mn, 0) * {bins}) + 1, {bins}), 1) AS INTEGER) AS bin,
                            count(*) AS n, any_value(mn) AS mn, any_value(mx) AS mx
                     FROM (SELECT {col}::DOUBLE AS x, min({col}::DOUBLE) OVER () AS mn, max({col}::DOUBLE) OVER () AS mx FROM lineitem)
                     WHERE x IS NOT NULL GROUP BY 1)"""


@register("profile_histogram", " UNION ALL ".join(_hist_sql(c, b) for c, b in _HISTS))
def profile_histogram(spark, sf):
    li = Tables(spark, sf).lineitem
    out = None
    for c, b in _HISTS:
        h = profile.histogram(li, c, b)
        out = h if out is None else out.unionByName(h)
    return out


_CARD_COLS = ["l_returnflag", "l_linestatus", "l_partkey", "l_suppkey", "l_shipdate"]


@register(
    "profile_cardinality",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM lineitem" for c in _CARD_COLS),
)
def profile_cardinality(spark, sf):
    return profile.cardinality(Tables(spark, sf).lineitem, _CARD_COLS)


@register(
    "zscore_outliers",
    f"""WITH s AS (SELECT avg(value) AS mu, stddev_samp(value) AS sd FROM events),
         z AS (SELECT event_id, value, (value - s.mu) / s.sd AS z FROM events CROSS JOIN s)
    SELECT event_id, value, round(z, {R}) AS z, z > 3 AS above FROM z WHERE abs(z) > 3""",
)
def zscore_outliers(spark, sf):
    """P15/A12/T4 on events.value: |z| > 3, strongest first; ``above`` marks z > 3."""
    ev = Tables(spark, sf).events.select("event_id", "value")
    out = profile.zscore_outliers(ev, "value")
    return out.select("event_id", "value", F.round("z", R).alias("z"), (F.col("z") > 3).alias("above"))


@register(
    "zscore_signed",
    f"""WITH s AS (SELECT avg(c_acctbal) AS mu, stddev_samp(c_acctbal) AS sd FROM customer),
         z AS (SELECT c_custkey, c_acctbal, (c_acctbal - s.mu) / s.sd AS z FROM customer CROSS JOIN s)
    SELECT c_custkey, c_acctbal, round(z, {R}) AS z, CASE WHEN z > 1.5 THEN 'high' ELSE 'negative' END AS side FROM z WHERE z > 1.5 OR c_acctbal < 0""",
)
def zscore_signed(spark, sf):
    """P15, directional: balances far above the mean (z > 1.5), and negative ones."""
    c = Tables(spark, sf).customer.select("c_custkey", "c_acctbal")
    return profile.signed_outliers(c, "c_acctbal", 1.5).select("c_custkey", "c_acctbal", F.round("z", R).alias("z"), "side")


@register(
    "category_extremes",
    f"""WITH m AS (SELECT l_suppkey, round(avg(l_extendedprice), 8) AS mean_target FROM lineitem GROUP BY l_suppkey),
         t AS (SELECT l_suppkey, mean_target, row_number() OVER (ORDER BY mean_target DESC, l_suppkey) AS rn, 'top' AS side FROM m),
         b AS (SELECT l_suppkey, mean_target, row_number() OVER (ORDER BY mean_target ASC, l_suppkey) AS rn, 'bottom' AS side FROM m)
    SELECT l_suppkey, round(mean_target, {R}) AS mean_target, rn, side FROM (SELECT * FROM t WHERE rn <= 5 UNION ALL SELECT * FROM b WHERE rn <= 5)""",
)
def category_extremes(spark, sf):
    return profile.category_extremes(Tables(spark, sf).lineitem, "l_suppkey", "l_extendedprice", n=5)


@register(
    "date_to_int",
    "SELECT o_orderkey, CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS date_int FROM orders",
)
def date_to_int(spark, sf):
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", profile.date_to_int(F.col("o_orderdate")).alias("date_int"))


# ------------------------------------- JSON -----------------------------------------

@register(
    "json_metrics_flatten",
    f"""WITH kv AS (SELECT event_type, unnest(json_keys(props)) AS metric, props FROM events)
    SELECT event_type, metric, count(*) AS n, round(avg(CAST(json_extract_string(props, '$."' || metric || '"') AS DOUBLE)), {R}) AS mean_value
    FROM kv GROUP BY event_type, metric""",
)
def json_metrics_flatten(spark, sf):
    """A JSON object column parsed as map<string,double>, exploded, averaged per group."""
    ev = Tables(spark, sf).events
    kv = ev.select("event_type", F.explode(F.from_json("props", "map<string,double>")).alias("metric", "v"))
    return kv.groupBy("event_type", "metric").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("v"), R).alias("mean_value"))


@register(
    "json_leaves",
    """WITH c AS (SELECT n_nationkey, n_name, count(c_custkey) AS n, min(c_custkey) AS lo, max(c_custkey) AS hi
                  FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2)
    SELECT n_nationkey, '$.name' AS path, 'STRING' AS kind, n_name AS value FROM c
    UNION ALL SELECT n_nationkey, '$.customers.n', 'BIGINT', CAST(n AS VARCHAR) FROM c
    UNION ALL SELECT n_nationkey, '$.customers.range[0]', CASE WHEN lo IS NULL THEN 'VOID' ELSE 'BIGINT' END, CAST(lo AS VARCHAR) FROM c
    UNION ALL SELECT n_nationkey, '$.customers.range[1]', CASE WHEN hi IS NULL THEN 'VOID' ELSE 'BIGINT' END, CAST(hi AS VARCHAR) FROM c
    UNION ALL SELECT n_nationkey, CASE WHEN n % 2 = 0 THEN '$.notes[0].method' ELSE '$.notes' END, CASE WHEN n % 2 = 0 THEN 'STRING' ELSE 'EMPTY' END, CASE WHEN n % 2 = 0 THEN 'svd' END FROM c
    UNION ALL SELECT n_nationkey, '$["is even"]', 'BOOLEAN', CASE WHEN n % 2 = 0 THEN 'true' ELSE 'false' END FROM c""",
)
def json_leaves(spark, sf):
    """One multi-line JSON file a nation, listed, read whole and opened leaf by leaf."""
    t = Tables(spark, sf)
    c = t.nation.join(t.customer, F.col("c_nationkey") == F.col("n_nationkey"), "left").groupBy("n_nationkey", "n_name").agg(F.count("c_custkey").alias("n"), F.min("c_custkey").alias("lo"), F.max("c_custkey").alias("hi"))
    even = F.col("n") % 2 == 0
    notes = F.when(even, F.array(F.struct(F.lit("svd").alias("method")))).otherwise(F.array().cast("array<struct<method: string>>"))
    made = F.struct(F.col("n_name").alias("name"), F.struct("n", F.array("lo", "hi").alias("range")).alias("customers"), notes.alias("notes"), even.alias("is even"))
    path = scratch_path(spark, "nations-json")
    c.select("n_nationkey", F.to_json(made, {"pretty": "true", "ignoreNullFields": "false"}).alias("value")).repartition("n_nationkey").write.partitionBy("n_nationkey").text(path)
    files = nested.read_whole_files(spark, path, "part-*")
    key = F.regexp_extract("file", "n_nationkey=([0-9]+)", 1).cast("int").alias("n_nationkey")
    return nested.json_leaves(files.select(key, "value"), "value", ["n_nationkey"])
