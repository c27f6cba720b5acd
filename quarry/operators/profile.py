"""Column profiling in few passes: null counts, numeric summaries, correlation
matrix, equal-width histograms, cardinalities, z-score outliers and category
extremes.

Global statistics enter row expressions as scalar subqueries (computed once,
inlined as a value) — never a driver ``collect`` and never a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

R = 6
RANK_DIGITS = 8  # ranks are taken above the noise of summation order, not on shown digits


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Columns of numeric type, chosen from the schema at plan time."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, NumericType) and not isinstance(f.dataType, BooleanType) and f.name not in exclude
    ]


def null_counts(df: DataFrame, suffix: str = "_null_count") -> DataFrame:
    """One row, one ``<col>_null_count`` column per input column, one scan."""
    return df.select([F.sum(F.col(c).isNull().cast("long")).alias(c + suffix) for c in df.columns])


def _long(one_row: DataFrame, names: list[str], fields: list[str]) -> DataFrame:
    """Unpivot ``<name>__<field>`` columns of a one-row frame into (column, fields...)."""
    body = ", ".join(f"'{n}', " + ", ".join(f"`{n}__{f}`" for f in fields) for n in names)
    return one_row.selectExpr(f"stack({len(names)}, {body}) AS (column, {', '.join(fields)})")


def describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, count, mean, stddev, min, max) — typed, long format, one pass."""
    cols = cols or numeric_columns(df)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"{c}__count"),
            F.round(F.avg(x), R).alias(f"{c}__mean"),
            F.round(F.stddev_samp(x), R).alias(f"{c}__stddev"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
        ]
    return _long(df.agg(*aggs), cols, ["count", "mean", "stddev", "min", "max"])


def corr_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(col_a, col_b, corr) for every pair a ≤ b (pairwise-complete rows), one pass."""
    cols = cols or numeric_columns(df)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    aggs = [F.round(F.corr(F.col(a).cast("double"), F.col(b).cast("double")), R).alias(f"p{i}") for i, (a, b) in enumerate(pairs)]
    body = ", ".join(f"'{a}', '{b}', p{i}" for i, (a, b) in enumerate(pairs))
    return df.agg(*aggs).selectExpr(f"stack({len(pairs)}, {body}) AS (col_a, col_b, corr)")


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width histogram over [min, max]; the max value falls in the last bin.
    (column, bin, lo, hi, n) with empty bins omitted."""
    x = F.col(col).cast("double")
    stats = df.agg(F.min(x).alias("mn"), F.max(x).alias("mx"))
    mn, mx = stats.select("mn").scalar(), stats.select("mx").scalar()
    width = (mx - mn) / F.lit(bins)
    b = F.least(F.floor(F.try_divide(x - mn, mx - mn) * bins) + 1, F.lit(bins))
    b = F.coalesce(b, F.lit(1))  # all values equal → one bin
    counted = df.where(x.isNotNull()).groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        F.lit(col).alias("column"),
        "bin",
        F.round(mn + (F.col("bin") - 1) * width, R).alias("lo"),
        F.round(mn + F.col("bin") * width, R).alias("hi"),
        "n",
    )


def cardinality(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, n_distinct): exact distinct count per column.

    Rows are unpivoted to (column, value) and de-duplicated with one partial +
    final aggregation, instead of k DISTINCT aggregates (which Spark would plan
    as an Expand of every row k times followed by the same shuffle)."""
    body = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in cols)
    pairs = df.selectExpr(f"stack({len(cols)}, {body}) AS (column, value)").where(F.col("value").isNotNull())
    return pairs.distinct().groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))


def zscore(df: DataFrame, col: str, out: str = "z") -> DataFrame:
    """Adds ``out`` = (x − mean) / sample stddev, both as scalar subqueries."""
    x = F.col(col).cast("double")
    stats = df.agg(F.avg(x).alias("mu"), F.stddev_samp(x).alias("sd"))
    mu, sd = stats.select("mu").scalar(), stats.select("sd").scalar()
    return df.withColumn(out, F.try_divide(x - mu, sd))


def zscore_outliers(df: DataFrame, col: str, threshold: float = 3.0) -> DataFrame:
    """Rows with |z| > threshold, strongest first (the order is a presentation
    detail; the set is the result)."""
    z = zscore(df, col)
    return z.where(F.abs(F.col("z")) > threshold).orderBy(F.abs(F.col("z")).desc())


def signed_outliers(df: DataFrame, col: str, threshold: float = 3.0) -> DataFrame:
    """Rows with z > threshold ("high") or a value below 0 ("negative"), with ``side``; a row
    is never both unless the mean itself is far below 0, then it counts as high."""
    side = F.when(F.col("z") > threshold, "high").when(F.col(col) < 0, "negative")
    return zscore(df, col).withColumn("side", side).where(F.col("side").isNotNull())


def category_extremes(df: DataFrame, cat: str, target: str, n: int = 5) -> DataFrame:
    """Top-n and bottom-n categories by mean target: (cat, mean, side, rn).

    The mean per category is a partial + final aggregation; the two ranking
    windows run over one row per category with a group limit each."""
    means = df.groupBy(cat).agg(F.round(F.avg(F.col(target).cast("double")), RANK_DIGITS).alias("mean_target"))

    def side(order: Column, name: str) -> DataFrame:
        # orderBy + limit is a distributed top-k (TakeOrdered); the numbering
        # window then sees at most n rows.
        k = means.orderBy(order, F.col(cat)).limit(n)
        return k.withColumn("rn", F.row_number().over(Window.orderBy(order, F.col(cat))).cast("long")).withColumns({"side": F.lit(name), "mean_target": F.round("mean_target", R)})

    return side(F.col("mean_target").desc(), "top").unionByName(side(F.col("mean_target").asc(), "bottom"))


def date_to_int(c: Column) -> Column:
    """yyyymmdd as an integer."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)
