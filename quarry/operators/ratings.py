"""Per-item review counts and mean marks with a minimum-count filter, top-k.

Both are one partial + final aggregation (a hot item only grows its partial
sums) followed by a distributed top-k (``orderBy(...).limit(k)`` plans as
TakeOrderedAndProject: k rows per partition reach the driver-side merge).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

R = 6
RANK_DIGITS = 12  # ranks are taken above the noise of summation order, not on shown digits


def top_by_count(df: DataFrame, item: str = "item", k: int = 10) -> DataFrame:
    counts = df.groupBy(item).agg(F.count(F.lit(1)).alias("n_reviews"))
    return counts.orderBy(F.col("n_reviews").desc(), F.col(item).asc()).limit(k)


def top_by_mean(df: DataFrame, item: str = "item", mark: str = "mark", min_count: int = 100, k: int = 10) -> DataFrame:
    stats = df.groupBy(item).agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.round(F.avg(F.col(mark).cast("double")), RANK_DIGITS).alias("mean_mark"),
    )
    top = (
        stats.where(F.col("n_reviews") >= min_count)
        .orderBy(F.col("mean_mark").desc(), F.col(item).asc())
        .limit(k)
    )
    return top.withColumn("mean_mark", F.round("mean_mark", R))
