"""Data-quality checks: clock-time consistency, additive consistency, filters
with their complement, and one-pass row counting.

All checks are row-local column expressions (no shuffle); counts are one
aggregation pass with ``count_if``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_MINUTES = 1440


def hhmm_minutes(c: Column) -> Column:
    """HHMM clock number → minutes after midnight; 2400 counts as 0; values that
    are not a valid clock time give null."""
    v = F.when(c == 2400, F.lit(0)).otherwise(c).cast("int")
    hh, mm = F.floor(v / 100).cast("int"), v % 100
    return F.when((v >= 0) & (hh < 24) & (mm < 60), hh * 60 + mm)


def clock_gap_error(t1: Column, t2: Column, diff: Column) -> Column:
    """Signed error of the claim ``t2 − t1 = diff`` for HHMM clocks.

    t2 moves to the next day when it reads earlier than t1 but diff > 0, t1
    moves when t2 reads later but diff < 0; diff counts modulo one day and keeps
    its sign (−1450 → −10).  0 means consistent, null means undecidable.
    """
    a = F.when(t1 == 2400, F.lit(0)).otherwise(t1)
    b = F.when(t2 == 2400, F.lit(0)).otherwise(t2)
    m1, m2 = hhmm_minutes(a), hhmm_minutes(b)
    m2 = F.when((b < a) & (diff > 0), m2 + DAY_MINUTES).otherwise(m2)
    m1 = F.when((b > a) & (diff < 0), m1 + DAY_MINUTES).otherwise(m1)
    return (m2 - m1) - diff.cast("int") % DAY_MINUTES


def clock_consistent(df: DataFrame, t1: str, t2: str, diff: str) -> DataFrame:
    """Rows whose clock columns agree with ``diff``; undecidable rows are dropped
    (three-valued logic of ``NOT anomaly``).  2400 is rewritten to 0 in the output."""
    err = clock_gap_error(F.col(t1), F.col(t2), F.col(diff))
    out = df.where(~(F.abs(err) > 0))
    for c in (t1, t2):
        out = out.withColumn(c, F.when(F.col(c) == 2400, F.lit(0)).otherwise(F.col(c)))
    return out


def clock_anomalies(df: DataFrame, t1: str, t2: str, diff: str) -> DataFrame:
    err = clock_gap_error(F.col(t1), F.col(t2), F.col(diff))
    return df.withColumn("gap_error", err).where(F.abs(F.col("gap_error")) > 0)


def sum_consistent(df: DataFrame, parts: list[str], total: str) -> DataFrame:
    """Keep rows where the parts add up to ``total``; a null anywhere drops the row."""
    s = reduce(lambda x, y: x + y, [F.col(p) for p in parts])
    return df.where(~(s != F.col(total)))


def breakdown_consistent(df: DataFrame, parts: list[str], total: str) -> DataFrame:
    """Check the sum only when every part is present; rows with a null part are kept."""
    all_present = reduce(lambda x, y: x & y, [F.col(p).isNotNull() for p in parts])
    s = reduce(lambda x, y: x + y, [F.col(p) for p in parts])
    return df.where(~(all_present & (s != F.col(total))))


def filter_with_complement(df: DataFrame, cond: Column) -> tuple[DataFrame, DataFrame]:
    return df.where(cond), df.where(~cond)


def step_counts(df: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """(step, n_rows, pct_of_total) for named row predicates, in one scan."""
    aggs = [F.count(F.lit(1)).alias("total")] + [F.count_if(c).alias(f"s{i}") for i, (_, c) in enumerate(steps)]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{name}', s{i}" for i, (name, _) in enumerate(steps))
    long = one.selectExpr("total", f"stack({len(steps)}, {stack}) AS (step, n_rows)")
    return long.select(
        "step",
        F.col("n_rows").cast("long").alias("n_rows"),
        F.round(F.try_divide(F.col("n_rows") * F.lit(100.0), F.col("total")), 6).alias("pct_of_total"),
    )
