"""Previous row per key in time order, safe for a key that holds a large share
of all rows.

``lag(...) OVER (PARTITION BY key ORDER BY ts)`` sends every row of a key to one
task.  Here rows are windowed per (key, time bucket) instead; the first row of
each bucket takes the last row of the key's previous non-empty bucket, found by
a window over one summary row per (key, bucket).  The widest window therefore
holds the rows of one key in one bucket, or one row per bucket of one key —
bounded by the time span, not by the data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def previous_in_key(df: DataFrame, key: str, ts: str, tiebreak: str, cols: list[str], bucket: str = "hour") -> DataFrame:
    """Adds ``prev_<c>`` for each c in ``cols``: the value of the row before, in
    (ts, tiebreak) order within ``key``; null for the key's first row."""
    b = F.date_trunc(bucket, F.col(ts)).alias("_bucket")
    base = df.withColumn("_bucket", b)
    order = [F.col(ts), F.col(tiebreak)]
    w_in = Window.partitionBy(key, "_bucket").orderBy(*order)
    within = base.withColumn("_rn", F.row_number().over(w_in))
    for c in cols:
        within = within.withColumn(f"prev_{c}", F.lag(c).over(w_in))

    # Last row of each (key, bucket), then the previous bucket's last row.
    last = base.groupBy(key, "_bucket").agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_last"))
    w_b = Window.partitionBy(key).orderBy("_bucket")
    carry = last.select(key, "_bucket", F.lag("_last").over(w_b).alias("_carry"))

    joined = within.join(carry, [key, "_bucket"], "left")
    for c in cols:
        joined = joined.withColumn(
            f"prev_{c}", F.when(F.col("_rn") == 1, F.col(f"_carry.{c}")).otherwise(F.col(f"prev_{c}"))
        )
    return joined.drop("_bucket", "_rn", "_carry")
