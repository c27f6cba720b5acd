"""Derived test fixtures: the same recipe as a Spark plan and as a DuckDB CTE.

They turn the bundled tables into stand-ins for the reference's inputs
(flight clock columns, null patterns, additive breakdowns, ratings).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.sequence import previous_in_key
from quarry.sources.tables import Tables

# Fixed values of the recipes (shared by both engines).
CLOCK_INJECT_MOD = 97      # event_id % 97 = 0 → diff off by +7 minutes
CLOCK_INJECT_MINUTES = 7
NULL_PRICE_MOD = 50        # o_totalprice null
NULL_PRIORITY_MOD = 70     # o_orderpriority null
CANCELLED_MOD = 31
DIVERTED_MOD = 37
PART_MODS = (40, 25, 60)   # C3 parts a, b, c
PART_C_NULL_MOD = 90
TOTAL_OFF_MOD = 101        # total off by one
BREAKDOWN_MODS = (40, 25, 60, 7, 11)
BREAKDOWN_NULL_MOD = 3
RATING_MIN_COUNT = 70


def _hhmm(ts):
    return F.hour(ts) * 100 + F.minute(ts)


def clock_events(t: Tables) -> DataFrame:
    """(event_id, user_id, t1, t2, diff) — previous/current event clock of a user."""
    ev = t.events.select("event_id", "user_id", "ts")
    prev = previous_in_key(ev, "user_id", "ts", "event_id", ["ts"])
    minutes = (F.unix_timestamp(F.date_trunc("minute", F.col("ts"))) - F.unix_timestamp(F.date_trunc("minute", F.col("prev_ts")))) / 60
    diff = minutes.cast("int") + F.when(F.col("event_id") % CLOCK_INJECT_MOD == 0, CLOCK_INJECT_MINUTES).otherwise(0)
    return prev.where(F.col("prev_ts").isNotNull()).select(
        "event_id", "user_id", _hhmm(F.col("prev_ts")).alias("t1"), _hhmm(F.col("ts")).alias("t2"), diff.alias("diff")
    )


CLOCK_SQL = f"""
clock AS (
  SELECT event_id, user_id,
         CAST(hour(prev_ts) * 100 + minute(prev_ts) AS INTEGER) AS t1,
         CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS t2,
         CAST((epoch(date_trunc('minute', ts)) - epoch(date_trunc('minute', prev_ts))) / 60 AS INTEGER)
           + CASE WHEN event_id % {CLOCK_INJECT_MOD} = 0 THEN {CLOCK_INJECT_MINUTES} ELSE 0 END AS diff
  FROM (SELECT event_id, user_id, ts,
               lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts
        FROM events) e
  WHERE prev_ts IS NOT NULL)
"""


def orders_nulls(t: Tables) -> DataFrame:
    """Orders with injected nulls and cancelled / diverted flags."""
    k = F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.when(k % NULL_PRICE_MOD == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.when(k % NULL_PRIORITY_MOD == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        (k % CANCELLED_MOD == 0).cast("int").alias("cancelled"),
        (k % DIVERTED_MOD == 0).cast("int").alias("diverted"),
    )


ORDERS_NULLS_SQL = f"""
onull AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % {NULL_PRICE_MOD} = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
         o_orderdate,
         CASE WHEN o_orderkey % {NULL_PRIORITY_MOD} = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
         CAST(o_orderkey % {CANCELLED_MOD} = 0 AS INTEGER) AS cancelled,
         CAST(o_orderkey % {DIVERTED_MOD} = 0 AS INTEGER) AS diverted
  FROM orders)
"""


def orders_parts(t: Tables) -> DataFrame:
    """(o_orderkey, a, b, c, total) with c null and total off by one by modulus."""
    k = F.col("o_orderkey")
    a, b, c = (k % m for m in PART_MODS)
    total = a + b + c + F.when(k % TOTAL_OFF_MOD == 0, 1).otherwise(0)
    return t.orders.select(
        "o_orderkey", a.alias("a"), b.alias("b"),
        F.when(k % PART_C_NULL_MOD == 0, F.lit(None).cast("long")).otherwise(c).alias("c"),
        total.alias("total"),
    )


ORDERS_PARTS_SQL = f"""
oparts AS (
  SELECT o_orderkey, o_orderkey % {PART_MODS[0]} AS a, o_orderkey % {PART_MODS[1]} AS b,
         CASE WHEN o_orderkey % {PART_C_NULL_MOD} = 0 THEN NULL ELSE o_orderkey % {PART_MODS[2]} END AS c,
         o_orderkey % {PART_MODS[0]} + o_orderkey % {PART_MODS[1]} + o_orderkey % {PART_MODS[2]}
           + CASE WHEN o_orderkey % {TOTAL_OFF_MOD} = 0 THEN 1 ELSE 0 END AS total
  FROM orders)
"""

BREAKDOWN_COLS = [f"p{i + 1}" for i in range(len(BREAKDOWN_MODS))]


def orders_breakdown(t: Tables) -> DataFrame:
    """C4: five parts (all null by modulus) and their total (off by one by modulus)."""
    k = F.col("o_orderkey")
    parts = [k % m for m in BREAKDOWN_MODS]
    total = sum(parts[1:], parts[0]) + F.when(k % TOTAL_OFF_MOD == 0, 1).otherwise(0)
    nul = k % BREAKDOWN_NULL_MOD == 0
    cols = [F.when(nul, F.lit(None).cast("long")).otherwise(p).alias(n) for p, n in zip(parts, BREAKDOWN_COLS)]
    return t.orders.select("o_orderkey", *cols, total.alias("total"))


ORDERS_BREAKDOWN_SQL = "obreak AS (SELECT o_orderkey, " + ", ".join(
    f"CASE WHEN o_orderkey % {BREAKDOWN_NULL_MOD} = 0 THEN NULL ELSE o_orderkey % {m} END AS {n}"
    for m, n in zip(BREAKDOWN_MODS, BREAKDOWN_COLS)
) + ", " + " + ".join(f"o_orderkey % {m}" for m in BREAKDOWN_MODS) + (
    f" + CASE WHEN o_orderkey % {TOTAL_OFF_MOD} = 0 THEN 1 ELSE 0 END AS total FROM orders)"
)


def ratings(t: Tables) -> DataFrame:
    """(item, mark) from events."""
    return t.events.select(F.col("user_id").alias("item"), F.col("value").alias("mark"))


RATINGS_SQL = "ratings AS (SELECT user_id AS item, value AS mark FROM events)"
