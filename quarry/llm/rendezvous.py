"""Sharding by rendezvous hashing [DataFrame functions only].

A record's key and a shard's number give a hash, uniform in (0, 1); with the shard's weight
that becomes a score, -weight / ln(hash), and the record goes to the shard of the highest
score.  A shard gets records in proportion to its weight, wherever they come from.  A score
depends on no other shard, so a new shard takes records only into itself, a shard that goes
gives up only its own, and a changed weight moves records only to or from that shard.

Within a shard, records get gapless slots in the order of (hash of the key, key, checksum).
Slots come from a range partitioning of all records, in which equal records are told apart
by where they were read, with the counts of (partition, shard) added up: no shard, key or
group of copies is gathered in one task, and texts stay where they are.

Defined cases
* null key: the SHA-256 of the text stands for it, so such rows spread over all shards and
  equal ones stay together; null key and null text: one fixed key.
* null text: no bytes, checksum of no bytes.
* repeated keys and repeated rows: the same shard, slots of their own.
* shards of weight 0 or less get nothing; without any shard of positive weight: ValueError.
* empty table: no rows.  Columns other than those named are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.session import materialize

HEX = 13                  # hex digits of the hash that are used: 52 bits, exact in a double
PER_HASH = 4              # shards that one SHA-256 has digits for
PER_ROW = 16              # bytes a record takes besides its text
PARTITION_BITS = 33       # of monotonically_increasing_id, below the partition's number


def key_of(key: Column, text: Column) -> Column:
    """The string a record is placed by."""
    return F.coalesce(key.cast("string"), F.concat(F.lit("text "), F.sha2(text, 256)), F.lit("null"))


def digits(key: Column, block: Column, at: Column) -> Column:
    return F.substring(F.sha2(F.concat(key, F.lit(":"), block.cast("string")), 256), at, F.lit(HEX))


def bid(number: Column, shard: Column, weight: Column | None) -> Column:
    """What a shard bids for a record; the highest wins, in ties the smaller shard.  Without
    weights the hash's digits are compared as they are, which gives the same winner."""
    last = (-shard).alias("last")
    if weight is None:
        return F.struct(number.alias("number"), last)
    uniform = (F.conv(number, 16, 10).cast("long") + F.lit(0.5)) / F.lit(2.0 ** (4 * HEX))
    return F.struct((-weight / F.log(uniform)).alias("score"), number.alias("number"), last)


def best_bid(key: Column, weights: dict[int, float], equal: bool) -> Column:
    """The highest bid of some shards; one hash is made for each block of shards."""
    blocks: dict[int, list] = {}
    for s, w in sorted(weights.items()):
        entry = F.struct(F.lit(int(s)).alias("shard"), F.lit(HEX * (s % PER_HASH) + 1).alias("at"), F.lit(float(w)).alias("weight"))
        blocks.setdefault(s // PER_HASH, []).append(entry)
    groups = F.array(*(F.struct(F.lit(b).alias("block"), F.array(*shards).alias("shards")) for b, shards in blocks.items()))

    def best(group):
        made = F.array(F.sha2(F.concat(key, F.lit(":"), group["block"].cast("string")), 256))
        bids = lambda h: F.transform(group["shards"], lambda s: bid(F.substring(h, s["at"], F.lit(HEX)), s["shard"], None if equal else s["weight"]))
        return F.transform(made, lambda h: F.array_max(bids(h)))[0]

    return F.array_max(F.transform(groups, best))


def shards_of(key: Column, weights: dict[int, float], added: dict[int, float] | None = None) -> Column:
    """(now, grown): the shard of a key, and its shard once those of ``added`` are there."""
    weights, added = ({s: w for s, w in (x or {}).items() if w > 0} for x in (weights, added))
    if not weights:
        raise ValueError("no shard has a positive weight")
    equal = len({*weights.values(), *added.values()}) == 1
    later = lambda b: F.greatest(b, best_bid(key, added, equal)) if added else b
    return F.transform(F.array(best_bid(key, weights, equal)), lambda b: F.struct((-b["last"]).alias("now"), (-later(b)["last"]).alias("grown")))[0]


def place(docs: DataFrame, weights: dict[int, float], added: dict[int, float] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, grown_shard) of every row, in the rows' order, and the
    digits that its slot is found by.

    ``weights`` are the shards, ``added`` shards that come in later: grown_shard is the
    record's shard once they are there."""
    rows = docs.select(
        F.col(key), (F.coalesce(F.octet_length(text), F.lit(0)) + PER_ROW).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("text_crc32"), key_of(F.col(key), F.col(text)).alias("_key"),
    )
    rows = rows.withColumn("_shards", shards_of(F.col("_key"), weights, added))
    return rows.select(key, "size", "text_crc32", F.col("_shards.now").alias("shard"), F.col("_shards.grown").alias("grown_shard"), digits(F.col("_key"), F.lit("slot"), F.lit(1)).alias("_at"))


def partitions(spark, rows: int) -> int:
    """Range partitions for ``rows`` small rows: the session's number, fewer for few rows,
    more where they would hold over a million each."""
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // 8192)), rows >> 20)


def with_slots(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``slot``: 0, 1, 2, ... within each ``group`` by ``order``; rows that agree
    in all of these get slots in any order."""
    spark = rows.sparkSession
    stored = materialize(rows.withColumn("_read", F.monotonically_increasing_id()), "unplaced")
    n = partitions(spark, stored.count())
    keys = [group, *order, "_read"]
    dealt = stored.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id())
    dealt = dealt.withColumn("_part", F.shiftright("_id", PARTITION_BITS)).withColumn("_nth", F.col("_id").bitwiseAND((1 << PARTITION_BITS) - 1))
    dealt = materialize(dealt.drop("_id", "_read"), "placed")
    runs = dealt.groupBy("_part", group).agg(F.min("_nth").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_part", group, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_base"))
    # at most one run for each partition and each group: as small as the partition list
    return dealt.join(F.broadcast(runs), ["_part", group]).withColumn("slot", F.col("_nth") + F.col("_base")).drop("_part", "_nth", "_base")


def assign(docs: DataFrame, weights: dict[int, float], added: dict[int, float] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot, grown_shard): ``place`` with gapless slots."""
    placed = with_slots(place(docs, weights, added, key, text), "shard", ["_at", key, "text_crc32", "size"])
    return placed.select(key, "size", "text_crc32", "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, weights: dict[int, float], key: str = "doc_id", text: str = "text", rows_per_file: int = 1_000_000) -> None:
    """Write all rows, whole, to one folder ``shard=<n>`` for each shard, in files of at most
    ``rows_per_file`` rows.  Rows are range-partitioned by shard and hash, so a large shard is
    written by many tasks and a task writes to few shards."""
    if "shard" in docs.columns:
        raise ValueError("the documents have a column shard already")
    k = key_of(F.col(key), F.col(text))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.withColumn("shard", shards_of(k, weights)["now"])
    order = ["shard", F.xxhash64(key, text), F.monotonically_increasing_id()]
    rows.repartitionByRange(n, *order).write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path)
