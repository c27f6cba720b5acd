"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of equal size.  Block j (from 0) of a source with weight
w = a / A has the release time floor(j / w) and the deadline ceil((j + 1) / w), in slots of
one block; earliest deadline first among the released blocks meets every deadline, so at
every slot each source is within less than one block of its target.  Integer weights make
the schedule repeat after A slots, in which a source gets exactly a blocks: the scheduler
runs over that one period only (it depends on the weights alone, never on data), and
block j of a source goes to slot (j div a) * A + place of its block (j mod a).

Blocks of a source that has run out leave their slots empty and the others go on in the
same proportion, so every row is kept and gets a place.

Defined cases
* sources without a weight of their own, null ones included, share the weight of ``OTHER``
  as one stream.
* rows are put in order by a hash of doc_id and then text; repeated rows are kept, each
  with a place of its own; null doc_id or text are values like any other.
* empty table: no rows.  Extra columns stay as they are.
"""

from __future__ import annotations

import heapq
from fractions import Fraction
from math import ceil, floor

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OTHER = "*"
BLOCK_ROWS = 16
BUCKET_DIGITS = 3  # hex digits of the order hash by which a source's rows are dealt out


def period(weights: dict[str, int]) -> list[tuple[str, int]]:
    """Earliest-deadline-first over one period: for every slot, (source, number of its
    block).  All deadlines are checked, which holds for any integer weights."""
    total = sum(weights.values())
    ready, coming = [], []
    for s, a in weights.items():
        if a < 1:
            raise ValueError(f"weight of {s!r} must be a positive integer")
        w = Fraction(a, total)
        for j in range(a):
            coming.append((floor(j / w), ceil((j + 1) / w), s, j))
    coming.sort(key=lambda x: x[0], reverse=True)
    out = []
    for slot in range(total):
        while coming and coming[-1][0] <= slot:
            _, deadline, s, j = coming.pop()
            heapq.heappush(ready, (deadline, s, j))
        deadline, s, j = heapq.heappop(ready)
        if slot >= deadline:
            raise AssertionError("a block missed its deadline")
        out.append((s, j))
    return out


def rank_in_stream(docs: DataFrame, weights: dict[str, int], digits: int = BUCKET_DIGITS, columns: list[str] | None = None) -> DataFrame:
    """(row, stream, rank): rank counts a stream's rows from 0 in the order of a hash of
    doc_id, then doc_id, then a hash of the text.  ``row`` holds ``columns`` (all by default);
    a text that is not among them is hashed where it is read and not sent.

    Rows are ranked inside (stream, leading hash digits), which splits a hot source into
    16^digits parts; the offsets of the parts come from their counts, at most
    16^digits numbers per stream."""
    stream = F.when(docs["source"].isin(*[s for s in weights if s != OTHER]), docs["source"]).otherwise(F.lit(OTHER))
    h = F.md5(F.coalesce(docs["doc_id"].cast("string"), F.lit("")))
    rows = docs.select(
        F.struct(*(docs[c] for c in columns or docs.columns)).alias("row"), stream.alias("stream"), h.alias("h"),
        docs["doc_id"].alias("id"), F.md5(docs["text"].cast("string")).alias("t"), F.substring(h, 1, digits).alias("part"),
    )
    counts = rows.groupBy("stream", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("stream").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("stream", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    order = Window.partitionBy("stream", "part").orderBy("h", F.col("id").asc_nulls_first(), F.col("t").asc_nulls_first())
    local = rows.withColumn("local", F.row_number().over(order) - 1)
    return local.join(offsets, ["stream", "part"]).select("row", "stream", (F.col("offset") + F.col("local")).alias("rank"))


def mix(docs: DataFrame, weights: dict[str, int], block_rows: int = BLOCK_ROWS, digits: int = BUCKET_DIGITS, columns: list[str] | None = None) -> DataFrame:
    """All rows of ``docs`` as ``row`` (its ``columns``; all by default), with (stream, block, slot, place): the block within
    the stream, the slot it is scheduled in, and the row's place in the mixture, which
    orders all rows (places of streams that have run out stay empty)."""
    weights = {**weights, OTHER: weights.get(OTHER, 1)}
    places: dict[str, list[int]] = {s: [] for s in weights}
    for slot, (s, _) in enumerate(period(weights)):
        places[s].append(slot)
    total = sum(weights.values())
    ranked = rank_in_stream(docs, weights, digits, columns)
    # one slot array per source, chosen by the row's stream: sized by the weights alone
    arrays = None
    for s, slots in places.items():
        value = F.array(*(F.lit(x) for x in slots))
        arrays = F.when(F.col("stream") == s, value) if arrays is None else arrays.when(F.col("stream") == s, value)
    block = F.floor(F.col("rank") / block_rows)
    turn = F.floor(F.col("block") / F.size("slots"))
    slot = turn * total + F.get("slots", F.pmod(F.col("block"), F.size("slots")).cast("int"))
    return (
        ranked.withColumn("slots", arrays).withColumn("block", block).withColumn("slot", slot)
        .select("row", "stream", "block", "slot", (F.col("slot") * block_rows + F.pmod(F.col("rank"), F.lit(block_rows))).alias("place"))
    )


def write_mixture(mixed: DataFrame, path: str, files: int) -> None:
    """Store a mixture in training order: file after file, row after row."""
    mixed.repartitionByRange(files, "place").sortWithinPartitions("place").select("row.*").write.parquet(path)
