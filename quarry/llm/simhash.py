"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has 64 bits.  For radius r every bit i gets a non-zero vector phi(i) of
r + 1 bits, and every non-zero vector v gives one table whose mask holds the bits with
phi(i) . v odd.  r differing bits give r equations in r + 1 unknowns, so some v is
orthogonal to all of them: in that table the two masked fingerprints are equal.  All
2^(r+1) - 1 tables together therefore miss no pair within the radius, and each masks out
about half of the bits.

Defined cases
* null, empty or white text: no words, fingerprint zero, linked like any other.
* fewer words than the shingle length: the whole sequence is the one shingle.
* null ``doc_id``: never a component id unless the whole group has none, then null.
* repeated ``doc_id``: rows are fingerprinted one by one; the component id is the smallest
  id of the group.
* empty table: no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.words import LOWER
from quarry.operators.graph import connected_components
from quarry.session import materialize, ship_package

SEED = 42
SHINGLE = 3
RADIUS = 3
SPLIT_ABOVE = 50_000  # distinct fingerprints of one bucket that are compared in one task
STEP = 1 << 16        # shingles whose bits are counted at a time


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash over all k-word shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    k = min(k, len(words))
    joined = b" ".join(words)
    start = [0, *accumulate(len(w) + 1 for w in words)]
    n = len(words) - k + 1
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for a in range(0, n, STEP):
        b = min(n, a + STEP)
        h = np.array([digest(joined[s:e - 1], SEED) for s, e in zip(start[a:b], start[a + k:b + k])], np.uint64)
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE, *more: Column) -> DataFrame:
    """(doc_id, fp) and the columns ``more``: fp is the fingerprint as a signed long."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, k) for t in texts], np.uint64).view(np.int64))

    return docs.select("doc_id", of(F.col("text").cast("string")).alias("fp"), *more)


def masks(radius: int, turn: int = 0) -> list[int]:
    """The covering masks, as signed longs; ``turn`` deals the vectors to other bits."""
    n = 2 ** (radius + 1) - 1
    phi = [1 + (i * (1 + 6 * turn) + turn) % n for i in range(64)]
    out = []
    for v in range(1, n + 1):
        m = sum(1 << i for i in range(64) if (phi[i] & v).bit_count() % 2)
        out.append(m - (1 << 64) if m >> 63 else m)
    return out


def tables(fps: DataFrame, radius: int, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """(fp, table, key, sub): every fingerprint once in each covering table.  Buckets with
    more than ``split_above`` fingerprints are covered again by a second family of masks:
    a pair within the radius that shares the bucket also shares a part of it."""
    def covered(turn):
        return F.array(*(F.struct(F.lit(t).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks(radius, turn))))

    rows = fps.select("fp", F.explode(covered(0)).alias("c")).select("fp", "c.table", "c.key")
    large = rows.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > split_above)
    marked = rows.join(large, ["table", "key"], "left")
    parts = F.when(F.col("n").isNull(), F.array(F.struct(F.lit(-1).alias("table"), F.lit(0).cast("long").alias("key")))).otherwise(covered(1))
    return marked.select("fp", "table", "key", F.explode(parts).alias("sub"))


def bucket_edges(bucket: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links inside one bucket: at most len - 1 pairs, however
    dense the bucket is.  Each round compares one reached fingerprint with those that
    are not reached yet."""
    left = np.unique(bucket)
    edges, todo = [], []
    while len(left) or todo:
        if not todo:
            todo, left = [left[0]], left[1:]
            continue
        x = todo.pop()
        near = np.bitwise_count((left ^ x).view(np.uint64)) <= radius
        if near.any():
            found = left[near]
            edges += [(int(x), int(y)) for y in found]
            todo += list(found)
            left = left[~near]
    return edges


def links(fps: DataFrame, radius: int = RADIUS, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """(src, dst): links between distinct fingerprints whose closure is that of all links
    of at most ``radius`` differing bits."""
    buckets = tables(fps, radius, split_above).groupBy("table", "key", "sub").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for b in pdf["fps"]:
                found = bucket_edges(np.asarray(b, np.int64), radius)
                if found:
                    yield pd.DataFrame(found, columns=["src", "dst"])

    return buckets.select("fps").mapInPandas(search, "src long, dst long").distinct()


def rooted(marks: DataFrame, first: Column, radius: int, split_above: int) -> tuple[DataFrame, DataFrame]:
    """(fp, first, root) of every fingerprint, and (root, lead) of every group: its smallest
    ``first``, a column over ``marks``.

    Copies share a fingerprint and never make pairs: the graph is over distinct
    fingerprints."""
    each = marks.groupBy("fp").agg(F.min(first).alias("first"))
    found = materialize(links(each.select("fp"), radius, split_above), "fp-links")
    ends = found.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    groups = connected_components(found, ends).toDF("fp", "root")
    each = each.join(groups, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    return each, each.groupBy("root").agg(F.min("first").alias("lead"))


def near_duplicates(docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """(doc_id, fp, component_id): documents joined by chains of fingerprints that differ
    in at most ``radius`` bits; component_id is the smallest doc_id of the group."""
    marks = materialize(fingerprints(docs, k), "fingerprints")
    each, smallest = rooted(marks, F.col("doc_id"), radius, split_above)
    final = each.join(smallest, "root").select("fp", F.col("lead").alias("component_id"))
    return marks.join(final, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` (all columns) of each group: of those with its smallest doc_id,
    null only if the whole group has no other, the one with the smallest hash.  Equal rows
    are one."""
    parts = [x for c in docs.columns for x in (docs[c], docs[c].isNull())]
    k1, k2 = F.xxhash64(*parts).alias("k1"), F.xxhash64(F.lit(1), *parts).alias("k2")
    marks = materialize(fingerprints(docs, k, F.struct(k1, k2).alias("key")), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("key.k1").alias("k1"), F.col("key.k2").alias("k2"))
    lead = rooted(marks, first, radius, SPLIT_ABOVE)[1].select("lead.k1", "lead.k2")
    # equal rows meet after a partial aggregation, so a row that is repeated often is not one task
    rows = docs.select(k1, k2, F.struct(*(docs[c] for c in docs.columns)).alias("row")).groupBy("k1", "k2").agg(F.first("row").alias("row"))
    return rows.join(lead, ["k1", "k2"], "left_semi").select("row.*")
