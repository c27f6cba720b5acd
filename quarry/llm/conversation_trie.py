"""Prefix trie of conversations, by union-find over sorted neighbours.

Every conversation becomes a path, the keys of its turns one after the other.  Paths are
range-partitioned and sorted, so that each subtree of the trie is a run of neighbours, and
neighbours have a longest common prefix (LCP).  A task takes the edges between neighbours
in descending depth: an edge joins two runs, whose roots become children of a branching
node at that depth; the nodes above a run's root that branch nowhere lie on its way up.

The run that holds a partition's first path and the run that holds its last one may go on
in other partitions.  Their nodes stay open: a partition's forest is contracted to these two
spines, on which every node carries the sums over what is closed below it.  Neighbouring
partitions' spines are merged, some at a time, in as many rounds as needed: nodes with the
same prefix are one, and those that lie on neither outer spine any more are closed from the
deepest up.  A spine is as long as one conversation, whatever the number of conversations.

Members of a node that end there come sorted, so their hash is made in the task; those of an
open node are written as strings of some KB and hashed in order in a stream (SHA-256 of one
node's list can only be made one after the other; it is not held in memory).

Defined cases
* null conv_id: no conversation, such rows take no part.
* null role or text is empty; null turn comes first; equal turns of a conversation are
  ordered by the key of their role and text; repeated rows are turns of their own.
* very long texts only give a key and a word count.  The keys of one conversation are one
  row, 16 bytes a turn.
* empty table: no rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.session import materialize, ship_package

KEY = 16                  # bytes of a turn's key
WORD = r"[^\x20\x09-\x0D]+"
FAMILY = 20               # conversations c - c % FAMILY .. + FAMILY - 1 share heads
HEADS = 4                 # a conversation takes over 0 .. HEADS - 1 turns
PART_TURNS = 1 << 18      # turns for which a partition is made, at least
FAN = 32                  # partitions merged by one task of a round
IDS = 512                 # members of an open node in one string
ROWS = 1 << 16            # node rows made at a time
NOTHING = hashlib.sha256(b"").hexdigest()

SCHEMA = (
    "kind string, part long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, digest binary, up binary, first boolean, last boolean, words long, nth long, ids string"
)
ARROW = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
FIELDS = [(c.split()[0], ARROW[c.split()[1]]) for c in SCHEMA.split(", ")]
CLOSED, SPINE, ENDS = "closed", "spine", "ends"
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def taken_over(conv_id: Column) -> Column:
    """How many turns a conversation takes over from the first of its family."""
    return (F.crc32(conv_id.cast("string")) % HEADS).cast("int")


def conversation_paths(conversations: DataFrame, heads: Callable[[Column], Column] | None = taken_over) -> DataFrame:
    """(conv_id, path, words): a row for each conversation, its turns' keys in order and
    their numbers of words.  With ``heads`` the first turns of a conversation, as many as that
    says, are those of the first one of its family.  A family is at most FAMILY rows, so
    one shuffle of keys serves the grouping and the heads."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.left(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256), F.lit(2 * KEY))
    conv = F.col("conv_id").cast("long")
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        conv.alias("conv_id"), (conv - conv % FAMILY).alias("family"), F.struct("turn", key.alias("key"), F.regexp_count(text, F.lit(WORD)).alias("words")).alias("turn")
    )
    own = turns.repartition("family").groupBy("family", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("own"))
    if heads is not None:
        h = heads(F.col("conv_id"))
        head = F.max(F.when(F.col("conv_id") == F.col("family"), F.slice("own", 1, HEADS - 1))).over(Window.partitionBy("family"))
        own = own.withColumn("head", head).withColumn("h", h)
        kept = F.slice("own", F.col("h") + 1, F.greatest(F.size("own") - F.col("h"), F.lit(0)))
        own = own.select("conv_id", F.concat(F.when(F.col("head").isNull(), F.slice("own", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("h"))), kept).alias("own"))
    keys = F.array_join(F.transform("own", lambda t: t["key"]), "")
    return own.select("conv_id", F.unhex(keys).alias("path"), F.transform("own", lambda t: t["words"].cast("int")).alias("words"))


class Forest:
    """The trie of a partition's sorted paths, but for its open nodes' sums."""

    def __init__(self, ids: np.ndarray, length: np.ndarray, keys: np.ndarray, words: np.ndarray):
        self.ids, self.length = ids.tolist(), length.tolist()
        self.keys, self.n = keys, len(ids)
        self.begin = np.cumsum(length) - length
        self.sums = np.concatenate([[0], np.cumsum(words)])  # of words, before each turn
        self.segments: list[tuple] = []  # ways up that are closed
        self.above: list = []            # of each: the parent's conv_id, or the open parent
        self.open: list[tuple] = []      # ways up on a spine
        self.grow(self.neighbours(length))

    def neighbours(self, length: np.ndarray) -> np.ndarray:
        """LCP of each path but the first with the one before."""
        at = np.repeat(np.arange(self.n), length)
        nth = np.arange(len(at)) - self.begin[at]
        before = np.maximum(at - 1, 0)
        same = (at > 0) & (nth < length[before])
        other = np.where(same, self.begin[before] + nth, 0)
        same &= (self.keys == self.keys[other]).all(axis=1)
        differs = np.append(np.flatnonzero(~same), len(at))
        first = differs[np.searchsorted(differs, self.begin)]
        return np.minimum(first - self.begin, length)[1:]

    def grow(self, lcp: np.ndarray) -> None:
        """Union-find over the neighbour edges, deepest first.  A run is kept at its root's
        index: [first path, last path, conv_id, depth, closed children, leaves and tokens
        below, members that end at the depth (from, to), ways up that end there]."""
        runs = [[i, i, c, d, 0, 0, 0, i, i + 1, []] for i, (c, d) in enumerate(zip(self.ids, self.length))]
        root = list(range(self.n))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for e in np.argsort(-lcp, kind="stable").tolist():
            depth = int(lcp[e])
            left, right = find(e), find(e + 1)
            a, b = runs[left], runs[right]
            self.climb(a, depth)
            self.climb(b, depth)
            if len(a[9]) < len(b[9]):
                root[left], keep, into = right, right, b[9]
                into += a[9]
            else:
                root[right], keep, into = left, left, a[9]
                into += b[9]
            ends = (a[7], b[8]) if a[7] < a[8] and b[7] < b[8] else (a[7], a[8]) if a[7] < a[8] else (b[7], b[8])
            runs[keep] = [a[0], b[1], min(a[2], b[2]), depth, a[4] + b[4], a[5] + b[5], a[6] + b[6], *ends, into]
        self.climb(runs[find(0)], -1)

    def climb(self, run: list, depth: int) -> None:
        """Close the nodes of a run below ``depth``, or leave them on a spine."""
        first, last, conv, top, children, leaves, saved, begin, end, below = run
        if top == depth:
            return
        if first == 0 or last == self.n - 1:
            for s in below:
                self.above[s] = (first == 0, top)
            self.open.append((*run[:9], depth))
            run[3:] = [depth, 0, 0, 0, 0, 0, []]
            return
        for s in below:
            self.above[s] = conv
        leaves = leaves if children else 1
        copies, at = last - first, int(self.begin[first])
        run[3:] = [depth, 1, leaves, saved + copies * int(self.sums[at + top] - self.sums[at + depth]), 0, 0, [len(self.segments)]]
        self.segments.append((conv, at, top, depth, copies + 1, children, leaves, saved, begin, end))
        self.above.append(None)

    def digests(self, path: int) -> list[bytes]:
        """Identity of every prefix of a path."""
        h = hashlib.blake2b(digest_size=KEY)
        out = [h.digest()]
        for k in self.keys[self.begin[path]:self.begin[path] + self.length[path]]:
            h.update(k.tobytes())
            out.append(h.digest())
        return out

    def rows(self, part: int) -> Iterator[pa.RecordBatch]:
        spines = {True: self.digests(0), False: self.digests(self.n - 1)}
        if self.segments:
            yield from self.closed(part, spines)
        held, ends = [], []
        for first, last, conv, top, children, leaves, saved, begin, end, depth in self.open:
            digest, at = spines[first == 0], int(self.begin[first])
            for d in range(top, depth, -1):
                words = int(self.sums[at + d] - self.sums[at + d - 1]) if d else 0
                sums = (children, leaves, saved) if d == top else (0, 0, 0)
                held.append({
                    "kind": SPINE, "part": part, "conv_id": conv, "depth": d, "n_convs": last - first + 1, "n_children": sums[0], "n_leaves": sums[1], "saved_tokens": sums[2],
                    "digest": digest[d], "up": digest[d - 1] if d else None, "first": first == 0, "last": last == self.n - 1, "words": words,
                })
            for nth, i in enumerate(range(begin, end, IDS)):
                ends.append({"kind": ENDS, "part": part, "digest": digest[top], "nth": nth, "ids": ",".join(map(str, self.ids[i:min(end, i + IDS)]))})
        for some in (held, ends):
            for i in range(0, len(some), ROWS):
                yield batch_of(some[i:i + ROWS])

    def closed(self, part: int, spines: dict[bool, list[bytes]]) -> Iterator[pa.RecordBatch]:
        conv, at, top, depth, n, children, leaves, saved, begin, end = np.array(self.segments, np.int64).T
        parent = np.array([-1 if isinstance(p, tuple) else p for p in self.above], np.int64)
        up = np.array([spines[p[0]][p[1]] if isinstance(p, tuple) else None for p in self.above], object)
        stop = np.cumsum(top - depth)
        for a in range(0, int(stop[-1]), ROWS):
            row = np.arange(a, min(a + ROWS, int(stop[-1])))
            s = np.searchsorted(stop, row, "right")
            d = depth[s] + stop[s] - row
            highest, lowest = d == depth[s] + 1, d == top[s]
            made = np.full(len(row), NOTHING, object)
            made[lowest] = [hashlib.sha256(",".join(map(str, self.ids[b:e])).encode()).hexdigest() for b, e in zip(begin[s[lowest]], end[s[lowest]])]
            open_parent = highest & np.array([x is not None for x in up[s]], bool)
            yield batch_of({
                "kind": [CLOSED] * len(row), "part": np.full(len(row), part), "conv_id": conv[s], "depth": d,
                "parent_conv_id": pa.array(np.where(highest, parent[s], conv[s]), mask=open_parent),
                "n_convs": n[s], "n_children": np.where(lowest, children[s], 1), "n_leaves": leaves[s],
                "saved_tokens": saved[s] + (n[s] - 1) * (self.sums[at[s] + top[s]] - self.sums[at[s] + d - 1]),
                "ends_sha256": made.tolist(), "up": pa.array(np.where(highest, up[s], None).tolist(), pa.binary()),
            }, len(row))


def batch_of(rows: list[dict] | dict, n: int = 0) -> pa.RecordBatch:
    """Rows, or columns of ``n`` rows, with all other fields null."""
    if isinstance(rows, list):
        return pa.RecordBatch.from_arrays([pa.array([r.get(f) for r in rows], t) for f, t in FIELDS], [f for f, _ in FIELDS])
    return pa.RecordBatch.from_arrays([pa.array(rows[f], t) if f in rows else pa.nulls(n, t) for f, t in FIELDS], [f for f, _ in FIELDS])


def grow_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's closed nodes, spines and members that end on a spine."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held)
    path, words = rows.column("path"), rows.column("words")
    length = pc.binary_length(path).to_numpy().astype(np.int64) // KEY
    keys = np.frombuffer(b"".join(p.as_py() for p in path), np.uint64).reshape(-1, 2)
    forest = Forest(rows.column("conv_id").to_numpy(), length, keys, pc.list_flatten(words).to_numpy().astype(np.int64))
    yield from forest.rows(TaskContext.get().partitionId())


def merge_spines(final: bool) -> Callable[[pa.Table], pa.Table]:
    """Spines of neighbouring forests made one; all nodes are closed in the last round."""

    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(["part", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "digest", "up", "first", "last", "words"]).to_pylist(), key=lambda r: r["part"])
        left, right, group = rows[0]["part"], rows[-1]["part"], rows[0]["part"] // FAN
        nodes: dict[bytes, dict] = {}
        for r in rows:
            first, last = r["first"] and r["part"] == left, r["last"] and r["part"] == right
            node = nodes.get(r["digest"])
            if node is None:
                nodes[r["digest"]] = r | {"first": first, "last": last, "part": group}
                continue
            node["conv_id"] = min(node["conv_id"], r["conv_id"])
            node["first"], node["last"] = node["first"] or first, node["last"] or last
            for f in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                node[f] += r[f]
        for node in sorted(nodes.values(), key=lambda r: -r["depth"]):
            if not final and (node["first"] or node["last"]):
                node["kind"] = SPINE
                continue
            node["kind"] = CLOSED
            node["n_leaves"] = node["n_leaves"] if node["n_children"] else 1
            node["saved_tokens"] += (node["n_convs"] - 1) * node["words"]
            if node["up"] is not None:
                above = nodes[node["up"]]
                above["n_children"] += 1
                above["n_leaves"] += node["n_leaves"]
                above["saved_tokens"] += node["saved_tokens"]
        return pa.Table.from_batches([batch_of(list(nodes.values()))])

    return merge


def hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each open node's members, from its strings in order."""
    current, h = None, None

    def done(digests: list, made: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(made, pa.string())], ["digest", "ends_sha256"])

    for batch in batches:
        digests, made = [], []
        for digest, ids in zip(batch.column("digest"), batch.column("ids")):
            digest, ids = digest.as_py(), ids.as_py().encode()
            if digest == current:
                h.update(b"," + ids)
                continue
            if current is not None:
                digests.append(current)
                made.append(h.hexdigest())
            current, h = digest, hashlib.sha256(ids)
        yield done(digests, made)
    if current is not None:
        yield done([current], [h.hexdigest()])


def trie(paths: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """The nodes of the trie of ``paths`` (conv_id, path, words; one row a conversation)."""
    spark = paths.sparkSession
    ship_package(spark)
    paths = materialize(paths, "trie-paths")
    turns = paths.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    n = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), turns // 8192), turns // part_turns)
    ordered = paths.repartitionByRange(n, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    forest = materialize(ordered.mapInArrow(grow_forest, SCHEMA), "trie-forest")

    spines = forest.where(F.col("kind") == SPINE)
    width = (spines.agg(F.max("part")).first()[0] or 0) + 1
    left, merged = spines, []
    while True:
        final = width <= FAN
        done = materialize(left.groupBy(F.floor(F.col("part") / FAN)).applyInArrow(merge_spines(final), SCHEMA), "trie-spines")
        merged.append(done.where(F.col("kind") == CLOSED))
        if final:
            break
        left, width = done.where(F.col("kind") == SPINE), -(-width // FAN)
    shared = merged[0]
    for m in merged[1:]:
        shared = shared.unionByName(m)

    ends = forest.where(F.col("kind") == ENDS).select("digest", "part", "nth", "ids")
    ends = ends.repartition(n, "digest").sortWithinPartitions("digest", "part", "nth").mapInArrow(hash_ends, "digest binary, ends_sha256 string")
    owner = shared.select(F.col("digest").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    plain = [c for c in NODE if c not in ("parent_conv_id", "ends_sha256")]
    branch = shared.select("digest", "up", *plain).join(ends, "digest", "left").join(owner, "up", "left")
    branch = branch.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))).select(NODE)

    closed = forest.where(F.col("kind") == CLOSED)
    # a child of an open node looks its parent up among its own partition's spines
    here = spines.select("part", F.col("digest").alias("up")).join(owner, "up")
    below = closed.where(F.col("up").isNotNull()).drop("parent_conv_id").join(here, ["part", "up"]).select(NODE)
    return branch.unionByName(below).unionByName(closed.where(F.col("up").isNull()).select(NODE))


def prefix_trie(conversations: DataFrame, heads: Callable[[Column], Column] | None = taken_over, part_turns: int = PART_TURNS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256): the trie's nodes, each named by its smallest member and its depth."""
    return trie(conversation_paths(conversations, heads), part_turns)
