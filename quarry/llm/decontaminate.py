"""Benchmark decontamination with suffix arrays over the training text.

Every block of training documents is a shard.  Its suffix array holds, sorted, the
suffixes that can begin a benchmark window at all: the next words must all be benchmark
words and follow each other as they do in some benchmark item, which every occurrence of
a window fulfils, so none is lost.  Every suffix of every benchmark item is looked up by
binary search; each range found gives the places where the item's next window occurs.
Chaining places on one diagonal gives the longest verbatim matches and their locations.

Words are compared by a 64-bit key.  The benchmark is turned into search tables on the
driver in parts of at most ``BENCH_BYTES`` of text; larger benchmarks take several parts,
which one job applies one after the other, so no part of the corpus is read twice.

Defined cases
* null, empty or wordless documents: n_words 0, not contaminated.
* null or wordless benchmark texts: never found.  Null item_id: its windows count as any
  other, its name in the list is ``null``.
* repeated item_id: one item, found if any of its rows is.
* repeated or null doc_id: every row is judged on its own text.
* empty documents: no rows; empty benchmark: nothing is hit.
* very long texts: a text beyond a block's size is one shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.words import LOWER, Words, blocks, separators
from quarry.session import ship_package

WINDOW = 13
BENCH_BYTES = 16 << 20
SHARD_BYTES = 2 << 20  # text of a shard

# Word characters after lower-casing: 0-9, a-z and every byte of a non-ASCII character.
SEP = separators(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))


class Benchmark:
    """Search tables of one part of the benchmark."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.window = window
        texts = [(t or "").encode("utf-8", "surrogatepass").translate(LOWER) for _, t in items]
        words = Words(texts, SEP)
        self.vocab, code = np.unique(words.keys(), return_inverse=True)
        code = code.astype(np.int64) + 1  # 0: no benchmark word
        base = len(self.vocab) + 1
        names, owner = np.unique([n for n, _ in items], return_inverse=True) if items else (np.array([], str), np.array([], int))
        self.names = [str(n) for n in names]
        rows, size, item, at, pair, short = [], [], [], [], [], []
        for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
            n = b - a
            w = min(window, n)
            if n:
                pair.append(code[a:b - 1] * base + code[a + 1:b])
                if w < window:
                    short.append(code[a])
            for p in range(a, b - w + 1) if n else ():
                row = np.zeros(window, ">u4")
                row[:w] = code[p:p + w]
                rows.append(row)
                size.append(w)
                item.append(owner[i])
                at.append(p - a)
        self.pairs = np.unique(np.concatenate(pair)) if pair else np.zeros(0, np.int64)
        self.base = base
        self.short = np.zeros(base, bool)
        self.short[np.array(short, int)] = True
        self.rows = np.array(rows, ">u4").reshape(-1, window)
        self.size, self.item, self.at = (np.array(x, np.int64) for x in (size, item, at))
        high = self.rows.copy()
        high[np.arange(window)[None, :] >= self.size[:, None]] = 0xFFFFFFFF
        self.low, self.high = as_bytes(self.rows), as_bytes(high)

    def codes(self, words: Words) -> np.ndarray:
        """Benchmark word numbers of a shard, with a 0 after every document and at the end."""
        keys = words.keys()
        at = np.searchsorted(self.vocab, keys)
        at[at == len(self.vocab)] = 0
        found = np.where(self.vocab[at] == keys, at + 1, 0) if len(self.vocab) else np.zeros(len(keys), np.int64)
        n = len(keys) + len(words.first) - 1
        out = np.zeros(n + self.window, np.int64)
        out[np.arange(len(keys)) + np.searchsorted(words.first[1:], np.arange(len(keys)), "right")] = found
        return out

    def candidates(self, code: np.ndarray) -> np.ndarray:
        """Positions at which a benchmark window may begin."""
        n = len(code) - self.window
        ok = np.zeros(n, bool)
        both = np.flatnonzero((code[:n] > 0) & (code[1:n + 1] > 0))
        value = code[both] * self.base + code[both + 1]
        at = np.searchsorted(self.pairs, value)
        at[at == len(self.pairs)] = 0
        if len(self.pairs):
            ok[both] = self.pairs[at] == value
        # window - 1 consecutive word pairs of the benchmark
        run = np.cumsum(np.concatenate([[0], ok]))
        full = np.zeros(n, bool)
        m = n - self.window + 2
        if m > 0:
            full[:m] = run[self.window - 1:self.window - 1 + m] - run[:m] == self.window - 1 if self.window > 1 else code[:m] > 0
        return np.flatnonzero(full | self.short[code[:n]])

    def occurrences(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, position) of every occurrence of a benchmark window in the shard, by
        binary search of each benchmark suffix in the shard's suffix array."""
        at = self.candidates(code)
        if not len(at) or not len(self.rows):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        suffix = as_bytes(code[at[:, None] + np.arange(self.window)].astype(">u4"))
        order = np.argsort(suffix, kind="stable")
        array = suffix[order]
        lo, hi = np.searchsorted(array, self.low, "left"), np.searchsorted(array, self.high, "right")
        count = hi - lo
        window = np.repeat(np.arange(len(lo)), count)
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return window, at[order[np.repeat(lo, count) + offset]]


def as_bytes(rows: np.ndarray) -> np.ndarray:
    """Rows of big-endian numbers as byte strings, which sort as the rows do."""
    rows = np.ascontiguousarray(rows, ">u4")
    return rows.view(f"S{4 * rows.shape[1]}").reshape(-1) if len(rows) else np.zeros(0, f"S{4 * max(1, rows.shape[1])}")


class Shard:
    """A block of documents as one sequence of benchmark word numbers."""

    def __init__(self, texts: list[bytes], bench: Benchmark):
        words = Words([t.translate(LOWER) for t in texts], SEP)
        self.first = words.first + np.arange(len(words.first))  # in the sequence with a 0 after each document
        self.n_words = np.diff(words.first)
        self.window, self.place = bench.occurrences(bench.codes(words))
        self.doc = np.searchsorted(self.first, self.place, "right") - 1
        self.bench = bench

    def covered(self) -> np.ndarray:
        """For every position: is it inside an occurrence."""
        change = np.zeros(int(self.first[-1]) + self.bench.window + 1, np.int64)
        np.add.at(change, self.place, 1)
        np.add.at(change, self.place + self.bench.size[self.window], -1)
        return np.cumsum(change) > 0

    def items(self) -> dict[int, list[str]]:
        """Document → names of the items found in it."""
        out: dict[int, list[str]] = {}
        if len(self.doc):
            for d, i in np.unique(np.stack([self.doc, self.bench.item[self.window]]), axis=1).T:
                out.setdefault(int(d), []).append(self.bench.names[i])
        return out

    def matches(self) -> Iterator[tuple[int, str, int, int, int]]:
        """(document, item, word in the item, word in the document, length) of the maximal
        verbatim matches of at least a window."""
        if not len(self.place):
            return
        b = self.bench
        item, at = b.item[self.window], b.at[self.window]
        order = np.lexsort((self.place, self.place - at, item, self.doc))
        doc, item, at, place, size = self.doc[order], item[order], at[order], self.place[order], b.size[self.window][order]
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(place - at) != 0) | (np.diff(place) > 1)
        begin = np.flatnonzero(new)
        end = np.concatenate([begin[1:], [len(order)]]) - 1
        for s, e in zip(begin, end):
            yield int(doc[s]), b.names[item[s]], int(at[s]), int(place[s] - self.first[doc[s]]), int(place[e] - place[s] + size[e])


def parts(bench: DataFrame, window: int, part_bytes: int) -> list[Benchmark]:
    """The benchmark as search tables of at most ``part_bytes`` of text each (or one item)."""
    rows = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    out, now, size = [], [], 0
    for r in rows.toLocalIterator():
        if now and size + len(r.text) > part_bytes:
            out.append(Benchmark(now, window))
            now, size = [], 0
        now.append((r.item_id, r.text))
        size += len(r.text)
    return [*out, Benchmark(now, window)]


def contamination(docs: DataFrame, bench: DataFrame, keep: list[str], window: int = WINDOW, part_bytes: int = BENCH_BYTES) -> DataFrame:
    """(row, n_words, n_hit, items) per document: columns ``keep`` as a struct, word counts
    and the sorted names of the items with occurring windows.  No shuffle: each document
    is judged where it is read."""
    spark = docs.sparkSession
    ship_package(spark)
    tables = parts(bench, window, part_bytes)
    inside = "text" in keep and docs.schema["text"].dataType == T.StringType()  # the text then travels once
    frame = docs.select(F.struct(*(docs[c] for c in keep)).alias("row"), (F.lit(None) if inside else docs["text"]).cast("string").alias("t"))
    frame = frame.withColumns({"n": F.lit(0).cast("long"), "hit": F.lit(None).cast("binary"), "items": F.array().cast("array<string>")})
    final = T.StructType([frame.schema["row"], T.StructField("n", T.LongType()), T.StructField("hit", T.LongType()), frame.schema["items"]])
    for i, table in enumerate(tables):
        held, last = spark.sparkContext.broadcast(table), i == len(tables) - 1

        def judge(batches: Iterator[pa.RecordBatch], held=held, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                earlier, listed = batch.column("hit"), batch.column("items")
                n, hits, items = [], [], []
                column = batch.column("row").field("text") if inside else batch.column("t")
                for first, texts in blocks((t.as_py() for t in column), SHARD_BYTES):
                    shard = Shard(texts, held.value)
                    covered, found = shard.covered(), shard.items()
                    for d, words in enumerate(shard.n_words):
                        bits = covered[shard.first[d]:shard.first[d] + words]
                        before = earlier[first + d].as_py()
                        if before:
                            bits = bits | np.unpackbits(np.frombuffer(before, np.uint8), count=words).astype(bool)
                        n.append(int(words))
                        hits.append(int(bits.sum()) if last else np.packbits(bits).tobytes())
                        items.append(sorted({*listed[first + d].as_py(), *found.get(d, [])}))
                new = {
                    "row": batch.column("row"), "t": batch.column("t"), "n": pa.array(n, pa.int64()),
                    "hit": pa.array(hits, pa.int64() if last else pa.binary()), "items": pa.array(items, pa.list_(pa.string())),
                }
                yield pa.RecordBatch.from_pydict({k: v for k, v in new.items() if k != "t" or not last})

        frame = frame.mapInArrow(judge, final if last else frame.schema)
    return frame.select("row", F.col("n").alias("n_words"), F.col("hit").alias("n_hit"), "items")


def longest_matches(docs: DataFrame, bench: DataFrame, window: int = WINDOW, part_bytes: int = BENCH_BYTES) -> DataFrame:
    """(doc_id, item_id, item_word, doc_word, n_words): every maximal verbatim match of at
    least a window (the whole item, if it is shorter), with its places, counted from 0."""
    spark = docs.sparkSession
    ship_package(spark)
    frame = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    names = ["item_id", "item_word", "doc_word", "n_words"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
    out = None
    for table in parts(bench, window, part_bytes):
        held = spark.sparkContext.broadcast(table)

        def search(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, texts in blocks((t.as_py() for t in batch.column("text")), SHARD_BYTES):
                    rows = list(Shard(texts, held.value).matches())
                    at, *rest = zip(*rows) if rows else [[]] * 5
                    ids = batch.column("doc_id").take(pa.array([first + d for d in at], pa.int64()))
                    yield pa.RecordBatch.from_arrays([ids, *(pa.array(x, k) for x, k in zip(rest, kinds))], ["doc_id", *names])

        kind = dict(frame.dtypes)["doc_id"]
        found = frame.mapInArrow(search, f"doc_id {kind}, item_id string, item_word long, doc_word long, n_words long")
        out = found if out is None else out.unionAll(found)
    return out


def is_contaminated(n_hit: Column, n_words: Column, per: int = 20) -> Column:
    """At least one word hit, and at least one in ``per``."""
    return (n_hit > 0) & (n_hit * per >= n_words)


def clean_documents(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    judged = contamination(docs, bench, docs.columns, window)
    return judged.where(~is_contaminated(F.col("n_hit"), F.col("n_words"))).select("row.*")
