"""Substring deduplication with a count-min prefilter.

First pass: every chunk of documents sketches its windows of ``window`` words, one list of
non-zero cells for each sketch row.  The sketch is cut into slabs by the leading key bits,
as many as the corpus needs, and each slab merges the chunks' sketches by adding cells; a
merged estimate is never below the true count.  A chunk learns which of its cells are
estimated to be repeated.  Second pass: only windows whose cells are repeated in every row
are grouped exactly, by a 112-bit key, with the smallest document each starts in.  No
repeated window can be lost, and what is sent stays near a byte per window and row.

Defined cases
* null text: no words.  Texts shorter than a window have none and stay whole.
* null doc_id: larger than every id, so such rows lose what any document with an id holds;
  windows that only rows without an id share stay.
* repeated doc_id: no row counts as smaller than another of the same id.
* windows repeated only within one document stay.
* empty table: no rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.chunks import CHUNK_BYTES, REGIONS, answered, ask, chunk_table, decode, rows_of, slab_of
from quarry.llm.words import WHITE, Words, blocks, distinct, mix, multipliers, separators, windows
from quarry.session import materialize

WINDOW = 13
DEPTH = 2                # rows of the sketch
CELL_BITS = 24           # cells of a slab's row: 2^24
SLAB_WINDOWS = 1 << 21   # windows for which a slab is made: an eighth of the cells
SEP = separators(WHITE)
LAST = np.iinfo(np.int64).max  # stands for a null id


class Chunk:
    """Windows of a chunk: keys, the document each starts in, and sketch cells."""

    def __init__(self, payload: bytes, window: int, slabs: int):
        batch = decode(payload)
        self.ids = batch.column(0)
        self.texts = batch.column(batch.num_columns - 1).to_pylist()
        order = pc.fill_null(self.ids, LAST).to_numpy(zero_copy_only=False).astype(np.int64)
        m1, m2 = multipliers(window, 1), multipliers(window, 2)
        key, key2, doc, self.n_words, first, base = [], [], [], [], [], 0
        for at, texts in blocks(self.texts):
            words = Words(texts, SEP)
            k, inside = windows(words.keys(0), words.first, window, m1)
            k2, _ = windows(words.keys(1), words.first, window, m2)
            start = np.flatnonzero(inside)
            key.append(k[start])
            key2.append(k2[start])
            doc.append(order[at + np.searchsorted(words.first, start, "right") - 1])
            first.append(base + start)  # number of the window's first word in the chunk
            self.n_words += list(np.diff(words.first))
            base += len(words)
        join = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        self.key, self.key2, self.doc, self.first = join(key, np.uint64), join(key2, np.uint64), join(doc, np.int64), join(first, np.int64)
        self.window, self.slabs, self.total = window, slabs, base

    def cells(self, row: int) -> np.ndarray:
        """Slab (every sketch row has its own) and cell of each window, as one number."""
        bits = self.key if row == 0 else mix(self.key ^ np.uint64(row * 0x632BE59BD9B4E019 & (1 << 64) - 1))
        slab = slab_of(self.key, self.slabs) + np.uint64(row * self.slabs)
        return slab << np.uint64(32) | bits & np.uint64((1 << CELL_BITS) - 1)

    def sketch(self):
        """(slab, (cell, whether set twice)) of the non-zero cells of this chunk's sketch."""
        for row in range(DEPTH):
            code, count = np.unique(self.cells(row), return_counts=True)
            yield code >> np.uint64(32), (code & np.uint64(0xFFFFFFFF), (count > 1).astype(np.uint64))

    def repeated(self, estimated: np.ndarray) -> np.ndarray:
        """Windows (numbers) whose cells are estimated to be repeated in every row."""
        left, at = np.arange(len(self.key)), 0
        for row in range(DEPTH):
            code = self.cells(row)
            cells = distinct(code)
            flag = estimated[at:at + len(cells)] > 0
            at += len(cells)
            left = left[flag[np.searchsorted(cells, code[left])]]
        return left

    def groups(self, estimated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The estimated repeats, sorted by key: (window, group of each, first of each
        group); the first of a group has its smallest document."""
        w = self.repeated(estimated)
        w = w[np.lexsort((self.doc[w], self.key2[w], self.key[w]))]
        new = np.ones(len(w), bool)
        new[1:] = (self.key[w[1:]] != self.key[w[:-1]]) | (self.key2[w[1:]] != self.key2[w[:-1]])
        return w, np.cumsum(new) - 1, np.flatnonzero(new)

    def exact(self, estimated: np.ndarray):
        """(slab, (key, second key, smallest document)) of the estimated repeats."""
        w, _, first = self.groups(estimated)
        w = w[first]
        yield slab_of(self.key[w], self.slabs), (self.key[w] >> np.uint64(16), self.key2[w], self.doc[w].view(np.uint64))

    def removed(self, estimated: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        """Which words of the chunk are covered by a window that starts in a smaller document."""
        w, group, first = self.groups(estimated)
        gone = earlier > 0
        lost = w[gone[group] | (self.doc[w] > self.doc[w[first]][group])]
        begin = self.first[lost]
        change = np.bincount(begin, minlength=self.total + 1) - np.bincount(begin + self.window, minlength=self.total + 1)
        return np.cumsum(change)[:-1] > 0


def merge_sketches(slab: int, arrays: list[np.ndarray]):
    """Add the chunks' cells; tell which of them hold two or more."""
    at, twice = arrays[0].astype(np.int64), arrays[1]
    cells = np.zeros(1 << CELL_BITS, np.uint8)
    cells[at[twice > 0]] = 2
    order = np.sort(at)
    cells[order[1:][order[1:] == order[:-1]]] = 2
    return [cells[at] >> 1], []


def merge_exact(slab: int, arrays: list[np.ndarray]):
    """Smallest document of every window; tell each chunk which of its windows start in a
    smaller document than any of its own."""
    key, key2, doc = arrays[0], arrays[1], arrays[2].view(np.int64)
    order = np.lexsort((doc, key2, key))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(key[order]) != 0) | (np.diff(key2[order]) != 0)
    smallest = np.empty(len(order), np.int64)
    smallest[order] = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    return [smallest < doc], []


def substring_dedup(docs: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES, slab_windows: int = SLAB_WINDOWS, regions: int = REGIONS) -> DataFrame:
    """(doc_id, n_words, n_removed, removed, kept): per document the words removed, as runs
    [first word, words], and the words kept, joined by one blank.  Ids are integers."""
    chunks = chunk_table(docs, [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")], chunk_bytes)
    size = chunks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    slabs = max(1, -(-size // (slab_windows * 6)))  # some six bytes of text to a word
    here = lambda row: Chunk(row["payload"], window, slabs)

    sketched = ask(chunks, lambda row: here(row).sketch(), merge_sketches, DEPTH * slabs, 2, 1, regions)
    sketched = materialize(sketched.withColumnRenamed("answers", "estimated"), "sketch-answers")
    told = chunks.join(sketched, "chunk", "left")
    exact = ask(told, lambda row: here(row).exact(answered(row["estimated"])), merge_exact, slabs, 3, 1, regions).withColumnRenamed("answers", "earlier")

    def finish(batches):
        for batch in batches:
            for row in rows_of(batch):
                chunk = here(row)
                gone = chunk.removed(answered(row["estimated"]), answered(row["earlier"]))
                n_removed, spans, kept, a = [], [], [], 0
                for text, n in zip(chunk.texts, chunk.n_words):
                    mask = gone[a:a + n]
                    a += n
                    words = (text or "").encode("utf-8", "surrogatepass").split()
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
                    n_removed.append(int(mask.sum()))
                    spans.append([[int(s), int(e - s)] for s, e in zip(edge[::2], edge[1::2])])
                    kept.append(b" ".join(compress(words, ~mask) if n_removed[-1] else words).decode("utf-8", "surrogatepass"))
                yield pa.RecordBatch.from_arrays(
                    [chunk.ids, pa.array(chunk.n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.string())],
                    ["doc_id", "n_words", "n_removed", "removed", "kept"],
                )

    return told.join(exact, "chunk", "left").mapInArrow(finish, "doc_id long, n_words long, n_removed long, removed array<array<long>>, kept string")
