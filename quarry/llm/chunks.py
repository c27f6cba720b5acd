"""Texts in chunks, and questions that chunks ask about keys of the whole corpus.

A chunk is a few MB of documents as one compressed row.  The chunk table is stored once,
bucketed by chunk, so each later pass reads it in place: only keys and answers move.

Keys of a chunk (64-bit hashes of windows or n-grams) are dealt by value to slabs.  A slab's
keys meet in one task, whose size is set by the slab count; an answer is aligned with the
keys a chunk sent, which the chunk can list again, so answers carry no keys.  A key that is
hot occurs once per chunk.

Both the chunks and the slabs grow with the corpus, so a chunk does not send a row to every
slab: it sends one to each of at most ``REGIONS`` regions, ranges of slabs.  Where a region
is more than one slab, a relay task takes a region's keys of one pack of ``REGIONS`` chunks,
about as many as a chunk has, and sends them on, a row for each slab; answers go back the
same way.  A chunk's share of rows is then REGIONS + slabs / REGIONS at most, each way."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize_bucketed, ship_package

CHUNK_BYTES = 4 << 20
REGIONS = 1 << 14         # rows a chunk sends at most
BITS, DIFFERENCES = 0x20, 0x10  # forms of packed integers


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers, compressed: bits where all are 0 or 1, else byte plane by byte
    plane, as differences where they increase."""
    values = np.ascontiguousarray(values, np.uint64)
    if not len(values) or values.max() <= 1:
        return bytes([BITS]) + zstandard.ZstdCompressor(level=1).compress(np.packbits(values.astype(np.uint8)).tobytes())
    form = DIFFERENCES if (values[1:] >= values[:-1]).all() else 0
    if form:
        values = np.diff(values, prepend=np.uint64(0))
    planes = values.view(np.uint8).reshape(-1, 8).T
    used = int(np.flatnonzero(planes.any(axis=1)).max(initial=-1)) + 1
    return bytes([form | used]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes[:used]).tobytes())


def unpack(blob: bytes, n: int) -> np.ndarray:
    form, raw = blob[0], np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), np.uint8)
    if form == BITS:
        return np.unpackbits(raw, count=n).astype(np.uint64)
    used = form & ~DIFFERENCES
    out = np.zeros((8, n), np.uint8)
    out[:used] = raw.reshape(used, n)
    values = np.ascontiguousarray(out.T).view(np.uint64).reshape(-1)
    return np.cumsum(values, dtype=np.uint64) if form & DIFFERENCES else values


def slab_of(keys: np.ndarray, slabs: int) -> np.ndarray:
    """Slab by the leading 32 bits: increasing in the key, equal shares of the key space."""
    return ((keys >> np.uint64(32)) * np.uint64(slabs)) >> np.uint64(32)


def runs(sorted_values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, begin, end) of the runs of equal values."""
    n = len(sorted_values)
    cuts = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]])) if n else np.zeros(0, int)
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), n]):
        yield int(sorted_values[a]), a, b


def encode(columns: dict[str, pa.Array]) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_pydict(columns)
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def decode(payload: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(payload).read_next_batch()


def chunk_table(docs: DataFrame, columns: list, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, payload, size): the ``columns`` (the last is the text) of all rows, packed
    row after row into chunks of at most ``chunk_bytes`` of text, a longer text alone; null
    is kept as null.  ``size`` is the bytes of text, and one for each row.

    The chunk number names the partition and the place in it; the table is stored before
    anyone reads the number, so a task that runs again changes nothing.  There is a bucket for
    each chunk up to the session's bound on buckets; beyond it a task reads several chunks,
    one after the other."""
    spark = docs.sparkSession
    ship_package(spark)
    frame = docs.select(*columns)
    names = frame.columns
    size = docs.agg(F.coalesce(F.sum(F.octet_length(columns[-1])), F.lit(0))).first()[0]
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    buckets = min(most, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // chunk_bytes)))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0
        parts, held = [], 0

        def close():
            nonlocal number
            table = pa.Table.from_batches(parts).combine_chunks()
            payload = encode({n: table.column(n).combine_chunks() for n in names})
            number += 1
            return pa.RecordBatch.from_pydict({"chunk": [base | (number - 1)], "payload": [payload], "size": pa.array([held], pa.int64())})

        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(names[-1])), 0).to_pylist()
            begin = 0
            for i, n in enumerate(sizes):
                if held and held + n > chunk_bytes:
                    parts.append(batch.slice(begin, i - begin))
                    yield close()
                    parts, held, begin = [], 0, i
                held += n + 1
            parts.append(batch.slice(begin))
        if held:
            yield close()

    rows = frame.mapInArrow(fill, "chunk long, payload binary, size long")
    return materialize_bucketed(rows, "chunks", "chunk", buckets)


ARROW = {"place": pa.int64(), "source": pa.int64(), "n": pa.int64(), "side": pa.binary(), "sums": pa.list_(pa.int64())}


def ask(chunks: DataFrame, question: Callable, reply: Callable, slabs: int, sent: int, returned: int, regions: int = REGIONS) -> DataFrame:
    """(chunk, answers): what ``reply`` says to each chunk; ``answered`` reads it.

    question(row) takes one row of ``chunks`` (a dict) and yields parts (slab of each key, in
    order; ``sent`` arrays aligned with it), the slabs rising from part to part.
    reply(slab, arrays) gets a slab's keys of all chunks, one chunk after the other, and
    returns (``returned`` arrays aligned with them, numbers), whose sums over all slabs are
    the sums of ``answers.sums``.

    Rows on the way are (place, source, n, side, values): n keys of a source, a chunk or a
    pack, at a place, a region or a slab; ``side`` tells the slab of each key on the way from
    chunk to relay, and its chunk from there to the slab and back."""
    fan = -(-slabs // regions)
    out_names, back_names = [f"v{i}" for i in range(sent)], [f"v{i}" for i in range(returned)]
    schema = lambda names: "place long, source long, n long, side binary" + "".join(f", {v} binary" for v in names)

    def batch_of(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
        columns = ["place", "source", "n", "side", *names]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], ARROW.get(c, pa.binary())) for i, c in enumerate(columns)], columns)

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                for slab, arrays in question(row):
                    rows = []
                    for region, a, b in runs(slab // np.uint64(fan)):
                        side = pack(slab[a:b]) if fan > 1 else None
                        rows.append((region, row["chunk"], b - a, side, *(pack(x[a:b]) for x in arrays)))
                    yield batch_of(rows, out_names)

    def arrays_of(table: pa.Table, names: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        n = table.column("n").to_numpy()
        return n, [np.concatenate([unpack(v.as_py(), k) for v, k in zip(table.column(c), n)]) for c in names]

    def relay_out(table: pa.Table) -> pa.Table:
        n, (slab, *arrays) = arrays_of(table, ["side", *out_names])
        chunk = np.repeat(table.column("source").to_numpy(), n)
        order = np.lexsort((chunk, slab))
        number = table.column("pack")[0].as_py()
        rows = [(s, number, b - a, pack(chunk[order[a:b]]), *(pack(x[order[a:b]]) for x in arrays)) for s, a, b in runs(slab[order])]
        return pa.Table.from_batches([batch_of(rows, out_names)])

    def answer(table: pa.Table) -> pa.Table:
        n, arrays = arrays_of(table, out_names)
        values, numbers = reply(table.column("place")[0].as_py(), arrays)
        ends = np.cumsum(n)
        cut = [[pack(x[b - k:b]) for b, k in zip(ends, n)] for x in values]
        sums = [list(numbers)] + [[0] * len(numbers)] * (len(n) - 1)
        given = table.select(["place", "source", "n", "side"]).combine_chunks().columns
        return pa.table([*given, *(pa.array(c, pa.binary()) for c in cut), pa.array(sums, ARROW["sums"])], [*list(ARROW)[:4], *back_names, "sums"])

    def relay_back(table: pa.Table) -> pa.Table:
        n, (chunk, *arrays) = arrays_of(table, ["side", *back_names])
        slab = np.repeat(table.column("place").to_numpy(), n)
        order = np.lexsort((slab, chunk))
        region = int(slab[0]) // fan
        rows = [(region, c, b - a, None, *(pack(x[order[a:b]]) for x in arrays)) for c, a, b in runs(chunk[order])]
        numbers = [sum(x) for x in zip(*table.column("sums").to_pylist())]
        sums = [numbers] + [[0] * len(numbers)] * (len(rows) - 1)
        return pa.Table.from_batches([batch_of(rows, back_names)]).append_column("sums", pa.array(sums, ARROW["sums"]))

    asked = chunks.mapInArrow(out, schema(out_names))
    if fan > 1:
        packs = -(-chunks.count() // regions)
        asked = asked.withColumn("pack", F.pmod(F.xxhash64("source"), F.lit(packs)))
        asked = asked.groupBy("place", "pack").applyInArrow(relay_out, schema(out_names))
    said = schema(back_names) + ", sums array<long>"
    replies = asked.groupBy("place").applyInArrow(answer, said)
    if fan > 1:
        replies = replies.withColumn("region", F.floor(F.col("place") / fan)).groupBy("region", "source").applyInArrow(relay_back, said)
    return replies.groupBy(F.col("source").alias("chunk")).agg(F.collect_list(F.struct("place", "n", *back_names, "sums")).alias("answers"))


def answered(answers: list[dict] | None, value: int = 0) -> np.ndarray:
    """A value of the answers to a chunk, aligned with the keys that it sent."""
    found = [unpack(a[f"v{value}"], a["n"]) for a in sorted(answers or [], key=lambda a: a["place"])]
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one at a time, so that one payload is unpacked at a time."""
    for i in range(batch.num_rows):
        yield {n: batch.column(n)[i].as_py() for n in batch.schema.names}
