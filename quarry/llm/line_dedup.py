"""Line deduplication [DataFrame functions only].

Line hashes are range-partitioned with a secondary sort by document and position; a
streaming window keeps the first occurrences of each hash, from which the documents
that may keep the line follow.  The result is a packed keep bitmap per document, not
text; ``apply_keep`` turns documents and bitmaps into kept text.

Defined cases
* null or empty text: one empty line, nothing dropped.
* null ``doc_id``: such rows count as one document that is smaller than every other.
* repeated ``doc_id``: rows with the same id are one document when documents are
  counted; each row is judged, and answered, on its own text.
* a line repeated inside its keeping document stays every time.
* empty table: no rows.  Extra columns are ignored here and kept by ``apply_keep``,
  whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import materialize

WHITE = " \t\n\x0b\f\r"  # [\x20\x09-\x0D]
MIN_CHARS = 20
MIN_DOCS = 3
SALTS = 32  # parts into which every hash is dealt by document, so a hot line is many groups


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def lower_ascii(s: Column) -> Column:
    """A-Z to a-z and nothing else.  ``lower`` does just that, fast, unless the string
    holds another letter that has a lower case."""
    other = s.rlike(r"[\p{IsUppercase}\p{IsTitlecase}&&[^A-Z]]")
    return F.when(other, F.translate(s, string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.lower(s))


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(WHITE)))


def occurrences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(hash, doc_id, rid, pos) of every line whose key is long enough.

    ``rid`` is a hash of the text: with ``doc_id`` it names the row, and rows that agree
    in both also agree in the answer."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("rid"), F.posexplode(text_lines(F.col("text"))).alias("pos", "line"))
    keyed = lines.select("doc_id", "rid", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.char_length("key") >= min_chars).select(F.unhex(F.md5("key")).alias("hash"), "doc_id", "rid", "pos")


def salt_of(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(SALTS))


def keepers(occ: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(hash, salt, keeper): hashes found in at least ``min_docs`` documents, with every
    salt they occur under, and the largest document that holds each.

    Every (hash, salt) is one run of a range partition sorted by document and position.
    A document has one salt, so each run streams its first ``min_docs`` documents and the
    runs of a hash add up: at most salts x min_docs rows per hash leave this step, a hot
    line included."""
    salted = occ.select("hash", salt_of(F.col("doc_id")).alias("salt"), "doc_id", "pos")
    order = [F.col("doc_id").desc_nulls_last(), F.col("pos").asc()]
    ranged = salted.repartitionByRange("hash", "salt").sortWithinPartitions("hash", "salt", *order)
    run = Window.partitionBy("hash", "salt").orderBy(*order)
    doc_run = Window.partitionBy("hash", "salt").orderBy(F.col("doc_id").desc_nulls_last())
    streamed = ranged.withColumn("nth", F.dense_rank().over(doc_run)).withColumn("before", F.lag("nth", 1, 0).over(run))
    firsts = streamed.where((F.col("nth") <= min_docs) & (F.col("before") != F.col("nth")))
    merged = firsts.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"), F.collect_set("salt").alias("salts"))
    return merged.where(F.col("n") >= min_docs).select("hash", F.explode("salts").alias("salt"), "keeper")


def pack(bits: Column) -> Column:
    """A string of 0 and 1 (a multiple of 8 long) as binary."""
    nibbles = F.transform(F.regexp_extract_all(bits, F.lit("(.{4})"), F.lit(1)), lambda x: F.conv(x, 2, 16))
    return F.unhex(F.array_join(nibbles, ""))


def unpack(bitmap: Column) -> Column:
    """Binary as an array of booleans, in order."""
    def nibble(c):
        v = F.conv(c, 16, 10).cast("int")
        return F.array(*(v.bitwiseAND(b) > 0 for b in (8, 4, 2, 1)))

    return F.flatten(F.transform(F.split(F.hex(bitmap), "(?!$)"), nibble))


def keep_bits(dropped: Column, n_lines: Column) -> Column:
    """Bitmap (1 keeps) of ``n_lines`` lines without the sorted positions ``dropped``:
    one piece per dropped line, so the work follows the positions, not their product."""
    before = F.concat(F.array(F.lit(-1)), dropped)
    gaps = F.zip_with(dropped, F.slice(before, 1, F.size(dropped)), lambda p, q: F.concat(F.repeat(F.lit("1"), p - q - 1), F.lit("0")))
    tail = F.repeat(F.lit("1"), n_lines - 1 - F.element_at(dropped, -1))
    whole = (F.ceil(n_lines / 8) * 8).cast("int")
    return pack(F.rpad(F.concat(F.array_join(gaps, ""), tail), whole, "0"))


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, rid, n_dropped, dropped) per document that loses lines; ``dropped`` are the
    sorted positions, ``keep_bits`` packs them."""
    occ = materialize(occurrences(docs, min_chars), "lines")
    salted = occ.withColumn("salt", salt_of(F.col("doc_id")))  # a hot line meets its keeper in many tasks
    lost = salted.join(keepers(occ, min_docs), ["hash", "salt"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    per_doc = lost.groupBy("doc_id", "rid").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
    return per_doc.select("doc_id", "rid", F.size("dropped").cast("long").alias("n_dropped"), "dropped")


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, rid, n_lines, n_dropped, keep) of every document that loses lines."""
    sizes = docs.select("doc_id", F.xxhash64("text").alias("rid"), F.size(text_lines(F.col("text"))).alias("n_lines")).distinct()
    hits = line_dedup(docs, min_chars, min_docs)
    j = sizes.join(hits.toDF("d", "r", "n_dropped", "dropped"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("rid") == F.col("r")))
    return j.select("doc_id", "rid", F.col("n_lines").cast("long").alias("n_lines"), "n_dropped", keep_bits(F.col("dropped"), F.col("n_lines")).alias("keep"))


def apply_keep(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with all its columns in ``row``, and (n_lines, n_dropped, kept) beside it."""
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("rid"))
    b = bitmaps.select(F.col("doc_id").alias("d"), F.col("rid").alias("r"), "n_dropped", "keep")
    j = rows.join(b, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("rid") == F.col("r")), "left")
    text = F.coalesce(F.col("row.text"), F.lit(""))
    lines = text_lines(F.col("row.text"))
    flags = F.arrays_zip(lines.alias("l"), F.slice(unpack(F.col("keep")), F.lit(1), F.size(lines)).alias("k"))
    kept = F.array_join(F.transform(F.filter(flags, lambda x: x["k"]), lambda x: x["l"]), "\n")
    return j.select(
        "row", F.size(lines).cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        F.when(F.col("keep").isNull(), text).otherwise(kept).alias("kept"),
    )
