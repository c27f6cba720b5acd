"""Delimited text sources and sinks (TSV / CSV with header and quoting)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.session import materialize


def write_tsv(df: DataFrame, path: str, header: bool = True) -> None:
    """Tab-separated with a header line; fields holding a tab, quote or newline are
    quoted and inner quotes doubled (RFC-4180 style)."""
    (df.write.mode("error").option("sep", "\t").option("header", header)
       .option("quote", '"').option("escape", '"').option("quoteAll", False).csv(path))


def read_tsv(spark: SparkSession, path: str, schema: StructType | str | None = None, quoted_newlines: bool = False, header: bool = True) -> DataFrame:
    """Reader matching ``write_tsv``: doubled quotes are un-doubled.  Pass ``schema`` on
    production paths; without it every column is a string.  ``quoted_newlines`` lets
    quoted fields span lines, which makes a file one task: only where they occur.
    ``header=False`` reads header-less files (columns by position in ``schema``)."""
    reader = (spark.read.option("sep", "\t").option("header", header)
              .option("quote", '"').option("escape", '"').option("multiLine", quoted_newlines))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Header + type inference (an extra pass over the input)."""
    return spark.read.csv(path, header=True, inferSchema=True)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("error").option("header", True).csv(path)


def read_lines_indexed(spark: SparkSession, path: str, skip: str | None = None) -> DataFrame:
    """(file, line, index, value): every line of text files with its number in the file and
    over all files, in the order of file names, both from 0.

    A line's place in its split is known to the task that reads it; the numbers of lines in
    the splits before it come from a prefix sum over one row for each split.  No task reads
    more than its splits.  Lines that equal ``skip`` (a repeated header) are left out
    before they are numbered."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    lines = lines.where(~F.col("value").eqNullSafe(F.lit(skip))) if skip is not None else lines
    stored = materialize(lines.withColumn("id", F.monotonically_increasing_id()), "lines")
    splits = stored.groupBy("file", "start").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    in_file = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    files = splits.groupBy("file").agg(F.sum("n").alias("n"))
    before = files.select("file", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("files_before"))
    offsets = splits.select("file", "start", "first", F.coalesce(F.sum("n").over(in_file), F.lit(0)).alias("before")).join(before, "file")
    line = F.col("id") - F.col("first") + F.col("before")
    return stored.join(offsets, ["file", "start"]).select("file", line.alias("line"), (line + F.col("files_before")).alias("index"), "value")


def read_lines_split(spark: SparkSession, path: str, sep: str = "\t", index: bool = False) -> DataFrame:
    """Line scan without quote handling: every line equal to the first one (the header) is
    dropped, each remaining line split on ``sep``.  (line, fields array<string>), with ``index``
    also its number among the remaining lines, from 0."""
    lines = spark.read.text(path)
    if index:
        first = lines.first()
        numbered = read_lines_indexed(spark, path, first.value if first else None)
        return numbered.select("index", F.col("value").alias("line"), F.split("value", sep).alias("fields"))
    header = lines.limit(1).select(F.col("value").alias("h"))
    body = lines.join(header, lines["value"] == header["h"], "left_anti")
    return body.select(F.col("value").alias("line"), F.split("value", sep).alias("fields"))
