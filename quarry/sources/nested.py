"""Nested JSON: files listed and read whole, every leaf a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import materialize


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(file, size, modified) of all files below ``path`` whose name fits ``glob``.  Contents
    are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return found.select(F.col("path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def read_whole_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(file, value): every file below ``path`` as one row, line breaks and all."""
    found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path, wholetext=True)
    return found.select(F.col("_metadata.file_path").alias("file"), "value")


def json_leaves(frame: DataFrame, col: str, keys: list[str]) -> DataFrame:
    """(keys..., path, kind, value): every leaf of a column of JSON texts.

    ``path`` is like $.a[0].b; a key that is no plain name is quoted: $["a key"].  ``kind`` is
    the type (STRING, BIGINT, DOUBLE, DECIMAL, BOOLEAN, VOID for null), EMPTY for objects and
    arrays without elements, MALFORMED for a text that is no JSON (value: the text).  Null
    texts give no rows.  One level of nesting is opened at a time, all rows at once, for as long
    as any row has objects or arrays left; the levels are stored, so no depth is parsed twice."""
    spark = frame.sparkSession
    rows = frame.where(F.col(col).isNotNull()).select(*keys, F.lit("$").alias("path"), F.try_parse_json(col).alias("v"), F.col(col).alias("text"))
    bad = rows.where(F.col("v").isNull()).select(*keys, "path", F.lit("MALFORMED").alias("kind"), F.col("text").alias("value"))
    out = materialize(bad, "json-leaves")
    level = rows.where(F.col("v").isNotNull()).drop("text")
    while True:
        typed = materialize(level.withColumn("kind", F.regexp_extract(F.schema_of_variant("v"), "^([A-Z]+)", 1)), "json-level")
        leaf = typed.where(~F.col("kind").isin("OBJECT", "ARRAY"))
        out = out.unionByName(leaf.select(*keys, "path", "kind", F.variant_get("v", "$", "string").alias("value")))
        holds = typed.where(F.col("kind").isin("OBJECT", "ARRAY"))
        if holds.isEmpty():
            return out
        opened = spark.sql("SELECT h.* EXCEPT (v, kind), t.pos, t.key, t.value AS v FROM {holds} h, LATERAL variant_explode_outer(h.v) t", holds=holds)
        empty = opened.where(F.col("pos").isNull()).select(*keys, "path", F.lit("EMPTY").alias("kind"), F.lit(None).cast("string").alias("value"))
        out = out.unionByName(empty)
        plain = F.col("key").rlike("^[A-Za-z_][A-Za-z0-9_]*$")
        named = F.when(plain, F.concat(F.lit("."), F.col("key"))).otherwise(F.concat(F.lit("["), F.to_json(F.array("key")).substr(F.lit(2), F.length(F.to_json(F.array("key"))) - 2), F.lit("]")))
        step = F.when(F.col("key").isNull(), F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]"))).otherwise(named)
        level = opened.where(F.col("pos").isNotNull()).select(*keys, F.concat("path", step).alias("path"), "v")

