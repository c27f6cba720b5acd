"""A training corpus from raw documents: toxicity, line dedup, near duplicates, benchmark
decontamination, mixing.  Each stage reads all that its predecessor kept, as Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontaminate, line_dedup, mixing, simhash, toxicity
from quarry.llm.queries import MIX_WEIGHTS
from quarry.session import materialize
from quarry.sources.tables import table

ORACLE_SQL = None  # the classifier and the fingerprints have no SQL form; tests compare with brute force

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled rows among them, rejects go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.score(docs, model).where(F.col("score") < 0.5).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents share stay in the last of them; texts that lose none are
    unchanged."""
    applied = line_dedup.apply_keep(docs, line_dedup.keep_bitmaps(docs))
    changed = F.col("n_dropped") > 0
    text = F.when(changed, F.col("kept")).otherwise(F.col("row.text"))
    size = F.when(changed, F.char_length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    new = {"text": text, "n_chars": size}
    return applied.select(*(new.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one with the smallest id."""
    return simhash.keep_first(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark passages go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document with its place in the mixture."""
    mixed = mixing.mix(docs, MIX_WEIGHTS)
    return mixed.select(*(F.col(f"row.{c}") for c in docs.columns), "stream", "block", "slot", "place")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored in the checkpoint folder."""
    docs = table(spark, sf_dir, "documents").select(*DOCUMENTS)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
