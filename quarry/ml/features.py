"""Feature table, deterministic split and the feature pipeline (pyspark.ml)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN_PERCENT = 80


def hash_split(key: Column, train_percent: int = TRAIN_PERCENT) -> Column:
    """'train' / 'test' from a hash of the row key: stable across recomputation
    and independent of partitioning (unlike a seeded random split)."""
    bucket = F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long"), F.lit(100))
    return F.when(bucket < train_percent, F.lit("train")).otherwise(F.lit("test"))


def threshold_label(c: Column, threshold: float) -> Column:
    return F.when(c > threshold, 1).otherwise(0)


def feature_pipeline(numeric: list[str], categorical: list[str], scale: bool = True) -> Pipeline:
    """index (by frequency) → one-hot (last category dropped) → assemble → scale
    (unit std, no centring).  Unseen categories at transform time get their own index."""
    idx = [f"{c}_idx" for c in categorical]
    oh = [f"{c}_oh" for c in categorical]
    stages = [
        StringIndexer(inputCols=categorical, outputCols=idx, handleInvalid="keep"),
        OneHotEncoder(inputCols=idx, outputCols=oh),
        VectorAssembler(inputCols=numeric + oh, outputCol="raw_features" if scale else "features"),
    ]
    if scale:
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withStd=True, withMean=False))
    return Pipeline(stages=stages)


def source_importances(importances, attrs: list[tuple[int, str]], sources: list[str]) -> list[tuple[str, float]]:
    """Sum vector-slot importances back onto their source columns; ``attrs`` are
    (slot index, slot name) pairs from the assembled vector's metadata."""
    out = {s: 0.0 for s in sources}
    for i, name in attrs:
        src = next((s for s in sorted(sources, key=len, reverse=True) if name == s or name.startswith(s + "_")), name)
        out[src] = out.get(src, 0.0) + float(importances[i])
    return sorted(out.items())


def vector_attrs(df: DataFrame, col: str) -> list[tuple[int, str]]:
    meta = df.schema[col].metadata.get("ml_attr", {}).get("attrs", {})
    return sorted((a["idx"], a["name"]) for group in meta.values() for a in group)
