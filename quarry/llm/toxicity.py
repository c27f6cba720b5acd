"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; everything else is unlabelled and may hold
toxic text.  With the class prior p of toxic text among all text, the risk of calling
unlabelled text negative is corrected by the part that is due to its hidden positives,
R_u(-) - p R_p(-), and that difference is not let below zero (Kiryo et al. 2017):
R = p R_p(+) + max(0, R_u(-) - p R_p(-)).

Features are byte 5-grams of the lower-cased words (with the blanks around them) and
whole words, present or not.  A few thousand of them, those most enriched in the
positives, enter a logistic model trained in NumPy on a bounded sample
(``max_positive`` and ``max_unlabelled`` documents, chosen by a hash of the id); scoring
covers every document in one map without a shuffle.

Defined cases
* null and empty texts have no features and get the model's base score.
* null doc_id: never in the training sample; scored as any other row.
* repeated doc_id: at most one of its texts, that of the smallest hash, enters the sample.
* repeated labels of one document: toxic if any says so; repeated documents are scored
  row by row.
* no confirmed toxic example: nothing to learn, every score is the prior.
* empty documents: no rows.  Extra columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.words import LOWER, Words, blocks, distinct, mix, separators
from quarry.session import ship_package

GRAM = 5
FEATURES = 4000
MAX_POSITIVE = 3000
MAX_UNLABELLED = 9000
PRIOR = 0.1  # only where no negative label allows an estimate
MAX_SAMPLE_BYTES = 20_000  # longest text that may enter the training sample

# Word characters: 0-9, A-Z, a-z (lower-cased) and every byte of a non-ASCII character.
SEP = separators(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit feature key) of every word and 5-gram, repeats included."""
    words = Words([t.translate(LOWER) for t in texts], SEP)
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    doc = np.searchsorted(words.first, np.arange(n), "right") - 1
    raw = np.where(SEP[words.bytes], np.uint8(32), words.bytes).astype(np.uint64)
    m = len(raw) - GRAM + 1
    gram = np.zeros(max(m, 0), np.uint64)
    for j in range(GRAM):
        gram = (gram << np.uint64(8)) | raw[j:j + len(gram)]
    # from the blank before a word to the blank behind it
    count = np.maximum(1, words.end - words.start + 2 - GRAM + 1)
    at = np.repeat(words.start - 1, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    inside = at < len(gram)
    grams = mix(gram[at[inside]] ^ np.uint64(0x5851F42D4C957F2D))
    return np.concatenate([doc, np.repeat(doc, count)[inside]]), np.concatenate([words.keys(), grams])


class Chosen:
    """A set of feature keys with a column each.  A bitmap of the low key bits turns most
    keys away before the binary search."""

    LOW = np.uint64((1 << 20) - 1)

    def __init__(self, keys: np.ndarray):
        self.keys = distinct(keys)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.keys & self.LOW).astype(np.int64)] = True

    def presence(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text number, column) pairs."""
        doc, key = features(texts)
        some = np.flatnonzero(self.maybe[(key & self.LOW).astype(np.int64)])
        doc, key = doc[some], key[some]
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == key if len(self.keys) else np.zeros(0, bool)
        both = distinct(doc[hit] * (1 << 32) + at[hit])
        return both >> 32, both & 0xFFFFFFFF


@dataclass
class Model:
    chosen: Chosen
    weight: np.ndarray
    bias: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        doc, col = self.chosen.presence(texts)
        z = self.bias + np.bincount(doc, self.weight[col], len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def select(positive: list[bytes], unlabelled: list[bytes], k: int) -> Chosen:
    """The k features whose share among positives exceeds that among all the most, of
    those found in at least three positives."""
    per_text = []
    for _, run in blocks_of(positive):
        doc, key = features(run)
        order = np.lexsort((key, doc))
        doc, key = doc[order], key[order]
        new = np.ones(len(key), bool)
        new[1:] = (np.diff(doc) != 0) | (key[1:] != key[:-1])
        per_text.append(key[new])
    keys, p = np.unique(np.concatenate(per_text), return_counts=True)
    candidates = Chosen(keys[p >= 3])
    p = p[p >= 3]
    u = np.zeros(len(candidates.keys))
    for _, run in blocks_of(unlabelled):
        u += np.bincount(candidates.presence(run)[1], minlength=len(u))
    rp, ru = p / len(positive), (u + 0.5) / max(1, len(unlabelled))
    gain = np.where(rp > 2 * ru, rp * np.log(rp / ru), 0)
    best = np.argsort(-gain, kind="stable")[:k]
    return Chosen(candidates.keys[best[gain[best] > 0]])


def blocks_of(texts: list[bytes], limit: int = 2 << 20) -> Iterator[tuple[int, list[bytes]]]:
    run, size, first = [], 0, 0
    for i, t in enumerate(texts):
        if run and size + len(t) > limit:
            yield first, run
            run, size, first = [], 0, i
        run.append(t)
        size += len(t)
    if run:
        yield first, run


def train(positive: list[bytes], unlabelled: list[bytes], prior: float, k: int = FEATURES, rounds: int = 400, rate: float = 0.05, decay: float = 1e-4) -> Model:
    """Minimise the non-negative risk with the sigmoid loss's smooth relative, the logistic
    loss, by full-batch Adam.  Where the corrected negative risk falls below zero the step
    goes against it, as the estimator asks."""
    if not positive:
        return Model(Chosen(np.zeros(0, np.uint64)), np.zeros(0), float(np.log(prior / (1 - prior))))
    chosen = select(positive, unlabelled, k)
    d = len(chosen.keys)

    def matrix(texts):
        rows, cols = [], []
        for first, run in blocks_of(texts):
            r, c = chosen.presence(run)
            rows.append(r + first)
            cols.append(c)
        return np.concatenate(rows), np.concatenate(cols), len(texts)

    p, u = matrix(positive), matrix(unlabelled) if unlabelled else (np.zeros(0, int), np.zeros(0, int), 1)
    w = np.zeros(d + 1)
    m, v = np.zeros(d + 1), np.zeros(d + 1)

    def margin(x):
        return w[d] + np.bincount(x[0], w[x[1]], x[2])

    def gradient(x, g):  # g: derivative of the mean loss by each row's margin
        return np.concatenate([np.bincount(x[1], g[x[0]], d), [g.sum()]])

    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for t in range(1, rounds + 1):
        zp, zu = margin(p), margin(u)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        pull = gradient(p, -(1 - sigmoid(zp)) / p[2]) * prior
        push = gradient(u, sigmoid(zu) / u[2]) - prior * gradient(p, sigmoid(zp) / p[2])
        g = (pull + push if negative >= 0 else -push) + decay * np.append(w[:d], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Model(chosen, w[:d], float(w[d]))


def training_sample(docs: DataFrame, labels: DataFrame, may_learn: Column, max_positive: int, max_unlabelled: int) -> tuple[list[bytes], list[bytes], float | None]:
    """Texts of confirmed toxic documents and of any documents, and the share of toxic
    documents among the labelled ones, from rows for which ``may_learn`` (over doc_id)."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(may_learn)
    seen = marks.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("p")).first()
    prior = None if not seen.n or seen.p in (0, seen.n) else float(seen.p) / seen.n
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(F.col("doc_id").isNotNull() & may_learn & F.col("text").isNotNull())
    fit = rows.where(F.octet_length("text") <= MAX_SAMPLE_BYTES)
    draw = F.xxhash64(F.col("doc_id"), F.lit("draw"))

    def texts(ids: DataFrame, most: int) -> list[bytes]:
        drawn = ids.select("doc_id").distinct().orderBy(draw, "doc_id").limit(most)  # ids alone meet on the driver
        rows = fit.join(drawn, "doc_id", "left_semi")
        one = rows.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
        return [r.text.encode("utf-8", "surrogatepass") for r in one.orderBy(draw, "doc_id").toLocalIterator()]

    positive = texts(fit.select("doc_id").join(marks.where("toxic = 1"), "doc_id", "left_semi"), max_positive)
    return positive, texts(fit, max_unlabelled), prior


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, prior: float | None = None) -> Model:
    positive, unlabelled, seen = training_sample(docs, labels, may_learn, max_positive, max_unlabelled)
    return train(positive, unlabelled, prior or seen or PRIOR)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(row, score): every row of ``docs`` as a struct, and its toxicity from 0 to 1."""
    spark = docs.sparkSession
    ship_package(spark)
    held = spark.sparkContext.broadcast(model)
    frame = docs.select(F.struct(*(docs[c].cast("string").alias(c) if c == "text" else docs[c] for c in docs.columns)).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("row").field("text")
            out = [held.value.score(texts) for _, texts in blocks(t.as_py() for t in column)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(np.concatenate(out) if out else [], pa.float64())], ["row", "score"])

    return frame.mapInArrow(run, T.StructType([frame.schema["row"], T.StructField("score", T.DoubleType())]))


def held_out(doc_id: Column, parts: int) -> Column:
    """crc32(doc_id as text) mod ``parts`` is 0; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == 0, F.lit(False))
