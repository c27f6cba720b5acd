"""Language-model scores by deleted interpolation.

The model mixes maximum-likelihood estimates of trigram, bigram and unigram and a uniform
floor.  The mixture weights depend on how often the context was seen (buckets by powers of
two of the trigram context's count, or of the bigram context's where the trigram context
is new).  They are learned by expectation-maximisation on deleted counts: each training
text is scored with its own counts taken out of the totals, so every training token is once
in a held-out part, and the weights do not depend on how texts are stored or chunked.

Counting is a question of chunks to key slabs (see ``chunks``): a chunk sends its distinct
n-grams with its training counts and gets the totals back.  For the weights the chunks
return, instead of tokens, counts of (bucket, estimates in eighths of an octave); that table is
stored and stays distributed: each round of the EM brings its sums by bucket to the driver.

Defined cases
* null and empty texts: the end token alone.
* null doc_id: never used for training (its fold is undefined), held_out false; scored.
* repeated doc_id: rows are trained on and scored one by one.
* no training text: all counts zero; the model is the uniform floor.
* buckets in which no training token falls: all weights equal.
* empty table: no rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.chunks import CHUNK_BYTES, REGIONS, answered, ask, chunk_table, decode, rows_of, slab_of
from quarry.llm.words import LOWER, WHITE, Words, blocks, distinct, mix, separators
from quarry.session import materialize, materialize_bucketed, release

ORDER = 3
SLAB_KEYS = 1 << 20       # distinct chunk keys for which a slab is made
SEP = separators(WHITE)
END, START = np.uint64(0xE5D0F00DCAFE0001), np.uint64(0x57A27000BEEF0003)
ADD = 0.1                 # additive constant of the base score
STEPS = 8                 # estimates are kept in 1/STEPS octaves for the weights
STILL = 1e-7              # of a token's log-likelihood, by which a round of EM must gain
OCTAVES = 126             # that are told apart below 1
BUCKETS = 16


def low_bits(order: int, slabs: int) -> int:
    """Key bits that are not sent: none of a word's, and of longer n-grams so many that
    the rest grows with the number of slabs, hence with the corpus (48 bits at 128)."""
    return 0 if order == 0 else max(0, 24 - slabs.bit_length())


class Tokens:
    """Tokens of a chunk: words, each text closed by an end token."""

    def __init__(self, payload: bytes):
        self.batch = decode(payload)
        self.train = self.batch.column(1).to_numpy(zero_copy_only=False)
        keys, lengths = [], []
        for _, texts in blocks(self.batch.column(2).to_pylist()):
            words = Words([t.translate(LOWER) for t in texts], SEP)
            keys.append(np.insert(words.keys(), words.first[1:], END))
            lengths.append(np.diff(words.first) + 1)
        self.length = np.concatenate(lengths).astype(np.int64)
        self.key = np.concatenate(keys)
        self.begin = np.cumsum(self.length) - self.length
        self.trained = np.repeat(self.train, self.length)

    def grams(self):
        """Keys of the 1-, 2- and 3-grams that end in each token, one order after the other;
        starts are padded."""
        yield self.key
        back1 = np.roll(self.key, 1)
        back1[self.begin] = START
        back2 = np.roll(back1, 1)
        back2[self.begin] = START
        two = mix(self.key * np.uint64(0x9FB21C651E98DF25) + mix(back1))
        yield two
        yield mix(two * np.uint64(0xC2B2AE3D27D4EB4F) + mix(back2 ^ np.uint64(0x165667B19E3779F9)))


def question(payload: bytes, slabs: int):
    """(slab, (key, training count)) of the n-grams of a chunk; every order has slabs of
    its own."""
    t = Tokens(payload)
    for order, gram in enumerate(t.grams()):
        low = np.uint64(low_bits(order, slabs))
        gram = gram >> low << low
        keys = distinct(gram)
        seen, count = np.unique(gram[t.trained], return_counts=True)
        counts = np.zeros(len(keys), np.uint64)
        counts[np.searchsorted(keys, seen)] = count
        yield slab_of(keys, slabs) + np.uint64(order * slabs), (keys >> low, counts)


def reply(slab: int, arrays: list[np.ndarray], slabs: int):
    """Totals of a slab's n-grams; and, of the words seen in training, how many distinct ones
    there are, how many in all, and how often the end token is among them."""
    distinct_keys, place = np.unique(arrays[0], return_inverse=True)
    total = np.bincount(place, arrays[1].astype(np.float64), len(distinct_keys)).astype(np.uint64)
    seen = (int((total > 0).sum()), int(total.sum()), int(total[distinct_keys == END].sum())) if slab < slabs else (0, 0, 0)
    return [total[place]], seen


class Counted(Tokens):
    """A chunk's tokens with the corpus counts of their n-grams and contexts."""

    def __init__(self, payload: bytes, totals: np.ndarray, slabs: int, docs: int, tokens: int, deleted: bool):
        super().__init__(payload)
        self.count, at = [], 0
        for order, gram in enumerate(self.grams()):
            low = np.uint64(low_bits(order, slabs))
            gram = gram >> low << low
            keys, place = np.unique(gram, return_inverse=True)
            count = totals[at:at + len(keys)].astype(np.float64)[place]
            at += len(keys)
            if deleted:
                count -= self.own(place, len(keys))
            self.count.append(count)
        less = np.where(self.train, 1, 0) if deleted else np.zeros(len(self.train), np.int64)
        n_docs = docs - less
        self.tokens = tokens - np.repeat(less * self.length, self.length)
        self.context = []  # of the bigram and of the trigram that ends in each token
        for order in range(ORDER - 1):
            c = np.roll(self.count[order], 1)
            c[self.begin] = n_docs
            self.context.append(c)

    def own(self, place: np.ndarray, n: int) -> np.ndarray:
        """How often each token's n-gram (``place`` of ``n``) is in its own text, if that is
        trained on."""
        text = np.repeat(np.arange(len(self.length)), self.length)
        _, which, count = np.unique(text * n + place, return_inverse=True, return_counts=True)
        return count[which] * self.trained

    def estimates(self) -> list[np.ndarray]:
        """Unigram, bigram and trigram likelihood of every token; 0 for a new context."""
        one = self.count[0] / np.maximum(1, self.tokens)
        rest = [np.minimum(1, np.divide(c, x, out=np.zeros(len(c)), where=x > 0)) for c, x in zip(self.count[1:], self.context)]
        return [one, *rest]

    def bucket(self) -> np.ndarray:
        """Bucket of each token's context frequency."""
        two, three = self.context
        octave = lambda x: np.minimum(BUCKETS - 1, np.log2(np.maximum(x, 1)).astype(np.int64))
        return np.where(three > 0, BUCKETS + octave(three), np.where(two > 0, octave(two), 0))


def bits(per_octave: int) -> int:
    """Of a cell, for each estimate."""
    return (OCTAVES * per_octave + 1).bit_length()


def steps(p: np.ndarray) -> np.ndarray:
    """Estimate in steps below 1, from 1; 0 for none."""
    return np.where(p > 0, np.clip(np.round(-STEPS * np.log2(np.where(p > 0, p, 1))), 0, OCTAVES * STEPS).astype(np.int64) + 1, 0)


def shares(cell: np.ndarray, n: np.ndarray, weights: np.ndarray, floor: float, per_octave: int) -> np.ndarray:
    """Tokens that ``weights`` give to floor, unigram, bigram and trigram, by bucket, and at
    the end the tokens' log-likelihood; the cells' estimates are in 1/per_octave octaves."""
    width = bits(per_octave)
    bucket = cell >> (ORDER * width)
    p = [np.full(len(cell), floor)]
    for order in range(ORDER):
        s = cell >> (width * order) & (1 << width) - 1
        p.append(np.where(s > 0, 2.0 ** (-(s - 1) / per_octave), 0))
    part = weights[bucket] * np.stack(p, axis=1)
    total = part.sum(axis=1)
    part *= (n / total)[:, None]
    given = np.stack([np.bincount(bucket, part[:, k], 2 * BUCKETS) for k in range(ORDER + 1)], axis=1)
    return np.append(given.ravel(), n @ np.log(total))


def learn_weights(cells: list[tuple[int, int]] | DataFrame, floor: float, rounds: int = 60, per_octave: int = 1) -> np.ndarray:
    """Weights (floor, unigram, bigram, trigram) by bucket, from (cell, tokens), by EM, until the
    likelihood of a token stands still (it gains less than STILL).  Of a stored table only
    the sums of its partitions come to the driver in each round."""
    weights, last = np.full((2 * BUCKETS, ORDER + 1), 1 / (ORDER + 1)), -np.inf
    if isinstance(cells, list):
        cell, n = np.array(cells, np.int64).reshape(-1, 2).T
    for _ in range(rounds):
        if isinstance(cells, list):
            sums = shares(cell, n, weights, floor, per_octave)
        else:
            def part(batches, weights=weights):
                sums = np.zeros(weights.size + 1)
                for b in batches:
                    sums += shares(b.column(0).to_numpy(), b.column(1).to_numpy(), weights, floor, per_octave)
                yield pa.RecordBatch.from_pydict({"sums": pa.array([sums.tolist()], pa.list_(pa.float64()))})

            found = [r.sums for r in cells.mapInArrow(part, "sums array<double>").collect()]
            sums = np.array(found).reshape(-1, weights.size + 1).sum(axis=0)
        likelihood, tokens = sums[-1], sums[:-1].sum()
        # half a token of each estimate keeps every weight above zero
        sums = sums[:-1].reshape(weights.shape) + 0.5
        weights = sums / sums.sum(axis=1, keepdims=True)
        if likelihood - last <= STILL * tokens:
            break
        last = likelihood
    return weights


def score(docs: DataFrame, train: Column, chunk_bytes: int = CHUNK_BYTES, slab_keys: int = SLAB_KEYS, regions: int = REGIONS) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every text;
    ``train`` (over doc_id, null is false) chooses the rows that counts are taken from."""
    cols = [F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), F.col("text").cast("string").alias("text")]
    chunks = chunk_table(docs, cols, chunk_bytes)
    size = chunks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    slabs = max(1, -(-size // (slab_keys * 6)))  # some six bytes of text to a token
    counted = ask(chunks, lambda row: question(row["payload"], slabs), lambda slab, arrays: reply(slab, arrays, slabs), ORDER * slabs, 2, 1, regions)
    counted = materialize_bucketed(counted, "counts", "chunk", chunks._buckets)
    one = counted.select(F.explode("answers.sums").alias("s"))
    found = one.agg(*(F.coalesce(F.sum(F.col("s")[i]), F.lit(0)).alias(c) for i, c in enumerate(("kinds", "seen", "ends")))).first()
    kinds, n_tokens, n_docs = found.kinds, found.seen, found.ends
    floor = 1 / (kinds + 1)
    joined = chunks.join(counted, "chunk")
    here = lambda row, deleted: Counted(row["payload"], answered(row["answers"]), slabs, n_docs, n_tokens, deleted)

    width = bits(STEPS)

    def held(batches):
        for batch in batches:
            for row in rows_of(batch):
                c = here(row, True)
                code = c.bucket() << (ORDER * width)
                for order, p in enumerate(c.estimates()):
                    code |= steps(p) << (width * order)
                cell, count = np.unique(code[c.trained], return_counts=True)
                yield pa.RecordBatch.from_pydict({"cell": pa.array(cell, pa.int64()), "n": pa.array(count, pa.int64())})

    cells = joined.mapInArrow(held, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    cells = materialize(cells, "cells")
    weights = learn_weights(cells, floor, per_octave=STEPS)
    release(cells)

    def finish(batches):
        for batch in batches:
            for row in rows_of(batch):
                c = here(row, False)
                w = weights[c.bucket()]
                p = w[:, 0] * floor
                for k, e in enumerate(c.estimates()):
                    p = p + w[:, k + 1] * e
                base = (c.count[0] + ADD) / (n_tokens + ADD * (kinds + 1))
                per_text = lambda x: np.add.reduceat(x, c.begin)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": c.batch.column(0), "n_tokens": pa.array(c.length), "n_known": pa.array(per_text((c.count[0] > 0).astype(np.int64))),
                    "train_tokens": pa.array(np.full(len(c.length), n_tokens)), "base_score": pa.array(per_text(np.log10(base))), "score": pa.array(per_text(np.log10(p))),
                })

    return joined.mapInArrow(finish, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
