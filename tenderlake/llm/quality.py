"""Quality classifier: logistic regression on hashed word n-grams, trained with FTRL-proximal updates.

Features are 1- and 2-grams of words and of word shapes (case, punctuation, digits, and
whether a word repeats the one before it), hashed into ``2**BITS`` weights.  A
document's value for a feature is its share of the document's n-grams times a
constant, so a score is a sparse dot product: the mean of the gathered weights.

Training uses a bounded sample of labelled rows: the ``sample_rows`` rows smallest by a
hash of the doc_id among those whose crc32(doc_id as text) mod ``folds`` is not 0, each dealt
to one of ``PARTS`` buckets.  In each round every bucket makes follow-the-regularised-leader
updates over its rows, from the state of the round before; Spark sums the buckets' changes by
feature and their mean is the next state.  The state has at most 2**BITS rows, whatever
the input.  Labels, lang, source and doc_id are never inputs of a score.

Scoring reads every whole text once, in Arrow batches, without a shuffle.

Defined results: null and empty texts score by the bias alone.  Labels that are null are not
learnt from; a doc_id labelled more than once is learnt from as often.  Without any usable label all
scores are 0.5.  A null doc_id is not held out and not learnt from.  Repeated rows stay; empty table: empty
result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BoundedCache, keep_only, map_columns, written

BITS = 18
SAMPLE_ROWS = 20_000
PARTS = 8
ROUNDS = 2
SCALE = 24.0
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.5
THRESHOLD = 0.3
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class NGrams:
    """Hashed feature indices of texts; one in each task."""

    def __init__(self, cache_limit: int = 500_000):
        self.known: BoundedCache = BoundedCache(cache_limit)  # word -> hash with the shape in its low 8 bits

    def _word(self, w: str) -> int:
        core = w.strip(".,;:!?")
        case = 0 if core.islower() else 1 if core.isupper() and len(core) > 1 else 2 if core[:1].isupper() else 3
        other = sum(not (c.isalnum() or c in ".,;:!?'-") for c in w)
        shape = case | (4 if "!" in w else 0) | (8 if w[-1] in ".,;:" else 0) | (16 if any(c.isdigit() for c in w) else 0) \
            | (32 if other else 0) | (64 if other == len(w) else 0)
        return (xxhash.xxh3_64_intdigest(w) & ~0xFF) | shape

    def indices(self, text: str) -> np.ndarray:
        """An index for each n-gram of the text, with repeats."""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        known = self.known
        known.room_for(len(words))
        codes = []
        for w in words:
            code = known.get(w)
            if code is None:
                code = self._word(w)
                if len(w) <= 64:
                    known[w] = code
            codes.append(code)
        h = np.array(codes, dtype=np.uint64)
        shape = h & np.uint64(0xFF)
        shape[1:] |= (h[1:] == h[:-1]).astype(np.uint64) << np.uint64(7)
        top = np.uint64(64 - BITS)
        with np.errstate(over="ignore"):
            return np.concatenate([
                h * _M1 >> top, (h[:-1] * _M1 + h[1:] * _M2) * _M1 >> top,
                (shape + np.uint64(1)) * _M2 >> top, ((shape[:-1] << np.uint64(8) | shape[1:]) + np.uint64(1000)) * _M2 >> top,
            ]).astype(np.int32)


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """FTRL-proximal's weights from its state."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def ftrl(texts: list[str], labels: list[int], z: np.ndarray, n: np.ndarray, grams: NGrams) -> None:
    """One pass of updates, in place; the last element is the bias."""
    for text, y in zip(texts, labels):
        idx = grams.indices(text)
        at, times = np.unique(idx, return_counts=True)
        at = np.append(at, len(z) - 1)
        x = np.append(times * (SCALE / max(len(idx), 1)), 1.0)
        w = weights_of(z[at], n[at])
        p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
        g = (p - y) * x
        sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
        z[at] += g - sigma * w
        n[at] += g * g


def score_text(idx: np.ndarray, w: np.ndarray) -> float:
    s = w[-1] + (SCALE * w[idx].mean() if len(idx) else 0.0)
    return float(1 / (1 + np.exp(-np.clip(s, -30, 30))))


def held_out(folds: int, doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, folds: int, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, y, text) of the sampled rows, written."""
    chosen = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("y"))
              .filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out(folds))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample_rows))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # At most sample_rows rows of two numbers: a proven bound for the broadcast.
    return written(texts.join(F.broadcast(chosen), "doc_id"), "quality-sample")


def _updates(state, turn: int):
    """A bucket's changes of the state in one round."""
    def f(group: pa.Table) -> pa.Table:
        keep_only()
        z0, n0 = (a.astype("f8") for a in state.value)
        z, n = z0.copy(), n0.copy()
        rows = sorted(zip(*(group.column(c).to_pylist() for c in ("doc_id", "y", "text"))),
                      key=lambda r: (xxhash.xxh3_64_intdigest(f"{turn} {r[0]}"), *r))
        ftrl([r[2] for r in rows], [r[1] for r in rows], z, n, NGrams())
        at = np.flatnonzero(n != n0)
        return pa.table({"at": at.astype("i4"), "z": z[at] - z0[at], "n": n[at] - n0[at]})

    return f


def train(sample: DataFrame, rounds: int = ROUNDS, parts: int = PARTS) -> np.ndarray:
    """Weights (2**BITS and the bias)."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    sc = sample.sparkSession.sparkContext
    dealt = sample.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(parts)))
    for turn in range(rounds):
        state = sc.broadcast((z.astype("f4"), n.astype("f4")))

        change = (dealt.groupBy("part").applyInArrow(_updates(state, turn), "at int, z double, n double")
                  .groupBy("at").agg(F.sum("z").alias("z"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")))
        got = change.toArrow()  # at most 2**BITS + 1 rows
        at = got.column("at").to_numpy()
        k = got.column("k").to_numpy()
        z[at] += got.column("z").to_numpy() / k
        n[at] += got.column("n").to_numpy() / k
        state.unpersist()
    return weights_of(z, n).astype("f4")


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2**BITS + 1 numbers

    def make():
        keep_only()
        w, grams = shared.value, NGrams()
        return lambda batch: {"doc_id": batch.column("doc_id"),
                              "score": [score_text(grams.indices(t or ""), w) for t in batch.column("text").to_pylist()]}

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    return map_columns(rows, "doc_id bigint, score double", make)


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = THRESHOLD,
             sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    weights = train(training_sample(docs, labels, folds, sample_rows))
    return score(docs, weights).select(
        "doc_id", held_out(folds).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that the classifier rejects, with all its columns."""
    weights = docs.sparkSession.sparkContext.broadcast(train(training_sample(docs, labels, folds)))

    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w, grams = weights.value, NGrams()
        for part in texts:
            yield pd.Series([score_text(grams.indices(t or ""), w) for t in part], dtype="float64")

    return docs.filter(F.pandas_udf(scores, "double")(F.col("text")) >= threshold)
