"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the presences of its words, pairs of neighbouring words and
pairs with one word between them, hashed into BUCKETS. FTRL-proximal keeps a rate for each
coordinate and sets most weights to exactly zero (L1), so the model is a short list of
(bucket, weight) that is broadcast to the tasks that score.

The model is fitted in one task on at most TRAIN_ROWS labelled texts, chosen and ordered by a
hash of doc_id; scoring covers all texts, whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.shared import WordCache, chunks, table

#: Labelled texts that a model is fitted on at most.
TRAIN_ROWS = 16_000
BUCKETS = 1 << 22
THRESHOLD = 0.3
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 1.5, 0.1, 3
#: The bias before any row is seen: about one text in eight.
PRIOR = -2.0

_FOLD = bytes(32 if b < 48 or 58 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 127 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_PAIR, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def word_cache() -> WordCache:
    return WordCache(lambda words: [xxhash.xxh64_intdigest(w) for w in words], 300_000)


def features(texts: list[bytes], cache: WordCache) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every n-gram and skip-gram, repeats included."""
    split = [t.translate(_FOLD).split() for t in texts]
    cache.fill({w for x in split for w in x})
    lengths = [len(x) for x in split]
    h = np.fromiter((cache[w] for x in split for w in x), np.uint64, sum(lengths))
    text = np.repeat(np.arange(len(texts)), lengths)
    near, far = text[1:] == text[:-1], text[2:] == text[:-2]
    grams = [h, (h[:-1] * _PAIR + h[1:])[near], (h[:-2] * _SKIP + h[2:])[far]]
    where = np.concatenate([text, text[:-1][near], text[:-2][far]])
    mixed = np.concatenate(grams)
    mixed ^= mixed >> np.uint64(29)
    return where, ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(42)).astype(np.int64)


class Ftrl:
    """FTRL-proximal with per-coordinate rates."""

    def __init__(self):
        self.z, self.n = np.zeros(BUCKETS), np.zeros(BUCKETS)
        self.bias, self.bias_n = PRIOR, 0.0

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(self.bias + w.sum(), -35, 35))) - label
        n = self.n[at]
        more = np.sqrt(n + g * g)
        self.z[at] += g - (more - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g
        self.bias_n += g * g
        self.bias -= 0.1 * g / (BETA + np.sqrt(self.bias_n))

    def model(self) -> tuple[np.ndarray, np.ndarray]:
        """(buckets, weights) that aren't zero; the bias is bucket -1."""
        at = np.flatnonzero(np.abs(self.z) > L1)
        return np.concatenate([[-1], at]), np.concatenate([[self.bias], self.weights(at)])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_rows(df: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """order, toxic, buckets of at most ``limit`` labelled texts that aren't held out."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    order = F.xxhash64(F.col("doc_id"), F.lit(8))
    chosen = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).select(F.col("doc_id").alias("labelled"), "toxic", order.alias("order")).orderBy("order", "labelled").limit(limit)
    # ``limit`` rows of three numbers, so the broadcast is bounded.
    texts = df.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled")).select("order", "toxic", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_cache()
        for piece, raw in chunks(batches):
            where, bucket = features(raw, cache)
            cut = np.searchsorted(np.sort(where), np.arange(len(raw) + 1))
            bucket = bucket[np.argsort(where, kind="stable")]
            own = [np.unique(bucket[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_pydict({"order": piece.column("order"), "toxic": piece.column("toxic").cast(pa.int32()), "buckets": pa.array(own, pa.list_(pa.int64())).cast(pa.list_(pa.int32()))})

    # A doc_id that is on many rows would multiply its label, hence the limit on rows too.
    return texts.mapInArrow(run, "order long, toxic int, buckets array<int>").orderBy("order").limit(limit)


def fit(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The model, fitted in one task on its bounded rows; only non-zero weights come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [(r, y) for b in batches for r, y in zip(b.column("buckets"), b.column("toxic").to_pylist(), strict=True)]
        known = [(r.values.to_numpy().astype(np.int64), y) for r, y in known]
        model = Ftrl()
        for _ in range(EPOCHS):
            for at, y in known:
                model.learn(at, y)
        bucket, weight = model.model()
        yield pa.RecordBatch.from_pydict({"bucket": bucket, "weight": weight})

    found = rows.coalesce(1).mapInArrow(run, "bucket long, weight double").toArrow()
    return found["bucket"].to_numpy(), found["weight"].to_numpy()


def score_texts(texts: list[bytes], weights: np.ndarray, bias: float, cache: WordCache) -> np.ndarray:
    """weights: dense over the buckets."""
    where, bucket = features(texts, cache)
    live = np.flatnonzero(weights[bucket])
    seen = np.unique(where[live] * BUCKETS + bucket[live])
    total = np.bincount(seen // BUCKETS, weights[seen % BUCKETS], len(texts))
    return 1 / (1 + np.exp(-np.clip(bias + total, -35, 35)))


def score(df: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of df.

    Null and empty texts get the model's bias as their score. Equal texts get equal scores. Columns
    other than doc_id and text are ignored; an empty table gives none.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, weight = shared.value
        dense = np.zeros(BUCKETS)
        dense[bucket[bucket >= 0]] = weight[bucket >= 0]
        bias = float(weight[bucket < 0].sum()) if len(bucket) else PRIOR
        cache = word_cache()
        for piece, texts in chunks(batches):
            yield pa.RecordBatch.from_pydict({"doc_id": piece.column("doc_id"), "score": pa.array(score_texts(texts, dense, bias, cache), pa.float64())})

    scored = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, by a model fitted on ``labels.toxic`` without the held-out rows."""
    documents = table(spark, sf_dir, "documents")
    return score(documents, fit(training_rows(documents, table(spark, sf_dir, "labels"))))
