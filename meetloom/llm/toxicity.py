"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct hashed byte n-grams (5, 6 and 8 bytes, A-Z lower-cased) of
the whole text. On the labelled sample, each feature's log-count ratio r compares how
often the two classes hold it; a logistic regression with an L2 penalty then learns one
weight per r-scaled feature, and weight * r is what scoring adds up.

The sample is bounded: at most SAMPLE_DOCS labelled documents, in the order of a hash of
their id, and SAMPLE_BYTES of UTF-8 text; fitting happens on the driver within those bounds.
All features that pass LEAST_Z carry weights; the sample bounds their number.
Scoring runs over all rows in Arrow batches and reads nothing but the text.

Null text counts as empty and gets the prior. A document labelled twice takes its highest
label; labels without text or with a null label are not learned from. Without labels of both
classes every score is the share of toxic labels (0 if there are none).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetloom.llm.common import saved, small_batches, text_udf, training_part

SAMPLE_DOCS, SAMPLE_BYTES = 4_000, 48 << 20
SIZES, BUCKET_BITS = (5, 6, 8), 22
BUCKETS = 1 << BUCKET_BITS
#: A feature is learned from if so many sampled documents hold it and its share of toxic ones lies so many standard deviations from the mean. The sample bounds their number.
LEAST_DOCS, LEAST_Z = 4, 5.0
PENALTY, STEPS = 3e-4, 300
REJECT_AT = 0.3
FOLD = bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def hashed(text: str | None) -> list[np.ndarray]:
    """Buckets of the text's n-grams in order, one array a size. Every run of ASCII that is no letter or digit counts as one space, and one stands at both ends."""
    words = b" ".join((text or "").encode("utf-8", "replace").translate(FOLD).split())
    b = np.frombuffer(b" " + words + b" ", np.uint8).astype(np.uint32)
    out = []
    for n in SIZES:
        if len(b) < n:
            continue
        h = np.full(len(b) - n + 1, n, np.uint32)
        for i in range(n):
            h ^= b[i : len(b) - n + 1 + i]
            h *= np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h >>= np.uint32(32 - BUCKET_BITS)
        out.append(h)
    return out


def features(text: str | None) -> np.ndarray:
    """Sorted distinct buckets of the text's n-grams."""
    return np.unique(np.concatenate([np.empty(0, np.uint32), *hashed(text)]))


@dataclass
class ToxicityModel:
    """weight[bucket] already holds the log-count ratio; score = sigmoid(bias + sum over the distinct buckets)."""

    bias: float
    weight: np.ndarray

    def score(self, text: str | None) -> float:
        total = self.bias
        if not np.isfinite(total):
            return float(total > 0)
        known = [x[self.weight[x] != 0] for x in hashed(text)]
        if known:
            total += float(self.weight[np.unique(np.concatenate(known))].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(total, -700, 700))))


def fit(samples: list[tuple[str | None, int]]) -> ToxicityModel:
    y = np.array([int(t > 0) for _, t in samples], np.float64)
    weight = np.zeros(BUCKETS, np.float32)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return ToxicityModel(np.inf if share == 1 else -np.inf, weight)
    docs = [features(t) for t, _ in samples]
    held = np.zeros(BUCKETS, np.int32)
    for d in docs:
        held[d] += 1
    in_toxic = np.zeros(BUCKETS, np.int32)
    for d, t in zip(docs, y, strict=True):
        if t:
            in_toxic[d] += 1
    share = y.mean()
    z = np.where(held >= LEAST_DOCS, (in_toxic - held * share) / np.sqrt(np.maximum(held, 1) * share * (1 - share)), 0)
    cols = np.flatnonzero(np.abs(z) >= LEAST_Z)
    p, q = in_toxic[cols] + 1.0, held[cols] - in_toxic[cols] + 1.0
    r = np.log(p / (y.sum() + 2)) - np.log(q / (len(y) - y.sum() + 2))
    new = np.full(BUCKETS, -1, np.int64)
    new[cols] = np.arange(len(cols))
    docs = [x[x >= 0] for x in (new[d] for d in docs)]
    flat = np.concatenate(docs)
    row = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    value = r[flat]
    w, bias = np.zeros(len(cols)), float(np.log(share / (1 - share)))
    # Adam's steps: the columns differ much in scale.
    first, second, first_b, second_b = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for k in range(1, STEPS + 1):
        g = 1 / (1 + np.exp(-np.clip(bias + np.bincount(row, value * w[flat], len(docs)), -40, 40))) - y
        dw, db = np.bincount(flat, value * g[row], len(cols)) / len(y) + PENALTY * w, float(g.mean())
        first, second = 0.9 * first + 0.1 * dw, 0.99 * second + 0.01 * dw**2
        first_b, second_b = 0.9 * first_b + 0.1 * db, 0.99 * second_b + 0.01 * db**2
        rate = 0.02 * np.sqrt(1 - 0.99**k) / (1 - 0.9**k)
        w -= rate * first / (np.sqrt(second) + 1e-8)
        bias -= 2 * rate * first_b / (np.sqrt(second_b) + 1e-8)
    weight[cols] = w * r
    return ToxicityModel(bias, weight)


def labelled_sample(docs: DataFrame, labels: DataFrame, parts: int = 4, held_out: int = 2) -> list[tuple[str | None, int]]:
    """The bounded training sample: docs (doc_id, text), labels (doc_id, toxic). Ids are drawn among those that have a text."""
    judged = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & training_part(F.col("doc_id"), parts, held_out)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    drawn = saved(judged.orderBy(*order).limit(4 * SAMPLE_DOCS))  # labels without text take no place unless three in four lack it
    texts = docs.select("doc_id", "text").where("text is not null")
    ids = texts.select("doc_id").join(F.broadcast(drawn), "doc_id").distinct().orderBy(*order).limit(SAMPLE_DOCS)
    out, size = [], 0
    for r in texts.join(F.broadcast(saved(ids)), "doc_id").orderBy(*order, "text").toLocalIterator():
        if len(out) >= SAMPLE_DOCS:
            break
        n = len(r["text"].encode("utf-8", "replace"))
        if size + n > SAMPLE_BYTES:  # a text that does not fit leaves room for those after it
            continue
        size += n
        out.append((r["text"], r["toxic"]))
    return out


def score_column(spark, model: ToxicityModel):
    """An Arrow UDF of the text column; the weights (16 MB) travel as one broadcast."""
    shared = spark.sparkContext.broadcast(model)
    small_batches(spark)
    return text_udf("double", lambda scores: pa.array(scores, pa.float64()), lambda: shared.value.score)


def score_documents(docs: DataFrame, labels: DataFrame, parts: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of docs."""
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    toxicity = score_column(docs.sparkSession, fit(labelled_sample(docs, labels, parts, held_out)))
    rows = docs.select("doc_id", (~training_part(F.col("doc_id"), parts, held_out)).alias("held_out"), toxicity("text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= REJECT_AT).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, labelled_docs: DataFrame | None = None, threshold: float = REJECT_AT) -> DataFrame:
    """The rows of docs, columns unchanged, whose text scores below the threshold."""
    toxicity = score_column(docs.sparkSession, fit(labelled_sample(labelled_docs or docs, labels)))
    return docs.where(toxicity(docs["text"]) < threshold)


def is_toxic(score: Column, threshold: float = REJECT_AT) -> Column:
    return score >= threshold
