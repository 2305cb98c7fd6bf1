"""Quality classifier: logistic regression over hashed word n-grams, trained by FTRL.

Features are the hashed words and word pairs of the whole text (case kept; a word that repeats
the one before it gives one common pair, so repetition itself is a feature), each with its share
of the text times ``SCALE``. The training rows are labelled documents of the training folds, at
most ``MAX_TRAIN`` of them (chosen by id hash); they are dealt into ``SHARDS``
parts, each part runs follow-the-regularised-leader updates over its documents, and the parts'
weights are averaged. A score is the logistic function of a sparse dot product.

Hashing is done by DataFrame functions next to the scan; only feature numbers go to Python, and
texts are never shuffled. What is broadcast is bounded: ``MAX_TRAIN`` ids and ``N_BUCKETS``
weights.

Defined cases: null and blank texts have no features and score the bias; a null id is in no
fold (not held out) and never trains; labels that are null or without a document are ignored;
repeated rows score alike; without any training row every score is 0.5; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthlake.llm.common import bounded_sample, let, ship_code, words

N_BUCKETS = 1 << 18
MAX_TRAIN = 20_000
SHARDS = 4
EPOCHS = 8
SCALE = 64.0
CUTOFF = 0.3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.01, 0.01
FOLDS = 5
END, AGAIN = "\n", "\n="  # no word holds them


def features(text: Column, n_buckets: int = N_BUCKETS) -> Column:
    """Hash buckets of a text's words and word pairs as array<int>."""
    n = F.lit(n_buckets)

    def of(w: Column) -> Column:
        def pair(x: Column, i: Column) -> Column:
            y = F.coalesce(F.get(w, i + 1), F.lit(END))
            return F.pmod(F.when(x == y, F.xxhash64(F.lit(AGAIN))).otherwise(F.xxhash64(x, y)), n).cast("int")

        return F.concat(F.transform(w, lambda x: F.pmod(F.xxhash64(x), n).cast("int")), F.transform(w, pair))

    return let(words(text), of)


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def shares(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, n = np.unique(buckets, return_counts=True)
    return at, n * (SCALE / max(1, len(buckets)))


def ftrl(rows: list[tuple[np.ndarray, int]], n_buckets: int = N_BUCKETS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights after ``epochs`` passes of FTRL-proximal updates; the last one is the bias."""
    z, n = np.zeros(n_buckets + 1), np.zeros(n_buckets + 1)
    sparse = []
    for buckets, y in rows:
        at, x = shares(buckets)
        sparse.append((np.append(at, n_buckets), np.append(x, 1.0), y))
    weights = lambda z, n: np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(sparse)):
            at, x, y = sparse[k]
            w = weights(z[at], n[at])
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    return weights(z, n)


def train(docs: DataFrame, labels: DataFrame, n_buckets: int = N_BUCKETS, max_train: int = MAX_TRAIN) -> np.ndarray:
    """Weights of ``n_buckets`` features and the bias, from labelled rows of the training folds."""
    ship_code(docs.sparkSession)
    y = labels.select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("__y"))
    y = y.where("__y IS NOT NULL").where(fold(F.col("__id")) != 0).groupBy("__id").agg(F.max("__y").alias("__y"))
    y = bounded_sample(y, F.col("__id"), max_train)
    d = docs.select("doc_id", "text").join(F.broadcast(y), F.col("doc_id") == F.col("__id"))
    d = d.select("doc_id", F.col("__y").alias("y"), features(F.col("text"), n_buckets).alias("f"),
                 F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(SHARDS)).alias("shard"))

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("doc_id", kind="stable")
        w = ftrl([(np.asarray(f), int(y)) for f, y in zip(part["f"], part["y"], strict=True)], n_buckets)
        at = np.flatnonzero(w)
        return pd.DataFrame({"at": at.astype("int32"), "w": w[at]})

    parts = d.groupBy("shard").applyInPandas(fit, "at int, w double")
    out = np.zeros(n_buckets + 1)
    for r in parts.groupBy("at").agg(F.sum("w").alias("w")).collect():  # <= n_buckets + 1 rows
        out[r.at] = r.w / SHARDS
    return out


def score(docs: DataFrame, weights: np.ndarray, cutoff: float = CUTOFF) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document."""
    spark = docs.sparkSession
    ship_code(spark)
    n_buckets = len(weights) - 1
    sent = spark.sparkContext.broadcast(weights)
    d = docs.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
                    features(F.col("text"), n_buckets).alias("f"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        for b in batches:
            f = b.column(2)
            ends = f.offsets.to_numpy()
            values = w[f.values.to_numpy()[ends[0]:ends[-1]]]
            total = np.concatenate([[0.0], np.cumsum(values)])
            n = np.diff(ends)
            mean = np.diff(total[ends - ends[0]]) / np.maximum(n, 1)
            p = 1 / (1 + np.exp(-np.clip(w[n_buckets] + SCALE * mean, -35, 35)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p)], ["doc_id", "held_out", "score"])

    s = d.mapInArrow(run, f"doc_id {dict(d.dtypes)['doc_id']}, held_out boolean, score double")
    return s.withColumn("predicted", (F.col("score") >= cutoff).cast("int"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
