"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text, present or not: words, pairs of neighbours, and pairs with one word between them,
hashed into `2 ** bits` buckets. Training is follow-the-regularised-leader with a learning rate per
coordinate; L1 leaves few weights, which are broadcast and looked up while every text is read once.

The labelled rows used for training are a sample of at most about `sample` documents, taken by a hash of
the doc_id, with one text (that of the smallest hash) for each doc_id, so its size is bounded however many
labels and rows there are. It is dealt to
learners of about `learner_rows` rows that run side by side; their weights are averaged.

Nulls and odd rows: a null text is empty; an empty text has no feature and gets the score of the bias
alone; a null doc_id is never held out and never trains; of several labels for one doc_id the largest
counts; labels without a document, or null, are ignored; without any label the bias is neutral and every
score is 0.5. An empty table gives an empty result. Other columns are never inputs of a score.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .tasks import ship, whole_text
from .words import batched, mixed, word_hashes

BITS = 20
SAMPLE = 24_000
# Rows of the sample that one learner takes.
LEARNER_ROWS = 8_000
EPOCHS = 3
THRESHOLD = 0.7
# FTRL-proximal: rate alpha / (beta + sqrt(sum of squared gradients)), L1 and L2.
ALPHA, BETA, L1, L2 = 2.0, 0.5, 1.5, 0.02

# The column that `score_documents` adds.
SCORE = "_tallywright_score"


def features(texts: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features and the text each belongs to; repeats are not removed."""
    words, owner, _, _ = word_hashes(texts)
    parts, owners = [words], [owner]
    for gap, sign in ((1, 0xA24BAED4963EE407), (2, 0x9FB21C651E98DF25)):
        same = owner[gap:] == owner[:-gap]
        second = words[gap:][same]
        parts.append(words[:-gap][same] * np.uint64(sign) ^ ((second << np.uint64(1)) | (second >> np.uint64(63))))
        owners.append(owner[:-gap][same])
    buckets = mixed(np.concatenate(parts)) >> np.uint64(64 - bits)
    return buckets.astype(np.int64), np.concatenate(owners)


def learn(texts: list[bytes], labels: list[int], bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights of one learner; the last is the bias, fixed at the log odds of the labels.

    A common word is present in texts of both kinds, so its summed gradient walks about zero and grows
    as the root of its squares; L1 therefore grows with that root, and only words whose gradient keeps
    its direction get a weight.
    """
    size = 1 << bits
    z, n = np.zeros(size), np.zeros(size)
    bias = float(np.log((sum(labels) + 1) / (len(labels) - sum(labels) + 1)))
    rows = []
    for low, high in batched(texts):
        buckets, owner = features(texts[low:high], bits)
        keys = np.unique(owner * size + buckets)
        cuts = np.searchsorted(keys, np.arange(high - low + 1) * size)
        keys %= size
        rows += [keys[a:b].astype(np.int32) for a, b in zip(cuts[:-1], cuts[1:])]
    for _ in range(epochs):
        for row, label in zip(rows, labels):
            zs, ns = z[row], n[row]
            w = _weights(zs, ns)
            g = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -30, 30))) - label
            z[row] = zs + g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / ALPHA * w
            n[row] = ns + g * g
    return np.append(_weights(z, n), bias)


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    root = np.sqrt(n)
    shrunk = np.sign(z) * np.maximum(np.abs(z) - L1 * (BETA + root), 0)
    return -shrunk / ((BETA + root) / ALPHA + L2)


def fold(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo 3; null stays null."""
    return F.crc32(doc_id.cast("string")) % 3


def training_rows(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, learner_rows: int = LEARNER_ROWS
) -> tuple[DataFrame, int]:
    """`doc_id, toxic, text` of about `sample` labelled documents outside the held-out third, and how
    many learners they are dealt to."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .filter(fold(F.col("doc_id")) != 1)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    n = known.count()
    share = sample / max(sample, n)
    shards = max(1, -(-min(n, sample) // learner_rows))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    # One text for each doc_id: many rows of one doc_id would all go to one learner.
    one = texts.join(chosen, "doc_id").groupBy("doc_id")
    return one.agg(F.first("toxic").alias("toxic"), F.min_by("text", F.xxhash64("text")).alias("text")), shards


def train(
    docs: DataFrame,
    labels: DataFrame,
    bits: int = BITS,
    sample: int = SAMPLE,
    learner_rows: int = LEARNER_ROWS,
    epochs: int = EPOCHS,
) -> np.ndarray:
    """Averaged weights, the bias last. What the driver gets is at most 2 ** bits numbers, and in
    practice, after L1, a few thousand."""
    ship(docs.sparkSession)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["order", "doc_id"])
        weights = learn([x.encode() for x in pdf["text"]], pdf["toxic"].tolist(), bits, epochs)
        kept = np.flatnonzero(weights)
        return pd.DataFrame({"bucket": kept, "weight": weights[kept], "n": len(pdf)})

    rows, shards = training_rows(docs, labels, sample, learner_rows)
    rows = rows.select(
        F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(shards)).alias("shard"),
        F.xxhash64("doc_id", F.lit(2)).alias("order"),
        *("doc_id", "toxic", "text"),
    )
    learned = rows.groupBy("shard").applyInPandas(one, "bucket long, weight double, n long")
    mean = learned.groupBy("bucket").agg((F.sum("weight") / shards).alias("weight"))
    found = mean.orderBy("bucket").toPandas()
    weights = np.zeros((1 << bits) + 1)
    weights[found["bucket"].to_numpy(np.int64)] = found["weight"].to_numpy()
    return weights


def score_documents(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """Every row of `docs` with its columns, and `SCORE`, the probability of label 1, in a new column."""
    ship(docs.sparkSession)
    bits = (len(weights) - 1).bit_length() - 1
    table = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    @F.pandas_udf("double")
    def probability(column: pd.Series) -> pd.Series:
        w = table.value
        texts = [x.encode() for x in column]
        sums = np.full(len(texts), float(w[-1]))
        for low, high in batched(texts):
            buckets, owner = features(texts[low:high], bits)
            used = np.flatnonzero(w[buckets])
            keys = np.unique(owner[used] << 32 | buckets[used])
            np.add.at(sums, low + (keys >> 32), w[keys & 0xFFFFFFFF])
        return pd.Series(1 / (1 + np.exp(-np.clip(sums, -30, 30))))

    return docs.withColumn(SCORE, probability(whole_text()))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document, learned from labels outside the held-out third."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_documents(docs, train(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        F.col(SCORE).alias("score"),
        (F.col(SCORE) >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that are not predicted toxic, with their columns."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_documents(docs, train(docs, labels))
    return scored.filter(F.col(SCORE) < THRESHOLD).drop(SCORE)
