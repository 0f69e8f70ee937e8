"""Toxicity: a linear classifier over character n-grams whose features are
scaled by naive Bayes log-count ratios, trained on labelled texts.

A text is lower-cased, everything but letters becomes one space, and the
n-grams of lengths ``GRAMS`` (word edges included) are hashed into buckets.
A bucket's log-count ratio compares the shares of toxic and clean texts
that contain it. The buckets whose ratio is most certain are the features;
a text's feature is the ratio if it contains the n-gram, else 0, and a
logistic regression weighs them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import bound_batches, cut, fold, frugal, give_back

GRAMS = (4, 5, 6, 7)
BUCKET_BITS = 20
SAMPLE_PER_CLASS = 8_000    # bound of the labelled sample, by class
FEATURES = 8_192
SMOOTHING = 1.0
REGULARIZATION = 1e-4
THRESHOLD = 0.7

NOT_LETTERS = re.compile(r"[\W\d_]+")


@dataclass
class Model:
    """Weights by bucket (0: no feature) and the intercept."""
    weights: np.ndarray
    intercept: float


def buckets(text: str) -> np.ndarray:
    """Buckets of all n-grams of a text, with repeats; none without letters."""
    letters = NOT_LETTERS.sub(" ", text.lower()).strip()
    if not letters:
        return np.empty(0, np.int64)
    codes = np.frombuffer(f" {letters} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out, acc = [], codes
    for n in range(2, max(GRAMS) + 1):
        if len(codes) < n:
            break
        acc = acc[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1:]
        if n in GRAMS:
            h = (acc + np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
            out.append((h * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _labelled(docs: DataFrame, labels: DataFrame, train, id_col: str, text_col: str,
              label_col: str, per_class: int) -> tuple[DataFrame, dict]:
    """A bounded sample (text, label, weight) of the labelled training rows,
    the first of each class by a hash of the id, and the counts by class.
    Both classes weigh alike."""
    own = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")) \
        .where("id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label")) \
        .where(train(F.col("id")))
    own = cut(own, "toxicity-labels")
    totals = {r.label: r.n for r in own.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    sample = None
    for label, n in totals.items():
        top = own.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(per_class) \
            .withColumn("weight", F.lit(1.0 / min(n, per_class)))
        sample = top if sample is None else sample.unionByName(top)
    if sample is None:
        return docs.select(F.col(text_col).alias("text"), F.lit(0).alias("label"),
                           F.lit(0.0).alias("weight")).limit(0), totals
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # at most 2 * per_class rows of two numbers; one text an id, the smallest
    picked = texts.join(F.broadcast(cut(sample, "toxicity-sample")), "id").groupBy("id") \
        .agg(F.min("text").alias("text"), F.first("label").alias("label"), F.first("weight").alias("weight")) \
        .select("text", "label", "weight")
    return cut(picked, "toxicity-texts"), totals


def _ratios(sample: DataFrame, features: int) -> dict[int, float]:
    """Log-count ratios of the ``features`` buckets with the most certain ones."""
    def count(batches):
        seen = np.zeros((2, 1 << BUCKET_BITS), np.int32)
        rows = np.zeros(2, np.int64)
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[label, np.unique(buckets(text or ""))] += 1
                rows[label] += 1
        at = np.flatnonzero(seen.any(axis=0))
        # the row numbers go in a bucket of their own
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[at, -1].astype(np.int64)), pa.array(np.r_[seen[0, at], rows[0]].astype(np.int64)),
             pa.array(np.r_[seen[1, at], rows[1]].astype(np.int64))], ["bucket", "clean", "toxic"])

    counts = cut(sample.select("text", "label").mapInArrow(frugal(count), "bucket long, clean long, toxic long")
                 .groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")),
                 "toxicity-counts")
    total = counts.where("bucket = -1").first()
    if not total or not total.clean or not total.toxic:
        return {}
    a = SMOOTHING
    clean, toxic = F.col("clean") + a, F.col("toxic") + a
    ratio = F.log(toxic / (total.toxic + 2 * a)) - F.log(clean / (total.clean + 2 * a))
    certain = F.abs(ratio) / F.sqrt(1 / toxic + 1 / clean)
    best = counts.where("bucket >= 0").select("bucket", ratio.alias("r"), certain.alias("z")) \
        .orderBy(F.desc("z"), "bucket").limit(features).collect()
    return {r.bucket: r.r for r in best if r.r}


def train_model(docs: DataFrame, labels: DataFrame, train, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "toxic", per_class: int = SAMPLE_PER_CLASS,
                features: int = FEATURES) -> Model:
    """Fit on at most ``per_class`` rows of each class of the labelled rows
    that ``train`` (a condition on the id) admits.

    Labels other than 0 and 1 and null ids are left out; an id with both
    labels counts as toxic. Of the rows of an id the smallest text is taken. Without texts of both classes the model has no
    feature and scores every text with the smoothed share of toxic labels.
    """
    bound_batches(docs.sparkSession)
    sample, totals = _labelled(docs, labels, train, id_col, text_col, label_col, per_class)
    ratios = _ratios(sample, features)
    weights = np.zeros(1 << BUCKET_BITS)
    if not ratios:
        p = (totals.get(1, 0) + 1) / (sum(totals.values()) + 2)
        return Model(weights.astype(np.float32), math.log(p / (1 - p)))
    chosen = list(ratios)
    mask = np.zeros(1 << BUCKET_BITS, bool)
    mask[chosen] = True

    def features_of(batches):
        for batch in batches:
            grams = []
            for text in batch.column(0).to_pylist():
                b = buckets(text or "")
                grams.append([str(i) for i in np.unique(b[mask[b]])])
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(grams, pa.list_(pa.string()))],
                                             ["label", "weight", "grams"])

    found = cut(sample.mapInArrow(frugal(features_of), "label int, weight double, grams array<string>"), "toxicity-grams")
    present = CountVectorizerModel.from_vocabulary([str(b) for b in chosen], "grams", "present") \
        .setBinary(True).transform(found)
    scaled = ElementwiseProduct(scalingVec=Vectors.dense([ratios[b] for b in chosen]),
                                inputCol="present", outputCol="features").transform(present)
    fitted = LogisticRegression(regParam=REGULARIZATION, standardization=False, weightCol="weight",
                                maxIter=100).fit(scaled.select("label", "weight", "features"))
    weights[chosen] = np.array([ratios[b] for b in chosen]) * fitted.coefficients.toArray()
    return Model(weights.astype(np.float32), float(fitted.intercept))


def scorer(spark: SparkSession, model: Model):
    """A column function: the probability of label 1 of a whole text. Null
    and empty texts and texts without letters get the score of a text
    without features."""
    bound_batches(spark)
    shared = spark.sparkContext.broadcast((model.weights, model.intercept))

    @F.pandas_udf("double")
    def probability(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, intercept = shared.value
        has = weights != 0
        for texts in parts:
            logits = np.full(len(texts), intercept)
            for k, text in enumerate(texts):
                if text:
                    b = buckets(text)
                    logits[k] += weights[np.unique(b[has[b]])].sum(dtype=np.float64)
            yield pd.Series(1 / (1 + np.exp(-np.clip(logits, -500, 500))))
        give_back()

    return probability


def training_fold(id_: Column) -> Column:
    """Ids whose labels may be learned from."""
    return F.crc32(id_.cast("string").cast("binary")) % 3 != 1


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, held_out, score, predicted.

    The model learns from labels whose id lies outside the held-out fold
    (crc32 of the id mod 3 = 1) only; rows with a null id are never learned
    from, and held out is false for them. Repeated rows score alike; an
    empty table gives no rows. Other columns are not read.
    """
    model = train_model(docs, labels, training_fold, id_col, text_col, label_col)
    scored = docs.select(F.col(id_col), scorer(docs.sparkSession, model)(F.col(text_col).cast("string")).alias("score"))
    return scored.select(
        id_col, F.coalesce(fold(id_col, 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
