"""Toxicity by cumulative-link ordinal regression over sparse text features.

The labels are toxic 0 or 1. Severity grades 0 to 3 are made from them: 0 is clean, and toxic documents are graded by the terciles of
their sum of log counts of toxic-leaning features in the training sample. The model has one weight vector and three ordered thresholds:
P(grade <= k) = sigmoid(threshold_k - w.x). It is fitted in numpy on the driver on a bounded sample (``textmodel.SAMPLE``) and scores
every whole text: expected severity, the chance of any toxicity, and the most likely grade.

A document is toxic if the chance of grade 1 or more is at least one half. Edge cases: null and empty texts have no features and
get the score of the thresholds alone, floored to clean (severity 0); without labels of both kinds nothing is toxic and severity is 0;
a null ``doc_id`` stays null; repeated rows give repeated results; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import documents, pieces
from orderloom.llm.textmodel import SAMPLE, Selected, adam, dot, labelled_sample, log_counts, select_features, sigmoid

GRADES = 4


@dataclass
class OrdinalModel:
    buckets: np.ndarray  # selected features
    weights: np.ndarray  # one weight per feature, shared by all thresholds
    thresholds: np.ndarray  # GRADES - 1 ascending numbers

    def score(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected severity, chance of grade 1 or more, and most likely grade."""
        row, feature, n, counts = Selected(self.buckets)(text)
        z = dot(row, feature, log_counts(n), self.weights, len(counts))
        beyond = sigmoid(z[:, None] - self.thresholds[None, :])  # P(grade > k)
        if len(self.buckets) == 0:
            beyond[:] = 0
        beyond[counts == 0] = 0
        grades = -np.diff(beyond, axis=1, prepend=1.0, append=0.0)
        return beyond.sum(1), beyond[:, 0], grades.argmax(1)


def fit_ordinal(
    row: np.ndarray, feature: np.ndarray, value: np.ndarray, y: np.ndarray, features: int, steps: int = 300, l2: float = 1e-5
) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ascending thresholds that maximise the likelihood of the grades ``y``."""
    rows, top = len(y), GRADES - 1
    start = np.concatenate([np.zeros(features), [1.0], np.full(top - 1, np.log(0.5))])

    def thresholds(p: np.ndarray) -> np.ndarray:
        return np.cumsum(np.concatenate([p[features : features + 1], np.exp(p[features + 1 :])]))

    def gradient(p: np.ndarray) -> np.ndarray:
        z, cut = dot(row, feature, value, p[:features], rows), thresholds(p)
        below = np.concatenate([[-np.inf], cut, [np.inf]])
        hi, lo = sigmoid(below[y + 1] - z), sigmoid(below[y] - z)
        chance = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = hi * (1 - hi) / chance, lo * (1 - lo) / chance
        dz = d_hi - d_lo  # of the negative log likelihood
        d_cut = np.array([(-d_hi[y == k].sum() + d_lo[y == k + 1].sum()) for k in range(top)])
        tail = np.cumsum(d_cut[::-1])[::-1]
        gaps = np.concatenate([tail[:1], tail[1:] * np.exp(p[features + 1 :])])
        g = np.bincount(feature, weights=value * dz[row], minlength=features)
        return np.concatenate([g, gaps]) / rows + np.concatenate([l2 * p[:features], np.zeros(top)])

    p = adam(start, gradient, steps, 0.1)
    return p[:features], thresholds(p)


def train(docs: DataFrame, labels: DataFrame, sample_size: int = SAMPLE) -> OrdinalModel:
    sample = labelled_sample(docs, labels, "toxic", sample_size)
    none = OrdinalModel(np.empty(0, np.int64), np.zeros(0), np.array([1.0, 2.0, 3.0]))
    seen = {r["y"] for r in sample.select("y").distinct().collect()}
    if not {0, 1} <= seen:
        return none
    buckets = select_features(sample)
    if not len(buckets):
        return none

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        selected = Selected(buckets)
        for batch in batches:
            for part in pieces(batch):
                row, feature, n, counts = selected(part.column("text"))
                cuts = np.searchsorted(row, np.arange(1, len(counts)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("y"), pa.array(np.split(feature, cuts)), pa.array(np.split(n, cuts))],
                    ["y", "feature", "n"],
                )

    narrow = sample.select("text", F.col("y").cast("long").alias("y"))
    table = narrow.mapInArrow(run, "y long, feature array<long>, n array<long>").toArrow().combine_chunks()
    toxic = table.column("y").to_numpy()
    sizes = np.array([len(x) for x in table.column("feature").to_pylist()], np.int64)
    row = np.repeat(np.arange(len(toxic)), sizes)
    feature = np.concatenate([np.array(x, np.int64) for x in table.column("feature").to_pylist()])
    n = np.concatenate([np.array(x, np.int64) for x in table.column("n").to_pylist()])
    # A feature leans to toxic if it stands in a larger share of the toxic documents.
    share = [np.bincount(feature[toxic[row] == k], minlength=len(buckets)) / max(1, (toxic == k).sum()) for k in (0, 1)]
    leaning = share[1] > 3 * share[0]
    strength = np.bincount(row, weights=log_counts(n) * leaning[feature], minlength=len(toxic))
    cuts = np.quantile(strength[toxic == 1], [1 / 3, 2 / 3])
    grade = np.where(toxic == 1, 1 + np.searchsorted(cuts, strength, "right"), 0)
    weights, thresholds = fit_ordinal(row, feature, log_counts(n), grade, len(buckets))
    return OrdinalModel(buckets, weights, thresholds)


def score_documents(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """doc_id, severity (expected grade), p_toxic, grade and toxic of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                severity, p, grade = model.score(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(severity), pa.array(p), pa.array(grade.astype(np.int32)), pa.array(p >= 0.5)],
                    ["doc_id", "severity", "p_toxic", "grade", "toxic"],
                )

    narrow = docs.select("doc_id", "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, severity double, p_toxic double, grade int, toxic boolean")


def drop_toxic(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """The rows of ``docs`` that are not toxic, all columns unchanged."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                yield part.filter(pa.array(model.score(part.column("text"))[1] < 0.5))

    return docs.mapInArrow(run, schema)


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    """Expected severity of every document, from a model fitted on a bounded sample of ``labels``."""
    docs = documents(spark, sf_dir)
    return score_documents(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
