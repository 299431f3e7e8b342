"""Sparse text features and the bounded training samples of the document classifiers.

Features are hashed words without outer punctuation, their 4- and 5-byte beginnings, and their punctuation tails. Models are fitted on the driver on at most
about ``SAMPLE`` labelled rows, drawn by a hash of the id, over at most ``FEATURES`` selected features; both bounds are parameters.
Scoring runs over all whole texts in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import LOWER, flat, keep, mixed, pieces, prefix_hashes, span_hashes, words

SAMPLE = 20_000
FEATURES = 4096
BITS = 18
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def token_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, row) of every feature occurrence, and the number of words per row."""
    rows = len(offsets) - 1
    starts, ends, row = words(data, offsets)
    counts = np.bincount(row, minlength=rows)
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64), counts
    a, b = starts.copy(), ends.copy()
    while True:
        trim = (b > a) & _PUNCTUATION[data[b - 1]]
        if not trim.any():
            break
        b -= trim
    while True:
        trim = (a < b) & _PUNCTUATION[data[np.minimum(a, len(data) - 1)]]
        if not trim.any():
            break
        a += trim
    prefix = prefix_hashes(data, lower=True)
    kinds = [(a, b), (a, np.minimum(a + 4, b)), (a, np.minimum(a + 5, b)), (b, ends)]
    out, of = [], []
    for kind, (x, y) in enumerate(kinds):
        full = y > x
        if kind in (1, 2):
            full = y - x == kind + 3
        h = mixed(span_hashes(prefix, x[full], y[full]) + np.uint64(kind * 0x51ED270B))
        out.append((h >> np.uint64(64 - BITS)).astype(np.int64))
        of.append(row[full])
    return np.concatenate(out), np.concatenate(of), counts


def row_counts(bucket: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, bucket) pairs in order, and how often each occurs."""
    pair, n = np.unique((row << BITS) | bucket, return_counts=True)
    return pair >> BITS, pair & ((1 << BITS) - 1), n


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, size: int = SAMPLE, columns: tuple[str, ...] = ()) -> DataFrame:
    """About ``size`` labelled documents at most, drawn by a hash of doc_id: doc_id, text, y and ``columns``."""
    one = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("y"))
    space = 1 << 30
    share = min(space, size * space // max(1, one.count()) + 1)
    drawn = one.filter(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(space)) < share).select(F.col("doc_id").alias("l_id"), "y")
    narrow = docs.select("doc_id", "text", *columns)
    # The drawn labels are at most about ``size`` rows of two numbers, so they may be broadcast.
    return keep(narrow.join(F.broadcast(drawn), F.col("doc_id") == F.col("l_id")).drop("l_id"), "labelled")


def select_features(sample: DataFrame, limit: int = FEATURES, least: float = 20.0) -> np.ndarray:
    """Buckets whose presence tells positive from negative documents best, by the likelihood ratio of the two-by-two table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for part in pieces(batch):
                bucket, row, _ = token_buckets(*flat(part.column("text")))
                row, bucket, _ = row_counts(bucket, row)
                y = part.column("y").to_numpy(zero_copy_only=False).astype(np.int64)
                np.add.at(counts, (y[row], bucket), 1)
        used = np.flatnonzero(counts.any(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(counts[1, used]), pa.array(counts[0, used])], ["bucket", "pos", "neg"]
        )

    totals = sample.groupBy().agg(F.coalesce(F.sum("y"), F.lit(0)).alias("p"), F.count("y").alias("n")).first()
    p, n = float(totals["p"]), float(totals["n"] - totals["p"])
    cell = lambda seen, rows, kind: F.when(seen > 0, seen * F.log(seen * F.lit(p + n) / (rows * F.lit(max(kind, 1.0))))).otherwise(0.0)
    pos, neg, both = F.col("pos"), F.col("neg"), F.col("pos") + F.col("neg")
    lack = F.lit(p + n) - both
    ratio = 2 * (cell(pos, both, p) + cell(neg, both, n) + cell(F.lit(p) - pos, lack, p) + cell(F.lit(n) - neg, lack, n))
    chosen = (
        sample.select("text", F.col("y").cast("long").alias("y"))
        .mapInArrow(run, "bucket long, pos long, neg long")
        .groupBy("bucket")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .withColumn("ratio", ratio)
        .filter(F.col("ratio") >= least)
        .orderBy(F.desc("ratio"), "bucket")
        .limit(limit)
        .select("bucket")
        .collect()
    )
    return np.array(sorted(r.bucket for r in chosen), np.int64)


class Selected:
    """Turns texts into counts of the selected features."""

    def __init__(self, buckets: np.ndarray):
        self.at = np.full(1 << BITS, -1, np.int32)
        self.at[buckets] = np.arange(len(buckets), dtype=np.int32)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, feature, count) of the features present, and words per row."""
        bucket, row, counts = token_buckets(*flat(column))
        feature = self.at[bucket]
        hit = feature >= 0
        row, feature, n = row_counts(feature[hit].astype(np.int64), row[hit])
        return row, feature, n, counts


def log_counts(n: np.ndarray) -> np.ndarray:
    return np.log1p(n.astype(np.float64))


def dot(row: np.ndarray, feature: np.ndarray, value: np.ndarray, w: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, weights=value * w[feature], minlength=rows)


def adam(w: np.ndarray, gradient, steps: int, rate: float) -> np.ndarray:
    """Full-batch Adam; ``gradient(w)`` is of the mean loss."""
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return w


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.clip(x, -500, 500)))
