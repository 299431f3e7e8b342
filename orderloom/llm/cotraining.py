"""Quality classifier by co-training of a text view and a page-metadata view.

View A holds the words of a document (selected hashed features). View B holds what is known about the page: source, language, length and layout
(share of symbols, capitals and digits, line length, share of repeated words), each cut into fixed bins. Both are logistic
regressions, fitted in numpy on the driver on a bounded sample of labelled rows. In each round every view labels
all unlabelled documents of the corpus, and the ones it is surest of, in the proportion of the classes, become training rows of the other
view. Their sparse features are made once and kept; a round reads them and ranks every row, and counts by ranges of the rank give the
lowest rank to take, so only the bounded rows taken reach the driver. Documents alike in text, source and language (by a 64-bit
hash) are handed over once. At the end each view is calibrated on labelled rows kept apart, and a logistic regression over the two calibrated logits combines
them. All documents are then scored over their whole texts.

Parameters: ``sample_size`` bounds the labelled training rows; a view hands over 5 % of the unlabelled rows in a round, or of ``pool_size`` if there are
more. Edge cases: null and empty texts
are scored by the metadata view and the intercepts; null source or language is a value of its own; without labels of both kinds every score
is 0.5 and nothing is dropped; a null ``doc_id`` stays null; repeated rows give repeated results; other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import LOWER, documents, flat, keep, mixed, pieces, word_hashes
from orderloom.llm.textmodel import Selected, adam, dot, labelled_sample, log_counts, select_features, sigmoid

SAMPLE = 10_000
POOL = 10_000
ROUNDS = 5
BINS = 16
NAMES = 64  # hash buckets for each of source and language
_STATS = 7
META = 2 * NAMES + _STATS * BINS
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def _named(column: pa.Array, kind: int) -> np.ndarray:
    data, offsets = flat(column.cast(pa.string()))
    sums = np.zeros(len(data) + 1, np.uint64)
    values = mixed(data.astype(np.uint64) + (np.arange(len(data), dtype=np.uint64) - np.repeat(offsets[:-1], np.diff(offsets)).astype(np.uint64)) * np.uint64(257))
    np.cumsum(values, out=sums[1:])
    h = mixed(sums[offsets[1:]] - sums[offsets[:-1]] + np.uint64(kind))
    return (h % np.uint64(NAMES)).astype(np.int64)


def page_features(batch: pa.RecordBatch) -> np.ndarray:
    """For every row the active metadata features, one of each group: shape (rows, 2 + number of statistics)."""
    data, offsets = flat(batch.column("text"))
    rows = batch.num_rows
    sizes = np.diff(offsets)
    of = np.repeat(np.arange(rows), sizes)
    per = lambda mask: np.bincount(of[mask], minlength=rows)
    share = lambda n, d: n / np.maximum(d, 1)
    hashes, row = word_hashes(data, offsets)
    n_words = np.bincount(row, minlength=rows)
    order = np.lexsort((hashes, row))
    again = np.zeros(len(row), bool)
    again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (row[order][1:] == row[order][:-1])
    repeats = np.bincount(row[order][again], minlength=rows)
    letters = per((LOWER[data] >= 97) & (LOWER[data] <= 122))
    lines = per(data == 10) + 1
    stats = [
        np.log2(np.maximum(sizes, 1)),
        BINS * np.sqrt(share(per(_SYMBOL[data]), sizes)),
        BINS * np.sqrt(share(per((data >= 65) & (data <= 90)), letters)),
        BINS * np.sqrt(share(per((data >= 48) & (data <= 57)), sizes)),
        np.log2(share(n_words, lines) + 1) * 1.5,
        BINS * share(repeats, n_words),
        np.log2(lines) * 1.5,
    ]
    columns = [_named(batch.column("source"), 1), NAMES + _named(batch.column("lang"), 2)]
    columns += [2 * NAMES + k * BINS + np.clip(s, 0, BINS - 1).astype(np.int64) for k, s in enumerate(stats)]
    return np.stack(columns, 1)


@dataclass
class View:
    weights: np.ndarray  # the last one is the intercept
    slope: float = 1.0
    shift: float = 0.0

    def logit(self, row: np.ndarray, feature: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
        return self.slope * (dot(row, feature, value, self.weights, rows) + self.weights[-1]) + self.shift


@dataclass
class CoModel:
    buckets: np.ndarray
    text: View | None
    page: View | None
    mix: np.ndarray  # weight of each calibrated logit, and an intercept

    def score(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of good quality: by the text, by the page, and combined."""
        rows = batch.num_rows
        if self.text is None:
            half = np.full(rows, 0.5)
            return half, half, half
        row, feature, n, _ = Selected(self.buckets)(batch.column("text"))
        a = self.text.logit(row, feature, log_counts(n), rows)
        active = page_features(batch)
        b = self.page.weights[active].sum(1) + self.page.weights[-1]
        b = self.page.slope * b + self.page.shift
        return sigmoid(a), sigmoid(b), sigmoid(self.mix[0] * a + self.mix[1] * b + self.mix[2])


class Rows:
    """Sparse rows of one view, held on the driver."""

    def __init__(self, features: list, values: list | None, size: int):
        self.size = size
        self.n = len(features)
        lengths = np.array([len(f) for f in features], np.int64)
        self.row = np.repeat(np.arange(self.n), lengths)
        self.feature = np.concatenate([np.asarray(f, np.int64) for f in features]) if self.n else np.empty(0, np.int64)
        self.value = np.ones(len(self.feature)) if values is None else np.concatenate([np.asarray(v, np.float64) for v in values])

    def fit(self, rows: np.ndarray, y: np.ndarray, steps: int = 120, l2: float = 1e-4) -> View:
        """Logistic regression on the given rows; a row may be listed more than once."""
        weight = np.bincount(rows, minlength=self.n).astype(float)
        target = np.zeros(self.n)
        target[rows] = y

        def gradient(w: np.ndarray) -> np.ndarray:
            z = dot(self.row, self.feature, self.value, w, self.n) + w[-1]
            r = weight * (sigmoid(z) - target)
            g = np.bincount(self.feature, weights=self.value * r[self.row], minlength=self.size + 1)
            g[-1] = r.sum()
            return g / weight.sum() + l2 * w

        return View(adam(np.zeros(self.size + 1), gradient, steps, 0.1))

    def logit(self, view: View) -> np.ndarray:
        return view.logit(self.row, self.feature, self.value, self.n)


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 400) -> np.ndarray:
    """Small dense logistic regression with an intercept as last weight."""
    x = np.column_stack([x, np.ones(len(x))])
    start = np.zeros(x.shape[1])
    start[:-1] = 1 / (x.shape[1] - 1)
    return adam(start, lambda w: x.T @ (sigmoid(x @ w) - y) / len(y), steps, 0.05)


def _sparse(docs: DataFrame, buckets: np.ndarray, carried: str, kind: str) -> DataFrame:
    """uid, the column ``carried``, and as bytes: selected features (2 each), their counts (4 each), page features (2 each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        selected = Selected(buckets)
        for batch in batches:
            for part in pieces(batch):
                row, feature, n, counts = selected(part.column("text"))
                ends = np.append(0, np.cumsum(np.bincount(row, minlength=len(counts)))).astype(np.int32)
                page = page_features(part).astype(np.uint16)
                columns = [(ends * 2, feature.astype(np.uint16)), (ends * 4, n.astype(np.uint32))]
                columns.append((np.arange(len(page) + 1, dtype=np.int32) * (2 * page.shape[1]), page))
                data = [
                    pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(np.ascontiguousarray(o)), pa.py_buffer(v.tobytes())])
                    for o, v in columns
                ]
                yield pa.RecordBatch.from_arrays([part.column("uid"), part.column(carried), *data], ["uid", carried, "feature", "n", "page"])

    source, lang = (F.col(c).cast("string").alias(c) for c in ("source", "lang"))
    uid = F.xxhash64(F.lit(9), *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in ("text", "source", "lang")])
    narrow = docs.select(uid.alias("uid"), F.col(carried).cast(kind).alias(carried), "text", source, lang)
    return narrow.mapInArrow(run, f"uid long, {carried} {kind}, feature binary, n binary, page binary")


def _numbers(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in a column of bytes one after the other, and how many each row has."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat_bytes = b"" if data is None or ends[-1] == ends[0] else data.slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes()
    return np.frombuffer(flat_bytes, kind), np.diff(ends) // np.dtype(kind).itemsize


def _logits(batch: pa.RecordBatch, views: list[View]) -> list[np.ndarray]:
    rows = batch.num_rows
    feature, sizes = _numbers(batch.column("feature"), np.uint16)
    n, _ = _numbers(batch.column("n"), np.uint32)
    page, per_row = _numbers(batch.column("page"), np.uint16)
    every = np.arange(rows)
    a = views[0].logit(np.repeat(every, sizes), feature.astype(np.int64), log_counts(n), rows)
    return [a, views[1].logit(np.repeat(every, per_row), page.astype(np.int64), np.ones(len(page)), rows)]


def _ranked(views: list[View], given: list[np.ndarray]):
    """(doc_id, uid, a, b) of every row: the rank by each view, positive if it says good, negative if bad, 0 for rows the other view was given.

    The size of a rank is that of the logit in its upper and a part of the uid in its lower 32 bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid = batch.column("uid").to_numpy()
            ranks = []
            for k, z in enumerate(_logits(batch, views)):
                rank = np.abs(z).astype(np.float32).view(np.uint32).astype(np.int64) << 32 | (uid >> 32 & 0xFFFFFFFF)
                ranks.append(pa.array(np.where(np.isin(uid, given[1 - k]), 0, np.sign(z).astype(np.int64) * rank)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("uid"), *ranks], ["doc_id", "uid", "a", "b"])

    return run


def hand_over(pool: DataFrame, known: DataFrame, views: list[View], given: list[np.ndarray], most: list[int]) -> list[list[int]]:
    """For each side the uids of the ``most[side]`` rows of highest rank that the other view was not given yet.

    Side 2k + 1 is what view k is surest is good, 2k what it is surest is bad. Rows of ``pool`` whose doc_id is in ``known`` do not count. The join
    with them is on the narrow ranks, so that features are never shuffled.
    """
    kind = pool.schema["doc_id"].dataType.simpleString()
    ranked = pool.select("doc_id", "uid", "feature", "n", "page").mapInArrow(_ranked(views, given), f"doc_id {kind}, uid long, a long, b long")
    both = F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).alias("r")) for k, c in enumerate("ab")])
    found = ranked.join(known, "doc_id", "left_anti").select("uid", F.inline(both)).filter("r <> 0")
    found = found.select((F.col("k") * 2 + F.when(F.col("r") > 0, 1).otherwise(0)).alias("side"), F.abs("r").alias("rank"), "uid")
    found = keep(found.distinct(), "surest")
    least = dict.fromkeys(range(4), 0)
    need = dict(enumerate(most))
    still = [side for side in range(4) if most[side] > 0]
    for shift in (48, 32, 16, 0):
        if not still:
            break
        inside = F.lit(False)
        for side in still:
            inside = inside | ((F.col("side") == side) & (F.shiftright("rank", shift + 16) == F.lit(least[side] >> (shift + 16))) if shift < 48 else F.col("side") == side)
        bins = found.filter(inside).groupBy("side", F.shiftright("rank", shift).alias("bin")).count().collect()
        for side in list(still):
            own = sorted(((r["bin"], r["count"]) for r in bins if r["side"] == side), reverse=True)
            for value, count in own:
                if count >= need[side]:
                    least[side] = value << shift
                    if count <= 2 * need[side] + 100:
                        still.remove(side)
                    break
                need[side] -= count
            else:
                still.remove(side)  # all rows found are fewer than asked for
    wanted = F.lit(False)
    for side in range(4):
        if most[side] > 0:
            wanted = wanted | ((F.col("side") == side) & (F.col("rank") >= F.lit(least[side])))
    rows = sorted((r["side"], -r["rank"], r["uid"]) for r in found.filter(wanted).collect())
    return [[uid for s, _, uid in rows if s == side][: most[side]] for side in range(4)]


class Examples:
    """Training rows on the driver: the labelled ones, then those handed over."""

    def __init__(self):
        self.features: list[np.ndarray] = []
        self.values: list[np.ndarray] = []
        self.pages: list[np.ndarray] = []
        self.at: dict[int, int] = {}

    def add(self, table: pa.Table, named: bool = True) -> None:
        for uid, feature, n, page in zip(*(table.column(c).to_pylist() for c in ("uid", "feature", "n", "page")), strict=True):
            if named and uid in self.at:
                continue
            if named:
                self.at[uid] = len(self.pages)
            self.features.append(np.frombuffer(feature, np.uint16).astype(np.int64))
            self.values.append(log_counts(np.frombuffer(n, np.uint32)))
            self.pages.append(np.frombuffer(page, np.uint16).astype(np.int64))


def co_train(examples: Examples, y: np.ndarray, size: int, pool: DataFrame, known: DataFrame, most: int, rounds: int = ROUNDS) -> tuple[View, View, np.ndarray]:
    """``examples`` starts with the labelled rows, ``y`` are their labels. Every fourth is kept apart for calibration.

    In a round each view hands over at most ``most`` rows of ``pool`` whose doc_id is not in ``known``.
    """
    labelled = np.arange(len(y))
    apart = labelled[3::4] if len({*y[labelled[3::4]]}) == 2 else labelled
    base = np.setdiff1d(labelled, apart) if len(apart) < len(labelled) else labelled
    if len({*y[base]}) < 2:
        base = labelled
    good = float(np.mean(y[base]))
    per_side = [round(most * (1 - good)), round(most * good)] * 2
    given = [dict[int, int](), dict[int, int]()]  # pseudo-labels of each view's training set
    for turn in range(rounds + 1):
        sides = (Rows(examples.features, examples.values, size), Rows(examples.pages, None, META))
        views: list[View] = []
        for side, extra in zip(sides, given, strict=True):
            rows = np.concatenate([base, np.array([examples.at[uid] for uid in extra], np.int64)])
            views.append(side.fit(rows, np.concatenate([y[base], np.fromiter(extra.values(), np.int64, len(extra))])))
        if turn == rounds or not most:
            break
        chosen = hand_over(pool, known, views, [np.fromiter(g, np.int64, len(g)) for g in given], per_side)
        for side, uids in enumerate(chosen):
            given[1 - side // 2].update(dict.fromkeys(uids, side % 2))
        new = sorted({uid for uids in chosen for uid in uids} - examples.at.keys())
        if new:
            wanted = pool.sparkSession.createDataFrame([(uid,) for uid in new], "uid long")
            examples.add(pool.join(F.broadcast(wanted), "uid").dropDuplicates(["uid"]).select("uid", "feature", "n", "page").toArrow())
    logits = []
    for side, view in zip(sides, views, strict=True):
        z = side.logit(view)[apart]
        view.slope, view.shift = map(float, _logistic(z[:, None], y[apart]))
        logits.append(view.slope * z + view.shift)
    return views[0], views[1], _logistic(np.column_stack(logits), y[apart])


def train(docs: DataFrame, labels: DataFrame, sample_size: int = SAMPLE, pool_size: int = POOL, rounds: int = ROUNDS, share: float = 0.05) -> CoModel:
    sample = labelled_sample(docs, labels, "quality", sample_size, ("source", "lang"))
    nothing = CoModel(np.empty(0, np.int64), None, None, np.zeros(3))
    if {r["y"] for r in sample.select("y").distinct().collect()} != {0, 1}:
        return nothing
    buckets = select_features(sample)
    known = labels.filter("quality is not null").select("doc_id")
    kind = docs.schema["doc_id"].dataType.simpleString()
    pool = keep(_sparse(docs, buckets, "doc_id", kind), "pool")
    n = pool.select("doc_id").join(known, "doc_id", "left_anti").count()
    table = _sparse(sample, buckets, "y", "long").toArrow()
    examples = Examples()
    examples.add(table, named=False)
    most = max(1, round(share * min(n, pool_size))) if n else 0
    a, b, mix = co_train(examples, table.column("y").to_numpy(), len(buckets), pool, known, most, rounds)
    return CoModel(buckets, a, b, mix)


def score_documents(docs: DataFrame, model: CoModel) -> DataFrame:
    """doc_id, text_score, page_score, quality_score and keep (quality_score of at least 0.5) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                a, b, both = model.score(part)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(a), pa.array(b), pa.array(both), pa.array(both >= 0.5)],
                    ["doc_id", "text_score", "page_score", "quality_score", "keep"],
                )

    narrow = docs.select("doc_id", "text", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, text_score double, page_score double, quality_score double, keep boolean")


def op1_quality_cotraining(spark, sf_dir: str) -> DataFrame:
    """Quality of every document, from views co-trained on a bounded sample of labelled rows and all unlabelled ones."""
    docs = documents(spark, sf_dir)
    return score_documents(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
