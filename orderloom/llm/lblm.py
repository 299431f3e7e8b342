"""Language-model scoring with a log-bilinear neural model, trained in numpy by noise-contrastive estimation.

Counts. One pass counts all training tokens (hashed words, pre-aggregated in the task). The most frequent words and the end of text are symbols of
the model; all other words belong to one of ``CLASSES`` classes by their last letters, which are symbols too.

Model. The two symbols before a token predict its vector: p = R[s1] C1 + R[s2] C2; the logit of symbol s is p.Q[s] + b[s]. Every task trains a copy on its
part of the training texts by noise-contrastive estimation with noise drawn from the symbol counts, and copies are averaged, weighted by tokens, by an
aggregate over parameter numbers. This is done in ``ROUNDS`` rounds over disjoint parts that together are all training documents.

Scoring. Logits of all pairs of contexts come from matrix products in blocks and are normalised over all symbols, so the log-probabilities are
exact, not self-normalised. A word of a class gets the class's probability times its smoothed share of the class, with one more
type for unknown words; so the model is normalised over known words and one unknown word per class.

Counts of the most frequent words, ``HEAD`` at most, travel to the tasks as a broadcast of fixed size; all other tokens are joined with the full count
table. Edge cases: null and empty texts are one end token; a null ``doc_id`` counts as empty text for the split and stays null; without
training tokens the model is uniform; repeated rows give repeated results; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import LOWER, documents, flat, keep, mixed, pieces, prefix_hashes, signed, span_hashes, words

TOP_WORDS = 447
CLASSES = 64
END = TOP_WORDS  # symbol of the end of text; classes follow
SYMBOLS = TOP_WORDS + 1 + CLASSES
SIZE = 24
HEAD = 1 << 18
ROUNDS = 2
BATCH = 8192
NOISE = 48
HELD = 4 << 20
END_HASH = 0x1D0F_57A6_3C2B_4E11


def token_table(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, class and row of every word, in text order."""
    data, offsets = flat(column)
    starts, ends, row = words(data, offsets)
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64), row
    hashes = mixed(span_hashes(prefix_hashes(data, lower=True), starts, ends))
    last, before = LOWER[data[ends - 1]], LOWER[data[np.maximum(ends - 2, starts)]]
    shape = mixed(last.astype(np.uint64) * np.uint64(251) + before.astype(np.uint64) * np.uint64(65_537))
    return signed(hashes), (shape % np.uint64(CLASSES)).astype(np.int64), row


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size, texts = 0, 0

    def flush() -> pa.RecordBatch:
        word, kind = (np.concatenate(c) for c in zip(*held, strict=True))
        unique, first, n = np.unique(word, return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(unique), pa.array(kind[first].astype(np.int32)), pa.array(n)], ["w", "kind", "n"])

    for batch in batches:
        for part in pieces(batch):
            word, kind, _ = token_table(part.column("text"))
            texts += part.num_rows
            held.append((word, kind))
            size += len(word)
            if size >= HELD:
                yield flush()
                held, size = [], 0
    if size:
        yield flush()
    if texts:
        yield pa.RecordBatch.from_arrays([pa.array([END_HASH]), pa.array([-1], pa.int32()), pa.array([texts])], ["w", "kind", "n"])


@dataclass
class Counts:
    """What tasks need of the corpus counts: fixed in size."""

    total: int  # N
    distinct: int  # V
    top: np.ndarray  # hashes of the words that are symbols, sorted
    top_symbol: np.ndarray
    head: np.ndarray  # hashes of the most frequent words, sorted, and their counts
    head_count: np.ndarray
    class_total: np.ndarray
    class_distinct: np.ndarray
    symbol_count: np.ndarray

    def symbols(self, word: np.ndarray, kind: np.ndarray) -> np.ndarray:
        out = END + 1 + kind
        if len(self.top):
            at = np.minimum(np.searchsorted(self.top, word), len(self.top) - 1)
            out = np.where(self.top[at] == word, self.top_symbol[at], out)
        return out

    def head_counts(self, word: np.ndarray) -> np.ndarray:
        """Count of each word, -1 for words outside the head."""
        if not len(self.head):
            return np.full(len(word), -1)
        at = np.minimum(np.searchsorted(self.head, word), len(self.head) - 1)
        return np.where(self.head[at] == word, self.head_count[at], -1)


def corpus_counts(training: DataFrame) -> tuple[DataFrame, Counts]:
    """The count table (w, kind, c) of all training tokens, and its bounded digest."""
    table = keep(
        training.select("text").mapInArrow(_count, "w long, kind int, n long").groupBy("w").agg(F.first("kind").alias("kind"), F.sum("n").alias("c")),
        "lm-counts",
    )
    # The head ends at a count, found from a table of a few hundred count steps, so no task sorts the vocabulary.
    step = F.floor(F.log2("c") * 8)
    steps = table.filter("kind >= 0").groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    within = [r["step"] for r, n in zip(steps, np.cumsum([r["count"] for r in steps]), strict=True) if n <= HEAD]
    head = table.filter((F.col("kind") >= 0) & (step >= (min(within) if within else 1 << 20))).toArrow()
    word, kind, c = (head.column(k).to_numpy() for k in ("w", "kind", "c"))
    rank = np.lexsort((word, -c))
    top = rank[:TOP_WORDS]
    order = np.argsort(word[top])
    classes = table.filter("kind >= 0").groupBy("kind").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    ends = table.filter("kind < 0").agg(F.sum("c")).first()[0] or 0
    n, v = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in classes:
        n[r["kind"]], v[r["kind"]] = r["n"], r["v"]
    total, distinct = int(n.sum()) + ends, int(v.sum()) + (ends > 0)
    n -= np.bincount(kind[top], weights=c[top], minlength=CLASSES)
    v -= np.bincount(kind[top], minlength=CLASSES)
    symbol = np.zeros(SYMBOLS)
    symbol[: len(top)], symbol[END], symbol[END + 1 :] = c[top], ends, n
    by_word = np.argsort(word)
    return table, Counts(total, distinct, word[top][order], order, word[by_word], c[by_word], n, v, symbol)


def sequence(counts: Counts, word: np.ndarray, kind: np.ndarray, row: np.ndarray, rows: int):
    """Symbols of all texts, each closed by the end symbol: (context two back, context one back, symbol, row)."""
    per_row = np.bincount(row, minlength=rows)
    s = np.full(len(word) + rows, END, np.int64)
    s[np.arange(len(word)) + row] = counts.symbols(word, kind)
    of = np.repeat(np.arange(rows), per_row + 1)
    back1 = np.append(END, s[:-1])
    back2 = np.append([END, END], s[:-2]) if len(s) > 1 else np.full(len(s), END)
    back2[np.cumsum(per_row + 1) - per_row - 1] = END
    return back2, back1, s, of


class LogBilinear:
    SHAPES = ((SYMBOLS, SIZE), (SIZE, SIZE), (SIZE, SIZE), (SYMBOLS, SIZE), (SYMBOLS,))

    def __init__(self, parameters: list[np.ndarray]):
        self.r, self.c1, self.c2, self.q, self.b = self.parameters = parameters

    @staticmethod
    def start(symbol_count: np.ndarray, seed: int = 3) -> LogBilinear:
        rng = np.random.default_rng(seed)
        share = (symbol_count + 0.5) / (symbol_count + 0.5).sum()
        eye = np.eye(SIZE)
        return LogBilinear([
            *(a.astype(np.float32) for a in (rng.normal(0, 0.3, (SYMBOLS, SIZE)), eye * 0.5, eye * 0.5, rng.normal(0, 0.05, (SYMBOLS, SIZE)), np.log(share)))
        ])

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters]).astype(np.float64)

    @classmethod
    def from_flat(cls, values: np.ndarray) -> LogBilinear:
        cuts = np.cumsum([int(np.prod(s)) for s in cls.SHAPES])[:-1]
        return cls([v.reshape(s).astype(np.float32) for v, s in zip(np.split(values, cuts), cls.SHAPES, strict=True)])

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logit parts of the two contexts, and the log normaliser of every pair of contexts."""
        far = self.r @ self.c1 @ self.q.T
        near = self.r @ self.c2 @ self.q.T + self.b
        norm = np.empty((SYMBOLS, SYMBOLS), np.float32)
        for k in range(SYMBOLS):
            logits = self.r[k] @ self.c1 @ self.q.T + near  # all pairs with this far context, as one block
            top = logits.max(1, keepdims=True)
            norm[k] = top[:, 0] + np.log(np.exp(logits - top).sum(1))
        return far, near, norm


class Trainer:
    """Noise-contrastive estimation with AdaGrad; noise symbols are shared by a batch."""

    def __init__(self, model: LogBilinear, symbol_count: np.ndarray, seed: int, rate: float = 0.08):
        self.model = LogBilinear([p.copy() for p in model.parameters])
        self.square = [np.full(p.shape, 1e-6, np.float32) for p in model.parameters]
        self.share = (symbol_count + 0.5) / (symbol_count + 0.5).sum()
        self.cumulative = np.cumsum(self.share)
        self.offset = (np.log(NOISE) + np.log(self.share)).astype(np.float32)
        self.rng = np.random.default_rng(seed)
        self.rate = rate

    def step(self, far: np.ndarray, near: np.ndarray, target: np.ndarray) -> None:
        m = self.model
        n = len(target)
        noise = np.minimum(np.searchsorted(self.cumulative, self.rng.random(NOISE)), SYMBOLS - 1)
        rf, rn = m.r[far], m.r[near]
        p = rf @ m.c1 + rn @ m.c2
        qt, qn = m.q[target], m.q[noise]
        good = np.einsum("nd,nd->n", p, qt) + m.b[target] - self.offset[target]
        bad = p @ qn.T + m.b[noise] - self.offset[noise]
        g_good = (0.5 * (np.tanh(0.5 * good) - 1)) / n  # d loss / d logit of the true symbol
        g_bad = (0.5 * (np.tanh(0.5 * bad) + 1)) / n
        dp = g_good[:, None] * qt + g_bad @ qn
        dq = self._scatter(target, g_good[:, None] * p)
        np.add.at(dq, noise, g_bad.T @ p)
        db = np.bincount(target, weights=g_good, minlength=SYMBOLS)
        np.add.at(db, noise, g_bad.sum(0))
        dr = self._scatter(far, dp @ m.c1.T) + self._scatter(near, dp @ m.c2.T)
        for value, square, g in zip(m.parameters, self.square, (dr, rf.T @ dp, rn.T @ dp, dq, db), strict=True):
            square += g * g
            value -= self.rate * g / np.sqrt(square)

    @staticmethod
    def _scatter(at: np.ndarray, rows: np.ndarray) -> np.ndarray:
        flat_at = (at[:, None] * SIZE + np.arange(SIZE)[None, :]).ravel()
        return np.bincount(flat_at, weights=rows.ravel(), minlength=SYMBOLS * SIZE).reshape(SYMBOLS, SIZE).astype(np.float32)


def _train(counts, start: np.ndarray, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counts.value
        trainer = Trainer(LogBilinear.from_flat(start), known.symbol_count, seed + TaskContext.get().partitionId())
        n = 0
        for batch in batches:
            for part in pieces(batch):
                far, near, s, _ = sequence(known, *token_table(part.column("text")), part.num_rows)
                order = trainer.rng.permutation(len(s))
                for k in range(0, len(s), BATCH):
                    at = order[k : k + BATCH]
                    trainer.step(far[at], near[at], s[at])
                n += len(s)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int64()), pa.array([trainer.model.flat() * n], pa.list_(pa.float64()))], ["n", "sums"]
            )

    return run


def train_model(training: DataFrame, counts: Counts, rounds: int = ROUNDS, seed: int = 11) -> LogBilinear:
    """``training`` has columns text and part; round k trains on the rows with part = k."""
    shared = training.sparkSession.sparkContext.broadcast(counts)
    model = LogBilinear.start(counts.symbol_count)
    for k in range(rounds):
        copies = training.filter(F.col("part") == k).select("text").mapInArrow(
            _train(shared, model.flat(), seed + 1000 * k), "n long, sums array<double>"
        )
        means = (
            copies.select("n", F.posexplode("sums").alias("at", "x")).groupBy("at").agg((F.sum("x") / F.sum("n")).alias("x")).toArrow()
        )
        if means.num_rows:
            values = np.empty(means.num_rows)
            values[means.column("at").to_numpy()] = means.column("x").to_numpy()
            model = LogBilinear.from_flat(values)
    return model


_SCORED = "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, shared double, model double, rare array<long>, tf array<int>"


def _score(counts, parameters: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Counts = counts.value
        far_part, near_part, norm = LogBilinear.from_flat(parameters).tables()
        in_class = np.zeros(SYMBOLS)
        in_class[END + 1 :] = np.log10(known.class_total + 0.5 * (known.class_distinct + 1))
        log10e = np.log10(np.e)
        rid = TaskContext.get().partitionId() << 40
        end_log = np.log10(known.symbol_count[END] + 0.5)
        end_known = int(known.symbol_count[END] > 0)
        for batch in batches:
            for part in pieces(batch):
                rows = part.num_rows
                word, kind, row = token_table(part.column("text"))
                far, near, s, of = sequence(known, word, kind, row, rows)
                # The model without the words' own counts in their classes.
                each = (far_part[far, s] + near_part[near, s] - norm[far, near]) * log10e - in_class[s]
                model = np.bincount(of, weights=each, minlength=rows)
                count = known.head_counts(word)
                seen = count >= 0
                value = np.log10(np.where(seen, count, 0) + 0.5)
                shared = np.bincount(row[seen], weights=value[seen], minlength=rows)
                own = known.symbols(word[seen], kind[seen]) < END  # symbols of their own have no share of a class
                model -= np.bincount(row[seen][own], weights=value[seen][own], minlength=rows)
                model -= end_log
                shared += end_log
                n_known = np.bincount(row[seen], minlength=rows) + end_known
                w, r = word[~seen], row[~seen]
                order = np.lexsort((w, r))
                w, r = w[order], r[order]
                new = np.ones(len(w), bool)
                new[1:] = (w[1:] != w[:-1]) | (r[1:] != r[:-1])
                first = np.flatnonzero(new)
                tf = np.diff(np.append(first, len(w))).astype(np.int32)
                ends = np.append(0, np.cumsum(np.bincount(r[first], minlength=rows))).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (w[first], tf)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(rid, rid + rows)), part.column("doc_id"), part.column("held_out"),
                        pa.array(np.bincount(of, minlength=rows)), pa.array(n_known), pa.array(shared), pa.array(model), *lists,
                    ],
                    ["rid", "doc_id", "held_out", "n_tokens", "n_known", "shared", "model", "rare", "tf"],
                )
                rid += rows

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row, trained on the rows not held out."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        (F.crc32(key.cast("binary")) % 5 == 1).alias("held_out"),
        F.pmod(F.xxhash64(F.lit(2), "doc_id", "text"), F.lit(ROUNDS)).alias("part"),
    )
    training = rows.filter(~F.col("held_out")).select("text", "part")
    table, counts = corpus_counts(training)
    model = train_model(training, counts)
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    scored = keep(rows.select("doc_id", "held_out", "text").mapInArrow(_score(shared, model.flat()), _SCORED), "lm-scored")
    rare = (
        scored.select("rid", F.explode(F.arrays_zip("rare", "tf")).alias("t"))
        .select("rid", F.col("t.rare").alias("r"), F.col("t.tf").alias("tf"))
        .join(table.select("w", "c"), F.col("r") == F.col("w"), "left")
        .groupBy("rid")
        .agg(
            F.sum(F.col("tf") * F.log10(F.coalesce(F.col("c"), F.lit(0)) + 0.5)).alias("more"),
            F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("also_known"),
        )
        .withColumnRenamed("rid", "rare_rid")
    )
    more = F.coalesce(F.col("more"), F.lit(0.0))
    base = F.col("shared") + more - F.col("n_tokens") * F.lit(float(np.log10(counts.total + 0.5 * (counts.distinct + 1))))
    return scored.join(rare, F.col("rid") == F.col("rare_rid"), "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce(F.col("also_known"), F.lit(0))).cast("long").alias("n_known"),
        F.lit(counts.total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("model") + F.col("shared") + more).alias("score"),
    )


def op4_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """Contract query: the model's and the base's log10 probability of every document."""
    return score_documents(documents(spark, sf_dir))
