"""Counts and base scores against plain Python, a normalised model, and gain on held-out documents."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from orderloom.llm import lblm


def plain(rows):
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None] for _, t in rows]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in rows]
    counts = Counter(t for words, h in zip(tokens, held) if not h for t in words)
    n, v = sum(counts.values()), len(counts)
    out = []
    for (doc, _), words, h in zip(rows, tokens, held):
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in words)
        out.append((doc, h, len(words), sum(counts[t] > 0 for t in words), n, base))
    return out


def check(got, want):
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert tuple(g[:5]) == tuple(w[:5]) and abs(g[5] - w[5]) < 1e-6 * max(1, abs(w[5])), (g, w)


def test_base_and_held_out_gain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in lblm.score_documents(docs).collect()]
    check(got, plain(rows))
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held) * 0.995  # better than the base by half a percent of its digits


def test_small_head_and_edges(spark, monkeypatch):
    monkeypatch.setattr(lblm, "HEAD", 460)
    rows = [(i, " ".join(f"W{(i * j) % 700}é" for j in range(i % 90))) for i in range(300)] + [(900, None), (None, " \t"), (901, "a"), (901, "a"), (902, "B " * 30_000)]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, rid int, kind string").repartition(3)
    check([tuple(r) for r in lblm.score_documents(df).collect()], plain(rows))
    assert lblm.score_documents(df.limit(0)).count() == 0


def test_normalised_over_words_and_unknown(spark):
    rows = [(i, " ".join(f"w{(i * j) % 900}" for j in range(60))) for i in range(200)]
    df = spark.createDataFrame([(t, i % 2) for i, t in rows], "text string, part int")
    table, counts = lblm.corpus_counts(df)
    model = lblm.train_model(df, counts)
    far, near, norm = model.tables()
    vocabulary = table.filter("kind >= 0").collect()
    for a, b in ((0, 1), (lblm.END, lblm.END), (500, 3)):
        p = np.exp(far[a] + near[b] - norm[a, b].astype(np.float64))
        assert abs(p.sum() - 1) < 1e-4
        total = p[lblm.END]
        spread = counts.class_total + 0.5 * (counts.class_distinct + 1)
        for r in vocabulary:
            s = int(counts.symbols(np.array([r.w]), np.array([r.kind]))[0])
            total += p[s] if s < lblm.END else p[s] * (r.c + 0.5) / spread[r.kind]
        total += sum(p[lblm.END + 1 + k] * 0.5 / spread[k] for k in range(lblm.CLASSES))
        rest = p[: lblm.TOP_WORDS].sum() - sum(p[s] for s in counts.top_symbol)
        assert abs(total + rest - 1) < 1e-3


def test_sequence():
    counts = lblm.Counts(0, 0, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.zeros(64), np.zeros(64), np.zeros(lblm.SYMBOLS))
    word, kind, row = lblm.token_table(pa.array(["a b c", "", None, "d"]))
    far, near, s, of = lblm.sequence(counts, word, kind, row, 4)
    e = lblm.END
    a, b, c, d = (e + 1 + kind).tolist()
    assert s.tolist() == [a, b, c, e, e, e, d, e] and of.tolist() == [0, 0, 0, 0, 1, 2, 3, 3]
    assert near.tolist() == [e, a, b, c, e, e, e, d]
    assert far.tolist() == [e, e, a, b, e, e, e, e]
