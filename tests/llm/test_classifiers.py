"""Held-out accuracy of the two document classifiers, and their edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import cotraining, toxicity

SF = "/root/testdata/sf0.1"
EDGE = [(1, None, None, None, "x"), (None, "", "src1", "en", "x"), (3, "word " * 40_000, "src1", "en", "y"), (3, "a", "s", "en", "y"), (3, "a", "s", "en", "y")]
EDGE_SCHEMA = "doc_id long, text string, source string, lang string, y string"


def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_fit_ordinal_orders_grades():
    rng = np.random.default_rng(0)
    y = (rng.random(2000) < 0.3) * rng.integers(1, 4, 2000)
    row = np.concatenate([np.repeat(np.arange(2000), 3), np.repeat(np.arange(2000), y)])
    feature = np.concatenate([rng.integers(5, 30, 6000), rng.integers(0, 5, y.sum())])
    w, cut = toxicity.fit_ordinal(row, feature, np.ones(len(row)), y, 30)
    assert (np.diff(cut) > 0).all() and w[:5].min() > w[5:].max()


@pytest.mark.parametrize("name", ["toxic", "quality"])
def test_held_out(spark, name):
    docs, labels = tables(spark)
    labels = labels.withColumn("part", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(4)))
    seen, unseen = labels.filter("part > 0"), labels.filter("part = 0")
    if name == "toxic":
        scored = toxicity.score_documents(docs, toxicity.train(docs, seen)).withColumn("said", F.col("toxic").cast("int")).drop("toxic")
    else:
        scored = cotraining.score_documents(docs, cotraining.train(docs, seen)).withColumn("said", F.col("keep").cast("int"))
    rows = scored.join(unseen, "doc_id").select("said", name).collect()
    y, said = (np.array([r[k] for r in rows]) for k in (1, 0))
    assert (said[y == 0] == 0).mean() >= (0.995 if name == "toxic" else 0.6)
    assert (said[y == 1] == 1).mean() >= (0.85 if name == "toxic" else 0.95)
    assert scored.count() == docs.count()


def test_edges(spark):
    docs, labels = tables(spark)
    edge = spark.createDataFrame(EDGE, EDGE_SCHEMA)
    tox, good = toxicity.train(docs, labels), cotraining.train(docs, labels)
    out = toxicity.score_documents(edge, tox).collect()
    assert [r.doc_id for r in out] == [1, None, 3, 3, 3] and not any(r.toxic for r in out)
    assert out[0].severity == out[1].severity == 0 and out[3] == out[4]
    rows = cotraining.score_documents(edge, good).collect()
    assert len(rows) == 5 and all(0 <= r.quality_score <= 1 for r in rows) and rows[3] == rows[4]
    assert toxicity.drop_toxic(edge, tox).columns == edge.columns and toxicity.drop_toxic(edge, tox).count() == 5
    empty = edge.limit(0)
    assert toxicity.score_documents(empty, tox).count() == cotraining.score_documents(empty, good).count() == 0
    none = labels.limit(0)
    assert not any(r.toxic for r in toxicity.score_documents(edge, toxicity.train(docs, none)).collect())
    assert {r.quality_score for r in cotraining.score_documents(edge, cotraining.train(docs, none)).collect()} == {0.5}


def test_surest_rows_of_the_whole_corpus(spark):
    """What the views hand over is the top of all rows, in any partitioning, without the rows given before and with copies once."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 300, rng.integers(1, 40))) for _ in range(3000)]
    rows = [(i, t, f"s{i % 7}", "en") for i, t in enumerate(texts)] + [(5000 + i, texts[9], "s2", "en") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    buckets = np.sort(rng.choice(1 << 18, 4096, replace=False))
    pool = cotraining._sparse(docs.repartition(7), buckets, "doc_id", "long").persist()
    known = spark.createDataFrame([(i,) for i in range(0, 3000, 3)], "doc_id long")
    views = [cotraining.View(rng.normal(size=4097)), cotraining.View(rng.normal(size=cotraining.META + 1))]
    batch = pool.toArrow().combine_chunks().to_batches()[0]
    uid, doc = (batch.column(c).to_numpy() for c in ("uid", "doc_id"))
    open_ = (doc >= 3000) | (doc % 3 > 0)
    given = [uid[:100], uid[50:300]]
    most = [40, 300, 0, 5000]
    got = cotraining.hand_over(pool, known, views, given, most)
    for k, z in enumerate(cotraining._logits(batch, views)):
        for side, sure in ((2 * k, -z), (2 * k + 1, z)):
            free = {(-np.float32(s), -(int(u) >> 32 & 0xFFFFFFFF), int(u)) for s, u in zip(sure[open_], uid[open_], strict=True) if s > 0 and u not in given[1 - k]}
            assert got[side] == [u for *_, u in sorted(free)][: most[side]]


def test_every_unlabelled_row_is_in_the_pool(spark, monkeypatch):
    docs, labels = tables(spark)
    seen = []
    plain = cotraining.hand_over
    monkeypatch.setattr(cotraining, "hand_over", lambda pool, known, *rest: seen.append(pool.join(known, "doc_id", "left_anti").count()) or plain(pool, known, *rest))
    cotraining.train(docs, labels.filter("doc_id % 10 = 0"), pool_size=50, rounds=1)
    known = labels.filter("doc_id % 10 = 0 and quality is not null").select("doc_id")
    assert seen == [docs.join(known, "doc_id", "left_anti").count()]
