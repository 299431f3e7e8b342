"""The corpus pipeline stage by stage against brute-force versions of what each stage must do to its own input."""

import base64
import hashlib
from collections import Counter

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as cp
from orderloom.llm import toxicity
from orderloom.llm.pii import find
from tests.llm.test_jaccard import brute
from tests.llm.test_mixing import plain_targets, words

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert [n for n, _ in cp.STAGES] == ["toxicity", "jaccard", "pii", "mixing", "bpe"]

    clean = cp.drop_toxic(spark, docs, SF).cache()
    bad = {r.doc_id for r in toxicity.score_documents(docs, toxicity.train(docs, labels)).filter("toxic").collect()}
    kept = clean.collect()
    assert {r.doc_id for r in kept} == {r.doc_id for r in docs.collect()} - bad

    one = cp.drop_near_duplicates(spark, clean, SF).cache()
    classes = brute([(r.doc_id, r.text) for r in kept], 5, 80)
    assert sorted(r.doc_id for r in one.collect()) == sorted(d for d, n, c, _ in classes if d == c)

    safe = cp.mask_personal_data(spark, one, SF).cache()
    assert not any(find(r.text, {})[0] for r in safe.collect())
    assert safe.count() == one.count()

    mixed = cp.mix_sources(spark, safe, SF).cache()
    sizes, taken, longest = Counter(), Counter(), Counter()
    for r in safe.collect():
        sizes[r.source] += len(words(r.text))
        longest[r.source] = max(longest[r.source], len(words(r.text)))
    for r in mixed.collect():
        taken[r.source] += len(words(r.text))
    for s, t in plain_targets(sizes).items():  # whole texts: off by half a document at most
        assert abs(taken[s] - t) <= longest[s] / 2 + 1e-6
    assert set(mixed.collect()) <= set(safe.collect())
    for stage in (clean, one, safe, mixed):
        assert stage.columns == columns

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter((r.doc_id, tuple(library.encode_ordinary(r.text)), hashlib.sha256(r.text.encode()).hexdigest()) for r in mixed.collect())
    assert Counter((r.doc_id, tuple(r.token_ids), r.decoded_sha256) for r in cp.encode(spark, mixed, SF).collect()) == want


def test_duplicates_with_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(4, text, "s"), (2, text + " x", "s"), (None, text, "s"), (4, text, "s"), (7, None, "s"), (8, "", "s"), (8, "", "s"), (9, "alone here", None), (9, "other words stand here now", None), (None, "only null ids", "s"), (None, "only null ids", "s")]
    df = spark.createDataFrame([(*r, "en", 1, 5) for r in rows], "doc_id long, text string, source string, lang string, n_chars long, k int")
    out = sorted(((r.doc_id, r.text) for r in cp.drop_near_duplicates(spark, df, SF).collect()), key=str)
    assert out == sorted([(2, text + " x"), (7, None), (8, ""), (8, ""), (9, "alone here"), (9, "other words stand here now"), (None, "only null ids")], key=str)
    empty = df.limit(0)
    for stage in (cp.drop_near_duplicates, cp.mask_personal_data, cp.mix_sources):
        assert stage(spark, empty, SF).columns == df.columns and stage(spark, empty, SF).count() == 0


def test_clashing_names(spark):
    rows = [(i, f"some words that stand in text {i % 7} and nowhere else", "s", i, str(i), i, i) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, near_key long, mix_key string, k int, row int")
    for stage in (cp.drop_near_duplicates, cp.mask_personal_data, cp.mix_sources):
        out = stage(spark, df, SF)
        assert out.columns == df.columns and out.count() and {tuple(r) for r in out.collect()} <= set(rows)


def test_odd_tables_through_run(spark, tmp_path):
    """Null sources and texts, and a table without rows, go through all stages."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    odd = docs.withColumn("source", F.when(F.col("doc_id") % 3 > 0, F.col("source"))).withColumn("text", F.when(F.col("doc_id") % 5 > 0, F.col("text")))
    for name, table in (("odd", odd), ("none", docs.limit(0))):
        table.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    assert cp.run(spark, f"{tmp_path}/odd").count() > 0
    assert cp.run(spark, f"{tmp_path}/none").count() == 0


def test_run(spark):
    out = cp.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "n_tokens", "token_ids"} <= set(out.columns)
