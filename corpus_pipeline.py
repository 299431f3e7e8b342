"""A training corpus from ``documents``: toxic documents and near-duplicates go, personal data is masked, sources are mixed, texts become tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``. SQL cannot express the stages (trained model, sets by hash, merges), so they are tested against
brute-force versions in tests/llm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import bpe, jaccard, mixing, pii, toxicity
from orderloom.llm.common import documents, keep

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of toxicity is below one half, by a model fitted on a bounded sample of ``labels``."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of 5-word shingles at a similarity of 0.8 or more: the one of smallest doc_id."""
    return jaccard.one_per_group(docs, 5, 80)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per draw, all of them whole: documents of a source that is weighted up come more than once."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and digests of every row of the mix."""
    import public_tokenizers

    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = keep(docs, f"corpus-{name}")
    return docs
