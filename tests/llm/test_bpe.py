"""Byte-level BPE against the tokenizer library, and the round trip."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from orderloom.llm import bpe
from orderloom.llm.bpe import MergeReplay, encode_documents, read_ranks

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    with open(PATH, "rb") as f:
        return MergeReplay(read_ranks(f.read()), public_tokenizers.PATTERN)


def test_same_ids_as_the_library(library, coder):
    rng = random.Random(4)
    alphabet = "aabbcdeé ñß\n\t\x0b\x1c\x1f\x85\xa0 's'll!!##0192漢字🙂🙂а"
    texts = ["", " ", "a" * 3000, "!" * 999, "abab" * 500, "\n" * 50 + "x", "Ouwhea the of rend", "  two  spaces  "]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 300))) for _ in range(400)]
    for text in texts:
        ids = coder.encode(text)
        assert ids == library.encode_ordinary(text), text
        assert coder.decode(ids).decode() == text


def test_equal_ranks_with_a_lower_new_pair():
    # ab=300, aba=256 (from ab + a): after the first merge the new pair goes first and takes the second "a".
    ranks = {bytes([b]): b for b in range(256)} | {b"aba": 256, b"ab": 300, b"abab": 301}
    reference = tiktoken.Encoding("r", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    own = MergeReplay(ranks, r"\S+")
    for text in ("abababa", "ababab", "aabbaabab", "abaab", "babababab" * 7):
        assert own.encode(text) == reference.encode_ordinary(text)


def test_documents(spark, library):
    rows = [(1, "Hello hello", "x"), (2, None, "y"), (None, "", "z"), (1, "Hello hello", "x"), (5, "é" * 100_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    out = encode_documents(df, PATH, public_tokenizers.PATTERN, with_ids=True).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(out) == 5
    for row, (doc, text, _) in zip(out, rows, strict=True):
        ids = library.encode_ordinary(text or "")
        assert (row.doc_id, row.n_tokens, row.token_ids) == (doc, len(ids), ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert out[1].ids_sha256 == empty
    assert encode_documents(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_forgetting_pieces_changes_nothing(library, coder, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 50)
    monkeypatch.setattr(bpe, "STAY", 20)
    rng = random.Random(6)
    for _ in range(60):
        text = " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9))) for _ in range(40))
        assert coder.encode(text) == library.encode_ordinary(text)
    assert coder.known < 120
