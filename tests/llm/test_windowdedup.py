"""Removal of repeated windows against brute force; symbols of equal windows against each other."""

import hashlib
import random
import re

import numpy as np
import pytest

from orderloom.llm import recompression as rc
from orderloom.llm import windowdedup as wd
from orderloom.llm.common import mixed


def brute(rows, window):
    least, split = {}, []
    for doc, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        split.append((doc, w))
        for i in range(len(w) - window + 1 if doc is not None else 0):
            key = tuple(w[i : i + window])
            least[key] = min(least.get(key, doc), doc)
    out = []
    for doc, w in split:
        gone = set()
        for i in range(len(w) - window + 1 if doc is not None else 0):
            if least[tuple(w[i : i + window])] < doc:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, size=70):
    rng = random.Random(seed)
    vocab = ["a", "b", "Ünï", "the", " x", "B"][: 2 + seed]
    text = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", "\n", " \t"]) for _ in range(n))
    passages = [text(rng.randrange(8, 60)) for _ in range(5)]
    texts = []
    for _ in range(size):
        kind = rng.random()
        if texts and kind < 0.3:
            w = rng.choice(texts).split(" ")
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = "new"
            texts.append(" ".join(w))
        elif kind < 0.4:
            texts.append(rng.choice(["a ", "a b ", "a b b "]) * rng.randrange(1, 60))
        else:
            texts.append("".join(text(rng.randrange(1, 40)) + rng.choice(passages) for _ in range(rng.randrange(1, 4))) + text(rng.randrange(9)))
    ids = rng.sample(range(-50, 500), len(texts))
    rows = list(zip(ids, texts))
    return rows + [(501, None), (502, ""), (503, " \n "), (None, texts[0]), (ids[3], texts[3]), (ids[3], texts[3]), (ids[4], texts[5]), (504, "w " * 20)]


@pytest.mark.parametrize("window,seed", [(13, 1), (13, 4), (3, 2), (1, 3), (5, 3)])
def test_all_windows(spark, monkeypatch, window, seed):
    monkeypatch.setattr(wd, "HELD", 50 if seed < 3 else 1 << 19)
    monkeypatch.setattr(wd, "HOT", 6 if seed in (1, 3) else 10_000)
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, 7, "x", 2) for r in rows], "doc_id long, text string, tid int, s string, key int").repartition(4)
    got = sorted([tuple(r) for r in wd.remove_repeated_windows(df, window).collect()], key=str)
    assert got == brute(rows, window)


def test_planted(spark):
    """A passage of over 50 words in many documents stays in the first; clean ones are left alone."""
    rng = random.Random(6)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**7)}" for _ in range(n))
    passage = fresh(55)
    rows = [(i, f"{fresh(80)} {passage} {fresh(30)}" if i % 3 == 0 else fresh(120)) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r.doc_id: r.n_removed for r in wd.remove_repeated_windows(df).collect()}
    assert found == {i: 55 if i % 3 == 0 and i else 0 for i in range(90)}


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id int, text string")
    found = wd.remove_repeated_windows(df)
    assert found.count() == 0 and dict(found.dtypes)["doc_id"] == "int"


@pytest.mark.parametrize("vocab,window", [(1, 13), (2, 13), (3, 7), (40, 13), (5, 2), (9, 1)])
def test_equal_windows_have_equal_symbols(vocab, window):
    rng = np.random.default_rng(vocab)
    row = np.sort(rng.integers(0, 30, 3000))
    names = mixed(rng.integers(0, vocab, 3000).astype(np.uint64))
    names[1000:1400] = names[200:600]
    of, key, anchor, first, last = rc.occurrences(names, row, 31, window)
    seen, windows = {}, 0
    for k, a, p, q in zip(key.tolist(), anchor.tolist(), first.tolist(), last.tolist()):
        for i in range(p, q + 1):
            windows += 1
            assert row[i] == row[i + window - 1]
            assert seen.setdefault(tuple(names[i : i + window].tolist()), (k, a - i)) == (k, a - i)
    assert windows == sum(max(0, n - window + 1) for n in np.bincount(row))


def test_symbols_name_their_words():
    """Equal names stand for equal words, and long contexts are left out."""
    rng = np.random.default_rng(3)
    names = mixed(rng.integers(0, 3, 4000).astype(np.uint64))
    row = np.repeat(np.arange(4), 1000)
    s, e, cs, ce, name = rc.symbols(names, row, 13)
    assert (ce - cs <= 13).all() and (cs < s).any() and (e - s > 3).any()
    seen = {}
    for a, b, k in zip(s.tolist(), e.tolist(), name.tolist()):
        assert seen.setdefault(k, tuple(names[a:b])) == tuple(names[a:b])
