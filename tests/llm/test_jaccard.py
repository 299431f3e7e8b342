"""The Jaccard join against all pairs, the tree against all pairs, components against union-find."""

import random
import re

import numpy as np
import pytest

from orderloom.llm import jaccard
from orderloom.llm.components import components


def brute(rows, n, percent):
    """component_id and number of links per row."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                inter = len(sets[i] & sets[j])
                if 100 * inter >= percent * (len(sets[i]) + len(sets[j]) - inter):
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for d in groups[find(i)] if d is not None]
        out.append((doc, len(sets[i]), min(ids) if ids else None, links[i]))
    return sorted(out, key=str)


def corpus(seed, size=400):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 6))) for _ in range(400)]
    shared = " ".join(rng.choice(vocabulary) for _ in range(30))
    texts = []
    for _ in range(size):
        kind = rng.random()
        if texts and kind < 0.45:
            w = rng.choice(texts).split(" ")
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            texts.append(" ".join(w[: len(w) - rng.randrange(3)] or w))
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 12, 40, 90, 300]))]
            texts.append(" ".join(words) + (" " + shared if rng.random() < 0.3 else ""))
    rows = [(i * 7 % size, t) for i, t in enumerate(texts)]
    rows += [(9000, ""), (9001, " \t\n"), (9002, None), (None, texts[0]), (3, texts[5]), (3, texts[5]), (None, "only one here"), (9003, texts[7].upper())]
    return rows


@pytest.mark.parametrize("n,percent,seed", [(3, 90, 1), (5, 80, 2), (3, 60, 3)])
def test_all_pairs(spark, n, percent, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, set_id int, cluster string").repartition(5)
    got = sorted([tuple(r) for r in jaccard.jaccard_classes(df, n, percent).collect()], key=str)
    assert got == brute(rows, n, percent)


def test_chunked_units(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK_SETS", 7)
    monkeypatch.setattr(jaccard, "KEYS_HELD", 50)
    rows = corpus(8, 200)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted([tuple(r) for r in jaccard.jaccard_classes(df, 3, 90).collect()], key=str) == brute(rows, 3, 90)
    assert jaccard.jaccard_classes(df.limit(0)).count() == 0


def test_few_long_sets_in_chunks(spark, monkeypatch):
    """Clusters of two or three sets in several chunks, some of them empty: every link counts once."""
    monkeypatch.setattr(jaccard, "CHUNK_TOKENS", 100)
    rows = []
    for group in range(12):
        words = [f"g{group}w{k}" for k in range(90)]
        rows += [(10 * group + k, " ".join([*words, *(f"x{group}y{k}z{e}" for e in range(k))])) for k in range(2 + group % 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted([tuple(r) for r in jaccard.jaccard_classes(df, 3, 90).collect()], key=str) == brute(rows, 3, 90)


@pytest.mark.parametrize("most_bits", [64, 8192])
def test_tree_loses_no_pair(most_bits):
    rng = np.random.default_rng(1)
    base = [rng.choice(5000, s, replace=False) for s in rng.integers(1, 200, 12)]
    sets = []
    for _ in range(150):
        s = base[rng.integers(12)].copy()
        s[rng.integers(0, len(s), rng.integers(0, 1 + len(s) // 8))] = rng.integers(5000, 9000)
        sets.append(np.unique(s).astype(np.uint64))
    sizes = np.array([len(s) for s in sets])
    got = {(min(a, b), max(a, b)) for x, y in jaccard.unit_links(np.concatenate(sets), sizes, 90, most_bits) for a, b in zip(x.tolist(), y.tolist())}
    want = set()
    for i in range(150):
        for j in range(i + 1, 150):
            inter = len(np.intersect1d(sets[i], sets[j]))
            if 100 * inter >= 90 * (len(sets[i]) + len(sets[j]) - inter):
                want.add((i, j))
    assert got == want and want


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(1000, 1060)] + [(2000, k) for k in range(2001, 2200)]
    label = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(label[a], label[b])
            changed |= label[a] != m or label[b] != m
            label[a] = label[b] = m
    out = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.id: r.root for r in out} == {k: v for k, v in label.items() if k != v}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("percent", [90, 80, 55])
def test_linked_sets_share_a_part(percent):
    """Pairs right at the threshold, from one shingle to thousands, always show a common key."""
    rng = np.random.default_rng(percent)
    for size in [1, 2, 5, 9, 10, 11, 19, 20, 33, 60, 100, 149, 150, 400, 1000, 2500, 6000]:
        for _ in range(6):
            x = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            other = int(rng.integers(size, size * 100 // percent + 1))  # partner's size
            common = -(-percent * (size + other) // (100 + percent))  # least overlap of a link
            if common > size:
                continue
            y = np.concatenate([rng.permutation(x)[:common], rng.integers(0, 1 << 63, other - common, dtype=np.uint64)])
            keys = []
            frequent = np.sort(rng.permutation(x)[: rng.integers(0, size + 1)])
            for s in (x, y):
                s = np.unique(s)
                key, row = jaccard.Parts(percent, len(s)).keys(s, np.array([len(s)]), frequent)
                assert len(key) == len(row) and (row == 0).all()
                keys.append(set(key.tolist()))
            assert keys[0] & keys[1], (size, other, common)
