"""Vector codes against exhaustive integer k-means; the trees against plain sums."""

import hashlib
import random

import numpy as np
import pytest

from orderloom.llm import vectorcodes as vc


def brute(rows, parts, entries, rounds):
    """rows: (vec_id, vector, label) in any order."""
    kept = [(i, v, c) for i, v, c in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    ints = [(i, [int(np.floor(np.float64(np.float32(x)) * 1024)) for x in v], c) for i, v, c in kept]
    ints.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if ints:
        ints = [r for r in ints if len(r[1]) == len(ints[0][1])]
    width = len(ints[0][1]) // parts if ints else 0
    cut = [[r[1][p * width : (p + 1) * width] for r in ints] for p in range(parts)]
    books = [[list(x) for x in c[:entries]] for c in cut]

    def assign(book, part):
        return [min(range(len(book)), key=lambda e: (sum((a - b) ** 2 for a, b in zip(book[e], x)), e)) for x in part]

    for _ in range(rounds):
        for p in range(parts):
            of = assign(books[p], cut[p])
            for e in range(len(books[p])):
                mine = [x for x, o in zip(cut[p], of) if o == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    final = [assign(books[p], cut[p]) for p in range(parts)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, per_label = [], {}
    for k, (i, _, label) in enumerate(ints):
        error = sum(sum((a - b) ** 2 for a, b in zip(books[p][final[p][k]], cut[p][k])) for p in range(parts))
        per_label[label] = per_label.get(label, 0) + error
        out.append((i, "".join(f"{final[p][k]:02x}" for p in range(parts)), error, label))
    return sorted(((i, c, e, per_label[label], digest) for i, c, e, label in out), key=str)


def spark_rows(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1.5) for r in rows], "vec_id long, embedding array<float>, label int, error double").repartition(3)
    coded, books = vc.compress(df, **options)
    found = vc.with_label_errors(coded)
    return sorted([(r.vec_id, r.code, r.error, r.label_error, vc.digest(books)) for r in found.collect()], key=str)


def clouds(rng, n, width, spread):
    centres = rng.normal(size=(6, width))
    v = centres[rng.integers(0, 6, n)] + rng.normal(size=(n, width)) * spread
    return [(int(i), [float(x) for x in row], int(rng.integers(0, 4)) if i % 7 else None) for i, row in enumerate(v)]


@pytest.mark.parametrize("seed,spread,block", [(1, 0.05, 70), (2, 1.0, 4096), (3, 0.002, 33)])
def test_exhaustive(spark, seed, spread, block):
    rng = np.random.default_rng(seed)
    rows = clouds(rng, 220, 8, spread)
    rows += [(900 + i, rows[5][1], 3) for i in range(40)]  # one vector over and over
    rows += [(3, rows[9][1], 1), (3, rows[8][1], 1), (None, rows[2][1], None)]
    rows += [(950, None, 1), (951, [float("nan")] * 8, 1), (952, [1.0] * 7 + [None], 2), (953, [float("inf")] * 8, 1), (954, [1.0] * 4, 1)]
    random.Random(seed).shuffle(rows)
    got = spark_rows(spark, rows, parts=4, entries=24, rounds=4, block=block)
    assert got == brute(rows, 4, 24, 4)


def test_grid_ties(spark):
    """Integer grids have many equal distances and equal entries."""
    rng = random.Random(5)
    rows = [(i, [rng.randrange(-3, 4) / 1024 for _ in range(4)], i % 3) for i in range(300)]
    assert spark_rows(spark, rows, parts=2, entries=40, rounds=3, block=64) == brute(rows, 2, 40, 3)


def test_few_and_none(spark):
    rows = [(1, [0.5, -0.5], 1), (2, [0.25, 0.75], 2)]
    assert spark_rows(spark, rows, parts=2) == brute(rows, 2, 256, 4)
    assert spark_rows(spark, [(1, None, 1)]) == []
    with pytest.raises(ValueError):
        spark_rows(spark, rows, parts=4)


def test_empty_vectors(spark):
    assert [r[:4] for r in spark_rows(spark, [(1, [], 1), (2, [], None)])] == [(1, "00000000", 0, 0), (2, "00000000", 0, 0)]


@pytest.mark.parametrize("seed,kind", [(1, "normal"), (2, "line"), (3, "equal"), (4, "grid")])
def test_tree(seed, kind):
    rng = np.random.default_rng(seed)
    points = (rng.normal(size=(700, 3)) * 500).astype(np.int64)
    if kind == "line":
        points[:, 1:] = 0
        points[:, 0] = 2 ** (np.arange(700) % 20)
    if kind == "equal":
        points[:] = 7
    if kind == "grid":
        points = rng.integers(0, 5, (700, 3))
    weights = rng.integers(1, 9, 700)
    tree = vc.build_tree(points, weights, leaf=5)
    assert sorted(tree["order"].tolist()) == list(range(700))
    for b in range(len(tree["begin"])):
        own = tree["order"][tree["begin"][b] : tree["end"][b]]
        assert tree["count"][b] == weights[own].sum()
        assert (tree["sum"][b] == (points[own] * weights[own, None]).sum(0)).all()
        assert (np.linalg.norm(points[own] - tree["centre"][b], axis=1) <= tree["radius"][b] + 1e-9).all()
        if tree["left"][b] >= 0:
            x, y = tree["left"][b], tree["right"][b]
            assert (tree["begin"][x], tree["end"][x], tree["end"][y]) == (tree["begin"][b], tree["begin"][y], tree["end"][b])
    book = points[rng.integers(0, 700, 60)]
    want = ((points[:, None, :] - book[None]) ** 2).sum(2).argmin(1)
    assert vc.codes(tree, points, book).tolist() == want.tolist()


def test_balls_are_owned():
    """Well separated clouds are given to their entries without looking at points."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(8, 4)) * 100_000
    points = (np.repeat(centres, 200, 0) + rng.normal(size=(1600, 4)) * 30).astype(np.int64)
    tree = vc.build_tree(points, np.ones(1600, np.int64))
    balls, entries, places, _ = vc.nearest_entries(tree, points, centres.astype(np.int64))
    assert not len(places) and len(balls) < 40
    assert sorted(set(entries.tolist())) == list(range(8))
