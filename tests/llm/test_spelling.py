"""Spelling variants against a brute-force version over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orderloom.llm import spelling as sp


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long_ = sorted((a, b), key=len)
    return any(long_[:i] + long_[i + 1 :] == short for i in range(len(long_)))


def brute(rows):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}
    forms, out = {}, []
    for w, n in words.items():
        found = [x for x in words if near(w, x)]
        best = min(found, key=lambda x: (-words[x], x.encode()), default=None)
        forms[w] = (best if best and words[best] >= 5 * n else None), len(found)
    for w, (form, n_near) in forms.items():
        root = w
        while forms[root][0]:
            root = forms[root][0]
        out.append((w, form, root, words[w], n_near, words.get(form)))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    letters = "abcdeîéñÿZQ" if seed % 2 else "ab"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randrange(5, 11))) for _ in range(25)]
    stems += [stems[0] * 9, "x" * 47, "x" * 48, "x" * 49, "y" * 60, "y" * 30 + "z" + "y" * 29, "y" * 59, "×÷×÷×÷", "×÷×÷×"]
    for s in list(stems):  # variants, and variants of variants
        k = rng.randrange(len(s))
        stems += [s[:k] + s[k + 1 :], s[:k] + "q" + s[k:], s[:k] + "w" + s[k + 1 :]]
    weight = [rng.choice([1, 1, 6, 40, 300]) for _ in stems]
    rows = [(i, " ".join(rng.choices(stems, weight, k=120))) for i in range(60)]
    return rows + [(None, rows[0][1]), (3, rows[3][1]), (3, rows[3][1]), (700, None), (701, ""), (702, "a1b2,c"), (703, stems[0].upper() + " " + "b" * 9000)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_all_pairs(spark, monkeypatch, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, "c", 5) for r in rows], "doc_id long, text string, word string, n int").repartition(3)
    assert sorted(map(tuple, sp.spelling_variants(df).collect())) == brute(rows)


def test_small_tables(spark, monkeypatch):
    """Counts do not depend on how often the table is flushed or where a text is cut."""
    monkeypatch.setattr(sp, "HELD", 3)
    monkeypatch.setattr(sp, "CHUNK", 10)
    rows = corpus(5)[:8] + [(9, "chained Chainéd chainéds " * 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = Counter()
    for batch in df.toArrow().to_batches():
        for part in sp._count(iter([batch])):
            for w, n in zip(part.column("word").to_pylist(), part.column("n").to_pylist()):
                got[w] += n
    want = {w: n for w, _, _, n, _, _ in brute(rows)}
    assert {w: n for w, n in got.items() if n >= 5} == want


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    found = sp.spelling_variants(df)
    assert found.count() == 0
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_long_chain(spark):
    links = spark.range(40).select(F.col("id").cast("string").alias("word"), (F.col("id") + 1).cast("string").alias("form"))
    assert {r.root for r in sp.roots(links).collect()} == {"40"}


def test_neighbourhoods_meet(spark):
    """Reduced words one edit apart meet from the longer or greater one."""
    rng = random.Random(4)
    words = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) for _ in range(80)}
    df = spark.createDataFrame([(w,) for w in words], "r string").select("r", F.explode(sp.neighbourhood(F.col("r"))).alias("g"))
    met = [(r.r, r.g) for r in df.collect() if r.g in words]
    assert len(met) == len(set(met))
    want = {frozenset((a, b)) for a in words for b in words if near(a, b)} | {frozenset([a]) for a in words}
    assert {frozenset(p) for p in met} == want
