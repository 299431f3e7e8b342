"""Targets against plain water filling, quotas and draws against their rules, rows of the mix."""

import random
import re

from pyspark.sql import functions as F

from orderloom.llm.mixing import mix, mix_plan, source_targets, split_quotas, taken_words


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, left, target = sum(sizes.values()), set(names), dict.fromkeys(names, 0.0)
    rest = float(total)
    while left and rest > 1e-9:
        w = sum(weight[s] for s in left)
        share = {s: rest * weight[s] / w for s in left}
        over = {s for s in left if target[s] + share[s] >= 3 * sizes[s]}
        rest = 0.0
        for s in left:
            target[s] += share[s]
            if target[s] > 3 * sizes[s]:
                rest += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
        left -= over
    return target


def corpus(n, seed=1):
    rng = random.Random(seed)
    sources = ["big"] * 60 + ["a", "é", "z", "Z", None, "tiny", "none"]
    rows = []
    for i in range(n):
        source = rng.choice(sources)
        size = 0 if source == "none" else rng.randrange(1, 80 if source != "tiny" else 3)
        rows.append((i, " ".join(f"w{rng.randrange(99)}" for _ in range(size)), source))
    return rows + [(n, None, "big"), (n + 1, " \t", "a"), (None, "x y z", None), (5, "same row here", "z"), (5, "same row here", "z"), (n + 2, "w " * 20_000, "é")]


def test_targets(spark):
    rng = random.Random(7)
    for case in range(6):
        names = [None, "é", "b", "Z", "a", *(f"s{i}" for i in range(case * 3))]
        sizes = {s: rng.choice([0, 1, 5, 100, 10_000, 250_000]) for s in names}
        got = source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
        want = plain_targets(sizes)
        assert {r.source: round(r.target, 3) for r in got} == {s: round(t, 3) for s, t in want.items()}


def test_taken(spark):
    rows = corpus(3000)
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size int, block int").repartition(5)
    out = taken_words(mix_plan(df)).collect()
    assert len(out) == len(rows)
    sizes, taken, target = {}, {}, {}
    for r in out:
        assert 0 <= r.taken <= 3 * r.size
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    want = plain_targets(sizes)
    longest = {s: max(r.size for r in out if r.source == s) for s in sizes}
    for s, t in want.items():
        assert abs(target[s] - t) < 1e-6 * max(1, t)
        assert abs(taken[s] - t) <= longest[s] / 2 + 1e-6, (s, taken[s], t)
    again = taken_words(mix_plan(df.repartition(2))).select("doc_id", "taken").collect()
    assert sorted(map(str, again)) == sorted(str(r) for r in [type(again[0])(doc_id=r.doc_id, taken=r.taken) for r in out])
    assert mix_plan(df.limit(0)).count() == 0 and mix(df.limit(0)).count() == 0


def test_tree_quotas(spark):
    units = spark.createDataFrame([(s, b, c) for s, n in (("a", 40), ("b", 200), (None, 17)) for b in range(n) for c in range(2)], "source string, block int, copy int")
    turns = split_quotas(units, 3, 5)
    per_shard = {r.shard: r["count"] for r in turns.groupBy("shard").count().collect()}
    assert set(per_shard) == set(range(8)) and max(per_shard.values()) - min(per_shard.values()) <= 3
    assert {r.source: r["count"] for r in turns.groupBy("source").count().collect()} == {"a": 80, "b": 400, None: 34}
    assert turns.groupBy("source").agg(F.countDistinct("turn").alias("n"), F.max("turn").alias("m")).filter("n <> m").count() == 0


def test_rows_of_the_mix(spark):
    rows = corpus(800, 4)
    df = spark.createDataFrame([(*r, len(r[1] or ""), "en", 9) for r in rows], "doc_id long, text string, source string, n_chars long, lang string, words int")
    plan = {}
    named = df.withColumn("mix_key", F.xxhash64("doc_id", "text"))
    doc = {r.mix_key: r.doc_id for r in named.select("mix_key", "doc_id").collect()}
    for r in mix_plan(named, ("mix_key",)).collect():
        plan.setdefault(doc[r.mix_key], []).extend(d["words"] for d in r.draws)
    got = {}
    texts = {}
    for r in mix(df).collect():
        got.setdefault(r.doc_id, []).append(len(words(r.text)))
        texts.setdefault(r.doc_id, []).append(r.text)
        assert r.n_chars == len(r.text)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in plan.items() if v}
    known = {(doc, text) for doc, text, _ in rows}
    assert all((doc, t) in known for doc, ts in texts.items() for t in ts)
    assert mix(df).columns == df.columns


def test_only_whole_texts(spark):
    rows = corpus(3000, 6)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    known = {(doc, text) for doc, text, _ in rows}
    mixed = mix(df, blocks=4).collect()
    assert all((r.doc_id, r.text) in known for r in mixed)
    assert len({(r.doc_id, r.text) for r in mixed if r.source == "big"}) < sum(s == "big" for _, _, s in rows)  # its quota ends inside a block
    named = df.withColumn("mix_key", F.xxhash64("doc_id", "text"))
    plan = taken_words(mix_plan(named, ("mix_key",), blocks=4)).collect()
    assert sum(r.taken for r in plan) == sum(len(words(r.text)) for r in mixed)
    for source in {s for *_, s in rows}:
        own = [r for r in plan if r.source == source]
        longest = max(r.size for r in own)
        assert all(r.taken % r.size == 0 for r in own if r.size)
        assert abs(sum(r.taken for r in own) - own[0].target) <= longest / 2 + 1e-6, source


def test_clashing_names(spark):
    """Columns of the input keep their names and values, whatever they are called."""
    rows = [(*r, 100 + i, f"m{i}", i, i) for i, r in enumerate(corpus(300, 8))]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_key long, mix_draw string, row int, draw int")
    out = mix(df)
    assert out.columns == df.columns
    assert {tuple(r) for r in out.collect()} <= set(rows) and out.count() > 100
