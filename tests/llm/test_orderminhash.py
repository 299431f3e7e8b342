"""Order MinHash against a plain version, likeness against edits, successors across partitions."""

import hashlib
import random

import numpy as np
import pyarrow as pa

from orderloom.llm.common import mixed, word_hashes
from orderloom.llm.orderminhash import _C, _ODD, _SEEDS, HASHES, K, TUPLE, compare_with_next, edited, fingerprints, likeness, signatures

ONES = (1 << 64) - 1


def mix(x):
    return int(mixed(np.array([x & ONES], np.uint64))[0])


def plain(text):
    """The same fingerprint element by element."""
    raw = text.encode()
    words = [int(h) for h in word_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), lower=False)[0]]
    size = min(K, len(words))
    found, seen = [], {}
    for i in range(max(len(words) - K + 1, 1) if words else 0):
        value = size
        for w in words[i : i + size]:
            value = mix(value * int(_C) + w)
        seen[value] = seen.get(value, -1) + 1
        found.append((value, mix(value + seen[value] * int(_C))))
    out = []
    for s, seed in enumerate(_SEEDS.tolist()):
        def rank(i):
            y = ((found[i][1] ^ seed) * int(_ODD)) & ONES
            y ^= y >> 32
            return ((y * int(_ODD)) & ONES) & ~((1 << len(found).bit_length()) - 1), i
        picks = sorted(sorted(range(len(found)), key=rank)[:TUPLE])
        h = s + 1
        for t in range(TUPLE):
            h = mix(h * int(_C) + (found[picks[t]][0] if t < len(picks) else 0))
        out.append(max(h >> 48, 1) if found else 0)
    return out


def test_against_plain_version():
    rng = random.Random(1)
    texts = ["", " ", "one", "a b", "a a a a a a", "x y x y x y x"] + [" ".join(rng.choice("abcdefg") for _ in range(rng.randrange(40))) for _ in range(30)]
    for text in texts:
        assert signatures(pa.array([text]))[0].tolist() == plain(text), text


def test_likeness_follows_edits():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(600)]
    base = " ".join(words)
    near = " ".join(words[:590] + ["new"] * 10)
    half = " ".join(words[:300] + words[:300][::-1])
    moved = " ".join(words[300:] + words[:300])
    other = " ".join(reversed(words))
    s = signatures(pa.array([base, base, near, half, moved, other, None]))
    like = [float(likeness(s[:1], s[i : i + 1])[0]) for i in range(7)]
    assert like[1] == 1 and like[2] > 0.85 and 0.05 < like[3] < 0.6 and like[5] < 0.1 and like[6] == 0
    assert like[4] < like[2]  # the same words in another order are less alike


def test_successors(spark):
    rng = random.Random(3)
    rows = [(i * 3, " ".join(rng.choice(["é", "bb", "ccc", "d"]) for _ in range(rng.randrange(30)))) for i in range(200)]
    rows += [(None, "last é"), (9, "z again"), (603, None)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], "doc_id long, text string, kind int, pid string").repartition(6)
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want = set()
    for i, (doc, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        change = edited(text, following)
        a, b, c = signatures(pa.array([text, change, following]))
        near = lambda x, y: float((x == y).mean())
        want.add((doc, len(text), hashlib.sha256(change.encode()).hexdigest(), near(a, b), near(a, c)))
    got = compare_with_next(df).collect()
    assert len(got) == len(order)
    assert {(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got} == want
    assert {len(r.fingerprint) for r in got} == {4 * HASHES}
    single = compare_with_next(df.filter("doc_id = 3")).collect()
    assert len(single) == 1 and single[0].near_next == 1
    assert compare_with_next(df.limit(0)).count() == fingerprints(df.limit(0)).count() == 0
    assert fingerprints(df).count() == len(order)
