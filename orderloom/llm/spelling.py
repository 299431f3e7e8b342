"""Spelling variants by reduced-alphabet generation.

1. Words are counted per task in a bounded table before they are shuffled. A damaged run (one whose checksum is divisible by ``EVERY``) counts under
   what is left when one of its code points is taken out.
2. Every letter is hashed to one of a few symbols. Words one edit apart have reduced words at most one edit apart, so the one-edit neighbourhood
   of every distinct reduced word is generated and joined with the reduced vocabulary. A pair of reduced words meets once: from the
   neighbourhood of the longer one, or of the greater one at equal lengths, so insertions need not be written.
3. The original words of two reduced words that met are compared; only words exactly one inserted, deleted or replaced code point apart stay.
4. A neighbourhood grows with the square of the word's length. Runs of over ``LONG`` code points meet instead on their unchanged half: one edit leaves the
   first or the second half as it is.
5. Forms are followed to their roots by pointer doubling; counts grow at least fivefold with every step, so few rounds are needed.

Edge cases: null and empty texts have no words; a null ``doc_id`` is written as nothing before the colon; repeated rows count again; ties between near words
go to the smallest in code-point order; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import documents, keep

EVERY = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
LIFT = 5
LONG = 48
HELD = 200_000
CHUNK = 1 << 20
SYMBOLS = "abcdefghijkl"

_LETTERS = "".join(map(chr, [*range(97, 123), *range(0xC0, 0x100)]))
_REDUCED = "".join(SYMBOLS[ord(c) % len(SYMBOLS)] for c in _LETTERS)
# On lower-cased UTF-8: U+00C0 to U+00FF are the byte C3 and one of 80 to BF.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
_OUTSIDE = re.compile(rb"[^a-z\x80-\xbf\xc3]")


def without_one(run: bytes, k: int) -> bytes:
    """The run without its k-th code point."""
    text = run.decode()
    return (text[:k] + text[k + 1 :]).encode()


def _runs(text: bytes) -> Iterator[list[bytes]]:
    """Lists of the runs of a lower-cased text, about ``CHUNK`` bytes at a time; a chunk ends outside of any run."""
    at = 0
    while at < len(text):
        stop = len(text)
        if stop - at > CHUNK:
            end = _OUTSIDE.search(text, at + CHUNK)
            stop = end.start() if end else stop
        yield _RUN.findall(text, at, stop)
        at = stop


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences per word of enough code points, summed over as many texts as the bounded table holds."""
    held: Counter[bytes] = Counter()

    def flush() -> pa.RecordBatch:
        words, n = pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())
        held.clear()
        return pa.RecordBatch.from_arrays([words, n], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for runs in _runs((text or "").encode().lower()):
                for run, n in Counter(runs).items():
                    if len(run) < LEAST_LENGTH:  # in bytes, of which there are no fewer than code points
                        continue
                    h = zlib.crc32(run, prefix)
                    length = len(run) - run.count(b"\xc3")
                    if h % EVERY == 0:
                        run, length = without_one(run, h % length), length - 1
                    if length >= LEAST_LENGTH:
                        held[run] += n
                if len(held) >= HELD:
                    yield flush()
    if held:
        yield flush()


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words with enough code points and occurrences."""
    return (
        docs.select("doc_id", "text").mapInArrow(_count, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)
    )


def neighbourhood(r: Column) -> Column:
    """The reduced word, and what one deletion or one replacement by a smaller symbol makes of it."""
    places = F.sequence(F.lit(1), F.length(r))
    before = lambda i: F.substring(r, F.lit(1), i - 1)
    after = lambda i: F.substring(r, i + 1, F.length(r))
    deleted = F.transform(places, lambda i: F.concat(before(i), after(i)))
    symbols = F.array(*map(F.lit, SYMBOLS))
    replaced = F.transform(
        places,
        lambda i: F.transform(F.filter(symbols, lambda s: s < F.substring(r, i, F.lit(1))), lambda s: F.concat(before(i), s, after(i))),
    )
    return F.array_distinct(F.concat(F.array(r), deleted, F.flatten(replaced)))


def _one_edit(a: str, b: str) -> Column:
    return F.levenshtein(a, b, 1) == 1


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): every two near words of ``words`` (word, n) once."""
    length = F.length("word")
    reduced = keep(
        words.filter(length <= LONG).withColumn("r", F.translate("word", _LETTERS, _REDUCED)).select("r", "word", "n"), "spelling-reduced"
    )
    symbols = reduced.select("r").distinct()
    met = symbols.select("r", F.explode(neighbourhood(F.col("r"))).alias("g")).join(symbols.select(F.col("r").alias("g")), "g")
    a = reduced.select("r", F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = reduced.select(F.col("r").alias("g"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    short = (
        met.join(a, "r").join(b, "g")
        .filter(((F.col("r") != F.col("g")) | (F.col("a") < F.col("b"))) & _one_edit("a", "b"))
        .select("a", "a_n", "b", "b_n")
    )
    # ``size`` is the length of the shorter word of a pair; a word may be either.
    halves = (
        words.filter(length >= LONG)
        .withColumn("size", F.explode(F.array(length, length - 1)))
        .withColumn("half", F.floor(F.col("size") / 2).cast("int"))
        .withColumn("first", F.explode(F.array(F.lit(True), F.lit(False))))
        .withColumn(
            "part", F.sha2(F.when(F.col("first"), F.expr("left(word, half)")).otherwise(F.expr("right(word, size - half)")), 256)
        )
        .select("size", "first", "part", "word", "n")
    )
    x = halves.select("size", "first", "part", F.col("word").alias("a"), F.col("n").alias("a_n"))
    y = halves.select("size", "first", "part", F.col("word").alias("b"), F.col("n").alias("b_n"))
    some_long = (F.length("a") > LONG) | (F.length("b") > LONG)
    long_ = (
        x.join(y, ["size", "first", "part"])
        .filter((F.col("a") < F.col("b")) & some_long & _one_edit("a", "b"))
        .select("a", "a_n", "b", "b_n").distinct()
    )
    return short.union(long_)


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of every row of ``links`` (word, form): the last form reached. Forms must lead to no word twice."""
    now = keep(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        step = now.join(onward, F.col("root") == F.col("at"), "left")
        if step.filter("at is not null").isEmpty():
            return now
        now = keep(step.select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs`` (doc_id, text)."""
    words = keep(vocabulary(docs), "spelling-words")
    pairs = keep(near_pairs(words), "spelling-pairs")
    sides = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).union(
        pairs.select("b", "a", "a_n")
    )
    best = sides.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best")
    )
    large = -F.col("best.minus") >= LIFT * F.col("n")
    formed = keep(
        words.join(best, "word", "left").select(
            "word",
            F.when(large, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(large, -F.col("best.minus")).alias("form_n"),
        ),
        "spelling-forms",
    )
    last = roots(formed.filter("form is not null"))
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """Contract query: every frequent word with its form and root."""
    return spelling_variants(documents(spark, sf_dir))
