"""Removal of word windows that stand in an earlier document, found by recompression.

A word goes if it is covered by ``WINDOW`` consecutive words that also start, as the same sequence, in a document of smaller doc_id.

1. Naming (see ``recompression``). Each task names the token runs and pairs of its texts, round by round. A name follows from what it names, so
   names agree over the whole corpus without a table. Every window is given the greatest symbol that depends on its words alone.
2. First Spark round: the symbols meet by name, one row per symbol and task with its smallest and largest document. A window whose symbol stands in one
   document only is no repeat. The names of the others go into a bit filter of fixed size.
3. Second Spark round: the windows that passed are verified by all their words. Two windows are equal if they have the same symbol (64 bits, from
   names) and the same hash of the whole window (64 bits, from a second, independent hash of each word). Within a task only the occurrences
   in the window's smallest document are open; all others are answered there. So a passage in a third of all documents costs a few
   rows per task. The open ones meet by symbol, a row per run of windows with the same symbol, and those whose document is not the smallest are
   answered. A symbol with very many places (a common phrase, or the edge of a common passage, which goes on differently in every document) would
   gather in one task: its windows meet one by one, by symbol and hash.
4. Only texts that may lose a word, as told by a bit filter, are shuffled.

Edge cases: null and empty texts have no words (digest of the empty string); rows with a null ``doc_id`` lose nothing and count for no other; rows with
equal doc_ids are one document's: windows they share are no repeats of each other; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import (
    CHECK, bit_filter, documents, flat, keep, may_hold, mixed, pieces, prefix_hashes, signed, span_hashes, window_hashes, words,
)
from orderloom.llm.recompression import occurrences

WINDOW = 13
HELD = 1 << 19  # rows a task gathers before it sends what is left of them
HOT = 10_000  # places from which on a symbol's windows meet by hash


def _leads(*keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _gathered(held: list[tuple]) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*held, strict=True)]


def _windowed(batch: pa.RecordBatch, window: int):
    """Per piece: (doc, tid, data, word starts, ends, rows, names, occurrences)."""
    for part in pieces(batch):
        data, offsets = flat(part.column("text"))
        starts, ends, row = words(data, offsets)
        names = mixed(span_hashes(prefix_hashes(data), starts, ends))
        doc, tid = part.column("doc").to_numpy(), part.column("tid").to_numpy()
        yield doc, tid, data, starts, ends, row, names, occurrences(names, row, part.num_rows, window)


def _show_symbols(window: int):
    """(key, low, high, n): the symbols of the windows, with smallest and largest document and number of places seen in a while."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0

        def flush() -> pa.RecordBatch:
            key, doc = _gathered(held)
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            first = np.flatnonzero(_leads(key))
            last = np.append(first[1:], len(key)) - 1
            columns = signed(key[first]), doc[first], doc[last], last - first + 1
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "low", "high", "n"])

        for batch in batches:
            for doc, _, _, _, _, _, _, (of, key, _, _, _) in _windowed(batch, window):
                if len(of):
                    held.append((key, doc[of]))
                    count += len(of)
                if count >= 2 * HELD:
                    yield flush()
                    held, count = [], 0
        if held:
            yield flush()

    return run


_OPEN, _ANSWERED = 0, 1
_ROWS = "kind byte, meet long, key long, doc long, tid long, s int, e int, hashes binary"


def _rows(kind: int, meet, key, doc, tid, s, e, hashes: np.ndarray) -> pa.RecordBatch:
    """``hashes`` holds those of the windows s to e - 1 of every open row, end to end."""
    n = e - s if kind == _OPEN else np.zeros(len(s), np.int64)
    ends = np.append(0, np.cumsum(8 * n)).astype(np.int32)
    packed = pa.Array.from_buffers(pa.binary(), len(s), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(hashes))])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(s), kind, np.int8)),
            *(pa.array(c) for c in (meet, key, doc, tid)),
            *(pa.array(c.astype(np.int32)) for c in (s, e)),
            packed,
        ],
        ["kind", "meet", "key", "doc", "tid", "s", "e", "hashes"],
    )


def _unpacked(column: pa.Array) -> np.ndarray:
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].copy().view(np.int64) if ends[-1] > ends[0] else np.empty(0, np.int64)


def _spans(doc: np.ndarray, tid: np.ndarray, s: np.ndarray, window: int):
    """Windows of texts merged to spans of words: (doc, tid, s, e)."""
    order = np.lexsort((s, tid, doc))
    doc, tid, s = doc[order], tid[order], s[order]
    new = _leads(doc, tid)
    new[1:] |= s[1:] > s[:-1] + window
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(s)) - 1
    return doc[first], tid[first], s[first], s[last] + window


def _later(key: np.ndarray, h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether each window, told by its symbol and its hash, also stands in a smaller document here."""
    order = np.lexsort((doc, h, key))
    lead = _leads(key[order], h[order])
    out = np.empty(len(doc), bool)
    out[order] = doc[order] > doc[order][lead][np.cumsum(lead) - 1]
    return out


def _show_windows(shared, window: int):
    """Windows whose symbol passed: answered ones as spans, open ones with their hashes, a row per run of windows with one symbol."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, hot = shared.value
        held: list[tuple] = []
        count = 0

        def flush() -> Iterator[pa.RecordBatch]:
            key, h, doc, tid, s, alone = _gathered(held)
            later = _later(key, h, doc)
            if later.any():
                d, t, a, b = _spans(doc[later], tid[later], s[later], window)
                none = np.zeros(len(d), np.int64)
                yield _rows(_ANSWERED, none, none, d, t, a, b, none)
            key, h, doc, tid, s, alone = (c[~later] for c in (key, h, doc, tid, s, alone))
            if len(s):
                new = _leads(key, doc, tid) | alone
                new[1:] |= s[1:] != s[:-1] + 1
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(s)) - 1
                # The windows of a hot symbol meet one by one, all others by symbol.
                apart = signed(mixed(key[first].view(np.uint64) + h[first].view(np.uint64)))
                meet = np.where(alone[first], apart, key[first])
                yield _rows(_OPEN, meet, key[first], doc[first], tid[first], s[first], s[last] + 1, h)

        for batch in batches:
            for doc, tid, data, starts, ends, row, _, (of, key, _, first, last) in _windowed(batch, window):
                go = may_hold(repeated, signed(key)) if len(of) else np.zeros(0, bool)
                if not go.any():
                    continue
                of, key, first, n = of[go], signed(key[go]), first[go], (last - first + 1)[go]
                at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                alone = np.repeat(may_hold(hot, key), n)
                of, key = np.repeat(of, n), np.repeat(key, n)
                checks = mixed(span_hashes(prefix_hashes(data, table=CHECK), starts, ends))
                per_row = np.bincount(row, minlength=len(doc))
                s = at - (np.cumsum(per_row) - per_row)[of]
                held.append((key, signed(window_hashes(checks, at, window)), doc[of], tid[of], s, alone))
                count += len(at)
                if count >= HELD:
                    yield from flush()
                    held, count = [], 0
        if held:
            yield from flush()

    return run


def _meet_windows(window: int):
    """Rows sorted by ``meet``: the spans of answered rows, and of open windows that stand in a smaller document, too."""

    def work(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        key, doc, tid, s, e = (rows.column(c).to_numpy() for c in ("key", "doc", "tid", "s", "e"))
        n = (e - s).astype(np.int64)
        h = np.concatenate([_unpacked(c) for c in rows.column("hashes").chunks] or [np.empty(0, np.int64)])
        of = np.repeat(np.arange(len(n)), n)
        later = _later(key[of], h, doc[of])
        if later.any():
            of = of[later]
            begin = (s - (np.cumsum(n) - n))[of] + np.flatnonzero(later)
            d, t, a, b = _spans(doc[of], tid[of], begin, window)
            columns = [pa.array(d), pa.array(t), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "tid", "s", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.RecordBatch] = []  # rows of the last ``meet`` so far, which may go on
        for batch in batches:
            answered = batch.column("kind").to_numpy() == _ANSWERED
            if answered.any():
                yield batch.filter(pa.array(answered)).select(["doc", "tid", "s", "e"])
            rows = batch.filter(pa.array(~answered))
            if not rows.num_rows:
                continue
            meet = rows.column("meet").to_numpy()
            if pending and pending[0].column("meet")[0].as_py() != meet[0]:
                yield from work(pa.Table.from_batches(pending))
                pending = []
            stop = int(np.searchsorted(meet, meet[-1], "left"))
            if stop:
                yield from work(pa.Table.from_batches([*pending, rows.slice(0, stop)]))
                pending = []
            pending.append(rows.slice(stop))
        if pending:
            yield from work(pa.Table.from_batches(pending))

    return run


def repeated_spans(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, tid, s, e): spans of words to remove; ``texts`` has columns doc (long), tid (a hash of the text) and text."""
    spark = texts.sparkSession
    used = texts.filter("doc is not null and tid is not null").select("doc", "tid", "text")
    symbols = keep(
        used.mapInArrow(_show_symbols(window), "key long, low long, high long, n long")
        .groupBy("key").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
        .filter("low < high").select("key", "n"),
        "window-symbols",
    )
    filters = bit_filter(symbols, "key"), bit_filter(symbols.filter(F.col("n") > HOT), "key")
    shared = spark.sparkContext.broadcast(filters)
    return (
        used.mapInArrow(_show_windows(shared, window), _ROWS)
        # Answered rows are dealt anyhow; only open ones have to meet.
        .repartition(F.when(F.col("kind") == _ANSWERED, F.xxhash64("tid", "s")).otherwise(F.col("meet")))
        .sortWithinPartitions("meet")
        .mapInArrow(_meet_windows(window), "doc long, tid long, s int, e int")
    )


def _kept(data: np.ndarray, offsets: np.ndarray, cuts: pa.Array | None):
    """Word count, removed words and digest of the kept words of every row. ``cuts``: lists of (s, e) per row."""
    starts, ends, row = words(data, offsets)
    rows = len(offsets) - 1
    n = np.bincount(row, minlength=rows)
    gone = np.zeros(len(starts), bool)
    if cuts is not None and len(starts):
        lists = cuts if not cuts.offset else pa.concat_arrays([cuts])
        begin = lists.offsets.to_numpy()
        inner = lists.values.slice(begin[0], begin[-1] - begin[0])
        a, b = (inner.field(k).to_numpy() for k in range(2))
        a, b = (c[begin[0] : begin[-1]] if len(c) != begin[-1] - begin[0] else c for c in (a, b))
        base = np.repeat(np.cumsum(n) - n, np.diff(begin))
        depth = np.zeros(len(starts) + 1, np.int64)
        np.add.at(depth, base + a, 1)
        np.add.at(depth, base + b, -1)
        gone = np.cumsum(depth)[:-1] > 0
    stay = np.flatnonzero(~gone)
    s, e, of = starts[stay], ends[stay], row[stay]
    # Every kept word but a row's last is followed by one space, which takes the place of the white space after it.
    last = np.ones(len(s), bool)
    last[:-1] = of[1:] != of[:-1]
    depth = np.zeros(len(data) + 2, np.int8)
    depth[s] += 1
    depth[e + ~last] -= 1
    mask = np.cumsum(depth, dtype=np.int8)[: len(data)].astype(bool)
    out = data.copy()
    out[e[~last]] = 0x20
    kept = out[mask]
    sizes = np.bincount(of, weights=e - s + ~last, minlength=rows).astype(np.int64)
    stop = np.cumsum(sizes)
    digests = [hashlib.sha256(kept[b - a : b]).hexdigest() for a, b in zip(sizes.tolist(), stop.tolist(), strict=True)]
    return n, np.bincount(row[gone], minlength=rows), digests


_RESULT = "n_words long, n_removed long, kept_sha256 string"


def _result(part: pa.RecordBatch, cuts: pa.Array | None) -> pa.RecordBatch:
    n, removed, digests = _kept(*flat(part.column("text")), cuts)
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(removed.astype(np.int64)), pa.array(digests)],
        ["doc_id", "n_words", "n_removed", "kept_sha256"],
    )


def _untouched(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                part = part.filter(pa.array(~may_hold(shared.value, np.ascontiguousarray(part.column("tid").to_numpy()))))
                if part.num_rows:
                    yield _result(part, None)

    return run


def _touched(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = may_hold(shared.value, np.ascontiguousarray(batch.column("tid").to_numpy()))
            if good.any():
                yield batch.filter(pa.array(good))

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            yield _result(part, part.column("cuts"))


def remove_repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text", F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("tid")
    )
    spans = keep(repeated_spans(texts, window), "window-spans")
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(spans, "tid"))
    schema = f"doc_id {kind}, {_RESULT}"
    clean = texts.select("doc_id", "text", "tid").mapInArrow(_untouched(shared), schema)
    per_text = spans.groupBy("doc", "tid").agg(F.collect_list(F.struct("s", "e")).alias("cuts"))
    passed = texts.mapInArrow(_touched(shared), f"doc_id {kind}, text string, doc long, tid long")
    # Texts with equal hashes and other doc_ids may come along without spans.
    cut = passed.join(per_text, ["doc", "tid"], "left").select(
        "doc_id", "text", F.coalesce("cuts", F.array().cast("array<struct<s:int,e:int>>")).alias("cuts")
    )
    return clean.union(cut.mapInArrow(_cut, schema))


def op13_window_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: windows of 13 words over all documents."""
    return remove_repeated_windows(documents(spark, sf_dir))
