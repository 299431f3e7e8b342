"""Document fingerprints by Order MinHash.

The elements of a text are its k-mers of words (as bytes, case kept), each with its occurrence number, so that repeats count. Each of
``HASHES`` hash functions selects the ``TUPLE`` elements of smallest value; they are put back into text order and hashed as a tuple. Two texts
agree in a component if they share the selected elements in the same order, which makes the likeness (share of equal components) sensitive to
edits and moved passages. A component keeps 16 bits in the fingerprint.

The contract query also needs each document's successor by doc_id. Documents are range-partitioned by doc_id and read in order; only the last
document of each partition waits for the first of the next one, a small table of two rows per partition.

Edge cases: null text counts as empty; texts without words have the all-zero fingerprint; a text with fewer than k words has its whole word
sequence as its only element; null ids come last in the order; equal ids follow the order of their texts; the only document is its own successor;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import documents, flat, keep, mixed, pieces, word_hashes

K = 2
HASHES = 64
TUPLE = 2
_SEEDS = np.random.default_rng(77).integers(1, 1 << 63, HASHES, dtype=np.uint64)
_ODD = np.uint64(0xD6E8FEB86659FD93)
_C = np.uint64(0x9E3779B97F4A7C15)


def kmers(hashes: np.ndarray, row: np.ndarray, rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every k-mer of words in text order; of the whole sequence where a row has fewer words."""
    counts = np.bincount(row, minlength=rows)
    per_row = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    of = np.repeat(np.arange(rows), per_row)
    first = np.cumsum(counts) - counts
    at = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    size = np.minimum(counts[of], k)
    value = size.astype(np.uint64)
    for j in range(k):
        inside = j < size
        step = mixed(value * _C + hashes[np.where(inside, at + j, at)])
        value = np.where(inside, step, value)
    return value, of


def numbered(value: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Hash of each element with its occurrence number within the row."""
    order = np.lexsort((value, of))  # stable: occurrences stay in text order
    v, r = value[order], of[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    at = np.arange(len(v))
    occurrence = np.empty(len(v), np.uint64)
    occurrence[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    return mixed(value + occurrence * _C)


def signatures(texts: pa.Array, k: int = K, hashes: int = HASHES, size: int = TUPLE) -> np.ndarray:
    """One row of ``hashes`` 16-bit components per text."""
    rows = len(texts)
    value, of = kmers(*word_hashes(*flat(texts), lower=False), rows, k)
    out = np.zeros((rows, hashes), np.uint16)
    if not len(value):
        return out
    element = numbered(value, of)
    per_row = np.bincount(of, minlength=rows)
    some = np.flatnonzero(per_row)
    begin = (np.cumsum(per_row) - per_row)[some]
    low = np.uint64((1 << int(len(value)).bit_length()) - 1)
    at = np.arange(len(value), dtype=np.uint64)
    keep_high = ~low
    for i in range(hashes):
        y = (element ^ _SEEDS[i]) * _ODD
        y ^= y >> np.uint64(32)
        y *= _ODD
        y &= keep_high
        y |= at
        picks = np.empty((size, len(some)), np.int64)
        for t in range(size):
            best = np.minimum.reduceat(y, begin)
            gone = best == np.iinfo(np.uint64).max
            pos = (best & low).astype(np.int64)
            picks[t] = np.where(gone, len(value), pos)
            y[pos[~gone]] = np.iinfo(np.uint64).max
        picks.sort(axis=0)  # text order
        h = np.full(len(some), i + 1, np.uint64)
        for t in range(size):
            inside = picks[t] < len(value)
            h = mixed(h * _C + np.where(inside, value[np.where(inside, picks[t], 0)], np.uint64(0)))
        out[some, i] = np.maximum(h >> np.uint64(48), 1).astype(np.uint16)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal components, row by row."""
    return (a == b).mean(axis=1)


def edited(text: str, following: str) -> str:
    """The last floor(n/2) code points of ``text`` replaced by the first as many of ``following``, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id and fingerprint (hex) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                prints = [s.tobytes().hex() for s in signatures(part.column("text"), k).astype(">u2")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    narrow = docs.select("doc_id", "text")
    return narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, fingerprint string")


_DONE, _HEAD, _LAST = 0, 1, 2
_COLUMNS = ["kind", "pid", "doc_id", "n_chars", "edited", "print", "edited_print", "near_edited", "near_next", "text"]
_TYPES = [pa.int8(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.string()]
_SCHEMA = (
    "kind byte, pid int, doc_id long, n_chars long, edited binary, print binary, edited_print binary, near_edited double, "
    "near_next double, text string"
)


def _bytes(signature: np.ndarray) -> bytes:
    return signature.astype(">u2").tobytes()


def _compare(pid: int, ids: list, texts: list[str], following: list[str], own: np.ndarray, after: np.ndarray) -> pa.RecordBatch:
    """Finished rows for texts whose successors are known."""
    changed = [edited(t, n) for t, n in zip(texts, following, strict=True)]
    other = signatures(pa.array(changed, pa.string()))
    n = len(ids)
    columns = [
        [_DONE] * n, [pid] * n, ids, [len(t) for t in texts], [hashlib.sha256(c.encode()).digest() for c in changed],
        [_bytes(s) for s in own], [_bytes(s) for s in other], likeness(own, other), likeness(own, after), [None] * n,
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _COLUMNS)


def _waiting(kind: int, pid: int, doc_id, text: str, own: np.ndarray) -> pa.RecordBatch:
    row = [kind, pid, doc_id, len(text), None, _bytes(own), None, None, None, text]
    return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, _TYPES, strict=True)], _COLUMNS)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range partition in order; its first and last row are also given as waiting rows."""
    pid = TaskContext.get().partitionId()
    ids: list = []
    texts: list[str] = []
    own = np.empty((0, HASHES), np.uint16)
    first = True
    for batch in batches:
        for part in pieces(batch, limit=512 << 10):
            new = signatures(part.column("text"))
            ids += part.column("doc_id").to_pylist()
            texts += [t or "" for t in part.column("text").to_pylist()]
            own = np.concatenate([own, new])
            if first:
                yield _waiting(_HEAD, pid, ids[0], texts[0], own[0])
                first = False
            if len(ids) > 1:
                yield _compare(pid, ids[:-1], texts[:-1], texts[1:], own[:-1], own[1:])
                ids, texts, own = ids[-1:], texts[-1:], own[-1:]
    if ids:
        yield _waiting(_LAST, pid, ids[0], texts[0], own[0])


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Waiting last rows with their successors."""
    for batch in batches:
        for row in batch.to_pylist():
            own, after = (np.frombuffer(row[c], ">u2").astype(np.uint16)[None, :] for c in ("print", "next_print"))
            yield _compare(row["pid"], [row["doc_id"]], [row["text"]], [row["next_text"]], own, after)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """The contract's columns: every text against its edited text and against the next document."""
    order = F.col("doc_id").asc_nulls_last()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = keep(
        rows.repartitionByRange(order).sortWithinPartitions(order, "text").mapInArrow(_in_order, _SCHEMA), "order-minhash"
    )
    heads = parts.filter(f"kind = {_HEAD}").select("pid", F.col("text").alias("t"), F.col("print").alias("p"))
    # Two rows per partition, whatever the number of documents.
    ring = Window.orderBy("pid")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = heads.select(
        F.col("pid").alias("h_pid"),
        F.coalesce(F.lead("t").over(ring), F.first("t").over(whole)).alias("next_text"),
        F.coalesce(F.lead("p").over(ring), F.first("p").over(whole)).alias("next_print"),
    )
    last = parts.filter(f"kind = {_LAST}").join(following, F.col("pid") == F.col("h_pid"))
    closed = last.select("pid", "doc_id", "text", "print", "next_text", "next_print").mapInArrow(_close, _SCHEMA)
    return parts.filter(f"kind = {_DONE}").union(closed).select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("edited")).alias("edited_sha256"),
        F.lower(F.hex("print")).alias("fingerprint"),
        F.lower(F.hex("edited_print")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op2_order_minhash(spark, sf_dir: str) -> DataFrame:
    """Contract query: fingerprints of every whole text and of its edited text."""
    return compare_with_next(documents(spark, sf_dir))
