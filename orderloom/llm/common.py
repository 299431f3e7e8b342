"""Helpers shared by the training-data operators: shared-folder tables, flat text batches, hashed words.

The array helpers work on one Arrow batch at a time, cut into pieces of about a megabyte, so a task's memory
does not depend on the number of rows it reads.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import work_dir

PIECE_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_TABLE = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# For a second hash of the same bytes, independent of the first.
CHECK = np.random.default_rng(20250317).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C13 | 3  # odd, 3 modulo 4: swaps at short distances keep nearly all bits
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the cluster's shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of plans that are no longer referenced; it only learns of them when garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``limit`` bytes together; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at, done = 0, 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(at, stop - at)
        at, done = stop, int(ends[stop - 1])


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column as one array, and the n + 1 offsets of its rows. Null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or ends[-1] == ends[0]:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word, a word being a run of anything but space and tab to carriage return."""
    if not len(data):
        none = np.empty(0, np.int64)
        return none, none, none
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    first[inner] = solid[inner]
    last[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, 2 * PIECE_BYTES)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        _powers[name] = have
    return have[:n]


def prefix_hashes(data: np.ndarray, lower: bool = False, table: np.ndarray = _TABLE) -> np.ndarray:
    """Polynomial prefix sums modulo 2^64 over a random value per byte; n + 1 entries."""
    values = (table[LOWER] if lower else table)[data]
    values *= _power("up", _BASE, len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values, out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span [start, end): equal bytes have equal hashes wherever they stand."""
    return (prefix[ends] - prefix[starts]) * _power("down", _INVERSE, len(prefix))[starts]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values, so that any of their bits may be compared or cut off."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Scrambled 64-bit hash and row of every word, in text order."""
    starts, ends, row = words(data, offsets)
    return mixed(span_hashes(prefix_hashes(data, lower), starts, ends)), row


def shingle_hashes(hashes: np.ndarray, row: np.ndarray, rows: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingles of each row, sorted by row and hash.

    A row with fewer words has its whole sequence as its only shingle; a row without words has none.
    """
    counts = np.bincount(row, minlength=rows)
    first = np.cumsum(counts) - counts
    out, of = [], []
    for size in range(1, n + 1):
        whole = (counts >= n) if size == n else (counts == size)
        starts_per_row = np.where(whole, np.maximum(counts - size + 1, 0), 0)
        of_row = np.repeat(np.arange(rows), starts_per_row)
        if not len(of_row):
            continue
        begin = np.cumsum(starts_per_row) - starts_per_row
        at = first[of_row] + np.arange(len(of_row)) - begin[of_row]
        value = np.full(len(at), size, np.uint64)
        for k in range(size):
            value = mixed(value * np.uint64(0xD1342543DE82EF95) + hashes[at + k])
        out.append(value)
        of.append(of_row)
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    value, of_row = np.concatenate(out), np.concatenate(of)
    order = np.lexsort((value, of_row))
    value, of_row = value[order], of_row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (of_row[1:] != of_row[:-1])
    return value[new], of_row[new]


def window_hashes(names: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` names from each place in ``at`` on."""
    out = np.full(len(at), size, np.uint64)
    for k in range(size):
        out = mixed(out * np.uint64(0xD1342543DE82EF95) + names[at + k])
    return out


FILTER_BITS = 25


def bit_filter(ids: DataFrame, column: str) -> np.ndarray:
    """2^FILTER_BITS bits of the ids, the same size for any number of them. It keeps rows out of shuffles and decides nothing."""
    size = 1 << FILTER_BITS
    words_ = (
        ids.select(
            F.floor(F.pmod(F.col(column), F.lit(size)) / 32).cast("int").alias("w"),
            F.expr(f"shiftleft(1L, cast(pmod({column}, {size}) % 32 as int))").alias("bit"),
        )
        .groupBy("w")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(size >> 5, np.uint32)
    out[words_.column("w").to_numpy()] = words_.column("bits").to_numpy().astype(np.uint32)
    return out


def may_hold(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether each 64-bit id may be one of those the filter was made of."""
    at = ids.view(np.uint64) & np.uint64((1 << FILTER_BITS) - 1)
    return ((bits[at >> np.uint64(5)] >> (at & np.uint64(31)).astype(np.uint32)) & 1).astype(bool)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
