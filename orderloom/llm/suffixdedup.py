"""Removal of repeated byte strings with hash-compared suffix sorting.

Every byte covered by a ``LENGTH``-byte string that also starts elsewhere, in any document, is removed; matches never cross documents.

1. Anchors. In each window of ``LENGTH`` bytes the ``GRAM``-byte string of smallest hash (leftmost on ties) is its anchor. The choice depends on
   the window's bytes alone, so equal windows have equal anchors at equal offsets. Runs of windows with one anchor make one occurrence.
2. Occurrences of anchors that stand in one place only are dropped after one narrow shuffle. Within a map task, repeated
   anchors are recognised before the shuffle and only one witness per anchor is sent, so a passage in a third of all documents costs a row per task.
3. For the rest the surrounding bytes (a slice: all windows of the occurrence) are fetched once per distinct slice. Slices that occur twice
   are repeated as a whole. Slices of one anchor are suffix-sorted to the right and to the left of the anchor by mergesort; a
   comparison finds the common extension by binary search over polynomial prefix hashes. All common extensions of neighbours are then
   checked byte by byte, and a batch in which a hash lied is sorted anew by its bytes. A window is repeated if another slice lies in the
   same class of the right order (common extension long enough) and in the same class of the left order.
   Anchors with more slices than a bound are cut into chunks, and each pair of chunks is one unit of work.
4. Exact copies of a text are repeated as a whole if they have ``LENGTH`` bytes. Only documents that may have a removed byte, as told by a fixed-size
   bit filter, are shuffled with their text.

The byte check covers the common extensions inside the sort. Whole texts, occurrences and equal slices are told apart by 64-bit hashes alone.

Edge cases: null and empty texts, and texts shorter than ``LENGTH``, lose nothing; repeated rows are copies of each other; a null ``doc_id`` stays
null; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import documents, flat, keep, mixed, pieces, prefix_hashes, signed, span_hashes

LENGTH = 400
GRAM = 200
HELD = 1 << 19
CHUNK_SLICES = 16_384
BATCH_BYTES = 4 << 20
FILTER_BITS = 25
_C = np.uint64(0x9E3779B97F4A7C15)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Occurrences (row, hash, anchor, first window start, last window start); positions count from the row's start."""
    none = np.empty(0, np.int64)
    if len(data) < length:
        return none, none.astype(np.uint64), none, none, none
    n = len(data) - gram + 1
    at = np.arange(n)
    h = mixed(span_hashes(prefix_hashes(data), at, at + gram))
    low = np.uint64((1 << int(len(data)).bit_length()) - 1)
    x = (h & ~low) | at.astype(np.uint64)
    span, wide = 1, length - gram + 1
    while span * 2 <= wide:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    x = np.minimum(x[: len(x) - (wide - span)], x[wide - span :])
    pick = (x & low).astype(np.int64)  # the anchor of the window at each start
    sizes = np.diff(offsets)
    starts = np.maximum(sizes - length + 1, 0)
    row = np.repeat(np.arange(len(sizes)), starts)
    q = offsets[row] + np.arange(len(row)) - np.repeat(np.cumsum(starts) - starts, starts)
    if not len(q):
        return none, none.astype(np.uint64), none, none, none
    a = pick[q]
    new = np.ones(len(q), bool)
    new[1:] = (a[1:] != a[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(q)) - 1
    base = offsets[row[first]]
    return row[first], h[a[first]], a[first] - base, q[first] - base, q[last] - base


_WITNESS, _HIT = 0, 1
_FOUND = "kind byte, key long, occ long, tid long, a int, q1 int, q2 int"


def _found(kind: int, key, occ, tid, a, q1, q2) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(key), kind, np.int8)), pa.array(key), pa.array(occ), pa.array(tid)]
        + [pa.array(np.asarray(c, np.int32)) for c in (a, q1, q2)],
        ["kind", "key", "occ", "tid", "a", "q1", "q2"],
    )


def _repeated(key: np.ndarray, occ: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (key, occ) without doubles; whether the key has another occurrence; whether the row is its key's first."""
    order = np.lexsort((occ, key))
    k, o = key[order], occ[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
    order, k = order[new], k[new]
    lead = np.ones(len(k), bool)
    lead[1:] = k[1:] != k[:-1]
    run = np.cumsum(lead) - 1
    return order, np.bincount(run)[run] > 1 if len(run) else lead, lead


def _show_anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count, seen = 0, set()

        def flush() -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            order, many, lead = _repeated(columns[0], columns[1])
            rows = [c[order] for c in columns]
            if many.any():
                yield _found(_HIT, *(c[many] for c in rows))
            # One witness per key tells other tasks; a key that is alone here may still be met elsewhere.
            yield _found(_WITNESS, *(c[lead] for c in rows))

        for batch in batches:
            for part in pieces(batch):
                tid = part.column("tid").to_numpy()
                row, h, a, q1, q2 = anchors(*flat(part.column("text")), length, gram)
                fresh = np.array([t not in seen for t in tid.tolist()], bool)
                first = np.zeros(len(tid), bool)
                first[np.unique(tid, return_index=True)[1]] = True
                seen.update(tid.tolist())
                use = (fresh & first)[row]
                row, h, a, q1, q2 = (c[use] for c in (row, h, a, q1, q2))
                if not len(row):
                    continue
                occ = signed(mixed(tid[row].view(np.uint64) + a.astype(np.uint64) * _C))
                held.append((signed(h), occ, tid[row], a, q1, q2))
                count += len(row)
                if count >= HELD:
                    yield from flush()
                    held, count = [], 0
        if held:
            yield from flush()

    return run


def _meet_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, occ): passes hits, and witnesses whose key is met again."""
    pending: pa.RecordBatch | None = None  # the last row of the batch before, while its key may go on
    alone = True
    for batch in batches:
        hits = batch.column("kind").to_numpy() == _HIT
        if hits.any():
            yield batch.filter(pa.array(hits))
        rows = batch.filter(pa.array(~hits))
        if not rows.num_rows:
            continue
        key, occ = rows.column("key").to_numpy(), rows.column("occ").to_numpy()
        if pending is not None:
            old_key, old_occ = pending.column("key")[0].as_py(), pending.column("occ")[0].as_py()
            if key[0] == old_key and (occ[key == old_key] != old_occ).any():
                if alone:
                    yield pending
                alone = False
            elif key[0] != old_key:
                alone = True
        order, many, _ = _repeated(key, occ)
        if pending is not None and not alone:
            many = many | (key[order] == old_key)
        if many.any():
            yield rows.take(pa.array(order[many]))
        last = rows.num_rows - 1
        same = pending is not None and key[last] == old_key
        alone = (alone if same else True) and not (occ[key == key[last]] != occ[last]).any()
        pending = rows.slice(last)


_CUT = "h long, sid long, occ long, tid long, off int, q1 int, q2 int, slice binary"


def _whole(tid: np.ndarray, q1: np.ndarray, q2: np.ndarray, repeated: np.ndarray, length: int) -> Iterator[pa.RecordBatch]:
    """Intervals of the repeated occurrences, merged per text."""
    tid, q1, q2 = tid[repeated], q1[repeated].astype(np.int64), q2[repeated].astype(np.int64)
    order = np.lexsort((q1, tid))
    tid, q1, q2 = tid[order], q1[order], q2[order]
    if not len(tid):
        return
    cut = np.flatnonzero(tid[1:] != tid[:-1]) + 1
    per_text = zip(tid[np.append(0, cut)].tolist(), np.split(q1, cut), np.split(q2 + length, cut), strict=True)
    t, a, b = (np.array(c, np.int64) for c in zip(*((t, a, b) for t, s, e in per_text for a, b in merged(s, e)), strict=True))
    ids, small, blob = pa.nulls(len(t), pa.int64()), pa.nulls(len(t), pa.int32()), pa.nulls(len(t), pa.binary())
    ends = [pa.array(c.astype(np.int32)) for c in (a, b - length)]
    yield pa.RecordBatch.from_arrays(
        [ids, ids, ids, pa.array(t), small, *ends, blob], ["h", "sid", "occ", "tid", "off", "q1", "q2", "slice"]
    )


def _cut_slices(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per occurrence; the bytes go with the first occurrence of a slice in the piece.

        A slice that stands twice in the piece is repeated as a whole: its intervals are given merged per text, in rows without a
        slice id, and only one occurrence goes on as witness. So a slice repeated over and over costs a row per task.
        """
        for batch in batches:
            for part in pieces(batch):
                data, offsets = flat(part.column("text"))
                lists = part.column("hits")
                lists = lists if not lists.offset else pa.concat_arrays([lists])
                begin = lists.offsets.to_numpy()
                inner = lists.values.slice(begin[0], begin[-1] - begin[0])
                row = np.repeat(np.arange(part.num_rows), np.diff(begin))
                h, occ, a, q1, q2 = (inner.field(k).to_numpy() for k in range(5))
                # field() of a sliced struct ignores the slice.
                h, occ, a, q1, q2 = (c[begin[0] : begin[-1]] if len(c) != len(row) else c for c in (h, occ, a, q1, q2))
                start, end = offsets[row] + q1, offsets[row] + q2 + length
                prefix = prefix_hashes(data)
                off = a - q1
                sid = mixed(span_hashes(prefix, start, end) + off.astype(np.uint64) * _C + (end - start).astype(np.uint64))
                _, first, times = np.unique(sid, return_index=True, return_counts=True)
                tid = part.column("tid").to_numpy()[row]
                many = np.zeros(len(sid), bool)
                many[first] = times > 1
                other = np.ones(len(sid), bool)
                other[first] = False
                yield from _whole(tid, q1, q2, many | other, length)
                go = np.sort(first)
                h, sid, occ, tid, off, q1, q2, start, end = (c[go] for c in (h, sid, occ, tid, off, q1, q2, start, end))
                lengths = end - start
                ends = np.cumsum(lengths)
                at = np.repeat(start - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)
                blob = pa.Array.from_buffers(
                    pa.binary(), len(sid), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(data[at])]
                )
                ints = [pa.array(c.astype(np.int32)) for c in (off, q1, q2)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(signed(sid)), pa.array(occ), pa.array(tid), *ints, blob],
                    ["h", "sid", "occ", "tid", "off", "q1", "q2", "slice"],
                )

    return run


class Suffixes:
    """Strings that start at ``at`` and run ``step`` = 1 to the right or -1 to the left for ``size`` bytes, in one buffer."""

    def __init__(self, data: np.ndarray, prefix: np.ndarray, at: np.ndarray, size: np.ndarray, step: int):
        self.data, self.prefix, self.at, self.size, self.step = data, prefix, at, size, step

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension of strings x and y, by binary search over their prefix hashes."""
        low = np.zeros(len(x), np.int64)
        high = np.minimum(self.size[x], self.size[y])
        a, b = self.at[x], self.at[y]
        for _ in range(int(high.max(initial=0)).bit_length()):
            mid = (low + high + 1) >> 1
            if self.step > 0:
                same = span_hashes(self.prefix, a, a + mid) == span_hashes(self.prefix, b, b + mid)
            else:
                same = span_hashes(self.prefix, a - mid, a) == span_hashes(self.prefix, b - mid, b)
            low = np.where(same, mid, low)
            high = np.where(same, high, mid - 1)
        return low

    def byte(self, x: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th byte of string x, -1 past its end."""
        at = self.at[x] + k if self.step > 0 else self.at[x] - 1 - k
        inside = k < self.size[x]
        return np.where(inside, self.data[np.where(inside, at, 0)].astype(np.int64), -1)

    def before(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether string x sorts before string y; equal strings by number."""
        k = self.common(x, y)
        a, b = self.byte(x, k), self.byte(y, k)
        return (a < b) | ((a == b) & (x < y))

    def sort(self, group: np.ndarray) -> np.ndarray:
        """Mergesort within each group (ascending group numbers). All merges of a level are done together: a string's new place
        is its place in its own run plus the number of strings of the sister run before it, found by binary search."""
        n = len(group)
        lead = np.ones(n, bool)
        lead[1:] = group[1:] != group[:-1]
        starts = np.flatnonzero(lead)
        of = np.cumsum(lead) - 1
        begin = starts[of]
        stop = np.append(starts[1:], n)[of]
        inner = np.arange(n) - begin
        order = np.arange(n)
        width = 1
        longest = int((stop - begin).max(initial=0))
        while width < longest:
            run = inner // width
            sister = begin + (run ^ 1) * width
            low = np.minimum(sister, stop)
            high = np.minimum(sister + width, stop)
            floor = low.copy()
            for _ in range(int(width).bit_length()):
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                mid = (low[open_] + high[open_]) >> 1
                less = self.before(order[mid], order[open_])
                low[open_] = np.where(less, mid + 1, low[open_])
                high[open_] = np.where(less, high[open_], mid)
            place = begin + (run & ~1) * width + inner % width + (low - floor)
            merged = np.empty(n, np.int64)
            merged[place] = order
            order = merged
            width *= 2
        return order

    def neighbours(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted order, and each string's common extension with the one before it (-1 at the start of a group)."""
        order = self.sort(group)
        reach = np.full(len(order), -1, np.int64)
        inside = np.flatnonzero(group[order][1:] == group[order][:-1]) + 1
        x, y = order[inside - 1], order[inside]
        reach[inside] = self.common(x, y)
        if not self._verified(x, y, reach[inside]):
            text = [
                self.data[a : a + s].tobytes() if self.step > 0 else self.data[a - s : a].tobytes()[::-1]
                for a, s in zip(self.at.tolist(), self.size.tolist(), strict=True)
            ]
            order = np.array(sorted(range(len(text)), key=lambda i: (group[i], text[i], i)), np.int64)
            for i in np.flatnonzero(group[order][1:] == group[order][:-1]) + 1:
                a, b = text[order[i - 1]], text[order[i]]
                reach[i] = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
        return order, reach

    def _verified(self, x: np.ndarray, y: np.ndarray, k: np.ndarray) -> bool:
        """Every claimed common extension holds byte by byte."""
        for i in range(0, len(k), 4096):
            size = k[i : i + 4096]
            of = np.repeat(np.arange(len(size)), size)
            step = (np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)) * self.step - (self.step < 0)
            if (self.data[self.at[x[i : i + 4096]][of] + step] != self.data[self.at[y[i : i + 4096]][of] + step]).any():
                return False
        return True


def repeated_windows(group: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, off: np.ndarray, length: int):
    """Runs (slice, first, last) of window starts, counted from the slice's start, whose bytes stand in another slice of the group."""
    n = len(group)
    prefix = prefix_hashes(data)
    at = starts + off
    right, reach_r = Suffixes(data, prefix, at, sizes - off, 1).neighbours(group)
    left, reach_l = Suffixes(data, prefix, at, off, -1).neighbours(group)
    rank_r, rank_l = np.empty(n, np.int64), np.empty(n, np.int64)
    rank_r[right] = np.arange(n)
    rank_l[left] = np.arange(n)
    least, most = off - (sizes - length), off  # window starts lie ``l`` bytes before the anchor
    hit = np.zeros((int(most.max(initial=0)) + 1, n), bool)
    for l in range(hit.shape[0]):  # noqa: E741
        live = np.flatnonzero((least <= l) & (l <= most))
        if len(live) < 2:
            continue
        a = np.cumsum(reach_r < length - l)[rank_r[live]]
        b = np.cumsum(reach_l < l)[rank_l[live]]
        key = a * (n + 1) + b
        order = np.argsort(key, kind="stable")
        k = key[order]
        same = k[1:] == k[:-1]
        both = np.zeros(len(k), bool)
        both[1:] |= same
        both[:-1] |= same
        hit[l, live[order[both]]] = True
    # A run of l is a run of window starts in reverse.
    s, l = np.nonzero(hit.T)  # noqa: E741
    if not len(s):
        return s, s, s
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (l[1:] != l[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(s)) - 1
    return s[first], off[s[first]] - l[last], off[s[first]] - l[first]


def _sort_units(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (h, i, j, sid); whole units are taken together until they have a few megabytes."""
        pending: list[pa.RecordBatch] = []
        held = 0

        def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
            table = table.combine_chunks()
            h, i, j, sid, off = (table.column(c).to_numpy() for c in ("h", "i", "j", "sid", "off"))
            unit = np.ones(len(h), bool)
            unit[1:] = (h[1:] != h[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            fresh = unit.copy()
            fresh[1:] |= sid[1:] != sid[:-1]
            group = np.cumsum(unit) - 1
            several = np.bincount(group[fresh], minlength=int(group[-1]) + 1) > 1
            use = np.flatnonzero(fresh & several[group])
            if not len(use):
                return
            blob = table.column("slice").combine_chunks().cast(pa.large_binary()).take(pa.array(use))
            blob = blob.combine_chunks() if isinstance(blob, pa.ChunkedArray) else blob
            _, ends, data = blob.buffers()
            ends = np.frombuffer(ends, np.int64)[blob.offset : blob.offset + len(blob) + 1]
            data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
            ends = ends - ends[0]
            s, first, last = repeated_windows(group[use], data, ends[:-1], np.diff(ends), off[use].astype(np.int64), length)
            if len(s):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sid[use][s]), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))], ["sid", "first", "last"]
                )

        for batch in batches:
            if not batch.num_rows:
                continue
            h, i, j = (batch.column(c).to_numpy() for c in ("h", "i", "j"))
            pending.append(batch)
            held += batch.nbytes
            if held < BATCH_BYTES:
                continue
            whole = np.flatnonzero((h != h[-1]) | (i != i[-1]) | (j != j[-1]))
            stop = int(whole[-1]) + 1 if len(whole) else 0
            before = pending[:-1]
            if not stop and before:
                # The last unit may have begun in an earlier batch: everything ahead of it can go.
                table = pa.Table.from_batches(before)
                keys = [table.column(c).to_numpy() for c in ("h", "i", "j")]
                ahead = np.flatnonzero((keys[0] != h[-1]) | (keys[1] != i[-1]) | (keys[2] != j[-1]))
                cut = int(ahead[-1]) + 1 if len(ahead) else 0
                if cut:
                    yield from work(table.slice(0, cut))
                    pending = [*table.slice(cut).to_batches(), batch]
                    held = sum(b.nbytes for b in pending)
            elif stop:
                yield from work(pa.Table.from_batches([*before, batch.slice(0, stop)]))
                pending = [batch.slice(stop)]
                held = pending[0].nbytes
        if pending:
            yield from work(pa.Table.from_batches(pending))

    return run


def _bit_filter(ids: DataFrame, column: str) -> np.ndarray:
    """2^FILTER_BITS bits of the ids, the same size for any number of them."""
    size = 1 << FILTER_BITS
    words = (
        ids.select(
            F.floor(F.pmod(F.col(column), F.lit(size)) / 32).cast("int").alias("w"),
            F.expr(f"shiftleft(1L, cast(pmod({column}, {size}) % 32 as int))").alias("bit"),
        )
        .groupBy("w")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(size >> 5, np.uint32)
    out[words.column("w").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return out


def _inside(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at = ids.view(np.uint64) & np.uint64((1 << FILTER_BITS) - 1)
    return ((bits[at >> np.uint64(5)] >> (at & np.uint64(31)).astype(np.uint32)) & 1).astype(bool)


def _passing(shared, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = _inside(shared.value, np.ascontiguousarray(batch.column("tid").to_numpy()))
            if good.any():
                yield batch.filter(pa.array(good)).select(columns)

    return run


def _result(part: pa.RecordBatch, removed: np.ndarray, spans: np.ndarray, kept: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), part.column("n_bytes"), pa.array(removed), pa.array(spans), pa.array(kept)],
        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    )


def _untouched(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.ascontiguousarray(batch.column("tid").to_numpy())
            part = batch.filter(pa.array(~_inside(shared.value, ids)))
            if part.num_rows:
                zero = np.zeros(part.num_rows, np.int64)
                yield _result(part, zero, zero, [hashlib.sha256((t or "").encode()).hexdigest() for t in part.column("text").to_pylist()])

    return run


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the union of half-open intervals."""
    order = np.argsort(starts, kind="stable")
    a, b = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(a), bool)
    new[1:] = a[1:] > b[:-1]
    first = np.flatnonzero(new)
    return list(zip(a[first].tolist(), b[np.append(first[1:], len(a)) - 1].tolist(), strict=True))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            n_removed, n_spans, digests = [], [], []
            for text, cuts in zip(part.column("text").to_pylist(), part.column("cuts").to_pylist(), strict=True):
                raw, at, digest, gone = (text or "").encode(), 0, hashlib.sha256(), 0
                runs = merged(*(np.array(c, np.int64) for c in zip(*((x["s"], x["e"]) for x in cuts), strict=True))) if cuts else []
                for a, b in runs:
                    digest.update(raw[at:a])
                    at, gone = b, gone + b - a
                digest.update(raw[at:])
                n_removed.append(gone)
                n_spans.append(len(runs))
                digests.append(digest.hexdigest())
            yield _result(part, np.array(n_removed, np.int64), np.array(n_spans, np.int64), digests)


def repeated_cuts(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(tid, s, e): byte intervals to remove; ``texts`` has columns tid (a hash of the text), n_bytes and text."""
    spark = texts.sparkSession
    long_ = texts.filter(F.col("n_bytes") >= length).select("tid", "text")
    found = keep(
        long_.mapInArrow(_show_anchors(length, gram), _FOUND)
        # Hits have their answer and are dealt anyhow; only witnesses have to meet by key.
        .repartition(F.when(F.col("kind") == _HIT, F.col("occ")).otherwise(F.col("key")))
        .sortWithinPartitions("key", "occ")
        .mapInArrow(_meet_anchors, _FOUND)
        .select("key", "occ", "tid", "a", "q1", "q2"),
        "suffix-anchors",
    ).distinct()
    per_text = found.groupBy("tid").agg(F.collect_list(F.struct(F.col("key").alias("h"), "occ", "a", "q1", "q2")).alias("hits"))
    shared = spark.sparkContext.broadcast(_bit_filter(found, "tid"))
    cut = keep(
        long_.mapInArrow(_passing(shared, ["tid", "text"]), "tid long, text string")
        .join(per_text, "tid")
        .select("tid", "text", "hits")
        .mapInArrow(_cut_slices(length), _CUT),
        "suffix-slices",
    )
    members = cut.filter("sid is not null").select("h", "sid", "occ", "tid", "q1", "q2")
    whole = cut.filter("sid is null").select("tid", F.col("q1").alias("s"), (F.col("q2") + length).alias("e"))
    twice = members.groupBy("sid").agg(F.min("occ").alias("x"), F.max("occ").alias("y")).filter("x < y").select("sid")
    chunks = (
        members.select("h", "sid").distinct().groupBy("h").agg(F.count("*").alias("n")).filter("n > 1")
        .select("h", F.ceil(F.col("n") / CHUNK_SLICES).cast("int").alias("chunks"))
    )
    units = (
        cut.filter("slice is not null")
        .select("h", "sid", "off", "slice")
        .join(chunks, "h")
        .withColumn("chunk", F.pmod(F.xxhash64("sid"), F.col("chunks")).cast("int"))
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("h", F.least("chunk", "k").alias("i"), F.greatest("chunk", "k").alias("j"), "sid", "off", "slice")
    )
    windows = (
        units.repartition("h", "i", "j")
        .sortWithinPartitions("h", "i", "j", "sid")
        .mapInArrow(_sort_units(length), "sid long, first int, last int")
    )
    return (
        members.join(windows, "sid")
        .select("tid", (F.col("q1") + F.col("first")).alias("s"), (F.col("q1") + F.col("last") + length).alias("e"))
        .union(members.join(twice, "sid").select("tid", F.col("q1"), F.col("q2") + length))
        .union(whole)
        .distinct()
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select("doc_id", text.alias("text")).select(
        "doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"), F.xxhash64("text", F.octet_length("text")).alias("tid")
    )
    copies = texts.filter(F.col("n_bytes") >= length).groupBy("tid", "n_bytes").count().filter("count > 1")
    cuts = keep(
        repeated_cuts(texts, length, gram).union(copies.select("tid", F.lit(0), F.col("n_bytes").cast("int"))), "suffix-cuts"
    )
    shared = spark.sparkContext.broadcast(_bit_filter(cuts, "tid"))
    clean = texts.mapInArrow(_untouched(shared), schema)
    per_text = cuts.groupBy("tid").agg(F.collect_list(F.struct("s", "e")).alias("cuts"))
    passed = texts.select("doc_id", "text", "n_bytes", "tid").mapInArrow(
        _passing(shared, ["doc_id", "text", "n_bytes", "tid"]), f"doc_id {kind}, text string, n_bytes long, tid long"
    )
    touched = passed.join(per_text, "tid", "left").select("doc_id", "n_bytes", "text", "cuts").mapInArrow(_remove, schema)
    return clean.union(touched)


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: repeated strings of 400 bytes over all documents."""
    return remove_repeats(documents(spark, sf_dir))
