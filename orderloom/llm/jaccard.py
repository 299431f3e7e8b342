"""N-gram Jaccard join with signature trees.

1. One pass over the texts makes the set of n-word shingles of every document and its 64-bit set id; exact copies share a set id.
2. The sets are divided into candidate clusters without missing a link. Sets of nearby sizes are cut into m parts by hash range. Two linked
   sets differ in at most k shingles, so at least m - k parts are equal. What a part is worth depends on its shingles alone: two for each, or
   one for each frequent shingle. A set with fewer than m - k parts worth less than r has to show only parts worth r or more, and
   takes the largest r up to 6 for which this holds. Equal parts put sets into one cluster. At thresholds under 85, where parts are small, one pass finds
   frequent shingles first (``FREQUENT`` at most); any choice of them gives the same links, a good one keeps shared passages from joining clusters. Within a map task
   only the smallest set id of a part is sent on, with an edge to it from each other set, so a part shared by a third of all documents
   costs a row per task.
3. Every cluster gets signature trees. A leaf is a set, a node holds the OR of its bitmaps and its range of sizes.
   The tree is traversed against itself from the top, and a pair of nodes is dropped if the sizes are too far apart or if the
   bits in common allow too small an overlap. Remaining pairs of sets are counted exactly. Clusters above a bound are cut into chunks by hash and each
   pair of chunks is one unit of work, so no group is held whole in one task.
4. Links give components; the class id is the smallest doc_id reachable.

A fixed-size bit filter (4 MB) of the set ids in clusters keeps other sets out of the shuffle of step 3. Being only a filter it may let
some of them pass, and more of them as the corpus grows.

Edge cases: a text with fewer than n words has its whole word sequence as its only shingle; null texts and texts without
words have an empty set and are linked with nothing; a null ``doc_id`` is in no class of its own unless linked; repeated rows are copies
of each other; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import documents, flat, keep, mixed, pieces, shingle_hashes, signed, word_hashes
from orderloom.llm.components import components

CHUNK_SETS = 4096
CHUNK_TOKENS = 1 << 20
KEYS_HELD = 1 << 20
FILTER_BITS = 25
FREQUENT = 1 << 18
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def shingle_sets(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of all rows, sorted within the row; set size per row; set id per row (0 for an empty set)."""
    data, offsets = flat(column)
    hashes, row = word_hashes(data, offsets)
    value, of = shingle_hashes(hashes, row, len(column), n)
    sizes = np.bincount(of, minlength=len(column))
    sums = np.zeros(len(value) + 1, np.uint64)
    np.cumsum(mixed(value), out=sums[1:])
    ends = np.cumsum(sizes)
    ids = mixed(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64) * _C[0])
    return value, sizes, np.where(sizes > 0, ids, np.uint64(0))


class Parts:
    """The division of sets into parts for links of 100 * overlap >= percent * union."""

    def __init__(self, percent: int, largest: int):
        ratio = 150 if percent >= 85 else 10_000 / percent  # of the sizes at the ends of a range, in percent
        first = [1]
        while first[-1] <= largest:
            first.append(int(first[-1] * ratio) // 100 + 1)
        self.percent = percent
        self.first = np.array(first, np.int64)  # range i holds sizes first[i] .. first[i + 1] - 1
        top = np.append(self.first[1:] - 1, self.first[-1] * 2)
        partner = top * 100 // percent
        self.k = (top + partner) * (100 - percent) // (100 + percent)
        need = self.k + 1
        self.m = np.ceil(need * np.where(top / need >= 6, 1.25, 1.4)).astype(np.int64)

    def keys(self, value: np.ndarray, sizes: np.ndarray, frequent: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(key, row) of the parts that each set shows: in its own size range and, as the larger partner, in the one below."""
        rare = np.arange(len(value) + 1)
        if frequent is not None and len(frequent):
            known = frequent[np.minimum(np.searchsorted(frequent, value), len(frequent) - 1)] == value
            rare = np.append(0, np.cumsum(~known))
        own = np.searchsorted(self.first, sizes, "right") - 1
        scrambled = np.zeros(len(value) + 1, np.uint64)
        np.cumsum(mixed(value ^ _C[2]), out=scrambled[1:])
        high = value >> np.uint64(32)
        keys, rows = [], []
        for down in (0, 1):
            rng = own - down
            used = (sizes > 0) & (rng >= 0)
            if down:  # the smallest partner must reach into the range below
                used &= self.percent * sizes <= 100 * (self.first[own] - 1)
            m = np.where(used, self.m[rng], 0)
            base = _starts(m)
            of = np.repeat(np.arange(len(sizes)), sizes)
            live = used[of]
            part = base[of] + ((high * m[of].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
            at = np.flatnonzero(live)
            if not len(at):
                continue
            p = part[at]
            new = np.ones(len(at), bool)
            new[1:] = p[1:] != p[:-1]
            begin = at[new]
            slot = p[new]
            row = of[begin]
            end = np.append(begin[1:], at[-1] + 1)
            # A set's values are contiguous, so a part ends where the next begins or where its set ends.
            end = np.minimum(end, np.cumsum(sizes)[row])
            count = end - begin
            spare = m - self.k[np.maximum(rng, 0)] - 1
            # A part is worth two for each shingle that is not frequent and one for each that is.
            worth = np.minimum(count + rare[end] - rare[begin], 6)
            poor = m - np.bincount(row, minlength=len(sizes))  # parts worth less than 1, then less than 2, up to 6
            least = np.where(poor <= spare, 1, 0)
            for w in range(1, 6):
                poor = poor + np.bincount(row[worth == w], minlength=len(sizes))
                least = np.where(poor <= spare, w + 1, least)
            shows_all = used & (least == 0)
            take = worth >= least[row]
            total = scrambled[end] - scrambled[begin]
            index = slot - base[row]
            key = lambda t, r, i, c: mixed(t + mixed(r.astype(np.uint64) * _C[0] + i.astype(np.uint64) * _C[1] + c.astype(np.uint64)))
            keys.append(key(total[take], rng[row[take]], index[take], count[take]))
            rows.append(row[take])
            if shows_all.any():
                every = np.flatnonzero(shows_all)
                slots = np.concatenate([np.arange(base[r], base[r] + m[r]) for r in every])
                empty = np.setdiff1d(slots, slot)
                owner = np.searchsorted(base, empty, "right") - 1
                zero = np.zeros(len(empty), np.uint64)
                keys.append(key(zero, rng[owner], empty - base[owner], zero))
                rows.append(owner)
        if not keys:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        return np.concatenate(keys), np.concatenate(rows)


def _star(key: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct (key, member); for every row the first member of its key."""
    order = np.lexsort((member, key))
    key, member = key[order], member[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (member[1:] != member[:-1])
    key, member = key[new], member[new]
    lead = np.ones(len(key), bool)
    lead[1:] = key[1:] != key[:-1]
    return key, member, member[np.maximum.accumulate(np.where(lead, np.arange(len(key)), 0))]


def _pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


_KEY, _EDGE, _DOC = 0, 1, 2


def _rows(kind: int, a, b: np.ndarray, c: np.ndarray | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(b), kind, np.int8)),
            a if isinstance(a, pa.Array) else pa.array(a),
            pa.array(b),
            pa.array(np.zeros(len(b), np.int32) if c is None else c.astype(np.int32)),
        ],
        ["kind", "a", "b", "c"],
    )


def _local_counts(n: int):
    """Shingles that stand in several of the sets a task holds at a time, with their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        count, seen = 0, set()

        def flush() -> pa.RecordBatch:
            shingle, times = np.unique(np.concatenate(held), return_counts=True)
            often = times > 2
            return pa.RecordBatch.from_arrays([pa.array(signed(shingle[often])), pa.array(times[often])], ["h", "c"])

        for batch in batches:
            for part in pieces(batch):
                value, sizes, ids = shingle_sets(part.column("text"), n)
                fresh = []
                for i in ids.tolist():
                    fresh.append(i not in seen)
                    seen.add(i)
                held.append(value[np.repeat(np.array(fresh, bool), sizes)])
                count += len(held[-1])
                if count >= 4 * KEYS_HELD:
                    yield flush()
                    held, count, seen = [], 0, set()
        if held:
            yield flush()

    return run


def frequent_shingles(narrow: DataFrame, n: int) -> np.ndarray:
    """The most frequent shingles of the corpus, ``FREQUENT`` at most, ascending."""
    counts = keep(narrow.select("text").mapInArrow(_local_counts(n), "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "frequent")
    step = F.floor(F.log2("c") * 4)
    steps = counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()  # a few hundred at most
    within = [r["step"] for r, total in zip(steps, np.cumsum([r["count"] for r in steps]), strict=True) if total <= FREQUENT]
    if not within:
        return np.empty(0, np.uint64)
    return np.sort(signed_to_unsigned(counts.filter(step >= min(within)).select("h").toArrow().column("h").to_numpy()))


def _show(n: int, percent: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        held: list[tuple[np.ndarray, np.ndarray]] = []
        count = 0

        def flush() -> Iterator[pa.RecordBatch]:
            key, member, lead = _star(np.concatenate([k for k, _ in held]), np.concatenate([s for _, s in held]))
            edge = member != lead
            if edge.any():
                yield _rows(_EDGE, *_pairs(member[edge], lead[edge]))
            yield _rows(_KEY, key[~edge], member[~edge])

        for batch in batches:
            for part in pieces(batch):
                value, sizes, ids = shingle_sets(part.column("text"), n)
                ids = signed(ids)
                yield _rows(_DOC, part.column("doc_id").cast(pa.int64()), ids, sizes)
                key, row = Parts(percent, int(sizes.max(initial=1))).keys(value, sizes, frequent)
                if len(key):
                    held.append((signed(key), ids[row]))
                    count += len(key)
                if count >= KEYS_HELD:
                    yield from flush()
                    held, count = [], 0
        if held:
            yield from flush()

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (a, b): an edge from every set of a key to the first one; edges and documents pass."""
    last_key, lead = None, None
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        other = np.flatnonzero(kind != _KEY)
        if len(other):
            yield batch.take(pa.array(other))
        at = kind == _KEY
        if not at.any():
            continue
        shown = batch.filter(pa.array(at))
        key, member, first = _star(shown.column("a").to_numpy(), shown.column("b").to_numpy())
        if key[0] == last_key:
            first = np.where(key == last_key, lead, first)
        last_key, lead = key[-1], first[-1]
        edge = member != first
        if edge.any():
            yield _rows(_EDGE, *_pairs(member[edge], first[edge]))


class SignatureTree:
    """Sets of one unit in a hierarchy: level 0 are the sets, a node above holds the OR of 8 bitmaps and the size range."""

    FAN = 8

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        self.bits, self.low, self.high = [bits], [sizes], [sizes]
        while len(self.low[-1]) > 1:
            cut = np.arange(0, len(self.low[-1]), self.FAN)
            self.bits.append(np.bitwise_or.reduceat(self.bits[-1], cut, axis=0))
            self.low.append(np.minimum.reduceat(self.low[-1], cut))
            self.high.append(np.maximum.reduceat(self.high[-1], cut))

    def links(self, percent: int, capacity: np.ndarray | None, exact) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of sets i < j with 100 * overlap >= percent * union.

        ``capacity`` is the number of shingles behind each bit, None if every bit is one shingle. ``exact(i, j)`` counts the overlap of pairs
        of sets; it is not needed when bits are shingles.
        """
        work = [(len(self.low) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        step = max(256, (1 << (21 if capacity is None else 17)) // max(1, self.bits[0].shape[1]))
        if capacity is not None:
            # What the bits of a byte stand for, for every place and value of the byte.
            values = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
            capacity = (capacity.reshape(-1, 8) @ values.T.astype(np.int64)).astype(np.int32)
        while work:
            level, x, y = work.pop()
            if len(x) > step:
                work += [(level, x[k : k + step], y[k : k + step]) for k in range(0, len(x), step)]
                continue
            low, high = self.low[level], self.high[level]
            fits = (100 * high[x] >= percent * low[y]) & (100 * high[y] >= percent * low[x])
            x, y = x[fits], y[fits]
            common = self.bits[level][x] & self.bits[level][y]
            most = self._weight(common, capacity)
            most = np.minimum(most, np.minimum(high[x], high[y]))
            keep = (100 + percent) * most >= percent * (low[x] + low[y])
            if level:
                x, y = x[keep], y[keep]
                f = self.FAN
                below = len(self.low[level - 1])
                cx = (x[:, None] * f + np.repeat(np.arange(f), f)[None, :]).ravel()
                cy = (y[:, None] * f + np.tile(np.arange(f), f)[None, :]).ravel()
                good = (cx < below) & (cy < below) & ((cx < cy) if level == 1 else (cx <= cy))
                if good.any():
                    work.append((level - 1, cx[good], cy[good]))
                continue
            x, y, most = x[keep], y[keep], most[keep]
            if capacity is not None and len(x):
                most = exact(x, y)
                sure = (100 + percent) * most >= percent * (low[x] + low[y])
                x, y = x[sure], y[sure]
            if len(x):
                yield x, y

    @staticmethod
    def _weight(common: np.ndarray, capacity: np.ndarray | None) -> np.ndarray:
        if capacity is None:
            return np.bitwise_count(common).sum(1, dtype=np.int64)
        octets = common.view(np.uint8)
        return capacity[np.arange(octets.shape[1])[None, :], octets].sum(1, dtype=np.int64)


def unit_links(value: np.ndarray, sizes: np.ndarray, percent: int, most_bits: int = 8192) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs among the sets of one unit; ``value`` holds their shingles one after the other."""
    shingles, token, times = np.unique(value, return_inverse=True, return_counts=True)
    of = np.repeat(np.arange(len(sizes)), sizes)
    # Sets of like size and content next to each other make tight nodes.
    lead = np.minimum.reduceat(value, _starts(sizes))
    order = np.lexsort((lead, sizes))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    shared = times > 1  # a shingle in one set only is in no overlap
    bit_of = np.cumsum(shared) - 1
    n = int(shared.sum())
    width = 64 * -(-min(max(n, 1), most_bits) // 64)
    folded = n > most_bits
    use = shared[token]
    bit = bit_of[token[use]] % width
    row = place[of[use]]
    bits = np.zeros((len(sizes), width // 64), np.uint64)
    np.bitwise_or.at(bits, (row, bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
    capacity = np.bincount(np.arange(n) % width, minlength=width) if folded else None
    starts = _starts(sizes)

    def exact(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.empty(len(i), np.int64)
        for k, (a, b) in enumerate(zip(order[i].tolist(), order[j].tolist(), strict=True)):
            out[k] = len(
                np.intersect1d(value[starts[a] : starts[a] + sizes[a]], value[starts[b] : starts[b] + sizes[b]], assume_unique=True)
            )
        return out

    for x, y in SignatureTree(bits, sizes[order]).links(percent, capacity, exact):
        yield order[x], order[y]


def _join_unit(ids: np.ndarray, copies: np.ndarray, chunk: np.ndarray, crossed: bool, value: np.ndarray, sizes: np.ndarray, percent: int):
    """(set, smallest linked set found, documents linked through this unit) of a unit's sets.

    Between two chunks (``crossed``) only their cross pairs count, also if one of them has no rows; a chunk's own pairs belong to the
    unit of the chunk with itself.
    """
    root = np.arange(len(ids))
    links = np.zeros(len(ids), np.int64)
    for x, y in unit_links(value, sizes, percent):
        if crossed:
            over = chunk[x] != chunk[y]
            x, y = x[over], y[over]
        np.add.at(links, x, copies[y])
        np.add.at(links, y, copies[x])
        while True:
            a, b = root[x], root[y]
            differ = a != b
            if not differ.any():
                break
            x, y = x[differ], y[differ]
            np.minimum.at(root, np.maximum(a, b)[differ], np.minimum(a, b)[differ])
            while (root[root] != root).any():
                root = root[root]
    found = links > 0
    return ids[found], ids[root[found]], links[found]


def _units(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by unit; a unit's rows may run over several batches."""
        pending: list[pa.RecordBatch] = []

        def emit(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            unit = np.stack([rows.column(c).to_numpy() for c in ("cluster", "i", "j")])
            cut = np.flatnonzero((unit[:, 1:] != unit[:, :-1]).any(0)) + 1
            ids, copies, chunk = (rows.column(c).to_numpy() for c in ("set_id", "copies", "chunk"))
            lists = rows.column("shingles").combine_chunks()
            ends = lists.offsets.to_numpy()
            value = signed_to_unsigned(lists.values.to_numpy())
            out = []
            for a, b in zip(np.append(0, cut).tolist(), np.append(cut, len(ids)).tolist(), strict=True):
                crossed = bool(unit[1, a] != unit[2, a])
                if b - a > 1 and not (crossed and (chunk[a:b] == chunk[a]).all()):
                    out.append(
                        _join_unit(ids[a:b], copies[a:b], chunk[a:b], crossed, value[ends[a] : ends[b]], np.diff(ends[a : b + 1]), percent)
                    )
            if out:
                arrays = [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["set_id", "root", "links"])

        for batch in batches:
            if not batch.num_rows:
                continue
            if pending:
                tail, head = pending[-1].slice(pending[-1].num_rows - 1), batch.slice(0, 1)
                same = all(tail.column(c)[0].as_py() == head.column(c)[0].as_py() for c in ("cluster", "i", "j"))
                if not same:
                    yield from emit(pa.Table.from_batches(pending))
                    pending = []
            last = [batch.column(c)[batch.num_rows - 1].as_py() for c in ("cluster", "i", "j")]
            unit = [batch.column(c).to_numpy() for c in ("cluster", "i", "j")]
            whole = np.flatnonzero((unit[0] != last[0]) | (unit[1] != last[1]) | (unit[2] != last[2]))
            stop = int(whole[-1]) + 1 if len(whole) else 0
            if stop:
                yield from emit(pa.Table.from_batches([*pending, batch.slice(0, stop)]))
                pending = []
            pending.append(batch.slice(stop))
        if pending:
            yield from emit(pa.Table.from_batches(pending))

    return run


def signed_to_unsigned(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.uint64)


def _member_filter(members: DataFrame) -> np.ndarray:
    """Bits of the set ids in clusters: 2^FILTER_BITS of them at any corpus size, built by an aggregate over words of 32 bits."""
    at = F.pmod(F.col("set_id"), F.lit(1 << FILTER_BITS))
    words = (
        members.select(F.floor(at / 32).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(pmod(set_id, {1 << FILTER_BITS}) % 32 as int))").alias("bit"))
        .groupBy("w")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    out[words.column("w").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return out


def _cluster_sets(n: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for part in pieces(batch):
                value, sizes, ids = shingle_sets(part.column("text"), n)
                at = ids & np.uint64((1 << FILTER_BITS) - 1)
                hit = (sizes > 0) & ((bits[at >> np.uint64(5)] >> (at & np.uint64(31)).astype(np.uint32)) & 1).astype(bool)
                _, first = np.unique(np.where(hit, ids, np.uint64(0)), return_index=True)
                chosen = np.sort(first[hit[first]])
                if len(chosen):
                    s = sizes[chosen]
                    at = np.repeat(_starts(sizes)[chosen] - _starts(s), s) + np.arange(int(s.sum()))
                    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(s)).astype(np.int32)), pa.array(signed(value[at])))
                    yield pa.RecordBatch.from_arrays([pa.array(signed(ids[chosen])), lists], ["set_id", "shingles"])

    return run


def jaccard_classes(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links of every row: two rows link when 100 * overlap >= percent * union."""
    spark = docs.sparkSession
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    frequent = frequent_shingles(narrow, n) if percent < 85 else np.empty(0, np.uint64)
    shown = narrow.mapInArrow(_show(n, percent, spark.sparkContext.broadcast(frequent)), "kind byte, a long, b long, c int")
    met = keep(
        shown.repartition("a").sortWithinPartitions("a", "b").mapInArrow(_meet, "kind byte, a long, b long, c int"), "jaccard-met"
    )
    sets = met.filter(f"kind = {_DOC}").select(F.col("a").alias("doc_id"), F.col("b").alias("set_id"), F.col("c").cast("long").alias("n_shingles"))
    clusters = components(met.filter(f"kind = {_EDGE}").select("a", "b"))
    members = clusters.select(F.col("id").alias("set_id"), F.col("root").alias("cluster")).union(
        clusters.select(F.col("root"), F.col("root")).distinct()
    )
    each = sets.filter("n_shingles > 0").groupBy("set_id").agg(
        F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"), F.max("n_shingles").alias("size")
    )
    members = keep(members.join(each, "set_id"), "jaccard-members")
    weight = members.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("size").alias("tokens"))
    chunks = F.greatest(F.ceil(F.col("n") / CHUNK_SETS), F.ceil(F.col("tokens") / CHUNK_TOKENS)).cast("int")
    placed = (
        members.select("set_id", "cluster", "copies")
        .join(weight.select("cluster", chunks.alias("chunks")), "cluster")
        .withColumn("chunk", F.pmod(F.xxhash64("set_id"), F.col("chunks")).cast("int"))
    )
    shared = spark.sparkContext.broadcast(_member_filter(members))  # 4 MB at any size
    full = narrow.select("text").mapInArrow(_cluster_sets(n, shared), "set_id long, shingles array<long>").dropDuplicates(["set_id"])
    units = (
        full.join(placed, "set_id")
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("cluster", F.least("chunk", "k").alias("i"), F.greatest("chunk", "k").alias("j"), "set_id", "copies", "chunk", "shingles")
    )
    links = keep(
        units.repartition("cluster", "i", "j")
        .sortWithinPartitions("cluster", "i", "j", "set_id")
        .mapInArrow(_units(percent), "set_id long, root long, links long"),
        "jaccard-links",
    )
    roots = components(links.select(F.col("set_id").alias("a"), F.col("root").alias("b")))
    degree = links.groupBy("set_id").agg(F.sum("links").alias("links"))
    joined = each.join(roots.select(F.col("id").alias("set_id"), "root"), "set_id", "left").withColumn(
        "root", F.coalesce("root", "set_id")
    )
    classes = joined.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    per_set = (
        joined.join(classes, "root")
        .join(degree, "set_id", "left")
        .select("set_id", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    return sets.join(per_set, "set_id", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def one_per_group(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without near-duplicates: of each class the row of smallest doc_id stays (null ids last, then by a hash of the text).

    Rows with an empty set all stay. Repeated rows are near-duplicates of each other.
    """
    key = F.xxhash64(F.lit(9), F.col("doc_id"), F.col("text"))
    keyed = docs.select(F.struct("*").alias("row"), key.alias("near_key"))  # the caller's columns may have any names
    classes = jaccard_classes(docs.select(key.alias("doc_id"), "text"), n, percent).filter("n_shingles > 0")
    rows = (
        classes.groupBy("doc_id").agg(F.first("component_id").alias("class"), F.count("*").alias("times"))
        .join(docs.select(key.alias("k"), F.col("doc_id").cast("long").alias("id")).distinct(), F.col("doc_id") == F.col("k"))
    )
    stays = rows.groupBy("class").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k")).alias("first"))
    marked = rows.join(stays, "class").select("k", "times", (F.col("k") == F.col("first.k")).alias("stays"))
    # Gone: rows of other members; rows that repeat a staying one are put back once.
    gone = keep(marked.filter(~F.col("stays") | (F.col("times") > 1)), "near-gone")
    rest = keyed.join(gone.select(F.col("k").alias("near_key")), "near_key", "left_anti")
    again = keyed.join(gone.filter("stays").select(F.col("k").alias("near_key")), "near_key", "left_semi").dropDuplicates(["near_key"])
    return rest.select("row.*").union(again.select("row.*"))


def op9_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Contract query: 3-word shingles, links at 90 in 100."""
    return jaccard_classes(documents(spark, sf_dir), 3, 90)
