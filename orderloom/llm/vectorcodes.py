"""Vector codes: the parts of every vector are coded by codebooks that k-means fits over anchors-hierarchy metric trees.

1. Each component becomes the integer floor(1024 * x); a vector is cut into ``PARTS`` equal parts with a codebook each.
2. A task gathers rows up to a bounded block and builds a metric tree over the distinct parts at each position, middle-out: about sqrt(n) anchors
   are grown by taking points from each other (only points far enough from their anchor are looked at), the anchors are merged upwards into
   ever larger balls, and each anchor is divided downwards in the same way until balls are small. A ball caches the sum and the count of its
   points, copies counted, and a centre and radius that hold all of them. Trees are kept as flat arrays, a row per block.
3. In a round every tree is walked from its root with the list of all codebook entries. At each ball, an entry that another entry beats for every
   point of the ball leaves the list, and children inherit what is left. A ball whose list has shrunk to one entry is wholly owned: its cached
   sum and count go to the entry. At the leaves the remaining entries are compared exactly. Spark adds up the sums; only the codebooks, whose
   size is fixed, pass through the driver.
4. The last walk gives each part its entry. Errors are exact integers.

All pruning has a margin far above the rounding of its doubles, and ties between entries go to the lower one, so codes are those of an
exhaustive search. Equal entries cannot both win: the lower one stays from the start.

Edge cases: a vector that is null, or holds null or non-finite components, is dropped; so is one whose length differs from that of the kept row of smallest
vec_id. A length that ``PARTS`` does not divide raises ValueError, as do components whose squared distances could reach 2^53 and not be exact
(beyond +-2^23 after scaling in parts of 16). Fewer rows than entries give smaller codebooks; repeated vec_ids are ordered by vector and null ones come last; other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import keep

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
BLOCK = 16_384  # rows of a block
LEAF = 24
EXACT = 1 << 53  # doubles below it are exact integers
LABELS = 100_000  # up to so many labels their sums are broadcast


# --- trees --------------------------------------------------------------------------------------


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    off = points - centre
    return np.sqrt(np.einsum("ij,ij->i", off, off))


def anchors(points: np.ndarray, k: int) -> tuple[list[int], list[np.ndarray]]:
    """Up to ``k`` anchors and the points each of them owns, farthest first; every point belongs to its nearest anchor.

    A new anchor is the point farthest from its own anchor. It takes points from the others; an owned point nearer to its anchor than half the
    distance between the two anchors cannot change hands, so a list is only read up to there.
    """
    first = 0
    d = _distances(points, points[first])
    order = np.argsort(-d, kind="stable")
    pivots, owned, dist = [first], [order], [d[order]]
    while len(pivots) < k:
        far = max(range(len(pivots)), key=lambda i: dist[i][0] if len(dist[i]) else -1.0)
        if not len(dist[far]) or dist[far][0] <= 0:
            break
        new = int(owned[far][0])
        taken, taken_d = [], []
        between = _distances(points[pivots], points[new])
        for i in range(len(pivots)):
            stop = int(np.searchsorted(-dist[i], -between[i] / 2, "right"))
            if not stop:
                continue
            mine = owned[i][:stop]
            to_new = _distances(points[mine], points[new])
            go = to_new < dist[i][:stop]
            if go.any():
                taken.append(mine[go])
                taken_d.append(to_new[go])
                stay = np.ones(len(owned[i]), bool)
                stay[:stop] = ~go
                owned[i], dist[i] = owned[i][stay], dist[i][stay]
        mine, to_new = np.concatenate(taken), np.concatenate(taken_d)
        order = np.argsort(-to_new, kind="stable")
        pivots.append(new)
        owned.append(mine[order])
        dist.append(to_new[order])
    return pivots, owned


def _merge_order(centres: np.ndarray, radii: np.ndarray) -> list[tuple[int, int]]:
    """Merges of balls, always the two whose common ball is smallest. Merge m makes ball number len(centres) + m."""
    n = len(centres)
    centre, radius, number = centres.copy(), radii.copy(), np.arange(n)
    gap = np.sqrt(np.maximum(((centre[:, None, :] - centre[None, :, :]) ** 2).sum(2), 0))
    size = np.maximum((gap + radius[:, None] + radius[None, :]) / 2, np.maximum(radius[:, None], radius[None, :]))
    np.fill_diagonal(size, np.inf)
    out = []
    for m in range(n - 1):
        i, j = divmod(int(np.argmin(size)), n)
        out.append((int(number[i]), int(number[j])))
        g, new_radius = gap[i, j], size[i, j]
        if g > 0 and new_radius > radius[i]:
            centre[i] = centre[i] + (centre[j] - centre[i]) * min(1.0, (new_radius - radius[i]) / g)
        radius[i], number[i] = new_radius, n + m
        size[j, :] = size[:, j] = np.inf
        gap[i] = gap[:, i] = np.sqrt(np.maximum(((centre - centre[i]) ** 2).sum(1), 0))
        joint = np.maximum((gap[i] + radius[i] + radius) / 2, np.maximum(radius[i], radius))
        open_ = np.isfinite(size[i])
        open_[i] = False
        size[i, open_] = size[open_, i] = joint[open_]
    return out


def build_tree(points: np.ndarray, weights: np.ndarray, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """A binary metric tree. ``order`` lists the points so that every ball holds a slice [begin, end) of it; ball 0 is the root.

    ``left`` is the first child (the second is ``right``), -1 at a leaf.
    """
    floats = points.astype(np.float64)
    begin, end, left, right = [0], [len(points)], [-1], [-1]
    order = np.arange(len(points))

    def divide(node: int) -> None:
        at, stop = begin[node], end[node]
        inside = order[at:stop]
        if stop - at <= leaf:
            return
        pivots, owned = anchors(floats[inside], max(2, int(round((stop - at) ** 0.5))))
        if len(pivots) < 2:
            return
        groups = [inside[o] for o in owned]
        means = np.array([floats[g].mean(0) for g in groups])
        radii = np.array([_distances(floats[g], c).max() for g, c in zip(groups, means, strict=True)])
        merges = _merge_order(means, radii)
        count = len(groups)

        def place(ball: int, slot: int, at: int) -> int:
            """Lay out a merged ball or an anchor at ``at``; where it ends. Iterative, as merges can form long chains."""
            waiting = [(ball, slot)]
            while waiting:
                ball, slot = waiting.pop()
                begin[slot] = at if ball < count else -1
                if ball < count:
                    order[at : at + len(groups[ball])] = groups[ball]
                    at += len(groups[ball])
                    end[slot] = at
                    leaves.append(slot)
                    continue
                a, b = merges[ball - count]
                left[slot], right[slot] = len(begin), len(begin) + 1
                begin.extend((-1, -1))
                end.extend((-1, -1))
                left.extend((-1, -1))
                right.extend((-1, -1))
                inner.append(slot)
                waiting.append((b, right[slot]))
                waiting.append((a, left[slot]))
            return at

        leaves: list[int] = []
        inner: list[int] = []
        place(count + len(merges) - 1, node, at)
        for slot in reversed(inner):  # children come after their parents
            begin[slot], end[slot] = begin[left[slot]], end[right[slot]]
        todo.extend(leaves)

    todo = [0]
    while todo:
        divide(todo.pop())
    b, e = np.array(begin), np.array(end)
    mass = np.concatenate([[0], np.cumsum(weights[order])])
    sums = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points[order] * weights[order, None], axis=0)])
    count, total = mass[e] - mass[b], sums[e] - sums[b]
    centre = total / np.maximum(count, 1)[:, None]
    radius = np.array([_distances(floats[order[x:y]], c).max(initial=0) for x, y, c in zip(begin, end, centre, strict=True)])
    return {
        "order": order.astype(np.int32),
        "begin": b.astype(np.int32),
        "end": e.astype(np.int32),
        "left": np.array(left, np.int32),
        "right": np.array(right, np.int32),
        "count": count.astype(np.int64),
        "sum": total.astype(np.int64),
        "centre": centre,
        "radius": radius,
    }


# --- walks --------------------------------------------------------------------------------------


def _shrunk(centre: np.ndarray, radius: np.ndarray, of: np.ndarray, entry: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Which (ball, entry) pairs stay: those that the entry nearest to the ball's centre does not beat over the whole ball.

    The nearest entry a beats b at every point if the centre lies farther than the radius on a's side of the plane between them.
    """
    off = centre[of] - book[entry]
    d = np.einsum("ij,ij->i", off, off)
    new = np.ones(len(of), bool)
    new[1:] = of[1:] != of[:-1]
    start = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    least = np.minimum.reduceat(d, start)
    hit = np.flatnonzero(d == least[run])
    best = np.empty(len(start), np.int64)
    best[run[hit][::-1]] = entry[hit][::-1]  # the lowest of equally near entries
    a = best[run]
    apart = book[entry] - book[a]
    gap = np.sqrt(np.einsum("ij,ij->i", apart, apart))
    beaten = d - least[run] > 2 * radius[of] * gap + 1e-6 * (1 + d)
    return ~beaten | (entry == a)


def nearest_entries(tree: dict[str, np.ndarray], points: np.ndarray, book: np.ndarray):
    """The walk of one tree: (owned balls, their entries, places in ``order``, their entries).

    The places are those of points in leaves that no single entry owns.
    """
    floats, floating = points[tree["order"]].astype(np.float64), book.astype(np.float64)
    squares = np.einsum("ij,ij->i", floating, floating)
    _, first = np.unique(book, axis=0, return_index=True)
    entry = np.sort(first)
    of = np.zeros(len(entry), np.int64)
    balls, entries, places, chosen = [], [], [], []
    begin, end, left, right = tree["begin"], tree["end"], tree["left"], tree["right"]
    while len(of):
        stays = _shrunk(tree["centre"], tree["radius"], of, entry, floating)
        of, entry = of[stays], entry[stays]
        new = np.ones(len(of), bool)
        new[1:] = of[1:] != of[:-1]
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(of)))
        ball = of[start]
        owned = size == 1
        balls.append(ball[owned])
        entries.append(entry[start[owned]])
        is_leaf = ~owned & (left[ball] < 0)
        for i in np.flatnonzero(is_leaf).tolist():
            b, listed = ball[i], entry[start[i] : start[i] + size[i]]
            # Products stay below 2^53, so these doubles are exact integers. argmin takes the lowest of equal ones.
            d = squares[listed] - 2.0 * (floats[begin[b] : end[b]] @ floating[listed].T)
            chosen.append(listed[d.argmin(1)])
            places.append(np.arange(begin[b], end[b]))
        go = (~owned & ~is_leaf)[np.cumsum(new) - 1]
        of, entry = of[go], entry[go]
        of = np.concatenate([left[of], right[of]]).astype(np.int64)
        entry = np.concatenate([entry, entry])
        by_ball = np.lexsort((entry, of))
        of, entry = of[by_ball], entry[by_ball]
    none = [np.empty(0, np.int64)]
    return tuple(np.concatenate(c or none) for c in (balls, entries, places, chosen))


def entry_sums(tree, points, weights, book) -> tuple[np.ndarray, np.ndarray]:
    """Count and componentwise sum of the points of each entry."""
    balls, entries, places, chosen = nearest_entries(tree, points, book)
    count, total = np.zeros(len(book), np.int64), np.zeros(book.shape, np.int64)
    np.add.at(count, entries, tree["count"][balls])
    np.add.at(total, entries, tree["sum"][balls])
    who = tree["order"][places]
    np.add.at(count, chosen, weights[who])
    np.add.at(total, chosen, points[who] * weights[who, None])
    return count, total


def codes(tree, points, book) -> np.ndarray:
    """The entry of every point."""
    balls, entries, places, chosen = nearest_entries(tree, points, book)
    out = np.empty(len(points), np.int64)
    size = (tree["end"] - tree["begin"])[balls]
    at = np.repeat(tree["begin"][balls] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    out[tree["order"][at]] = np.repeat(entries, size)
    out[tree["order"][places]] = chosen
    return out


# --- blocks -------------------------------------------------------------------------------------

_FLAT = ("order", "begin", "end", "left", "right")
_WIDE = ("count", "sum", "centre", "radius")
_TREE = "points binary, weights binary, of binary, " + ", ".join(f"{c} binary" for c in _FLAT + _WIDE)
_BLOCK = f"vec_ids binary, no_id binary, labels binary, no_label binary, width int, parts array<struct<{_TREE}>>"
_NAMES = ("points", "weights", "of", *_FLAT, *_WIDE)
_TYPES = {"points": np.int64, "weights": np.int64, "of": np.int32, "count": np.int64, "sum": np.int64, "centre": np.float64, "radius": np.float64}
_TREE_TYPE = pa.struct([(c, pa.binary()) for c in _NAMES])


def _build_blocks(parts: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0

        def build() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            values = rows.column("v").combine_chunks()
            n, flat = rows.num_rows, values.flatten().to_numpy()
            matrix = flat.reshape(n, -1)
            width = matrix.shape[1] // parts
            if len(flat) and 4 * width * max(int(flat.max()), -int(flat.min())) ** 2 >= EXACT:
                raise ValueError("components are too large for exact squared distances")
            trees = []
            for p in range(parts):
                points, of, weights = np.unique(matrix[:, p * width : (p + 1) * width], axis=0, return_inverse=True, return_counts=True)
                tree = build_tree(points, weights) | {"points": points, "weights": weights, "of": of.reshape(-1).astype(np.int32)}
                trees.append({c: np.ascontiguousarray(tree[c]).tobytes() for c in _NAMES})
            columns = []
            for c in ("vec_id", "label"):
                column = rows.column(c)
                columns += [column.fill_null(0).to_numpy().astype(np.int64), column.is_null().to_numpy().astype(np.uint8)]
            arrays = [pa.array([c.tobytes()], pa.binary()) for c in columns]
            arrays += [pa.array([width], pa.int32()), pa.array([trees], pa.list_(_TREE_TYPE))]
            return pa.RecordBatch.from_arrays(arrays, ["vec_ids", "no_id", "labels", "no_label", "width", "parts"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, block - count)
                held.append(part)
                count += part.num_rows
                at += part.num_rows
                if count == block:
                    yield build()
                    held, count = [], 0
        if count:
            yield build()

    return run


def _opened(row: dict, width: int) -> dict[str, np.ndarray]:
    out = {c: np.frombuffer(row[c], _TYPES.get(c, np.int32)) for c in _NAMES}
    for c in ("points", "sum", "centre"):
        out[c] = out[c].reshape(-1, width) if width else out[c].reshape(len(out["weights" if c == "points" else "count"]), 0)
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _sum_round(shared):
    """Adds up the sums of all blocks of a task: a row per number of the codebooks, counts first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, total = shared.value, None
        for block in _blocks(batches):
            found = []
            for part, book in zip(block["parts"], books, strict=True):
                tree = _opened(part, block["width"])
                count, sums = entry_sums(tree, tree["points"], tree["weights"], book)
                found.append(np.concatenate([count[:, None], sums], axis=1).reshape(-1))
            total = np.concatenate(found) + (0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["slot", "value"])

    return run


def _code_round(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for block in _blocks(batches):
            ids, labels = (np.frombuffer(block[c], np.int64) for c in ("vec_ids", "labels"))
            no_id, no_label = (np.frombuffer(block[c], np.uint8).astype(bool) for c in ("no_id", "no_label"))
            error, hexes = np.zeros(len(ids), np.int64), []
            for part, book in zip(block["parts"], books, strict=True):
                tree = _opened(part, block["width"])
                code = codes(tree, tree["points"], book)
                off = tree["points"] - book[code]
                error += np.einsum("ij,ij->i", off, off)[tree["of"]]
                hexes.append(code[tree["of"]])
            text = np.stack(hexes, 1).astype(np.uint8).tobytes().hex()
            step = 2 * len(hexes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, mask=no_id),
                    pa.array(labels, mask=no_label),
                    pa.array([text[i : i + step] for i in range(0, len(text), step)]),
                    pa.array(error),
                ],
                ["vec_id", "label", "code", "error"],
            )

    return run


# --- operator -----------------------------------------------------------------------------------


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v) of the rows that take part, v as integers."""
    v = F.col("v")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("long").alias("label"),
            F.col("embedding").cast("array<double>").alias("v"),
        )
        .filter(v.isNotNull() & finite)
        .withColumn("v", F.transform("v", lambda c: F.floor(c * scale).cast("long")))
    )


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for x in book.reshape(-1).tolist()).encode()).hexdigest()


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK
) -> tuple[DataFrame, list[np.ndarray]]:
    """Rows (vec_id, label, code, error) of ``vectors`` (vec_id, embedding, label), and the codebooks."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits: at most 256 entries")
    spark = vectors.sparkSession
    whole = scaled(vectors)
    first = whole.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(1).collect()
    size = len(first[0].v) if first else 0
    if size % parts:
        raise ValueError(f"vectors of {size} components cannot be cut into {parts} equal parts")
    whole = whole.filter(F.size("v") == size)
    seeds = np.array([r.v for r in whole.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()], np.int64)
    seeds = seeds.reshape(len(seeds), size)
    width = size // parts
    books = [seeds[:, p * width : (p + 1) * width].copy() for p in range(parts)]
    trees = keep(whole.mapInArrow(_build_blocks(parts, block), _BLOCK), "codes-trees")
    for _ in range(rounds if len(seeds) else 0):
        shared = spark.sparkContext.broadcast(books)
        sums = trees.mapInArrow(_sum_round(shared), "slot long, value long").groupBy("slot").agg(F.sum("value").alias("value")).toArrow()
        flat = np.zeros(parts * len(seeds) * (width + 1), np.int64)
        flat[sums.column("slot").to_numpy()] = sums.column("value").to_numpy()
        for book, found in zip(books, flat.reshape(parts, len(seeds), width + 1), strict=True):
            used = found[:, 0] > 0
            book[used] = found[used, 1:] // found[used, :1]
    shared = spark.sparkContext.broadcast(books)
    return trees.mapInArrow(_code_round(shared), "vec_id long, label long, code string, error long"), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``label_error``: the errors of all rows of the same label, null labels together."""
    coded = keep(coded, "codes-rows")
    sums = keep(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"), "codes-labels")
    if sums.count() <= LABELS:
        sums = F.broadcast(sums)
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")


def op11_vector_codes(spark, sf_dir: str) -> DataFrame:
    """Contract query: codes and errors of all vectors."""
    coded, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return with_label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
