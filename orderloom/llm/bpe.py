"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A task splits its texts into pieces and keeps each text as numbers of distinct pieces until enough pieces have gathered that it has not seen before. These
are laid end to end, and an inverted index leads from a merge to the positions where a token pair makes it. Merges are applied in rank
order over all pieces together: the index is kept in blocks of ``1 << BLOCK_BITS`` ranks, the lowest block with entries is taken, and every piece makes
its lowest merge of that block at once. Only the touched neighbours get new index entries. Pieces are independent, so a merge of
a higher rank in one piece may be made before one of a lower rank in another.

Within one piece, equal ranks go left to right. They are merged together unless a merge makes a pair of
lower rank; then only the leftmost one is merged and the others are looked at again later. Pieces that are tokens themselves are not merged.

The rank tables are built once, on the driver, and travel to the tasks as a broadcast of numpy arrays of fixed size (a few numbers per way
to cut a token of the vocabulary file in two). A worker process keeps one coder; known pieces lie flat in one array of ids.

Edge cases: null and empty texts have no tokens (``n_tokens`` 0, digests of the empty string); a null ``doc_id`` stays null; repeated rows
give repeated results; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import count, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from orderloom.llm.common import documents, pieces

# Distinct pieces a worker remembers, and how many of the first seen stay when it starts afresh; both change speed only.
CACHE = 120_000
STAY = 60_000
FRESH = 80_000  # new pieces that are replayed together
RUN_BYTES = 1 << 20
HELD_PIECES = 1 << 21  # piece numbers a task holds at most before it replays
BLOCK_BITS = 8


def read_ranks(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines.splitlines() if line)}


class Tables(NamedTuple):
    """A vocabulary as arrays: the tokens' ids and bytes end to end, and the rank of every pair that merges, ordered by pair."""

    ids: np.ndarray
    ends: np.ndarray
    raw: bytes
    pair_keys: np.ndarray
    pair_rank: np.ndarray


def tables(ranks: dict[bytes, int]) -> Tables:
    keys, merged = [], []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                keys.append(a << 32 | b)
                merged.append(rank)
    pair_keys, pair_rank = np.array(keys, np.int64), np.array(merged, np.int32)
    order = np.argsort(pair_keys)
    return Tables(
        np.array(list(ranks.values()), np.int32),
        np.cumsum([len(token) for token in ranks]),
        b"".join(ranks),
        np.append(pair_keys[order], np.iinfo(np.int64).max),
        np.append(pair_rank[order], np.int32(-1)),
    )


class MergeReplay:
    """Encodes and decodes with one rank table. ``pattern`` splits a text into pieces that are merged separately."""

    def __init__(self, vocabulary: Tables | dict[bytes, int], pattern: str):
        import regex

        known = vocabulary if isinstance(vocabulary, Tables) else tables(vocabulary)
        ends = known.ends.tolist()
        texts = [known.raw[a:b] for a, b in zip([0, *ends], ends)]
        self.split = regex.compile(pattern).findall
        self.ranks = dict(zip(texts, known.ids.tolist(), strict=True))
        largest = max(self.ranks.values())
        self.bytes_of = [b""] * (largest + 1)
        self.text_of = [""] * (largest + 1)
        for token, i in self.ranks.items():
            self.bytes_of[i] = token
            self.text_of[i] = str(i)
        self.pair_keys, self.pair_rank = known.pair_keys, known.pair_rank
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        first, second = np.repeat(self.byte_id, 256), np.tile(self.byte_id, 256)
        self.byte_pairs = self.rank_of(first, second)
        self.index: defaultdict[str, int] = defaultdict(count().__next__)  # piece -> its number
        self.known = 0
        self.flat = np.empty(0, np.int32)  # the ids of all known pieces, end to end
        self.ends = np.zeros(1, np.int64)

    def _shrink(self) -> None:
        """Keep the pieces seen first, which are the frequent ones."""
        self.known = min(STAY, self.known)
        self.index = defaultdict(count(self.known).__next__, islice(self.index.items(), self.known))
        self.ends = self.ends[: self.known + 1].copy()
        self.flat = self.flat[: self.ends[-1]].copy()

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; -1 where there is none."""
        key = (a.astype(np.int64) << 32) | b
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_rank[at], np.int32(-1))

    def replay(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all pieces end to end, and how many each has."""
        sizes = np.array([len(w) for w in words], np.int64)
        total = int(sizes.sum())
        if not total:
            return np.empty(0, np.int32), np.zeros(len(words), np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        ids = self.byte_id[raw]
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        ends = np.cumsum(sizes[sizes > 0])
        right = np.arange(1, total + 1, dtype=np.int32)
        right[ends - 1] = -1
        left = np.arange(-1, total - 1, dtype=np.int32)
        left[ends - sizes[sizes > 0]] = -1
        rank = np.full(total, -1, np.int32)  # of the pair that begins at a position
        inner = np.flatnonzero(right >= 0)
        rank[inner] = self.byte_pairs[raw[inner].astype(np.int64) * 256 + raw[inner + 1]]
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(at: np.ndarray) -> None:
            at = at[rank[at] >= 0]
            if not len(at):
                return
            block = (rank[at] >> BLOCK_BITS).astype(np.int16)
            order = np.argsort(block, kind="stable")
            block, at = block[order], at[order]
            cuts = np.flatnonzero(block[1:] != block[:-1]) + 1
            for b, part in zip(block[np.append(0, cuts)].tolist(), np.split(at, cuts), strict=True):
                if b in waiting:
                    waiting[b].append(part)
                else:
                    waiting[b] = [part]
                    heapq.heappush(heap, b)

        add(inner)
        while heap:
            b = heapq.heappop(heap)
            parts = waiting.pop(b)
            at = parts[0] if len(parts) == 1 else np.concatenate(parts)
            at = np.sort(at[(rank[at] >> BLOCK_BITS) == b])
            if not len(at):
                continue
            at = at[np.append(True, at[1:] != at[:-1])]
            # No lower block has entries: the lowest merge of a piece in this block is its lowest of all.
            lead = np.append(True, word[at[1:]] != word[at[:-1]])
            of = np.cumsum(lead) - 1
            r = rank[at]
            lowest = r == np.minimum.reduceat(r, np.flatnonzero(lead))[of]
            later = [at[~lowest]]
            at, r = at[lowest], r[lowest]
            same = word[at[1:]] == word[at[:-1]]
            if same.any():
                # Overlapping candidates: every other one of a chain, from its left end.
                chained = np.append(False, right[at[:-1]] == at[1:])
                if chained.any():
                    head = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
                    odd = (np.arange(len(at)) - head) % 2 == 1
                    later.append(at[odd])
                    at, r = at[~odd], r[~odd]
                second = right[at]
                after, before = right[second], left[at]
                prior = np.append(False, before[1:] == second[:-1])  # the token before is itself a result of this step
                follows = np.where(after >= 0, self.rank_of(r, ids[after]), -1)
                leads = np.where(before >= 0, self.rank_of(np.where(prior, r, ids[before]), r), -1)
                lower = ((follows >= 0) & (follows < r)) | ((leads >= 0) & (leads < r))
                if lower.any():
                    # Those pieces merge only their leftmost candidate now.
                    slow = np.isin(word[at], word[at[lower]])
                    take = ~slow | np.append(True, word[at[1:]] != word[at[:-1]])
                    later.append(at[~take])
                    at, r = at[take], r[take]
            second = right[at]
            after = right[second]
            ids[at] = r
            ids[second] = -1
            rank[second] = -1
            right[at] = after
            more = after >= 0
            left[after[more]] = at[more]
            before = left[at]
            rank[at] = -1
            begins = np.concatenate([at[more], before[before >= 0]])
            begins = begins[ids[begins] >= 0]
            rank[begins] = self.rank_of(ids[begins], ids[right[begins]])
            add(np.concatenate([begins, *later]))
        live = ids >= 0
        return ids[live], np.bincount(word[live], minlength=len(words))

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def numbered(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Each text as piece numbers. New pieces have none of their ids before :meth:`learn`."""
        number, split = self.index.__getitem__, self.split
        return [np.fromiter(map(number, split(t)), np.int32) for t in texts]

    @property
    def fresh(self) -> int:
        return len(self.index) - self.known

    def learn(self) -> None:
        """Encode all new pieces."""
        if not self.fresh:
            return
        new = [w.encode() for w in islice(self.index, self.known, None)]
        single = np.array([self.ranks.get(w, -1) for w in new], np.int32)
        sizes = np.ones(len(new), np.int64)
        flat, sizes[single < 0] = self.replay([w for w, s in zip(new, single.tolist(), strict=True) if s < 0])
        ends = np.cumsum(sizes)
        ids = np.empty(int(ends[-1]), np.int32)
        whole = np.repeat(single >= 0, sizes)
        ids[whole], ids[~whole] = single[single >= 0], flat
        self.flat = np.concatenate([self.flat, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + ends])
        self.known = len(self.index)

    def ids_of(self, numbers: np.ndarray) -> np.ndarray:
        begin = self.ends[numbers]
        size = self.ends[numbers + 1] - begin
        stop = np.cumsum(size)
        return self.flat[np.repeat(begin - (stop - size), size) + np.arange(int(stop[-1]) if len(stop) else 0)]

    def forget(self) -> None:
        """Called when no text is held as numbers."""
        if self.known > CACHE:
            self._shrink()

    def encode(self, text: str) -> list[int]:
        self.forget()
        (numbers,) = self.numbered([text])
        self.learn()
        return self.ids_of(numbers).tolist()


_coders: dict[tuple[int, str], MergeReplay] = {}


def _coder(shared, pattern: str) -> MergeReplay:
    """The coder of this worker process for a broadcast; it outlives the task, and only one is kept."""
    vocabulary = shared.value
    key = hash((vocabulary.raw, vocabulary.ids.tobytes())), pattern
    if key not in _coders:
        _coders.clear()
        _coders[key] = MergeReplay(vocabulary, pattern)
    return _coders[key]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text, and ``token_ids`` if asked for.

    ``decoded_sha256`` is the digest of the bytes that the ids decode to.
    """
    with open(ranks_path, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(tables(read_ranks(file.read())))

    def finished(coder: MergeReplay, doc_ids: list[pa.Array], held: list[np.ndarray]) -> pa.RecordBatch:
        coder.learn()
        n, ids_digest, decoded_digest, tokens = [], [], [], []
        for numbers in held:
            ids = coder.ids_of(numbers)
            listed = ids.tolist()
            n.append(len(listed))
            ids_digest.append(hashlib.sha256(",".join(map(coder.text_of.__getitem__, listed)).encode()).hexdigest())
            decoded_digest.append(hashlib.sha256(coder.decode(listed)).hexdigest())
            if with_ids:
                tokens.append(ids)
        columns = [pa.concat_arrays(doc_ids), pa.array(n, pa.int64()), pa.array(ids_digest), pa.array(decoded_digest)]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            ends = np.append(0, np.cumsum(n)).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(tokens))))
            names.append("token_ids")
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared, pattern)
        doc_ids: list[pa.Array] = []
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for part in pieces(batch, limit=RUN_BYTES):
                doc_ids.append(part.column("doc_id"))
                held += coder.numbered([t or "" for t in part.column("text").to_pylist()])
                size += sum(map(len, held[-part.num_rows :]))
                if coder.fresh >= FRESH or size >= HELD_PIECES:
                    yield finished(coder, doc_ids, held)
                    coder.forget()
                    doc_ids, held, size = [], [], 0
        if held:
            yield finished(coder, doc_ids, held)
        coder.forget()

    narrow = docs.select("doc_id", "text")
    schema = f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return narrow.mapInArrow(run, schema + (", token_ids array<int>" if with_ids else ""))


def op5_bpe(spark, sf_dir: str) -> DataFrame:
    """Contract query: token count and digests of ids and decoded bytes for every document."""
    import public_tokenizers

    return encode_documents(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )
