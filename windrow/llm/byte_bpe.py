"""Byte-level BPE: a segment tree over byte positions holds the leftmost pair of least rank."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from windrow.llm.common import Remembered, pick, ship, sliced, whole_text

#: Above every packed (rank, position).
NO_PAIR = np.int32(2**31 - 1)
#: Longest piece, in bytes, that is merged together with others; longer ones have a tree of their own.
JOINT_BYTES = 64
#: Pieces whose ids a Python worker remembers in each of two generations.
REMEMBERED = 200_000
#: Pieces that are merged together.
STEP = 20_000
#: Bytes of text that are split at once.
SLICE = 2 << 20
#: Ids that are decoded at once; a longer text is decoded alone, in steps of so many.
DECODED = 1 << 18


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """Ranks of a vocabulary, and the rank of every pair of its tokens that forms a token."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        if max(ranks.values()) * JOINT_BYTES >= NO_PAIR:
            raise ValueError("the vocabulary is too large for 32-bit trees")
        self.token_length = np.zeros(max(ranks.values()) + 1, np.int64)
        self.token_length[list(ranks.values())] = list(map(len, ranks))
        self.token_begin = np.cumsum(self.token_length) - self.token_length
        self.token_bytes = np.frombuffer(b"".join(sorted(ranks, key=ranks.__getitem__)), np.uint8)
        self.find = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.byte < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        self.wide = max(ranks.values()) + 1
        split = [(ranks[t[:k]] * self.wide + ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.pair_rank = dict(split)
        self.pair_keys = np.array(sorted(self.pair_rank), np.int64)
        self.pair_values = np.array([self.pair_rank[k] for k in self.pair_keys.tolist()], np.int64)
        self.known = Remembered(REMEMBERED)

    def packed(self, left: np.ndarray, right: np.ndarray, position: np.ndarray, size: int) -> np.ndarray:
        """Rank of each pair times ``size`` plus its position: least rank first, then leftmost. NO_PAIR without rank."""
        keys = left.astype(np.int64) * self.wide + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_values[at] * size + position, NO_PAIR).astype(np.int32)

    def merge_one(self, piece: bytes) -> list[int]:
        """Ids of a piece of any length."""
        n = len(piece)
        size = 1 << max(0, (n - 1).bit_length())
        none = (1 << 62, 0)
        ids = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, wide = self.pair_rank.get, self.wide
        tree = [none] * (2 * size)
        for i in range(n - 1):
            if (r := rank(ids[i] * wide + ids[i + 1])) is not None:
                tree[size + i] = (r, i)
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(i: int, value: tuple[int, int]) -> None:
            node = size + i
            tree[node] = value
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    return
                tree[node] = least

        while tree[1] != none:
            merged, i = tree[1]
            gone = after[i]
            follow = after[gone]
            ids[i], after[i] = merged, follow
            ids[gone] = -1
            put(gone, none)
            r = None
            if follow < n:
                before[follow] = i
                r = rank(merged * wide + ids[follow])
            put(i, none if r is None else (r, i))
            if (left := before[i]) >= 0:
                r = rank(ids[left] * wide + merged)
                put(left, none if r is None else (r, left))
        return [x for x in ids if x >= 0]

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """Ids, as little-endian 32-bit numbers, of pieces of 2 to JOINT_BYTES bytes: one tree each, stepped together."""
        out = [b""] * len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        leaves = 1 << np.ceil(np.log2(np.maximum(lengths, 2))).astype(np.int64)
        for size in np.unique(leaves).tolist():
            chosen = np.flatnonzero(leaves == size)
            for at in range(0, len(chosen), STEP):
                some = chosen[at : at + STEP].tolist()
                ids, count = self._together([pieces[k] for k in some], lengths[some], size)
                blob, ends = ids.astype("<i4").tobytes(), (4 * np.cumsum(count)).tolist()
                for k, begin, end in zip(some, [0, *ends], ends, strict=False):
                    out[k] = blob[begin:end]
        return out

    def _together(self, pieces: list[bytes], length: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids in turn, and how many each piece has. Row r of each table begins at r times its width."""
        m, wide = len(pieces), size + 1
        inside = np.arange(wide) < length[:, None]
        ids = np.full((m, wide), -1, np.int32)
        ids[inside] = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        tree = np.full((m, 2 * size), NO_PAIR, np.int32)
        paired = inside[:, 1:]
        tree[:, size:][paired] = self.packed(ids[:, :-1][paired], ids[:, 1:][paired], np.nonzero(paired)[1], size)
        node = size
        while node > 1:
            node >>= 1
            tree[:, node : 2 * node] = np.minimum(tree[:, 2 * node : 4 * node : 2], tree[:, 2 * node + 1 : 4 * node : 2])
        after = np.tile(np.arange(1, wide + 1, dtype=np.int32), (m, 1)).reshape(-1)
        before = np.tile(np.arange(-1, size, dtype=np.int32), (m, 1)).reshape(-1)
        live = np.flatnonzero(tree[:, 1] < NO_PAIR)
        ids, tree = ids.reshape(-1), tree.reshape(-1)
        while len(live):
            row, root = live * wide, live * (2 * size)
            merged, i = np.divmod(tree[root + 1], np.int32(size))
            gone = after[row + i]
            follow = after[row + gone]
            next_ = np.minimum(follow, size)
            ids[row + i], ids[row + gone] = merged, -1
            after[row + i], before[row + next_] = follow, i
            left = before[row + i]
            first = left < 0
            left = np.where(first, 0, left)
            right_value = np.where(follow < length[live], self.packed(merged, ids[row + next_], i, size), NO_PAIR)
            left_value = self.packed(ids[row + left], merged, left, size)
            leaf = np.stack((gone, i, np.where(first, i, left))) + size
            tree[root + leaf] = np.stack((np.full_like(i, NO_PAIR), right_value, np.where(first, right_value, left_value)))
            for _ in range(size.bit_length() - 1):
                leaf >>= 1
                child = root + 2 * leaf
                tree[root + leaf] = np.minimum(tree[child], tree[child + 1])
            live = live[tree[root + 1] < NO_PAIR]
        kept = ids >= 0
        return ids[kept], kept.reshape(m, wide).sum(1)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in turn, and where each text begins in them; equal pieces are merged once and remembered."""
        split = [self.find(text) for text in texts]
        known = self.known
        known.turn()
        new = known.missing(set().union(*split))
        short, raw = [], []
        for piece in new:
            data = piece.encode()
            if (whole := self.ranks.get(data)) is not None:
                known[piece] = whole.to_bytes(4, "little")
            elif len(data) > JOINT_BYTES:
                known[piece] = np.array(self.merge_one(data), "<i4").tobytes()
            else:
                short.append(piece)
                raw.append(data)
        known.update(zip(short, self.merge_many(raw), strict=True))
        blobs = [b"".join(map(known.__getitem__, pieces)) for pieces in split]
        ends = np.cumsum(np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4)
        return np.frombuffer(b"".join(blobs), "<i4"), np.concatenate(([0], ends))

    def decode(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts in turn, and where each text begins in them, from ids and where each text begins there."""
        ends = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.token_length[ids], out=ends[1:])
        data = np.empty(ends[-1], np.uint8)
        for k in range(0, len(ids), DECODED):
            part, end = ids[k : k + DECODED], ends[k : k + DECODED + 1]
            from_ = np.repeat(self.token_begin[part] - end[:-1], np.diff(end)) + np.arange(end[0], end[-1])
            data[end[0] : end[-1]] = self.token_bytes[from_]
        return data, ends[at]


def runs(begin: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of texts with at most ``most`` ids together; a longer text is a run of its own."""
    first = 0
    while first < len(begin) - 1:
        last = max(first + 1, int(np.searchsorted(begin, begin[first] + most, side="right")) - 1)
        yield first, last
        first = last


_merges: dict[tuple[str, str], Merges] = {}


def merges(path: str, pattern: str) -> Merges:
    """The tables of a vocabulary, built once per Python worker."""
    if (path, pattern) not in _merges:
        _merges[path, pattern] = Merges(read_ranks(path), pattern)
    return _merges[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and the ids of its whole text (``array<int>``).

    Each match of ``pattern`` is merged by itself; a match that is a token is taken whole. ``path`` names a rank file
    that exists on every executor, as part of an installed package does. NULL and empty texts have no ids. Rows are
    independent and need no shuffle; a very long text is held by one task.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merges(path, pattern)
        for part in sliced(batches, "text", SLICE):
            ids, at = table.encode(part.column("text").to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "ids"])

    source = pick(docs, doc_id=doc_id, text=whole_text(text))
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """Rows (doc_id, ids, data): the bytes that the ids stand for."""
    ship(tokens.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merges(path, pattern)
        for batch in batches:
            offsets = batch.column("ids").offsets.to_numpy().astype(np.int64)
            for first, last in runs(offsets, DECODED):
                part = batch.slice(first, last - first)
                begin = offsets[first : last + 1]
                data, ends = table.decode(batch.column("ids").values.to_numpy()[begin[0] : begin[-1]], begin - begin[0])
                texts = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), texts], ["doc_id", "ids", "data"])

    source = tokens.select("doc_id", "ids")
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids array<int>, data binary")
