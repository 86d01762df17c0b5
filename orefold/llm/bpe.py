"""Byte-level BPE with a segment tree over byte positions.

A piece of text starts as one part per byte. Leaf ``i`` of the tree holds the rank of the merge of the live part that begins at
byte ``i`` with its live right neighbour (a constant above all ranks if there is none), every inner node the smaller of its
two children. The root so names the lowest rank, and going down to the left child whenever it holds that rank finds the
leftmost place. A merge clears one leaf and updates those of the merged part and of its left neighbour: three paths to the
root, so a piece of n bytes takes O(n log n) whatever it looks like. Live neighbours are kept in two link arrays.

Ranks are those of a tiktoken file; a piece that is itself a token is that token. A bounded memo per worker keeps the ids
of short pieces that recur.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.llm import textgrid
from orefold.llm.common import prepare

MEMO_PIECES = 400_000
TOGETHER_LONGEST = 64
TOGETHER_PIECES = 4096
NO_PAIR = 1 << 40


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece by repeated merges of the leftmost pair of lowest rank."""
    n = len(piece)
    if n < 2:
        return [ranks[piece]] if n else []
    size = 1 << (n - 1).bit_length()
    tree = [NO_PAIR] * (2 * size)
    find = ranks.get
    for i in range(n - 1):
        tree[size + i] = find(piece[i : i + 2], NO_PAIR)
    for node in range(size - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left <= right else right
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    while tree[1] != NO_PAIR:
        lowest, node = tree[1], 1
        while node < size:
            node *= 2
            if tree[node] != lowest:
                node += 1
        at = node - size
        gone = after[at]
        behind = after[gone]
        after[at] = behind
        if behind < n:
            before[behind] = at
        changed = [(gone, NO_PAIR)]
        changed.append((at, find(piece[at : after[behind]], NO_PAIR) if behind < n else NO_PAIR))
        left = before[at]
        if left >= 0:
            changed.append((left, find(piece[left:behind], NO_PAIR)))
        for place, rank in changed:
            node = size + place
            tree[node] = rank
            node >>= 1
            while node:
                left, right = tree[2 * node], tree[2 * node + 1]
                least = left if left <= right else right
                if tree[node] == least:
                    break
                tree[node] = least
                node >>= 1
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : after[at]]])
        at = after[at]
    return ids


class Merger:
    """The same merges for many short pieces at once: row ``r`` of each array is the tree of piece ``r``.

    Parts are token ids here, and the rank of a pair is looked up by its two ids: every split of every token into two
    tokens is one entry of a sorted table.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[key] for key in self.keys.tolist()], np.int64)
        self.byte = np.array([ranks[bytes([value])] for value in range(256)], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NO_PAIR)

    def merge_many(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece; all have at least two bytes. Meant for pieces of similar, small size."""
        lengths = np.array([len(piece) for piece in pieces])
        size = 1 << (int(lengths.max()) - 1).bit_length()
        rows = len(pieces)
        raw = np.frombuffer(b"".join(piece.ljust(size, b"\0") for piece in pieces), np.uint8).reshape(rows, size)
        token = self.byte[raw]
        places = np.arange(size)
        tree = np.full((rows, 2 * size), NO_PAIR, np.int64)
        first = self.rank(token[:, :-1], token[:, 1:])
        tree[:, size:-1] = np.where(places[1:] < lengths[:, None], first, NO_PAIR)
        level = size // 2
        while level:
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
            level //= 2
        after = np.tile(places + 1, (rows, 1))
        before = np.tile(places - 1, (rows, 1))
        alive = np.arange(rows)
        while True:
            alive = alive[tree[alive, 1] < NO_PAIR]
            if not len(alive):
                break
            lowest, node = tree[alive, 1], np.ones(len(alive), np.int64)
            for _ in range(size.bit_length() - 1):
                node *= 2
                node += tree[alive, node] != lowest
            at = node - size
            gone = after[alive, at]
            behind = after[alive, gone]
            token[alive, at] = lowest
            after[alive, at] = behind
            inner = np.flatnonzero(behind < lengths[alive])
            before[alive[inner], behind[inner]] = at[inner]
            tree[alive, size + gone] = NO_PAIR
            tree[alive, size + at] = NO_PAIR
            rows_in = alive[inner]
            tree[rows_in, size + at[inner]] = self.rank(token[rows_in, at[inner]], token[rows_in, behind[inner]])
            left = before[alive, at]
            outer = np.flatnonzero(left >= 0)
            rows_out = alive[outer]
            tree[rows_out, size + left[outer]] = self.rank(token[rows_out, left[outer]], token[rows_out, at[outer]])
            for owner, place in ((alive, gone), (alive, at), (rows_out, left[outer])):
                node = (size + place) >> 1
                for _ in range(size.bit_length() - 1):
                    tree[owner, node] = np.minimum(tree[owner, 2 * node], tree[owner, 2 * node + 1])
                    node >>= 1
        live = np.zeros((rows, size + 1), bool)
        live[:, 0] = True
        at = np.zeros(rows, np.int64)
        walking = np.arange(rows)
        while len(walking):
            at[walking] = after[walking, at[walking]]
            walking = walking[at[walking] < lengths[walking]]
            live[walking, at[walking]] = True
        ids = token[live[:, :-1]].tolist()
        ends = np.cumsum(live[:, :-1].sum(1)).tolist()
        return [ids[low:high] for low, high in zip([0, *ends], ends)]


@dataclass
class Encoder:
    ranks: dict[bytes, int]
    pattern: regex.Pattern
    memo: dict[str, list[int]] = field(default_factory=dict)
    decimal: dict[str, str] = field(default_factory=dict)
    long: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.merger = Merger(self.ranks)

    def _learn(self, pieces: set[str]) -> None:
        """Put the ids of unknown pieces into the memo, short ones in groups of similar size."""
        groups: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                self._put(piece, [whole])
            elif len(raw) > TOGETHER_LONGEST:
                self._put(piece, merge(raw, self.ranks))
            else:
                groups.setdefault((len(raw) - 1).bit_length(), []).append((piece, raw))
        for group in groups.values():
            for low in range(0, len(group), TOGETHER_PIECES):
                part = group[low : low + TOGETHER_PIECES]
                for (piece, _), ids in zip(part, self.merger.merge_many([raw for _, raw in part])):
                    self._put(piece, ids)

    def _put(self, piece: str, ids: list[int]) -> None:
        self.memo[piece] = ids
        self.decimal[piece] = ",".join(map(str, ids))

    def pieces_of(self, texts: list[str]) -> list[list[str]]:
        """Pieces of each text, all of them in the memo; long ones leave it next time, and a large memo starts anew."""
        found = list(map(self.pattern.findall, texts))
        if len(self.memo) > MEMO_PIECES:
            self.memo.clear()
            self.decimal.clear()
        for piece in self.long:
            self.memo.pop(piece, None)
            self.decimal.pop(piece, None)
        unknown = set().union(*found).difference(self.memo)
        self.long = [piece for piece in unknown if len(piece) > TOGETHER_LONGEST]
        self._learn(unknown)
        return found

    def encode(self, text: str) -> list[int]:
        (pieces,) = self.pieces_of([text])
        return list(chain.from_iterable(map(self.memo.__getitem__, pieces)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(load_ranks(path), regex.compile(pattern))


def token_digests(docs: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every whole text; null counts as empty.

    ``path`` is a rank file at the same place on every machine, ``pattern`` splits the text before the merges.
    """
    prepare(docs.sparkSession)
    narrow = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            counts, ids_digests, decoded = [], [], []
            for low, high in textgrid.slices(batch.column(1)):
                for pieces in own.pieces_of([value or "" for value in batch.column(1).slice(low, high - low).to_pylist()]):
                    ids = list(chain.from_iterable(map(own.memo.__getitem__, pieces)))
                    counts.append(len(ids))
                    ids_digests.append(hashlib.sha256(",".join(map(own.decimal.__getitem__, pieces)).encode()).hexdigest())
                    decoded.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return narrow.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
