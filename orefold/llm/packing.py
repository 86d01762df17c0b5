"""Packing documents into token sequences: dominance reduction of the lengths, then best fit of what is left.

Only a document longer than a sequence is cut, so the instance is a multiset of lengths of at most ``CAPACITY``: however many
documents there are, it is a count per length. On that table the plan is made:

* Reduction after Martello and Toth. For the longest open length, the sequence {longest alone} or {longest, partner} is
  fixed for good where it dominates every other sequence with the longest in it: nothing fits beside it; or the longest
  partner fills it exactly; or no two pieces fit beside it; or no three do and no two are longer than the partner. All
  copies are fixed at once.
* The rest by best fit, longest first, again whole counts at a time: bins of equal free space are one group.

The plan is a list of runs: so many neighbouring sequences take so many pieces of one length each from one offset on. Its size
follows the number of distinct lengths, not of documents, so it is sent to every task. A piece finds its place by its number
among the pieces of its length. These numbers come from counts per (length, salt), so no length, however common, is
sorted or counted in one task.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orefold.llm import textgrid
from orefold.llm.common import prepare, store

CAPACITY = 4096
END_ID = 1
MEMO_PARTS = 200_000
TOGETHER_PARTS = 2000
SEPARATOR = "\x00"

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


# Token ids


_SPACE, _LETTER, _DIGIT, _PUNCTUATION, _OTHER, _SPECIAL = range(6)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
for _byte in range(33, 127):
    _CLASS[_byte] = _LETTER if chr(_byte).isalpha() else _DIGIT if chr(_byte).isdigit() else _PUNCTUATION
_CLASS[ord("'")] = _OTHER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# The letters that stand for bytes in vocabularies of byte-level models (fixed values): printable ones for themselves, the
# others in order from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_LETTERS = {byte: chr(byte) for byte in _PRINTABLE} | {
    byte: chr(256 + n) for n, byte in enumerate(sorted({*range(256)} - _PRINTABLE))
}


class PartTokenizer:
    """Ids of texts, for a tokenizer that lower-cases and joins neither words nor letters with digits or punctuation.

    A word of letters (ASCII and Latin-1), digits and ASCII punctuation is taken apart into its runs of one kind, lower-cased
    as bytes; a word with anything else (apostrophes, combining marks, other scripts) stays one part as it is. Equal
    parts of a slice are found by their 64-bit hashes, each is looked up once in a bounded memo by its bytes. Unknown runs of
    letters, which the library would hand to its model as they are, go to that model at once; other unknown parts are
    encoded together with a separator that is one token between them.

    The name of a special token in a text is that token, as the library has it: it is looked for in the text as it is, before
    anything else, and is a part of its own that ends the parts beside it.

    The memo has two generations: when the younger is full it becomes the older, and what is found there moves up again.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(token.normalized or token.single_word or token.lstrip or token.rstrip for token in added):
            raise ValueError("special tokens have to be found in the text as it is")
        names = sorted((token.content.encode() for token in added), key=len, reverse=True)
        self.names = re.compile(b"|".join(map(re.escape, names)) or b"(?!)")
        self.model = self.tokenizer.model
        self.separator = self._ids(SEPARATOR)
        if len(self.separator) != 4:
            raise ValueError("the separator has to be one token")
        self.memo: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _letters(self, part: bytes) -> bytes:
        """Ids of a lower-case run of letters: one word to the model, each byte as the letter that stands for it."""
        word = part.decode("latin-1").translate(_BYTE_LETTERS)
        return np.array([token.id for token in self.model.tokenize(word)], "<u4").tobytes()

    def _lookup(self, parts: list[bytes], letters: list[bool]) -> list[bytes]:
        if len(self.memo) > MEMO_PARTS // 2:
            self.memo, self.older = {}, self.memo
        unknown = []
        for part, plain in zip(parts, letters):
            if part not in self.memo:
                found = self.older.get(part)
                if found is not None:
                    self.memo[part] = found
                elif plain:
                    self.memo[part] = self._letters(part)
                else:
                    unknown.append(part)
        self._learn(unknown)
        return list(map(self.memo.__getitem__, parts))

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, parts: list[bytes]) -> None:
        """Encode unknown parts; those with the separator inside one by one."""
        mark = SEPARATOR.encode()
        for part in parts:
            if mark in part:
                self.memo[part] = self._ids(part.decode())
        plain = [part for part in parts if mark not in part]
        for low in range(0, len(plain), TOGETHER_PARTS):
            some = plain[low : low + TOGETHER_PARTS]
            raw = self._ids((b" " + mark + b" ").join(some).decode())
            ends = (4 * np.flatnonzero(np.frombuffer(raw, "<u4") == np.frombuffer(self.separator, "<u4"))).tolist()
            starts = [0, *(end + 4 for end in ends)]
            for part, start, end in zip(some, starts, [*ends, len(raw)], strict=True):
                self.memo[part] = raw[start:end]

    def _special(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """First byte and end of each name of a special token; none reaches from one text into the next."""
        found = np.array([match.span() for match in self.names.finditer(data)], np.int64).reshape(-1, 2)
        return found[np.searchsorted(bounds, found[:, 0], "right") == np.searchsorted(bounds, found[:, 1])]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text begins (one more than texts)."""
        data, bounds = textgrid.texts(column)
        kind, low = _CLASS[data], _LOWER[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)
        follow = data[lead + 1]
        latin = lead[(follow >= 0x80) & (follow <= 0xBF) & (follow != 0x97) & (follow != 0xB7)]
        kind[latin] = kind[latin + 1] = _LETTER
        low[latin[low[latin + 1] != 0x9F] + 1] |= 0x20  # capitals; sharp s stays
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        words = textgrid.split(column)
        # Words with a byte of another kind, and all their bytes.
        strange = np.unique(np.searchsorted(words.start, np.flatnonzero(kind == _OTHER), "right") - 1)
        sizes = words.end[strange] - words.start[strange]
        whole = np.repeat(words.start[strange] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        kind[whole] = _OTHER
        low[whole] = data[whole]
        special = self._special(data, bounds)
        for begin, stop in special.tolist():
            kind[begin:stop] = _SPECIAL
        edge[special] = True
        change = np.ones(len(data) + 1, bool)
        change[1:-1] = kind[1:] != kind[:-1]
        change |= edge
        inside = kind != _SPACE
        start = np.flatnonzero(inside & change[:-1])
        end = np.flatnonzero(inside & change[1:]) + 1
        parts = textgrid.Words(low, bounds, start, end, np.searchsorted(start, bounds))
        _, shown, which = np.unique(parts.hashes(), return_index=True, return_inverse=True)
        raw = low.tobytes()
        keys = [raw[a:b] for a, b in zip(start[shown].tolist(), end[shown].tolist())]
        ids = self._lookup(keys, (kind[start[shown]] == _LETTER).tolist())
        sizes = np.array([len(found) // 4 for found in ids], np.int64)
        flat = np.frombuffer(b"".join(ids), "<u4")
        counts = sizes[which]
        until = np.concatenate([[0], np.cumsum(counts)])
        shift = (np.cumsum(sizes) - sizes)[which] - until[:-1]
        tokens = flat[np.repeat(shift, counts) + np.arange(until[-1])]
        return tokens, until[parts.first]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> PartTokenizer:
    return PartTokenizer(path)


def token_pieces(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Pieces of every document: its ids and an end id, cut where it exceeds a sequence. Null texts are empty: one end id."""
    prepare(docs.sparkSession)
    narrow = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    end, width = np.array([END_ID], "<u4").tobytes(), 4 * CAPACITY

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in batches:
            rows: list[tuple] = []
            for low, high in textgrid.slices(batch.column(1)):
                tokens, first = own.encode(batch.column(1).slice(low, high - low))
                raw, bounds = tokens.tobytes(), (4 * first).tolist()
                for doc_id, begin, stop in zip(batch.column(0).slice(low, high - low).to_pylist(), bounds, bounds[1:]):
                    ids = raw[begin:stop] + end
                    for n, at in enumerate(range(0, len(ids), width)):
                        cut = ids[at : at + width]
                        rows.append((doc_id, n, at // 4, len(cut) // 4, zlib.crc32(cut)))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(columns, kinds)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return narrow.mapInArrow(run, PIECE)


# The plan


@dataclass(frozen=True)
class Run:
    """``bins`` neighbouring sequences from ``first`` on take ``copies`` pieces of ``length`` each, from ``offset`` on."""

    length: int
    first: int
    bins: int
    copies: int
    offset: int
    pieces: int  # the last sequence may get fewer


class Plan:
    def __init__(self) -> None:
        self.runs: list[Run] = []
        self.sequences = 0
        self.fixed = 0  # sequences settled by dominance

    def open(self, bins: int) -> int:
        self.sequences += bins
        return self.sequences - bins

    def put(self, length: int, first: int, bins: int, copies: int, offset: int, pieces: int | None = None) -> None:
        self.runs.append(Run(length, first, bins, copies, offset, bins * copies if pieces is None else pieces))


def _best_partner(left: np.ndarray, room: int) -> tuple[int, bool]:
    """Longest length in ``left`` (counts) that fits in ``room`` (0: none), and whether it dominates all other fillings."""
    lengths = np.flatnonzero(left[: room + 1])
    if not len(lengths):
        return 0, True
    longest, least = int(lengths[-1]), int(lengths[0])
    if longest == room:
        return longest, True
    second = least if left[least] > 1 else int(lengths[1]) if len(lengths) > 1 else room + 1
    if least + second > room:
        return longest, True
    small = np.repeat(lengths[:3], np.minimum(left[lengths[:3]], 3))[:3]
    if len(small) == 3 and small.sum() <= room:
        return longest, False
    fits = lengths[np.searchsorted(lengths, room - lengths, "right") - 1]
    ok = room - lengths >= least
    same = ok & (fits == lengths) & (left[lengths] < 2)
    fits = np.where(same, np.concatenate([[0], lengths])[np.searchsorted(lengths, fits)], fits)
    pair = np.where(ok & (fits > 0), lengths + fits, 0).max()
    return longest, bool(pair <= longest)


def reduce_by_dominance(left: np.ndarray, plan: Plan, capacity: int = CAPACITY) -> None:
    """Fix dominating sequences, taking their pieces out of the counts ``left``."""
    for length in range(capacity, 0, -1):
        while left[length]:
            left[length] -= 1
            partner, dominates = _best_partner(left, capacity - length)
            left[length] += 1
            if not dominates:
                break
            if partner == 0:
                bins = int(left[length])
                plan.put(length, plan.open(bins), bins, 1, 0)
                left[length] = 0
            elif partner == length:
                # Two fill a sequence, or dominance, which needs up to three more pieces of the length, has to be shown again.
                bins = int(left[length]) // 2 if 2 * length == capacity else max(int(left[length]) // 2 - 2, 1)
                plan.put(length, plan.open(bins), bins, 2, 0)
                left[length] -= 2 * bins
            else:
                bins = int(min(left[length], left[partner]))
                if length + partner < capacity:  # dominance has to be shown again as counts fall
                    bins = 1 if left[partner] <= 3 or left[length] <= 3 else bins - 3
                first = plan.open(bins)
                plan.put(length, first, bins, 1, 0)
                plan.put(partner, first, bins, 1, length)
                left[length] -= bins
                left[partner] -= bins
            plan.fixed = plan.sequences


def best_fit(left: np.ndarray, plan: Plan, capacity: int = CAPACITY) -> None:
    """Pack the counts ``left``, longest first, each into the fullest sequence that has room."""
    groups: dict[int, list[tuple[int, int]]] = {}  # free space -> [(first sequence, sequences)]
    for length in range(capacity, 0, -1):
        count = int(left[length])
        while count:
            free = min((room for room in groups if room >= length), default=None)
            if free is None:
                free, copies = capacity, capacity // length
                bins = -(-count // copies)
                first = plan.open(bins)
            else:
                first, have = groups[free].pop()
                if not groups[free]:
                    del groups[free]
                copies = free // length
                bins = min(have, -(-count // copies))
                if bins < have:
                    groups.setdefault(free, []).append((first + bins, have - bins))
            pieces = min(count, bins * copies)
            plan.put(length, first, bins, copies, capacity - free, pieces)
            count -= pieces
            short = bins * copies - pieces
            whole = bins - (1 if short else 0)
            for start, n, used in ((first, whole, copies), (first + whole, bins - whole, copies - short)):
                room = free - used * length
                if n and room:
                    groups.setdefault(room, []).append((start, n))
        left[length] = 0


def make_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    plan = Plan()
    reduce_by_dominance(left, plan, capacity)
    best_fit(left, plan, capacity)
    return plan


@dataclass
class Places:
    """The plan as arrays: for a length and a number among its pieces, the sequence and offset."""

    key: np.ndarray
    first: np.ndarray
    copies: np.ndarray
    offset: np.ndarray
    number: np.ndarray

    SHIFT = 48

    @classmethod
    def of(cls, plan: Plan) -> Places:
        taken: Counter[int] = Counter()
        rows = []
        for run in plan.runs:
            rows.append((run.length << cls.SHIFT | taken[run.length], run.first, run.copies, run.offset, taken[run.length]))
            taken[run.length] += run.pieces
        columns = np.array(sorted(rows), np.int64).reshape(-1, 5).T
        return cls(*columns)

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, length << self.SHIFT | number, "right") - 1
        nth = number - self.number[at]
        return self.first[at] + nth // self.copies[at], self.offset[at] + nth % self.copies[at] * length


# Spark


def numbered(pieces: DataFrame) -> DataFrame:
    """Add ``number``: 0, 1, ... among the pieces of equal length."""
    spark = pieces.sparkSession
    salts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        salted.groupBy("length", "salt")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("nth", F.row_number().over(within) - 1)
    return ranked.join(offsets, ["length", "salt"]).select(*pieces.columns, (F.col("base") + F.col("nth")).alias("number"))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a stored table of pieces (lengths from 1 to ``capacity``)."""
    spark = pieces.sparkSession
    counts = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = spark.sparkContext.broadcast(Places.of(make_plan(counts, capacity)))
    kind = pa.struct([("sequence_id", pa.int64()), ("offset", pa.int64())])

    @F.arrow_udf("sequence_id long, offset long")
    def place(length: pa.Array, number: pa.Array) -> pa.Array:
        found = places.value.find(length.to_numpy(zero_copy_only=False), number.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], fields=list(kind))

    placed = numbered(pieces).withColumn("place", place("length", "number"))
    return placed.select(*pieces.columns, "place.sequence_id", "place.offset")


def pack_documents(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    return pack(store(token_pieces(docs, path, text, key), "token-pieces"))
