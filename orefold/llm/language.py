"""Language identification by cross-parsing: the language whose training text needs the fewest phrases for a text wins.

A text is cut greedily into phrases: each is the longest run that occurs somewhere in the training text of a language.
The suffix automaton of that training text finds it: read symbols while a transition exists, else begin a new phrase. The
automaton is laid out as one table (state, symbol) -> state whose missing entries lead where the symbol leads from the
start, marked as a new phrase; so a text costs one lookup per symbol and language, and many pieces of text advance side by
side. Pieces are counted alone (one extra phrase each) and added up, so a long text is bounded work in any order.

Symbols are bytes of the lower-cased letters; everything else is one blank. Counts are normalised, since languages have learned
from different amounts of text: a phrase is worth the bits that point into the training text, the logarithm of its length, and
a symbol that the training text lacks at least the bits of a byte. These bits of a text are its cross-entropy by parsing.

Learning cuts all labelled texts, whole, into pieces of ``LEARNED_CHARS`` characters and takes ``LEARNED_PIECES`` different ones for
each language by their hashes, a text in turn with the others. That is a bounded sample from everywhere in the texts: rows
and passages that are repeated count once, no opening counts for more than the rest, and no long text for more than a short
one. Every text is scored whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orefold.llm import textgrid
from orefold.llm.common import prepare, remainder

FOLDS, HELD_OUT = 3, 1
LEARNED_CHARS = 256
LEARNED_PIECES = 48
LITERAL_BITS = 8
PIECE = 512
UNDETERMINED = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
for _byte in range(65, 91):
    _FOLD[_byte] = _byte + 32
    _FOLD[_byte + 32] = _byte + 32


def symbols(data: np.ndarray) -> np.ndarray:
    """Lower-cased letter bytes, blanks elsewhere. Latin capitals of two bytes are lowered too."""
    folded = _FOLD[data]
    if len(data) > 1:
        capital = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97))
        folded[capital + 1] += 32
    return folded


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts every substring of ``text`` (online construction)."""
    follow, link, length = [{}], [-1], [0]
    last = 0
    for symbol in text:
        new = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and symbol not in follow[state]:
            follow[state][symbol] = new
            state = link[state]
        if state >= 0:
            target = follow[state][symbol]
            if length[target] == length[state] + 1:
                link[new] = target
            else:
                split = len(follow)
                follow.append(dict(follow[target]))
                length.append(length[state] + 1)
                link.append(link[target])
                link[target] = link[new] = split
                while state >= 0 and follow[state].get(symbol) == target:
                    follow[state][symbol] = split
                    state = link[state]
        last = new
    return follow


@dataclass
class Parser:
    """One language: ``table[state * width + code]`` is twice the next state, plus one where a new phrase begins.

    The last state is where every text starts and where an unknown symbol, a phrase of its own, leads: any symbol read
    there begins a phrase.
    """

    code: np.ndarray
    width: int
    table: np.ndarray
    learned: int  # symbols of the training text

    @classmethod
    def of(cls, text: bytes) -> Parser:
        follow = suffix_automaton(text)
        seen = sorted(follow[0])
        code = np.zeros(256, np.int32)
        code[seen] = np.arange(1, len(seen) + 1)
        width = len(seen) + 1
        start = np.full(width, len(follow), np.int32)
        for symbol, state in follow[0].items():
            start[code[symbol]] = state
        table = np.tile(2 * start + 1, (len(follow) + 1, 1))
        rows = [state for state, edges in enumerate(follow) for _ in edges]
        columns = [code[symbol] for edges in follow for symbol in edges]
        table[rows, columns] = [2 * target for edges in follow for target in edges.values()]
        return cls(code, width, table.ravel(), len(text))

    def phrases(self, lanes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases of each piece: ``lanes[k]`` holds symbol k of all pieces, which are sorted by falling length."""
        state = np.full(len(lengths), len(self.table) // self.width - 1, np.int32)
        count = np.zeros(len(lengths), np.int32)
        active = np.searchsorted(-lengths, -np.arange(len(lanes)), "left")
        coded = self.code[lanes]
        for k in range(len(lanes)):
            n = active[k]
            step = self.table[state[:n] * self.width + coded[k, :n]]
            count[:n] += step & 1
            state[:n] = step >> 1
        return count

    def bits(self, phrases: np.ndarray, symbol_counts: np.ndarray) -> np.ndarray:
        """Cost of texts with so many phrases and symbols (a column for each of the 256)."""
        pointer = np.log2(max(self.learned, 2))
        unknown = symbol_counts[:, self.code == 0].sum(1)
        return (phrases - unknown) * pointer + unknown * max(pointer, LITERAL_BITS)


@dataclass
class Model:
    languages: list[str]
    parsers: list[Parser]


def _has_letter(column: pa.Array, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    plain = np.concatenate([[0], np.cumsum((data < 128) & (_FOLD[data] != 32))])
    found = plain[bounds[1:]] > plain[bounds[:-1]]
    for i in np.flatnonzero(~found):
        text = column[int(i)].as_py()
        found[i] = text is not None and any(map(str.isalpha, text))
    return found


def classify(column: pa.Array, model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of every text of a batch: the winner's share of inverse normalised counts, sharpened."""
    languages, scores = [], []
    parsers = model.parsers
    for low, high in textgrid.slices(column):
        part = column.slice(low, high - low)
        data, bounds = textgrid.texts(part)
        folded, sizes = symbols(data), np.diff(bounds)
        pieces = -(-sizes // PIECE)
        owner = np.repeat(np.arange(len(sizes)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = bounds[owner] + nth * PIECE
        length = np.minimum(PIECE, bounds[owner + 1] - start)
        order = np.argsort(-length, kind="stable")
        start, length, owner = start[order], length[order], owner[order]
        padded = np.concatenate([folded, np.full(PIECE, 32, np.uint8)])
        deepest = int(length[0]) if len(length) else 0
        lanes = padded[start[None, :] + np.arange(deepest)[:, None]]
        row = np.repeat(np.arange(len(sizes)), sizes)
        symbol_counts = np.bincount(row * 256 + folded, minlength=256 * len(sizes)).reshape(-1, 256)
        needed = np.array(
            [p.bits(np.bincount(owner, p.phrases(lanes, length), len(sizes)), symbol_counts) for p in parsers]
        ).reshape(-1, len(sizes))
        ok = _has_letter(part, data, bounds) & (len(parsers) > 0)
        if len(parsers):
            best = needed.argmin(0)
            share = (needed.min(0) / np.maximum(needed, 1e-9)) ** 4
            score = np.where(ok, 1 / np.maximum(share.sum(0), 1), 0.0)
        else:
            best, score = np.zeros(len(sizes), int), np.zeros(len(sizes))
        languages += [model.languages[b] if good else UNDETERMINED for b, good in zip(best, ok)]
        scores.append(score)
    return languages, np.concatenate(scores) if scores else np.zeros(0)


def learned_pieces(labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, list[str]]:
    """Per language at most ``LEARNED_PIECES`` different pieces of its texts: of each text the one whose hash is lowest, then of
    each the second, and so on, in the order of the hashes.

    A first pass estimates how many different first pieces there are. If they are many, a second keeps those below a hash that
    four times as many as are wanted should pass. The driver gets the sample only. Rows without text, letters or
    language give no pieces.
    """
    cut = F.regexp_extract_all(F.col(text).cast("string"), F.lit(f"(?s).{{1,{LEARNED_CHARS}}}"), F.lit(0))
    lettered = F.filter(cut, lambda piece: piece.rlike(r"\p{L}"))
    hashed = F.transform(lettered, lambda piece: F.struct(F.xxhash64(piece).alias("at"), piece.alias("piece")))
    texts = labelled.filter(F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("language"), F.array_sort(F.array_distinct(hashed)).alias("pieces")
    )
    first = texts.select("language", F.get("pieces", F.lit(0))["at"].alias("at")).filter(F.col("at").isNotNull())
    different = first.groupBy("language").agg(F.approx_count_distinct("at").alias("n")).collect()
    if not different:
        return {}
    passed = [(row["language"], 4 * LEARNED_PIECES / max(row["n"], 1)) for row in different]
    limits = [(language, int(share * 2**64) - 2**63 if share < 1 else None) for language, share in passed]
    limit = F.broadcast(labelled.sparkSession.createDataFrame(limits, "language string, highest long"))
    ranked = texts.join(limit, "language").select(
        "language", "highest", F.posexplode(F.slice("pieces", 1, LEARNED_PIECES)).alias("rank", "found")
    )
    low = F.col("highest").isNull() | ((F.col("rank") == 0) & (F.col("found.at") <= F.col("highest")))
    chosen = (
        ranked.filter(low)
        .groupBy("language", F.col("found.at").alias("at"))
        .agg(F.min("rank").alias("rank"), F.min("found.piece").alias("piece"))
        .withColumn("nth", F.row_number().over(Window.partitionBy("language").orderBy("rank", "at")))
        .filter(F.col("nth") <= LEARNED_PIECES)
    )
    found: dict[str, list[str]] = {language: [] for language, _ in sorted(limits)}
    for row in chosen.orderBy("language", "nth").collect():
        found[row["language"]].append(row["piece"])
    return found


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Parsers of all languages, each learned from its pieces joined by blanks."""
    pieces = learned_pieces(labelled, text, lang)
    joined = [np.frombuffer(" ".join(found).encode(), np.uint8) for found in pieces.values()]
    return Model(list(pieces), [Parser.of(symbols(text).tobytes()) for text in joined])


def predict(spark: SparkSession, text: Column, model: Model) -> Column:
    """Struct (lang_pred, score) of a text column."""
    shared = spark.sparkContext.broadcast(model)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("lang_pred string, score double")
    def scored(column: pa.Array) -> pa.Array:
        languages, scores = classify(column, shared.value)
        return pa.StructArray.from_arrays([pa.array(languages, pa.string()), pa.array(scores, pa.float64())], fields=list(kind))

    return scored(text.cast("string"))


def learned(docs: DataFrame) -> Model:
    """Model from the documents outside the held-out fold."""
    prepare(docs.sparkSession)
    return train(docs.filter(remainder("doc_id", FOLDS) != HELD_OUT))


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document. Null texts and texts without a letter are ``und``, score 0.

    With no labelled text at all every language is ``und``. Ties go to the language first in order.
    """
    model = model or learned(docs)
    found = docs.select(
        "doc_id",
        (remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        predict(docs.sparkSession, F.col("text"), model).alias("found"),
    )
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def accepted(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, that ``identify`` gives a language: only ``und`` goes, whatever the score.

    Where no language was learned everything would be ``und``; then only texts without a letter go.
    """
    model = learned(docs)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    return docs.filter(predict(docs.sparkSession, F.col("text"), model)["lang_pred"] != UNDETERMINED)
