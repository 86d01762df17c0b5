"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text has one feature per word occurrence (value 1 / number of words) and a fixed row of statistics: shares of symbols,
bars, exclamation marks, capitals and digits, word length, repeated words and lines, size, and the declared number of
characters against the found one. Every feature has a weight and a vector of ``RANK`` numbers; a pair of features adds the
product of their vectors. The sum over all pairs is half of (sum of vectors) squared minus the sum of squares, so scoring
is linear in the words. Learning uses at most ``PER_LABEL`` labelled texts per label, whole, with adaptive steps over
mini-batches. Null and empty texts have only statistics (all 0 but a mark for "no words"). Without labelled texts of both
labels every score is the share of label 1 (0 without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold.llm import textgrid
from orefold.llm.common import labelled, one_per_id, prepare, remainder

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
PER_LABEL = 1500
WIDTH = 1 << 16
RANK = 8
EPOCHS, STEPS, BATCH, RATE, L2 = 10, 400, 64, 0.02, 1e-4

STATISTICS = (
    "symbols", "bars", "exclamations", "capitals", "digits", "word_length", "repeated_words", "repeated_lines", "lines",
    "size", "no_words", "declared_size",
)
N_STATISTICS = len(STATISTICS)


def _marks(text: str) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(text.encode())] = True
    return found


_SYMBOLS, _BARS, _LOUD, _LINE = _marks("#*$%&<>"), _marks("|"), _marks("!"), _marks("\n")
_CAPITALS, _DIGITS = _marks("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _marks("0123456789")


def _repeated(owner: np.ndarray, values: np.ndarray, texts: int) -> np.ndarray:
    """How many of each text's values were there before."""
    order = np.lexsort((values, owner))
    same = (owner[order][1:] == owner[order][:-1]) & (values[order][1:] == values[order][:-1])
    return np.bincount(owner[order][1:][same], minlength=texts)


def features(column: pa.Array, declared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner and place of every word, and the statistics of every text (values of about 0 to 1).

    Lines count as repeated if they differ only in the kind of white space or in white space at their end.
    """
    words = textgrid.split(column)
    texts = len(column)
    sizes = np.diff(words.bounds)
    count = np.diff(words.first)
    some, letters = np.maximum(count, 1), np.maximum(sizes, 1)
    owner, hashes = words.owner, words.hashes()
    lines = textgrid.split(column, gap=_LINE)
    n_lines = np.diff(lines.first)
    characters = words.totals((words.data & 0xC0) != 0x80)
    table = np.zeros((texts, N_STATISTICS))
    table[:, 0] = np.minimum(words.totals(_SYMBOLS[words.data]) / some / 3, 1)
    table[:, 1] = np.minimum(words.totals(_BARS[words.data]) / some * 2, 1)
    table[:, 2] = np.minimum(words.totals(_LOUD[words.data]) / some / 2, 1)
    table[:, 3] = words.totals(_CAPITALS[words.data]) / letters
    table[:, 4] = words.totals(_DIGITS[words.data]) / letters
    table[:, 5] = np.minimum(sizes / some / 20, 1)
    table[:, 6] = _repeated(owner, hashes, texts) / some
    table[:, 7] = _repeated(lines.owner, lines.hashes(), texts) / np.maximum(n_lines, 1)
    table[:, 8] = np.minimum(n_lines / some * 5, 1)
    table[:, 9] = np.minimum(np.log1p(count) / 12, 1)
    table[:, 10] = count == 0
    table[:, 11] = np.where(declared >= 0, np.minimum(np.abs(declared - characters) / np.maximum(characters, 1), 1), 0)
    return owner, (hashes & np.uint64(WIDTH - 1)).astype(np.int64), table


@dataclass
class Model:
    bias: float
    linear: np.ndarray  # of words, then of statistics
    factors: np.ndarray

    def margin(self, owner: np.ndarray, places: np.ndarray, table: np.ndarray) -> np.ndarray:
        texts = len(table)
        some = np.maximum(np.bincount(owner, minlength=texts), 1)
        straight = np.bincount(owner, self.linear[places], texts) / some + table @ self.linear[WIDTH:]
        pairs = np.zeros(texts)
        for k in range(self.factors.shape[1]):
            of_words, of_statistics = self.factors[places, k], self.factors[WIDTH:, k]
            total = np.bincount(owner, of_words, texts) / some + table @ of_statistics
            squares = np.bincount(owner, of_words * of_words, texts) / some**2 + table**2 @ of_statistics**2
            pairs += total * total - squares
        return self.bias + straight + pairs / 2

    def score_column(self, column: pa.Array, declared: np.ndarray) -> np.ndarray:
        scores = []
        for low, high in textgrid.slices(column):
            found = features(column.slice(low, high - low), declared[low:high])
            scores.append(1 / (1 + np.exp(-np.clip(self.margin(*found), -35, 35))))
        return np.concatenate(scores) if scores else np.zeros(0)


def fit(rows: list[np.ndarray], table: np.ndarray, labels: np.ndarray) -> Model:
    """Adaptive steps over mini-batches (``EPOCHS`` times all rows, ``STEPS`` at least) on the log loss with L2.

    Only touched rows of the word vectors move.
    """
    share = float(labels.mean()) if len(labels) else 0.0
    rng = np.random.default_rng(7)
    size = WIDTH + N_STATISTICS
    linear, factors = np.zeros(size), rng.normal(0, 0.05, (size, RANK))
    if not 0 < share < 1:
        return Model(35.0 if share == 1 else -35.0, linear, np.zeros((size, RANK)))
    bias = float(np.log(share / (1 - share)))
    spread = np.zeros((size, RANK + 1))
    bias_spread = 0.0
    batches = -(-len(rows) // BATCH)
    epochs = max(EPOCHS, -(-STEPS // batches))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs) + RATE / 20
        for batch in np.array_split(rng.permutation(len(rows)), batches):
            some = [rows[i] for i in batch]
            counts = np.array([len(row) for row in some])
            owner = np.repeat(np.arange(len(some)), counts)
            words = np.concatenate(some)
            places, back = np.unique(words, return_inverse=True)
            value, own = np.repeat(1 / np.maximum(counts, 1), counts), table[batch]
            v, v_own = factors[words] * value[:, None], factors[WIDTH:]
            total = np.stack([np.bincount(owner, v[:, k], len(some)) for k in range(RANK)], 1) + own @ v_own
            squares = np.bincount(owner, (v * v).sum(1), len(some)) + own**2 @ (v_own**2).sum(1)
            straight = np.bincount(owner, linear[words] * value, len(some)) + own @ linear[WIDTH:]
            margin = bias + straight + ((total * total).sum(1) - squares) / 2
            slope = (1 / (1 + np.exp(-np.clip(margin, -35, 35))) - labels[batch]) / len(batch)
            each = (slope[owner] * value)[:, None] * (total[owner] - v)
            columns = np.concatenate([places, WIDTH + np.arange(N_STATISTICS)])
            gradient = np.empty((len(columns), RANK + 1))
            gradient[: len(places), 0] = np.bincount(back, slope[owner] * value, len(places))
            for k in range(RANK):
                gradient[: len(places), k + 1] = np.bincount(back, each[:, k], len(places))
            gradient[len(places) :, 0] = own.T @ slope
            gradient[len(places) :, 1:] = own.T @ (slope[:, None] * total) - (own**2).T @ slope[:, None] * v_own
            gradient += L2 * np.column_stack([linear[columns], factors[columns]])
            spread[columns] += gradient**2
            move = rate * gradient / (np.sqrt(spread[columns]) + 1e-8) * 5
            linear[columns] -= move[:, 0]
            factors[columns] -= move[:, 1:]
            bias_spread += slope.sum() ** 2
            bias -= rate * slope.sum() / (np.sqrt(bias_spread) + 1e-8)
    return Model(bias, linear, factors)


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model:
    """Learn from a bounded sample of labelled documents; only hashed words and statistics reach the driver."""
    prepare(docs.sparkSession)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, tables = [], []
            declared = batch.column(1).fill_null(-1).to_numpy(zero_copy_only=False)
            for low, high in textgrid.slices(batch.column(0)):
                owner, places, table = features(batch.column(0).slice(low, high - low), declared[low:high])
                lists += [part.tolist() for part in np.split(places, np.searchsorted(owner, np.arange(1, high - low)))]
                tables += table.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), batch.column(3), pa.array(lists, pa.list_(pa.int32())), pa.array(tables, pa.list_(pa.float64()))],
                ["label", "id", "places", "table"],
            )

    sample = labelled(docs, labels, "quality", per_label, FOLDS, HELD_OUT)
    sample = sample.select("text", "n_chars", "label", "labelled_id")
    kind = "label int, id long, places array<int>, table array<double>"
    found = one_per_id(sample.mapInArrow(measured, kind)).toArrow().sort_by("id")
    rows = [np.array(row, np.int64) for row in found["places"].to_pylist()]
    table = np.array(found["table"].to_pylist(), float).reshape(-1, N_STATISTICS)
    return fit(rows, table, np.array(found["label"].to_pylist(), float))


def score(spark: SparkSession, text: Column, declared: Column, model: Model) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(column: pa.Array, size: pa.Array) -> pa.Array:
        declared_size = size.fill_null(-1).to_numpy(zero_copy_only=False)
        return pa.array(shared.value.score_column(column, declared_size), pa.float64())

    return scored(text.cast("string"), declared.cast("long"))


def classify(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= 0.3) of every document."""
    model = model or train(docs, labels)
    declared = F.col("n_chars") if "n_chars" in docs.columns else F.lit(None)
    held_out = (remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out")
    scored = docs.select("doc_id", held_out, score(docs.sparkSession, F.col("text"), declared, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
