"""Toxicity: logistic regression over hashed words that must not react to which group a sentence mentions.

Learning minimises the log loss of labelled texts (both labels weigh the same), plus L2, plus ``PENALTY`` times the squared change of the score when
the identity terms of a labelled text are swapped for others of their kind. A group that happens to be mentioned in
toxic examples more often so gets no weight of its own, and neutral mentions aren't flagged.

A text is the set of its words (runs of letters and digits, ASCII lower-cased) hashed to ``WIDTH`` places. Words in fewer
than ``LEAST_DOCUMENTS`` sampled texts or a share of them below ``LEAST_SHARE``, words whose share differs between the labels by less than ``LEAST_ASSOCIATION`` standard
errors, and weights below ``PRUNE`` are left out. Learning uses at most ``PER_LABEL`` labelled texts
per label, whole; scoring is one pass over whole texts. Null and empty texts have no words and get the score of the
intercept. Without labelled texts of both labels every score is the share of label 1 (0 without any).
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

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
PER_LABEL = 5000
WIDTH = 1 << 20
LEAST_DOCUMENTS = 4
LEAST_SHARE = 0.002
LEAST_ASSOCIATION = 5.0
PENALTY = 40.0
L2 = 5e-5
STEPS = 400
PRUNE = 0.02

# Terms for groups of people; a swap replaces a term by another of its row.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("gay", "straight", "lesbian", "bisexual", "heterosexual", "transgender"),
    ("black", "white", "asian", "african", "latino", "arab"),
    ("american", "mexican", "chinese", "indian", "german", "french", "spanish", "turkish", "polish"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("old", "young", "elderly", "teenage"),
    ("blind", "deaf", "disabled", "paralyzed"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "hindus", "atheisten"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "hindous", "athées"),
    ("mujeres", "hombres", "chicas", "chicos"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "ateos"),
)


def word_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, place) pairs, sorted by text."""
    words = textgrid.split(column, lower=True, gap=textgrid.NOT_LETTERS)
    places = (words.hashes() & np.uint64(WIDTH - 1)).astype(np.int64)
    pairs = np.unique(words.owner * WIDTH + places)
    return pairs // WIDTH, pairs % WIDTH


def place_of(term: str) -> int:
    return int(word_features(pa.array([term]))[1][0])


def swaps(groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> dict[int, int]:
    """Place of each identity term -> place of the next term of its row; the rows are rings."""
    found: dict[int, int] = {}
    for group in groups:
        places = [place_of(term) for term in group]
        for place, other in zip(places, places[1:] + places[:1]):
            found.setdefault(place, other)
    return found


@dataclass
class Examples:
    """Sparse rows: the places of row i are ``places[first[i]:first[i + 1]]``."""

    first: np.ndarray
    places: np.ndarray

    @classmethod
    def of(cls, rows: list[np.ndarray]) -> Examples:
        first = np.concatenate([[0], np.cumsum([len(row) for row in rows])]).astype(np.int64)
        return cls(first, np.concatenate(rows) if rows else np.zeros(0, np.int64))

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, owner: np.ndarray, places: np.ndarray, texts: int) -> np.ndarray:
        return _sigmoid(self.bias + np.bincount(owner, self.weights[places], texts))

    def score_column(self, column: pa.Array) -> np.ndarray:
        scores = []
        for low, high in textgrid.slices(column):
            words = textgrid.split(column.slice(low, high - low), lower=True, gap=textgrid.NOT_LETTERS)
            places = (words.hashes() & np.uint64(WIDTH - 1)).astype(np.int64)
            known = np.flatnonzero(self.weights[places])
            pairs = np.unique(words.owner[known] * WIDTH + places[known])
            scores.append(self.score(pairs // WIDTH, pairs % WIDTH, high - low))
        return np.concatenate(scores) if scores else np.zeros(0)


def fit(rows: list[np.ndarray], labels: np.ndarray, swap: dict[int, int], penalty: float = PENALTY, steps: int = STEPS) -> Model:
    """Full-batch Adam on log loss, L2 and the squared score changes of swapped copies."""
    share = float(labels.mean()) if len(labels) else 0.0
    if not 0 < share < 1:
        return Model(np.zeros(WIDTH), 35.0 if share == 1 else -35.0)
    documents = np.bincount(np.concatenate(rows) if rows else [], minlength=WIDTH)
    toxic = np.bincount(np.concatenate([row for row, label in zip(rows, labels) if label > 0]), minlength=WIDTH)
    rate, n_toxic = documents / len(rows), labels.sum()
    expected_spread = np.sqrt(np.maximum(rate * (1 - rate), 1e-12) * (1 / n_toxic + 1 / (len(rows) - n_toxic)))
    difference = toxic / n_toxic - (documents - toxic) / (len(rows) - n_toxic)
    least = max(LEAST_DOCUMENTS, LEAST_SHARE * len(rows))
    active = (documents >= least) & (np.abs(difference) >= LEAST_ASSOCIATION * expected_spread)
    for place, other in swap.items():
        active[place] |= documents[place] > 0
        active[other] |= documents[place] > 0
    column = np.cumsum(active) - 1
    width = int(active.sum())

    originals, copies = [], []
    for i, row in enumerate(rows):
        mentioned = [place for place in row.tolist() if place in swap]
        if mentioned:
            kept = [place for place in row.tolist() if place not in swap]
            originals.append(i)
            copies.append(np.unique(np.array(kept + [swap[place] for place in mentioned], np.int64)))

    def compact(some: list[np.ndarray]) -> Examples:
        return Examples.of([column[row[active[row]]] for row in some])

    data, swapped = compact(rows), compact(copies)
    row, row_swapped = data.row, swapped.row
    origin = np.array(originals, np.int64)
    weights, bias = np.zeros(width), 0.0
    balance = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))
    moment, spread = np.zeros(width + 1), np.zeros(width + 1)
    n = len(rows)
    for step in range(1, steps + 1):
        score = _sigmoid(bias + np.bincount(row, weights[data.places], n))
        slope = balance * (score - labels) / n
        from_swapped = np.zeros(0)
        if len(origin):
            other = _sigmoid(bias + np.bincount(row_swapped, weights[swapped.places], len(origin)))
            change = 2 * penalty * (score[origin] - other) / n
            np.add.at(slope, origin, change * score[origin] * (1 - score[origin]))
            from_swapped = -change * other * (1 - other)
        gradient = np.empty(width + 1)
        gradient[:-1] = np.bincount(data.places, slope[row], width) + L2 * weights
        gradient[-1] = slope.sum() + from_swapped.sum()
        if len(origin):
            gradient[:-1] += np.bincount(swapped.places, from_swapped[row_swapped], width)
        moment = 0.9 * moment + 0.1 * gradient
        spread = 0.999 * spread + 0.001 * gradient**2
        move = 0.05 * (moment / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    weights[np.abs(weights) < PRUNE] = 0
    whole = np.zeros(WIDTH, np.float32)
    whole[active] = weights
    return Model(whole, float(bias))


def train(docs: DataFrame, labels: DataFrame, penalty: float = PENALTY, per_label: int = PER_LABEL) -> Model:
    """Learn from a bounded sample of labelled documents; only their hashed words reach the driver."""
    prepare(docs.sparkSession)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = []
            for low, high in textgrid.slices(batch.column(0)):
                owner, places = word_features(batch.column(0).slice(low, high - low))
                lists += [part.tolist() for part in np.split(places, np.searchsorted(owner, np.arange(1, high - low)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(lists, pa.list_(pa.int32()))], ["label", "id", "places"]
            )

    sample = labelled(docs, labels, "toxic", per_label, FOLDS, HELD_OUT).select("text", "label", "labelled_id")
    found = one_per_id(sample.mapInArrow(features, "label int, id long, places array<int>")).toArrow().sort_by("id")
    places = found["places"].combine_chunks() if found.num_rows else pa.array([], pa.list_(pa.int32()))
    rows = [np.array(row, np.int64) for row in places.to_pylist()]
    return fit(rows, np.array(found["label"].to_pylist(), float), swaps(), penalty)


def score(spark: SparkSession, text: Column, model: Model) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        return pa.array(shared.value.score_column(column), pa.float64())

    return scored(text.cast("string"))


def classify(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= 0.7) of every document."""
    model = model or train(docs, labels)
    held_out = (remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out")
    scored = docs.select("doc_id", held_out, score(docs.sparkSession, F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, with all their columns, whose score stays below the threshold."""
    model = train(docs, labels)
    return docs.filter(score(docs.sparkSession, F.col("text"), model) < THRESHOLD)
