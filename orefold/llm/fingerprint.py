"""Document fingerprints from improbable features in chained Bloom filters.

Every run of 16 bytes of a text is a candidate feature. Its rarity is how far its byte entropy lies from what is typical of
prose; among any 16 neighbouring runs the rarest, leftmost first, gains a point, and runs with ``POPULAR`` points or more
are the text's features. A text of fewer than ``FEW_RUNS`` runs has them all as features, one in which no run is popular its
rarest. What is chosen depends on the bytes around it alone, so shared passages share features wherever they
stand. Each feature sets five bits of a 2048-bit Bloom filter; after ``FILTER_FEATURES`` features the next filter of the
chain begins. Two filters are compared by the bits they share beyond chance, over the most they could share; a chain by
the best match of each filter of the shorter chain, weighed by its bits.

Entropies of all runs of a batch come from running sums over whole numbers: moving on by a byte changes the sum by what the
leaving and the entering byte count for. The batch is cut into lanes that move on side by side, each with its own counts. So equal runs have equal entropies wherever they stand, and a text costs its length. A text shorter than a run is one
feature; null counts as empty and has none. Equal texts have equal fingerprints, and equal fingerprints likeness 1.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.llm import textgrid
from orefold.llm.common import prepare

RUN = 16
NEIGHBOURS = 16
POPULAR = 6
FEW_RUNS = 96
LANES = 2048
TYPICAL = 780  # entropy of usual runs, in thousandths of the most that a run can have
FILTER_FEATURES = 160
FILTER_BITS = 2048
FILTER_HASHES = 5

_SCALE = 1 << 16
_N_LOG_N = np.array([0] + [round(n * np.log2(n) * _SCALE) for n in range(1, RUN + 2)], np.int64)
_GAIN = np.concatenate([[0], np.diff(_N_LOG_N)]).astype(np.int32)
_MOST = int(_N_LOG_N[RUN])


def entropies(data: np.ndarray) -> np.ndarray:
    """Entropy of every run of 16 bytes, in thousandths of the largest possible."""
    n = len(data)
    if n < RUN:
        return np.zeros(0, np.int32)
    lanes = max(1, min(LANES, n // (8 * RUN)))
    steps = -(-(n - RUN + 1) // lanes)
    padded = np.zeros(lanes * steps + RUN, np.uint8)
    padded[:n] = data
    ways = np.lib.stride_tricks.as_strided(padded, (steps + RUN, lanes), (1, steps), writeable=False)
    cell = ways + np.arange(lanes) * 256
    count = np.zeros(lanes * 256, np.int8)
    total = np.empty((steps, lanes), np.int32)
    total[0] = 0
    for t in range(RUN):
        have = count.take(cell[t]) + 1
        count[cell[t]] = have
        total[0] += _GAIN.take(have)
    for t in range(1, steps):
        leaving, entering = cell[t - 1], cell[t + RUN - 1]
        have = count.take(leaving)
        change = -_GAIN.take(have)
        count[leaving] = have - 1
        have = count.take(entering) + 1
        count[entering] = have
        change += _GAIN.take(have)
        np.add(total[t - 1], change, out=total[t])
    flat = np.ascontiguousarray(total.T).ravel()[: n - RUN + 1].astype(np.int64)
    return ((_MOST - flat) * 1000 // _MOST).astype(np.int32)


def _window_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, its length included."""
    return textgrid.span_hashes(textgrid.mix(data.astype(np.uint64) + np.uint64(1)), start, end)


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Owner and hash of the features of every text, in order of their places."""
    data, bounds = textgrid.texts(column)
    sizes = np.diff(bounds)
    score = entropies(data)
    owner, start = [], []
    if len(score):
        width = np.int64(len(data).bit_length())
        rank = (np.int64(2000) - np.abs(score.astype(np.int64) - TYPICAL)) << width | np.arange(len(score))
        runs = np.maximum(sizes - RUN + 1, 0)  # of each text
        rarest = textgrid.window_minimum(rank, NEIGHBOURS) & ((np.int64(1) << width) - 1)
        points = np.zeros(len(data) + 1, np.int32)
        long = np.flatnonzero(runs >= NEIGHBOURS)
        step = np.zeros(len(rarest) + 1, np.int32)
        np.add.at(step, bounds[long], 1)
        np.add.at(step, bounds[long] + runs[long] - NEIGHBOURS + 1, -1)
        valid = np.flatnonzero(np.cumsum(step[:-1]))
        points[: len(score)] = np.bincount(rarest[valid], minlength=len(score))[: len(score)]
        few = np.flatnonzero((runs > 0) & (runs < FEW_RUNS))
        every = np.repeat(bounds[few] - np.cumsum(runs[few]) + runs[few], runs[few]) + np.arange(runs[few].sum())
        points[every] = POPULAR
        chosen = np.flatnonzero(points >= POPULAR)
        owner.append(np.searchsorted(bounds, chosen, "right") - 1)
        start.append(chosen)
        none = np.flatnonzero((runs > 0) & (np.bincount(owner[0], minlength=len(sizes)) == 0))
        first = [int(bounds[i]) + int(rank[bounds[i] : bounds[i] + runs[i]].argmin()) for i in none]
        owner.append(none)
        start.append(np.array(first, np.int64))
    short = np.flatnonzero((sizes > 0) & (sizes < RUN))
    owner.append(short)
    start.append(bounds[short])
    owners, starts = np.concatenate(owner), np.concatenate(start)
    order = np.lexsort((starts, owners))
    owners, starts = owners[order], starts[order]
    ends = np.minimum(starts + RUN, bounds[owners + 1])
    return owners, _window_hashes(data, starts, ends)


def filters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bloom filters of all texts as rows of 256 bytes, and the first row of each text (one more than texts)."""
    owner, hashes = features(column)
    count = np.bincount(owner, minlength=len(column))
    chain = -(-count // FILTER_FEATURES)
    first = np.concatenate([[0], np.cumsum(chain)])
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    row = first[owner] + nth // FILTER_FEATURES
    bits = np.zeros((int(first[-1]), FILTER_BITS), np.uint8)
    for k in range(FILTER_HASHES):
        bits[row, (hashes >> np.uint64(11 * k)).astype(np.int64) & (FILTER_BITS - 1)] = 1
    return np.packbits(bits, axis=1), first


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """0 to 1 for two chains of filters (rows of 256 bytes)."""
    if one.shape == other.shape and np.array_equal(one, other):
        return 1.0
    if not len(one) or not len(other):
        return 0.0
    if len(one) > len(other):
        one, other = other, one
    one, other = (np.ascontiguousarray(rows).view(np.uint64) for rows in (one, other))
    have, theirs = np.bitwise_count(one).sum(1).astype(float), np.bitwise_count(other).sum(1).astype(float)
    best = np.zeros(len(one))
    for i in range(len(one)):
        shared = np.bitwise_count(one[i] & other).sum(1)
        chance = have[i] * theirs / FILTER_BITS
        room = np.minimum(have[i], theirs) - chance
        best[i] = np.max(np.where(room > 0, (shared - chance) / np.maximum(room, 1e-9), 1.0))
    return float(np.clip(np.average(best, weights=have), 0, 1))


def likenesses(ones: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Likeness of each pair; pairs of single filters are compared together."""
    found = np.zeros(len(ones))
    single = [i for i, (a, b) in enumerate(zip(ones, others)) if len(a) == len(b) == 1]
    if single:
        one, other = (np.concatenate([side[i] for i in single]).view(np.uint64) for side in (ones, others))
        have, theirs = np.bitwise_count(one).sum(1).astype(float), np.bitwise_count(other).sum(1).astype(float)
        chance = have * theirs / FILTER_BITS
        room = np.minimum(have, theirs) - chance
        score = np.where(room > 0, (np.bitwise_count(one & other).sum(1) - chance) / np.maximum(room, 1e-9), 1.0)
        found[single] = np.where((one == other).all(1), 1.0, np.clip(score, 0, 1))
    for i in set(range(len(ones))).difference(single):
        found[i] = likeness(ones[i], others[i])
    return found


def as_text(rows: np.ndarray) -> str:
    return base64.b64encode(rows.tobytes()).decode()


def fingerprints(column: pa.Array) -> list[np.ndarray]:
    """The chain of each text, worked out in slices of bounded size."""
    found = []
    for low, high in textgrid.slices(column):
        rows, first = filters(column.slice(low, high - low))
        found += [rows[a:b] for a, b in zip(first[:-1], first[1:])]
    return found


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of the beginning of the following document."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


# Spark: every document next to its successor


def _bucketed(docs: DataFrame) -> tuple[DataFrame, int]:
    """doc_id, text, bucket, carried: documents in ranges of doc_id, the first of a range repeated behind the range before.

    The range bounds are quantiles of doc_id, as many as shuffle partitions; the first range follows the last.
    """
    spark = docs.sparkSession
    wanted = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = docs.approxQuantile("doc_id", [k / wanted for k in range(1, wanted)], 0.2 / wanted) if docs.columns else []
    edges = np.array(sorted(set(bounds)), float)

    @F.arrow_udf("int")
    def bucket(ids: pa.Array) -> pa.Array:
        known = ids.fill_null(-(1 << 62)).to_numpy(zero_copy_only=False)
        return pa.array(np.searchsorted(edges, known, "left"), pa.int32())

    placed = docs.withColumn("bucket", bucket("doc_id"))
    least = F.min(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("least")
    firsts = placed.groupBy("bucket").agg(least).orderBy("bucket").collect()
    before = {row["bucket"]: firsts[i - 1]["bucket"] for i, row in enumerate(firsts)}
    number = F.coalesce("doc_id", F.lit(-(1 << 63)))
    table = spark.createDataFrame(
        [(row["bucket"], row["least"], before[row["bucket"]]) for row in firsts], "bucket int, least long, before int"
    )
    known = placed.join(F.broadcast(table), "bucket")
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("carried"))
    copy = F.struct(F.col("before").alias("bucket"), F.lit(True).alias("carried"))
    places = F.when(number == F.col("least"), F.array(own, copy)).otherwise(F.array(own))
    rows = known.select("doc_id", "text", F.explode(places).alias("at"))
    return rows.select("doc_id", "text", "at.bucket", "at.carried"), len(edges) + 1


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare(ids: list, texts: list[str], chains: list[np.ndarray]) -> pa.RecordBatch:
    """Result rows of all documents but the last, each with the one after it."""
    changed = [edited(text, following) for text, following in zip(texts, texts[1:])]
    edits = fingerprints(pa.array(changed, pa.large_string()))
    columns = [
        pa.array(ids[:-1], pa.int64()),
        pa.array([len(text) for text in texts[:-1]], pa.int64()),
        pa.array([hashlib.sha256(text.encode()).hexdigest() for text in changed], pa.string()),
        pa.array([as_text(chain) for chain in chains[:-1]], pa.string()),
        pa.array([as_text(chain) for chain in edits], pa.string()),
        pa.array(likenesses(chains[:-1], edits), pa.float64()),
        pa.array(likenesses(chains[:-1], chains[1:]), pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in RESULT.split(", ")])


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprint of every document and of its edited text, and their likeness, and that to the next document.

    Documents are in order of doc_id (null first), rows of equal id in order of their texts; the first follows the last. A
    single document follows itself. Every task reads one range of doc_id, once, in order.
    """
    prepare(docs.sparkSession)
    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    rows, buckets = _bucketed(narrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, chains, bucket, closed = [], [], [], None, False
        for batch in batches:
            for low, high in textgrid.slices(batch.column(1)):
                part = batch.slice(low, high - low)
                found = fingerprints(part.column(1))
                pending = zip(*(part.column(i).to_pylist() for i in range(4)), found)
                for doc_id, text, at, carried, chain in pending:
                    if at != bucket:
                        if len(ids) > 1:
                            yield _compare(ids, texts, chains)
                        ids, texts, chains, bucket, closed = [], [], [], at, False
                    if closed:
                        continue  # another row with the id of the next document
                    closed = carried
                    ids.append(doc_id)
                    texts.append(text)
                    chains.append(chain)
                if len(ids) > 1:
                    yield _compare(ids, texts, chains)
                    ids, texts, chains = ids[-1:], texts[-1:], chains[-1:]

    ordered = rows.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket", "carried", "doc_id", "text")
    return ordered.mapInArrow(run, RESULT)
