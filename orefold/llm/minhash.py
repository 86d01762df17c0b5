"""Near duplicates: universal hash minima with banding, verification, and connected components by star rounds.

A document is the set of its distinct five-word shingles (words lower-cased in ASCII). Documents with equal sets form a class,
of which only the member with the smallest id goes on. A class has ``BANDS * ROWS`` minima of random linear functions of its
shingle hashes; each band of ``ROWS`` minima puts it in a bucket. At similarity 0.75 two classes share no bucket with
probability (1 - 0.75 ** 5) ** 40 = 2e-5.

Within a bucket no pairs are listed. First round: every member is compared with the bucket's smallest and largest id only. Of its
candidates each class keeps the one whose signature agrees most, and that link is confirmed on the full sets. The components of
these links are found. Second round, for buckets whose members ended up in different components: members outside the bucket's
most frequent component are compared with the members of other components, in blocks of about ``BLOCK`` by ``BLOCK`` members and
``BLOCK_BYTES`` by ``BLOCK_BYTES`` of text (or one longer text), inside a task each: first on sizes and signatures, then, for
members that may have a link in the block, on their texts. Only links leave it. So every pair of a bucket is either in one
component already or is compared itself, no list of pairs is ever made, and a bucket filled by one group of copies costs its
size. (Members of large families that are alike but just below the threshold cost the time of their pairs, and their texts
are copied to each block in which a signature can't tell them from links.)

Comparing means: sizes allow 0.75; then the share of equal minima (one byte each) is at least ``LEAST_AGREEMENT``, six standard
deviations below 0.75; then 100 * intersection >= 75 * union on the full sets, worked out from the whole texts.

Texts are read once for signatures; of the rest only those that may have a link are shuffled, in the second round once for each
block in which they may have one. Null texts and texts without words have empty
sets and link with nothing; a null doc_id links with nothing, its component is null and it is kept. Rows of equal id count
as one document, with the set of the row whose size and key are smallest; equal rows all get the same answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, MapType, VariantType

from orefold.llm import textgrid
from orefold.llm.common import drop, join_back, prepare, store
from orefold.llm.components import components

SHINGLE = 5
BANDS, ROWS = 40, 5
LEAST_PERCENT = 75
LEAST_AGREEMENT = 0.56
BROADCAST_PAIRS = 1_000_000
BLOCK = 512
BLOCK_BYTES = 8 << 20

_MINIMA = BANDS * ROWS
# A block; the place of its band is a key too, so that bands of different places with equal hashes stay apart.
_BLOCK = ("band", "place", "p", "q")
_RNG = np.random.Generator(np.random.PCG64(5))
_FACTOR = _RNG.integers(0, 1 << 32, _MINIMA, dtype=np.uint32) | np.uint32(1)
_SHIFT = _RNG.integers(0, 1 << 32, _MINIMA, dtype=np.uint32)
_BAND = _RNG.integers(0, 1 << 64, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_KEYS = _RNG.integers(0, 1 << 64, 2, dtype=np.uint64)

SIGNATURE = "doc_id long, n_bytes long, n_shingles long, key_a long, key_b long, bands array<long>, sketch binary"


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Owner and hash of every distinct shingle, sorted by both."""
    words = textgrid.split(column, lower=True)
    hashes, first = words.hashes(), words.first
    count = np.diff(first)
    runs = textgrid.run_hashes(hashes, SHINGLE)
    start = np.arange(len(runs))
    owner = words.owner[: len(runs)]
    inside = start + SHINGLE <= first[owner + 1]
    few = np.flatnonzero((count > 0) & (count < SHINGLE))
    owners = np.concatenate([owner[inside], few])
    values = np.concatenate([runs[inside], textgrid.span_hashes(hashes, first[few], first[few + 1])])
    order = np.lexsort((values, owners))
    owners, values = owners[order], values[order]
    new = np.ones(len(owners), bool)
    new[1:] = (owners[1:] != owners[:-1]) | (values[1:] != values[:-1])
    return owners[new], values[new]


def signatures(owner: np.ndarray, values: np.ndarray, texts: int) -> tuple[np.ndarray, ...]:
    """Set sizes, two set keys, bands and one byte of every minimum; zeros for empty sets."""
    sizes = np.bincount(owner, minlength=texts)
    some = np.flatnonzero(sizes)
    first = (np.cumsum(sizes) - sizes)[some]
    keys = np.zeros((2, texts), np.uint64)
    minima = np.zeros((texts, _MINIMA), np.uint32)
    if len(some):
        for k in range(2):
            keys[k, some] = np.add.reduceat(textgrid.mix(values ^ _KEYS[k]), first)
        short = (values >> np.uint64(32)).astype(np.uint32)
        for k in range(_MINIMA):
            minima[some, k] = np.minimum.reduceat(short * _FACTOR[k] + _SHIFT[k], first)
    bands = textgrid.mix((minima.reshape(texts, BANDS, ROWS).astype(np.uint64) * _BAND).sum(2, dtype=np.uint64))
    return sizes, keys[0], keys[1], bands, (minima >> np.uint32(8)).astype(np.uint8)


def agreement(one: pa.Array, other: pa.Array) -> np.ndarray:
    """Share of equal minima, corrected for bytes that are equal by chance."""
    sides = [np.frombuffer(b"".join(side.to_pylist()), np.uint8).reshape(-1, _MINIMA) for side in (one, other)]
    equal = (sides[0] == sides[1]).mean(1)
    return (equal - 1 / 256) / (1 - 1 / 256)


def similar(one: pa.Array, other: pa.Array) -> np.ndarray:
    """Whether the full shingle sets of each pair of texts meet 100 * intersection >= 75 * union."""
    found = np.zeros(len(one), bool)
    for low, high in textgrid.slices(one):
        for a, b in textgrid.slices(other.slice(low, high - low)):
            begin, n = low + a, b - a
            sets = [shingle_sets(side.slice(begin, n)) for side in (one, other)]
            sizes = [np.bincount(owner, minlength=n) for owner, _ in sets]
            owner, values = (np.concatenate([sets[0][i], sets[1][i]]) for i in range(2))
            order = np.lexsort((values, owner))
            owner, values = owner[order], values[order]
            both = np.flatnonzero((owner[1:] == owner[:-1]) & (values[1:] == values[:-1]))
            shared = np.bincount(owner[both], minlength=n)
            union = sizes[0] + sizes[1] - shared
            found[begin : begin + n] = (union > 0) & (100 * shared >= LEAST_PERCENT * union)
    return found


def signed(docs: DataFrame) -> DataFrame:
    """Signature table of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in textgrid.slices(batch.column(1)):
                part = batch.slice(low, high - low)
                sizes, key_a, key_b, bands, sketch = signatures(*shingle_sets(part.column(1)), high - low)
                flat = pa.array(bands.view(np.int64).ravel())
                offsets = pa.array(np.arange(0, BANDS * (high - low) + 1, BANDS, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.diff(textgrid.texts(part.column(1))[1])),
                        pa.array(sizes),
                        pa.array(key_a.view(np.int64)),
                        pa.array(key_b.view(np.int64)),
                        pa.ListArray.from_arrays(offsets, flat),
                        pa.array([row.tobytes() for row in sketch], pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "n_shingles", "key_a", "key_b", "bands", "sketch"],
                )

    return docs.mapInArrow(run, SIGNATURE)


@F.arrow_udf(DoubleType())
def _agreement(one: pa.Array, other: pa.Array) -> pa.Array:
    return pa.array(agreement(one, other), pa.float64())


@F.arrow_udf(BooleanType())
def _similar(one: pa.Array, other: pa.Array) -> pa.Array:
    return pa.array(similar(one, other), pa.bool_())


def _agreeing(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes and signatures allow a link, with their agreement."""
    side = lambda name: classes.select(
        F.col("id").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"sketch_{name}")
    )
    known = pairs.join(side("a"), "a").join(side("b"), "b")
    sized = known.filter(100 * F.least("n_a", "n_b") >= LEAST_PERCENT * F.greatest("n_a", "n_b"))
    rated = sized.select("a", "b", _agreement("sketch_a", "sketch_b").alias("agreement"))
    return rated.filter(F.col("agreement") >= LEAST_AGREEMENT)


def _confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (a, b), a stored table, whose full sets are similar.

    Only texts that take part are shuffled: up to ``BROADCAST_PAIRS`` pairs their ids are sent to the scan; beyond that the
    join itself finds them. Both sides share one exchange of the texts, and a frequent ``a`` is a skewed partition that is split.
    """
    if pairs.count() <= BROADCAST_PAIRS:
        ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        docs = docs.join(F.broadcast(ids), "doc_id", "left_semi")
    side = lambda name: docs.select(F.col("doc_id").alias(name), F.col("text").alias(f"text_{name}"))
    with_texts = pairs.join(side("b"), "b").join(side("a"), "a")
    return with_texts.filter(_similar("text_a", "text_b")).select("a", "b")


def _shared(buckets: DataFrame) -> DataFrame:
    """Members of buckets with two ids or more, with the smallest and the largest of them."""
    ends = (
        buckets.groupBy("band")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .filter(F.col("low") < F.col("high"))
    )
    return join_back(buckets, ends, ["band"], "bucket-ends").select(*buckets.columns, "low", "high")


def _with_ends(shared: DataFrame) -> DataFrame:
    """Each member with the smallest and the largest id of its bucket."""
    pairs = shared.select(F.explode(F.array("low", "high")).alias("a"), F.col("id").alias("b"))
    return pairs.filter(F.col("a") != F.col("b")).distinct()


def _mixed(shared: DataFrame, found: DataFrame) -> DataFrame:
    """Members of buckets with several components: their component, the bucket's most frequent one, and how many members
    and bytes of text there are, in all and outside that component."""
    labelled = shared.join(found.select(F.col("node").alias("id"), "component"), "id", "left").select(
        "band", "place", "id", "n", "n_bytes", F.coalesce("component", "id").alias("component")
    )
    labelled = store(labelled, "labelled-buckets")
    frequent = (
        labelled.groupBy("band", "component")
        .agg(F.count(F.lit(1)).alias("size"), F.sum("n_bytes").alias("bytes"))
        .groupBy("band")
        .agg(
            F.max_by("component", F.struct("size", "component")).alias("main"),
            F.sum("size").alias("all"),
            (F.sum("size") - F.max("size")).alias("others"),
            F.sum("bytes").alias("all_bytes"),
            (F.sum("bytes") - F.max_by("bytes", F.struct("size", "component"))).alias("other_bytes"),
        )
        .filter("others > 0")
    )
    return join_back(labelled, frequent, ["band"], "mixed-bands")


def _dealt(members: DataFrame) -> DataFrame:
    """Members dealt into blocks: those outside the main component (``asks``) against all, about ``BLOCK`` members and
    ``BLOCK_BYTES`` of text of each to a block, never more blocks than members."""

    def parts(members: str, size: str):
        return F.ceil(F.greatest(F.col(members) / BLOCK, F.least(F.col(members), F.col(size) / BLOCK_BYTES))).cast("int")

    rows, columns = parts("others", "other_bytes"), parts("all", "all_bytes")
    row, column = F.pmod(F.xxhash64("id"), rows).cast("int"), F.pmod(F.xxhash64("id", F.lit(1)), columns).cast("int")

    def at(p, q, asks: bool):
        return F.struct(p.alias("p"), q.alias("q"), F.lit(asks).alias("asks"))

    asking = F.transform(F.sequence(F.lit(0), columns - 1), lambda q: at(row, q, True))
    answering = F.transform(F.sequence(F.lit(0), rows - 1), lambda p: at(p, column, False))
    places = F.when(F.col("component") == F.col("main"), answering).otherwise(F.concat(asking, answering))
    return members.select("*", F.explode(places).alias("at")).select("*", "at.*").drop("at")


def sliced_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_sets`` of many texts, a slice at a time: what is held at once is the sets, not the work on all bytes."""
    parts = [(low, shingle_sets(texts.slice(low, high - low))) for low, high in textgrid.slices(texts)]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate([low + owner for low, (owner, _) in parts]), np.concatenate([values for _, (_, values) in parts])


def _partners(block: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Each asking member of a block with the members of other components whose sizes and signatures allow a link.

    A pair that shares an earlier band is left to the block of that band.
    """
    asks = block["asks"].to_numpy()
    ids, component, n = (block[name].to_numpy() for name in ("id", "component", "n"))
    main, place = block["main"][0].as_py(), block["place"][0].as_py()
    earlier = block["bands"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), place)
    sketch = np.frombuffer(b"".join(block["sketch"].to_pylist()), np.uint8).reshape(-1, _MINIMA)
    least = LEAST_AGREEMENT * (1 - 1 / 256) + 1 / 256
    for i in np.flatnonzero(asks).tolist():
        open_ = ~asks & (component != component[i]) & ((component == main) | (ids > ids[i]))
        open_ &= 100 * np.minimum(n, n[i]) >= LEAST_PERCENT * np.maximum(n, n[i])
        near = np.flatnonzero(open_)
        near = near[~(earlier[near] == earlier[i]).any(1)]
        near = near[(sketch[near] == sketch[i]).mean(1) >= least]
        if len(near):
            yield i, near


def with_partners(block: pa.Table) -> pa.Table:
    """The members of a block that have a possible link in it: those whose texts have to be compared."""
    needed = np.zeros(len(block), bool)
    for i, near in _partners(block):
        needed[i] = needed[near] = True
    return block.filter(pa.array(needed))


def compare_block(block: pa.Table) -> pa.Table:
    """Links (a, b) between components of one block, at most one for each asking member and component."""
    ids, component = block["id"].to_numpy(), block["component"].to_numpy()
    owner, values = sliced_sets(block["text"].combine_chunks())
    codes = np.unique(values, return_inverse=True)[1]
    first = np.searchsorted(owner, np.arange(len(ids) + 1))
    marked = np.zeros(int(codes.max(initial=-1)) + 1, bool)
    running = np.zeros(len(codes) + 1, np.int64)
    links: list[tuple[int, int]] = []
    for i, near in _partners(block):
        own = codes[first[i] : first[i + 1]]
        marked[own] = True
        np.cumsum(marked[codes], out=running[1:])
        marked[own] = False
        shared = running[first[near + 1]] - running[first[near]]
        union = len(own) + (first[near + 1] - first[near]) - shared
        linked = near[100 * shared >= LEAST_PERCENT * union]
        for j in linked[np.unique(component[linked], return_index=True)[1]].tolist():
            links.append((int(ids[i]), int(ids[j])))
    columns = list(zip(*links)) or [(), ()]
    return pa.table({"a": pa.array(columns[0], pa.int64()), "b": pa.array(columns[1], pa.int64())})


def _across_components(shared: DataFrame, found: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Confirmed links between components that meet in a bucket; a stored table.

    Blocks are first compared in their tasks on sizes and signatures alone. Only the members that may have a link in their
    block meet there again with their texts and are compared on full sets; no pair but a link leaves a block.
    """
    members = store(_mixed(shared, found), "mixed-buckets")
    signs = classes.select("id", "bands", "sketch")
    dealt = _dealt(members).join(signs, "id").withColumn("bands", F.slice("bands", F.lit(1), F.col("place")))
    block = dealt.select(*_BLOCK, "asks", "id", "component", "main", "n", "bands", "sketch")
    asked = store(block.groupBy(*_BLOCK).applyInArrow(with_partners, block.schema), "asked-members")
    ids = asked.select(F.col("id").alias("doc_id")).distinct()
    if ids.count() <= BROADCAST_PAIRS:
        ids = F.broadcast(ids)
    texts = docs.join(ids, "doc_id", "left_semi").groupBy(F.col("doc_id").alias("id")).agg(F.min("text").alias("text"))
    links = store(asked.join(texts, "id").groupBy(*_BLOCK).applyInArrow(compare_block, "a long, b long"), "links")
    drop(members, asked)
    return links


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    prepare(docs.sparkSession)
    narrow = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    table = store(signed(narrow), "signatures")
    keys = ["n_shingles", "key_a", "key_b"]
    members = store(table.select("doc_id", *keys), "members")
    sets = store(members.filter("n_shingles > 0").groupBy(*keys).agg(F.min("doc_id").alias("id")), "sets")
    first = sets.dropna(subset=["id"]).groupBy("id").agg(F.min(F.struct(*keys)).alias("of")).select("id", "of.*")
    signed_ids = table.withColumnRenamed("doc_id", "id").join(first, ["id", *keys]).dropDuplicates(["id"])
    classes = store(signed_ids.select("id", "n_bytes", F.col("n_shingles").alias("n"), "bands", "sketch"), "classes")
    drop(table)

    buckets = classes.select("id", "n", "n_bytes", F.posexplode("bands").alias("place", "value")).select(
        F.xxhash64("place", "value").alias("band"), "place", "id", "n", "n_bytes"
    )
    shared = store(_shared(buckets), "shared-buckets")
    candidates = _agreeing(_with_ends(shared), classes)
    nearest = candidates.groupBy("b").agg(F.max_by("a", F.struct("agreement", -F.col("a"))).alias("a"))
    pairs = store(nearest.select("a", "b"), "pairs")
    links = store(_confirmed(pairs, narrow), "links")
    found = components(links, "a", "b")
    more = _across_components(shared, found, classes, narrow)
    drop(pairs, shared, classes)
    if not more.isEmpty():
        drop(found)
        found = components(links.unionByName(more), "a", "b")
    drop(links, more)

    named = members.join(sets, keys, "left").join(found.select(F.col("node").alias("id"), "component"), "id", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "id", "doc_id"))
    result = named.select("doc_id", "n_shingles", component.alias("component_id"))
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents with all their columns, one of each group: the smallest id, and of a repeated id the row with the least
    text, then the least other columns.

    What goes is taken out by an anti join, so the texts aren't shuffled while its ids are few (checked).
    """
    found = store(near_duplicates(docs, text, key), "near-duplicates").dropna(subset=["doc_id"])
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    again = found.filter("kept").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("__again"))
    if gone.count() <= BROADCAST_PAIRS:
        gone = F.broadcast(gone)
    own = docs[key].cast("bigint")
    left = docs.join(gone, own == F.col("__gone"), "left_anti")
    if again.isEmpty():
        return left
    if again.count() <= BROADCAST_PAIRS:
        again = F.broadcast(again)
    own = left[key].cast("bigint")
    repeated = left.join(again, own == F.col("__again"), "left_semi")
    sortable = [f.name for f in docs.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    order = F.struct(F.col(text).alias("__text"), *[F.col(name).alias(f"__{i}") for i, name in enumerate(sortable)])
    least = repeated.groupBy(own.alias("__again")).agg(F.min_by(F.struct(*docs.columns), order).alias("__row"))
    once = least.select("__row.*")
    return left.join(again, own == F.col("__again"), "left_anti").unionByName(once)
