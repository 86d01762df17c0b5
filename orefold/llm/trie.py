"""Prefix trie of conversations by fixed-length block hashing.

Every node of the trie is a distinct sequence of first turns; its members are the conversations that begin with it. Turns become
digests of 16 bytes, and the turns of a conversation blocks of a fixed number. A streaming pass chains the blocks: the digest
at the end of a block covers all turns up to it. Conversations are first grouped by these block digests, copies combined before
the shuffle. Where all members of a block's start share the whole block, the nodes inside it have the same members, and
nothing is hashed by turn. Only where siblings diverge are the turn boundaries inside the distinct blocks refined.

Sums over subtrees need no walk through the trie. A node is owned by its smallest member. The nodes that a conversation owns
are the lower end of its path, from its top on, so distinct turns are counted once by their owner:

    n_leaves     = members that own a childless node
    n_children   = members whose top hangs at the node, and one if the owner goes on
    saved_tokens = characters of all members from the node on, less those that a member at or below it owns

Each of these is a sum over the members of a node, that is, over blocks grouped by digest.

Joins back to a grouped table read the groups stored, so that a very common block is split by adaptive execution. The ids that
end at a node become texts of up to 4,096 neighbouring ids before a task streams them, in order, through one hash. A conversation
is streamed by one task, whatever its length; memory holds one block of it.

* A null role or text is empty, a null turn sorts first; rows of equal turn are ordered by role, then text, and all stay.
  Rows without a conv_id belong to no conversation and are ignored.
* A conversation without turns is a member of the root. An empty table has no root: the result is empty.
* Further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orefold.llm.common import drop, prepare, remainder, store

BLOCK_TURNS = 4
FAMILY = 100  # conversations c - c % 100 ... lend their first turns
OPENINGS = 6  # lengths 0 to 5
ROOT = bytes(16)
ID_BITS = 12  # ids whose higher bits agree are joined in one text before they are streamed


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), digest and chars of every turn, in the order of the conversation."""
    text, role = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("text", "role"))
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"), text.alias("text"),
    ).filter(F.col("conv_id").isNotNull())
    ordered = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    # The length of the role keeps (role, text) apart from any other pair with the same characters.
    said = F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary")
    return rows.withColumn("place", F.row_number().over(ordered)).select(
        "conv_id", "place", F.unhex(F.md5(said)).alias("digest"), F.length("text").cast("bigint").alias("chars")
    )


def rebuilt(told: DataFrame) -> DataFrame:
    """conv_id, depth, digest, chars: the first turns of the head of the family, then the own turns behind as many."""
    conversations = told.select("conv_id").distinct()
    openings = (
        told.filter((F.col("conv_id") % FAMILY == 0) & (F.col("place") < OPENINGS))
        .groupBy(F.col("conv_id").alias("head"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "digest", "chars"))).alias("opening"))
    )
    borrowed = (
        conversations.withColumn("head", F.col("conv_id") - F.col("conv_id") % FAMILY)
        .withColumn("wanted", remainder("conv_id", OPENINGS).cast("int"))
        .join(openings, "head", "left")
        .select("conv_id", "wanted", F.slice(F.coalesce("opening", F.array()), F.lit(1), F.col("wanted")).alias("opening"))
    )
    borrowed = store(borrowed, "openings")
    lent = borrowed.select("conv_id", F.explode("opening").alias("turn")).select(
        "conv_id", F.col("turn.place").cast("bigint").alias("depth"), "turn.digest", "turn.chars"
    )
    own = told.join(borrowed, "conv_id").filter(F.col("place") > F.col("wanted"))
    depth = (F.col("place") - F.col("wanted") + F.size("opening")).cast("bigint")
    return lent.unionByName(own.select("conv_id", depth.alias("depth"), "digest", "chars"))


_BLOCK = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("block", pa.int64()),
        ("begin", pa.binary()),
        ("end", pa.binary()),
        ("before", pa.int64()),
        ("digests", pa.list_(pa.binary())),
        ("chars", pa.list_(pa.int64())),
        ("last", pa.bool_()),
    ]
)
BLOCK = (
    "conv_id long, block long, begin binary, end binary, before long, digests array<binary>, chars array<long>, last boolean"
)


def chained(begin: bytes, digests: list[bytes]) -> bytes:
    return hashlib.md5(begin + b"".join(digests)).digest()


def _chained(begin: Column, digests: Column) -> Column:
    """``chained`` as a column expression."""
    return F.unhex(F.md5(F.aggregate(digests, begin, lambda joined, digest: F.concat(joined, digest))))


def blocks(path: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The blocks of every conversation with the chained digests at both ends and the characters before; a stored table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        block, begin, before, digests, chars = 0, ROOT, 0, [], []

        def close(last: bool) -> None:
            done.append((now, block, begin, chained(begin, digests), before, digests, chars, last))

        for batch in batches:
            for conv_id, _, digest, size in zip(*(column.to_pylist() for column in batch.columns)):
                if conv_id != now:
                    if now is not None:
                        close(True)
                    now, block, begin, before, digests, chars = conv_id, 0, ROOT, 0, [], []
                elif len(digests) == block_turns:
                    close(False)
                    block, begin, before, digests, chars = block + 1, done[-1][3], before + sum(chars), [], []
                digests.append(digest)
                chars.append(size)
            if done:
                yield _batch(done, _BLOCK)
                done.clear()
        if now is not None:
            close(True)
            yield _batch(done, _BLOCK)

    whole = path.select("conv_id", "depth", "digest", "chars").repartition("conv_id")
    return store(whole.sortWithinPartitions("conv_id", "depth").mapInArrow(run, BLOCK), "turn-blocks")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def variants(pieces: DataFrame, root_owner: int | None) -> DataFrame:
    """The distinct blocks: members, owner (the smallest), members that end in it; siblings with the same start, itself
    included; and the owner of the node above. A stored table."""
    same = ("block", "begin", "before", "digests", "chars")
    distinct = store(
        pieces.groupBy("end").agg(
            F.count(F.lit(1)).alias("members"),
            F.min("conv_id").alias("owner"),
            F.count_if("last").alias("ending"),
            *[F.any_value(name).alias(name) for name in same],
        ),
        "turn-variants",
    )
    above = distinct.select(F.col("end").alias("begin"), F.col("owner").alias("above"))
    begins = distinct.groupBy("begin").agg(F.count(F.lit(1)).alias("siblings")).join(above, "begin", "left")
    begins = store(begins.select("begin", "siblings", F.coalesce("above", F.lit(root_owner)).alias("above")), "block-starts")
    marked = store(distinct.join(begins, "begin"), "marked-variants")
    drop(distinct, begins)
    return marked


def refined(marked: DataFrame, block_turns: int) -> DataFrame:
    """The turns of the blocks in which siblings diverge: place, key (the digest up to the turn), depth, size, before_turn."""
    split = marked.filter(F.col("siblings") > 1)
    return _by_turn(split, block_turns).withColumn(
        "key", _chained(F.col("begin"), F.slice("digests", F.lit(1), F.col("place") + 1))
    )


def _by_turn(marked: DataFrame, block_turns: int) -> DataFrame:
    """One row per turn of each block: place (from 0), size, depth, and the characters before the turn."""
    return marked.select("*", F.posexplode("chars").alias("place", "size")).select(
        "*",
        (F.col("block") * block_turns + F.col("place") + 1).alias("depth"),
        (F.col("before") + F.aggregate(F.slice("chars", F.lit(1), F.col("place")), F.lit(0).cast("bigint"), _plus)).alias(
            "before_turn"
        ),
    )


def _plus(total: Column, more: Column) -> Column:
    return total + more


def profiles(marked: DataFrame, turns_of_split: DataFrame, block_turns: int) -> DataFrame:
    """What a block says of its owner: depth of the first node in it that it owns (null: none), owner of the node above that
    one, characters before it, and whether the block's last node is a leaf."""
    inner = store(turns_of_split.groupBy("key").agg(F.sum("members").alias("sharing"), F.min("owner").alias("node_owner")), "split-nodes")
    owned = F.col("owner") == F.col("node_owner")
    once = ("owner", "members", "ending", "above", "before")
    split = (
        turns_of_split.join(inner, "key")
        .groupBy("end")
        .agg(
            *[F.any_value(name).alias(name) for name in once],
            F.min(F.when(owned, F.col("depth"))).alias("top"),
            F.max(F.when(~owned, F.struct("depth", "node_owner"))).alias("foreign"),
            F.sum(F.when(owned, 0).otherwise(F.col("size"))).alias("skipped"),
            F.max_by("sharing", "depth").alias("sharing"),
        )
        .select(
            "owner",
            "top",
            F.coalesce("foreign.node_owner", "above").alias("above"),
            (F.col("before") + F.col("skipped")).alias("before_top"),
            ((F.col("ending") == F.col("members")) & (F.col("sharing") == F.col("members"))).alias("leaf"),
        )
    )
    alone = marked.filter(F.col("siblings") == 1).select(
        "owner",
        (F.col("block") * block_turns + 1).alias("top"),
        "above",
        F.col("before").alias("before_top"),
        (F.col("ending") == F.col("members")).alias("leaf"),
    )
    return split.unionByName(alone)


def facts(told: DataFrame, pieces: DataFrame, profile: DataFrame, block_turns: int) -> DataFrame:
    """Per conversation: turns, characters, where it ends, its top and the owner above it, owned characters, whether it owns a
    leaf. A stored table."""
    top = F.min(F.when(F.col("top").isNotNull(), F.struct("top", "above", "before_top")))
    tops = profile.groupBy(F.col("owner").alias("conv_id")).agg(top.alias("t"), F.bool_or("leaf").alias("leaf"))
    total = F.col("before") + F.aggregate("chars", F.lit(0).cast("bigint"), _plus)
    lasts = pieces.filter("last").select(
        "conv_id", "end", total.alias("total"), (F.col("block") * block_turns + F.size("chars")).alias("n_turns")
    )
    joined = told.select("conv_id").distinct().join(lasts, "conv_id", "left").join(tops, "conv_id", "left")
    return store(
        joined.select(
            "conv_id",
            F.coalesce("end", F.lit(ROOT)).alias("end"),
            F.coalesce("total", F.lit(0)).alias("total"),
            F.coalesce("n_turns", F.lit(0)).alias("n_turns"),
            F.col("t.top").alias("top"),
            F.col("t.above").alias("above"),
            F.coalesce(F.col("total") - F.col("t.before_top"), F.lit(0)).alias("owned"),
            F.coalesce("leaf", F.lit(False)).cast("bigint").alias("leaf"),
        ),
        "conversation-facts",
    )


def _digest_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, digest, done = None, None, []
    for batch in batches:
        for key, _, ids in zip(*(column.to_pylist() for column in batch.columns)):
            if key == now:
                digest.update(b"," + ids.encode())
                continue
            if now is not None:
                done.append((now, digest.hexdigest()))
            now, digest = key, hashlib.sha256(ids.encode())
        if done:
            yield _batch(done, _ENDS)
            done = []
    if now is not None:
        yield _batch([(now, digest.hexdigest())], _ENDS)


_ENDS = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])


def ends(known: DataFrame) -> DataFrame:
    """key and digest of the ascending conv_ids that end at the node; for nodes where any does."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    runs = known.groupBy(F.col("end").alias("key"), F.shiftright("conv_id", ID_BITS).alias("run")).agg(ids.alias("ids"))
    ordered = runs.repartition("key").sortWithinPartitions("key", "run")
    return ordered.mapInArrow(_digest_runs, "key binary, ends_sha256 string")


def nodes(marked: DataFrame, turns_of_split: DataFrame, pieces: DataFrame, known: DataFrame, block_turns: int) -> DataFrame:
    """All nodes but the root: conv_id (the owner), depth, key, n_convs, last size, characters before, sums over the members."""
    sums = store(
        pieces.select("conv_id", "end")
        .join(known.select("conv_id", "total", "owned", "leaf"), "conv_id")
        .groupBy("end")
        .agg(F.sum("total").alias("totals"), F.sum("owned").alias("owneds"), F.sum("leaf").alias("n_leaves")),
        "member-sums",
    )
    added = ("totals", "owneds", "n_leaves")
    split = (
        turns_of_split.join(sums, "end")
        .groupBy("key")
        .agg(
            F.min("owner").alias("conv_id"),
            F.any_value("depth").alias("depth"),
            F.any_value("before_turn").alias("before_turn"),
            F.sum("members").alias("n_convs"),
            *[F.sum(name).alias(name) for name in added],
        )
    )
    # A node inside an unsplit block is the end of no conversation: its name is its owner and depth.
    name = F.concat_ws(":", F.col("owner").cast("string"), F.col("depth").cast("string")).cast("binary")
    alone = _by_turn(marked.filter(F.col("siblings") == 1).join(sums, "end"), block_turns).select(
        F.when(F.col("place") == F.size("chars") - 1, F.col("end")).otherwise(name).alias("key"),
        F.col("owner").alias("conv_id"),
        "depth",
        "before_turn",
        F.col("members").alias("n_convs"),
        *added,
    )
    return split.unionByName(alone)


def _root(known: DataFrame) -> DataFrame:
    found = known.agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.count_if(F.col("top") == 1).alias("n_children"),
        F.sum("leaf").alias("leaves"),
        (F.sum("total") - F.sum("owned")).alias("saved_tokens"),
    ).filter(F.col("n_convs") > 0)
    return found.select(
        F.lit(ROOT).alias("key"), "conv_id", F.lit(0).cast("bigint").alias("depth"),
        F.lit(None).cast("bigint").alias("parent_conv_id"), "n_convs", "n_children",
        F.greatest("leaves", F.lit(1)).alias("n_leaves"), "saved_tokens",
    )


def prefix_trie(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    prepare(conversations.sparkSession)
    told = store(turns(conversations), "turns")
    root_owner = told.agg(F.min("conv_id")).first()[0]
    pieces = blocks(rebuilt(told), block_turns)
    marked = variants(pieces, root_owner)
    turns_of_split = refined(marked, block_turns)
    known = facts(told, pieces, profiles(marked, turns_of_split, block_turns), block_turns)
    drop(told)

    hanging = known.filter(F.col("top").isNotNull()).groupBy(
        F.col("above").alias("conv_id"), (F.col("top") - 1).alias("depth")
    )
    kids = hanging.agg(F.count(F.lit(1)).alias("kids"))
    owners = known.select("conv_id", "total", "owned", "n_turns", "top", "above")
    found = nodes(marked, turns_of_split, pieces, known, block_turns)
    inner = found.join(owners, "conv_id").join(kids, ["conv_id", "depth"], "left")
    distinct_chars = F.col("owneds") - F.col("owned") + F.col("total") - F.col("before_turn")
    trie = inner.select(
        "key",
        "conv_id",
        "depth",
        F.when(F.col("depth") == F.col("top"), F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        (F.coalesce("kids", F.lit(0)) + (F.col("n_turns") > F.col("depth")).cast("bigint")).alias("n_children"),
        "n_leaves",
        (F.col("totals") - F.col("n_convs") * F.col("before_turn") - distinct_chars).alias("saved_tokens"),
    ).unionByName(_root(known))
    nothing = hashlib.sha256(b"").hexdigest()
    return trie.join(ends(known), "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
