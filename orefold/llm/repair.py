"""Conversation structure repair: the cheapest edits that make roles alternate, found by scalar big-integer weights.

Rows of a conversation may be kept, given the role user or assistant, or deleted, and empty turns of either role may be
inserted, until the role initials read ``(s?(ua)+)?``. The states of that pattern and the rows form a layered DAG. A path has
one whole number as its weight: high digits hold its cost, the digits below hold the letters of its edits, the first letter
highest, each of a fixed width, with zeros behind the last. The least weight of all paths is therefore the cheapest, of equal
costs the one whose letters are least in ASCII, a shorter audit before its continuations; the minimum of integers decides
everything, and the edits are read off the digits of the winner. The DP runs from the last row to the first, so that what
follows a node is settled before a letter is put in front of it: the letters move one digit down and the new one takes the
highest. Each layer needs the four weights behind it and no others.

Spark orders the rows: they are dealt out by conversation, sorted by turn, and streamed through a task that holds one byte a
row and the digests of the rows of one conversation. Texts don't reach that pass. A second pass streams them behind the
audit of their conversation and hashes the repaired turns without holding them.

* A null role or text counts as one space, as does a null turn or conv_id where the key of the damage is built. A null
  conv_id is a conversation like any other; a null turn sorts first and counts for no gap.
* Rows of equal turn are ordered by role, then text; rows repeated as a whole are duplicates from the second on.
* An empty table gives an empty result; further columns, whatever their names, are ignored.
* A very long conversation costs the square of its rows in digits (20,000 rows: some seconds), and memory in proportion.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.llm.common import prepare, store

GAPS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1

# Digits of the letters in ASCII order; 0 is the padding behind the last.
LETTERS = "\0DIKR"
DIGIT = {letter: number for number, letter in enumerate(LETTERS)}
DIGIT_BITS = 3

# What is known of a row: its role's initial, and whether it must go or ends unfinished.
INITIALS = "sua"
OTHER = 3
SOUND, UNFINISHED, DOOMED = 0, 4, 8

# States of ``(s?(ua)+)?``: nothing yet, after s, after u, after a. Accepted are the first and the last.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
ACCEPTED = (START, AFTER_A)
NEXT = {
    (START, 0): AFTER_S, (START, 1): AFTER_U, (AFTER_S, 1): AFTER_U, (AFTER_U, 2): AFTER_A, (AFTER_A, 1): AFTER_U,
}
ASSIGNABLE = (1, 2)  # user, assistant
ROLE_OF = {1: "user", 2: "assistant"}
PERMITTED = {(0, 1), (1, 2), (2, 1)}


def cheapest(codes: bytes) -> tuple[int, str]:
    """Cost and audit of the cheapest edits of a conversation whose rows have these codes."""
    digits = 3 * len(codes) + 2  # a row has one letter and at most two inserted turns before it
    high, top = DIGIT_BITS * digits, DIGIT_BITS * (digits - 1)
    mask = (1 << high) - 1
    edge = {
        (letter, more): ((COST[letter] + more) << high) + (DIGIT[letter] << top)
        for letter in COST
        for more in (0, TRUNCATED_COST)
    }

    def before(letter: str, weight: int | None, more: int = 0) -> int | None:
        """The weight with one more edit in front."""
        if weight is None:
            return None
        low = weight & mask
        return weight - low + (low >> DIGIT_BITS) + edge[letter, more]

    def least(*weights: int | None) -> int | None:
        return min((weight for weight in weights if weight is not None), default=None)

    def with_inserts(bare: list[int | None]) -> list[int | None]:
        """The layer if turns may also be inserted before its row. Two behind AFTER_A or AFTER_U would lead back there."""
        user, assistant = before(INSERT, bare[AFTER_U]), before(INSERT, bare[AFTER_A])
        both = before(INSERT, assistant)
        return [
            least(bare[START], user, both),
            least(bare[AFTER_S], user, both),
            least(bare[AFTER_U], assistant),
            least(bare[AFTER_A], user),
        ]

    layer = with_inserts([0 if state in ACCEPTED else None for state in range(4)])
    for code in reversed(codes):
        initial, fault = code & 3, code & ~3
        bare = []
        for state in range(4):
            found = [before(DELETE, layer[state])]
            if fault != DOOMED:
                more = TRUNCATED_COST if fault == UNFINISHED else 0
                if (state, initial) in NEXT:
                    found.append(before(KEEP, layer[NEXT[state, initial]], more))
                found += [
                    before(REROLE, layer[NEXT[state, role]], more) for role in ASSIGNABLE if (state, role) in NEXT
                ]
            bare.append(least(*found))
        layer = with_inserts(bare)
    weight = layer[START]
    letters = weight & mask
    audit = "".join(LETTERS[(letters >> shift) & 7] for shift in range(top, -1, -DIGIT_BITS)).rstrip("\0")
    return weight >> high, audit


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the damaged rows, and ``gone``: true marks a dropped row, which stays listed."""
    conv_id, turn = F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint")
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text"))
    said = [F.coalesce(part.cast("string"), F.lit(" ")) for part in (conv_id, turn)]
    kind = F.crc32(F.concat(said[0], F.lit(":"), said[1]).cast("binary")) % 20
    rows = conversations.select(
        conv_id.alias("conv_id"), turn.alias("turn"), role.alias("role"), text.alias("text"), kind.alias("kind")
    )
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.translate("text", ENDS, ""))
        .otherwise(F.col("text"))
        .alias("text"),
        (F.col("kind") == 0).alias("gone"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _ordered(rows: DataFrame, *first: str) -> DataFrame:
    """Whole conversations in a task, by turn (null first), then role and text."""
    return rows.repartition("conv_id").sortWithinPartitions(
        "conv_id", *first, F.col("turn").asc_nulls_first(), "role", "text"
    )


def _initial(role: Column) -> Column:
    letter = F.substring(role, 1, 1)
    code = F.lit(OTHER)
    for number, known in reversed(list(enumerate(INITIALS))):
        code = F.when(letter == known, number).otherwise(code)
    return code


_REPORT = pa.schema(
    [("conv_id", pa.int64())]
    + [(name, pa.int64()) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string())]
)
REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Conversation:
    """What the first pass gathers of the conversation whose rows it meets."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.codes, self.seen = bytearray(), set()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns = 0
        self.first = self.last = None

    def add(self, turn: int | None, initial: int, blank: bool, unfinished: bool, digest: bytes) -> None:
        if turn is not None and turn != self.last:
            self.turns += 1
            self.first = turn if self.first is None else self.first
            self.last = turn
        fault = SOUND
        if blank:
            self.blank += 1
            fault = DOOMED
        elif digest in self.seen:
            self.duplicate += 1
            fault = DOOMED
        elif unfinished:
            self.truncated += 1
            fault = UNFINISHED
        self.seen.add(digest)
        if self.codes:
            self.illegal += (self.codes[-1] & 3, initial) not in PERMITTED
        self.codes.append(initial | fault)

    def report(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        found = (self.blank, self.duplicate, self.truncated, self.illegal)
        return (self.conv_id, gaps, *found, *cheapest(bytes(self.codes)))


def _inspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, done = None, []
    for batch in batches:
        for conv_id, gone, *row in zip(*(column.to_pylist() for column in batch.columns)):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    done.append(now.report())
                now = _Conversation(conv_id)
            if not gone:
                now.add(*row)
        if done:
            yield _batch(done, _REPORT)
            done = []
    if now is not None:
        yield _batch([now.report()], _REPORT)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def inspect(damaged: DataFrame) -> DataFrame:
    """Faults, cost and audit of every conversation, one without a row left included; a stored table."""
    bare = F.rtrim(F.col("text"), F.lit(GAPS))
    rows = _ordered(damaged).select(
        "conv_id",
        "gone",
        "turn",
        _initial(F.col("role")).alias("initial"),
        (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(*ENDS)).alias("unfinished"),
        # The length of the role keeps (role, text) apart from any other pair with the same characters.
        F.unhex(F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary"))).alias("digest"),
    )
    return store(rows.mapInArrow(_inspect, REPORT), "repair-reports")


class _Rewriter:
    """Hashes the repaired turns of one conversation while its rows come by."""

    def __init__(self, report: tuple):
        self.report = report
        self.edits = iter(report[-1])
        self.state = START
        self.hash = hashlib.sha256()
        self.turns = 0

    def put(self, initial: int, role: str, text: str) -> None:
        self.state = NEXT[self.state, initial]
        self.hash.update(f"{'\n' if self.turns else ''}{role}:{text}".encode())
        self.turns += 1

    def wanted(self) -> int:
        """The role that a turn must have here if it is given one: assistant after user, else user."""
        return ASSIGNABLE[self.state == AFTER_U]

    def edit(self, letter: str, role: str, text: str) -> None:
        if letter == KEEP:
            self.put(INITIALS.index(role[0]), role, text)
        elif letter != DELETE:
            self.put(self.wanted(), ROLE_OF[self.wanted()], text)

    def row(self, role: str, text: str) -> None:
        while (letter := next(self.edits)) == INSERT:
            self.edit(letter, "", "")
        self.edit(letter, role, text)

    def finish(self) -> tuple:
        for letter in self.edits:
            self.edit(letter, "", "")
        return (*self.report, self.hash.hexdigest())


_REPAIRED = _REPORT.append(pa.field("repaired_sha256", pa.string()))
REPAIRED = f"{REPORT}, repaired_sha256 string"


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, done = None, []
    for batch in batches:
        for role, text, conv_id, *found in zip(*(column.to_pylist() for column in batch.columns)):
            if role is None:  # the report of the conversation comes before its rows
                if now is not None:
                    done.append(now.finish())
                now = _Rewriter((conv_id, *found))
            else:
                now.row(role, text)
        if done:
            yield _batch(done, _REPAIRED)
            done = []
    if now is not None:
        yield _batch([now.finish()], _REPAIRED)


def repair(damaged: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of the repaired turns of every conversation of ``damaged`` (see ``damage``)."""
    prepare(damaged.sparkSession)
    reports = inspect(damaged)
    names = [name for name in _REPORT.names if name != "conv_id"]
    nothing = [F.lit(None).cast("string").alias(name) for name in ("role", "text")]
    heads = reports.select(F.lit(0).alias("rank"), F.lit(None).cast("bigint").alias("turn"), *nothing, "conv_id", *names)
    left = damaged.filter(~F.col("gone")).select(
        F.lit(1).alias("rank"), "turn", "role", "text", "conv_id",
        *[F.lit(None).cast(heads.schema[name].dataType).alias(name) for name in names],
    )
    rows = _ordered(heads.unionByName(left), "rank").select("role", "text", "conv_id", *names)
    return rows.mapInArrow(_rewrite, REPAIRED)


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Damage the conversations by their keys and repair them; one row for every conv_id."""
    return repair(damage(conversations))
