"""Repair and prefix trie of conversations against plain Python."""

import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from orefold.llm import repair, trie
from orefold.llm.common import table
from tests.llm.conftest import MIDDLE, SMALL

CONVERSATIONS = "conv_id long, turn long, role string, text string"
GAPS = " \t\n\x0b\x0c\r"
PATTERN = re.compile(r"(s?(ua)+)?")


def rows_of_table(folder):
    return duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{folder}/conversations.parquet'").fetchall()


EDGES = [
    (1, None, None, None), (1, None, "user", "No turn."), (1, 3, "user", "Gap before."), (1, 3, "user", "Gap before."),
    (1, 4, "", "No role."), (1, 5, "usher", "Another u."), (1, 6, "tool", "Neither."), (1, 7, "assistant", None),
    (2, 0, "system", "s."), (2, 1, "system", "s again"), (2, 2, "assistant", "Hi\x0b"), (2, 3, "assistant", "Hi!\x0b\r\n"),
    (3, 0, "user", " \t\n"), (3, 1, "user", " "), (3, 2, "user", "a.b?c!"),
    (4, 0, "user", "u:1."), (4, 1, "u", "ser:u:1."), (4, 2, "assistant", "x" * 70_000 + "."),
    (None, 0, "assistant", "No id."), (None, None, "user", "Neither."), (None, 0, "assistant", "No id."),
    (-5, 0, "user", "Negative."), (5, -2, "user", "Early."), (5, 2**40, "assistant", "Late."),
    (6, 0, "user", "ünïcödé ?"), (6, 1, "语", "初."), (6, 2, "assistant", "..."),
]


def damaged(rows):
    out = defaultdict(list)
    for conv_id, turn, role, text in rows:
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out[conv_id] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for listed in out.values():
        listed.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def faults_of(listed):
    seen, out = set(), []
    for _, role, text in listed:
        bare = text.rstrip(GAPS)
        fault = "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def searched(initials, faults):
    """Cheapest audit by comparing (cost, text) of all suffixes, forward with memory, letters as text."""
    memory = {}

    def best(i, state, inserted):
        if (i, state, inserted) in memory:
            return memory[i, state, inserted]
        found = []
        if i == len(initials) and state in ("", "a"):
            found.append((0, ""))
        follow = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        if inserted < 2:
            for c in follow:
                if c != "s" and (rest := best(i, c, inserted + 1)):
                    found.append((rest[0] + 2, "I" + rest[1]))
        if i < len(initials):
            if rest := best(i + 1, state, 0):
                found.append((rest[0] + 3, "D" + rest[1]))
            if faults[i] not in ("b", "d"):
                more = faults[i] == "t"
                for c in follow:
                    if initials[i] == c and (rest := best(i + 1, c, 0)):
                        found.append((rest[0] + more, "K" + rest[1]))
                    if c != "s" and (rest := best(i + 1, c, 0)):
                        found.append((rest[0] + 2 + more, "R" + rest[1]))
        memory[i, state, inserted] = min(found, default=None)
        return memory[i, state, inserted]

    return best(0, "", 0)


def repaired(listed, audit):
    rows, out, initials = iter(listed), [], ""
    for letter in audit:
        _, role, text = (None, "", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if initials[-1:] == "u" else "user"
        initials += role[0]
        out.append(f"{role}:{text}")
    assert next(rows, None) is None and PATTERN.fullmatch(initials)
    return hashlib.sha256("\n".join(out).encode()).hexdigest()


def expected_repairs(rows):
    left, out = damaged(rows), {}
    for conv_id in {row[0] for row in rows}:
        listed = left.get(conv_id, [])
        faults, turns = faults_of(listed), [turn for turn, _, _ in listed if turn is not None]
        initials = [role[:1] for _, role, _ in listed]
        cost, audit = searched(initials, faults)
        out[conv_id] = (
            conv_id,
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(kind) for kind in "bdt"),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
            cost,
            audit,
            repaired(listed, audit),
        )
    return out


def same_repairs(df, rows):
    found = df.collect()
    expected = expected_repairs(rows)
    assert len(found) == len(expected)
    for row in found:
        assert tuple(row) == expected[row["conv_id"]]


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
def test_repair_matches_a_search_over_all_edits(spark, folder):
    same_repairs(repair.repair_damaged(table(spark, folder, "conversations")), rows_of_table(folder))


def test_repair_of_edge_rows(spark):
    rows = [*EDGES, *[(7, i, "user" if i % 3 else "assistant", f"{i}{'.' if i % 4 else ''}") for i in range(300)]]
    df = spark.createDataFrame(rows, CONVERSATIONS).selectExpr("*", "1 AS gone", "2 AS kind", "3 AS audit", "4 AS rank")
    same_repairs(repair.repair_damaged(df), rows)


def test_repair_of_an_empty_table(spark):
    assert repair.repair_damaged(spark.createDataFrame([], CONVERSATIONS)).collect() == []


def test_conversation_without_a_row_left(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row = repair.repair_damaged(spark.createDataFrame([(dropped, 0, "user", "Hi.")], CONVERSATIONS)).first()
    assert tuple(row) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_weights_decide_every_short_conversation_as_a_search_does():
    """All codes of up to three rows, and ties: the least letters, a shorter audit before its continuations."""
    kinds = {repair.SOUND: "", repair.UNFINISHED: "t", repair.DOOMED: "b"}
    codes = [i | f for i in range(4) for f in kinds]
    for n in range(4):
        for chosen in itertools.product(codes, repeat=n):
            initials = [(repair.INITIALS + "x")[c & 3] for c in chosen]
            assert repair.cheapest(bytes(chosen)) == searched(initials, [kinds[c & ~3] for c in chosen])


def test_a_long_conversation_is_decided_whole():
    cost, audit = repair.cheapest(bytes([1, 2] * 4000 + [1]))
    assert cost == 2 and audit == "K" * 8001 + "I"


def expected_trie(rows):
    told = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            told[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    told = {c: [row[2:] for row in sorted(listed)] for c, listed in told.items()}
    members, paths = defaultdict(list), {}
    for c in sorted(told):
        h = zlib.crc32(str(c).encode()) % 6
        base = int(c / 100) * 100 if abs(c) < 2**50 else c - (abs(c) % 100) * (1 if c > 0 else -1)
        paths[c] = tuple(told.get(base, [])[:h] + told[c][h:])
        for d in range(len(paths[c]) + 1):
            members[paths[c][:d]].append(c)
    out = []
    for node, found in members.items():
        below = [other for other in members if other[: len(node)] == node]
        ending = ",".join(str(c) for c in found if len(paths[c]) == len(node))
        out.append(
            (
                found[0],
                len(node),
                members[node[:-1]][0] if node else None,
                len(found),
                sum(len(other) == len(node) + 1 for other in below),
                sum(not any(len(more) == len(other) + 1 and more[:-1] == other for more in below) for other in below),
                sum((len(members[other]) - 1) * len(other[-1][1]) for other in below if other),
                hashlib.sha256(ending.encode()).hexdigest(),
            )
        )
    return out


def same_trie(df, rows):
    assert sorted(map(tuple, df.collect()), key=lambda r: r[:2]) == sorted(expected_trie(rows), key=lambda r: r[:2])


def test_trie_matches_plain_python(spark):
    same_trie(trie.prefix_trie(table(spark, SMALL, "conversations")), rows_of_table(SMALL))


@pytest.mark.parametrize("block_turns", [1, 2, 4])
def test_trie_of_copies_forks_and_long_conversations(spark, block_turns):
    rows = list(EDGES)
    for c in range(100, 160):  # many copies, forks in and between blocks, openings lent by 100
        rows += [(c, t, "user", "same") for t in range(c % 11)] + [(c, 20 + t, "user", f"{c % 3}") for t in range(c % 5)]
    rows += [(300 + c, t, "user", "ab"[t == c]) for c in range(6) for t in range(30)]
    rows += [(2**62 + 100 - 2**62 % 100 + c, t, "x", "far") for c in range(3) for t in range(3)]
    df = spark.createDataFrame(rows, CONVERSATIONS).selectExpr("*", "1 AS place", "2 AS block", "3 AS owner", "4 AS key")
    same_trie(trie.prefix_trie(df, block_turns), rows)


def test_trie_of_random_small_alphabets(spark):
    """Every fork, end and copy that few words allow."""
    import random

    draw = random.Random(7)
    rows = [
        (c, t, draw.choice("ua"), draw.choice(["", "x", "yy"])) for c in range(-40, 240) for t in range(draw.randrange(1, 9))
    ]
    same_trie(trie.prefix_trie(spark.createDataFrame(rows, CONVERSATIONS)), rows)


def test_trie_without_turns_and_of_an_empty_table(spark):
    short = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 0][:3]
    rows = [(c, 0, "user", "lost") for c in short]
    same_trie(trie.prefix_trie(spark.createDataFrame(rows, CONVERSATIONS)), rows)
    assert trie.prefix_trie(spark.createDataFrame([], CONVERSATIONS)).collect() == []
    assert trie.prefix_trie(spark.createDataFrame([(None, 0, "user", "x")], CONVERSATIONS)).collect() == []
