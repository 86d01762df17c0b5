"""Line dedup against plain Python."""

import hashlib
from collections import defaultdict

import pytest

from orefold.llm import lines

GAPS = " \t\n\x0b\x0c\r"
UPPER = {ord("A") + i: ord("a") + i for i in range(26)}

EDGES = [
    (1, None),
    (2, ""),
    (3, "\n\n \n\x0b"),
    (4, "Alpha \n\tbeta\r\nÄlpha\nalpha"),
    (5, "ALPHA\nälpha\nÄLPHA\n alpha"),
    (6, "alpha\nbeta\ngamma"),
    (6, "alpha\nbeta\ngamma"),
    (6, "beta\nalpha"),
    (None, "no id\nalpha"),
    (None, "no id"),
    (7, "trailing\n"),
    (8, "x" * 60_000 + "\nbeta\n" + "语" * 3000),
    (9, "\n".join(f"line {i}" if i % 7 else "beta" for i in range(20_000)) + "\nalpha"),
    (10, "\n".join(["alpha", *["own"] * 200, "alpha", *["other"] * 300])),
]


def expected(rows, least, chars=1, keep_first=False):
    found = defaultdict(set)
    split = [(doc_id, (text or "").split("\n")) for doc_id, text in rows]

    def key(line):
        return line.strip(GAPS).translate(UPPER)

    order = lambda d: (d is not None, d or 0)
    for doc_id, listed in split:
        for place, line in enumerate(listed):
            if len(key(line)) >= chars:
                found[key(line)].add((order(doc_id), place))
    common = {k: min(v) for k, v in found.items() if len({d for d, _ in v}) >= least}
    out = []
    for doc_id, listed in split:
        kept = [
            line
            for place, line in enumerate(listed)
            if key(line) not in common or keep_first and common[key(line)] == (order(doc_id), place)
        ]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((doc_id, len(listed), len(listed) - len(kept), digest))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("least, chars", [(1, 1), (2, 0), (3, 1), (4, 5), (10, 1)])
def test_digests_match_plain_python(documents, least, chars):
    df = documents(EDGES).selectExpr("*", "1 AS body", "2 AS place", "3 AS high", "4 AS n_dropped", "5 AS keep_words")
    assert ordered(lines.removal_digests(df, least, chars).collect()) == ordered(expected(EDGES, least, chars))


def test_the_first_of_all_occurrences_may_stay(documents):
    rows = [row for row in EDGES if row[0] != 6]
    docs = documents(rows)
    kept = lines.apply_bitmaps(docs, lines.keep_bitmaps(docs, 2, keep_first=True))
    found = [(r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) for r in kept.collect()]
    assert ordered(found) == ordered(expected(rows, 2, keep_first=True))


def test_bitmaps_store_no_full_words(documents):
    docs = documents([(i, "\n".join([f"{i} {n}" for n in range(10_000)] + ["end"])) for i in range(3)])
    words = lines.keep_bitmaps(docs, 3).first()["keep_words"]
    assert [(w["full"], w["bits"]) for w in words] == [(156, ~(1 << 16))]


def test_empty_tables_and_nothing_in_common(documents):
    assert lines.removal_digests(documents([])).collect() == []
    assert lines.keep_bitmaps(documents([(1, "a"), (2, "b")]), 2).collect() == []


def test_a_very_common_line_covers_many_partitions_and_no_python_runs(spark, documents):
    docs = documents([(i, f"common\nline {i}") for i in range(4000)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    hashes = lines.line_hashes(docs).persist()
    ranged = lines.first_occurrences(hashes)
    spread = ranged.groupBy("high").count().orderBy("count", ascending=False).first()["count"]
    assert spread == 4000
    hot = ranged.selectExpr("spark_partition_id() AS p", "high").groupBy("high").agg({"p": "approx_count_distinct"})
    assert hot.orderBy(hot.columns[1], ascending=False).first()[1] > 1
    plan = lines.removal_digests(docs)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(high" in ranged._jdf.queryExecution().executedPlan().toString()
    for operator in ("EvalPython", "InArrow", "InPandas", "CartesianProduct", "NestedLoopJoin"):
        assert operator not in plan
    hashes.unpersist()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
