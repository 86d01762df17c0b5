"""The pipeline: its stages against plain Python, its columns, and what it does with odd rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from orefold.llm import language, toxicity
from orefold.llm.common import drop, store, table
from tests.llm.conftest import MIDDLE, SMALL
from tests.llm.test_duplicates import linked, removed


def test_stages_are_registered():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "toxicity", "near_dedup", "substring_dedup", "best_fit_packing"
    ]
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert "pipeline" not in __spark_entry__.oracle_sql() and corpus_pipeline.ORACLE_SQL is None


@pytest.fixture(scope="module")
def stored(spark):
    """Input and output of every stage over the small tables."""
    docs = table(spark, SMALL, "documents")
    results = [docs]
    for name, stage in corpus_pipeline.STAGES:
        results.append(store(stage(spark, results[-1], SMALL), f"test-{name}"))
    return results


def rows(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_every_stage_but_the_last_keeps_the_columns(stored):
    assert all(df.schema.names == stored[0].schema.names for df in stored[:-1])
    assert [dict(df.dtypes) for df in stored[:-1]] == [dict(stored[0].dtypes)] * 5


def test_filters_drop_what_the_operators_reject(spark, stored):
    predicted = {r["doc_id"]: r for r in language.identify(stored[0]).collect()}
    assert all(predicted[i]["lang_pred"] != "und" for i, _ in rows(stored[1]))
    toxic = {r["doc_id"]: r["predicted"] for r in toxicity.classify(stored[1], table(spark, SMALL, "labels")).collect()}
    assert [i for i, _ in rows(stored[2])] == sorted(i for i, label in toxic.items() if not label)


def test_near_stage_keeps_one_of_each_group(stored):
    before = rows(stored[2])
    parts = linked(before)
    assert [i for i, _ in rows(stored[3])] == sorted(i for i, (_, component) in parts.items() if component == i)


def test_substring_stage_removes_repeated_passages(stored):
    expected = removed(rows(stored[3]))
    for doc_id, text in rows(stored[4]):
        words = text.encode().split()
        total, gone, digest = expected[doc_id]
        assert len(words) == total - gone
        assert hashlib.sha256(b" ".join(words)).hexdigest() == digest


def test_packing_stage_packs_every_document_left(stored):
    assert {r["doc_id"] for r in stored[5].collect()} == {i for i, _ in rows(stored[4])}


def test_run_gives_the_rows_of_the_stages(spark, stored):
    found = corpus_pipeline.run(spark, SMALL)
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(found.select(*key).collect()) == sorted(stored[5].select(*key).collect())


def test_stages_on_odd_rows(spark, documents, tmp_path):
    passage = " ".join(f"word{i}" for i in range(60))
    own = " ".join(f"own{i}" for i in range(60))
    odd = documents(
        [
            (1, None), (2, ""), (3, "!!! 123"), (4, "the same five words here"), (5, "the same five words here"),
            (5, "the same five words here"), (None, "no id at all"), (6, f"the house {passage} and the tree"),
            (7, f"another tree {passage} {own}"), (8, "the man and the house"),
        ]
    ).selectExpr("*", "1 AS kept", "'x' AS __row2")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(9)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = store(stage(spark, docs, str(tmp_path)), f"odd-{name}")
        assert docs.columns == odd.columns
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(left) == {4, 6, 7, 8, None} and docs.count() == 5
    assert left[7] == f"another tree {own}"
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert packed.count() == 5
    drop(docs)


def test_stages_on_an_empty_table(spark, documents):
    docs = documents([])
    for name, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, MIDDLE), f"empty-{name}")
        assert docs.count() == 0


def test_scratch_tables_are_gone_after_drop(spark):
    kept = store(spark.range(3).select(F.col("id")), "drop-test")
    files = kept.inputFiles()
    drop(kept)
    path = spark._jvm.org.apache.hadoop.fs.Path(files[0])
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
