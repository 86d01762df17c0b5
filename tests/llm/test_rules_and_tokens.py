"""Quality rules against SQL, byte-level BPE against the public library, WARC round trips."""

import base64
import hashlib
import zlib

import duckdb
import public_tokenizers
import pytest
import tiktoken

from checks.compare import connect, rows_of
from orefold.llm import bpe, oracles, queries, rules, warc
from tests.llm.conftest import SMALL


def same_as_sql(df, sql, con):
    names, ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    expected, theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert names == expected
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    same_as_sql(queries.QUERIES[name](spark, SMALL), queries.ORACLES[name], connect(SMALL))


EDGES = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "a b c a b c a b c"),
    (5, "x\nx\n\n \nx y\nx y"),
    (6, "the # * $ % & | < > the é ü ß 語"),
    (6, "the # * $ % & | < > the é ü ß 語"),
    (7, " ".join(["one two three"] * 40)),
    (8, "a" * 5000),
    (None, "no id"),
    (9, "a a a a"),
]


def test_rules_on_edge_texts_match_sql(spark, documents, long_text):
    rows = [*EDGES, (10, long_text)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [row for row in rows if row[0] not in (None, 6)])
    df = documents([row for row in rows if row[0] not in (None, 6)])
    same_as_sql(rules.judge(rules.measure(df)), oracles.OP9, con)
    found = {row["doc_id"]: row for row in rules.judge(rules.measure(documents(rows))).collect()}
    assert (found[1]["n_words"], found[1]["base_failed"], found[1]["kept"]) == (0, True, False)
    assert found[4]["n_repeat_words"] == 9 and found[9]["n_repeat_words"] == 4
    assert found[5]["n_dup_lines"] == 2 and found[6]["n_symbols"] == 8
    assert None in found


def test_rules_use_no_python_and_accept_an_empty_table_and_clashing_columns(spark, documents):
    df = documents([(1, "a b")]).selectExpr("*", "1 AS words", "2 AS n_words", "3 AS t", "4 AS kept")
    judged = rules.judge(rules.measure(df))
    assert judged.count() == 1
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert rules.judge(rules.measure(documents([]))).count() == 0


def test_clean_prose_is_kept_and_junk_is_not(documents):
    prose = " ".join(f"the word{i} of tree{i} and rain{i}" for i in range(20))
    junk = " ".join(f"wor{i}%%% hou{i}###" for i in range(40))
    found = {r["doc_id"]: r for r in rules.judge(rules.measure(documents([(1, prose), (2, junk)]))).collect()}
    assert found[1]["kept"] and not found[1]["base_failed"]
    assert found[2]["failed_rule"] == "symbols"


PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={}
    )


def digests(library, text):
    ids = library.encode_ordinary(text or "")
    return (
        len(ids),
        hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
        hashlib.sha256((text or "").encode()).hexdigest(),
    )


def test_token_digests_match_the_library(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    found = queries.QUERIES["op10_byte_bpe"](spark, SMALL).collect()
    assert len(found) == len(texts)
    for row in found:
        assert (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) == digests(library, texts[row["doc_id"]])


def test_token_digests_on_edge_texts(spark, documents, library, long_text):
    rows = [*EDGES, (10, long_text), (11, "a" * 30_000), (12, "日本語 тест 😀" * 50), (13, "<|endoftext|> don't\r\n\t  x ")]
    df = documents(rows).selectExpr("*", "1 AS ids", "'x' AS n_tokens")
    found = bpe.token_digests(df, PATH, public_tokenizers.PATTERN).collect()
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found)
    assert got == sorted((str(i), *digests(library, text)) for i, text in rows)
    assert bpe.token_digests(documents([]), PATH, public_tokenizers.PATTERN).count() == 0


def test_merges_of_single_and_grouped_pieces_agree(library):
    own = bpe.encoder(PATH, public_tokenizers.PATTERN)
    pieces = [b"ab", b"aaaaaaa", b"internationalisation", "übergröße".encode(), b"\xff\xfe\x00", bytes(range(60)), b"zzzzzz"]
    one = [bpe.merge(piece, own.ranks) for piece in pieces]
    assert own.merger.merge_many(pieces) == one
    assert [own.decode(ids) for ids in one] == pieces
    assert own.decode(own.encode("déjà vu")) == "déjà vu".encode()


PAGES = "page_id long, url string, html string"


def test_warc_round_trip_on_edge_pages(spark):
    pages = spark.createDataFrame(
        [
            (5, "http://a/ b\r\nc%20d", "<p>one</p>"),
            (3, None, "<p>one</p>"),
            (9, "http://x", "<p>one</p>"),
            (1, "http://n", None),
            (2, "http://e", ""),
            (7, "http://h", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 3),
            (8, "http://l", "é" * 300_000),
            (None, "http://i", "<p>one</p>"),
            (None, "http://i", "<p>alone</p>"),
            (7, "http://h", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 3),
        ],
        PAGES,
    ).selectExpr("*", "1 AS digest", "2 AS archive", "3 AS offset")
    found = warc.round_trip(pages).collect()
    rows = sorted((str(r["page_id"]), r["record_type"], r["refers_to"], r["payload_bytes"]) for r in found)
    assert rows == sorted(
        [
            ("5", "revisit", 3, 10), ("3", "response", None, 10), ("9", "revisit", 3, 10), ("1", "response", None, 0),
            ("2", "revisit", 1, 0), ("7", "response", None, 99), ("7", "response", None, 99),
            ("8", "response", None, 600_000), ("None", "revisit", 3, 10), ("None", "response", None, 12),
        ]
    )
    assert {r["digest_matches"] for r in found} == {True, None}
    empty = base64.b32encode(hashlib.sha1(b"").digest()).decode()
    assert {r["payload_digest"] for r in found if r["page_id"] in (1, 2)} == {empty}
    assert next(r["url"] for r in found if r["page_id"] == 9) == "http://x"
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_warc_members_are_valid_gzip_at_their_offsets(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://p/{i}", f"<p>{i}</p>" * 50) for i in range(40)], PAGES)
    manifest = warc.write_archives(pages, f"file://{tmp_path}/whole")
    index = warc.normalise(manifest, f"file://{tmp_path}/members").collect()
    assert sorted(r["page_id"] for r in index) == list(range(40))
    for row in index:
        path = row["archive"].removeprefix("file://")
        with open(path, "rb") as archive:
            archive.seek(row["offset"])
            headers, _, body = warc.parse(zlib.decompress(archive.read(row["length"]), 31))
        assert headers["warc-record-id"] == f"<urn:page:{row['page_id']}>"
        assert body.decode() == f"<p>{row['page_id']}</p>" * 50
        sidecar = open(f"{path}.idx").read().splitlines()
        assert f"{row['offset']}\t{row['length']}\t{row['page_id']}" in sidecar
    whole = open(manifest.first()["archive"].removeprefix("file://"), "rb").read()
    inflate = zlib.decompressobj(31)
    inflate.decompress(whole)
    assert inflate.eof and not inflate.unused_data  # one member for the whole file


def test_a_payload_damaged_on_the_way_is_an_error(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "http://a", "<p>one</p>"), (2, "http://b", "<p>six</p>")], PAGES)
    write = warc.write_archives

    def damage(pages, folder):
        manifest = write(pages, folder)
        for row in manifest.collect():
            path = row["archive"].removeprefix("file:")
            whole = zlib.decompress(open(path, "rb").read(), 31).replace(b"<p>one", b"<p>two")
            deflate = zlib.compressobj(1, zlib.DEFLATED, 31)
            open(path, "wb").write(deflate.compress(whole) + deflate.flush())
        return manifest

    assert warc.round_trip(pages).select("page_id", "payload_digest").count() == 2
    monkeypatch.setattr(warc, "write_archives", damage)
    with pytest.raises(Exception, match="damaged payload"):
        warc.round_trip(pages).select("page_id").collect()
