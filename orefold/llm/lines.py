"""Line dedup: common lines found by range-partitioned hashes, returned as compressed keep bitmaps of the documents.

Everything is a column expression. The lines of a document become rows (key hash, document, position), stored once. They are
dealt out by range of (hash, document) and sorted by position behind it, so a key with a third of all lines covers many
partitions; every partition streams its rows and passes on the first occurrence of each key in each document. Counting those
per key is combined before its shuffle, one row per key and partition. The keys of enough documents are stored and joined
back to the lines, the rows hit become one bit each, bits become words of 64 lines, and words become the bitmap of a document.
No text is shuffled until a caller applies the bitmaps.

A key is the line without white space at both ends and with A-Z in lower case, compared by 128 bits of hash.

* A null or empty text is one empty line. An empty key (a blank line) is counted only if ``least_chars`` is 0.
* A document is a doc_id: rows of equal id, null included, count once for a key. Rows of equal id and different text have
  bitmaps of their own; rows repeated as a whole share one.
* An empty table gives an empty result; further columns, whatever their names, are ignored.
* Very long texts cost time and memory in proportion to their length.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orefold.llm.common import drop, prepare, store

GAPS = " \t\n\x0b\x0c\r"
WORD_BITS = 64
ALL_KEPT = -1  # a word whose 64 lines all stay
_SEED = 7_046_029_254_386_353_131


def _body(text: str | Column) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("string"), F.lit(""))


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case; ``lower`` does that to plain ASCII at less cost."""
    bare = F.btrim(line, F.lit(GAPS))
    ascii_only = F.length(bare) == F.octet_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def line_hashes(docs: DataFrame, text: str = "text", key: str = "doc_id", least_chars: int = 1) -> DataFrame:
    """doc_id, text_hash, place (from 0), high and low (the key's hash) of every line whose key has ``least_chars`` characters."""
    body = docs.select(F.col(key).cast("bigint").alias("doc_id"), _body(text).alias("body"))
    lines = body.select(
        "doc_id", F.xxhash64("body").alias("text_hash"), F.posexplode(F.split("body", "\n")).alias("place", "line")
    )
    keyed = lines.select("doc_id", "text_hash", "place", line_key(F.col("line")).alias("line_key"))
    return keyed.filter(F.length("line_key") >= least_chars).select(
        "doc_id", "text_hash", "place", F.xxhash64("line_key").alias("high"), F.xxhash64(F.lit(_SEED), "line_key").alias("low")
    )


def first_occurrences(lines: DataFrame) -> DataFrame:
    """The first line of each key in each document, streamed off partitions by range of (hash, document)."""
    ranged = lines.select("high", "low", "doc_id", "place").repartitionByRange("high", "low", "doc_id")
    ordered = W.partitionBy("high", "low", "doc_id").orderBy("place")
    return ranged.withColumn("nth", F.row_number().over(ordered)).filter(F.col("nth") == 1).drop("nth")


def common_keys(lines: DataFrame, least_documents: int) -> DataFrame:
    """high, low, the number of documents, and the first (doc_id, place) of every key found in ``least_documents``."""
    counted = first_occurrences(lines).groupBy("high", "low").agg(
        F.count(F.lit(1)).alias("documents"), F.min(F.struct("doc_id", "place")).alias("first")
    )
    return counted.filter(F.col("documents") >= least_documents)


def keep_bitmaps(
    docs: DataFrame,
    least_documents: int = 10,
    least_chars: int = 1,
    keep_first: bool = False,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """doc_id, text_hash, n_dropped and keep_words of every document that loses a line; a stored table.

    ``keep_words`` is the bitmap: bit i % 64 of word i // 64 is set if line i stays. Runs of full words are not stored: an
    entry is the number of full words before it and one word, and after the last entry all lines stay. With ``keep_first``
    the first of all lines of a key stays (smallest doc_id, then position), otherwise the key loses all its lines.
    """
    prepare(docs.sparkSession)
    lines = store(line_hashes(docs, text, key, least_chars), "line-hashes")
    common = store(common_keys(lines, least_documents), "common-lines")
    hit = lines.join(common, ["high", "low"])
    if keep_first:
        hit = hit.filter(~F.struct("doc_id", "place").eqNullSafe(F.col("first")))
    # shiftleft takes the bit from the lowest six bits of the position, as the word from the others.
    bit = F.expr(f"shiftleft(1L, place % {WORD_BITS})")
    words = hit.groupBy("doc_id", "text_hash", F.floor(F.col("place") / WORD_BITS).alias("word")).agg(
        F.bit_or(bit).alias("dropped")
    )
    bitmaps = words.groupBy("doc_id", "text_hash").agg(
        F.sum(F.bit_count("dropped")).alias("n_dropped"),
        F.array_sort(F.collect_list(F.struct("word", F.bitwise_not("dropped").alias("bits")))).alias("found"),
    )
    full_before = F.col("found")
    stored = store(
        bitmaps.select(
            "doc_id",
            "text_hash",
            "n_dropped",
            F.transform(
                full_before,
                lambda w, i: F.struct(
                    (w["word"] - F.coalesce(F.get(full_before, i - 1)["word"], F.lit(-1)) - 1).alias("full"),
                    w["bits"].alias("bits"),
                ),
            ).alias("keep_words"),
        ),
        "keep-bitmaps",
    )
    drop(lines, common)
    return stored


def unpacked(keep_words: Column) -> Column:
    """All words of a bitmap up to its last entry, by number."""
    return F.flatten(
        F.transform(
            keep_words,
            lambda w: F.concat(F.array_repeat(F.lit(ALL_KEPT).cast("bigint"), w["full"].cast("int")), F.array(w["bits"])),
        )
    )


def kept_text(body: Column, words: Column) -> Column:
    """The lines whose bit is set (or lies behind the last word), joined by line breaks."""
    kept = F.filter(
        F.split(body, "\n"),
        lambda line, i: F.getbit(
            F.coalesce(F.get(words, F.floor(i / WORD_BITS).cast("int")), F.lit(ALL_KEPT).cast("bigint")), i % WORD_BITS
        )
        == 1,
    )
    return F.array_join(kept, "\n")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_text of every row of ``docs``."""
    body = docs.select(F.col(key).cast("bigint").alias("doc_id"), _body(text).alias("body"))
    named = bitmaps.select(F.col("doc_id").alias("its_id"), "text_hash", "n_dropped", "keep_words")
    same = F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.xxhash64("body") == F.col("text_hash"))
    joined = body.join(named, same, "left").withColumn("words", unpacked(F.col("keep_words")))
    return joined.select(
        "doc_id",
        # A replaced text is a byte shorter for each line break.
        (F.octet_length("body") - F.octet_length(F.replace("body", F.lit("\n"), F.lit(""))) + 1).cast("bigint").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("n_dropped").isNull(), F.col("body")).otherwise(kept_text(F.col("body"), F.col("words"))).alias("kept_text"),
    )


def removal_digests(docs: DataFrame, least_documents: int = 10, least_chars: int = 1) -> DataFrame:
    """doc_id, n_lines, n_dropped and the digest of the kept text of every document."""
    kept = apply_bitmaps(docs, keep_bitmaps(docs, least_documents, least_chars))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
