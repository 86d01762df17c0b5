"""Removal of passages that repeat across documents, with automata of recurring phrases.

A window is 50 consecutive words of one document. Every word covered by a window whose words also stand in a document
with a smaller doc_id is removed; windows are judged on the input.

1. Phrases. In each window the eight-word phrase with the smallest hash (leftmost if equal) stands for it, so equal windows
   have equal phrases at equal places: about one phrase place per 22 words.
2. Confirming. Phrases found in two documents or more recur; each is kept once, with its words, as a pattern.
3. Automata. Documents are dealt into shards of bounded text. The patterns that can occur in a shard, those whose hashes its
   documents have, are compiled into an Aho-Corasick automaton, and every text of the shard is streamed through it. Its hits
   are the places: what it does not find is no place, whatever the hashes say. So each document meets the patterns that can
   occur in it and no others, and the work grows with the text, not with text times patterns. Documents without a
   recurring phrase have no patterns and are not streamed.
4. Contexts. Neighbouring windows share a phrase: one row per place holds the phrase, the words all its windows cover (its
   context, as a hash) and which windows they are. Of documents with equal contexts all but the smallest repeat every
   window of it: done. Only where a phrase stands in different contexts the windows themselves are looked at, once per
   context, in its smallest document, grouped by phrase and hash; those with a smaller document are removed from the others.

Groups are stored aggregates joined back (a hot phrase is split by adaptive execution); what is collected per document is its
own phrases and windows. Keys are two 64-bit hashes, of the phrase and of the context or window. Texts are shuffled for
documents that are to be streamed or cut, not for others, as long as their ids fit into a broadcast of checked size. A null
text has no words. Rows with a null doc_id have no place in the order: they lose nothing and take nothing from others. Rows
of equal doc_id never take from each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from orefold.llm import textgrid
from orefold.llm.common import drop, join_back, prepare, store

WINDOW = 50
PHRASE = 8
BROADCAST_DOCUMENTS = 1_000_000

PHRASES = "doc_id long, text_key long, phrase long, words string"
PLACES = "doc_id long, text_key long, phrase long, context long, low int, high int"
WINDOWS = "doc_id long, text_key long, phrase long, window long, start int"


class Places:
    """Phrase places of all texts of a slice. Word numbers count over the whole slice."""

    def __init__(self, column: pa.Array) -> None:
        self.words = textgrid.split(column)
        self.hashes = self.words.hashes()
        first = self.words.first
        grams = textgrid.run_hashes(self.hashes, PHRASE)
        width = np.uint64(max(1, len(grams)).bit_length())
        ranked = (grams >> width) << width | np.arange(len(grams), dtype=np.uint64)
        least = textgrid.window_minimum(ranked, WINDOW - PHRASE + 1) & ((np.uint64(1) << width) - np.uint64(1))
        owner = self.words.owner[: len(least)]
        start = np.flatnonzero(np.arange(len(least)) + WINDOW <= first[owner + 1]) if len(least) else np.zeros(0, np.int64)
        place = least[start].astype(np.int64)
        owner = owner[start] if len(start) else np.zeros(0, np.int64)
        new = np.ones(len(start), bool)
        new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
        begin = np.flatnonzero(new)
        self.place, self.owner, self.low = place[begin], owner[begin], start[begin]
        self.high = start[np.concatenate([begin[1:], [len(start)]]).astype(np.int64) - 1] if len(begin) else self.low
        self.phrase = grams[self.place]

    def contexts(self) -> np.ndarray:
        return textgrid.span_hashes(self.hashes, self.low, self.high + WINDOW, 1)


def _int64(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64), pa.int64())


def phrases(docs: DataFrame) -> DataFrame:
    """The phrases that stand for windows of every document, with their words: (doc_id, text_key, phrase, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in textgrid.slices(batch.column(2)):
                part = batch.slice(i, j - i)
                found = Places(part.column(2))
                once = np.unique(np.stack([found.owner.astype(np.uint64), found.phrase]), axis=1, return_index=True)[1]
                owner = pa.array(found.owner[once])
                said = [b" ".join(found.words.text(k, k + PHRASE)).decode() for k in found.place[once].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(owner), part.column(1).take(owner), _int64(found.phrase[once]), pa.array(said, pa.string())],
                    [part.split()[0] for part in PHRASES.split(", ")],
                )

    return docs.mapInArrow(run, PHRASES)


def hits(words: textgrid.Words, patterns: set[str]) -> np.ndarray:
    """Ascending numbers of the words at which the automaton of the patterns finds one, over all texts."""
    automaton = ahocorasick.Automaton()
    for pattern in patterns:
        # Words are compared as bytes, one character each, between blanks: a pattern begins and ends at a word.
        streamed = f" {pattern.encode().decode('latin-1')} "
        automaton.add_word(streamed, len(streamed))
    if not len(automaton):
        return np.zeros(0, np.int64)
    automaton.make_automaton()
    seen = [np.zeros(0, np.int64)]
    for low, high in zip(words.first.tolist(), words.first[1:].tolist()):
        streamed = f" {b' '.join(words.text(low, high)).decode('latin-1')} "
        begins = np.fromiter((end - size + 1 for end, size in automaton.iter(streamed)), np.int64)
        sizes = words.end[low:high] - words.start[low:high] + 1
        seen.append(low + np.searchsorted(np.cumsum(sizes) - sizes, begins))
    return np.unique(np.concatenate(seen))


def phrase_places(docs: DataFrame) -> DataFrame:
    """The places at which the automaton of a shard finds a pattern (array ``patterns`` of its documents) that stands for
    windows there: (doc_id, text_key, phrase, context, low, high)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in textgrid.slices(batch.column(2)):
                part = batch.slice(i, j - i)
                found = Places(part.column(2))
                patterns = set(part.column(3).flatten().to_pylist())
                at = np.flatnonzero(np.isin(found.place, hits(found.words, patterns)))
                owner, origin = pa.array(found.owner[at]), found.words.first[found.owner[at]]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(owner),
                        part.column(1).take(owner),
                        _int64(found.phrase[at]),
                        _int64(found.contexts()[at]),
                        pa.array(found.low[at] - origin, pa.int32()),
                        pa.array(found.high[at] - origin, pa.int32()),
                    ],
                    [part.split()[0] for part in PLACES.split(", ")],
                )

    return docs.mapInArrow(run, PLACES)


def located_windows(docs: DataFrame) -> DataFrame:
    """Windows at the places of the phrases (array ``phrases``) that each document is asked for, which the automata found:
    (doc_id, text_key, phrase, window, start)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in textgrid.slices(batch.column(2)):
                part = batch.slice(i, j - i)
                found = Places(part.column(2))
                wanted = [set(asked) for asked in part.column(3).to_pylist()]
                signed = found.phrase.view(np.int64).tolist()
                asked = [k for k, (owner, phrase) in enumerate(zip(found.owner.tolist(), signed)) if phrase in wanted[owner]]
                places = np.array(asked, np.int64)
                low, count = found.low[places], found.high[places] - found.low[places] + 1
                start = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
                owner = np.repeat(found.owner[places], count)
                windows = textgrid.span_hashes(found.hashes, start, start + WINDOW, 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(owner)),
                        part.column(1).take(pa.array(owner)),
                        _int64(np.repeat(found.phrase[places], count)),
                        _int64(windows),
                        pa.array(start - found.words.first[owner], pa.int32()),
                    ],
                    [part.split()[0] for part in WINDOWS.split(", ")],
                )

    return docs.mapInArrow(run, WINDOWS)


def keyed(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(key).cast("bigint").alias("doc_id"), F.xxhash64(body).alias("text_key"), body.alias("text"))


def _few(ids: DataFrame) -> bool:
    return ids.count() <= BROADCAST_DOCUMENTS


def _beyond_smallest(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Smallest doc_id per key, a stored table, and the rows of larger ones."""
    least = store(rows.groupBy(*keys).agg(F.min("doc_id").alias("smallest")), "smallest")
    return least, rows.join(least, keys).filter(F.col("doc_id") > F.col("smallest"))


def patterns(said: DataFrame) -> DataFrame:
    """phrase and words of every phrase that two documents or more have; a stored table."""
    recurring = (
        said.groupBy("phrase")
        .agg(F.min("doc_id").alias("low_id"), F.max("doc_id").alias("high_id"))
        .filter(F.col("low_id") < F.col("high_id"))
    )
    of_smallest = join_back(said, recurring, ["phrase"], "recurring-phrases").filter(F.col("doc_id") == F.col("low_id"))
    return store(of_smallest.groupBy("phrase").agg(F.min("words").alias("words")), "patterns")


def _of_few(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """The documents that are asked for anything, with what they are asked for; others aren't shuffled while those are few."""
    keys = ["doc_id", "text_key"]
    if _few(asked):
        docs = docs.join(F.broadcast(asked.select(*keys)), keys, "left_semi")
    return docs.join(asked, keys)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, spans) of the documents that lose words: an array of (start, end) word numbers; a stored table."""
    said = store(phrases(docs.filter("doc_id IS NOT NULL")), "phrases")
    known = patterns(said)
    shards = (
        said.select("doc_id", "text_key", "phrase")
        .join(known, "phrase")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("words").alias("patterns"))
    )
    shards = store(shards, "document-patterns")
    streamed = _of_few(docs, shards).select("doc_id", "text_key", "text", "patterns")
    confirmed = store(phrase_places(streamed), "recurring-places")
    drop(said, known, shards)
    least, copies = _beyond_smallest(confirmed, ["phrase", "context"])
    whole = copies.select("doc_id", "text_key", F.col("low").alias("start"), (F.col("high") + WINDOW).alias("end"))
    whole_stored = store(whole, "repeated-contexts")

    contexts = least.select("phrase", "context", "smallest")
    differing = (
        contexts.groupBy("phrase")
        .agg(F.min("context").alias("low_context"), F.max("context").alias("high_context"))
        .filter(F.col("low_context") < F.col("high_context"))
        .select("phrase")
    )
    # Stored, so that the join on the phrase alone stands by itself and a hot phrase can be split.
    ambiguous = store(join_back(contexts, differing, ["phrase"], "differing-phrases"), "differing-contexts")
    asked = (
        confirmed.join(ambiguous, ["phrase", "context"])
        .filter(F.col("doc_id") == F.col("smallest"))
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("phrase").alias("phrases"))
    )
    asked = store(asked, "asked-phrases")
    searched = _of_few(docs, asked).select("doc_id", "text_key", "text", "phrases")
    windows = store(located_windows(searched), "windows")
    _, repeated = _beyond_smallest(windows, ["phrase", "window"])
    single = repeated.select("doc_id", "text_key", "start", (F.col("start") + WINDOW).alias("end"))
    spans = whole_stored.unionByName(single).groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans")
    )
    stored = store(spans, "spans")
    drop(confirmed, least, whole_stored, ambiguous, asked, windows)
    return stored


def kept_mask(words: int, spans: list) -> np.ndarray:
    step = np.zeros(words + 1, np.int64)
    for span in spans:
        step[span["start"]] += 1
        step[span["end"]] -= 1
    return np.cumsum(step[:-1]) == 0


def _with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """All documents with their ``spans`` (null: none). Those without aren't shuffled while the ids of the others are few."""
    keys = ["doc_id", "text_key"]
    if not _few(spans):
        return docs.join(spans, keys, "left")
    ids = F.broadcast(spans.select(*keys))
    cut = docs.join(ids, keys, "left_semi").join(spans, keys)
    none = F.lit(None).cast(spans.schema["spans"].dataType).alias("spans")
    return cut.unionByName(docs.join(ids, keys, "left_anti").select("*", none))


def removal_digests(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words joined by blanks, of every document."""
    prepare(docs.sparkSession)
    texts = keyed(docs, text, key)
    joined = _with_spans(texts, repeated_spans(texts)).select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1), batch.column(2)):
                words = text.as_py().encode().split()
                left = words
                if spans.is_valid:
                    left = [word for word, stays in zip(words, kept_mask(len(words), spans.as_py()).tolist()) if stays]
                rows.append((len(words), len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest()))
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


@F.arrow_udf(StringType())
def _cut(text: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for value, found in zip(text, spans):
        words = value.as_py().encode().split()
        out.append(b" ".join(w for w, stays in zip(words, kept_mask(len(words), found.as_py()).tolist()) if stays).decode())
    return pa.array(out, pa.string())


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", size: str = "n_chars") -> DataFrame:
    """The documents with all their columns; where words are removed the text is the kept words joined by blanks, and the
    column ``size``, if there is one, its number of characters.

    Other texts stay as they are. A document that loses all its words keeps its row, with an empty text.
    """
    prepare(docs.sparkSession)
    spans = repeated_spans(keyed(docs, text, key))
    row, body = "__row", F.coalesce(F.col(f"__row.{text}").cast("string"), F.lit(""))
    packed = docs.select(F.struct("*").alias(row))
    texts = packed.select(F.col(f"{row}.{key}").cast("bigint").alias("doc_id"), F.xxhash64(body).alias("text_key"), row)
    joined = _with_spans(texts, spans)
    cut = joined.filter("spans IS NOT NULL").select(row, _cut(body, F.col("spans")).alias("cut"))
    new = {text: F.col("cut"), size: F.length("cut").cast("bigint")}
    columns: list[Column] = [new.get(name, F.col(f"{row}.`{name}`")).alias(name) for name in docs.columns]
    same = joined.filter("spans IS NULL").select(f"{row}.*")
    return cut.select(*columns).unionByName(same)
