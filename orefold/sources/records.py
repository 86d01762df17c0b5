"""Records of delimited files with quoted line breaks, found in parallel, with the byte position of each.

A file is read as lines, split over tasks. What a line is depends on whether a quoted value is open before it, which no task
knows. So every line is read both ways: from outside, it may end with a value left open; from inside a value, it may continue,
close it, or not fit at all. Lines that can't merely continue a value are its events. A value opened by one event can only be
closed by the next, if nothing between breaks it and the fields add up to those of the header. Events get their ordinal in the
file from counts per block and sums over the blocks before, each is compared with its successor by an equi join, and of
overlapping candidates the first is taken, by the distance to the last ordinal that opens none. Lines of a taken pair are put
together; all others stand for themselves. A stray quote therefore costs the row that has it and no other.

Lines end with a line feed, a carriage return before it is dropped. Positions count the bytes of the file (of its unpacked
content, without a byte order mark).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orefold import session

FILE, BLOCK, POSITION, RAW = "_FILE", "_BLOCK", "POSITION", "RAW_ROW"
UNCLOSED = "_UNCLOSED"
_NTH, _LINE, _EVENT, _EVENTS = "_NTH", "_LINE", "_EVENT", "_EVENTS"
_BUCKET = 4096  # ordinals that one window over events covers


@dataclass(frozen=True)
class Shapes:
    """Patterns of lines for a delimiter and a quote; quantifiers are possessive, so no line is tried twice."""

    delimiter: str
    quote: str

    def _blank(self) -> str:
        return "[ ]*+" if self.delimiter == "\t" else "[ \t]*+"

    def _parts(self) -> tuple[str, str, str, str]:
        d, q, blank = re.escape(self.delimiter), re.escape(self.quote), self._blank()
        inner = f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+"
        field = f"(?:{blank}{q}{inner}{q}{blank}(?={d}|\\z)|(?!{blank}{q})[^{d}]*+)"
        return d, f"{blank}{q}", inner, field

    def opened(self) -> str:
        """From outside a value: whole fields (group 1), then a value that doesn't end."""
        d, opening, inner, field = self._parts()
        return f"^((?:{field}{d})*+){opening}{inner}\\z"

    def closing(self) -> str:
        """From inside a value: its end, then whole fields (group 1)."""
        d, _, inner, field = self._parts()
        return f"^{inner}{re.escape(self.quote)}{self._blank()}((?:{d}{field})*+)\\z"

    def through(self) -> str:
        """From inside a value: its end, whole fields (group 1), and a further value that doesn't end."""
        d, opening, inner, field = self._parts()
        return f"^{inner}{re.escape(self.quote)}{self._blank()}({d}(?:{field}{d})*+){opening}{inner}\\z"

    def interior(self) -> str:
        """From inside a value: nothing but more of it."""
        return f"^{self._parts()[2]}\\z"

    def quoted(self) -> str:
        return f"{re.escape(self.quote)}{self._parts()[2]}{re.escape(self.quote)}"

    def opens(self, line: Column) -> Column:
        return line.contains(self.quote) & F.rlike(line, F.lit(self.opened()))

    def _delimiters(self, line: Column, pattern: str) -> Column:
        bare = F.regexp_replace(F.regexp_extract(line, pattern, 1), self.quoted(), "")
        return F.length(bare) - F.length(F.replace(bare, F.lit(self.delimiter), F.lit("")))


def lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """_FILE, _BLOCK (byte where its split begins), _NTH (ascending within the split), _LINE, and its bytes with the line end."""
    read = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(_NTH),
        "value",
    )
    return read.select(
        FILE, BLOCK, _NTH, line_text("value", encoding).alias(_LINE), (F.octet_length("value") + 1).alias("_BYTES")
    )


def line_text(value: str, encoding: str) -> Column:
    """The line without a carriage return at its end, from bytes of ``encoding``; the text source leaves bytes as they are."""
    column = F.col(value)
    text = column if encoding == "UTF-8" else F.decode(column.cast("binary"), encoding)
    return F.when(F.endswith(text, F.lit("\r")), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)


def store(df: DataFrame, label: str) -> DataFrame:
    path = session.scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _measured(read: DataFrame, shapes: Shapes) -> DataFrame:
    """Lines with both readings, and running sums within their block."""
    line, quoted = F.col(_LINE), F.col(_LINE).contains(shapes.quote)
    opens, closes = shapes.opens(line), quoted & F.rlike(line, F.lit(shapes.closing()))
    interior = ~quoted | F.rlike(line, F.lit(shapes.interior()))
    through = quoted & F.rlike(line, F.lit(shapes.through()))
    read = read.select("*", opens.alias("_OPENS"), closes.alias("_CLOSES"), interior.alias("_INTERIOR"), through.alias("_THROUGH"))
    read = read.select(
        "*",
        (~F.col("_INTERIOR") & ~F.col("_THROUGH")).alias(_EVENT),
        F.when(F.col("_OPENS"), shapes._delimiters(line, shapes.opened())).otherwise(0).alias("_BEFORE"),
        F.when(F.col("_CLOSES"), shapes._delimiters(line, shapes.closing())).otherwise(0).alias("_AFTER"),
        F.when(F.col("_THROUGH"), shapes._delimiters(line, shapes.through())).otherwise(0).alias("_AMID"),
    ).drop("_INTERIOR", "_THROUGH")
    upto = W.partitionBy(FILE, BLOCK).orderBy(_NTH).rowsBetween(W.unboundedPreceding, W.currentRow)
    return read.select(
        "*",
        (F.sum("_BYTES").over(upto) - F.col("_BYTES")).alias("_BYTES_BEFORE"),
        F.sum(F.col(_EVENT).cast("bigint")).over(upto).alias("_EVENTS_UPTO"),
        F.sum(F.col("_AMID").cast("bigint")).over(upto).alias("_AMID_UPTO"),
    ).drop("_AMID")


def _numbered(measured: DataFrame) -> DataFrame:
    """Running sums over the whole file: those of the block, plus those of the blocks before it."""
    blocks = measured.groupBy(FILE, BLOCK).agg(
        F.sum("_BYTES").alias("b"), F.max("_EVENTS_UPTO").alias("e"), F.max("_AMID_UPTO").alias("a")
    )
    earlier = W.partitionBy(FILE).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    carried = store(
        blocks.select(FILE, BLOCK, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in "bea"]), "line-blocks"
    )
    return measured.join(carried, [FILE, BLOCK]).select(
        FILE,
        BLOCK,
        _NTH,
        _LINE,
        _EVENT,
        "_OPENS",
        "_CLOSES",
        "_BEFORE",
        "_AFTER",
        (F.col("b") + F.col("_BYTES_BEFORE")).alias(POSITION),
        (F.col("e") + F.col("_EVENTS_UPTO")).alias(_EVENTS),
        (F.col("a") + F.col("_AMID_UPTO")).alias("_AMID_UPTO"),
    )


def _taken(numbered: DataFrame, n_fields: int) -> DataFrame:
    """_FILE, _EVENTS, start: of every event that opens a value, and of the next, which closes it. A stored table."""
    events = numbered.filter(_EVENT).select(FILE, _EVENTS, "_OPENS", "_CLOSES", "_BEFORE", "_AFTER", "_AMID_UPTO")
    following = events.select(
        FILE,
        (F.col(_EVENTS) - 1).alias(_EVENTS),
        F.col("_CLOSES").alias("_NEXT_CLOSES"),
        F.col("_AFTER").alias("_NEXT_AFTER"),
        F.col("_AMID_UPTO").alias("_NEXT_AMID"),
    )
    delimiters = F.col("_BEFORE") + F.col("_NEXT_AFTER") + F.col("_NEXT_AMID") - F.col("_AMID_UPTO")
    fits = F.col("_OPENS") & F.col("_NEXT_CLOSES") & (delimiters + 1 == n_fields)
    pairs = store(
        events.join(following, [FILE, _EVENTS], "left").select(
            FILE, _EVENTS, F.coalesce(fits, F.lit(False)).alias("fits"), F.floor(F.col(_EVENTS) / _BUCKET).alias("bucket")
        ),
        "quote-pairs",
    )
    unfit = F.max(F.when(~F.col("fits"), F.col(_EVENTS)))
    upto = W.partitionBy(FILE, "bucket").orderBy(_EVENTS).rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = W.partitionBy(FILE).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    by_bucket = pairs.groupBy(FILE, "bucket").agg(unfit.alias("unfit"))
    carried = store(by_bucket.select(FILE, "bucket", F.max("unfit").over(earlier).alias("carried")), "quote-buckets")
    last_unfit = F.coalesce(F.max(F.when(~F.col("fits"), F.col(_EVENTS))).over(upto), F.col("carried"), F.lit(0))
    starts = (
        pairs.join(carried, [FILE, "bucket"])
        .withColumn("distance", F.col(_EVENTS) - last_unfit)
        .filter(F.col("fits") & (F.col("distance") % 2 == 1))
    )
    both = F.explode(F.array(F.col(_EVENTS), F.col(_EVENTS) + 1))
    return store(starts.select(FILE, F.col(_EVENTS).alias("start"), both.alias(_EVENTS)), "quoted-breaks")


def records(spark: SparkSession, path: str, delimiter: str, quote: str, encoding: str, n_fields: int) -> DataFrame:
    """_FILE, POSITION, RAW_ROW and _UNCLOSED (a quoted value of the row doesn't end) of every record but blank ones."""
    shapes = Shapes(delimiter, quote)
    measured = store(_measured(lines(spark, path, encoding), shapes), "physical-lines")
    numbered = _numbered(measured)
    taken = _taken(numbered, n_fields)
    # An event belongs to the pair that it opens or closes, another line to the pair opened last and not yet closed.
    placed = numbered.join(taken, [FILE, _EVENTS], "left").withColumn(
        "start", F.when(F.col(_EVENT) | (F.col("start") == F.col(_EVENTS)), F.col("start"))
    )
    alone = placed.filter(F.col("start").isNull() & (F.trim(_LINE) != "")).select(
        FILE, POSITION, F.col(_LINE).alias(RAW), F.col("_OPENS").alias(UNCLOSED)
    )
    joined = (
        placed.filter(F.col("start").isNotNull())
        .groupBy(FILE, "start")
        .agg(F.min(POSITION).alias(POSITION), F.array_sort(F.collect_list(F.struct(POSITION, _LINE))).alias("lines"))
        .select(
            FILE, POSITION, F.array_join(F.col("lines")[_LINE], "\n").alias(RAW), F.lit(False).alias(UNCLOSED)
        )
    )
    return alone.unionByName(joined)
