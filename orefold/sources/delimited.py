"""Delimited source files: reading, normalising, tolerant loading."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from orefold.functions import text
from orefold.schemas import nullable

_BAD_ROW = "_BAD_ROW"
REASON = "REJECT_REASON"
RAW_ROW = "RAW_ROW"

UTF8, LATIN1 = "UTF-8", "ISO-8859-1"

# Characters removed from header names (fixed values).
_DROPPED = str.maketrans({" ": "_", "(": None, ")": None})


@dataclass(frozen=True)
class Format:
    """How a delimited file is written. The defaults are those of the source files.

    ``multi_line`` accepts line breaks inside quotes; a file read that way cannot be split over tasks.
    """

    delimiter: str = ","
    quote: str = '"'
    header: bool = True
    encoding: str = UTF8
    trim: bool = True
    null_tokens: tuple[str, ...] = text.NULL_TOKENS
    multi_line: bool = False

    def reader(self, spark: SparkSession):
        return (
            spark.read.option("header", self.header)
            .option("sep", self.delimiter)
            .option("quote", self.quote)
            .option("escape", self.quote)
            .option("encoding", self.encoding)
            .option("multiLine", self.multi_line)
            .option("ignoreLeadingWhiteSpace", self.trim)
            .option("ignoreTrailingWhiteSpace", self.trim)
        )


def normalized_name(header: str) -> str:
    return header.removeprefix("\ufeff").strip().translate(_DROPPED).upper()


def file_name(encoded: Column) -> Column:
    """Name of a file as it is; a plus sign stays one, only percent codes are decoded."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def normalize_columns(df: DataFrame) -> DataFrame:
    """Upper-case names, blanks as underscores, no parentheses."""
    return df.toDF(*[normalized_name(c) for c in df.columns])


def add_audit_columns(df: DataFrame) -> DataFrame:
    """Load time and file name; for a frame read from files."""
    return df.withColumns(
        {"LOAD_TIMESTAMP": F.localtimestamp(), "SOURCE_FILE": file_name(F.col("_metadata.file_name"))}
    )


def _as_text(schema: StructType) -> StructType:
    return StructType([StructField(f.name, StringType(), True) for f in schema.fields])


def _token_to_null(column: Column, tokens: tuple[str, ...]) -> Column:
    return F.when(~F.trim(column).isin(*tokens), column)


def scan(spark: SparkSession, path: str, schema: StructType, fmt: Format = Format()) -> DataFrame:
    """Read with a declared schema. Missing-value tokens become null, other values that do not fit do too."""
    raw = fmt.reader(spark).schema(_as_text(schema)).csv(path)
    return raw.select(*[_typed(f, fmt) for f in schema.fields])


def _typed(field: StructField, fmt: Format) -> Column:
    value = _token_to_null(F.col(field.name), fmt.null_tokens)
    if isinstance(field.dataType, StringType):
        return value.alias(field.name)
    return value.try_cast(field.dataType).alias(field.name)


def tolerant_load(
    spark: SparkSession, path: str, schema: StructType, fmt: Format = Format()
) -> tuple[DataFrame, DataFrame]:
    """Good rows in their declared types, and rejected rows with the reason and their text.

    A row is rejected if it has another number of fields than declared or a value that its type cannot hold.
    Column pruning is off because a pruned parse does not count the fields.
    """
    text_schema = _as_text(schema).add(_BAD_ROW, StringType())
    rows = (
        fmt.reader(spark)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BAD_ROW)
        .option("columnPruning", False)
        .schema(text_schema)
        .csv(path)
    )
    reason = F.when(F.col(_BAD_ROW).isNotNull(), "wrong number of fields")
    for field in schema.fields:
        if not isinstance(field.dataType, StringType):
            value = _token_to_null(F.col(field.name), fmt.null_tokens)
            unfit = value.isNotNull() & value.try_cast(field.dataType).isNull()
            reason = reason.when(unfit, f"{field.name} is not {field.dataType.simpleString()}")
    judged = rows.withColumn(REASON, reason)
    good = judged.filter(F.col(REASON).isNull()).select(*[_typed(f, fmt) for f in schema.fields])
    whole = F.coalesce(F.col(_BAD_ROW), F.concat_ws(fmt.delimiter, *[F.col(c) for c in schema.names]))
    rejected = judged.filter(F.col(REASON).isNotNull()).select(REASON, whole.alias(RAW_ROW))
    return good, rejected


def detect_encoding(spark: SparkSession, path: str) -> str:
    """UTF-8 if every line is valid UTF-8, otherwise Latin-1, which accepts any byte."""
    invalid = spark.read.text(path).filter(~F.is_valid_utf8("value"))
    return UTF8 if invalid.isEmpty() else LATIN1


MISFIT = "_MISFIT"
CORRUPT, INVALID, HEADER = "_CORRUPT", "_INVALID", "_HEADER"


def header_of(spark: SparkSession, path: str, fmt: Format = Format()) -> list[str]:
    """Fields of the first line; none for an empty file."""
    first = replace(fmt, header=False).reader(spark).csv(path).first()
    return [field or "" for field in first] if first else []


def positions(header: list[str], schema: StructType) -> list[int]:
    """Place of every declared column in the header, by normalised name; a missing or ambiguous one is an error."""
    names = [normalized_name(name) for name in header]
    wrong = [f.name for f in schema.fields if names.count(f.name) != 1]
    if wrong:
        raise ValueError(f"columns missing or repeated in the header: {', '.join(wrong)}")
    return [names.index(f.name) for f in schema.fields]


def parsed(rows: DataFrame, raw: str, header: list[str], schema: StructType, fmt: Format = Format()) -> DataFrame:
    """``rows`` with the declared columns of their raw text, and whether it has another number of fields than the header
    (_CORRUPT), is the header itself (_HEADER), or has a value that its type can't hold (_MISFIT: the value is null)."""
    picked = positions(header, schema)
    fields = [f"_c{i}" for i in range(len(header))]
    options = {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD_ROW, "sep": fmt.delimiter, "quote": fmt.quote, "escape": fmt.quote,
        "ignoreLeadingWhiteSpace": str(fmt.trim).lower(), "ignoreTrailingWhiteSpace": str(fmt.trim).lower(),
    }
    declared = ", ".join(f"{name} string" for name in [*fields, _BAD_ROW])
    kept = rows.columns
    split = rows.withColumn("_FIELDS", F.from_csv(raw, declared, options)).select(*kept, "_FIELDS.*")
    is_header = F.lit(True)
    for name, value in zip(fields, header):
        is_header = is_header & (F.coalesce(name, F.lit("")) == value)
    named = split.select(
        *kept,
        *[F.col(fields[place]).alias(f.name) for f, place in zip(schema.fields, picked)],
        F.col(_BAD_ROW).isNotNull().alias(CORRUPT),
        is_header.alias(HEADER),
    )
    misfits = [_misfit(f, fmt) for f in schema.fields if not isinstance(f.dataType, StringType)]
    reason = F.lit(None).cast("string")
    for unfit, text_of in reversed(misfits):
        reason = F.when(unfit, text_of).otherwise(reason)
    return named.select(
        *kept,
        *[_typed(f, fmt) for f in schema.fields],
        CORRUPT,
        HEADER,
        reason.alias(MISFIT),
    )


def _misfit(field: StructField, fmt: Format) -> tuple[Column, str]:
    value = _token_to_null(F.col(field.name), fmt.null_tokens)
    return value.isNotNull() & value.try_cast(field.dataType).isNull(), f"{field.name} is not {field.dataType.simpleString()}"
