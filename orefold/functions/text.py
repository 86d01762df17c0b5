"""Text cleanup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of a missing value in source files (fixed values).
NULL_TOKENS = ("NULL", "null", "N/A", "")

# Characters other than blanks after which a new word starts (fixed values).
_WORD_BREAKS = r"[\t\r\n!?@\"^#$&~_,.:;+\-*%/|\\\[\](){}<>]"


def without_tokens(text: Column) -> Column:
    """Trimmed text, null for a missing-value token."""
    trimmed = F.trim(text)
    return F.when(~trimmed.isin(*NULL_TOKENS), trimmed)


def title_case(text: Column) -> Column:
    """Capitalise each word; words also end at punctuation (``mary-ann`` -> ``Mary-Ann``).

    ``initcap`` covers the usual case within generated code; only text with punctuation is split.
    """
    pieces = F.split(F.lower(text), rf"(?<={_WORD_BREAKS}|\s)")
    capitalised = F.array_join(
        F.transform(pieces, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), ""
    )
    return F.when(text.rlike(_WORD_BREAKS), capitalised).otherwise(F.initcap(text))


def or_default(text: Column, default: str, missing: str | None = None) -> Column:
    """Trimmed text; ``default`` for null or for the ``missing`` sentinel."""
    value = text if missing is None else F.nullif(text, F.lit(missing))
    return F.coalesce(F.trim(value), F.lit(default))


def is_blank(value: Column) -> Column:
    """Null, empty, or nothing but white space of any kind."""
    return ~F.coalesce(value.cast("string"), F.lit("")).rlike(r"(?U)\S")
