"""Quality rules: a table of thresholds compiled into one projection of length, symbol, stop-word and line ratios.

Everything is a column expression. Ratios are compared as products of whole numbers, so no rounding decides a verdict.
A text that is null or has no word has counts 0 and fails the base rule on its number of words. Work and memory per text
follow its length (repeats are found by sorting the text's own windows); nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
GAPS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
WINDOW = 3

# Frequent function words of English, German, French and Spanish, counted in lower case or capitalised.
STOP_WORDS = (
    "the", "be", "to", "of", "and", "that", "have", "with", "is", "in", "a", "it", "for", "on", "was", "as", "by", "this",
    "der", "die", "das", "und", "von", "mit", "ist", "nicht", "ein", "den", "sich",
    "le", "la", "les", "de", "et", "des", "en", "que", "pour", "dans", "un", "une",
    "el", "los", "las", "y", "se", "por", "con", "para", "del", "no",
)


@dataclass(frozen=True)
class Rule:
    """Fails when 100 * part > limit * whole (``most``), or < limit * whole (not ``most``)."""

    name: str
    part: str
    whole: str
    limit_percent: int
    most: bool = True

    def failed(self) -> Column:
        left, right = 100 * F.col(self.part), self.limit_percent * F.col(self.whole)
        return left > right if self.most else left < right


RULES = (
    Rule("long_words", "word_chars", "n_words", 1500),
    Rule("short_words", "word_chars", "n_words", 250, most=False),
    Rule("symbols", "n_symbols", "n_words", 20),
    Rule("stop_words", "n_stop_words", "n_words", 5, most=False),
    Rule("dup_lines", "n_dup_lines", "n_lines", 50),
)


def _hashes(words: Column) -> Column:
    """Hash of the window that begins at each word; the last two begin none."""
    whole = F.slice(words, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))
    return F.transform(whole, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, WINDOW)]))


def _windows(hashes: Column) -> Column:
    """(hash, place) of every window, sorted; null, at little cost, if no window is found twice."""
    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(placed))


def _repeated_starts(windows: Column) -> Column:
    """Places of windows found twice or more, ascending."""
    found = F.filter(
        windows,
        lambda x, k: (x["h"] == F.get(windows, k - 1)["h"]) | (x["h"] == F.get(windows, k + 1)["h"]),
    )
    return F.sort_array(F.transform(found, lambda x: x["i"]))


def _covered(starts: Column) -> Column:
    """Words in the windows that begin at ``starts``: each adds its words up to the next start."""
    steps = F.transform(starts, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - x, F.lit(WINDOW))))
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, x: total + x)


def measure(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key and counts of every text: words, characters, symbols, repeated lines and words, stop words, lines."""
    body = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    parts = body.select(
        "doc_id",
        F.regexp_extract_all("t", F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split("t", "\n"), lambda line: F.length(F.translate(line, GAPS, "")) > 0).alias("lines"),
        F.length(F.translate("t", GAPS, "")).cast("bigint").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
    )
    hashed = parts.select("*", _hashes(F.col("words")).alias("hashes"))
    sorted_windows = hashed.select("*", _windows(F.col("hashes")).alias("windows"))
    starts = sorted_windows.select("*", _repeated_starts(F.col("windows")).alias("starts"))
    return starts.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(_covered(F.col("starts")), F.lit(0)).cast("bigint").alias("n_repeat_words"),
        F.size(F.filter("words", lambda w: w.isin(*STOP_WORDS, *[word.capitalize() for word in STOP_WORDS]))).cast("bigint").alias("n_stop_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
    )


def judge(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add base_failed, kept, and the first rule that failed (null if none)."""
    base = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    verdicts = [(base, "base"), *[(rule.failed(), rule.name) for rule in rules]]
    first = F.coalesce(*[F.when(failed, F.lit(name)) for failed, name in verdicts])
    judged = measured.withColumn("base_failed", base).withColumn("failed_rule", first)
    return judged.withColumn("kept", F.col("failed_rule").isNull())
