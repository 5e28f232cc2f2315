"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions or a shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isochron.functions.binding import let

SPACE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it as with was be by on are this at from or an not have "
    "der die und das in den von zu mit sich auf für ist im dem nicht ein eine als auch es an "
    "le la les de des et un une du en que qui dans pour pas sur au avec est par il elle ce "
    "el los las y del se por con una su para como más no lo al"
)

# Texts with fewer words may lack function words by chance.
JUDGED_FROM = 30


@dataclass(frozen=True)
class Rule:
    """A value computed from the counts of a document must lie in [low, high]; a null value (a ratio to nothing) passes."""

    name: str
    value: str
    low: float | None = None
    high: float | None = None


# The document is kept when every value is in its range. Values are SQL over the columns that `counts` adds.
RULES = (
    Rule("length", "n_words", low=10),
    Rule("mean_word_length", "try_divide(word_chars, n_words)", low=2, high=15),
    Rule("symbols", "try_divide(n_symbols, n_words)", high=0.15),
    Rule("exclamations", "try_divide(n_marks, n_words)", high=0.5),
    Rule("capitals", "try_divide(n_capitals, word_chars)", high=0.5),
    Rule("stop_words", "try_divide(n_stop_words, n_judged)", low=0.02),
    Rule("duplicate_lines", "try_divide(n_dup_lines, n_lines)", high=0.5),
)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def occurrences(text: Column, characters: str) -> Column:
    """How many characters of the text are in the given set."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def repeated_cover(words: Column, width: int) -> Column:
    """How many words lie in a window of `width` words that the array holds at least twice.

    Windows are compared by a 64-bit hash of their words' hashes. Only where some hash repeats are windows sorted to find the
    repeated ones; their starts, in order, give the cover.
    """
    def grams(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - width)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(width)]))

    def starts_of_repeats(sorted_grams: Column) -> Column:
        def start(x: Column, j: Column) -> Column:
            same = (F.get(sorted_grams, j - 1)["h"] == x["h"]) | (F.get(sorted_grams, j + 1)["h"] == x["h"])
            return F.when(F.coalesce(same, F.lit(False)), x["i"]).otherwise(F.lit(-1))

        return F.sort_array(F.filter(F.transform(sorted_grams, start), lambda i: i >= 0))

    def cover(starts: Column) -> Column:
        reach = F.transform(starts, lambda x, j: F.least(F.lit(width), F.coalesce(F.get(starts, j + 1) - x, F.lit(width))))
        return F.aggregate(reach, F.lit(0), lambda total, n: total + n)

    def of_grams(hashed: Column) -> Column:
        indexed = F.transform(hashed, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        found = let(F.sort_array(indexed), lambda s: let(starts_of_repeats(s), cover))
        return F.when(F.size(F.array_distinct(hashed)) == F.size(hashed), F.lit(0)).otherwise(found)

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < width, F.lit(0)).otherwise(let(hashes, lambda h: let(grams(h), of_grams)))


def counts(text: Column, stop_words: Sequence[str] = tuple(STOP_WORDS.split())) -> dict[str, Column]:
    """Expressions of all counts that rules may use; a null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    lines = F.split(text, "\n")
    in_words = F.col("_words")
    return {
        "_words": words_of(text),
        "_lines": F.transform(F.filter(lines, lambda x: F.length(F.translate(x, BLANKS, "")) > 0), lambda x: F.xxhash64(x)),
        "n_words": F.size(in_words).cast("long"),
        "word_chars": F.length(F.translate(text, BLANKS, "")).cast("long"),
        "n_symbols": occurrences(text, SYMBOLS).cast("long"),
        "n_marks": occurrences(text, "!").cast("long"),
        "n_capitals": occurrences(text, CAPITALS).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_stop_words": F.size(F.filter(in_words, lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?"))).isin(*stop_words))).cast("long"),
        "n_judged": F.when(F.size(in_words) >= JUDGED_FROM, F.size(in_words)).otherwise(0).cast("long"),
        "n_repeat_words": repeated_cover(in_words, 5).cast("long"),
    }


def verdict(rules: Sequence[Rule]) -> Column:
    """One boolean for the whole table."""
    passed = F.lit(True)
    for rule in rules:
        value = F.expr(rule.value)
        if rule.low is not None:
            passed &= F.coalesce(value >= rule.low, F.lit(True))
        if rule.high is not None:
            passed &= F.coalesce(value <= rule.high, F.lit(True))
    return passed


def judge(documents: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """All columns of `documents`, the counts, base_failed (under ten words, or over a fifth of the words in repeated
    windows of five) and kept (not base_failed and within all rules).

    Null and empty texts have no words and fail. Every row is judged by itself, so repeated rows agree. Columns of
    `documents` that carry a name of the result are replaced. No shuffle: a map over the scan.
    """
    made = counts(F.col("_text"))
    own = [c for c in documents.columns if c not in {*made, "_text", "base_failed", "kept"}]
    rows = documents.select(*own, F.col(text).alias("_text"))
    rows = rows.withColumn("_words", made.pop("_words")).withColumn("_lines", made.pop("_lines"))
    rows = rows.withColumns(made)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    return rows.withColumn("kept", ~F.col("base_failed") & verdict(rules)).drop("_text", "_words", "_lines")

