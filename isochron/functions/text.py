"""Names and free text: accents, canonical forms, city names, list literals, identifiers."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every code point that decomposes lies below the end; the syllables of Hangul are left composed, as their parts are letters
# of the same word and not accents.
_DECOMPOSING_BELOW = 0x2FA20
_HANGUL = range(0xAC00, 0xD7A4)
_SURROGATES = range(0xD800, 0xE000)
# Punctuation that separates the words of a name.
SEPARATORS = "'’-_.,()/\\"
# All characters that count as white space.
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


@functools.cache
def _accent_tables() -> tuple[dict[str, str], str, str]:
    """(character -> one-character base, removed marks, lines of a character followed by its longer base)."""
    single, marks, longer = {}, [], []
    for code in range(0xA0, _DECOMPOSING_BELOW):
        if code in _HANGUL or code in _SURROGATES:
            continue
        char = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if not base:
            marks.append(char)
        elif len(base) > 1:
            longer.append(char + base)
        elif base != char:
            single[char] = base
    return single, "".join(marks), "\n".join(longer)


def strip_accents(text: Column, spaces: str = "") -> Column:
    """Base letters only; characters of `spaces` become blanks in the same pass.

    ASCII text, which is most text, needs only the blanks. In other text one pass replaces single characters; the few that expand
    are replaced only where present.
    """
    single, marks, longer = _accent_tables()
    table = single | dict.fromkeys(spaces, " ")
    expanding = "".join(item[0] for item in longer.split("\n"))
    expanded = F.aggregate(
        F.split(F.lit(longer), "\n"), text,
        lambda done, item: F.replace(done, F.substring(item, 1, 1), F.substring(item, 2, 20)),
    )
    source = F.when(F.translate(text, expanding, "") != text, expanded).otherwise(text)
    full = F.translate(source, "".join(table) + marks, "".join(table.values()))
    blanks = "".join(c for c in spaces if c.isascii())
    short = F.translate(text, blanks, " " * len(blanks)) if blanks else text
    return F.when(text.rlike(r"[^\x00-\x7F]"), full).otherwise(short)


def squeeze(text: Column) -> Column:
    """Runs of blanks as one, none at the ends."""
    return F.trim(F.regexp_replace(text, "  +", " "))


def canonicalize(text: Column) -> Column:
    """Lower case, no accents, punctuation and white space as single blanks; null and 'nan' give ''."""
    plain = squeeze(strip_accents(F.lower(text), SEPARATORS + SPACES))
    return F.when(text.isNull() | (F.lower(text) == "nan"), F.lit("")).otherwise(plain)


def normalize_city(text: Column) -> Column:
    """Letters, spaces and hyphens, with the abbreviations of 'saint' and 'sainte' spelled out; null gives ''."""
    plain = squeeze(F.regexp_replace(strip_accents(F.lower(text), SPACES), r"[^a-z\-]", " "))
    words = (("ste", "sainte"), ("st", "saint"))
    for short, full in words:
        plain = F.replace(plain, F.lit(f" {short} "), F.lit(f" {full} "))
    for short, full in words:
        plain = F.regexp_replace(plain, f"^{short} ", f"{full} ")
    return F.coalesce(plain, F.lit(""))


def sanitize(name: Column) -> Column:
    """A name that is safe in paths: no accents, other characters than word characters, '-' and '.' become '_'."""
    return F.regexp_replace(strip_accents(F.trim(name)), r"[^\p{L}\p{N}_\-.]+", "_")


def parse_list(text: Column) -> Column:
    """"['a', 'b']" or 'a, b' as an array of strings; anything unreadable as a list is split at its commas."""
    literal = F.from_json(F.translate(text, "'", '"'), "array<string>", {"mode": "PERMISSIVE"})
    split = F.filter(F.transform(F.split(text, ","), lambda item: F.trim(item)), lambda item: item != "")
    listed = F.when(F.startswith(F.trim(text), F.lit("[")), F.coalesce(literal, split)).otherwise(split)
    return F.coalesce(listed, F.array().cast("array<string>"))


def surrogate_key(*parts: Column) -> Column:
    """SHA-256 of the non-null parts joined by '_'."""
    return F.sha2(F.concat_ws("_", *[part.cast("string") for part in parts]), 256)


def first_letter(text: Column) -> Column:
    return F.upper(F.substring(text, 1, 1))
