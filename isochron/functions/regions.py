"""Region names: mapping, harmonising and checking against the standard labels.

The alias lists are short fixed values, so they travel inside the expression: no join, no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from isochron.fixed_values import (
    EXTRA_SPELLINGS, FORCED_LABEL, FORCED_LABEL_FOR, OVERSEAS, REGION_ALIASES, REGIONS,
)
from isochron.functions.binding import literal
from isochron.functions.text import SPACES, squeeze

CANONICAL = [canon for canon, *_ in REGIONS]
LABELS = [label for _, label, *_ in REGIONS]
LABEL_OF = {canon: label for canon, label, *_ in REGIONS}


def _lookup(key: Column, rows: list[tuple[str, str]]) -> Column:
    """The target of a name, null if it is not listed."""
    return F.try_element_at(literal(dict(rows), "map<string,string>"), key)


def _first_overlap(key: Column, rows: list[tuple[str, str]]) -> Column:
    """The target of the first row whose name contains the key or is contained in it; none for an empty key."""
    pairs = literal([{"name": name, "target": target} for name, target in rows], "array<struct<name string,target string>>")
    hits = F.filter(pairs, lambda row: key.contains(row["name"]) | row["name"].contains(key))
    return F.when(key != "", F.get(hits, F.lit(0))["target"])


def map_region(name: Column) -> Column:
    """Canonical region of a canonical-form name; null for overseas names, the name itself for unknown ones."""
    known = F.coalesce(_lookup(name, REGION_ALIASES), F.when(name.contains("rhone alpe"), "auvergne rhone alpes"), name)
    return F.when(~name.isin(OVERSEAS), known)


def is_canonical(name: Column) -> Column:
    return name.isin(CANONICAL)


def display_name(name: Column, raw: Column) -> Column:
    """The raw spelling, except where a label is forced."""
    return F.when(name.isin(FORCED_LABEL_FOR), FORCED_LABEL).otherwise(raw)


def harmonize_region(name: Column, raw: Column) -> Column:
    """Standard label of a canonical-form name: exact, else the first spelling that overlaps, else the raw name."""
    spellings = REGION_ALIASES + EXTRA_SPELLINGS
    known = {spelling for spelling, _ in spellings}
    rows = [(spelling, LABEL_OF[canon]) for spelling, canon in spellings]
    rows += [(canon, label) for canon, label, *_ in REGIONS if canon not in known]
    return F.coalesce(_lookup(name, rows), _first_overlap(name, rows), F.nullif(raw, F.lit("")))


def simplified(label: Column) -> Column:
    """The loose form in which labels are compared."""
    return squeeze(F.translate(F.lower(label), "-'éô" + SPACES, "  eo" + " " * len(SPACES)))


def standard_label(name: Column, loose: Column) -> Column:
    """The first standard label whose loose form equals, contains or is contained in that of the name."""
    labels = F.transform(
        literal(LABELS, "array<string>"), lambda label: F.struct(label.alias("label"), simplified(label).alias("loose"))
    )
    hits = F.filter(
        labels,
        lambda row: loose.contains(row["loose"]) | row["loose"].contains(loose)
        | (F.translate(loose, " ", "") == F.translate(row["loose"], " ", "")),
    )
    return F.when(name.isin(LABELS), name).otherwise(
        F.coalesce(F.when(loose != "", F.get(hits, F.lit(0))["label"]), F.nullif(name, F.lit("")))
    )


def is_standard(name: Column) -> Column:
    return name.isin(LABELS)
