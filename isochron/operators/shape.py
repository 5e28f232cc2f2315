"""Column plumbing: optional columns, headers, packed headers, column order, row concatenation, observed metrics."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isochron.fixed_values import HEADER_SYNONYMS, LEADING_COLUMNS


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def with_defaults(df: DataFrame, spec: T.StructType, default=None) -> DataFrame:
    """Add the absent columns of a schema as typed literals."""
    absent = {f.name: F.lit(default).cast(f.dataType) for f in spec.fields if f.name not in df.columns}
    return df.withColumns(absent) if absent else df


def clean_names(names: list[str]) -> list[str]:
    """Trimmed names, runs of white space (also no-break spaces) as one, known spellings renamed."""
    trimmed = [re.sub(r"[^\S\t]+", " ", name.removeprefix("\ufeff")).strip() for name in names]
    return [HEADER_SYNONYMS.get(name, name) for name in trimmed]


def clean_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_names(df.columns))


def split_packed(df: DataFrame, packed: str, separator: str = "\t") -> DataFrame:
    """Repair a table whose whole header, and every row, sits in one column: one column per header part."""
    targets = [part.strip() for part in packed.split(separator) if part.strip()]
    parts = F.split(F.col(quoted(packed)), re.escape(separator))
    rest = [F.col(quoted(c)) for c in df.columns if c != packed]
    return df.select(*rest, *[F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(targets)])


def split_all_packed(df: DataFrame) -> DataFrame:
    return reduce(split_packed, [c for c in df.columns if "\t" in c], df)


def lead_with(df: DataFrame, leading: list[str] = LEADING_COLUMNS) -> DataFrame:
    """The leading columns that exist first, then the others in their order."""
    first = [c for c in leading if c in df.columns]
    return df.select(*first, *[F.col(quoted(c)) for c in df.columns if c not in first])


def concat_tables(*tables: DataFrame) -> DataFrame:
    """All rows under all columns; what a table lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def observed(df: DataFrame, name: str, *not_null: str) -> tuple[DataFrame, Observation]:
    """The table with row and null counts that fill in while some later action runs: no job of their own."""
    observation = Observation(name)
    nulls = [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in not_null]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *nulls), observation
