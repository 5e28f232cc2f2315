"""Named queries and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isochron.session import apply_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Added before rounding, so that exact halves round the same way in every engine.
NUDGE = 1e-9


def comparable(df: DataFrame, rounded: Sequence[str], digits: int) -> DataFrame:
    """Timestamps without zone, dates as text, and the named doubles rounded."""
    changed = {c: F.round(F.col(c) + NUDGE, digits) for c in rounded}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.TimestampType):
            changed[field.name] = F.col(field.name).cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DateType):
            changed[field.name] = F.col(field.name).cast("string")
    return df.withColumns(changed) if changed else df


def query(sql: str | None = None, rounded: Sequence[str] = (), digits: int = 4):
    """Register a function (spark, sf_dir) -> DataFrame under its name, with its SQL if it has one."""
    def register(build: Callable[[SparkSession, str], DataFrame]):
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(apply_settings(spark), sf_dir), rounded, digits)

        QUERIES[build.__name__] = run
        if sql:
            replaced = ", ".join(f"round({c} + {NUDGE}, {digits}) + 0.0 AS {c}" for c in rounded)
            ORACLES[build.__name__] = f"SELECT * REPLACE ({replaced}) FROM ({sql})" if rounded else sql
        return build

    return register
