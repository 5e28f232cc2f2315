"""Naming an intermediate value inside a Column expression, and small tables as literals."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value evaluated once per row.

    A projection of its own would be undone when a filter on the result is pushed through it: the filter then repeats
    the whole expression for each use of the value. A lambda variable stays a variable.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def literal(value, schema: str) -> Column:
    """A list or dict of fixed values as one constant of the given type, folded before execution."""
    return F.from_json(F.lit(json.dumps(value, ensure_ascii=False)), schema)
