"""Numbers held as text, defaults, ratios, cyclic encodings and coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isochron.fixed_values import NUMERIC_NAME_TOKENS


def decimal_comma(text: Column) -> Column:
    """'1 234,5' -> 1234.5; anything that is no number -> null."""
    return F.translate(text.cast("string"), ",   ", ".").try_cast("double")


def coerce_numeric(df: DataFrame, tokens: list[str] = NUMERIC_NAME_TOKENS) -> DataFrame:
    """Make doubles of all columns whose name holds one of the tokens."""
    hits = [c for c in df.columns if any(token in c.lower() for token in tokens)]
    return df.withColumns({c: decimal_comma(F.col(c)) for c in hits})


def number_or_null(value: Column) -> Column:
    return value.try_cast("double")


def number_or_zero(value: Column) -> Column:
    return F.coalesce(value.try_cast("double"), F.lit(0.0))


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    """(sine, cosine) of a value on a circle of the given period."""
    angle = F.pi() * 2 * value / period
    return F.sin(angle), F.cos(angle)


def renewable_ratio(consumption: Column, *sources: Column) -> Column:
    """Share of consumption covered by the sources; consumption counts as at least 1."""
    total = sum((F.coalesce(source, F.lit(0.0)) for source in sources), F.lit(0.0))
    return total / F.greatest(consumption, F.lit(1.0))


def coordinates(text: Column) -> tuple[Column, Column]:
    """(lat, lon) from {"lat":,"lon":}, {"latitude":,"longitude":}, [lon, lat] or POINT (lon lat)."""
    pair = r"(-?[\d.]+)"
    point = rf"(?i)POINT\s*\({pair}\s+{pair}\)"
    listed = rf"^\s*\[\s*{pair}\s*,\s*{pair}"

    def axis(names: list[str], group: int) -> Column:
        found = [F.get_json_object(text, f"$.{name}") for name in names]
        found += [F.regexp_extract(text, pattern, group) for pattern in (point, listed)]
        return F.coalesce(*[candidate.try_cast("double") for candidate in found])

    return axis(["lat", "latitude"], 2), axis(["lon", "longitude"], 1)
