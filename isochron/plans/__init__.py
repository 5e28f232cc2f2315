"""Views and the registered queries, each next to the SQL it is checked against."""

from isochron.plans import basics, forecasts, places, roundtrips, series, streams  # noqa: F401
from isochron.plans.registry import ORACLES, QUERIES  # noqa: F401
