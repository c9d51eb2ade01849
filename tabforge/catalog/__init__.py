"""The query catalogue: importing it registers every query."""

from tabforge.catalog import evaluation, features, models, profiling, streams, ties, training  # noqa: F401
from tabforge.catalog.registry import ORACLES, QUERIES  # noqa: F401
