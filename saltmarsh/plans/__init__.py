from . import aggregations, encodings, filters, fitted, joins, metrics, models, scalars, scans, sets, windows  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
