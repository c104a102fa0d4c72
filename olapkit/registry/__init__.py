"""Every query of the library, by name."""

from olapkit.registry import encodings, layouts, rows, sales, scans, series, shapes, tables  # noqa: F401
from olapkit.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
