"""Every operator as a query on the driver's tables, with the SQL it must equal."""

from checks import chains, columns, lookups, quality, runs, storage
from checks.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "chains", "columns", "lookups", "quality", "runs", "storage"]
