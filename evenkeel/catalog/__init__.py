from evenkeel.catalog import drift, governance, keyed, models, tables
from evenkeel.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "drift", "governance", "keyed", "models", "tables"]
