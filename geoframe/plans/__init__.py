"""Registered check queries (``queries()`` / ``oracle_sql()`` of the entry
module).  Importing this package fills the registry."""

from geoframe.plans import catalog_checks, column_checks, scan_checks  # noqa: F401
from geoframe.plans.registry import KIND, ORACLE_SQL, QUERIES

__all__ = ["KIND", "ORACLE_SQL", "QUERIES"]
