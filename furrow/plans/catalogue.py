"""All queries of the library over the driver's tables, and the SQL that says the same."""

from __future__ import annotations

from furrow.plans import fixtures, places, rasters, scenes, statistics, timeseries  # noqa: F401

QUERIES, ORACLE_SQL = fixtures.QUERIES, fixtures.ORACLE_SQL
