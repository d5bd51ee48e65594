"""Named queries over the driver's tables, and the SQL that gives the same rows.

The tables stand in for the feed: events are positions (a user is a vessel, value a speed, the type a zone, errors lie
outside of all zones), sessions of events are calls, a user's share of three berths, orders and lines are intervals.
Each query applies the library's own operators; the SQL is written for itself.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from harborline.plans import catalog_models, catalog_operators

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = catalog_operators.QUERIES | catalog_models.QUERIES
ORACLE_SQL: dict[str, str] = catalog_operators.ORACLE_SQL | catalog_models.ORACLE_SQL
