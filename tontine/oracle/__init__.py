"""Reference SQL (DuckDB dialect) for every registered query.

Each statement rebuilds the fixture tables from the same input parquet views
and computes the query with plain SQL, independently of the Spark plans.
"""

from tontine.oracle.sql import ORACLE_SQL

__all__ = ["ORACLE_SQL"]
