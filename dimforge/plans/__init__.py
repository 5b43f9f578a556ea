"""Registered queries (``catalog``, ``constructs``), their DuckDB twins
(``oracle``, ``views_sql``) and the local comparison harness."""
