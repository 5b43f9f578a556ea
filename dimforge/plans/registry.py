"""All registered queries and their DuckDB twins."""

from __future__ import annotations

from dimforge.plans.catalog import QUERIES as _COMPOSITE
from dimforge.plans.constructs import CONSTRUCTS as _CONSTRUCTS
from dimforge.plans.increments import ORACLE as _INCREMENT_SQL
from dimforge.plans.increments import QUERIES as _INCREMENTS
from dimforge.plans.oracle import ORACLE as _SQL

QUERIES = {**_COMPOSITE, **_CONSTRUCTS, **_INCREMENTS}
ORACLE = {**_SQL, **_INCREMENT_SQL}

__all__ = ["QUERIES", "ORACLE"]
