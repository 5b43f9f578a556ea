"""dimforge — dimensional and fact modelling on Spark.

Cumulative dimensions (history kept in an array of structs), type-2 slowly
changing dimensions (full load and increment), datelist / bit-packed
activity tables, typed and de-duplicated fact tables and reduced
(daily -> monthly array) facts, expressed as DataFrame compositions so
Catalyst plans them and every shuffle is explicit in ``explain()``.
"""

from dimforge.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
