"""Conformance cases: key → (Spark query, equivalent DuckDB SQL).

Each Spark query takes ``(spark, sf_dir)``, reads the test tables from ``sf_dir``
and returns a lazy DataFrame. Importing the submodules fills the registry.
"""

from reportlake.conformance.registry import ORACLE, QUERIES  # noqa: F401
from reportlake.conformance import edges, guard, reports, relational, scalars, shipped, spread, tier_a  # noqa: F401,E402


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
